"""Rules that tell from a column's name and type what it probably holds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keywords in priority order, the ones with special rules, and
# the name endings that rule a column out.
KEYWORDS = (
    "firstname", "lastname", "middlename",
    "street", "address", "zip", "county", "city", "state",
    "dob", "dod", "doa",
    "ssn",
    "phone", "mobile", "telephone", "fax",
    "mail",
    "race",
    "medicare", "medicaid",
    "license", "npi",
)
EDGE_KEYWORDS = ("fax", "city", "state")
STRING_KEYWORDS = ("mail",)
EXCLUDED_SUFFIXES = ("id", "flag", "yn")


@dataclass(frozen=True)
class Rule:
    """``mode`` is ``contains``, or ``edge`` for names that start or end with it."""

    keyword: str
    mode: str = "contains"
    string_only: bool = False

    def matches(self, name: Column, dtype: Column) -> Column:
        """Condition on a lowercase name and type."""
        word = self.keyword.lower()
        if self.mode == "edge":
            found = name.startswith(word) | name.endswith(word)
        else:
            found = name.contains(word)
        return found & (dtype == "string") if self.string_only else found


def default_rules() -> list[Rule]:
    return [
        Rule(
            word,
            mode="edge" if word in EDGE_KEYWORDS else "contains",
            string_only=word in EDGE_KEYWORDS + STRING_KEYWORDS,
        )
        for word in KEYWORDS
    ]


def rules_value(rules: DataFrame) -> Column:
    """A table ``(prio, keyword, mode, string_only)`` a steward edits, as one value.

    It is looked up when the query runs: an array of structs by priority. However many rules there are, the
    expression stays the same.
    """
    row = F.struct("prio", F.lower("keyword").alias("keyword"), "mode", "string_only")
    return rules.agg(F.sort_array(F.collect_list(row)).alias("rules")).scalar()


def first_keyword(name: Column, dtype: Column, rules: Column) -> Column:
    """Priority and keyword of the first rule of ``rules_value`` that matches a lowercase name, null if none does."""

    def found(rule: Column) -> Column:
        word = rule["keyword"]
        edge = name.startswith(word) | name.endswith(word)
        hit = F.when(rule["mode"] == "edge", edge).otherwise(name.contains(word))
        return hit & (~rule["string_only"] | (dtype == "string"))

    return F.get(F.filter(rules, found), F.lit(0))


def has_excluded_suffix(name: Column, suffixes: Sequence[str] = EXCLUDED_SUFFIXES) -> Column:
    excluded = F.lit(False)
    for suffix in suffixes:
        excluded = excluded | name.endswith(suffix)
    return excluded


def rule_position(name: Column, dtype: Column, rules: Sequence[Rule]) -> Column:
    """Position of the first rule that matches, NULL if none does.

    One CASE expression per column of the inventory: no join with the rules
    and no window over the matches.
    """
    if not rules:
        return F.lit(None).cast("int")
    position = None
    for i, rule in enumerate(rules):
        found = rule.matches(name, dtype)
        position = F.when(found, F.lit(i)) if position is None else position.when(found, F.lit(i))
    return position


def shadowed_rules(rules: Sequence[Rule]) -> list[tuple[str, str]]:
    """Rules that can never win, each with the earlier rule that always does."""
    shadowed = []
    for i, late in enumerate(rules):
        for early in rules[:i]:
            wider = early.mode == "contains" and (late.string_only or not early.string_only)
            if wider and early.keyword.lower() in late.keyword.lower():
                shadowed.append((late.keyword, early.keyword))
                break
    return shadowed
