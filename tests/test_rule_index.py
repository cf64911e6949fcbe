"""Rules of any number, and groups inside groups."""

import random

import pytest

from colmask import classify_columns, classify_indexed, group_closure, has_grant, mask_table, register_mask_functions
from colmask.operators import rule_index
from colmask.plans.mask import create_masked_view
from colmask.operators.rules import Rule
from colmask.schemas import COLUMNS
from tests.conftest import rows

RULES = "prio int, keyword string, mode string, string_only boolean"
COLUMNS = "TableName string, Ordinal int, ColumnName string, DataType string"


@pytest.mark.parametrize("seed", range(2))
def test_equals_scan(spark, seed, monkeypatch):
    if seed == 1:
        monkeypatch.setattr(rule_index, "BROADCAST_BYTES", 0)
    draw = random.Random(seed)

    def word(low, high):
        return "".join(draw.choice("abcDE") for _ in range(draw.randint(low, high)))

    rules = [(draw.randint(0, 40), word(1, 6), draw.choice(["edge", "contains", None]), draw.random() < 0.3) for _ in range(150)]
    columns = [(f"t{draw.randint(0, 5)}", i, word(0, 9), draw.choice(["string", "INT"])) for i in range(600)]
    columns += [("hot", i, "abcabc", "string") for i in range(300)]
    rules, columns = spark.createDataFrame(rules, RULES), spark.createDataFrame(columns, COLUMNS)
    want = rows(classify_columns(columns, rules))
    assert want and rows(classify_indexed(columns, rules)) == want


def test_odd_rules(spark):
    columns = spark.createDataFrame([("t", 0, "Zip", "int"), ("t", 1, "zip", "string"), ("t", 2, None, "int"), ("t", 3, "q", "int")], COLUMNS)
    odd = spark.createDataFrame([(1, None, "contains", False), (9, "", "contains", False), (2, "ZIP", "edge", True), (3, "zzzz", "edge", False)], RULES)
    want = rows(classify_columns(columns, odd))
    assert rows(classify_indexed(columns, odd)) == want
    assert ("t", "zip", "zip", "string", True) in want
    assert classify_indexed(columns, odd.limit(0)).count() == 0
    assert classify_indexed(columns.limit(0), odd).count() == 0


@pytest.fixture
def grants(spark):
    return spark.createDataFrame(
        [("ann", "ward"), ("ward", "clinic"), ("clinic", "pii_access"), ("pii_access", "ward"), ("bob", "lab"), ("lab", "lab"),
         ("cy", "pii_access"), (None, "ward"), ("dee", None), ("ann", "ward"), ("eve", "clinic")],
        "principal string, grp string",
    )


def test_closure(spark, grants):
    closure = group_closure(grants, ["pii_access", "lab", "none"])
    assert rows(closure, "member", "grp") == [
        ("clinic", "pii_access"), ("lab", "lab"), ("none", "none"), ("pii_access", "pii_access"), ("ward", "pii_access"),
    ]
    assert rows(group_closure(grants.limit(0))) == [("pii_access", "pii_access")]


def test_reader_in_a_group_inside_a_group(spark, grants):
    from pyspark.sql import functions as F

    closure = group_closure(grants)
    people = spark.createDataFrame([("Smith",)], "lastname string")
    seen = {}
    for reader in ("ann", "bob", "cy", "dee", "eve", "ward", "nobody"):
        authorized = has_grant(grants, principal=F.lit(reader), closure=closure)
        seen[reader] = mask_table(people, ["lastname"], authorized=authorized).first()[0] == "Smith"
    assert seen == {"ann": True, "bob": False, "cy": True, "dee": False, "eve": True, "ward": True, "nobody": False}


def test_closure_in_views_and_functions(spark, grants):
    from pyspark.sql import functions as F

    me = spark.sql("SELECT current_user()").first()[0]
    for member, shown in (("ward", "Smith"), ("lab", "S****")):
        mine = grants.unionByName(grants.limit(1).select(F.lit(me).alias("principal"), F.lit(member).alias("grp")))
        mine.createOrReplaceTempView("ng_grants")
        group_closure(mine).createOrReplaceTempView("ng_closure")
        spark.sql("CREATE OR REPLACE TEMPORARY VIEW ng_people AS SELECT 'Smith' AS lastname")
        create_masked_view(spark, "ng_shown", "ng_people", ["lastname"], "ng_grants", closure_table="ng_closure")
        assert spark.table("ng_shown").first()[0] == shown
        register_mask_functions(spark, "ng_grants", closure_table="ng_closure")
        assert spark.sql("SELECT tc_string_mask(lastname) FROM ng_people").first()[0] == shown


def test_a_rules_table_finds_what_the_same_list_finds(spark):
    """Columns without a type, a place or a name count too, and no rule is tried on every column."""
    listed = [Rule("mail", string_only=True), Rule("fax", mode="edge"), Rule("st"), Rule("")]
    names = ["Email", "EMAIL", "fax_no", "no_fax_x", "street", "a_id", "zz", None]
    columns = spark.createDataFrame(
        [
            (t, place, name, dtype)
            for t in ("a.b.t", None)
            for i, name in enumerate(names)
            for place, dtype in ((i, "string"), (None, "INT"), (i + 9, None), (i, "string"))
        ],
        COLUMNS,
    )
    for n in (3, 4):
        table = spark.createDataFrame(
            [(i, r.keyword, r.mode, r.string_only) for i, r in enumerate(listed[:n])],
            "prio int, keyword string, mode string, string_only boolean",
        )
        got = classify_columns(columns, table)
        assert rows(got) == rows(classify_columns(columns, listed[:n]))
        assert got.count()
        assert "scalar-subquery" not in got._jdf.queryExecution().optimizedPlan().toString()
