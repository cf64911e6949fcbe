import random

import pytest

from colmask import Rule, classify_columns, default_rules, excluded_by_suffix, shadowed_rules
from colmask.operators import rules as rules_module
from colmask.schemas import COLUMNS
from tests.conftest import rows

# Column, type and expected category of one table.
GOLDEN = [
    ("FirstName", "string", "firstname"), ("first_name", "string", None), ("DOB", "date", "dob"),
    ("ssn", "string", "ssn"), ("is_ssn_verified_flag", "boolean", None),
    ("medicaid", "string", None), ("medicaid_number", "string", "medicaid"),
    ("telephone", "string", "phone"), ("faxphone", "string", "phone"), ("email", "string", "mail"),
    ("email_verified", "boolean", None), ("email_address", "string", "address"),
    ("home_city", "string", "city"), ("velocity", "string", "city"), ("facility", "string", None),
    ("city_code", "int", None), ("state", "string", "state"), ("statement", "string", "state"),
    ("state_code", "int", None), ("real_estate_tax", "string", None), ("fax", "string", "fax"),
    ("fax_count", "int", None), ("office_fax_no", "string", None), ("zip_code", "int", "zip"),
    ("trace_ts", "timestamp", "race"), ("doa", "timestamp_ntz", "doa"), ("npi", "bigint", "npi"),
    ("npi_id", "bigint", None), ("license_yn", "string", None),
    ("street_address", "string", "street"), ("mail_state", "string", "state"),
    ("mail_state_x", "string", "mail"), ("city_state", "string", "city"),
    ("gross_charges", "decimal(12,4)", None), ("ssn_history", "array<string>", "ssn"),
]


def inventory(spark, entries, table="clinic.hr.patients"):
    data = [(table, i, name, dtype) for i, (name, dtype) in enumerate(entries)]
    return spark.createDataFrame(data, COLUMNS)


def brute_force(columns):
    """The matches of an inventory by plain loops over tables, rules and columns."""
    found = {}
    tables = sorted({row[0] for row in columns})
    for table in tables:
        own = sorted((r for r in columns if r[0] == table), key=lambda r: r[1])
        for keyword in rules_module.KEYWORDS:
            for _, _, name, dtype in own:
                name, dtype = name.lower(), dtype.lower()
                if name[-2:] in ("id", "yn") or name[-4:] == "flag":
                    continue
                hit = keyword in name
                if keyword in ("fax", "city", "state"):
                    at_edge = name[: len(keyword)] == keyword or name[-len(keyword):] == keyword
                    hit = at_edge and dtype == "string"
                elif keyword == "mail":
                    hit = hit and dtype == "string"
                if hit:
                    found.setdefault((table, name), (keyword, dtype))
    return sorted((t, k, n, d, True) for (t, n), (k, d) in found.items())


def test_golden_table(spark):
    got = classify_columns(inventory(spark, [(n, t) for n, t, _ in GOLDEN]))
    want = sorted(
        ("clinic.hr.patients", c, n.lower(), t, True) for n, t, c in GOLDEN if c is not None
    )
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) == 22


def test_random_names_against_brute_force(spark):
    rng = random.Random(7)
    parts = list(rules_module.KEYWORDS) + ["_", "x", "id", "flag", "yn", "ID", "City", "No", "MAIL"]
    types = ["string", "STRING", "int", "date", "array<string>"]
    data = [
        (f"t{rng.randrange(20)}", i, "".join(rng.choices(parts, k=rng.randrange(1, 4))), rng.choice(types))
        for i in range(4000)
    ]
    got = classify_columns(spark.createDataFrame(data, COLUMNS))
    assert sorted(tuple(r) for r in got.collect()) == brute_force(data)


def test_names_that_differ_in_case_count_once(spark):
    entries = [("City", "int"), ("city", "string"), ("SSN", "bigint"), ("ssn", "string")]
    got = classify_columns(inventory(spark, entries))
    assert rows(got, "PIICategory", "ColumnName", "DataType") == [
        ("city", "city", "string"),
        ("ssn", "ssn", "bigint"),
    ]


def test_keywords_are_no_patterns(spark):
    got = classify_columns(inventory(spark, [("a_b", "int"), ("axb", "int"), ("50%", "int")]),
                           [Rule("a_b"), Rule("%")])
    assert rows(got, "ColumnName") == [("50%",), ("a_b",)]


def test_excluded_by_suffix(spark):
    got = excluded_by_suffix(inventory(spark, [(n, t) for n, t, _ in GOLDEN]))
    assert rows(got, "PIICategory", "ColumnName") == [
        ("license", "license_yn"), ("medicaid", "medicaid"), ("npi", "npi_id"),
        ("ssn", "is_ssn_verified_flag"),
    ]


def test_empty_inventory_and_no_rules(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert classify_columns(empty).count() == 0
    assert classify_columns(inventory(spark, [("ssn", "string")]), []).count() == 0


def test_rules_from_a_table(spark):
    table = spark.createDataFrame(
        [(2, "city", "edge", True), (1, "passport", "contains", False)],
        "prio int, keyword string, mode string, string_only boolean",
    )
    columns = inventory(
        spark, [("MyPassport", "int"), ("city_passport", "string"), ("velocity_x", "string"), ("home_city", "string"), ("city", "int")]
    )
    want = rows(classify_columns(columns, [Rule("passport"), Rule("city", "edge", True)]))
    assert rows(classify_columns(columns, table)) == want and len(want) == 3
    many = spark.range(20_000).selectExpr(
        "int(id) AS prio", "concat('zz', id, '_') AS keyword", "'contains' AS mode", "false AS string_only"
    )
    assert rows(classify_columns(columns, many.unionByName(table)), "ColumnName") == [("city_passport",), ("home_city",), ("mypassport",)]
    assert classify_columns(columns, table.limit(0)).count() == 0


def test_shadowed_rules():
    assert shadowed_rules(default_rules()) == [("telephone", "phone")]
    assert shadowed_rules([Rule("mail", string_only=True), Rule("email")]) == []


def test_matching_uses_no_join(spark):
    plan = classify_columns(inventory(spark, [("ssn", "string")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Window" not in text
