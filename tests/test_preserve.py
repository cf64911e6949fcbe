"""Format-preserving masks against a plain version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from colmask import mask_expr, mask_table
from colmask.functions.preserve import preserve_sql, restore_expr
from entry_queries import masks

KEY = "the key"


def plain(text, key=KEY):
    """The network character by character."""
    if text is None:
        return None
    kept = [c for c in text if re.match("[0-9A-Za-z]", c)]
    form = "".join("n" if "0" <= c <= "9" else "X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" else c for c in text)
    a, b = kept[0::2], kept[1::2]
    for r in range(10):
        out = []
        for i, c in enumerate(a):
            message = f"{r}|{i // 8}|{form}|{''.join(b)}"
            inner = hashlib.sha256((key + message).encode()).hexdigest()
            by = int(hashlib.sha256((key + inner).encode()).hexdigest()[i % 8 * 8 :][:8], 16)
            first, radix = ("0", 10) if c.isdigit() else ("A", 26) if c.isupper() else ("a", 26)
            out.append(chr(ord(first) + (ord(c) - ord(first) + by) % radix))
        a, b = b, out
    new = [x for pair in zip(a, [*b, ""]) for x in pair] if len(a) > len(b) else [x for pair in zip(a, b) for x in pair]
    rest = iter([c for c in new if c])
    return "".join(next(rest) if re.match("[0-9A-Za-z]", c) else c for c in text)


def texts():
    draw = random.Random(3)
    made = ["".join(draw.choices("0123456789abcxyzABCXYZ-. é日\U0001f600", k=n)) for n in [*range(30), 80, 300]]
    return [None, "", "-", "7", "a", "Z", "ab", "123-45-6789", "Mary-Jane O'Neil", "été", "a\nb|c", *made]


def test_against_a_plain_version(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "i int, s string")
    got = frame.select("i", "s", F.expr(preserve_sql("s", f"'{KEY}'")).alias("m")).withColumn("back", restore_expr("m", f"'{KEY}'"))
    for r in got.collect():
        assert r["m"] == plain(r["s"])
        assert r["back"] == r["s"]
        if r["s"]:
            assert len(r["m"]) == len(r["s"])


def test_bijective_on_all_values_of_six_digits(spark):
    values = spark.range(1_000_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("v"))
    masked = values.select("v", F.expr(preserve_sql("v", f"'{KEY}'")).alias("m"))
    seen = masked.agg(
        F.countDistinct("m").alias("n"), F.count_if(F.expr("m = v")).alias("same"), F.count_if(F.expr("m RLIKE '^[0-9]{6}$'")).alias("fit")
    ).first()
    assert (seen["n"], seen["fit"]) == (1_000_000, 1_000_000) and seen["same"] < 20
    plan = masked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_other_keys_and_forms_give_other_masks(spark):
    frame = spark.createDataFrame([(f"{i:06d}",) for i in range(300)], "v string")
    one, two = (F.expr(preserve_sql("v", f"'{k}'")) for k in ("one", "two"))
    dashed = F.regexp_replace(F.expr(preserve_sql("concat(left(v, 3), '-', right(v, 3))", "'one'")), "-", "")
    assert frame.filter(one == two).count() < 5 and frame.filter(one == dashed).count() < 5


def test_as_a_strategy(spark):
    frame = spark.createDataFrame([("123-45-6789", 4321, "x")], "ssn string, n int, s string")
    got = mask_table(frame, {"ssn": "preserve", "n": "preserve", "s": "preserve"}, key=KEY).first()
    assert tuple(got) == (plain("123-45-6789"), plain("4321"), plain("x"))
    with pytest.raises(ValueError, match="needs a key"):
        mask_expr("ssn", "string", strategy="preserve")


def test_customers_of_one_file_are_dealt_out(spark, tmp_path):
    people = spark.range(200).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id AS DOUBLE) AS c_acctbal")
    people.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    masked = masks.mask_preserve(spark, str(tmp_path))
    assert masked.rdd.getNumPartitions() == 4
    assert {r["c_custkey"]: r["restored"] for r in masked.collect()} == {i: f"Customer#{i}" for i in range(200)}
