"""Fields inside structs, arrays and maps."""

import pytest
from pyspark.sql.types import StructType

from colmask import ControlTable, UnsupportedTypeError, apply_control, classify_fields, discover_catalog, mask_table
from colmask.functions.nested import leaves
from colmask.operators.audit import fields_exposure
from colmask.plans.mask import MaskRunError, create_masked_view
from colmask.sources.inventory import columns_inventory
from tests.conftest import rows

SCHEMA = (
    "id int, person struct<lastname: string, `a.b`: string, addr: array<struct<zip: int, raw_zip: binary>>>, "
    "ssn_list array<array<string>>, phones map<string, struct<no: bigint>>, empty array<date>"
)


@pytest.fixture(scope="module")
def people(spark):
    data = [
        (1, ("Smith", "x", [(12345, b"1"), (None, b"2"), None]), [["123", None], None, []], {"home": (55512,), "work": None}, []),
        (2, None, None, None, None),
        (3, (None, None, None), [], {}, [None]),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_paths(spark, people):
    found = {leaf.path: leaf.dtype for leaf in leaves(people.schema)}
    assert found == {
        "id": "int", "person.lastname": "string", "person.`a.b`": "string", "person.addr.element.zip": "int",
        "person.addr.element.raw_zip": "binary", "ssn_list.element.element": "string", "phones.key": "string",
        "phones.value.no": "bigint", "empty.element": "date",
    }


def test_masks_inside(people):
    masked = mask_table(
        people, {"person.LastName": "redact", "person.addr.element.zip": "redact", "ssn_list.*": "shape", "phones.key": "preserve",
                 "phones.value.*": "full", "person.`a.b`": "full", "empty.*": "redact"}, key="k",
    )
    assert [c for c, _ in masked.dtypes] == people.columns
    one, two, three = [r.asDict(recursive=True) for r in masked.orderBy("id").collect()]
    assert one["person"]["lastname"] == "S****" and one["person"]["a.b"] == "****"
    assert [a and a["zip"] for a in one["person"]["addr"]] == ["1****", None, None]
    assert [a and bytes(a["raw_zip"]) for a in one["person"]["addr"]] == [b"1", b"2", None]
    assert one["ssn_list"] == [["nnn", None], None, []] and one["empty"] == []
    assert len(one["phones"]) == 2 and all(len(k) == 4 and k.islower() for k in one["phones"]) and "home" not in one["phones"]
    assert sorted(map(str, one["phones"].values())) == ["None", "{'no': '****'}"]
    assert list(two.values()) == [2, None, None, None, None]
    assert three["person"] == {"lastname": None, "a.b": "****", "addr": None}
    assert three["ssn_list"] == [] and three["phones"] == {} and three["empty"] == [None]


def test_authorized_readers_see_texts(people):
    shown = mask_table(people, ["person.addr.element.zip", "ssn_list.*"], authorized=True).orderBy("id").first()
    assert shown["person"]["addr"][0]["zip"] == "12345" and shown["ssn_list"][0] == ["123", None]


def test_what_cannot_be_masked(people):
    with pytest.raises(ValueError, match="no such column: person.gone"):
        mask_table(people, ["person.gone"])
    with pytest.raises(UnsupportedTypeError, match="person.addr.element.raw_zip"):
        mask_table(people, ["person.*"])
    with pytest.raises(UnsupportedTypeError, match="ssn_list"):
        mask_table(people, ["ssn_list"])
    with pytest.raises(ValueError, match="keys of a map"):
        mask_table(people, ["phones.*"])
    with pytest.raises(ValueError, match="whole columns"):
        mask_table(people, {"person.lastname": "token"}, vault=people)


def test_omitted_fields(people):
    left = mask_table(people, {"person.addr.element.raw_zip": "omit", "phones.key": "omit"})
    assert "raw_zip" not in left.schema["person"].simpleString() and "phones" not in left.columns


def test_a_column_with_a_dot_is_no_path(spark):
    df = spark.createDataFrame([("12", ("34",))], "`a.b` string, a struct<b: string>")
    assert rows(mask_table(df, ["a.b"])) == [("1*", ("34",))]
    assert rows(mask_table(df, ["`a.b`"])) == [("1*", ("34",))]


def test_classify(spark, people):
    schema = "mail struct<a: string, n: int, row_id: string>, MyPhones array<struct<Kind: string>>, x_flag struct<zip: int>, v int"
    tables = {"people": people, "other": spark.createDataFrame([], StructType.fromDDL(schema))}
    found = classify_fields(columns_inventory(spark, tables, nested=True))
    assert rows(found, "TableName", "ColumnName", "PIICategory", "DataType") == [
        ("other", "mail.a", "mail", "string"),
        ("other", "myphones.element.kind", "phone", "string"),
        ("other", "x_flag.zip", "zip", "int"),
        ("people", "person.addr.element.raw_zip", "zip", "binary"),
        ("people", "person.addr.element.zip", "zip", "int"),
        ("people", "person.lastname", "lastname", "string"),
        ("people", "phones.key", "phone", "string"),
        ("people", "phones.value.no", "phone", "bigint"),
        ("people", "ssn_list.element.element", "ssn", "string"),
    ]
    assert classify_fields(columns_inventory(spark, {}, nested=True)).count() == 0


def test_exposure(spark, people):
    audit = fields_exposure("p", people, {"person.lastname": "redact", "ssn_list.element.element": "redact", "phones.value.no": "full"})
    assert rows(audit) == [
        ("p", "person.lastname", 1, 0), ("p", "phones.value.no", 1, 0), ("p", "ssn_list.element.element", 1, 0),
    ]
    assert rows(fields_exposure("p", people.limit(0), {"phones.key": "redact"})) == [("p", "phones.key", 0, 0)]
    with pytest.raises(ValueError, match="no such field"):
        fields_exposure("p", people, {"person.gone": "redact"})


def test_control_run(spark, people, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS nested_run")
    people.write.mode("overwrite").saveAsTable("nested_run.people")
    control = ControlTable(spark, str(tmp_path / "control"))
    control.create()
    discover_catalog(spark, control, names=["nested_run.people"], nested=True)
    copy = str(tmp_path / "copy")
    strategies = {"phone": "hash"}
    with pytest.raises(MaskRunError) as failed:
        apply_control(
            spark, control, lambda name, df: df.write.parquet(copy), str(tmp_path / "logs"), strategies=strategies, key="k"
        )
    assert rows(failed.value.log.filter("status = 'failed'"), "ColumnName", "error") == [
        ("person.addr.element.raw_zip", "Unsupported data type: binary")
    ]
    out = spark.read.parquet(copy)
    assert "raw_zip" not in out.schema["person"].simpleString()
    first = out.orderBy("id").first()
    assert first["person"]["lastname"] == "S****" and first["ssn_list"][0] == ["1**", None] and "home" not in first["phones"]
    again = apply_control(
        spark, control, lambda name, df: 1 / 0, str(tmp_path / "logs"), strategies=strategies, key="k", strict=False
    )
    assert rows(again.log, "ColumnName", "status") == [("person.addr.element.raw_zip", "failed")]
    spark.sql("DROP SCHEMA nested_run CASCADE")


def test_view(spark, people):
    people.createOrReplaceTempView("nested_people")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW nested_grants AS SELECT 'no one' AS principal, 'pii_access' AS grp")
    create_masked_view(spark, "nested_shown", "nested_people", ["person.lastname", "ssn_list.*"], "nested_grants")
    seen = spark.table("nested_shown").orderBy("id").first()
    assert seen["person"]["lastname"] == "S****" and seen["ssn_list"][0] == ["1**", None]
