"""Payloads and tables against the promoted columns."""

import json

from parcelflow.operators.conformance import payload_conformance, table_conformance
from parcelflow.schema import PROMOTED_NAMES, Field

FIELDS = [
    Field("ListingKey", "string", 5),
    Field("City", "string", 4),
    Field("ListPrice", "decimal(6,2)"),
    Field("Stories", "smallint"),
    Field("SpaYN", "boolean"),
    Field("CloseDate", "date"),
    Field("ModificationTimestamp", "timestamp"),
]


def payloads(spark, *records):
    rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(rows, "raw string")


def found(spark, *records):
    return {r.column_name: r for r in payload_conformance(payloads(spark, *records), FIELDS).collect()}


def test_each_fault_is_told_apart(spark):
    got = found(
        spark,
        {"ListingKey": "abcde", "City": "Rome", "ListPrice": "1.00", "Stories": 2, "SpaYN": True, "CloseDate": "2024-02-29", "Extra": 1},
        {"ListingKey": "abcdef", "City": 7, "ListPrice": 12345.5, "Stories": "3", "SpaYN": "yes", "CloseDate": "2023-02-29"},
        {"ListingKey": "x", "City": None, "ListPrice": "1.5", "Stories": 70000, "SpaYN": False, "CloseDate": "2024-01-01"},
    )
    assert [got[f.name].verdict for f in FIELDS] == ["too long", "other type", "other type", "other type", "sound", "other type", "missing"]
    key, city, price, spa = (got[n] for n in ("ListingKey", "City", "ListPrice", "SpaYN"))
    assert (key.sent, key.n_too_long, key.n_other_type, key.n_missing, key.n_null) == ("STRING", 1, 0, 0, 0)
    assert (city.sent, city.n_null, city.n_other_type, city.n_missing) == ("VARIANT", 1, 1, 0)
    assert price.n_other_type == 1 and got["Stories"].n_other_type == 1 and got["CloseDate"].n_other_type == 1
    assert spa.n_payloads == 3 and spa.sent == "VARIANT"
    absent = got["ModificationTimestamp"]
    assert (absent.sent, absent.n_missing, absent.expected) == ("VOID", 3, "timestamp")


def test_gaps_and_payloads_that_are_no_objects(spark):
    got = found(spark, {"City": "A"}, {"City": None}, {}, "[1, 2]", '{"City": "B', "")
    city = got["City"]
    assert city.n_payloads == 6 and city.n_null == 1 and city.verdict == "nullable"
    assert city.n_missing == 4 and got["SpaYN"].verdict == "missing"


def test_no_payloads_miss_every_column(spark):
    rows = payload_conformance(payloads(spark)).collect()
    assert {r.column_name for r in rows} == set(PROMOTED_NAMES)
    assert {(r.verdict, r.n_payloads, r.sent) for r in rows} == {("missing", 0, None)}


def test_a_stored_table_is_measured(spark):
    table = spark.createDataFrame(
        [("abcde", "Rom", 1, None, "2024"), ("abcdef", None, 2, None, None)],
        "listingkey string, City string, ListPrice int, SpaYN boolean, unrelated string",
    )
    got = {r.column_name: r for r in table_conformance(table, FIELDS).collect()}
    assert (got["ListingKey"].verdict, got["ListingKey"].longest) == ("too long", 6)
    assert (got["City"].verdict, got["City"].n_null) == ("nullable", 1)
    assert (got["ListPrice"].verdict, got["ListPrice"].actual) == ("other type", "int")
    assert (got["SpaYN"].verdict, got["SpaYN"].n_null) == ("nullable", 2)
    assert got["Stories"].verdict == "missing" and "unrelated" not in got
    empty = {r.column_name: r.verdict for r in table_conformance(table.limit(0), FIELDS).collect()}
    assert (empty["ListingKey"], empty["Stories"]) == ("sound", "missing")
