"""Key check, typing, payload and validation of records."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import transform as tr
from parcelflow.operators.export import line_of
from parcelflow.schema import EMPTY_PAGE, INVALID, NO_KEY, PROMOTED, PROMOTED_NAMES, STORED

# A value of each type as the feed sends it.
SAMPLE = {
    "string": "Va,lue",
    "boolean": True,
    "int": 20,
    "smallint": 3,
    "timestamp": "2024-03-14T17:32:00Z",
    "date": "2024-03-14",
}


def sample(field):
    if field.name == "StateOrProvince":
        return "WA"
    return SAMPLE.get(field.sql_type, "47.50")


FULL = {f.name: sample(f) for f in PROMOTED}


def frame(spark, records):
    rows = [
        (0, i, None if r is None else r if isinstance(r, str) else json.dumps(r, ensure_ascii=False))
        for i, r in enumerate(records)
    ]
    return spark.createDataFrame(rows, "page_no bigint, pos int, raw string")


def typed(spark, records):
    rows = tr.type_records(frame(spark, records)).orderBy("pos").collect()
    return [r.asDict() for r in rows]


BLANK = ["", " ", "\t", "\n", "\r", "\x0b\x0c", "\u00a0"]


def test_a_row_exists_if_and_only_if_the_key_is_not_blank(spark):
    records = [{"ListingKey": k} for k in BLANK] + [{}, {"ListingKey": None}]
    good = ["a", " a ", "0", "K" * 128]
    got = typed(spark, records + [{"ListingKey": k} for k in good])
    assert [r["outcome"] for r in got] == [NO_KEY] * len(records) + [STORED] * len(good)
    assert [r["ListingKey"] for r in got][-len(good) :] == good
    everything = frame(spark, records + [{"ListingKey": k} for k in good])
    assert tr.with_key(everything).count() == len(good)
    assert tr.without_key(everything).count() == len(records)


def test_key_of_the_wrong_type_or_length_is_invalid_not_skipped(spark):
    got = typed(spark, [{"ListingKey": 12}, {"ListingKey": "K" * 129}, {"ListingKey": []}])
    assert [r["outcome"] for r in got] == [INVALID] * 3
    assert all(r["bad_fields"] == ["ListingKey"] for r in got)


def test_what_is_not_an_object_is_invalid(spark):
    got = typed(spark, ["[1]", '"text"', None])
    assert [r["outcome"] for r in got] == [INVALID] * 3


def test_marker_of_an_empty_page(spark):
    marker = spark.createDataFrame([(4, None, None)], "page_no bigint, pos int, raw string")
    assert tr.type_records(marker).first()["outcome"] == EMPTY_PAGE


def test_any_field_but_the_key_may_be_absent(spark):
    without = [{k: v for k, v in FULL.items() if k != name} for name in PROMOTED_NAMES[1:]]
    got = typed(spark, [FULL, {"ListingKey": "k"}, *without])
    assert all(r["outcome"] == STORED for r in got)
    assert all(got[0][name] is not None for name in PROMOTED_NAMES)
    assert all(got[1][name] is None for name in PROMOTED_NAMES[1:])
    for name, row in zip(PROMOTED_NAMES[1:], got[2:]):
        assert row[name] is None
        assert all(row[other] == got[0][other] for other in PROMOTED_NAMES if other != name)


def test_typing_is_a_fixpoint(spark):
    first = tr.type_records(frame(spark, [FULL]))
    # Decimals travel as text, so that no digit is lost on the way.
    again = F.to_json(
        F.struct(
            *[
                F.col(f.name).cast("string" if "decimal" in f.sql_type else f.sql_type).alias(f.name)
                for f in PROMOTED
            ]
        )
    )
    second = tr.type_records(first.select("page_no", "pos", again.alias("raw")))
    assert second.select(*PROMOTED_NAMES).first() == first.select(*PROMOTED_NAMES).first()


def test_payload_is_json_equal_to_the_source(spark):
    record = {
        "ListingKey": "k",
        "List": [1, 2.5, None, {"deep": ["ü", "\"", "\\"]}],
        "Big": 2**53,
        "Amenities": "Pool,Clubhouse",
        "Flag": False,
        "Text": "naïve — 你好",
    }
    row = tr.type_records(frame(spark, [record])).first()
    assert json.loads(row["raw_data"]) == record


def test_unknown_fields_are_kept(spark):
    record = {"ListingKey": "k", "City": "X", "Odd": "keep", "Nested": {"a": 1}}
    got = frame(spark, [record]).select(tr.unknown_fields(F.col("raw"))).first()[0]
    assert got == {"Odd": "keep", "Nested": '{"a":1}'}
    value = frame(spark, [record]).select(tr.json_field(F.col("raw"), "Nested.a", "int"))
    assert value.first()[0] == 1


def test_skip_report_names_what_is_known(spark):
    records = [
        {"ListingId": "id", "MlsId": None, "City": "X"},
        {"ListingKey": " ", "MlsId": "m", "ListAgentKey": "a"},
        {"ListingKey": "good"},
    ]
    got = {r.pos: r.identifying for r in tr.skip_report(frame(spark, records)).collect()}
    assert got == {0: {"ListingId": "id"}, 1: {"MlsId": "m", "ListAgentKey": "a"}}


def test_strict_mode_stops_and_names_the_fields(spark):
    bad = {"ListingKey": "k7", "ListPrice": "dear", "YearBuilt": 99999}
    checked = tr.enforce(tr.type_records(frame(spark, [FULL, bad])))
    with pytest.raises(Exception, match="key=k7 fields=ListPrice,YearBuilt"):
        checked.collect()
    kept = tr.type_records(frame(spark, [FULL, bad]))
    assert tr.stored_rows(kept).count() == 1
    assert tr.rejected_rows(kept).first()["bad_fields"] == ["ListPrice", "YearBuilt"]


# Values of every JSON kind, for any field.
ODD = [None, True, 0, 1, 7.5, -3, 10**15, 1e300, "", " ", "yes", "12", "1.0", "x" * 200, "2024-03-14", "2024-03-14T17:32:00+02:00", [], [1], {}, {"a": None}]


def test_bad_fields_are_the_sent_ones_without_a_typed_value_in_schema_order(spark):
    rng = random.Random(7)
    records = [FULL, {"ListingKey": "k"}, {n: None for n in PROMOTED_NAMES}, {n: [] for n in PROMOTED_NAMES}]
    for _ in range(300):
        some = {n: rng.choice([*ODD, FULL[n]]) for n in PROMOTED_NAMES if rng.random() < rng.choice([0.1, 0.9])}
        records.append({"ListingKey": "k", **some} if rng.random() < 0.8 else some)
    got = typed(spark, [*records, "{cut", None])
    for sent, row in zip(records, got):
        bad = [n for n in PROMOTED_NAMES if sent.get(n) is not None and row[n] is None]
        assert row["bad_fields"] == bad
        key = sent.get("ListingKey")
        lacking = key is None or (isinstance(key, str) and not key.strip())
        assert row["outcome"] == (NO_KEY if lacking else INVALID if bad else STORED)
    assert sum(row["outcome"] == INVALID for row in got) > 100
    assert [row["bad_fields"] for row in got[-2:]] == [[], []]


def test_no_step_of_the_typing_runs_a_lambda_or_carries_the_parsed_fields_on(spark, capsys):
    # Few fields, so that the plan is shown whole.
    fields = [f for f in PROMOTED if f.name in ("ListingKey", "ListPrice", "CloseDate", "SpaYN", "Stories")]
    tr.type_records(frame(spark, [FULL]), fields).explain("extended")
    plan = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert "lambda" not in plan and "from_json" in plan
    # The top three projections read names and texts, not the parsed fields.
    assert all("_in#" not in line for line in plan.split("Project ")[1:4])


def test_bulk_file_line(spark):
    row = spark.sql(
        r"""SELECT 'a"b\\c' AS t, CAST(NULL AS string) AS n, true AS b,
        CAST(1.5 AS decimal(14,2)) AS d, timestamp'2024-01-02 03:04:05' AS whole,
        timestamp'2024-01-02 03:04:05.000007' AS part, date'2024-01-02' AS day, 'x,y' AS c"""
    )
    assert row.select(line_of(row)).first()[0] == (
        r'"a\"b\\c",\N,"1","1.50","2024-01-02 03:04:05","2024-01-02 03:04:05.000007",'
        r'"2024-01-02","x,y"'
    )
    assert row.withColumn("d", F.lit(Decimal("0E-7"))).select(line_of(row, ["n"])).first()[0] == "\\N"
