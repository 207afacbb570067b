"""JSON values to typed columns."""

import datetime as dt
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow.functions import coerce as co
from parcelflow.functions.text import has_text, iso_z
from parcelflow.schema import Field

UTC = dt.timezone.utc


def read(spark, values, field):
    """(typed, unusable) for each JSON literal."""
    rows = [(i, '{"x":%s}' % v) for i, v in enumerate(values)]
    value = F.col("in").getField("x")
    typed = co.coerce(F.col("kind"), F.col("text"), field)
    result = (
        spark.createDataFrame(rows, "i int, raw string")
        .select("i", co.read_fields(F.col("raw"), ["x"]).alias("in"))
        .select("*", co.json_kind(value).alias("kind"), co.json_text(value).alias("text"))
        .select("*", typed.alias("typed"))
        .select("i", "typed", co.unusable(value, F.col("typed")).alias("bad"))
    )
    return [(r.typed, r.bad) for r in sorted(result.collect())]


CASES = {
    Field("x", "string", 4): [
        ('"abcd"', "abcd", False),
        ('"abcde"', None, True),
        ("12", None, True),
        ("true", None, True),
        ("null", None, False),
        ("[1]", None, True),
        ('"a,b"', "a,b", False),
        ('""', "", False),
    ],
    Field("x", "boolean"): [
        ("true", True, False),
        ("false", False, False),
        ("1", True, False),
        ("0", False, False),
        ("1.0", True, False),
        ("2", None, True),
        ('"on"', True, False),
        ('"OFF"', False, False),
        ('"Yes"', True, False),
        ('"n"', False, False),
        ('" yes"', None, True),
        ("null", None, False),
    ],
    Field("x", "int"): [
        ("3", 3, False),
        ("3.0", 3, False),
        ("3.5", None, True),
        ('"3"', 3, False),
        ('"3.0"', 3, False),
        ('" 4 "', 4, False),
        ('"-5"', -5, False),
        ("true", 1, False),
        ('"true"', None, True),
        ("99999999999", None, True),
        ("{}", None, True),
    ],
    Field("x", "smallint"): [("32767", 32767, False), ("32768", None, True)],
    Field("x", "decimal(14,2)"): [
        ("1.239", Decimal("1.24"), False),
        ('"100000.00"', Decimal("100000.00"), False),
        ('"1e3"', Decimal("1000.00"), False),
        ("true", None, True),
        ('"NaN"', None, True),
        ('"9999999999999.99"', None, True),
        ('"-0.005"', Decimal("-0.01"), False),
    ],
    Field("x", "timestamp"): [
        ('"2024-01-01T05:00:00+05:30"', dt.datetime(2023, 12, 31, 23, 30), False),
        ('"2024-01-01T05:00:00"', dt.datetime(2024, 1, 1, 5), False),
        ('"2024-01-01 05:00:00.123456Z"', dt.datetime(2024, 1, 1, 5, 0, 0, 123456), False),
        ('"2024-01-01t05:00:00z"', dt.datetime(2024, 1, 1, 5), False),
        ("1700000000", dt.datetime(2023, 11, 14, 22, 13, 20), False),
        ("1700000000000", dt.datetime(2023, 11, 14, 22, 13, 20), False),
        ('"T10:00"', None, True),
        ('"soon"', None, True),
        ('"2024-02-30T00:00:00Z"', None, True),
    ],
    Field("x", "date"): [
        ('"2024-01-02"', dt.date(2024, 1, 2), False),
        ('"2024-01-02T00:00:00Z"', dt.date(2024, 1, 2), False),
        ('"2024-01-02T10:00:00"', None, True),
        ('"2024"', None, True),
    ],
}


@pytest.mark.parametrize("field", CASES, ids=lambda f: f.sql_type)
def test_coercion(spark, field):
    cases = CASES[field]
    assert read(spark, [c[0] for c in cases], field) == [(c[1], c[2]) for c in cases]


ZONES = ["UTC", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "Pacific/Apia"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1)),
            st.sampled_from(ZONES),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_instant_survives_any_zone(spark, stamps):
    aware = [ts.replace(tzinfo=ZoneInfo(zone)) for ts, zone in stamps]
    # Some historic offsets carry seconds, which ISO text cannot express.
    aware = [a for a in aware if a.utcoffset().total_seconds() % 60 == 0]
    rows = [(i, a.isoformat()) for i, a in enumerate(aware)]
    frame = spark.createDataFrame(rows, "i int, text string").select(
        "i", F.unix_micros(co.iso_to_utc(F.col("text"))).alias("us")
    )
    epoch = dt.datetime(1970, 1, 1, tzinfo=UTC)
    want = {i: (a - epoch) // dt.timedelta(microseconds=1) for i, a in enumerate(aware)}
    assert {r.i: r.us for r in frame.collect()} == want


def test_iso_z_parses_back_to_the_same_instant(spark):
    stamps = [0, 1, 1_500_000, 1_700_000_000_000_000, 1_700_000_000_123_456]
    frame = spark.createDataFrame([(s,) for s in stamps], "us bigint").select(
        "us", iso_z(F.timestamp_micros("us")).alias("text")
    )
    got = frame.select("us", "text", F.unix_micros(co.iso_to_utc(F.col("text"))).alias("again"))
    rows = got.collect()
    assert all(r.us == r.again for r in rows)
    assert {r.text for r in rows} >= {"1970-01-01T00:00:00Z", "1970-01-01T00:00:01.500000Z"}


def test_blank_text(spark):
    blank = ["", " ", "\t\n\r\x0b\x0c ", "\u00a0", "\u3000", "\x1c\x1f", None]
    filled = ["a", "  a ", "0", "\u200b"]
    frame = spark.createDataFrame([(t,) for t in blank + filled], "t string")
    got = [r[0] for r in frame.select(has_text(F.col("t"))).collect()]
    want = [bool(t and t.strip()) for t in blank + filled]
    assert got == want
