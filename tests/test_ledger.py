"""Watermarks, running totals, states and the resume plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import audit, ledger
from parcelflow.sources import scans

DAY = dt.datetime(2024, 1, 1)
DDL = "run_no int, page_no bigint, n_rows bigint, max_ts timestamp_ntz, next_link string, committed_at timestamp"


def pages(spark, n, runs=1, seed=0):
    """Pages with times in any order, some of them missing."""
    rng = random.Random(seed)
    rows = []
    for run in range(runs):
        for page in range(n):
            newest = None if rng.random() < 0.2 else DAY + dt.timedelta(hours=rng.randrange(5000))
            link = f"p/{page + 1}" if page < n - 1 else None
            rows.append((run, page, rng.randrange(50), newest, link, DAY + dt.timedelta(seconds=page + 1)))
    return rows, spark.createDataFrame(rows, DDL)


def test_watermark_is_the_maximum_whatever_the_order(spark):
    rows, df = pages(spark, 40)
    want = max(r[3] for r in rows if r[3])
    assert ledger.watermark(df).first()[0] == want
    older = spark.createDataFrame([(DAY - dt.timedelta(days=9),)], "watermark timestamp_ntz")
    newer = spark.createDataFrame([(DAY + dt.timedelta(days=9999),)], "watermark timestamp_ntz")
    none = spark.createDataFrame([(None,)], "watermark timestamp_ntz")
    assert ledger.watermark(df, older).first()[0] == want
    assert ledger.watermark(df, none).first()[0] == want
    assert ledger.watermark(df, newer).first()[0] == DAY + dt.timedelta(days=9999)
    empty = df.where("false")
    assert ledger.watermark(empty, older).first()[0] == DAY - dt.timedelta(days=9)
    assert ledger.watermark(empty).first()[0] is None


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_running_totals_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ledger, "_BLOCK", block)
    rows, df = pages(spark, 50, runs=2, seed=3)
    got = {(r.run_no, r.page_no): r for r in ledger.running_progress(df).collect()}
    assert len(got) == len(rows)
    for run in (0, 1):
        total, newest = 0, None
        for i, row in enumerate(r for r in rows if r[0] == run):
            total += row[2]
            newest = max((t for t in (newest, row[3]) if t), default=None)
            seen = got[run, row[1]]
            assert (seen.batch_no, seen.cumulative_rows, seen.running_max_ts) == (i + 1, total, newest)


def test_one_progress_record_per_page_with_its_rate(spark):
    rows, df = pages(spark, 5)
    got = ledger.progress(df, F.lit(DAY)).orderBy("page_no").collect()
    assert [r.batch_no for r in got] == [1, 2, 3, 4, 5]
    assert all(r.requests_per_minute == pytest.approx(60.0) for r in got)


def test_state_follows_the_link(spark):
    _, df = pages(spark, 6)
    for row in ledger.state_after(df).collect():
        assert row.in_progress == (row.next_link is not None) == (row.link_saved_at is not None)
        assert row.in_progress == (row.page_no < 5)


NOW = dt.datetime(2024, 6, 1, 12)


@pytest.mark.parametrize(
    "running, age, marked, want",
    [
        (True, 0, True, "resume"),
        (True, 239.999999, False, "resume"),
        (True, 240, True, "pivot"),
        (True, 240, False, "error"),
        (True, 600, True, "pivot"),
        (True, None, True, "pivot"),
        (False, 0, True, "fresh"),
        (None, None, False, "fresh"),
    ],
)
def test_resume_plan(spark, running, age, marked, want):
    saved = None if age is None else NOW - dt.timedelta(seconds=age)
    state = spark.createDataFrame(
        [(running, saved, DAY if marked else None, "full")],
        "in_progress boolean, link_saved_at timestamp, watermark timestamp, mode string",
    )
    assert ledger.resume_decision(state, NOW).first().decision == want
    other = ledger.resume_decision(state, NOW, mode="incremental").first().decision
    assert other == "fresh"


def test_since_beats_the_stored_watermark(spark):
    _, df = pages(spark, 5)
    data = spark.sql("SELECT timestamp_ntz'2024-01-01' + make_dt_interval(id) AS t FROM range(300)")
    start = dt.datetime(2024, 1, 3)
    given = scans.newer_than(data, scans.since_bound(start, df), "t")
    assert given.agg(F.min("t")).first()[0] == dt.datetime(2024, 1, 4)
    again = scans.newer_than(data, start, "t", inclusive=True)
    assert again.agg(F.min("t")).first()[0] == start
    stored = scans.newer_than(data, scans.since_bound(None, df), "t")
    mark = ledger.watermark(df).first()[0]
    assert stored.count() == data.where(F.col("t") > F.lit(mark).cast("timestamp_ntz")).count()
    late = scans.late_rows(data, scans.stored_watermark(df), "t")
    assert late.count() + stored.count() == 300


def test_no_watermark_is_an_error(spark):
    _, df = pages(spark, 3)
    data = spark.createDataFrame([(DAY,)], "t timestamp_ntz")
    with pytest.raises(Exception, match="no watermark yet"):
        scans.newer_than(data, scans.stored_watermark(df.where("false")), "t").collect()


def test_audits(spark):
    hot = spark.createDataFrame(
        [("a", DAY, "A"), ("b", None, "a"), ("c", NOW, None)],
        "ListingKey string, ModificationTimestamp timestamp_ntz, MlsStatus string",
    )
    raw = spark.createDataFrame([("a", "{}"), ("z", "{}")], "ListingKey string, raw_data string")
    row = audit.load_audit(hot, raw).first()
    assert (row.n_rows, row.n_raw_rows, row.n_orphans, row.n_statuses) == (3, 2, 2, 2)
    assert (row.min_ts, row.max_ts) == (DAY, NOW)
    assert audit.load_audit(hot, raw, collation="UNICODE_CI").first().n_statuses == 1
    assert sorted(r[0] for r in audit.orphans(hot, raw).collect()) == ["b", "c"]
    joined = {r.ListingKey: r.raw_data for r in audit.hot_raw_join(hot, raw).collect()}
    assert joined == {"a": "{}", "b": None, "c": None}
    agrees = audit.watermark_check(hot, F.lit(NOW).cast("timestamp_ntz")).first()
    assert agrees.agrees and agrees.max_ts == NOW
    assert not audit.watermark_check(hot, F.lit(DAY).cast("timestamp_ntz")).first().agrees
    lost = audit.lost_rows(hot, raw, F.lit(NOW).cast("timestamp_ntz"))
    assert [r.ListingKey for r in lost.collect()] == ["c"]
    assert audit.missing_from_schema(["ListingKey", "City"], hot) == ["City"]
    payloads = spark.createDataFrame([('{"City":1,"X":2}',), ('{"ListingKey":1}',)], "raw string")
    missing = audit.missing_columns(["ListingKey", "City", "Stories"], payloads)
    assert [r[0] for r in missing.collect()] == ["Stories"]
