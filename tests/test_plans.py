"""What the physical plans must and must not do."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelflow.operators import transform as tr
from parcelflow.operators import upsert
from parcelflow.operators.layout import write_layout
from parcelflow.plans import feeds
from parcelflow.plans.store import ListingStore
from parcelflow.session import new_work_dir
from parcelflow.sources import pages as pg
from parcelflow.sources import scans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_and_filters_only_what_is_asked(spark):
    text = plan(entry.queries()["incremental_scan"](spark, SF_DIR))
    assert "GreaterThan(o_orderdate" in text
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "o_orderkey", "o_orderdate", "o_totalprice"
    }


def test_a_stored_watermark_reaches_the_scan(spark):
    text = plan(entry.queries()["incremental_from_ledger"](spark, SF_DIR))
    assert re.search(r"GreaterThan\(o_orderdate,ScalarSubquery", text)


def test_hot_keys_are_cut_before_the_shuffle(spark):
    batch = feeds.changed_rows(spark, SF_DIR)
    text = plan(upsert.latest_per_key(batch))
    partial = text.index("Partial")
    assert "WindowGroupLimit" in text and text.index("Exchange") < partial


def test_page_ledger_folds_by_hash(spark):
    text = plan(entry.queries()["batch_ledger"](spark, SF_DIR))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_stored_rows_do_not_parse_a_record_twice(spark):
    typed = tr.type_records(feeds.order_records(spark, SF_DIR), feeds.SLIM)
    text = tr.stored_rows(typed)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


@pytest.mark.parametrize("name", ["promoted_projection", "hot_view"])
def test_a_filter_on_the_outcome_stays_above_the_typing(spark, name):
    # All the promoted columns: with the parse copied into the filter this does not compile in minutes.
    text = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if re.match(r"\W*Filter ", line)]
    assert text.count("from_json") == 1
    assert any("outcome#" in line for line in filters)
    assert not any("from_json" in line or "try_variant_get" in line for line in filters)


def test_a_run_since_a_time_parses_a_record_once(spark):
    store = ListingStore(spark, new_work_dir(spark, "since")).create()
    pages = pg.pack_pages(feeds.event_records(spark, SF_DIR))
    rows = store.prepare(pages, datetime(2024, 6, 1), since=datetime(2024, 1, 15))
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if re.match(r"\W*Filter ", line)]
    assert any("outcome#" in line for line in filters)
    assert not any("from_json" in line or "try_variant_get" in line for line in filters)


def scanned_rows(df):
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan"):
            found.append(node.metrics().get("numOutputRows").get().value())
        children = node.children().iterator()
        while children.hasNext():
            walk(children.next())

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_layout_skips_rows_for_searches_and_time_bounds(spark):
    n = 400_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("ListingKey"),
        F.concat(F.lit("C"), (F.col("id") % 200).cast("string")).alias("City"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ModificationTimestamp"),
    )
    by_city, by_time = new_work_dir(spark, "city"), new_work_dir(spark, "time")
    write_layout(rows, by_city, ["City"])
    write_layout(rows, by_time, ["ModificationTimestamp"])
    city = spark.read.parquet(by_city).where("City = 'C7'")
    assert city.count() == n // 200
    assert scanned_rows(city) < n / 4
    newest = spark.createDataFrame([(1_700_000_000 + n - 100,)], "s bigint").select(
        F.timestamp_seconds("s").alias("max_ts")
    )
    recent = scans.newer_than(spark.read.parquet(by_time), scans.stored_watermark(newest))
    assert recent.count() == 99
    assert scanned_rows(recent) < n / 4


def test_compacted_payloads_are_not_shuffled(spark):
    store = ListingStore(spark, new_work_dir(spark, "bucketed")).create()
    records = feeds.customer_records(spark, SF_DIR)
    store.ingest(pg.pack_pages(records), run_key="first")
    assert store.compact(n_buckets=4) == 0
    store.ingest(pg.pack_pages(records.where("pos % 10 = 0")), run_key="second")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        payloads = store.property_raw()
        kept = plan(payloads).split("LeftAnti")[1].split("Sort [ListingKey")[1]
        assert "Bucketed: true" in kept and "Exchange" not in kept.split("FileScan")[0]
        assert payloads.count() == records.count()
        newest = payloads.groupBy("loaded_at").count().orderBy("loaded_at").collect()
        assert newest[1]["count"] == records.where("pos % 10 = 0").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
