"""One query per operator, each over the whole of a given table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import coerce as co
from parcelflow.functions.text import iso_z
from parcelflow.operators import audit, conformance, export, layout, ledger, paging, upsert
from parcelflow.operators import transform as tr
from parcelflow.plans import feeds
from parcelflow.plans.store import ListingStore
from parcelflow.schema import PROMOTED_NAMES, Field
from parcelflow.session import configure, new_work_dir
from parcelflow.sources import pages as pg
from parcelflow.sources import scans
from parcelflow.streaming import feed_states, progress, sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed times stand for "now" so that results do not depend on the clock.
NOW = datetime(2024, 6, 1, 12, 0, 0)
LOADED_AT = datetime(2024, 6, 1, 11, 59, 0)
STARTED_AT = datetime(2024, 6, 1, 11, 0, 0)


def query(function: Query) -> Query:
    """Register a query; its instants are shown as UTC wall-clock times."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = function(configure(spark), sf_dir)
        naive = [
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in result.dtypes
        ]
        return result.select(*naive)

    QUERIES[function.__name__] = run
    return run


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.type_records(feeds.order_records(spark, sf_dir), feeds.SLIM)


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of its own, so that several readers do not compute it again."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored page ledger of the slim feed; a page is committed every two seconds."""
    return _written(_ledger_of(_typed(spark, sf_dir)), "ledger")


def _ledger_of(typed: DataFrame) -> DataFrame:
    return ledger.page_ledger(typed, ["page_no"]).withColumn(
        "committed_at",
        F.timestamp_add("SECOND", (F.col("page_no") + 1) * 2, F.lit(STARTED_AT)),
    )


def _order_ledger(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.expr("o_orderkey div 1000").alias("page_no")).agg(
        F.count("*").alias("n_rows"), F.max("o_orderdate").alias("max_ts")
    )


# ---- pages and scans ----------------------------------------------------


@query
def page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = pg.open_pages(pg.pack_pages(feeds.order_records(spark, sf_dir)))
    fields = F.from_json("raw", "ListingId string, ListAgentKey string")
    return records.select("page_no", "next_link", "pos", fields.alias("f")).select(
        "page_no", "next_link", "pos", "f.ListingId", "f.ListAgentKey"
    )


@query
def page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The chain ends on the page before the last; the last is a leftover.
    records = feeds.order_records(spark, sf_dir)
    last = records.agg(F.max("page_no")).scalar()
    records = records.withColumn(
        "next_link", F.when(F.col("page_no") != last - 1, F.col("next_link"))
    )
    return pg.follow_chain(records, records.select("page_no", "next_link")).select(
        "page_no", "next_link", "pos"
    )


@query
def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.full_scan(feeds.table(spark, sf_dir, "orders"), "o_orderdate")


@query
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    return scans.newer_than(orders, datetime(1998, 6, 1), "o_orderdate").select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


def _stored_ledger(orders: DataFrame) -> DataFrame:
    """What an earlier run had committed: everything before mid-1999."""
    return _order_ledger(orders.where("o_orderdate < timestamp_ntz'1999-07-01'"))


@query
def since_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    stored = _stored_ledger(orders)
    scanned = [
        scans.newer_than(orders, scans.since_bound(start, stored), "o_orderdate").select(
            F.lit(label).alias("bound"), "o_orderkey", "o_orderdate"
        )
        for label, start in (("given", datetime(2000, 3, 1)), ("stored", None))
    ]
    return scanned[0].unionByName(scanned[1])


@query
def incremental_from_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    bound = scans.stored_watermark(_stored_ledger(orders))
    return scans.newer_than(orders, bound, "o_orderdate").select("o_orderkey", "o_orderdate")


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    return scans.late_rows(orders, datetime(1996, 2, 29), "o_orderdate").select(
        "o_orderkey", "o_orderdate"
    )


@query
def resume_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    last = orders.agg(F.expr("max(o_orderkey) div 1000")).scalar()
    committed = _order_ledger(orders).where(F.col("page_no") * 5 < last * 2)
    waiting = pg.pages_after(pg.pack_pages(feeds.order_records(spark, sf_dir)), committed)
    return pg.open_pages(waiting).select("page_no", "next_link", "pos")


@query
def paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return paging.paginate(orders, ["o_orderdate", "o_orderkey"], 1000)


# ---- records ------------------------------------------------------------


@query
def key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feeds.order_records(spark, sf_dir).where(F.col("pos").isNotNull())
    return tr.with_key(records).select(
        "page_no", "pos", tr.json_field(F.col("raw"), "ListingKey").alias("listing_key")
    )


@query
def skip_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feeds.order_records(spark, sf_dir).where(F.col("pos").isNotNull())
    known = F.col("identifying")
    return tr.skip_report(records).select(
        "page_no",
        "pos",
        F.size(known).alias("n_known"),
        known["ListingId"].alias("listing_id"),
        known["ListAgentKey"].alias("agent_key"),
    )


@query
def promoted_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.stored_rows(tr.type_records(feeds.full_records(spark, sf_dir))).select(
        *PROMOTED_NAMES
    )


@query
def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    words = ["yes", "off", "T", "0", "true", "n"]
    word = F.element_at(F.array(*[F.lit(w) for w in words]), (k % 6 + 1).cast("int"))
    record = F.struct(
        k.cast("string").alias("ListingKey"),
        F.concat((k % 1000).cast("string"), F.lit("."), F.lpad((k % 1000).cast("string"), 3, "0"))
        .alias("ListPrice"),
        F.concat((k % 300).cast("string"), F.when(k % 3 == 0, ".0").otherwise("")).alias("Stories"),
        word.alias("SpaYN"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("CloseDate"),
        F.when(k % 11 == 0, "3.5").otherwise((k % 40).cast("string")).alias("PhotosCount"),
    )
    fields = [
        Field("ListPrice", "decimal(14,2)"),
        Field("Stories", "smallint"),
        Field("SpaYN", "boolean"),
        Field("CloseDate", "date"),
        Field("PhotosCount", "int"),
    ]
    sent = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", co.read_fields(F.to_json(record), [f.name for f in fields]).alias("in")
    )

    def typed(field: Field) -> Column:
        value = F.col("in").getField(field.name)
        return co.coerce(co.json_kind(value), co.json_text(value), field).alias(field.name)

    return sent.select("o_orderkey", *[typed(f) for f in fields])


@query
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.stored_rows(_typed(spark, sf_dir)).select(
        "ListingKey",
        "ListingId",
        "InternetAddressDisplayYN",
        "ModificationTimestamp",
        "CloseDate",
        "PhotosCount",
    )


@query
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.rejected_rows(_typed(spark, sf_dir)).select(
        "page_no", "pos", "ListingKey", F.concat_ws(",", "bad_fields").alias("bad_fields")
    )


@query
def raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = pg.open_pages(pg.pack_pages(feeds.event_records(spark, sf_dir)))
    typed = tr.type_records(records, feeds.SLIM)
    kept = F.from_json(
        "raw_data", "ListingKey string, UserId bigint, MlsStatus string, Props struct<k int>"
    )
    return typed.select(kept.alias("kept")).select(
        F.col("kept.ListingKey").alias("listing_key"),
        F.col("kept.UserId").alias("user_id"),
        F.col("kept.MlsStatus").alias("event_type"),
        F.col("kept.Props.k").alias("k"),
    )


@query
def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = F.col("unknown")
    return (
        feeds.event_records(spark, sf_dir)
        .select(
            tr.json_field(F.col("raw"), "ListingKey").alias("listing_key"),
            tr.unknown_fields(F.col("raw")).alias("unknown"),
        )
        .select(
            "listing_key",
            F.concat_ws(",", F.sort_array(F.map_keys(unknown))).alias("names"),
            unknown["UserId"].cast("bigint").alias("user_id"),
            F.get_json_object(unknown["Props"], "$.k").cast("int").alias("k"),
        )
    )


@query
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw")
    return feeds.event_records(spark, sf_dir).select(
        tr.json_field(raw, "ListingKey").alias("listing_key"),
        tr.json_field(raw, "Props.k", "int").alias("k"),
        tr.json_field(raw, "UserId", "bigint").alias("user_id"),
        tr.json_field(raw, "NoSuchField").alias("absent"),
    )


@query
def utc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    text = F.when(e % 9 == 4, "soon").otherwise(feeds.iso_text(F.col("ts"), e % 4))
    return (
        feeds.table(spark, sf_dir, "events")
        .select("event_id", text.alias("text"))
        .select("event_id", co.iso_to_utc(F.col("text")).alias("ts"))
        .withColumn("rejected", F.col("ts").isNull())
    )


@query
def iso_z_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    ts = F.when(e % 4 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts").cast("timestamp"))
    return feeds.table(spark, sf_dir, "events").select("event_id", iso_z(ts).alias("iso"))


# ---- hot and raw halves -------------------------------------------------


def _both_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _written(tr.stamp(tr.stored_rows(_typed(spark, sf_dir)), F.lit(LOADED_AT)), "halves")
    hot = rows.select(*[f.name for f in feeds.SLIM], "loaded_at")
    return hot, tr.raw_half(rows)


def _halves_with_gaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both halves, with every thirteenth payload missing."""
    hot, raw = _both_halves(spark, sf_dir)
    return hot, raw.where(F.trim("ListingKey").cast("bigint") % 13 != 0)


@query
def hot_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = tr.type_records(feeds.full_records(spark, sf_dir))
    return tr.hot_half(tr.stamp(tr.stored_rows(typed), F.lit(LOADED_AT)))


@query
def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raw = _both_halves(spark, sf_dir)
    kept = F.from_json("raw_data", "SourceSystem string, Media struct<n int>")
    return raw.select("ListingKey", "loaded_at", kept.alias("kept")).select(
        "ListingKey",
        "loaded_at",
        F.col("kept.SourceSystem").alias("source"),
        F.col("kept.Media.n").alias("n_media"),
    )


@query
def batch_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot, raw = _both_halves(spark, sf_dir)
    stamps = raw.select("ListingKey", F.col("loaded_at").alias("raw_loaded_at"))
    return hot.select("ListingKey", "loaded_at").join(stamps, "ListingKey", "left")


@query
def hot_raw_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        audit.hot_raw_join(*_halves_with_gaps(spark, sf_dir))
        .select(
            "ListingKey",
            "MlsStatus",
            F.get_json_object("raw_data", "$.SourceSystem").alias("source"),
        )
        .orderBy("ListingKey")
    )


@query
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot, partial = _halves_with_gaps(spark, sf_dir)
    return audit.orphans(hot, partial).select("ListingKey", "MlsStatus")


# ---- upsert -------------------------------------------------------------

_ROW = ("ListingKey", "MlsStatus", "ListPrice", "ModificationTimestamp")


@query
def upsert_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = feeds.order_rows(spark, sf_dir), feeds.changed_rows(spark, sf_dir)
    return upsert.apply_batch(base, batch).select(*_ROW)


@query
def upsert_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = feeds.order_rows(spark, sf_dir), feeds.changed_rows(spark, sf_dir)
    return upsert.classify_batch(base, batch).select("ListingKey", "action", "ListPrice")


@query
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = feeds.order_rows(spark, sf_dir), feeds.changed_rows(spark, sf_dir)
    stamped = base.withColumn("loaded_at", F.lit(STARTED_AT))
    once = upsert.apply_batch(stamped, batch.withColumn("loaded_at", F.lit(LOADED_AT)))
    twice = upsert.apply_batch(once, batch.withColumn("loaded_at", F.lit(NOW)))
    return once.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        upsert.digested_difference(once, twice).agg(F.count("*")).scalar().alias("n_differences"),
    )


@query
def bulk_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs through the store, with a failed batch in between."""
    store = ListingStore(spark, new_work_dir(spark, "bulk-replace")).create()
    records = feeds.event_records(spark, sf_dir)
    packed = pg.pack_pages(records)
    store.ingest(packed, run_key="first")
    # A batch that wrote its rows but never its commit: it must stay unseen,
    # and the next batch takes its place.
    store.prepare(packed, LOADED_AT).write.parquet(store.path("change_log/batch_id=1"))
    changed = records.where(F.col("pos") % 3 == 0).withColumn(
        "raw", F.regexp_replace("raw", '"ListPrice":"[^"]*"', '"ListPrice":"1.50"')
    )
    store.ingest(pg.pack_pages(changed), run_key="second")
    return store.property(_ROW)


@query
def committed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = feeds.order_rows(spark, sf_dir).withColumn("batch_id", F.col("page_no"))
    commits = log.groupBy("batch_id").agg(F.count("*").alias("n_rows"))
    succeeded = commits.where(F.col("batch_id") % 4 != 3)
    return ledger.committed_rows(log, succeeded).select("batch_id", "ListingKey", "ListPrice")


# ---- ledger -------------------------------------------------------------


@query
def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger_of(_typed(spark, sf_dir)).drop("committed_at", "n_copies")


@query
def progress_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.progress(_ledger(spark, sf_dir), F.lit(STARTED_AT), by=[]).select(
        "page_no",
        "batch_no",
        "n_rows",
        "cumulative_rows",
        "running_max_ts",
        F.round("elapsed_seconds", 3).alias("elapsed_seconds"),
        F.round("requests_per_minute", 2).alias("requests_per_minute"),
    )


@query
def state_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.state_after(_ledger(spark, sf_dir), by=[])


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _ledger_of(_typed(spark, sf_dir)).withColumn("run_no", (F.col("page_no") % 3).cast("int"))
    return ledger.run_summary(runs, F.lit(STARTED_AT))


@query
def run_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    feed = (F.col("o_custkey") % 25).alias("feed")
    pages = orders.groupBy(feed, F.expr("o_orderkey div 1000").alias("page_no")).agg(
        F.max(F.when(F.col("o_custkey") % 25 != 9, F.col("o_orderdate"))).alias("max_ts")
    )
    # Earlier state: ahead of the data for feed 7, missing for every fifth feed.
    prior = orders.groupBy(feed).agg(
        F.max(
            F.when(F.col("o_custkey") % 25 == 7, F.expr("timestamp_ntz'2005-01-01'"))
            .when(F.col("o_custkey") % 5 == 0, None)
            .otherwise(F.expr("timestamp_ntz'1996-01-01'"))
        ).alias("watermark")
    )
    return ledger.watermark(pages, prior, by=["feed"])


@query
def oversized_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = (
        feeds.table(spark, sf_dir, "orders")
        .groupBy(F.expr("o_custkey div 100").alias("page_no"))
        .agg(F.count("*").alias("n_rows"))
    )
    return paging.oversized(sizes, 1000)


@query
def resume_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    saves = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("feed"),
        k.alias("batch_id"),
        F.when(k % 2 == 0, "full").otherwise("incremental").alias("mode"),
        (k % 7 != 0).alias("in_progress"),
        F.when(k % 7 != 0, F.timestamp_add("SECOND", -(k % 481), F.lit(NOW))).alias(
            "link_saved_at"
        ),
        F.when(k % 5 != 0, F.col("o_orderdate")).alias("watermark"),
    )
    latest = ledger.last_state(saves, "feed", ["batch_id"])
    any_mode = ledger.resume_decision(latest, NOW).withColumnRenamed("decision", "any_mode")
    return ledger.resume_decision(any_mode, NOW, mode="full").select(
        "feed", "batch_id", "any_mode", F.col("decision").alias("same_mode")
    )


# ---- audits -------------------------------------------------------------


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.load_audit(*_halves_with_gaps(spark, sf_dir))


@query
def watermark_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _written(_typed(spark, sf_dir), "watermark-check")
    return audit.watermark_check(tr.stored_rows(log), ledger.watermark(_ledger_of(log)).scalar())


@query
def crash_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a crash would lose: they share the watermark across a page break."""
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    observed = paging.paginate(orders, ["o_orderdate", "o_orderkey"], 1000)
    last = observed.agg(F.max("page_no")).scalar()
    stored = observed.where(F.col("page_no") * 2 < last)
    mark = stored.agg(F.max("o_orderdate")).scalar()
    return audit.lost_rows(observed, stored, mark, "o_orderkey", "o_orderdate")


@query
def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = feeds.order_records(spark, sf_dir).where(F.col("raw").isNotNull())
    return audit.missing_columns(PROMOTED_NAMES, payloads)


@query
def indexed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "indexed-lookup")
    rows = feeds.order_rows(spark, sf_dir)
    layout.write_layout(rows, path, ["MlsStatus", "ListPrice"])
    return spark.read.parquet(path).where(
        (F.col("MlsStatus") == "F") & F.col("ListPrice").between(100_000, 150_000)
    ).select(*_ROW)


@query
def table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ListingStore(spark, new_work_dir(spark, "table-catalog")).create(recreate=True)
    store.ingest(pg.pack_pages(feeds.customer_records(spark, sf_dir)), run_key="catalog")
    tables = {"property": store.property(), "property_raw": store.property_raw()}
    described = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(len(audit.missing_from_schema(PROMOTED_NAMES, df))).alias("n_missing"),
            F.count("*").alias("n_rows"),
        )
        for name, df in tables.items()
    ]
    return described[0].unionByName(described[1])


# ---- export, dry run, stream --------------------------------------------


@query
def csv_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    rows = feeds.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(c % 5 == 0, F.concat("c_name", F.lit(', "x\\y"'))).otherwise(F.col("c_name"))
        .alias("name"),
        F.when(c % 7 != 0, F.col("c_mktsegment")).alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        (c % 2 == 0).alias("flag"),
        F.timestamp_add("MICROSECOND", c * 1_000_000 + (c % 2) * 1_500, F.lit(STARTED_AT)).alias(
            "seen"
        ),
        F.date_add(F.lit(STARTED_AT.date()), (c % 365).cast("int")).alias("day"),
    )
    columns = ["c_custkey", "name", "segment", "balance", "flag", "seen", "day"]
    return rows.select("c_custkey", export.line_of(rows, columns).alias("line"))


@query
def dry_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed, rows = sync.observe_rows(_typed(spark, sf_dir))
    rows.write.format("noop").mode("overwrite").save()
    seen = observed.get
    return spark.createDataFrame(
        [(seen["n_rows"], seen["n_skipped"], seen["max_ts"])],
        "n_rows bigint, n_skipped bigint, max_ts timestamp",
    )


@query
def recreate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recreated store takes a run of the same name from its start."""
    root = new_work_dir(spark, "recreate-reload")
    pg.land_pages(pg.pack_pages(feeds.event_records(spark, sf_dir)), f"{root}/landing")
    store = ListingStore(spark, f"{root}/store")
    for _ in range(2):
        store.create(recreate=True)
        sync.full_sync(store, f"{root}/landing", "again")
    return store.property(_ROW)


@query
def continued_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stops, another one, a compaction, then the rest of the first.

    What arrives last wins: the second run over the first half, and the rest
    of the first run over the second.
    """
    store = ListingStore(spark, new_work_dir(spark, "continued-run")).create()
    records = feeds.event_records(spark, sf_dir)
    packed = pg.pack_pages(records)
    store.ingest(packed.where("page_no % 2 = 0"), run_key="first", epoch=0)
    changed = records.where("pos % 3 = 0").withColumn(
        "raw", F.regexp_replace("raw", '"ListPrice":"[^"]*"', '"ListPrice":"1.50"')
    )
    store.ingest(pg.pack_pages(changed), run_key="second")
    store.compact()
    store.ingest(packed.where("page_no % 2 = 1"), run_key="first", epoch=1)
    return store.property(_ROW)


@query
def chain_end_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load stops at the first page without a link; the last page is a leftover."""
    store = ListingStore(spark, new_work_dir(spark, "chain-end")).create()
    records = feeds.event_records(spark, sf_dir)
    last = records.agg(F.max("page_no")).scalar()
    cut = records.withColumn("next_link", F.when(F.col("page_no") != last - 1, F.col("next_link")))
    store.ingest(pg.pack_pages(cut), run_key="cut")
    return store.property(_ROW)


@query
def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_work_dir(spark, "stream-pages")
    pg.land_pages(pg.pack_pages(feeds.event_records(spark, sf_dir)), f"{root}/landing")
    store = ListingStore(spark, f"{root}/store")
    sync.full_sync(store, f"{root}/landing", "stream", pages_per_batch=64)
    return store.property(_ROW)


def _event_pages(events: DataFrame, key: Column, status: str, ts: Column) -> DataFrame:
    """Pages of events with a given key, status and time."""
    page = F.expr(f"event_id div {feeds.PAGE_SIZE}")
    last = events.agg(F.expr(f"max(event_id) div {feeds.PAGE_SIZE}")).scalar()
    record = F.struct(
        key.alias("ListingKey"),
        F.lit(status).alias("MlsStatus"),
        feeds.iso_text(ts, F.lit(0)).alias("ModificationTimestamp"),
    )
    return pg.pack_pages(
        events.select(
            page.alias("page_no"),
            F.when(page < last, F.concat(F.lit("page/"), (page + 1).cast("string"))).alias("next_link"),
            (F.col("event_id") % feeds.PAGE_SIZE).cast("int").alias("pos"),
            F.to_json(record).alias("raw"),
        )
    )


@query
def planned_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncs that follow their plan; totals by run, from the commits and the progress record.

    Run a is stopped and, as long as pages are missing, resumed in place of b.
    Run c ends on an open link that grows stale, so d pivots: of its rows half
    are newer than the watermark. Run e reads those at the watermark again.
    """
    root = new_work_dir(spark, "planned-sync")
    events = feeds.table(spark, sf_dir, "events")
    key = F.col("event_id").cast("string")
    newest = events.agg(F.max("ts")).scalar()
    moved = F.when(F.col("event_id") % 2 == 0, feeds.later(newest, F.lit(60))).otherwise(newest)
    pages = _event_pages(events, key, "as first sent", F.col("ts"))
    pg.land_pages(pages, f"{root}/first")
    pg.land_pages(pages.where(F.col("body").contains("@odata.nextLink")), f"{root}/open")
    third = events.where("event_id % 3 = 0")
    pg.land_pages(_event_pages(third, key, "moved", moved), f"{root}/later")

    store = ListingStore(spark, f"{root}/store")
    sync.planned_sync(store, f"{root}/first", "a", pages_per_batch=1, should_stop=lambda: True)
    sync.planned_sync(store, f"{root}/first", "b")
    sync.planned_sync(store, f"{root}/open", "c")
    # The only page of a small feed has no link: then c is empty and d is fresh.
    sync.planned_sync(store, f"{root}/later", "d", now=datetime(2124, 1, 1))
    sync.incremental(store, f"{root}/later", "e", inclusive=True)
    runs = store.commits().groupBy("run_key", "mode").agg(
        F.sum("n_pages").alias("n_pages"), F.sum("n_rows").alias("n_rows")
    )
    steps = store.progress().groupBy("run_key").agg(
        F.max("batch_no").alias("last_batch_no"), F.max("cumulative_rows").alias("cumulative_rows")
    )
    n_moved = store.property(["MlsStatus"]).agg(F.count_if(F.col("MlsStatus") == "moved")).scalar()
    return runs.join(steps, "run_key").withColumn("n_moved", n_moved)


@query
def store_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys without regard to case, the newest time wins, over a compaction; both halves alike.

    The second run spells every third key in lower case; half of its rows are
    a day older than what is stored and lose.
    """
    store = ListingStore(
        spark, new_work_dir(spark, "store-options"), collation="UNICODE_CI_AI_RTRIM", newest_wins=True
    ).create()
    events = feeds.table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    shift = F.when(F.col("event_id") % 2 == 0, 86_400).otherwise(-86_400)
    store.ingest(_event_pages(events, F.concat(F.lit("K"), number), "first", F.col("ts")), run_key="first")
    store.compact()
    again = events.where("event_id % 3 = 0")
    ts = feeds.later(F.col("ts"), shift)
    store.ingest(_event_pages(again, F.concat(F.lit("k"), number), "second", ts), run_key="second")
    key = F.lower("ListingKey").alias("key")
    status = F.get_json_object("raw_data", "$.MlsStatus").alias("raw_status")
    hot = store.property(["ListingKey", "MlsStatus"]).select("*", key)
    return hot.join(store.property_raw().select(key, status), "key", "full")


# ---- conformance, layouts, pages by number, folders by time --------------------------


@query
def typed_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformance.payload_conformance(feeds.mixed_records(spark, sf_dir)).drop("expected")


@query
def table_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.trim("ListingKey").cast("bigint")
    rows = feeds.order_rows(spark, sf_dir).select(
        "ListingKey",
        "MlsStatus",
        "ListPrice",
        F.when(k % 9 != 4, F.col("ModificationTimestamp")).alias("modificationtimestamp"),
        F.repeat(F.lit("x"), (k % 5).cast("int")).alias("StateOrProvince"),
        (k % 30).alias("Stories"),
    )
    return conformance.table_conformance(rows).drop("expected")


@query
def multi_column_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches on the second and on the third column of one layout."""
    path = new_work_dir(spark, "multi-column-lookup")
    searched = ["MlsStatus", "ListPrice", "ModificationTimestamp"]
    layout.write_curve_layout(feeds.order_rows(spark, sf_dir), path, searched)
    rows = spark.read.parquet(path)
    by_price = rows.where(F.col("ListPrice").between(100_000, 120_000))
    by_time = rows.where(F.col("ModificationTimestamp") >= datetime(2000, 6, 1))
    return by_price.select(F.lit("price").alias("search"), *_ROW).unionByName(by_time.select(F.lit("time").alias("search"), *_ROW))


@query
def page_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of all orders, found through the index of first rows."""
    path, order = new_work_dir(spark, "page-by-number"), ["o_orderdate", "o_orderkey"]
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    paging.write_pages(orders, order, 1000, path)
    return paging.read_page(spark, path, 1, order, 1000)


@query
def incremental_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "incremental-by-folder")
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    scans.write_by_time(orders, path, "o_orderkey", "o_orderdate", unit="month")
    bound = scans.stored_watermark(_stored_ledger(orders))
    return scans.newer_in_folders(spark.read.parquet(path), bound, "o_orderdate", unit="month")


@query
def sketched_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit from one row per page, with the exact number of keys beside it."""
    typed = _written(_typed(spark, sf_dir), "sketched-audit")
    found = audit.sketched_audit(_written(audit.batch_sketches(typed), "sketches"))
    exact = tr.stored_rows(typed).agg(F.countDistinct("ListingKey")).scalar()
    return found.withColumn("n_keys_exact", exact).select(
        "n_batches",
        "n_rows",
        "min_ts",
        "max_ts",
        "n_statuses",
        "n_keys_exact",
        (F.abs(F.col("n_keys") - F.col("n_keys_exact")) <= 0.05 * F.col("n_keys_exact")).alias("keys_within"),
    )


@query
def differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch changed, found through digests of the states before and after it."""
    base, batch = feeds.order_rows(spark, sf_dir), feeds.changed_rows(spark, sf_dir).where("pos < 10")
    return upsert.digested_difference(base, upsert.apply_batch(base, batch), ignore=("loaded_at", "run_no", "page_no", "pos"))


@query
def bulk_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk file of all customers, some with quotes, line ends and NULL markers, read again."""
    path, c = new_work_dir(spark, "bulk-read-back"), F.col("c_custkey")
    rows = feeds.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(c % 5 == 0, F.concat("c_name", F.lit(', "x\\y"')))
        .when(c % 11 == 0, F.concat(F.lit('\n"\n'), "c_name", F.lit("\\\n\r\n")))
        .when(c % 13 == 0, "\\N")
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(c % 7 != 0, F.col("c_mktsegment")).alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        (c % 2 == 0).alias("flag"),
        F.timestamp_add("MICROSECOND", c * 1_000_000 + (c % 2) * 1_500, F.lit(STARTED_AT)).alias("seen"),
        F.when(c % 3 != 0, F.date_add(F.lit(STARTED_AT.date()), (c % 365).cast("int"))).alias("day"),
    )
    export.write_bulk_file(rows, path)
    return export.read_bulk_file(spark, path, rows.schema)


# ---- streams with progress and state --------------------------------------


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is stopped after its first batch and goes on, and the record of each batch."""
    root = new_work_dir(spark, "stream-progress")
    pg.land_pages(pg.pack_pages(feeds.event_records(spark, sf_dir)), f"{root}/landing")

    def run(should_stop: Callable[[], bool]) -> DataFrame:
        done, _ = progress.run_stream(
            pg.stream_landed(spark, f"{root}/landing", 16),
            lambda pages: tr.type_records(pg.open_pages(pages), feeds.SLIM),
            lambda rows, epoch: rows.write.mode("overwrite").parquet(f"{root}/rows/epoch={epoch}"),
            "stream-progress",
            f"{root}/checkpoint",
            should_stop=should_stop,
        )
        return done.as_table(spark)

    records = run(lambda: True).unionByName(run(lambda: False))
    # A batch that the stop kept from being marked done is repeated; it counts once.
    batches = upsert.latest_per_key(records, "epoch", ["run_id"])
    rows = spark.read.parquet(f"{root}/rows")
    return batches.agg(
        F.count("*").alias("n_batches"),
        F.sum("n_pages").alias("n_pages"),
        F.sum("n_rows").alias("n_rows"),
        F.max("running_max_ts").alias("max_ts"),
    ).withColumn("n_stored", tr.stored_rows(rows).agg(F.countDistinct("ListingKey")).scalar())


@query
def streamed_resume_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision for every feed from states that a stream folded over several triggers and a restart."""
    root, k = new_work_dir(spark, "feed-states"), F.col("o_orderkey")
    saves = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("feed"),
        k.alias("batch_id"),
        F.when(k % 2 == 0, "full").otherwise("incremental").alias("mode"),
        (k % 7 != 0).alias("in_progress"),
        F.when(k % 7 != 0, F.timestamp_add("SECOND", -(k % 481), F.lit(NOW))).alias("link_saved_at"),
        F.when(k % 5 != 0, F.col("o_orderdate")).alias("watermark"),
    )
    # Later saves land first: the order of arrival must not matter.
    for part in (saves.where("batch_id % 3 > 0"), saves.where("batch_id % 3 = 0")):
        part.repartition(4).write.mode("append").parquet(f"{root}/landing")
        landed = spark.readStream.schema(saves.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landing")
        feed_states.follow_states(landed, root)
    states = feed_states.read_states(spark, root, ", ".join(f"{n} {t}" for n, t in saves.dtypes))
    any_mode = ledger.resume_decision(states, NOW).withColumnRenamed("decision", "any_mode")
    return ledger.resume_decision(any_mode, NOW, mode="full").select("feed", "batch_id", "any_mode", F.col("decision").alias("same_mode"))
