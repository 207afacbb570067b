"""Streams that report and stop, and states that a stream keeps."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import text as tx
from parcelflow.operators import export, ledger
from parcelflow.operators import transform as tr
from parcelflow.schema import PROMOTED
from parcelflow.session import new_work_dir
from parcelflow.sources import pages as pg
from parcelflow.streaming import feed_states, progress

FIELDS = [f for f in PROMOTED if f.name in ("ListingKey", "ModificationTimestamp")]


def land(spark, path, n_pages, rows=3):
    pages = []
    for n in range(n_pages):
        records = [{"ListingKey": f"{n}-{k}", "ModificationTimestamp": f"2024-01-{n + 1:02d}T00:00:{k:02d}Z"} for k in range(rows)]
        pages.append((n, json.dumps({"value": [*records, {"ListingKey": " "}], "@odata.nextLink": "x"})))
    pg.land_pages(spark.createDataFrame(pages, "page_no bigint, body string"), path)


def run(spark, root, name="run", **options):
    return progress.run_stream(
        pg.stream_landed(spark, f"{root}/landing", 2),
        lambda pages: tr.type_records(pg.open_pages(pages), FIELDS),
        options.pop("write", lambda rows, epoch: rows.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")),
        name,
        f"{root}/checkpoint",
        **options,
    )


def test_every_batch_is_reported_as_it_runs(spark):
    root, told = new_work_dir(spark, "told"), []
    land(spark, f"{root}/landing", 5)
    done, stopped = run(spark, root, report=told.append)
    assert not stopped and done.failure is None and told == done.records
    assert [r.batch_no for r in told] == [1, 2, 3] and [r.epoch for r in told] == [0, 1, 2]
    assert sum(r.n_pages for r in told) == 5 and sum(r.n_skipped for r in told) == 5
    assert [r.cumulative_rows for r in told] == [sum(r.n_rows for r in told[: k + 1]) for k in range(3)]
    assert told[-1].cumulative_rows == 15
    newest = [r.running_max_ts for r in told]
    assert newest == sorted(newest) and newest[-1].replace(tzinfo=None) == dt.datetime(2024, 1, 5, 0, 0, 2)
    assert all(r.elapsed_seconds > 0 and r.batches_per_minute == pytest.approx(r.batch_no / r.elapsed_seconds * 60) for r in told)
    assert done.as_table(spark).count() == 3
    # Nothing waits: no batch, no record.
    assert run(spark, root)[0].records == []


def test_rows_are_prepared_once_and_not_for_every_batch(spark):
    root, calls = new_work_dir(spark, "once"), []
    land(spark, f"{root}/landing", 5)

    def prepare(pages):
        calls.append(pages.isStreaming)
        return tr.type_records(pg.open_pages(pages), FIELDS)

    done, _ = progress.run_stream(
        pg.stream_landed(spark, f"{root}/landing", 2), prepare, lambda rows, epoch: rows.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}"), "once", f"{root}/checkpoint"
    )
    assert calls == [True] and [r.n_pages for r in done.records] == [2, 2, 1]
    kept = spark.read.parquet(f"{root}/out").drop("epoch")
    whole = tr.type_records(pg.open_pages(pg.read_landed(spark, f"{root}/landing")), FIELDS)
    assert kept.count() == 20 and kept.exceptAll(whole).count() == whole.exceptAll(kept).count() == 0


def test_a_stop_ends_the_query_without_a_failure_and_loses_nothing(spark):
    root = new_work_dir(spark, "stop")
    land(spark, f"{root}/landing", 7)
    first, stopped = run(spark, root, should_stop=lambda: True)
    assert stopped and first.failure is None and len(first.records) == 1
    assert spark.read.parquet(f"{root}/out").where("outcome = 'stored'").count() == first.records[0].n_rows == 6
    rest, stopped = run(spark, root)
    assert not stopped and rest.failure is None
    stored = spark.read.parquet(f"{root}/out").where("outcome = 'stored'")
    assert stored.count() == stored.select("ListingKey").distinct().count() == 21
    assert {r.epoch for r in first.records} | {r.epoch for r in rest.records} == {0, 1, 2, 3}


def test_a_failing_write_ends_the_run_with_its_error(spark):
    root = new_work_dir(spark, "fails")
    land(spark, f"{root}/landing", 3)

    def write(rows, epoch):
        raise ValueError("disk on fire")

    with pytest.raises(Exception, match="disk on fire"):
        run(spark, root, write=write)
    assert [r.n_pages for r in run(spark, root)[0].records] == [2, 1]


def test_states_follow_their_feeds_over_restarts(spark):
    root, rng = new_work_dir(spark, "feeds"), random.Random(5)
    schema = "feed string, batch_id bigint, in_progress boolean, link_saved_at timestamp, watermark timestamp"
    saves = []
    for k in range(600):
        feed = "hot" if k % 3 == 0 else f"f{rng.randrange(12)}"
        when = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(500))
        saves.append((feed, k, rng.random() < 0.7, when if rng.random() < 0.8 else None, when if rng.random() < 0.6 else None))
    rng.shuffle(saves)
    saves.append((None, 1, True, None, None))
    for low in (0, 250, 400):
        part = saves[low : {0: 250, 250: 400}.get(low)]
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
        feed_states.follow_states(stream, root)
        known = spark.createDataFrame(saves[: low + len(part)], schema)
        want = ledger.last_state(known, "feed", ["batch_id"])
        got = feed_states.read_states(spark, root, schema)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


KINDS = "k bigint, name string, flag boolean, price decimal(12,2), seen timestamp, day date, last string"


def texts(rng):
    return "".join(rng.choice('ab,"\\\n\r\tN\x01\x01abcé漢') for _ in range(rng.randrange(12)))


def test_the_bulk_file_reads_back_as_written(spark):
    rng, rows = random.Random(3), []
    for k in range(4_000):
        some = [texts(rng), rng.random() < 0.5, None, dt.datetime(2024, 1, 1, microsecond=rng.choice([0, 17])), dt.date(2024, 2, 29), texts(rng)]
        rows.append((k, *[None if rng.random() < 0.2 else v for v in some]))
    rows += [(-1, "\\N", None, None, None, None, "\\N"), (-2, "", True, None, None, None, ""), (-3, "\n", None, None, None, None, '"\n"'), (-4, 'x\n,"', None, None, None, None, "\n" * 50)]
    df = spark.createDataFrame(rows, KINDS).withColumn("price", F.when(F.col("k") % 3 == 0, (F.col("k") / 7).cast("decimal(12,2)")))
    path = new_work_dir(spark, "bulk")
    export.write_bulk_file(df.repartition(2), path)
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            back = export.read_bulk_file(spark, path, df.schema)
            assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    export.write_bulk_file(df.limit(0), path)
    assert export.read_bulk_file(spark, path, KINDS).collect() == []


def test_fields_that_do_not_fit_read_as_null(spark):
    line = spark.createDataFrame([('"12","x","2","1.239",\\N,"no day"',)], "l string")
    fields = line.select(tx.csv_fields(tx.without_escapes(F.col("l"))).alias("f"))
    kinds = ("bigint", "string", "boolean", "decimal(6,2)", "timestamp", "date", "string")
    got = fields.select(*[tx.csv_value(F.get("f", F.lit(n)), kind).alias(f"c{n}") for n, kind in enumerate(kinds)]).first()
    assert [None if v is None else str(v) for v in got] == ["12", "x", None, "1.24", None, None, None]
