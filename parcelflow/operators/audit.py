"""Checks of a loaded table against itself, its payloads and its ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.schema import KEY, MODIFIED, STATUS, STORED

#: Sketches hold ``2 ** SKETCH_BITS`` registers at most; their relative error is about
#: 0.83 over the root of that, 1.3 %, and none while a sketch holds few values.
SKETCH_BITS = 12


def hot_raw_join(hot: DataFrame, raw: DataFrame, key: str = KEY) -> DataFrame:
    """Each search row with its payload; at most one payload per key."""
    return hot.join(raw.drop("loaded_at"), key, "left")


def orphans(hot: DataFrame, raw: DataFrame, key: str = KEY) -> DataFrame:
    """Search rows without a payload row; only the keys of ``raw`` are read."""
    return hot.join(raw.select(key), key, "left_anti")


def load_audit(
    hot: DataFrame,
    raw: DataFrame,
    key: str = KEY,
    modified: str = MODIFIED,
    status: str = STATUS,
    collation: str | None = None,
) -> DataFrame:
    """One row: counts of both tables, time range, statuses and orphans."""
    state = F.collate(F.col(status), collation) if collation else F.col(status)
    return hot.agg(
        F.count("*").alias("n_rows"),
        F.min(modified).alias("min_ts"),
        F.max(modified).alias("max_ts"),
        F.countDistinct(state).alias("n_statuses"),
    ).select(
        "*",
        raw.agg(F.count("*")).scalar().alias("n_raw_rows"),
        orphans(hot.select(key), raw, key).agg(F.count("*")).scalar().alias("n_orphans"),
    )


def batch_sketches(typed: DataFrame, by: Sequence[str] = ("page_no",), key: str = KEY) -> DataFrame:
    """One row per batch: its counts and times, and sketches of its keys and statuses.

    Such a row is a few kilobytes however many records the batch holds, and rows of
    batches can be united later; :func:`sketched_audit` needs nothing else.
    """
    stored = F.col("outcome") == STORED
    return typed.groupBy(*by).agg(
        F.count_if(stored).alias("n_rows"),
        F.min(F.when(stored, F.col(MODIFIED))).alias("min_ts"),
        F.max(F.when(stored, F.col(MODIFIED))).alias("max_ts"),
        F.hll_sketch_agg(F.when(stored, F.col(key)), SKETCH_BITS).alias("keys"),
        F.hll_sketch_agg(F.when(stored, F.col(STATUS)), SKETCH_BITS).alias("statuses"),
    )


def sketched_audit(batches: DataFrame) -> DataFrame:
    """The load audit from one row per batch, without a look at the tables.

    ``n_rows`` counts what the batches brought, ``n_keys`` estimates the keys
    the table holds after them, ``n_statuses`` its statuses. A status that
    later rows have replaced everywhere still counts.
    """
    return batches.agg(
        F.count("*").alias("n_batches"),
        F.sum("n_rows").alias("n_rows"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"),
        F.hll_sketch_estimate(F.hll_union_agg("statuses")).alias("n_statuses"),
    )


def watermark_check(hot: DataFrame, watermark: Column, modified: str = MODIFIED) -> DataFrame:
    """The stored watermark beside the newest row, and whether they agree."""
    return hot.agg(F.max(modified).alias("max_ts")).select(
        "max_ts",
        watermark.alias("watermark"),
        watermark.eqNullSafe(F.col("max_ts")).alias("agrees"),
    )


def lost_rows(
    observed: DataFrame,
    stored: DataFrame,
    watermark: Column,
    key: str = KEY,
    modified: str = MODIFIED,
) -> DataFrame:
    """Rows at or below the watermark that the table does not hold.

    The next incremental scan starts above the watermark, so such a row would
    never be read again; after a sound recovery there is none. Keys are
    compared once each, however many rows share one; as a rule few or none are
    lost, so finding their rows needs no shuffle of the feed.
    """
    covered = observed.where(F.col(modified) <= watermark)
    lost = covered.select(key).distinct().join(stored.select(key), key, "left_anti")
    return covered.join(lost, key, "left_semi")


def missing_columns(required: Sequence[str], payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """Required column names that no payload in the table carries.

    Names are reduced per task before the shuffle, so its size follows the
    number of distinct fields and not the number of records.
    """
    actual = payloads.select(F.explode(F.json_object_keys(raw)).alias("column_name")).distinct()
    wanted = payloads.sparkSession.createDataFrame(
        [(name,) for name in required], "column_name string"
    )
    return wanted.exceptAll(actual)


def missing_from_schema(required: Sequence[str], df: DataFrame) -> list[str]:
    """Required columns a DataFrame or table lacks, in the order asked."""
    held = {name.lower() for name in df.columns}
    return [name for name in required if name.lower() not in held]
