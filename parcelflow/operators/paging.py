"""Fixed-size pages over a total order, without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.session import ensure_checkpoint_dir

# monotonically_increasing_id packs the task number above a 33-bit row number.
_ROW_BITS = 33


def paginate(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Add ``page_no`` and ``pos`` of every row under ``order``.

    Rows are range-partitioned and sorted; each task numbers its own rows, and
    the offset of a task is the sum of the sizes before it. ``order`` should
    end in a column that tells any two rows apart: then a time shared by a
    third of the rows still spreads over many tasks. The checkpoint pins the
    partitioning, which both the sizes and the rows must see alike, and
    survives the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_task", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
    )
    # One row per task of the sort: bounded by its partition count, whatever
    # the data size, so both the window and the broadcast stay small.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_task")
        .agg(F.count("*").alias("_size"))
        .select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_offset") + F.col("_row")
    return numbered.join(F.broadcast(offsets), "_task").select(
        *df.columns,
        F.floor(place / F.lit(size)).cast("bigint").alias("page_no"),
        (place % size).cast("int").alias("pos"),
    )


def write_pages(df: DataFrame, order: Sequence[str], size: int, path: str) -> None:
    """Write ``df`` in ``order`` with an index of the first row of every page.

    The rows are numbered once (:func:`paginate`); from then on any page is read
    by number without a sort, see :func:`read_page`. The index has one narrow
    row per page. The ``order`` must tell any two rows apart and hold no NULL.
    """
    placed = paginate(df, order, size)
    # The numbered rows already lie in ``order``, task by task.
    placed.drop("page_no", "pos").write.mode("overwrite").parquet(f"{path}/rows")
    first = placed.where("pos = 0").select("page_no", *order)
    first.write.mode("overwrite").parquet(f"{path}/index")


def read_page(spark: SparkSession, path: str, page: int, order: Sequence[str], size: int) -> DataFrame:
    """One page of what :func:`write_pages` wrote, with ``page_no`` and ``pos``; empty past the last.

    Two rows of the index bound the page. The bounds of the leading column
    reach the scan, which skips files, row groups and Parquet pages outside them;
    the other columns settle ties inside. Only the page itself is sorted.
    """
    index = spark.read.parquet(f"{path}/index").where(F.col("page_no").isin(page, page + 1))
    bounds = {row["page_no"]: row for row in index.collect()}
    rows = spark.read.parquet(f"{path}/rows")
    if page not in bounds:
        rows = rows.where(F.lit(False))
    else:
        rows = rows.where((F.col(order[0]) >= bounds[page][order[0]]) & ~_before(order, bounds[page]))
        if page + 1 in bounds:
            end = bounds[page + 1]
            rows = rows.where((F.col(order[0]) <= end[order[0]]) & _before(order, end))
    place = Window.partitionBy("page_no").orderBy(*order)
    return rows.withColumn("page_no", F.lit(page).cast("bigint")).withColumn("pos", F.row_number().over(place) - 1)


def _before(order: Sequence[str], bound: Row) -> Column:
    """Whether a row comes before ``bound`` in ``order``."""
    before = F.lit(False)
    for name in reversed(order):
        column, limit = F.col(name), F.lit(bound[name])
        before = (column < limit) | ((column == limit) & before)
    return before


def oversized(ledger: DataFrame, cap: int) -> DataFrame:
    """Pages that hold more stored rows than ``cap``; they load all the same."""
    return ledger.where(F.col("n_rows") > cap)


def check_batch_size(size: int, ceiling: int = 5000) -> int:
    """A page size that may be asked for: positive and within the ceiling."""
    if not 0 < size <= ceiling:
        raise ValueError(f"page size must be between 1 and {ceiling}, got {size}")
    return size
