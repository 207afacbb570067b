"""Whole and incremental scans of a modification-ordered table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.schema import MODIFIED

#: The folder column of :func:`write_by_time`: the first day of the folder's time.
FOLDER = "modified_from"


def full_scan(df: DataFrame, modified: str = MODIFIED) -> DataFrame:
    """Every row, oldest change first (a range-partitioned sort)."""
    return df.orderBy(F.col(modified).asc())


def _limit(df: DataFrame, bound: Column | datetime, modified: str) -> Column:
    # Casting the bound, not the column, keeps the filter pushable.
    limit = bound if isinstance(bound, Column) else F.lit(bound)
    return limit.cast(df.schema[modified].dataType)


def newer_than(
    df: DataFrame,
    bound: Column | datetime,
    modified: str = MODIFIED,
    inclusive: bool = False,
) -> DataFrame:
    """Rows changed strictly after ``bound``.

    ``bound`` may be a scalar subquery: Spark evaluates it first and pushes
    the resulting value to the Parquet scan. ``inclusive`` re-reads the
    boundary too, which is safe because the upsert is idempotent.
    """
    limit = _limit(df, bound, modified)
    column = F.col(modified)
    return df.where(column >= limit if inclusive else column > limit)


def write_by_time(rows: DataFrame, path: str, key: str, modified: str = MODIFIED, unit: str = "day") -> None:
    """Write ``rows`` into one folder per ``unit`` (day, month, year) of their modification time.

    Rows without a time go to a folder of their own, which no time bound reads.
    Tasks get ranges of time and ``key``: each writes few folders, and a day that
    holds a third of all rows is written by many.
    """
    placed = rows.withColumn(FOLDER, F.date_trunc(unit, F.col(modified)).cast("date"))
    placed.repartitionByRange(modified, key).sortWithinPartitions(modified, key).write.mode("overwrite").partitionBy(FOLDER).parquet(path)


def newer_in_folders(
    folders: DataFrame,
    bound: Column | datetime,
    modified: str = MODIFIED,
    unit: str = "day",
    inclusive: bool = False,
) -> DataFrame:
    """:func:`newer_than` over what :func:`write_by_time` wrote with the same ``unit``.

    Folders of earlier times are ruled out before any file is opened, also where
    the bound is a scalar subquery; inside the bound's own folder the time itself
    is pushed to the scan as before.
    """
    first = F.date_trunc(unit, _limit(folders, bound, modified)).cast("date")
    return newer_than(folders.where(F.col(FOLDER) >= first), bound, modified, inclusive).drop(FOLDER)


def late_rows(df: DataFrame, bound: Column | datetime, modified: str = MODIFIED) -> DataFrame:
    """Rows the next incremental scan will not see: at or below ``bound``."""
    return df.where(F.col(modified) <= _limit(df, bound, modified))


def stored_watermark(ledger: DataFrame, required: bool = True) -> Column:
    """The highest committed modification time, as a scalar subquery.

    With ``required`` an empty ledger stops the query instead of yielding a
    NULL bound, under which a scan would silently return nothing.
    """
    mark = F.max("max_ts")
    if required:
        # The same type as the watermark: a cast would keep it from the scan.
        failure = F.raise_error(F.lit("no watermark yet: run a full sync or give a start time"))
        mark = F.coalesce(mark, failure.cast(ledger.schema["max_ts"].dataType))
    return ledger.agg(mark.alias("watermark")).scalar()


def since_bound(since: datetime | Column | None, ledger: DataFrame) -> Column:
    """The caller's start time if given, else the stored watermark."""
    if since is None:
        return stored_watermark(ledger)
    return since if isinstance(since, Column) else F.lit(since)
