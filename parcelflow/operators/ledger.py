"""What a run has committed: per page, cumulatively, and as a resume plan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators.upsert import latest_per_key
from parcelflow.schema import INVALID, MODIFIED, NO_KEY, STORED

# Fixed value: a saved page link may be resumed for less than four minutes.
FRESH_SECONDS = 240

# Pages per block of the running totals. Page numbers are dense, so a block
# never holds more ledger rows than this.
_BLOCK = 4096


def page_ledger(typed: DataFrame, by: Sequence[str] = ("run_no", "page_no")) -> DataFrame:
    """One row per page: stored, skipped and invalid counts and the newest time.

    Pages without a single stored row appear with a count of zero, so their
    link still moves the cursor. The link belongs to the page; as a grouping
    column it leaves only fixed-width values to fold, which Spark hashes
    instead of sorting. ``n_copies`` counts first rows: above one, the page
    was landed more than once.
    """
    outcome = F.col("outcome")
    return typed.groupBy(*by, "next_link").agg(
        F.count_if(outcome == STORED).alias("n_rows"),
        F.count_if(outcome == NO_KEY).alias("n_skipped"),
        F.count_if(outcome == INVALID).alias("n_invalid"),
        F.max(F.when(outcome == STORED, F.col(MODIFIED))).alias("max_ts"),
        F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("n_copies"),
    )


def committed_rows(log: DataFrame, commits: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of batches that were committed; a failed batch's rows stay unseen.

    ``commits`` has one row per batch, so this side of the join is small.
    """
    return log.join(commits.select(batch), batch, "left_semi")


def watermark(
    ledger: DataFrame, prior: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The newest committed time per feed; it never falls below ``prior``.

    ``prior`` holds ``(*by, watermark)``. A missing time on either side is
    ignored. Without ``by`` there is one feed.
    """
    newest = ledger.groupBy(*by).agg(F.max("max_ts").alias("_newest"))
    if prior is None:
        return newest.select(*by, F.col("_newest").alias("watermark"))
    if not by:
        before = prior.agg(F.max("watermark")).scalar()
        return newest.select(F.greatest(before, F.col("_newest")).alias("watermark"))
    return newest.join(prior, list(by), "left").select(
        *by, F.greatest("watermark", "_newest").alias("watermark")
    )


def running_progress(ledger: DataFrame, by: Sequence[str] = ("run_no",)) -> DataFrame:
    """Batch number, rows so far and newest time so far, after each page.

    A window over the whole ledger would put it all in one task. Here pages
    fold inside blocks first; only the block totals are folded in sequence.
    """
    blocks = ledger.withColumn("_block", F.expr(f"page_no div {_BLOCK}"))
    group = [*by, "_block"]
    so_far = (
        Window.partitionBy(*group)
        .orderBy("page_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = blocks.select(
        "*",
        F.count("*").over(so_far).alias("_n"),
        F.sum("n_rows").over(so_far).alias("_rows"),
        F.max("max_ts").over(so_far).alias("_newest"),
    )
    before = (
        Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = blocks.groupBy(*group).agg(
        F.count("*").alias("_n"), F.sum("n_rows").alias("_rows"), F.max("max_ts").alias("_newest")
    )
    earlier = totals.select(
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"),
        F.max("_newest").over(before).alias("_newest0"),
    )
    return inside.join(earlier, group).select(
        *ledger.columns,
        (F.col("_n0") + F.col("_n")).alias("batch_no"),
        (F.col("_rows0") + F.col("_rows")).alias("cumulative_rows"),
        F.greatest("_newest0", "_newest").alias("running_max_ts"),
    )


def _seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def progress(
    ledger: DataFrame, started_at: Column, by: Sequence[str] = ("run_no",)
) -> DataFrame:
    """The progress record of each committed page, with the rate since start."""
    elapsed = _seconds(started_at, F.col("committed_at"))
    return (
        running_progress(ledger, by)
        .withColumn("elapsed_seconds", elapsed)
        .withColumn(
            "requests_per_minute",
            F.when(
                F.col("elapsed_seconds") > 0,
                F.col("batch_no") / F.col("elapsed_seconds") * 60.0,
            ),
        )
    )


def state_after(ledger: DataFrame, by: Sequence[str] = ("run_no",)) -> DataFrame:
    """The saved state after each page.

    In progress if and only if there is a link, and the link's time is kept if
    and only if there is a link.
    """
    linked = F.col("next_link").isNotNull()
    return running_progress(ledger, by).select(
        *by,
        "page_no",
        F.col("running_max_ts").alias("watermark"),
        linked.alias("in_progress"),
        "next_link",
        F.when(linked, F.col("committed_at")).alias("link_saved_at"),
    )


def last_state(states: DataFrame, feed: str, order: Sequence[str]) -> DataFrame:
    """Each feed's last saved state, out of any number of feeds."""
    return latest_per_key(states, feed, order)


def link_is_fresh(saved_at: Column, now: Column) -> Column:
    """Strictly less than the window old; a link never saved is not fresh."""
    age = F.unix_micros(now) - F.unix_micros(saved_at)
    return F.coalesce(age < FRESH_SECONDS * 1_000_000, F.lit(False))


def resume_decision(
    states: DataFrame, now: datetime | Column, mode: str | None = None
) -> DataFrame:
    """What a full sync should do next, feed by feed.

    ``resume`` a fresh link, ``pivot`` to an incremental scan when the link is
    stale, report ``error`` when there is no watermark to pivot from, else
    start ``fresh``. With ``mode`` only a state saved by a run of that mode
    counts as in progress, so one kind of run never resumes another's link.
    """
    clock = now if isinstance(now, Column) else F.lit(now)
    running = F.coalesce(F.col("in_progress"), F.lit(False))
    if mode is not None:
        running = running & (F.col("mode") == mode)
    decision = (
        F.when(~running, "fresh")
        .when(link_is_fresh(F.col("link_saved_at"), clock), "resume")
        .when(F.col("watermark").isNull(), "error")
        .otherwise("pivot")
    )
    return states.withColumn("decision", decision)


def run_summary(
    ledger: DataFrame, started_at: Column, by: Sequence[str] = ("run_no",)
) -> DataFrame:
    """Totals of each run: rows, pages, final watermark and elapsed time."""
    return ledger.groupBy(*by).agg(
        F.sum("n_rows").alias("total_rows"),
        F.count("*").alias("n_pages"),
        F.max("max_ts").alias("watermark"),
        _seconds(F.min(started_at), F.max("committed_at")).alias("elapsed_seconds"),
    )
