"""Runs: landed pages to the store, in micro-batches, with exact resume."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parcelflow.operators.ledger import resume_decision
from parcelflow.plans.store import ListingStore, utc_now
from parcelflow.schema import MODIFIED, NO_KEY, STORED
from parcelflow.sources.pages import follow_chain, page_links, read_landed, stream_landed
from parcelflow.streaming.progress import BatchRecord, drive


@dataclass(frozen=True)
class RunResult:
    """What a run did: rows stored by it, and the watermark now in force."""

    mode: str
    total_rows: int
    watermark: datetime | None
    elapsed_seconds: float
    stopped: bool = False


def _result(store: ListingStore, run_key: str, mode: str, started: datetime, stopped: bool):
    total = store.commits().where(F.col("run_key") == run_key).agg(F.sum("n_rows")).first()[0]
    newest = store.commits().agg(F.max("max_ts")).first()[0]
    elapsed = (utc_now() - started).total_seconds()
    return RunResult(mode, total or 0, newest, elapsed, stopped)


def run_pages(
    store: ListingStore,
    landing: str,
    run_key: str,
    mode: str = "full",
    since: datetime | None = None,
    pages_per_batch: int = 1024,
    quarantine: bool = False,
    should_stop: Callable[[], bool] = lambda: False,
    inclusive: bool = False,
    report: Callable[[BatchRecord], None] = lambda record: None,
) -> RunResult:
    """Load every landed page not yet loaded by this run, then stop.

    ``report`` gets the progress record of each batch as it is committed.

    ``run_key`` names the run: calling again with the same key continues after
    its last committed batch. A batch costs a few seconds besides its data, so
    a backfill wants many pages in each; an exact resume point wants few.
    ``should_stop`` is asked after each commit; the batch in flight always
    completes, and no further one is written.
    """
    store.create()
    started, run = utc_now(), store.open_run(run_key)

    def load(rows: DataFrame, epoch: int) -> dict:
        return store.ingest(rows, run_key, epoch, mode, since, quarantine, started, inclusive, run).asDict()

    # Typed on the stream: planned once, not anew for every batch.
    rows = store.typed(stream_landed(store.spark, landing, pages_per_batch), since, inclusive)
    _, stopped = drive(rows, load, run_key, f"{store.root}/checkpoints/{run_key}", should_stop, report)
    return _result(store, run_key, mode, started, stopped)


def full_sync(store: ListingStore, landing: str, run_key: str, **options) -> RunResult:
    """Load a whole feed."""
    return run_pages(store, landing, run_key, "full", **options)


def incremental(store: ListingStore, landing: str, run_key: str, **options) -> RunResult:
    """Load what changed strictly after the stored watermark.

    ``inclusive=True`` reads what changed at the watermark itself again.
    The bound of a run is fixed when the run starts: a continued run keeps
    the watermark that was in force before its first batch.
    """
    commits = store.create().commits()
    own = commits.where(F.col("run_key") == run_key).agg(F.min("run_no")).scalar()
    earlier = own.isNull() | (F.col("run_no") < own)
    known = commits.where(earlier).agg(F.max("max_ts")).first()[0]
    if known is None:
        raise RuntimeError("no watermark yet: run a full sync or give a start time")
    return run_pages(store, landing, run_key, "incremental", known, **options)


def since(
    store: ListingStore, landing: str, run_key: str, start: datetime, **options
) -> RunResult:
    """Load what changed strictly after ``start``, whatever is stored.

    An older start re-reads rows but never lowers the watermark, which is the
    maximum over all commits.
    """
    return run_pages(store, landing, run_key, "since", start, **options)


def dry_run(
    store: ListingStore,
    landing: str,
    since: datetime | None = None,
    quarantine: bool = False,
) -> RunResult:
    """Read and type every page, write nothing, report count and newest time."""
    started = utc_now()
    landed = read_landed(store.spark, landing)
    observed, rows = observe_rows(
        store.prepare(follow_chain(landed, page_links(landed)), started, since, quarantine)
    )
    rows.write.format("noop").mode("overwrite").save()
    summary = observed.get
    elapsed = (utc_now() - started).total_seconds()
    return RunResult("dry-run", summary["n_rows"], summary["max_ts"], elapsed)


def observe_rows(typed: DataFrame) -> tuple[Observation, DataFrame]:
    """Attach counts to a write, so that no second scan is needed."""
    observation = Observation()
    outcome = F.col("outcome")
    return observation, typed.observe(
        observation,
        F.count_if(outcome == STORED).alias("n_rows"),
        F.count_if(outcome == NO_KEY).alias("n_skipped"),
        F.max(F.when(outcome == STORED, F.col(MODIFIED))).alias("max_ts"),
    )


def planned_sync(
    store: ListingStore,
    landing: str,
    run_key: str,
    now: datetime | None = None,
    **options,
) -> RunResult:
    """A full sync that does what ``plan_full_sync`` says.

    ``fresh`` loads the feed as ``run_key``; ``resume`` goes on with the
    unfinished run under its own name; ``pivot`` leaves that run as it is and
    loads what changed after the watermark as ``run_key``, which must be a new
    name. With nothing to pivot from it stops.
    """
    plan = plan_full_sync(store.create(), now)
    if plan == "error":
        raise RuntimeError("the saved link is stale and there is no watermark to pivot to")
    if plan == "resume":
        return full_sync(store, landing, store.last_run()["run_key"], **options)
    if plan == "fresh":
        return full_sync(store, landing, run_key, **options)
    if store.commits().where(F.col("run_key") == run_key).first() is not None:
        raise ValueError(f"run {run_key!r} is the one to pivot from: give a new name")
    return incremental(store, landing, run_key, **options)


def plan_full_sync(store: ListingStore, now: datetime | None = None) -> str:
    """``resume``, ``pivot``, ``error`` or ``fresh``, from the latest run."""
    run = store.last_run()
    if run is None:
        return "fresh"
    state = store.commits().agg(F.max("max_ts").alias("watermark")).select(
        "watermark",
        F.lit(run["mode"]).alias("mode"),
        F.lit(not run["done"]).alias("in_progress"),
        F.when(F.lit(not run["done"]), F.lit(run["committed_at"])).alias("link_saved_at"),
    )
    return resume_decision(state, now or utc_now(), mode="full").first()["decision"]
