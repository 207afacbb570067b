"""Progress of a stream as it runs, and its stop between two batches."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

from parcelflow.schema import MODIFIED, NO_KEY, STORED

PROGRESS_DDL = (
    "run_id string, epoch bigint, batch_no bigint, n_pages bigint, n_rows bigint, n_skipped bigint, "
    "cumulative_rows bigint, max_ts timestamp, running_max_ts timestamp, "
    "elapsed_seconds double, batches_per_minute double"
)


def observe_batch(typed: DataFrame) -> tuple[Observation, DataFrame]:
    """Count a micro-batch while it is written, so that nothing is read twice."""
    counts, outcome = Observation(), F.col("outcome")
    return counts, typed.observe(
        counts,
        F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("n_pages"),
        F.count_if(outcome == STORED).alias("n_rows"),
        F.count_if(outcome == NO_KEY).alias("n_skipped"),
        F.max(F.when(outcome == STORED, F.col(MODIFIED))).alias("max_ts"),
    )


@dataclass(frozen=True)
class BatchRecord:
    """What one committed micro-batch did, and how far the run has come with it."""

    run_id: str
    epoch: int
    batch_no: int
    n_pages: int
    n_rows: int
    n_skipped: int
    cumulative_rows: int
    max_ts: datetime | None
    running_max_ts: datetime | None
    elapsed_seconds: float
    batches_per_minute: float


class RunProgress(StreamingQueryListener):
    """One record per committed batch of one query, kept and handed to ``report`` as it comes.

    ``note`` takes a batch's counts when it is written; the record is made when
    Spark reports the batch as done. Spark calls a listener for every
    query of the session; events of others are left alone. A batch without
    data writes nothing and has no record.
    """

    def __init__(self, run: str, report: Callable[[BatchRecord], None] = lambda record: None):
        self.run, self.records, self.failure = run, [], None
        self.ended = threading.Event()
        self._report, self._id, self._started = report, None, time.monotonic()
        self._noted: dict[int, Mapping] = {}

    def note(self, epoch: int, counts: Mapping) -> None:
        self._noted[epoch] = counts

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        if event.name == self.run:
            self._id, self._started = event.runId, time.monotonic()

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        done = event.progress
        if done.runId == self._id and done.batchId in self._noted:
            self._record(done.batchId)

    def close(self) -> None:
        """Record what was written by a batch that a stop kept Spark from reporting."""
        for epoch in sorted(self._noted):
            self._record(epoch)

    def _record(self, epoch: int) -> None:
        seen = self._noted.pop(epoch)
        before = self.records[-1] if self.records else None
        elapsed, number = max(time.monotonic() - self._started, 1e-9), len(self.records) + 1
        times = [t for t in (seen["max_ts"], before and before.running_max_ts) if t is not None]
        record = BatchRecord(
            str(self._id),
            epoch,
            number,
            seen["n_pages"],
            seen["n_rows"],
            seen["n_skipped"],
            seen["n_rows"] + (before.cumulative_rows if before else 0),
            seen["max_ts"],
            max(times, default=None),
            elapsed,
            number / elapsed * 60.0,
        )
        self.records.append(record)
        self._report(record)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        if event.runId == self._id:
            self.failure = event.exception
            self.ended.set()

    def as_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(vars(r).values()) for r in self.records], PROGRESS_DDL)


class GracefulStop:
    """Ends a query after the batch in flight; no batch fails and no exception is raised.

    ``between_batches`` is called at the end of a batch's ``foreachBatch``. Once a stop is
    wanted it asks the query to stop and waits until the query has taken note: the
    batch then ends as any other, and the query looks for no further one. Asking
    from another thread is needed because ``stop`` itself waits for the batch.
    """

    def __init__(self, wanted: Callable[[], bool], patience: float = 60.0):
        self._wanted, self._patience = wanted, patience
        self._query: StreamingQuery | None = None
        self._known = threading.Event()
        self.stopped = False

    def attach(self, query: StreamingQuery) -> None:
        self._query = query
        self._known.set()

    def between_batches(self) -> None:
        if self.stopped or not self._wanted() or not self._known.wait(self._patience):
            return
        self.stopped = True
        threading.Thread(target=self._query.stop, daemon=True).start()
        deadline = time.monotonic() + self._patience
        while self._query.isActive and time.monotonic() < deadline:
            time.sleep(0.01)


def drive(
    pages: DataFrame,
    load: Callable[[DataFrame, int], Mapping],
    run: str,
    checkpoint: str,
    should_stop: Callable[[], bool] = lambda: False,
    report: Callable[[BatchRecord], None] = lambda record: None,
) -> tuple[RunProgress, bool]:
    """Load every waiting micro-batch; the record of each, and whether the run was stopped.

    ``load`` gets a batch and its number and returns its counts (``n_pages``,
    ``n_rows``, ``n_skipped``, ``max_ts``). It must leave the same result when
    Spark calls it again for a batch: after a crash, and after a stop where Spark
    had no time to mark the batch as done. ``should_stop`` is asked after each
    batch. Raises what ended the query if it failed.
    """
    spark = pages.sparkSession
    progress, stop = RunProgress(run, report), GracefulStop(should_stop)

    def step(batch: DataFrame, epoch: int) -> None:
        progress.note(epoch, load(batch, epoch))
        stop.between_batches()

    spark.streams.addListener(progress)
    try:
        query = (
            pages.writeStream.queryName(run)
            .foreachBatch(step)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        stop.attach(query)
        query.awaitTermination()
        # Events travel apart from the query; the last record comes before the end.
        progress.ended.wait(60.0)
        progress.close()
    finally:
        spark.streams.removeListener(progress)
    return progress, stop.stopped


def run_stream(
    pages: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, int], None],
    run: str,
    checkpoint: str,
    **options,
) -> tuple[RunProgress, bool]:
    """:func:`drive` for rows that ``prepare`` types and ``write`` stores, reading them once.

    ``prepare`` is called once, on the stream, since building and analysing its plan anew
    costs more than the rows of a small batch. It must work row by row: an aggregate,
    a join or a window there would be the whole stream's, not a batch's.
    """

    def load(batch: DataFrame, epoch: int) -> Mapping:
        counts, typed = observe_batch(batch)
        write(typed, epoch)
        return counts.get

    return drive(prepare(pages), load, run, checkpoint, **options)
