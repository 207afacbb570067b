"""The tables on disk: a change log, its ledgers, and a compacted snapshot.

Every batch of pages is written to its own ``batch_id`` folder of the change
log, one row holding both the search columns and the payload. The batch
becomes visible only when its single row is written to ``commits``, after the
log and the page ledger; what a failed batch left behind is never read, and
the next attempt takes the same number and overwrites it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.operators import transform as tr
from parcelflow.operators.layout import write_layout
from parcelflow.operators.ledger import page_ledger, progress
from parcelflow.operators.upsert import latest_per_key, latest_wide_rows, not_older, replace_rows
from parcelflow.schema import (
    ARRIVAL,
    COMMIT_DDL,
    EMPTY_PAGE,
    HOT_COLUMNS,
    INVALID,
    KEY,
    LOG_DDL,
    MODIFIED,
    PAGE_LEDGER_DDL,
    PROMOTED_DDL,
    RAW_COLUMNS,
    STORED,
)
from parcelflow.session import configure
from parcelflow.sources.pages import follow_chain, open_pages, page_links
from parcelflow.sources.scans import stored_watermark

_DDL = {
    "change_log": LOG_DDL,
    "page_ledger": PAGE_LEDGER_DDL,
    "commits": COMMIT_DDL.removeprefix("batch_id bigint, "),
    "snapshots": "through_batch bigint, n_buckets int, created_at timestamp",
}
_PARTITION = {"snapshots": "version"}
_RAW_DDL = f"{KEY} string, raw_data string, loaded_at timestamp"

# A row's place in the log. A batch holds a page once; the batch number tells
# apart copies of a page that were landed again later in a run.
_PLACE = (*ARRIVAL, "batch_id")

# Search columns the compacted table is ordered by unless the caller chooses.
DEFAULT_LAYOUT = ("StateOrProvince", "City", "MlsStatus")

# Stored bytes that one bucket of the compacted payload table may hold.
BUCKET_BYTES = 512 << 20


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _held(value: datetime | int) -> Column:
    """A value that generated code looks up, rather than a literal in its text.

    Spark compiles a text anew whenever it differs, and what is compiled anew is also
    interpreted at first. A time or a number of the batch must not make each batch's
    code another one, so it is read from an array, at a place that Spark does not fold.
    """
    return F.get(F.array(F.lit(value)), F.spark_partition_id() * 0)


@dataclass
class RunState:
    """Where a run stands: its next batch, its number, the first page without a link, the epochs it has committed."""

    batch: int
    run_no: int
    end: int | None
    done: set[int]


class ListingStore:
    """A store of listings below one folder.

    ``collation`` says how keys compare (exactly, unless given). With
    ``newest_wins`` the row with the latest modification time holds a key, and
    arrival decides only between equal times. Both halves follow both options;
    a store must be opened with the same ones each time.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        collation: str | None = None,
        newest_wins: bool = False,
    ) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.collation = collation
        self.newest_wins = newest_wins

    # ---- tables ---------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _partition(self, table: str, number: int) -> str:
        return f"{self.path(table)}/{_PARTITION.get(table, 'batch_id')}={number}"

    def create(self, recreate: bool = False) -> ListingStore:
        """Create what is missing; with ``recreate`` empty every table first.

        Snapshots and the places of runs in their landings go with the tables,
        so that a run of a known name starts anew.
        """
        if recreate:
            for version in self._versions():
                self.spark.sql(f"DROP TABLE IF EXISTS {self._raw_table(version)}")
            for folder in (*_DDL, "compacted", "checkpoints"):
                self._remove(self.path(folder))
        for table, ddl in _DDL.items():
            empty = self.spark.createDataFrame([], ddl)
            # Partition -1 holds no rows; it lets an empty table be read.
            empty.write.mode("ignore").parquet(self._partition(table, -1))
        return self

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _versions(self) -> list[int]:
        """Snapshots made so far; none where there is no store yet."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path("snapshots"))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return []
        return [r["version"] for r in self.read("snapshots").select("version").collect()]

    def read(self, table: str) -> DataFrame:
        number = _PARTITION.get(table, "batch_id")
        return self.spark.read.schema(f"{_DDL[table]}, {number} bigint").parquet(
            self.path(table)
        )

    def _read_one(self, table: str, number: int) -> DataFrame:
        return self.spark.read.schema(_DDL[table]).parquet(self._partition(table, number))

    def commits(self) -> DataFrame:
        return self.read("commits")

    def ledger(self) -> DataFrame:
        """Pages of committed batches."""
        return self._committed(self.read("page_ledger"))

    def committed_log(self, after_batch: int = -1) -> DataFrame:
        """Log rows of committed batches past ``after_batch``."""
        return self._committed(self.read("change_log")).where(F.col("batch_id") > after_batch)

    def _committed(self, rows: DataFrame) -> DataFrame:
        """Rows up to the last commit, by a bound on the partition number.

        A failed batch leaves its number to the next attempt, so numbers are
        dense and only the one past the last commit can be unfinished. The bound
        selects folders; no row is joined or shuffled.
        """
        return rows.where(F.col("batch_id") <= self.commits().agg(F.max("batch_id")).scalar())

    def watermark(self, required: bool = True) -> Column:
        return stored_watermark(self.commits(), required)

    # ---- writing --------------------------------------------------------

    def _last(self, commits: DataFrame, column: str) -> int:
        return commits.agg(F.coalesce(F.max(column), F.lit(-1))).first()[0]

    def _next(self, run_key: str, epoch: int) -> Row:
        """Where a batch goes: its number, its run's number, and if it is done.

        A run that goes on after another one has committed gets a new number,
        so that numbers follow the order of arrival.
        """
        of_run = F.col("run_key") == run_key
        newest = F.max_by("run_key", "batch_id") == run_key
        return self.commits().agg(
            (F.coalesce(F.max("batch_id"), F.lit(-1)) + 1).alias("batch"),
            F.coalesce(
                F.max("run_no") + F.when(newest, 0).otherwise(1), F.lit(0)
            ).alias("run_no"),
            F.coalesce(F.bool_or(of_run & (F.col("epoch") == epoch)), F.lit(False)).alias("done"),
        ).first()

    def open_run(self, run_key: str) -> RunState:
        """The state of a run, read once; ``ingest`` carries it on from batch to batch."""
        place = self._next(run_key, -1)
        done = self.commits().where(F.col("run_key") == run_key).select("epoch").collect()
        ends = self._of_run(self.ledger(), run_key).where(F.col("next_link").isNull())
        end = ends.agg(F.min("page_no")).first()[0]
        return RunState(place["batch"], place["run_no"], end, {r["epoch"] for r in done})

    def _is_committed(self, batch: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._partition("commits", batch))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def progress(self) -> DataFrame:
        """The progress record of every committed page, run by run."""
        runs = self.commits().select("batch_id", "run_key", "started_at")
        return progress(
            self.ledger().join(runs, "batch_id"), F.col("started_at"), by=["run_key"]
        )

    def find_commit(self, run_key: str, epoch: int) -> Row | None:
        return (
            self.commits()
            .where((F.col("run_key") == run_key) & (F.col("epoch") == epoch))
            .first()
        )

    def typed(self, pages: DataFrame, since: datetime | None = None, inclusive: bool = False) -> DataFrame:
        """Typed rows of some pages, also of a stream of them; each row on its own.

        With ``since`` rows changed after it are kept, and with ``inclusive``
        those changed at that very time too.
        """
        typed = tr.type_records(open_pages(pages))
        if since is not None:
            # What the feed's own filter would leave out never enters the log.
            # The first row of a page stays as a marker, so the page still counts.
            # A time that cannot be read is a fault to report, not an old row.
            unread = (F.col("outcome") == INVALID) & F.col(MODIFIED).isNull()
            bound = F.lit(since)
            changed = F.col(MODIFIED) >= bound if inclusive else F.col(MODIFIED) > bound
            newer = F.coalesce(changed, F.lit(False)) | unread
            marker = ~newer & (F.coalesce(F.col("pos"), F.lit(0)) == 0)
            typed = (
                typed.where(newer | marker)
                .withColumn("outcome", F.when(marker, EMPTY_PAGE).otherwise(F.col("outcome")))
                .withColumn("raw_data", F.when(~marker, F.col("raw_data")))
            )
        return typed

    def prepare(
        self,
        pages: DataFrame,
        loaded_at: datetime,
        since: datetime | None = None,
        quarantine: bool = False,
        inclusive: bool = False,
    ) -> DataFrame:
        """Typed and stamped rows of some pages, before any write."""
        typed = self.typed(pages, since, inclusive)
        if not quarantine:
            typed = tr.enforce(typed)
        return tr.stamp(typed, _held(loaded_at))

    def ingest(
        self,
        pages: DataFrame,
        run_key: str,
        epoch: int = 0,
        mode: str = "full",
        since: datetime | None = None,
        quarantine: bool = False,
        started_at: datetime | None = None,
        inclusive: bool = False,
        run: RunState | None = None,
    ) -> Row:
        """Write one batch of pages and commit it; repeating a call is harmless.

        The pages are parsed once. Counts and the newest time come from a
        narrow read of the rows just written. With the state of a ``run`` the
        pages are rows that ``typed`` gave, and earlier commits are not read again.
        """
        if run is not None:
            return self._ingest_typed(pages, run_key, epoch, mode, quarantine, started_at, run)
        place = self._next(run_key, epoch)
        if place["done"]:
            return self.find_commit(run_key, epoch)
        loaded_at = utc_now()
        rows = self.prepare(self._in_chain(pages, run_key), loaded_at, since, quarantine, inclusive)
        seen = self._write(rows, place["batch"], place["run_no"])
        return self._commit(place["batch"], seen, run_key, epoch, mode, started_at or loaded_at)

    def _ingest_typed(
        self,
        rows: DataFrame,
        run_key: str,
        epoch: int,
        mode: str,
        quarantine: bool,
        started_at: datetime | None,
        run: RunState,
    ) -> Row:
        """A batch of typed rows, whose pages' links are known only once it is written.

        A batch that also brings pages past the first without a link is written
        again without them. Unreadable records count only in pages that stay.
        """
        if epoch in run.done:
            return self.find_commit(run_key, epoch)
        if self._is_committed(run.batch):
            # Another run has written meanwhile.
            run.__dict__.update(vars(self.open_run(run_key)))
        loaded_at = utc_now()

        def write(end: int | None) -> Row:
            kept = rows if end is None else rows.where(F.col("page_no") <= end)
            return self._write(tr.stamp(kept, _held(loaded_at)), run.batch, run.run_no)

        seen = write(run.end)
        if seen["end"] is not None and seen["last_page"] > seen["end"]:
            seen = write(seen["end"])
        if seen["n_invalid"] and not quarantine:
            # Fails as the same rows would on their way in.
            written = self._read_one("change_log", run.batch)
            tr.enforce(written).write.format("noop").mode("overwrite").save()
        commit = self._commit(run.batch, seen, run_key, epoch, mode, started_at or loaded_at)
        run.done.add(epoch)
        run.batch += 1
        run.end = min((e for e in (run.end, seen["end"]) if e is not None), default=None)
        return commit

    def _write(self, rows: DataFrame, batch: int, run_no: int) -> Row:
        """Write a batch's log and ledger, not yet its commit; what its pages show."""
        rows.withColumn("run_no", F.lit(run_no)).select(
            *T.StructType.fromDDL(_DDL["change_log"]).names
        ).write.mode("overwrite").parquet(self._partition("change_log", batch))

        page_ledger(self._read_one("change_log", batch)).withColumn(
            "committed_at", _held(utc_now())
        ).write.mode("overwrite").parquet(self._partition("page_ledger", batch))

        pages = self._read_one("page_ledger", batch).groupBy("page_no").agg(
            F.sum("n_copies").alias("n_copies"),
            F.sum("n_invalid").alias("n_invalid"),
            F.bool_or(F.col("next_link").isNull()).alias("ends"),
        )
        return pages.agg(
            F.lit(run_no).alias("run_no"),
            F.min(F.when(F.col("n_copies") > 1, F.col("page_no"))).alias("twin"),
            F.min(F.when(F.col("ends"), F.col("page_no"))).alias("end"),
            F.max("page_no").alias("last_page"),
            F.coalesce(F.sum("n_invalid"), F.lit(0)).alias("n_invalid"),
        ).first()

    def _commit(
        self, batch: int, seen: Row, run_key: str, epoch: int, mode: str, started_at: datetime
    ) -> Row:
        """Make a written batch visible."""
        if seen["twin"] is not None:
            raise ValueError(f"page {seen['twin']} was landed more than once")
        summary = self._read_one("page_ledger", batch).agg(
            F.lit(seen["run_no"]).alias("run_no"),
            F.lit(run_key).alias("run_key"),
            _held(epoch).cast("bigint").alias("epoch"),
            F.lit(mode).alias("mode"),
            F.count("*").alias("n_pages"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum("n_skipped"), F.lit(0)).alias("n_skipped"),
            F.max("max_ts").alias("max_ts"),
            F.max("page_no").alias("last_page"),
            F.max_by("next_link", "page_no").alias("next_link"),
            _held(started_at).alias("started_at"),
            _held(utc_now()).alias("committed_at"),
        )
        # One row, one file: the batch appears whole or not at all.
        summary.coalesce(1).write.mode("overwrite").parquet(self._partition("commits", batch))
        return self._read_one("commits", batch).withColumn("batch_id", F.lit(batch)).first()

    def _of_run(self, rows: DataFrame, run_key: str) -> DataFrame:
        """Ledger rows of one run, under all the numbers it had."""
        numbers = self.commits().where(F.col("run_key") == run_key).select("run_no").distinct()
        return rows.join(numbers, "run_no", "left_semi")

    def _in_chain(self, pages: DataFrame, run_key: str) -> DataFrame:
        """Pages up to the first without a link, among these and the run's earlier ones."""
        links = page_links(pages).unionByName(
            self._of_run(self.ledger(), run_key).select("page_no", "next_link")
        )
        return follow_chain(pages, links)

    # ---- current state --------------------------------------------------

    def _snapshot(self) -> Row | None:
        return self.read("snapshots").orderBy(F.desc("version")).first()

    def _recent(self, snapshot: Row | None, columns: Sequence[str]) -> DataFrame:
        """Stored rows of batches not yet compacted."""
        after = -1 if snapshot is None else snapshot["through_batch"]
        time = [MODIFIED] if self.newest_wins else []
        narrow = list(dict.fromkeys([KEY, *columns, *time, *_PLACE]))
        return self.committed_log(after).where(F.col("outcome") == STORED).select(*narrow)

    def property(self, columns: Sequence[str] = HOT_COLUMNS) -> DataFrame:
        """The search table: the last stored row of every key."""
        snapshot = self._snapshot()
        recent = self._recent(snapshot, columns)
        winners = latest_per_key(
            recent, order=_PLACE, newest_wins=self.newest_wins, collation=self.collation
        )
        return self._over_snapshot(snapshot, "property", winners, columns)

    def property_raw(self) -> DataFrame:
        """The payload table, one row per key."""
        snapshot = self._snapshot()
        recent = self._recent(snapshot, RAW_COLUMNS)
        winners = latest_wide_rows(
            recent, order=_PLACE, newest_wins=self.newest_wins, collation=self.collation
        )
        return self._over_snapshot(snapshot, "property_raw", winners, RAW_COLUMNS)

    def _over_snapshot(
        self, snapshot: Row | None, table: str, winners: DataFrame, columns: Sequence[str]
    ) -> DataFrame:
        """Recent rows in place of the snapshot's rows of the same keys.

        Runs are folded whole, so a recent row always arrived later. Where the
        newest wins, the search half of the snapshot has the times to compare.
        """
        if snapshot is None:
            return winners.select(*columns)
        base = self._snapshot_table(table, snapshot)
        if self.newest_wins:
            times = self._snapshot_table("property", snapshot)
            winners = not_older(winners, times, collation=self.collation)
        return replace_rows(
            base.select(*columns), winners.select(*columns), collation=self.collation
        )

    def skipped(self) -> DataFrame:
        """Records dropped for want of a key, with what identifies them."""
        return (
            self.committed_log()
            .where(F.col("outcome") == "no_key")
            .select("batch_id", *ARRIVAL, tr.identifying(F.col("raw_data")).alias("identifying"))
        )

    def rejected(self) -> DataFrame:
        """Records with unreadable fields, kept aside in quarantine mode."""
        return (
            self.committed_log()
            .where(F.col("outcome") == "invalid")
            .select("batch_id", *ARRIVAL, KEY, "bad_fields", "raw_data")
        )

    def register_views(self) -> None:
        """Make the tables available to SQL under their usual names."""
        self.property().createOrReplaceTempView("property")
        self.property_raw().createOrReplaceTempView("property_raw")

    # ---- compaction -----------------------------------------------------

    def _snapshot_path(self, table: str, version: int) -> str:
        return f"{self.root}/compacted/version={version}/{table}"

    def _raw_table(self, version: int) -> str:
        return f"parcelflow_raw_{hashlib.sha256(self.root.encode()).hexdigest()[:40]}_v{version}"

    def _snapshot_table(self, table: str, snapshot: Row) -> DataFrame:
        path = self._snapshot_path(table, snapshot["version"])
        if table == "property":
            return self.spark.read.schema(f"{PROMOTED_DDL}, loaded_at timestamp").parquet(path)
        name = self._raw_table(snapshot["version"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_RAW_DDL}) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {snapshot['n_buckets']} BUCKETS "
            f"LOCATION '{path}'"
        )
        return self.spark.table(name)

    def last_run(self) -> Row | None:
        """The latest run: its first batch, open link, watermark and whether it is done.

        A run is done when its last page has no link and no page before that
        one is missing; micro-batches may have taken pages out of order.
        """
        newest = self.commits().orderBy(F.desc("batch_id")).select("run_key", "run_no").first()
        if newest is None:
            return None
        commits = self.commits().where(F.col("run_key") == newest["run_key"])
        pages = self._of_run(self.ledger(), newest["run_key"])
        seen = pages.agg(F.countDistinct("page_no")).scalar()
        link = F.max_by("next_link", "last_page")
        return commits.agg(
            F.max("run_key").alias("run_key"),
            F.max("mode").alias("mode"),
            F.min(F.when(F.col("run_no") == newest["run_no"], F.col("batch_id"))).alias("first_batch"),
            F.max("batch_id").alias("last_batch"),
            (link.isNull() & (seen == F.max("last_page") + 1)).alias("done"),
            F.max("committed_at").alias("committed_at"),
        ).first()

    def _foldable_batch(self) -> int:
        """The last batch that may be folded: never part of an unfinished run."""
        run = self.last_run()
        if run is None:
            return -1
        return run["last_batch"] if run["done"] else run["first_batch"] - 1

    def _bytes(self, folder: str) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def _buckets(self, previous: Row | None) -> int:
        """Buckets of the payload table: one per ``BUCKET_BYTES`` of log and last snapshot, at least one per shuffle partition."""
        held = self._bytes(self.path("change_log"))
        if previous is not None:
            held += self._bytes(self._snapshot_path("property_raw", previous["version"]))
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-held // BUCKET_BYTES))

    def compact(
        self, layout: Sequence[str] = DEFAULT_LAYOUT, n_buckets: int | None = None
    ) -> int:
        """Fold finished runs into a new snapshot; return its version.

        The search half is laid out for searches on ``layout``. The payload
        half is bucketed by key: joining or upserting by key then shuffles
        only the other side.
        """
        through = self._foldable_batch()
        previous = self._snapshot()
        if through < 0 or (previous is not None and previous["through_batch"] >= through):
            return -1 if previous is None else previous["version"]
        version = 0 if previous is None else previous["version"] + 1
        buckets = n_buckets or self._buckets(previous)

        write_layout(self.property(), self._snapshot_path("property", version), layout)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._raw_table(version)}")
        self.property_raw().repartition(buckets, KEY).write.mode("overwrite").bucketBy(
            buckets, KEY
        ).sortBy(KEY).option("path", self._snapshot_path("property_raw", version)).saveAsTable(
            self._raw_table(version)
        )
        manifest = self.spark.createDataFrame(
            [(through, buckets, utc_now())], _DDL["snapshots"]
        )
        manifest.coalesce(1).write.mode("overwrite").parquet(
            self._partition("snapshots", version)
        )
        return version
