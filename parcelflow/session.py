"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set what the results depend on; call once per session.

    All times are UTC. Parquet timestamps are written as microseconds because
    the default INT96 form carries no min/max statistics, so a time filter on
    it can skip no row group. Generated methods above 8000 bytes of bytecode
    are not compiled by HotSpot, so Spark should split such code instead. The steps that type the promoted
    columns carry up to two hundred of them, more than Spark compiles by default.
    A store's batches and landed pages lie in a folder each; by default Spark lists
    them with one task a folder, which costs far more than the listing.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.codegen.maxFields", "400")
    listers = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listers))
    return spark


def local_session(cores: str = "*", app: str = "parcelflow") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    parallelism = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(parallelism))
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the call site of every column makes building them slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Local folders of sessions that run on this machine alone, by application.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the
    whole session runs on this machine; it goes when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="parcelflow-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, uniquely named folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding a set folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
