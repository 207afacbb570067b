"""The last saved state of any number of feeds, kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators.upsert import latest_per_key


def follow_states(
    saves: DataFrame, folder: str, feed: str = "feed", order: Sequence[str] = ("batch_id",)
) -> None:
    """Fold every waiting save of a stream into its feed's state, then return.

    The state store keeps one row per feed; ``order`` says which of two saves is the
    later, wherever and whenever they arrive. A micro-batch writes the feeds it
    changed as a folder of its own, which a repeated batch writes over, and the
    checkpoint below ``folder`` carries the states over a restart. A feed that
    fills a third of a batch costs one row per map task.
    """
    rest = [c for c in saves.columns if c not in (feed, *order)]
    last = F.max_by(F.struct(*order, *rest), F.struct(*order))
    states = saves.groupBy(feed).agg(last.alias("_last")).select(feed, "_last.*")

    def write(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changed/epoch={epoch}")

    (
        states.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_states(spark: SparkSession, folder: str, schema: str, feed: str = "feed") -> DataFrame:
    """Each feed's state: as its latest change left it."""
    changed = spark.read.schema(f"{schema}, epoch bigint").parquet(f"{folder}/changed")
    return latest_per_key(changed, feed, ["epoch"]).drop("epoch")
