"""Keyed upsert: the last arrival of a key replaces the whole row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.schema import ARRIVAL, KEY, MODIFIED


def match_key(key: str = KEY, collation: str | None = None) -> Column:
    """The key as it is compared: exactly, or under a collation.

    ``UNICODE_CI_AI_RTRIM`` ignores case, accents and trailing blanks.
    """
    column = F.col(key)
    return F.collate(column, collation) if collation else column


def latest_per_key(
    df: DataFrame,
    key: str = KEY,
    order: Sequence[str] = ARRIVAL,
    newest_wins: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """One whole row per key: the last to arrive.

    ``row_number() = 1`` lets Spark cut every group to one row before the
    shuffle (WindowGroupLimit), so a key that fills a third of the input costs
    one row per map task downstream. ``newest_wins`` puts the modification
    time ahead of arrival.
    """
    ranks = ([MODIFIED] if newest_wins else []) + list(order)
    window = Window.partitionBy(match_key(key, collation)).orderBy(
        *[F.col(c).desc_nulls_last() for c in ranks]
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_wide_rows(
    df: DataFrame,
    key: str = KEY,
    order: Sequence[str] = ARRIVAL,
    newest_wins: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """``latest_per_key`` for rows that carry a large payload.

    Ranking sorts its input on both sides of the shuffle. Here only the key
    and the place of arrival are ranked; the payload moves once, in a semi
    join on the place, which is unique and so cannot be skewed. The join is a
    merge, which can spill: there are as many places as keys, and Spark takes
    them for few, by their share of the compressed files, and broadcasts them.
    """
    narrow = df.select(key, *([MODIFIED] if newest_wins else []), *order)
    places = latest_per_key(narrow, key, order, newest_wins, collation).select(*order)
    return df.join(places.hint("merge"), list(order), "left_semi")


def _same_key(left: str, right: str, key: str, collation: str | None) -> Column:
    a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
    return F.collate(a, collation) == F.collate(b, collation) if collation else a == b


def replace_rows(
    base: DataFrame, winners: DataFrame, key: str = KEY, collation: str | None = None
) -> DataFrame:
    """``base`` with ``winners`` (one row per key) in place of the same keys."""
    kept = base.alias("b").join(
        winners.select(key).alias("w"), _same_key("b", "w", key, collation), "left_anti"
    )
    return kept.unionByName(winners)


def not_older(
    winners: DataFrame, times: DataFrame, key: str = KEY, collation: str | None = None
) -> DataFrame:
    """``winners`` without those older than the time that ``times`` holds for the key.

    A row without a time is older than any; of equal times the winner's counts.
    ``times`` holds every key and is never broadcast.
    """
    held = times.select(key, F.col(MODIFIED).alias("_held")).hint("merge").alias("b")
    later = F.col("_held").isNull() | (F.col(f"w.{MODIFIED}") >= F.col("_held"))
    return winners.alias("w").join(held, _same_key("w", "b", key, collation), "left").where(later).select("w.*")


def apply_batch(
    base: DataFrame,
    batch: DataFrame,
    key: str = KEY,
    order: Sequence[str] = ARRIVAL,
    newest_wins: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """``base`` (one row per key) after the upsert of ``batch``.

    Every column is overwritten, NULLs included. Only the batch is ranked;
    the base passes through one anti join, which Spark broadcasts while the
    batch's keys stay under its size limit. With ``newest_wins`` rows of both
    sides compete, so both are ranked.
    """
    columns = base.columns
    if newest_wins:
        both = base.unionByName(batch.select(*columns))
        return latest_per_key(both, key, order, True, collation)
    winners = latest_per_key(batch, key, order, collation=collation)
    return replace_rows(base, winners.select(*columns), key, collation)


def classify_batch(
    base: DataFrame, batch: DataFrame, key: str = KEY, order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The batch's winning rows, each marked ``inserted`` or ``updated``."""
    winners = latest_per_key(batch, key, order)
    existing = base.select(F.col(key), F.lit(True).alias("_known"))
    return (
        winners.join(existing, key, "left")
        .withColumn("action", F.when(F.col("_known"), "updated").otherwise("inserted"))
        .drop("_known")
    )


def state_difference(
    left: DataFrame, right: DataFrame, ignore: Sequence[str] = ("loaded_at",)
) -> DataFrame:
    """Rows held by only one of two states, load time aside; empty when equal.

    Both states are read once and meet in one shuffle: a row counts up on the
    left and down on the right.
    """
    columns = [c for c in left.columns if c not in ignore]
    a, b = left.select(*columns, F.lit(1).alias("_n")), right.select(*columns, F.lit(-1).alias("_n"))
    return (
        a.unionByName(b)
        .groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .where("_n != 0")
        .select(
            *columns,
            F.explode(
                F.array_repeat(F.when(F.col("_n") > 0, "left").otherwise("right"), F.abs("_n").cast("int"))
            ).alias("side"),
        )
    )


def _digest(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of a row that tells a NULL from its absence in the hash."""
    gaps = F.array(*[F.col(c).isNull() for c in columns])
    return F.xxhash64(F.lit(seed), gaps, *[F.col(c) for c in columns])


def bucket_digests(
    state: DataFrame, key: str = KEY, ignore: Sequence[str] = ("loaded_at",), buckets: int = 4096
) -> DataFrame:
    """One row per bucket of keys: the number of its rows and order-free sums of their hashes.

    Sums keep repeated rows apart, which exclusive-or would cancel. Two
    independent hashes make equal sums of unequal buckets a matter of 2^-128.
    """
    columns = sorted(c for c in state.columns if c not in ignore)
    exact = [F.sum(_digest(columns, seed).cast("decimal(20,0)")).alias(f"digest{seed}") for seed in (0, 1)]
    return state.groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count("*").alias("n_rows"), *exact)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(buckets)).cast("int")


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Numbers of the buckets whose digests differ, given those of two states."""
    names = ["n_rows", "digest0", "digest1"]
    a, b = (df.select("bucket", F.struct(*names).alias(side)) for df, side in ((left, "a"), (right, "b")))
    return a.join(b, "bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def digested_difference(
    left: DataFrame,
    right: DataFrame,
    key: str = KEY,
    ignore: Sequence[str] = ("loaded_at",),
    buckets: int = 4096,
) -> DataFrame:
    """:func:`state_difference` of two states that are mostly or wholly alike.

    First only digests meet: ``buckets`` rows a state and task at most. Rows are
    read again and shuffled only where a bucket differs; with none, the second pass
    meets an empty side and reads nothing. Columns count by name.
    """
    found = differing_buckets(*(bucket_digests(df, key, ignore, buckets) for df in (left, right)))
    # At most ``buckets`` numbers, whatever the states hold.
    differing = F.broadcast(found)

    def suspects(state: DataFrame) -> DataFrame:
        placed = state.withColumn("bucket", _bucket(key, buckets))
        return placed.join(differing, "bucket", "left_semi").drop("bucket")

    return state_difference(suspects(left), suspects(right), ignore)
