"""Nearest neighbours by a block matrix join: int8 products with error bounds, then exact scores."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import new_work_dir

#: Vectors of a block of queries and of candidates; candidate blocks that one group holds.
QUERY_ROWS, CANDIDATE_ROWS, GROUP_BLOCKS = 1024, 4096, 4

#: More than products of whole vectors lose where single terms round to 0.
_TINY = 1e-300

_BLOCK = "block long, dim int, ids binary, vectors binary"


def usable(column: str) -> Column:
    """Neither null nor zero, and every component a finite number."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def _blocks(vectors: DataFrame, rows: int, copies: int) -> DataFrame:
    """Vectors in blocks, each of one dimension, sorted by id.

    Of equal vectors a block keeps the ``copies`` with the least ids: a larger
    one cannot come among the nearest, as ties go to smaller ids.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[list, list]] = {}
        made = 0

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, parts = (np.concatenate(x) for x in held.pop(dim))
            parts = np.ascontiguousarray(parts)
            _, kind = np.unique(parts.view(np.dtype((np.void, parts.itemsize * dim))).ravel(), return_inverse=True)
            order = np.lexsort((ids, kind))
            ids, kind, parts = ids[order], kind[order], parts[order]
            new_kind = np.diff(kind, prepend=-1) != 0
            once = new_kind | (np.diff(ids, prepend=0) != 0)
            place = np.cumsum(once) - np.maximum.accumulate(np.where(new_kind, np.cumsum(once), 0))
            keep = once & (place < copies)
            made += 1
            columns = [base + made - 1], [dim], [ids[keep].tobytes()], [parts[keep].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["block", "dim", "ids", "vectors"])

        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            lists = batch.column("embedding")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                values = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                for k in range(0, len(at), rows):
                    held.setdefault(dim, ([], []))
                    held[dim][0].append(ids[at[k : k + rows]])
                    held[dim][1].append(values[k : k + rows])
                    if sum(map(len, held[dim][0])) >= rows:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return vectors.mapInArrow(build, _BLOCK)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, also where squares would leave the range of doubles; never too small."""
    top = np.abs(x).max(axis=1)
    with np.errstate(over="ignore"):
        return np.sqrt(((x / np.where(top > 0, top, 1)[:, None]) ** 2).sum(axis=1)) * top * (1 + 1e-12)


@dataclass
class Tile:
    """A block with its int8 codes: a vector is scale * codes + rest, of known lengths."""

    ids: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    scale: np.ndarray
    length: np.ndarray
    coded: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, dim: int, ids: bytes, vectors: bytes, kind: str) -> Tile:
        x = np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64)
        scale = np.abs(x).max(axis=1) / 127  # 0 for vectors too small to code, whose rest is all
        codes = np.rint(x / np.where(scale > 0, scale, np.inf)[:, None]).clip(-127, 127).astype(np.int8)
        back = codes * scale[:, None]
        return cls(np.frombuffer(ids, np.int64), x, codes, scale, *(_lengths(v) for v in (x, back, x - back)))


def _survivors(queries: Tile, candidates: Tile, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that can be among a query's ``k`` nearest.

    Products of codes are whole numbers, which single precision holds exactly up
    to 1,040 dimensions. They differ from the true product by no more than the
    lengths of what the codes leave out allow. A pair whose bound leaves the
    range of doubles survives, and so does one that rounding to 0 may hide.
    """
    kind = np.float32 if queries.codes.shape[1] <= 1040 else np.float64
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        about = (queries.codes.astype(kind) @ candidates.codes.T.astype(kind)).astype(np.float64) * queries.scale[:, None] * candidates.scale
        off = queries.coded[:, None] * candidates.rest + queries.rest[:, None] * candidates.length
        off += 1e-12 * queries.length[:, None] * candidates.length + _TINY
        own = queries.ids[:, None] == candidates.ids
        if candidates.ids.size > k:
            low = np.where(own | ~np.isfinite(about) | ~np.isfinite(off), -np.inf, about - off)
            least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
        return np.nonzero(~(about + off < least[:, None]) & ~own)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k] * y[:, k]
    return out


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are
    all rows but those with the query's own vec_id, compared where they have the
    query's dimension. Scores are in double precision; ties go to the smaller
    vec_id. Rows without a vec_id and vectors that are null, empty or zero, or
    hold null or non-finite components, take no part. A row that is repeated
    counts once. A query with fewer candidates gets them all; an empty table
    gives no rows. Other columns are not read.

    Blocks of queries meet blocks of candidates in a join on their groups: no
    block is broadcast, and a task holds two blocks at a time, besides the
    candidate blocks of a group, which the join keeps or spills. It is a merge
    join, told by a hint: Spark does not see that the query blocks are copied
    for every group and would send all copies through the driver. Such a join
    gives all the candidates of a group for one block of queries after another,
    so the tiles need no sort.
    """
    spark = vectors.sparkSession
    kind = "f8" if "double" in vectors.schema["embedding"].dataType.simpleString() else "f4"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null").where(usable("embedding"))
    folder = new_work_dir(spark, "blocks")
    _blocks(rows.where(F.col("vec_id") % every == 0), QUERY_ROWS, QUERY_ROWS).write.parquet(f"{folder}/queries")
    _blocks(rows, CANDIDATE_ROWS, k + 1).write.parquet(f"{folder}/candidates")
    queries, candidates = spark.read.parquet(f"{folder}/queries"), spark.read.parquet(f"{folder}/candidates")
    groups = max(1, -(-candidates.count() // GROUP_BLOCKS))
    left = queries.select(F.col("block").alias("query"), "dim", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    left = left.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = candidates.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tile, heaps = None, None, []

        def best() -> pa.RecordBatch:
            found = [(q, -negative, score) for q, heap in zip(tile.ids.tolist(), heaps, strict=True) for score, negative in heap]
            return pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                query, dim, query_ids, query_vectors, ids, parts = (batch.column(c)[row] for c in ("query", "dim", "query_ids", "query_vectors", "ids", "vectors"))
                dim = dim.as_py()
                if query.as_py() != held:
                    if held is not None:
                        yield best()
                    held, tile = query.as_py(), Tile.of(dim, query_ids.as_buffer(), query_vectors.as_buffer(), kind)
                    heaps = [[] for _ in tile.ids]
                other = Tile.of(dim, ids.as_buffer(), parts.as_buffer(), kind)
                least = np.array([heap[0][0] if len(heap) == k else -np.inf for heap in heaps])
                for low in range(0, len(tile.ids), 256):
                    part = Tile(*(getattr(tile, f)[low : low + 256] for f in Tile.__dataclass_fields__))
                    q, c = _survivors(part, other, least[low : low + 256], k)
                    for at, score, vec_id in zip((q + low).tolist(), _products(part.vectors[q], other.vectors[c]).tolist(), other.ids[c].tolist(), strict=True):
                        heap, pair = heaps[at], (score, -vec_id)
                        if len(heap) < k:
                            if pair not in heap:
                                heapq.heappush(heap, pair)
                        elif pair > heap[0] and pair not in heap:
                            heapq.heapreplace(heap, pair)
        if held is not None:
            yield best()

    # More places than groups, so that tasks have one or two: few groups dealt over few tasks by hash meet by chance.
    places = max(groups, min(4 * groups, 2000))
    left, right = (side.repartition(places, "group", "dim") for side in (left, right))
    tiles = left.hint("merge").join(right, ["group", "dim"]).select("query", "dim", "query_ids", "query_vectors", "ids", "vectors")
    found = tiles.mapInArrow(compare, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
