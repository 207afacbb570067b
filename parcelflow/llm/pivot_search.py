"""Exact search for the largest inner products, with distances to pivots to rule candidates out."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import new_work_dir

#: Pivots besides the origin, and the vectors they are chosen from (a bound).
PIVOTS, SAMPLE = 31, 1024
#: Candidates of a block, blocks of a group, and queries of a block.
ROWS, GROUP_BLOCKS, QUERY_ROWS = 4096, 8, 1024
#: Candidates whose products are computed at once, in the order of their bounds.
STEP = 256
#: Shares into which the search for meetings of parts and groups is dealt.
_SALTS = 64
#: Share of the squared lengths that rounding may take from a bound.
_SLACK = 1e-9
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(column: str) -> Column:
    """Not null, and every component a finite number; an empty or zero vector is usable."""
    finite = F.forall(F.col(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def codes(values: np.ndarray) -> np.ndarray:
    """floor(1024 x), as doubles: they hold it exactly, as 1024 is a power of two."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values.astype(np.float64) * 1024), -np.finfo(np.float64).max, np.finfo(np.float64).max)


def products(x: np.ndarray, y: np.ndarray, most: float) -> np.ndarray:
    """Inner products of one coded vector with others, whose components are ``most`` at most, in whole numbers.

    Doubles where these hold every partial sum; 64-bit integers where those do;
    else integers of any size, held at the bounds of 64 bits.
    """
    own = np.abs(x).max(initial=0)
    if own * most * max(1, len(x)) < 2**53:
        return (y @ x).astype(np.int64)
    if own * most * len(x) < 2**62 and max(own, most) < 2**62:
        return y.astype(np.int64) @ x.astype(np.int64)
    whole = [int(v) for v in x]
    return np.array([min(_MOST, max(_LEAST, sum(a * int(b) for a, b in zip(whole, row, strict=True)))) for row in y], np.int64)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, without overflow."""
    top = np.abs(x).max(axis=1, initial=0)
    scale = np.where(top > 0, top, 1)[:, None]
    with np.errstate(over="ignore"):
        return np.minimum(np.sqrt(((x / scale) ** 2).sum(axis=1)) * scale[:, 0], np.finfo(np.float64).max)


def spread_out(vectors: np.ndarray, count: int) -> np.ndarray:
    """The origin and up to ``count`` of the vectors, each the farthest from those before; padded with the origin."""
    chosen = [np.zeros(vectors.shape[1])]
    near = _lengths(vectors)
    while len(chosen) <= count and near.max(initial=0) > 0:
        chosen.append(vectors[int(near.argmax())])
        near = np.minimum(near, _lengths(vectors - chosen[-1]))
    return np.stack(chosen + [chosen[0]] * (count + 1 - len(chosen)))


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Pivots for each dimension among ``SAMPLE`` vectors; another dimension has the origin alone."""
    sample = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(SAMPLE).select("embedding").toLocalIterator()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row.embedding), []).append(row.embedding)
    return {dim: spread_out(codes(np.array(v).reshape(len(v), dim)), PIVOTS) for dim, v in by_dim.items()}


def _with_distances(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, embedding, dim, the nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            cell, reach = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                apart = _distances(codes(_matrix(lists, at, dim)), pivots.get(dim))
                cell[at], reach[at] = apart.argmin(axis=1), apart.min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists, pa.array(sizes, pa.int32()), pa.array(cell), pa.array(reach)], ["vec_id", "embedding", "dim", "cell", "reach"])

    return rows.mapInArrow(run, f"vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}, dim int, cell int, reach double")


def _matrix(lists: pa.Array, at: np.ndarray, dim: int) -> np.ndarray:
    return lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)


def _distances(x: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    """Distances of coded vectors to the pivots, a column for each."""
    if pivots is None:
        return np.repeat(_lengths(x)[:, None], PIVOTS + 1, axis=1)
    out = np.empty((len(x), len(pivots)))
    for p, pivot in enumerate(pivots):
        out[:, p] = _lengths(x - pivot)
    return out


_BLOCK = "block long, dim int, size int, nearest array<double>, farthest array<double>, ids binary, vectors binary, apart binary"


def _blocks(rows: DataFrame, pivots: dict[int, np.ndarray], size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors of one dimension as they follow each other, with their pivot table.

    ``nearest`` and ``farthest`` are a block's least and greatest distance to each pivot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, parts = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            made += 1
            apart = _distances(codes(parts), pivots.get(dim))
            row = {"block": base + made, "dim": dim, "size": len(ids), "nearest": apart.min(axis=0).tolist(), "farthest": apart.max(axis=0).tolist()}
            row |= {"ids": ids.astype(np.int64).tobytes(), "vectors": np.ascontiguousarray(parts).tobytes(), "apart": apart.tobytes()}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("size", pa.int32()), *((c, pa.list_(pa.float64())) for c in ("nearest", "farthest")), *((c, pa.binary()) for c in ("ids", "vectors", "apart"))])
        for batch in batches:
            ids, lists = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("embedding")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                while len(at):
                    room = size - sum(len(i) for i, _ in held.get(dim, []))
                    held.setdefault(dim, []).append((ids[at[:room]], _matrix(lists, at[:room], dim)))
                    at = at[room:]
                    if sum(len(i) for i, _ in held[dim]) == size:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return rows.mapInArrow(run, _BLOCK)


@dataclass
class Block:
    """Vectors with their codes, lengths and pivot table."""

    ids: np.ndarray
    codes: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, parts: list[dict], kind: str) -> Block:
        dim = parts[0]["dim"]
        ids = np.concatenate([np.frombuffer(p["ids"], np.int64) for p in parts])
        vectors = np.concatenate([np.frombuffer(p["vectors"], kind).reshape(-1, dim) if dim else np.zeros((p["size"], 0)) for p in parts])
        return cls(ids, codes(vectors), np.concatenate([np.frombuffer(p["apart"]).reshape(-1, PIVOTS + 1) for p in parts]))

    def __post_init__(self) -> None:
        self.apart = np.asfortranarray(self.apart)  # one pivot's distances after the other
        self.most = np.abs(self.codes).max(initial=0)
        with np.errstate(over="ignore"):
            self.squares = self.apart[:, 0] ** 2

    def search(self, query: np.ndarray, own: int, apart: np.ndarray, k: int, least: float) -> tuple[list[tuple[int, int]], int]:
        """The ``k`` best (score, -id) whose score is ``least`` or more, and the products computed.

        |x - y| is at least the difference of their distances to any pivot, and
        2 xy = |x|^2 + |y|^2 - |x - y|^2; so each pivot bounds the product from above, and
        a candidate is out where any bound falls below the score to reach. The rest
        are evaluated from the greatest bound on, until the next bound is below
        the ``k``-th score found: no other candidate can enter. Steps grow, since
        the first ones raise that score most.
        """
        with np.errstate(over="ignore", invalid="ignore"):
            ends = self.squares + apart[0] ** 2
            top = ends * (1 + 2 * _SLACK) + 2
            alive, gaps = np.arange(len(ends)), np.zeros(len(ends))
            for p in range(PIVOTS + 1):
                column = self.apart[:, p]
                gap = np.abs((column if len(alive) == len(column) else column[alive]) - apart[p])
                gaps = np.maximum(gaps, gap)
                if p % 4 == 3:
                    keep = ~(top - gaps * gaps < 2 * least)
                    if keep.sum() < 0.75 * len(keep):
                        alive, gaps, top = alive[keep], gaps[keep], top[keep]
            bound = (top - gaps * gaps) / 2
            bound[np.isnan(bound)] = np.inf
        keep = (bound >= least) & (self.ids[alive] != own)
        alive, bound = alive[keep], bound[keep]
        order = np.argsort(-bound, kind="stable")
        alive, bound = alive[order], bound[order]
        best: list[tuple[int, int]] = []
        done, step = 0, STEP
        while done < len(alive) and bound[done] >= least:
            at = alive[done : done + step]
            score = products(query, self.codes[at], self.most)
            good = np.flatnonzero(score >= least)
            if len(best) == k and len(good):
                good = good[score[good] >= best[-1][0]]
            best = sorted({*best, *zip(score[good].tolist(), (-self.ids[at[good]]).tolist(), strict=True)}, reverse=True)[:k]
            if len(best) == k:
                least = max(least, best[-1][0])
            done, step = done + len(at), 2 * step
        return best, done


_QUERY = pa.schema([("query", pa.int64()), ("dim", pa.int32()), ("codes", pa.list_(pa.float64())), ("own", pa.list_(pa.float64())), ("least", pa.int64()), ("origin", pa.int64())])
_PART = pa.schema([("part", pa.int64()), ("dim", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("floor", pa.int64()), ("queries", pa.binary()), ("codes", pa.binary()), ("own", pa.binary()), ("least", pa.binary())])
_FOUND = "query_id long, vec_id long, score long, compared long, products long"


def _seeds(blocks: DataFrame, kind: str, k: int, every: int) -> DataFrame:
    """Queries with their distances to the pivots and the ``k``-th score among the rows of their own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, found = Block.of([row], kind), []
                for at in np.flatnonzero(block.ids % every == 0).tolist():
                    best, _ = block.search(block.codes[at], int(block.ids[at]), block.apart[at], k, -math.inf)
                    least = best[-1][0] if len(best) == k else _LEAST
                    found.append({"query": int(block.ids[at]), "dim": row["dim"], "codes": block.codes[at].tolist(), "own": block.apart[at].tolist(), "least": least, "origin": row["block"]})
                yield pa.RecordBatch.from_pylist(found, _QUERY)

    return blocks.mapInArrow(run, "query long, dim int, codes array<double>, own array<double>, least long, origin long")


def _parts(queries: DataFrame) -> DataFrame:
    """Blocks of up to ``QUERY_ROWS`` queries as they follow each other, with the ranges of their distances and their least bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[dict]] = {}

        def part(rows: list[dict]) -> pa.RecordBatch:
            nonlocal made
            made += 1
            own, least = np.array([r["own"] for r in rows]), np.array([r["least"] for r in rows], np.int64)
            row = {"part": base + made, "dim": rows[0]["dim"], "low": own.min(axis=0).tolist(), "high": own.max(axis=0).tolist(), "floor": int(least.min())}
            row |= {"queries": np.array([r["query"] for r in rows], np.int64).tobytes(), "codes": np.array([r["codes"] for r in rows], np.float64).tobytes(), "own": own.tobytes(), "least": least.tobytes()}
            return pa.RecordBatch.from_pylist([row], _PART)

        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["dim"], []).append(row)
                if len(held[row["dim"]]) == QUERY_ROWS:
                    yield part(held.pop(row["dim"]))
        for rows in held.values():
            yield part(rows)

    return queries.mapInArrow(run, "part long, dim int, low array<double>, high array<double>, floor long, queries binary, codes binary, own binary, least binary")


def _may_hold() -> Column:
    """Whether the distances of a part of queries and of a group allow a score of the part's ``floor``."""
    apart = F.greatest(*(F.array_max(F.zip_with(x, y, lambda a, b: a - b)) for x, y in (("low", "farthest"), ("nearest", "high"))), F.lit(0.0))
    ends = F.col("high")[0] * F.col("high")[0] + F.col("farthest")[0] * F.col("farthest")[0]
    return ((ends - apart * apart) / 2 + ends * _SLACK + 1 >= F.col("floor")) | (F.col("floor") == _LEAST)


def _compare(kind: str, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Search the candidates of each group for all queries sent to it; a group's candidates come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, at = [], None, None
        for batch in batches:
            for row in (r for n in range(batch.num_rows) for r in batch.slice(n, 1).to_pylist()):
                if (row["group"], row["dim"]) != at:
                    held, block, at = [], None, (row["group"], row["dim"])
                if row["ids"] is not None:
                    held.append(row)
                    continue
                if block is None:
                    block, held = Block.of(held, kind), []
                ids, least = (np.frombuffer(row[c], np.int64) for c in ("queries", "least"))
                asked, own = np.frombuffer(row["codes"]).reshape(len(ids), row["dim"]), np.frombuffer(row["own"]).reshape(len(ids), -1)
                found = []
                for n, query in enumerate(ids.tolist()):
                    best, done = block.search(asked[n], query, own[n], k, int(least[n]) if least[n] > _LEAST else -math.inf)
                    found += [(query, -i, score, None, None) for score, i in best] + [(query, None, None, len(block.ids), done)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["query_id", "vec_id", "score", "compared", "products"])

    return run


def top_products(vectors: DataFrame, k: int = 10, every: int = 100, statistics: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest products of each query, exactly.

    Each component x counts as floor(1024 x); scores are inner products of these
    whole numbers. Queries are the rows whose vec_id is divisible by ``every``;
    candidates are all rows but those with the query's own vec_id, compared where they have
    the query's dimension. Ties go to the smaller vec_id. Rows without a vec_id
    and vectors that are null or hold null or non-finite components take no part;
    zero and empty vectors do. A row that is repeated counts once; different
    vectors of one vec_id are each a row. A query with fewer candidates gets them
    all; an empty table gives no rows. Scores beyond 64 bits are held at the
    bounds. Other columns are not read. With ``statistics`` the result is
    compared, products: the pairs that met, and the products computed for them.

    Vectors are dealt into ranges by their nearest pivot and its distance and written as
    blocks with their distances to all pivots. A query's first bound comes from
    its own block. Blocks of queries are sent only to those candidate blocks
    where the ranges of distances allow a score that is high enough; there the
    candidates are held once and the queries stream past.
    """
    spark = vectors.sparkSession
    kind = "f8" if "double" in vectors.schema["embedding"].dataType.simpleString() else "f4"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null").where(usable("embedding"))
    folder = new_work_dir(spark, "pivots")
    pivots = _pivots(rows)
    placed = _with_distances(rows, pivots)
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    ranges = max(1, -(-placed.count() // (ROWS * GROUP_BLOCKS)))
    near = ["dim", "cell", "reach", "vec_id"]
    _blocks(placed.repartitionByRange(ranges, *near).sortWithinPartitions(*near), pivots, ROWS).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")

    _seeds(blocks, kind, k, every).distinct().write.parquet(f"{folder}/queries")
    queries = spark.read.parquet(f"{folder}/queries")
    cuts = max(1, -(-queries.count() // QUERY_ROWS))
    _parts(queries.repartitionByRange(cuts, "dim", "origin", "query")).write.parquet(f"{folder}/parts")
    parts = spark.read.parquet(f"{folder}/parts")

    blocks = blocks.withColumn("group", F.shiftright("block", 32))
    ranges_of = [F.array(*(f(F.col(c)[p]) for p in range(PIVOTS + 1))).alias(c) for f, c in ((F.min, "nearest"), (F.max, "farthest"))]
    groups = blocks.groupBy("group", "dim").agg(*ranges_of).withColumn("salt", F.pmod(F.xxhash64("group"), F.lit(_SALTS)).cast("int"))
    near = parts.select("part", "dim", "low", "high", "floor", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    near.join(groups, ["dim", "salt"]).where(_may_hold()).select("part", "group", "dim").write.parquet(f"{folder}/meetings")
    meetings = spark.read.parquet(f"{folder}/meetings")
    sent = parts.select("part", "queries", "codes", "own", "least").join(meetings, "part")
    met = blocks.select("group", "dim", "block", "size", "ids", "vectors", "apart").join(meetings.select("group", "dim").distinct(), ["group", "dim"], "left_semi")
    rows = met.unionByName(sent, allowMissingColumns=True).repartition("group", "dim").sortWithinPartitions("group", "dim", F.col("block").asc_nulls_last(), "part")
    found = rows.mapInArrow(_compare(kind, k), _FOUND)
    if statistics:
        return found.agg(F.sum("compared").alias("compared"), F.sum("products").alias("products"))
    found = found.where("vec_id is not null").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
