"""How far the sources of a language differ in their terms, by a three-dimensional cube of tasks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, text_bytes
from parcelflow.session import new_work_dir

#: Sources and terms of a block, on average; blocks are dealt by hashes.
SOURCES, TERMS = 32, 4096
#: Distinct (lang, source, term) counts that a task holds before it hands them on.
HELD = 1 << 19
#: Bytes of one text whose words are held at once.
_PART = 1 << 20

#: Lower-cased letters and non-ASCII bytes; all others as a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: sums over parts of the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, within) in counts.items():
                terms = pa.array(list(times), pa.binary()).cast(pa.string())
                columns = [pa.array([x] * len(times), pa.string()) for x in (lang, source)]
                columns += [terms, pa.array(list(times.values()), pa.int64()), pa.array([within[t] for t in times], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])
            counts.clear()

        held = 0
        for batch in by_bytes(batches, "text"):
            data, at = text_bytes(batch.column("text"))
            plain = data.tobytes().translate(_LETTERS)
            for lang, source, (start, stop) in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), pairwise(at.tolist()), strict=True):
                times, within = counts.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(times), set()
                while start < stop:
                    end = stop if stop - start <= _PART else plain.find(b" ", start + _PART, stop)
                    end = stop if end < 0 else end
                    part = plain[start:end].split()
                    times.update(part)
                    seen.update(part)
                    start = end
                within.update(seen)
                held += len(times) - before + (before == 0)
            if held > HELD:
                yield from handed_on()
                held = 0
        yield from handed_on()

    return docs.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)) without leaving 64 bits: three digits at a time."""
    below = total + 2 * kept
    rest = count + 2
    share = F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + F.call_function("div", rest, below)
        rest = rest % below
    return share + 1


def _shares(count: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The same for counts of several sources; ``below`` is total + 2 kept."""
    rest, share = count + 2, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // below
        rest = rest % below
    return share + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Partial divergences of the sources of two blocks over the terms of one."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("part_value", pa.int64())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    lang, a, b, _ = (x.as_py() for x in key)
    terms = pa.concat_arrays([t.column("term").combine_chunks() for t in (left, right)]).dictionary_encode()
    width = len(terms.dictionary)
    at = pc.fill_null(terms.indices, -1).to_numpy()
    sides = []
    for table, term in ((left, at[: left.num_rows]), (right, at[left.num_rows :])):
        names = table.column("source").combine_chunks().dictionary_encode()
        row = names.indices.to_numpy()
        counts = np.zeros((len(names.dictionary), width), np.int64)
        held = term >= 0
        counts[row[held], term[held]] = table.column("count").to_numpy()[held]
        below = np.zeros((len(names.dictionary), 1), np.int64)
        below[row, 0] = table.column("below").to_numpy()
        # A language without kept terms has nothing to divide by, and nothing to add up.
        below = np.maximum(below, 1)
        sides.append((names.dictionary, _shares(counts, below), _shares(np.zeros_like(below), below)[:, 0]))
    (names, p, p_absent), (others, q, q_absent) = sides
    absent = left.column("terms")[0].as_py() - width
    parts = np.stack([_apart(p[i], q).sum(axis=1) + absent * _apart(p_absent[i], q_absent) for i in range(len(names))])
    # The two sides of a block come in orders of their own: a source is told from the others by its name.
    mates = pc.index_in(names, value_set=others).to_numpy(zero_copy_only=False) if a == b else ()
    distinct = np.ones(parts.shape, bool)
    distinct[np.arange(len(mates)), mates] = False
    i, j = np.nonzero(distinct)
    ends = [names.take(pa.array(i)), others.take(pa.array(j))]
    value = parts[i, j]
    if a != b:
        ends, value = [pa.concat_arrays(ends), pa.concat_arrays(ends[::-1])], np.concatenate([value, value])
    return pa.table([pa.array([lang] * len(value), pa.string()), *ends, pa.array(value)], schema=schema)


def divergences(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: what sets the sources of each language apart.

    Terms are runs of letters and non-ASCII characters, A-Z as a-z. A language
    keeps the V terms that ``least`` of its documents hold. A source gives each
    kept term p = 1 + floor(10^9 (count + 2) / (N + 2V)) of its count, N being the
    sum of its counts of kept terms; the language does so too. Two shares differ
    by f = floor((p - q)^2 / (p + q)). Part ``pair``: for each other source of the
    language, the sum of f over all kept terms, 0 where there are none. Part
    ``term``: the ``top`` kept terms that the source holds and that have a greater
    share in it than in the language, by f. Ranks start from 1 in each source and
    part, greatest value first, then by item in UTF-8 order.

    Null text, lang and source are ''. Rows that repeat a document are documents
    of their own. A source whose texts hold no terms is a source as any other; one
    alone in its language has no pairs. An empty table gives no rows. Texts are
    read whole, in parts of about a megabyte; other columns are not read. Sums of
    counts must stay below 9 * 10^15 for shares to be exact.

    Words are counted in the tasks that read them. Sources and terms of a language
    are dealt into blocks; a task owns the cells of (source block, source block, term
    block) that fall to it, gets the two slices of counts that the cell needs, and
    the partial sums are added up along the term blocks.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "divergence")
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = _counts(texts).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    word = Window.partitionBy("lang", "term")
    kept = counted.select("lang", "source", "term", "count", F.sum("docs").over(word).alias("docs"), F.sum("count").over(word).alias("lang_count"))
    kept.where(F.col("docs") >= least).drop("docs").write.parquet(f"{folder}/kept")
    kept = spark.read.parquet(f"{folder}/kept")

    found = texts.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    found.join(own, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")).write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    terms = kept.groupBy("lang", "term").agg(F.first("lang_count").alias("lang_count"))
    terms = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_count").alias("lang_total"))
    langs = sources.groupBy("lang").agg(F.count("*").alias("n_sources")).join(terms, "lang", "left").na.fill(0, ["kept", "lang_total"])
    blocks = F.ceil(F.col("n_sources") / SOURCES).cast("int"), F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS)).cast("int")
    langs = langs.withColumns({"n_blocks": blocks[0], "n_cuts": blocks[1]})
    langs.write.parquet(f"{folder}/langs")
    langs = spark.read.parquet(f"{folder}/langs")

    cut = F.pmod(F.xxhash64("term"), F.col("n_cuts")).cast("int")
    cuts = kept.select("lang", "term").distinct().join(langs, "lang").groupBy("lang", cut.alias("cut")).agg(F.count("*").alias("terms"))
    sized = sources.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("n_blocks")).cast("int"))
    sized = sized.withColumn("below", F.col("total") + 2 * F.col("kept"))
    every = sized.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("n_cuts") - 1))).select("lang", "source", "block", "cut", "n_blocks", "below", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("count"))
    slices = kept.join(sized.select("lang", "source", "block", "n_blocks", "n_cuts", "below"), ["lang", "source"]).withColumn("cut", cut)
    slices = every.unionByName(slices.select(every.columns)).join(cuts, ["lang", "cut"], "left").na.fill(0, ["terms"])
    slices.write.parquet(f"{folder}/slices")
    content = ["lang", "cut", "source", "below", "terms", "term", "count"]
    left = spark.read.parquet(f"{folder}/slices").select(*content, F.col("block").alias("a"), F.explode(F.sequence(F.col("block"), F.col("n_blocks") - 1)).alias("b"))
    right = spark.read.parquet(f"{folder}/slices").select(*content, F.explode(F.sequence(F.lit(0), F.col("block"))).alias("a"), F.col("block").alias("b"))
    cube = ["lang", "a", "b", "cut"]
    cells = left.groupBy(*cube).cogroup(right.groupBy(*cube)).applyInArrow(_cell, "lang string, source string, item string, part_value long")
    pairs = cells.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("value"))
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(group).alias("rank"))

    shares = kept.join(sized.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    shares = shares.select("lang", "source", F.col("term").alias("item"), _share(F.col("count"), F.col("total"), F.col("kept")).alias("p"), _share(F.col("lang_count"), F.col("lang_total"), F.col("kept")).alias("q"))
    shares = shares.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    best = shares.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= top)
    return pairs.unionByName(best.withColumn("part", F.lit("term")).select(pairs.columns))
