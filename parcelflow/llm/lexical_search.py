"""Ranked lexical search by bag deduplication: documents that items cannot tell apart are scored once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from parcelflow.llm.columns import by_bytes, text_bytes
from parcelflow.llm.wordhash import WORDS_ONLY
from parcelflow.session import new_work_dir

#: Bytes of item terms that a task may hold; a larger vocabulary is joined instead.
VOCABULARY_BYTES = 8 << 20
#: Classes and item terms that meet in one group; terms weighed at once in it.
CLASSES, ITEM_TERMS, TERMS_AT_ONCE = 4096, 32768, 2048
#: Bytes of one text whose words are held at once.
_PART = 1 << 20

_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(column: str) -> Column:
    """The terms of a text in order: runs of digits, letters and non-ASCII characters, A-Z as a-z."""
    plain = F.translate(F.coalesce(F.col(column), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(plain, _BETWEEN), lambda w: w != "")


def _parts(plain: bytes, start: int, stop: int) -> Iterator[list[bytes]]:
    """The words of ``plain[start:stop]``, where every byte between words is a space, a part at a time."""
    while start < stop:
        end = stop if stop - start <= _PART else plain.find(b" ", start + _PART, stop)
        end = stop if end < 0 else end
        yield plain[start:end].split()
        start = end


def _bags(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """doc_id, n and the known terms of each text with their counts, by term number."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in by_bytes(batches, "text"):
            data, at = text_bytes(batch.column("text"))
            plain = data.tobytes().translate(WORDS_ONLY)
            totals, flat, sizes = [], [], [0]
            for start, stop in pairwise(at.tolist()):
                total, found = 0, Counter()
                for part in _parts(plain, start, stop):
                    total += len(part)
                    found.update(filter(None, map(get, part)))
                totals.append(total)
                flat.extend(sorted(found.items()))
                sizes.append(len(flat))
            pairs = np.array(flat, np.int64).reshape(-1, 2)
            bags = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "tf"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(totals, pa.int64()), bags], ["doc_id", "n", "bag"])

    return docs.mapInArrow(run, f"doc_id {kind}, n long, bag array<struct<id: long, tf: long>>")


def _bags_joined(docs: DataFrame, vocabulary: DataFrame, folder: str) -> DataFrame:
    """The same as :func:`_bags` for a vocabulary of any size: words meet it in a join."""
    numbered = docs.select("doc_id", words("text").alias("words"), F.monotonically_increasing_id().alias("row"))
    numbered.write.parquet(f"{folder}/words")
    rows = docs.sparkSession.read.parquet(f"{folder}/words")
    counted = rows.select("row", F.explode("words").alias("term")).groupBy("row", "term").agg(F.count("*").alias("tf"))
    bags = counted.join(vocabulary, "term").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("id", "tf"))).alias("bag"))
    return rows.join(bags, "row", "left").select("doc_id", F.size("words").cast("long").alias("n"), F.coalesce("bag", F.array().cast("array<struct<id:bigint,tf:bigint>>")).alias("bag"))


def _best(classes: pa.Table, items: pa.Table, k: int, schema: pa.Schema) -> pa.Table:
    """The ``k`` best documents of a group's classes for each of its items."""
    if not classes.num_rows or not items.num_rows:
        return schema.empty_table()
    bags, members = (classes.column(c).combine_chunks() for c in ("bag", "members"))
    row = np.repeat(np.arange(len(bags)), bags.value_lengths().to_numpy())
    ids, tfs = (bags.flatten().field(f).to_numpy() for f in ("id", "tf"))
    m = classes.column("m").to_numpy()
    part = 1_000_000_000 * tfs // (1000 * tfs + 12 * m[row])
    order = np.argsort(ids, kind="stable")
    ids, row, part = ids[order], row[order], part[order]

    item, term, weight = (items.column(c).to_numpy() for c in ("item", "id", "weight"))
    order = np.lexsort((term, item))
    item, term, weight = item[order], term[order], weight[order]
    own, at, which = np.unique(item, return_index=True, return_inverse=True)
    scores = np.zeros((len(own), len(bags)), np.int64)
    used = np.unique(term)
    for low in range(0, len(used), TERMS_AT_ONCE):
        some = used[low : low + TERMS_AT_ONCE]
        a, b = np.searchsorted(ids, [some[0], some[-1] + 1])
        place = np.searchsorted(some, ids[a:b])
        held = some[place] == ids[a:b]
        dense = np.zeros((len(some), len(bags)), np.int64)
        dense[place[held], row[a:b][held]] = part[a:b][held]
        here = np.flatnonzero((term >= some[0]) & (term <= some[-1]))
        for i in np.unique(which[here]).tolist():
            mine = here[which[here] == i]
            scores[i] += weight[mine] @ dense[np.searchsorted(some, term[mine])]

    sizes = members.value_lengths().to_numpy()
    starts = np.cumsum(sizes) - sizes
    listed = members.flatten().field("doc_id")
    out_item, out_doc, out_score = [], [], []
    for i in range(len(own)):
        good = np.flatnonzero(scores[i] > 0)
        good = good[np.argsort(-scores[i][good], kind="stable")]
        reached = np.cumsum(sizes[good])
        last = np.searchsorted(reached, k)
        if last < len(good):
            good = good[: np.searchsorted(-scores[i][good], -scores[i][good[last]], "right")]
        at_doc = np.concatenate([np.arange(starts[c], starts[c] + sizes[c]) for c in good]) if len(good) else np.zeros(0, np.int64)
        docs, score = listed.take(pa.array(at_doc)), np.repeat(scores[i][good], sizes[good])
        ranked = pa.table({"score": score, "doc_id": docs}).sort_by([("score", "descending"), ("doc_id", "ascending")]).slice(0, k)
        out_item.append(np.full(ranked.num_rows, own[i]))
        out_doc.extend(ranked.column("doc_id").chunks)
        out_score.append(ranked.column("score").to_numpy())
    number = np.concatenate(out_item)
    item_ids = items.column("item_id").combine_chunks().take(pa.array(order[at][np.searchsorted(own, number)]))
    columns = [pa.array(number), item_ids, pa.chunked_array(out_doc, schema.field("doc_id").type), pa.array(np.concatenate(out_score))]
    return pa.table(columns, schema=schema)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents that score best for each item.

    Terms, weights and scores are whole numbers. A term weighs
    w = floor(1000 ln((2N + 2) / (2 df + 1))), a document has the length factor
    m = 75 + 25 n N div L, and scores the sum over the item's terms, repeats
    included, of w (10^9 tf div (1000 tf + 12 m)). N counts the documents with a
    term, L all their terms, n a document's own, df the documents with a term.
    Scores of 0 are not returned; equal scores go by doc_id, those without an id last.

    A null text is empty: such a document is in no result and not in N, such an
    item has no rows. Rows that repeat an item count once; different texts under
    one item_id are ranked each on its own. Rows that repeat a document are
    documents of their own. Empty tables give no rows. Texts are read whole,
    in parts of about a megabyte. Other columns are not read.

    A document is reduced to its counts of item terms and m. Documents equal in
    both form a class: the shuffle deals them by a hash, and the class is formed on
    the counts themselves. As all of a class score the same, its first ``k`` by
    doc_id can stand for it, and no more are moved. Classes meet items in groups of
    bounded size, each giving ``k`` rows an item.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "lexical")
    docs = docs.select("doc_id", "text")
    asked = items.select("item_id", words("text").alias("words")).distinct()
    asked.withColumn("item", F.monotonically_increasing_id()).write.parquet(f"{folder}/items")
    asked = spark.read.parquet(f"{folder}/items")
    wanted = asked.select("item", "item_id", F.explode("words").alias("term")).groupBy("item", "item_id", "term").agg(F.count("*").alias("times"))
    wanted.select("term").distinct().withColumn("id", F.monotonically_increasing_id() + 1).write.parquet(f"{folder}/vocabulary")
    vocabulary = spark.read.parquet(f"{folder}/vocabulary")

    if (vocabulary.agg(F.sum(F.octet_length("term"))).first()[0] or 0) <= VOCABULARY_BYTES:
        bags = _bags(docs, {r.term.encode(): r.id for r in vocabulary.toLocalIterator()})
    else:
        bags = _bags_joined(docs, vocabulary, folder)
    bags.write.parquet(f"{folder}/bags")
    bags = spark.read.parquet(f"{folder}/bags")
    total, length = bags.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    spread = bags.select(F.explode("bag.id").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(total) + 2) / (2 * F.col("df") + 1).cast("double")))
    weighed = wanted.join(vocabulary, "term").join(spread, "id").select("item", "item_id", "id", (F.col("times") * weight).alias("weight"))
    weighed.where("weight > 0").write.parquet(f"{folder}/weighed")
    weighed = spark.read.parquet(f"{folder}/weighed")

    m = F.lit(75) + F.expr(f"(25 * n * {total}) div {max(length, 1)}")
    held = bags.where(F.size("bag") > 0).select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("m", "bag"))
    same = ["hash", "m", "bag"]
    first = held.withColumn("place", F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last()))).where(F.col("place") <= k)
    classes = first.groupBy(*same).agg(F.collect_list(F.struct("doc_id")).alias("members"))
    classes.write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")

    groups, parts = (max(1, -(-df.count() // size)) for df, size in ((classes, CLASSES), (weighed, ITEM_TERMS)))
    left = classes.select("m", "bag", "members", F.pmod(F.xxhash64("hash"), F.lit(groups)).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = weighed.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    doc_kind, item_kind = docs.schema["doc_id"].dataType, asked.schema["item_id"].dataType
    found_kinds = pa.schema([("item", pa.int64()), ("item_id", to_arrow_type(item_kind)), ("doc_id", to_arrow_type(doc_kind)), ("score", pa.int64())])

    def score(classes: pa.Table, items: pa.Table) -> pa.Table:
        return _best(classes, items, k, found_kinds)

    met = left.groupBy("group", "part").cogroup(right.groupBy("group", "part"))
    found = met.applyInArrow(score, f"item long, item_id {item_kind.simpleString()}, doc_id {doc_kind.simpleString()}, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
