"""Scores of a log-bilinear language model, trained by noise-contrastive estimation.

A word is predicted in two steps, both log-bilinear: its class from the classes of
the two words before it, and the word in its class from the class of the word before.
Classes, about as many as the square root of the words, hold words that have like
neighbours. Rare words share buckets by their last two bytes, which are predicted
like words; a rare word has its share of its bucket by counts.

What the model learns from are counts over all texts, added up by Spark: of words
beside words, then of classes after classes and of words after classes. These tables
are of bounded size, so learning from them takes as long for any corpus, and the
result does not depend on how the texts are split over tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, texts_of
from parcelflow.session import new_work_dir

#: Words whose counts are sent to every task; the counts of all others are joined.
HEAD = 50_000
#: The most frequent of these are predicted each, if they occur often enough to learn from.
MODELLED, LEAST = 16_000, 8
#: Buckets of all other words grow with the words, up to the most.
FEWEST, MOST = 32, 1024
#: Kinds of neighbours that words are likened by: the most frequent words, the rest by their rank.
KEYS, OWN = 128, 96
#: Numbers of a vector, and rounds over the counts, for classes and for the words in a class.
CLASS_SIZE, CLASS_ROUNDS = 64, 30
WORD_SIZE, WORD_ROUNDS = 16, 60
#: Noise words to each true one, step size, contexts of one step.
NOISE, RATE, STEP = 64, 0.02, 2048
#: Distinct words a task counts before it passes them on.
COUNTED = 200_000
END = b""  # no word is empty


def tokens(text: str) -> list[bytes]:
    """Lower-cased words between ASCII white space, then the end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


@dataclass
class Vocabulary:
    """Counts of the head, and what is predicted: frequent words, then buckets of all others; of bounded size."""

    counts: dict[bytes, int]
    ids: dict[bytes, int]
    share: np.ndarray  # of all tokens, for each word or bucket
    sizes: np.ndarray  # of each bucket: count of its words, plus one for each and one for unseen words

    @property
    def start(self) -> int:
        """Stands before a text."""
        return len(self.share)

    def bucket(self, word: bytes) -> int:
        return zlib.crc32(word[-2:]) % len(self.sizes)

    def of(self, words: list[bytes]) -> np.ndarray:
        out = np.array(list(map(self.ids.get, words, repeat(-1))), np.int64)
        rare, first = np.flatnonzero(out < 0), len(self.ids)
        out[rare] = [first + self.bucket(words[k]) for k in rare.tolist()]
        return out


def sequence(ids: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts in a row, two starts before each text; and where the words are."""
    row = np.insert(ids, np.repeat(np.cumsum(sizes) - sizes, 2), start)
    return row, np.flatnonzero(row != start)


def likeness(beside: np.ndarray) -> np.ndarray:
    """Vectors of words from counts (side, word, key) of their neighbours: main directions of the roots of the shares."""
    rows = []
    for counts in beside + 1e-9:
        rows.append(np.sqrt(counts / counts.sum(axis=1, keepdims=True)) - np.sqrt(counts.sum(axis=0) / counts.sum()))
    rows = np.concatenate(rows, axis=1)
    _, axes = np.linalg.eigh((rows * beside[0].sum(axis=1)[:, None]).T @ rows)
    return rows @ axes[:, -32:]


def classes_of(vectors: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Classes of words: all words cut in two along their main direction again and again, largest part first.

    A cut halves the mean of the words' number and of their tokens, so classes are of bounded work.
    """
    parts = [np.arange(len(share))]
    for _ in range(isqrt(len(share) - 1) if len(share) > 1 else 0):
        worth = [len(p) / len(share) + share[p].sum() if len(p) > 1 else 0 for p in parts]
        part = parts.pop(int(np.argmax(worth)))
        own = share[part] / share[part].sum()
        apart = vectors[part] - own @ vectors[part]
        _, axes = np.linalg.eigh((apart * own[:, None]).T @ apart)
        order = np.argsort(apart @ axes[:, -1], kind="stable")
        cut = int(np.searchsorted(np.cumsum(own[order] + 1 / len(part)), 1.0))
        cut = min(max(cut, 1), len(part) - 1)
        parts += [part[order[:cut]], part[order[cut:]]]
    out = np.empty(len(share), np.int64)
    for k, part in enumerate(parts):
        out[part] = k
    return out


def fit(counts: np.ndarray, size: int, rounds: int) -> np.ndarray:
    """Normalised natural logarithms of what follows each context, from counts (far, near, target).

    The score of a target is the product of its vector with the sum of the context's
    two vectors, plus its bias. Noise-contrastive estimation tells true targets from
    ``NOISE`` times as many by their shares; as all targets are at hand, noise enters
    by its expected value and is not drawn. Steps follow the running squares of the
    gradients and get smaller in the second half.
    """
    far_n, near_n, targets = counts.shape
    rng, total = np.random.default_rng(3), max(float(counts.sum()), 1.0)
    noise = counts.sum(axis=(0, 1)) + 1.0
    noise /= noise.sum()
    ratio = (NOISE * noise).astype(np.float32)
    far, near, output = (rng.normal(0, 0.3, (n, size)).astype(np.float32) for n in (far_n, near_n, targets))
    bias = np.log(noise).astype(np.float32)
    parameters = [far, near, output, bias]
    means, squares = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    some = max(1, STEP // near_n)
    starts, step = np.arange(0, far_n, some), 0
    for turn in range(rounds):
        rate = RATE * min(1.0, 2 * (1 - turn / rounds))
        for k in rng.permutation(starts):
            true = counts[k : k + some].reshape(-1, targets).astype(np.float32)
            seen = true.sum(axis=1, keepdims=True)
            made = (far[k : k + some, None] + near).reshape(-1, size)
            odds = np.clip(made @ output.T + (bias - np.log(ratio)), -30, 30)
            change = (true - (true + seen * ratio) / (1 + np.exp(-odds))) / np.float32(total)
            back = (change @ output).reshape(-1, near_n, size)
            g_far = np.zeros_like(far)
            g_far[k : k + some] = back.sum(axis=1)
            step += 1
            for p, m, s, g in zip(parameters, means, squares, (g_far, back.sum(axis=0), change.T @ made, change.sum(axis=0)), strict=True):
                m += (g - m) * np.float32(0.1)
                s += (g * g - s) * np.float32(0.01)
                p += np.float32(rate / (1 - 0.9**step)) * m / (np.sqrt(s / np.float32(1 - 0.99**step)) + np.float32(1e-12))
    out = np.empty(counts.shape, np.float32)
    for k in range(far_n):
        scores = ((far[k] + near) @ output.T + bias).astype(np.float64)
        scores -= scores.max(axis=1, keepdims=True)
        out[k] = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return out


@dataclass
class Model:
    """Log10 probabilities: of classes after two classes, and of words in their class after a class."""

    of: np.ndarray  # the class of each word and bucket, and of the start
    classes: np.ndarray  # (far, near, class)
    words: np.ndarray  # (near, word)

    def logs(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For the words of a sequence at the given places."""
        of = self.of[row]
        return self.classes[of[at - 2], of[at - 1], of[at]].astype(np.float64) + self.words[of[at - 1], row[at]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])

    for batch in by_bytes(batches, "text"):
        for text in texts_of(batch):
            found.update(tokens(text))
        if len(found) >= COUNTED:
            yield passed_on()
            found.clear()
    yield passed_on()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often every word occurs in all texts, and the end."""
    return docs.select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame) -> list:
    """About the ``HEAD`` most frequent words; of those on the border, a share by hash."""
    level = F.floor(F.log2("n") * 8).cast("int")
    left, border, share = HEAD, -1, 0.0
    for row in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.col("level").desc()).collect():
        if row["words"] > left:
            border, share = row["level"], left / row["words"]
            break
        left -= row["words"]
    dealt = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    return counts.where((level > border) | ((level == border) & dealt)).orderBy(F.col("n").desc(), "word").collect()


def vocabulary(counts: DataFrame, distinct: int) -> Vocabulary:
    """What is predicted, from word, n of all texts."""
    head = [(bytes(r["word"]), r["n"]) for r in _head(counts)]
    ids = {word: k for k, (word, n) in enumerate(head[:MODELLED]) if n >= LEAST}
    made = Vocabulary(dict(head), ids, np.ones(0), np.ones(min(MOST, max(FEWEST, isqrt(distinct) // 4))))
    share = np.ones(len(ids) + len(made.sizes))
    bucket = F.crc32(F.expr("substring(word, -2, 2)")) % len(made.sizes)
    for k, n, words in counts.groupBy(bucket.alias("bucket")).agg(F.sum("n"), F.count("*")).collect():
        made.sizes[k] += n + words
        share[len(ids) + k] += n
    for word, k in ids.items():
        n, of = made.counts[word], made.bucket(word)
        made.sizes[of] -= n + 1
        share[len(ids) + of] -= n
        share[k] += n
    made.share = share / share.sum()
    return made


_Cells = Callable[[np.ndarray, np.ndarray], list[np.ndarray]]


def _cells(docs: DataFrame, known, size: int, cells: _Cells, part: Callable[[np.ndarray], np.ndarray] = np.zeros_like) -> DataFrame:
    """part, cell, n: how often every cell occurs in all texts, and the part it belongs to.

    ``cells`` gives them, below ``size``, for a sequence and the places of its words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, found = known.value, np.zeros(size, np.int64)
        for batch in by_bytes(batches, "text"):
            words = [tokens(t) for t in texts_of(batch)]
            lengths = np.array([len(w) for w in words])
            for some in cells(*sequence(vocabulary.of([w for own in words for w in own]), lengths, vocabulary.start)):
                at, n = np.unique(some, return_counts=True)
                found[at] += n
        at = np.flatnonzero(found)
        for some in np.array_split(at, len(at) // COUNTED + 1):
            yield pa.RecordBatch.from_arrays([pa.array(part(some)), pa.array(some), pa.array(found[some])], ["part", "cell", "n"])

    return docs.select("text").mapInArrow(count, "part long, cell long, n long").groupBy("part", "cell").agg(F.sum("n").alias("n"))


def _alike(docs: DataFrame, known, words: int) -> np.ndarray:
    """Counts (side, word, key) of the kinds of words before and after each word."""
    kind = np.arange(words + 1)
    kind[OWN:] = OWN + kind[OWN:] % (KEYS - OWN - 1)
    kind[-1] = KEYS - 1

    def cells(row: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        after = kind[np.append(row[1:], words)]
        return [row[at] * KEYS + kind[row[at - 1]], (words + row[at]) * KEYS + after[at]]

    found = _cells(docs, known, 2 * words * KEYS, cells).toArrow()
    out = np.zeros(2 * words * KEYS)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(2, words, KEYS)


def learned(docs: DataFrame, known: Vocabulary) -> Model:
    """The model of all texts; only tables whose size the vocabulary bounds are collected."""
    spark, words = docs.sparkSession, len(known.share)
    shared = spark.sparkContext.broadcast(known)
    own = classes_of(likeness(_alike(docs, shared, words)), known.share)
    n = int(own.max()) + 1
    of = np.append(own, n)
    after_two = (n + 1) ** 2 * n

    def cells(row: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        c = of[row]
        return [(c[at - 2] * (n + 1) + c[at - 1]) * n + c[at], after_two + c[at - 1] * words + row[at]]

    members = [np.flatnonzero(own == k) for k in range(n)]
    place = np.empty(words, np.int64)
    for m in members:
        place[m] = np.arange(len(m))

    def fitted(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        k, cell, counts = key[0], cells["cell"].to_numpy(), cells["n"].to_numpy()
        if k == n:
            table = np.zeros((n + 1, n + 1, n))
            table.ravel()[cell] = counts
            logs = fit(table, CLASS_SIZE, CLASS_ROUNDS)
        else:
            table = np.zeros((1, n + 1, len(members[k])))
            near, word = np.divmod(cell - after_two, words)
            table[0, near, place[word]] = counts
            logs = fit(table, WORD_SIZE, WORD_ROUNDS)
        return pd.DataFrame({"part": [k], "logs": [(logs / np.float32(np.log(10))).tobytes()]})

    def part(cell: np.ndarray) -> np.ndarray:
        return np.where(cell < after_two, n, own[(cell - after_two) % words])

    counted = _cells(docs, shared, after_two + (n + 1) * words, cells, part)
    rows = counted.groupBy("part").applyInPandas(fitted, "part long, logs binary").collect()
    model = Model(of, np.empty(0), np.empty((n + 1, words), np.float32))
    for k, logs in rows:
        logs = np.frombuffer(logs, np.float32)
        if k == n:
            model.classes = logs.reshape(n + 1, n + 1, n)
        else:
            model.words[:, members[k]] = logs.reshape(n + 1, -1)
    for k in set(range(n)) - {r["part"] for r in rows}:  # no word of it was seen
        model.words[:, members[k]] = -np.log10(len(members[k]))
    return model


_SCORED = "n_tokens long, n_known long, counts_log double, model_log double, words array<binary>, times array<int>"


def language_scores(train_docs: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and the columns of ``docs`` it was called with.

    Words are counted and the model is trained over all of ``train_docs``; every
    whole text of ``docs`` is scored. ``base_score`` is the log10 probability by
    counts alone, with one added to each; ``score`` that of the model. Counts of
    words outside the head are joined, so no table of all words is sent to tasks.
    Null and empty texts are the end only. Without training texts both scores
    take every word for unseen. Repeated rows are scored each.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "words")
    word_counts(train_docs).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    seen, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = vocabulary(counts, distinct)
    model = learned(train_docs, known) if seen else None
    shared = spark.sparkContext.broadcast((known, model))
    names = [c for c in docs.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = shared.value
        sizes = np.log10(known.sizes)
        logs = {w: float(np.log10(n + 1)) for w, n in known.counts.items()}
        for batch in by_bytes(batches, "text"):
            words = [tokens(t) for t in texts_of(batch)]
            lengths = np.array([len(w) for w in words])
            text = np.repeat(np.arange(len(words)), lengths)
            flat = [w for own in words for w in own]
            ids = known.of(flat)
            rare = ids >= len(known.ids)
            modelled = np.where(rare, -sizes[np.maximum(ids - len(known.ids), 0)], 0.0)
            if model is not None:
                modelled += model.logs(*sequence(ids, lengths, known.start))
            head = np.fromiter(map(logs.get, flat, repeat(-1.0)), np.float64, len(flat))
            outside = np.flatnonzero(head < 0)
            head[outside] = 0
            tails = [Counter() for _ in words]
            for k, of in zip(outside.tolist(), text[outside].tolist(), strict=True):
                tails[of][flat[k]] += 1
            n, n_docs = lengths, len(words)
            n_known = n - np.bincount(text[outside], minlength=n_docs)
            counts_log = np.bincount(text, head, n_docs)
            model_log = np.bincount(text, modelled + np.where(rare, head, 0), n_docs)
            tail, times = [list(t) for t in tails], [list(t.values()) for t in tails]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(n, pa.int64()),
                    pa.array(n_known, pa.int64()),
                    pa.array(counts_log, pa.float64()),
                    pa.array(model_log, pa.float64()),
                    pa.array(tail, pa.list_(pa.binary())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                [*names, *(c.split()[0] for c in _SCORED.split(", "))],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    scored = docs.mapInArrow(score, f"{kinds}, {_SCORED}").withColumn("row", F.monotonically_increasing_id())
    scored.write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    rest = (
        scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("tail"))
        .select("row", F.col("tail.words").alias("word"), F.col("tail.times").alias("times"))
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_log"), F.sum("times").alias("rest_known"))
    )
    rest_log, rest_known = F.coalesce("rest_log", F.lit(0.0)), F.coalesce("rest_known", F.lit(0).cast("long"))
    unit = float(np.log10(seen + distinct + 1))
    return scored.drop("words", "times").join(rest, "row", "left").select(
        *names,
        "n_tokens",
        (F.col("n_known") + rest_known).alias("n_known"),
        F.lit(int(seen)).cast("long").alias("train_tokens"),
        (F.col("counts_log") + rest_log - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("model_log") + rest_log).alias("score"),
    )
