"""Quality classifier: labelled neighbours vote in a latent-semantic space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, text_bytes, with_texts_mapped
from parcelflow.llm.wordhash import mix, word_hashes

#: Labelled texts of each label that are taken as neighbours, those with the least hashes.
LABELLED = 2000
#: Dimensions of the latent space, neighbours that vote, and the power their similarity is raised to.
DIMENSIONS, NEIGHBOURS, POWER = 48, 15, 24
#: Buckets of hashed words, and of hashed runs of ``GRAM`` letters.
WORDS, GRAMS, GRAM = 2048, 2048, 4
#: Weights, against that of byte pairs, that cross-validation over ``FOLDS`` parts of the labelled texts chooses from:
#: of the few terms that count repeated words, and of hashed terms. Of equally good ones the first is taken.
REPEATED, HASHED, FOLDS = (6, 1), (1, 0.3, 3), 3
#: Texts whose terms are in memory at a time.
COUNTED = 1024


def _kinds() -> np.ndarray:
    """Each byte's kind: lower and upper letters, digits, non-ASCII and control bytes by kind, other ASCII by itself."""
    kinds = np.arange(256)
    for low, high, kind in ((0, 8, 1), (14, 31, 1), (48, 57, 48), (65, 90, 65), (97, 122, 97), (127, 127, 1), (128, 255, 128)):
        kinds[low : high + 1] = kind
    return np.unique(kinds, return_inverse=True)[1]


_KIND = _kinds()
_KINDS = int(_KIND.max()) + 1
_PAIRS = _KINDS * _KINDS
#: How far back a word is looked for again.
_BACK = (1, 2, 3)
_HASHED = _PAIRS + len(_BACK) + 1
TERMS = _HASHED + WORDS + GRAMS


def term_counts(column: pa.Array) -> np.ndarray:
    """How often each term occurs in each text.

    Terms are the pairs of adjacent byte kinds, with a blank at both ends of a
    text, words that stand one, two or three places before too, words that occur
    earlier in the text at all, and words and runs of letters by hash, without case.
    """
    data, at = text_bytes(column)
    out = np.zeros((len(column), TERMS), np.float32)
    blank = _KIND[32]
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    for k, (start, stop) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        for window in range(start, stop, 1 << 20):
            kinds = _KIND[data[window : min(stop, window + (1 << 20) + 1)]]
            out[k, :_PAIRS] += np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=_PAIRS)
            out[k, _HASHED + WORDS :] += np.bincount(_gram_hashes(lower[window : min(stop, window + (1 << 20) + GRAM - 1)]), minlength=GRAMS)
        if stop > start:
            out[k, blank * _KINDS + _KIND[data[start]]] += 1
            out[k, _KIND[data[stop - 1]] * _KINDS + blank] += 1
        words = word_hashes(data[start:stop])
        out[k, _PAIRS : _PAIRS + len(_BACK)] = [(words[back:] == words[:-back]).sum() for back in _BACK]
        out[k, _HASHED - 1] = len(words) - len(np.unique(words))
        out[k, _HASHED : _HASHED + WORDS] = np.bincount(_buckets(words, WORDS), minlength=WORDS)
    return out


def _buckets(values: np.ndarray, n: int) -> np.ndarray:
    return (mix(values.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Buckets of the runs of ``GRAM`` bytes."""
    n = max(0, len(data) - GRAM + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(GRAM):
        runs = runs << np.uint64(8) | data[k : k + n]
    return _buckets(runs, GRAMS)


@dataclass
class Neighbours:
    """Latent-semantic vectors of labelled texts; of bounded size by ``LABELLED``."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def vectors_of(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) @ (self.weights[:, None] * self.axes))

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """The label that the nearest labelled texts vote for, weighted by similarity, with the prior as one weak vote."""
        if len(self.labels) == 0:
            return np.full(len(counts), self.prior)
        return self.votes(self.vectors_of(counts))

    def votes(self, vectors: np.ndarray) -> np.ndarray:
        near = vectors @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(near, at, 1), 0) ** POWER
        return ((votes * self.labels[at]).sum(axis=1) + 0.01 * self.prior) / (votes.sum(axis=1) + 0.01)


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _group_weights(repeated: float, hashed: float) -> np.ndarray:
    return np.repeat([1, repeated, hashed], [_PAIRS, _HASHED - _PAIRS, TERMS - _HASHED]).astype(np.float32)


def _axes(x: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The main directions of the weighted rows, by subspace iteration; ``rows`` is 1 for rows that count, else 0."""
    found = np.random.default_rng(5).normal(size=(TERMS, DIMENSIONS + 16)).astype(np.float32)
    for _ in range(5):
        found, _ = np.linalg.qr(weights[:, None] * (x.T @ (rows * (x @ (weights[:, None] * found)))))
    seen = rows * (x @ (weights[:, None] * found))
    _, turn = np.linalg.eigh(seen.T @ seen)
    return (found @ turn[:, ::-1][:, :DIMENSIONS]).astype(np.float32)


def _neighbours(x: np.ndarray, labels: np.ndarray, groups: np.ndarray, prior: float, rows: np.ndarray) -> Neighbours:
    """The model of the rows that count; ``x`` has the logarithms of their term counts."""
    weights = groups * np.log1p(rows.sum() / (1 + sum((x[k : k + COUNTED] > 0)[rows[k : k + COUNTED]].sum(axis=0) for k in range(0, len(x), COUNTED)))).astype(np.float32)
    axes = _axes(x, weights, rows[:, None].astype(np.float32))
    return Neighbours(weights, axes, _unit(x @ (weights[:, None] * axes))[rows], labels[rows], prior)


def _chosen_weights(x: np.ndarray, labels: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the groups of terms with the least log loss on parts of the labelled texts that were not learned from."""
    choices = [_group_weights(r, h) for h in HASHED for r in REPEATED]
    part = np.random.default_rng(9).permutation(len(x)) % FOLDS
    if len(x) < 2 * FOLDS:
        return choices[0]
    losses = []
    for groups in choices:
        loss = 0.0
        for fold in range(FOLDS):
            model = _neighbours(x, labels, groups, prior, part != fold)
            own = part == fold
            scores = model.votes(_unit(x @ (model.weights[:, None] * model.axes))[own]).clip(0.01, 0.99)
            loss -= np.log(np.where(labels[own] == 1, scores, 1 - scores)).sum()
        losses.append(loss)
    return choices[int(np.argmin(losses))]


def fit(docs: DataFrame, labels: DataFrame) -> Neighbours:
    """Learn from labelled rows of ``docs``: at most ``LABELLED`` texts of each label.

    Only texts and ``quality`` are learned from. Rows without a text, a doc_id or
    a label of 0 or 1 teach nothing; where nothing is left, every score is 0.5.
    """
    wanted = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality").distinct()
    ranked = wanted.join(docs.where("text is not null").select("doc_id").distinct(), "doc_id").withColumn("_order", F.xxhash64("doc_id", "quality"))
    chosen = [part for q in (0, 1) for part in [ranked.where(F.col("quality") == q).orderBy("_order", "doc_id").limit(LABELLED)]]
    few = chosen[0].unionByName(chosen[1]).select("doc_id", "quality")

    def count(batches):
        for batch in (b.slice(k, COUNTED) for b in by_bytes(batches, "text") for k in range(0, b.num_rows, COUNTED)):
            counts = term_counts(batch.column("text"))
            at = [np.flatnonzero(c).astype("<u2") for c in counts]  # few of the terms occur in a text
            times = [c[k].tobytes() for c, k in zip(counts, at, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([k.tobytes() for k in at], pa.binary()), pa.array(times, pa.binary())], ["doc_id", "quality", "terms", "times"]
            )

    taught = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in taught.schema.fields}
    rows = taught.select("doc_id", "quality", "text").mapInArrow(count, f"doc_id {kinds['doc_id']}, quality {kinds['quality']}, terms binary, times binary").orderBy("doc_id", "quality").collect()
    if not rows:
        return Neighbours(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    counts = np.zeros((len(rows), TERMS), np.float32)
    for count, r in zip(counts, rows, strict=True):
        count[np.frombuffer(r.terms, "<u2")] = np.frombuffer(r.times, np.float32)
    values = np.array([r.quality for r in rows], np.float32)
    share = wanted.join(docs.where("text is not null").select("doc_id"), "doc_id").agg(F.avg("quality")).first()[0]
    x = np.log1p(counts, out=counts)
    return _neighbours(x, values, _chosen_weights(x, values, float(share)), float(share), np.ones(len(x), bool))


def with_scores(docs: DataFrame, model: Neighbours, into: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a score from 0 to 1: higher where label 1 is likelier.

    Every document is compared with all labelled vectors, block by block. A null
    or empty text has no direction, so its score is the share of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value

        def score(batch: pa.RecordBatch) -> pa.Array:
            texts = batch.column("text")
            parts = [known.scores(term_counts(texts.slice(k, COUNTED))) for k in range(0, len(texts), COUNTED)]
            return pa.array(np.concatenate([np.zeros(0), *parts]).astype(np.float64).clip(0, 1))

        return score

    return with_texts_mapped(docs, into, "double", start, drop)
