"""Language identification of mixed text: word scores, and a path through languages that avoids switches."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, texts_of, with_texts_mapped
from parcelflow.session import new_work_dir

#: Texts of each language that are learned from, those with the least hashes.
TAUGHT = 400
_SALTS = 16
#: What a change of language between two words costs, in nats.
SWITCH = 12.0
#: Nats by which a text may fall below the margin of its languages: a few stray words.
STRAY = 4 * SWITCH
#: Hash buckets of letter triples.
BUCKETS = 1 << 16
#: A language is a candidate for a script that holds this share of its letters.
SCRIPT_SHARE = 0.002
_STEP = 2 << 20

#: First code points of script ranges, in order (fixed by Unicode); a range ends where the next starts.
SCRIPT_STARTS = np.array([
    0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0780, 0x0900, 0x0980, 0x0A00, 0x0A80, 0x0B00, 0x0B80, 0x0C00, 0x0C80,
    0x0D00, 0x0D80, 0x0E00, 0x0E80, 0x0F00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x13A0, 0x1400, 0x1780, 0x1800, 0x1E00, 0x1F00, 0x2000,
    0x3040, 0x30A0, 0x3100, 0x3130, 0x3190, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB1D, 0xFB50, 0xFE70, 0xFF00, 0x10000, 0x20000,
])


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: whether it belongs to words, whether it is a letter, and its lower-case form where that is one character."""
    points = [chr(k) for k in range(0x110000)]
    letter = np.array([c.isalpha() for c in points])
    inside = letter | np.array([unicodedata.category(c)[0] == "M" for c in points])
    lower = np.array([ord(x) if len(x := c.lower()) == 1 else k for k, c in enumerate(points)], np.uint32)
    return inside, letter, lower


@dataclass
class Words:
    """The words of some texts: ``text`` each is in, where it starts and stops there, its script and its letters' buckets."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    script: np.ndarray
    first: np.ndarray
    buckets: np.ndarray

    @property
    def letters(self) -> np.ndarray:
        return self.stop - self.start


def words_of(texts: list[str]) -> Words:
    inside, letter, lower = _tables()
    sizes = np.array([len(t) + 1 for t in texts])
    points = lower[np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")]
    on = inside[points]
    edges = np.flatnonzero(np.diff(on, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    if len(begins):
        # Marks that stand without any letter are no word.
        worded = np.add.reduceat(letter[points], begins, dtype=np.int64) > 0
        for start, stop in zip(begins[~worded].tolist(), ends[~worded].tolist(), strict=True):
            on[start:stop] = False
        begins, ends = begins[worded], ends[worded]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    text = np.searchsorted(starts, begins, "right") - 1
    points = np.where(on, points, np.uint32(0))
    at = np.flatnonzero(on)
    around = np.concatenate([points[:1] * 0, points, points[:1] * 0])
    mixed = around[at] * np.uint32(0x9E3779B1) + around[at + 1] * np.uint32(0x85EBCA77) + around[at + 2] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    first = np.concatenate([[0], np.cumsum(ends - begins)[:-1]]) if len(begins) else begins
    script = np.searchsorted(SCRIPT_STARTS, points[begins], "right") - 1
    return Words(text, begins - starts[text], ends - starts[text], script, first, (mixed >> np.uint32(16)).astype(np.int64) % BUCKETS)


@dataclass
class Languages:
    names: list[str]
    scores: np.ndarray  # bucket by language: log probability
    allowed: np.ndarray  # script by language
    least: np.ndarray  # log probability a letter, halfway between a language's own texts and those of others

    def word_scores(self, words: Words) -> np.ndarray:
        """Log probability of each word in each language that uses its script; in all where none does."""
        if not len(words.text):
            return np.zeros((0, len(self.names)), np.float32)
        made = np.add.reduceat(self.scores[words.buckets], words.first)
        allowed = self.allowed[words.script]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), made, np.float32(-1e6))


def best_path(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word, by Viterbi over the words of each text.

    All texts advance together, word by word, the longest first, so that those
    still running are always the first rows.
    """
    if not len(text):
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    sizes = np.diff(np.append(begins, len(text)))
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[order], sizes[order]
    running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
    here = np.arange(scores.shape[1])
    total = scores[begins].astype(np.float64)
    came: list[np.ndarray] = []
    for step in range(1, sizes[0]):
        n = running[step]
        now = total[:n]
        best = now.argmax(axis=1)[:, None]
        changed = np.take_along_axis(now, best, 1) - switch
        stays = now >= changed
        came.append(np.where(stays, here, best).astype(np.uint8 if len(here) < 256 else np.int32))
        total[:n] = np.where(stays, now, changed) + scores[begins[:n] + step]
    path = np.zeros(len(text), np.int64)
    state = total.argmax(axis=1)
    for step in range(sizes[0] - 1, 0, -1):
        n = running[step]
        path[begins[:n] + step] = state[:n]
        state[:n] = came[step - 1][np.arange(n), state[:n]]
    path[begins] = state
    return path


def fit(docs: DataFrame) -> Languages:
    """Learn from ``text`` and ``lang`` of at most ``TAUGHT`` texts of each language.

    Texts are chosen and counted in tasks, for any number of languages; the driver
    gets the counts, no text. Texts that are repeated teach once.
    """
    known = docs.where("text is not null and lang is not null").select("lang", "text").withColumn("_order", F.xxhash64("text"))
    chosen = known.select("lang", "_order").distinct().withColumn("_salt", F.pmod("_order", F.lit(_SALTS)))
    for group in (["lang", "_salt"], ["lang"]):  # a frequent language is cut in shares first
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("_order"))
        chosen = chosen.withColumn("_rank", rank).where(F.col("_rank") <= TAUGHT).drop("_rank")
    # Written, so that the join knows how little it is and moves no text.
    folder = new_work_dir(docs.sparkSession, "taught")
    chosen.select("lang", "_order").write.parquet(folder)
    chosen = docs.sparkSession.read.schema(chosen.select("lang", "_order").schema).parquet(folder)
    taught = known.join(chosen, ["lang", "_order"]).groupBy("lang", "_order").agg(F.min("text").alias("text")).select("lang", "text")

    def count(batches):
        for batch in by_bytes(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs.tolist()):
                words = words_of([t for t, own in zip(texts_of(batch), langs == lang, strict=True) if own])
                letters = np.bincount(words.script, words.letters, len(SCRIPT_STARTS)).astype(np.int64)
                counts = np.concatenate([np.bincount(words.buckets, minlength=BUCKETS), letters])
                # A language without a word still is one.
                at = np.flatnonzero(counts) if counts.any() else np.zeros(1, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "at", "n"])

    rows = taught.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).collect()
    names = sorted({r["lang"] for r in rows})
    if not names:
        return Languages([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_STARTS), 0), bool), np.zeros(0))
    column = {name: k for k, name in enumerate(names)}
    counts = np.zeros((BUCKETS + len(SCRIPT_STARTS), len(names)))
    counts[[r["at"] for r in rows], [column[r["lang"]] for r in rows]] = [r["n"] for r in rows]
    counts, letters = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((counts + 0.02) / (counts.sum(axis=0) + 0.02 * BUCKETS))
    return Languages(names, scores.astype(np.float32), letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0)), _least(counts, scores))


def _least(counts: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """For each language, the mean of what a letter of its own texts scores in it and what one of the other languages' texts does.

    A single language is told from letters that are all equally likely.
    """
    each = (counts.T @ scores / np.maximum(1, counts.sum(axis=0))[:, None]).T  # language by the language of the texts
    own, n = np.diag(each), len(each)
    return (own + ((each.sum(axis=1) - own) / (n - 1) if n > 1 else -np.log(BUCKETS))) / 2


_FOUND = "struct<lang: string, score: double, margin: double, spans: array<struct<lang: string, start: int, stop: int>>>"
_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])


def label(texts: list[str], model: Languages) -> pa.Array:
    """lang, score, margin and spans of each text."""
    words = words_of(texts)
    n = len(model.names)
    if not n:
        return pa.array([{"lang": "und", "score": 0.0, "margin": 0.0, "spans": []}] * len(texts), pa.struct([("lang", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("spans", pa.list_(_SPAN))]))
    scores = model.word_scores(words)
    path = best_path(scores, words.text)
    margin = np.bincount(words.text, scores[np.arange(len(path)), path] - words.letters * model.least[path], len(texts)).astype(np.float64)
    shares = np.bincount(words.text * n + path, words.letters, len(texts) * n).reshape(-1, n)
    total = shares.sum(axis=1)
    best = shares.argmax(axis=1)
    names = pa.array(model.names)
    lang = pa.DictionaryArray.from_arrays(pa.array(best, mask=total == 0), names).cast(pa.string()).fill_null("und")
    score = np.divide(shares.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)
    new = np.flatnonzero((np.diff(words.text, prepend=-1) != 0) | (np.diff(path, prepend=-1) != 0))
    last = np.append(new[1:], len(path))[: len(new)] - 1
    spans = pa.StructArray.from_arrays(
        [pa.DictionaryArray.from_arrays(pa.array(path[new], pa.int32()), names).cast(pa.string()), pa.array(words.start[new], pa.int32()), pa.array(words.stop[last], pa.int32())],
        fields=list(_SPAN),
    )
    at = np.searchsorted(words.text[new], np.arange(len(texts) + 1))
    return pa.StructArray.from_arrays([lang, pa.array(score), pa.array(margin), pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)], ["lang", "score", "margin", "spans"])


def with_languages(docs: DataFrame, model: Languages, into: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a struct of lang, score, margin and the spans of each language.

    The script of a word narrows the languages it can be in; the path through a
    text then weighs word scores against the cost of switches. ``lang`` has the
    most letters, ``score`` is its share of the letters, spans give characters of
    the text. ``margin`` is by how much, in nats, its words are likelier on their path than
    letters halfway between those of the languages found and of other languages. A text that is null or has no letter is ``und`` with a score of 0
    and a margin of 0 and no spans; so is every text where nothing was learned. Of languages with
    equal letters the first by name counts. Repeated rows are labelled alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value
        return lambda batch: label(texts_of(batch), known)

    return with_texts_mapped(docs, into, _FOUND, start, drop, _STEP)


def in_learned(found: Column) -> Column:
    """Whether a text is in the learned languages, from the struct of :func:`with_languages`: it has letters, and no more than ``STRAY`` speaks against it."""
    return (found["lang"] != "und") & (found["margin"] >= -STRAY)
