"""Benchmark decontamination: windows of test items found in texts by one automaton."""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import free_name, texts_of, with_texts_mapped
from parcelflow.llm.wordhash import WORDS_ONLY
from parcelflow.session import new_work_dir

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: Words of a block. Every window holds a whole one of those that start at each BLOCK-th word of its item.
BLOCK = (WINDOW + 1) // 2
#: Bytes of test items that one automaton is built of and that are broadcast at once; more items are dealt over several.
ITEM_BYTES = 4 << 20
#: Bytes of a text that are taken apart at once.
_STEP = 4 << 20
#: Characters that stand for one word, each from an alphabet of its own.
_DIGITS = 3
#: Stands for words that no item has.
_OTHER = "\0" * _DIGITS

_SPANS = "array<struct<first: int, stop: int, start: int, end: int>>"
_HITS = f"struct<n_words: bigint, spans: {_SPANS}, items: array<string>>"
_SPAN = pa.struct([(n, pa.int32()) for n in ("first", "stop", "start", "end")])
#: A word in the original text, whatever its case.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normalised(text: str) -> str:
    """The lower-cased words with a space before and after each; one character per byte."""
    words = text.encode().translate(WORDS_ONLY).split()
    return f" {b' '.join(words).decode('latin-1')} " if words else " "


@dataclass
class _Pattern:
    """Consecutive words: the items that are these words, and, as a block, the words around it in each item."""

    whole: set[str] = field(default_factory=set)
    around: dict[tuple[str, str], set[str]] = field(default_factory=dict)  # words before, words behind: items
    near: dict[tuple[int, str], list[tuple[str, str]]] = field(default_factory=dict)  # side, half of the words there: keys of around


class Windows:
    """One automaton over the words of all items; finds every occurrence of each window.

    An item shorter than a window is a pattern; longer ones are in blocks, which
    takes one state a digit of a word, where whole windows would take ``WINDOW``. A
    block found in a text is a window's if the words around it are those of an item.
    Words are coded in a few digits, so that no state has many next ones.
    """

    def __init__(self, items: list[tuple[str, str]]):
        split = [(item, text.encode().translate(WORDS_ONLY).split()) for item, text in items]
        known = dict.fromkeys(word for _, words in split for word in words)
        base = max(2, math.ceil(len(known) ** (1 / _DIGITS)) + 1)
        self.code = {word: "".join(chr(1 + d * base + k // base**d % base) for d in range(_DIGITS)) for k, word in enumerate(known)}
        patterns: dict[str, _Pattern] = {}
        size, side = BLOCK * _DIGITS, (BLOCK - 1) * _DIGITS
        for item, words in split:
            coded = "".join(map(self.code.__getitem__, words))
            if 0 < len(words) < WINDOW:
                patterns.setdefault(coded, _Pattern()).whole.add(item)
            for k in range(0, len(coded) - size + 1, size) if len(words) >= WINDOW else ():
                around = (coded[max(0, k - side) : k], coded[k + size : k + size + side])
                patterns.setdefault(coded[k : k + size], _Pattern()).around.setdefault(around, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        half = side // 2
        for coded, pattern in patterns.items():
            # A window has half of its words beside the block before it, or behind it.
            for key in pattern.around:
                if len(key[0]) >= half:
                    pattern.near.setdefault((0, key[0][-half:]), []).append(key)
                if len(key[1]) >= half:
                    pattern.near.setdefault((1, key[1][:half]), []).append(key)
            self.automaton.add_word(coded, (len(coded), pattern))
        if patterns:
            self.automaton.make_automaton()

    def coded(self, text: str) -> str:
        """The words of a text in their codes."""
        data, at, get, out = text.encode().translate(WORDS_ONLY), 0, self.code.get, []
        while at < len(data):
            stop = data.find(b" ", at + _STEP)
            stop = len(data) if stop < 0 else stop
            out.append("".join([get(word, _OTHER) for word in data[at:stop].split()]))
            at = stop
        return "".join(out)

    def found(self, words: str) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words that are in a window, and the items found, for words in their codes."""
        spans, items = [], set()
        half = (BLOCK - 1) // 2 * _DIGITS
        for last, (length, pattern) in self.automaton.iter(words) if len(self.automaton) else ():
            start, stop = last + 1 - length, last + 1
            if pattern.whole:
                spans.append((start // _DIGITS, stop // _DIGITS))
                items |= pattern.whole
            if not pattern.around:
                continue
            keys = {*pattern.near.get((0, words[max(0, start - half) : start]), ()), *pattern.near.get((1, words[stop : stop + half]), ())}
            for before, behind in keys:
                left = right = 0
                while left < min(len(before), start) and before.endswith(words[start - left - _DIGITS : start], len(before) - left - _DIGITS):
                    left += _DIGITS
                while right < len(behind) and behind.startswith(words[stop : stop + right + _DIGITS]) and stop + right < len(words):
                    right += _DIGITS
                if left + length + right >= WINDOW * _DIGITS:
                    spans.append(((start - left) // _DIGITS, (stop + right) // _DIGITS))
                    items |= pattern.around[before, behind]
        return spans, items


def _merged(spans: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Spans by their first word, those that share words or touch made one."""
    out: list[tuple[int, ...]] = []
    for first, stop, *places in sorted(spans):
        if out and first <= out[-1][1]:
            last = out[-1]
            out[-1] = (last[0], max(stop, last[1]), *((last[2], max(places[1], last[3])) if places else ()))
        else:
            out.append((first, stop, *places))
    return out


def hits(text: str, windows: Windows) -> tuple[int, list[tuple[int, int, int, int]], set[str]]:
    """Number of words; spans of hit words with their places in ``text``; items found."""
    words = windows.coded(text)
    found, items = windows.found(words)
    spans, places, word, place = [], _WORD.finditer(text) if found else None, -1, None
    for first, stop in _merged(found):
        while word < first:
            word, place = word + 1, next(places)
        start = place.start()
        while word < stop - 1:
            word, place = word + 1, next(places)
        spans.append((first, stop, start, place.end()))
    return len(words) // _DIGITS, spans, items


def _dealt(items: DataFrame) -> tuple[DataFrame, int]:
    """item, text and share of the test items, in shares of about ``ITEM_BYTES``; the number of shares."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where("text is not null and text <> ''").distinct()
    folder = new_work_dir(items.sparkSession, "items")
    rows.write.parquet(folder)
    rows = items.sparkSession.read.schema(rows.schema).parquet(folder)
    size = rows.agg(F.sum(F.octet_length("item") + F.octet_length("text"))).first()[0] or 0
    shares = max(1, math.ceil(size / ITEM_BYTES))
    return rows.withColumn("share", F.pmod(F.xxhash64("item", "text"), F.lit(shares))), shares


#: The automaton that this worker built last, by the number of its scan.
_built: dict[str, Windows] = {}


def _scan(rows: DataFrame):
    """The function that scans texts for the items of ``rows``, which are within ``ITEM_BYTES`` or about."""
    shared = rows.sparkSession.sparkContext.broadcast(sorted((r["item"], r["text"]) for r in rows.select("item", "text").collect()))
    number = uuid.uuid4().hex

    def start():
        if number not in _built:
            _built.clear()
            _built[number] = Windows(shared.value)
        windows = _built[number]
        return lambda batch: _as_array([hits(text, windows) for text in texts_of(batch)])

    return start


def _as_array(found: list[tuple[int, list[tuple[int, int, int, int]], set[str]]]) -> pa.Array:
    rows = [{"n_words": n, "spans": [dict(zip(("first", "stop", "start", "end"), x, strict=True)) for x in spans], "items": sorted(items)} for n, spans, items in found]
    return pa.array(rows, pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))]))


def with_hits(docs: DataFrame, items: DataFrame, into: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a struct of n_words, spans of hit words and the ids of items found.

    A span has its first word, the word behind its last, and where it starts and
    ends in the original text, in characters. Each text is scanned once by one
    automaton. Test sets beyond ``ITEM_BYTES`` are dealt over several automata: a
    job for each writes the hits of texts that have any, and these meet by the
    texts' digests, so that neither the plan nor a task grows with the test set.
    Null and empty texts have no words, no spans and no items; a
    null item_id counts as empty text, a null item text as no item. Repeated rows
    and repeated items change nothing else; with no items nothing is hit. Very long
    texts are taken apart piece by piece and scanned whole.
    """
    rows, shares = _dealt(items)
    if shares == 1:
        return with_texts_mapped(docs, into, _HITS, _scan(rows), drop)
    folder = new_work_dir(docs.sparkSession, "hits")
    texts = docs.select(F.sha2("text", 256).alias("key"), "text").where("text <> ''")
    for share in range(shares):
        found = with_texts_mapped(texts, "hits", _HITS, _scan(rows.where(F.col("share") == share)), drop=("text",))
        found.where("size(hits.spans) > 0").dropDuplicates(["key"]).write.parquet(f"{folder}/share={share}")
    key, before = free_name(docs, "_key"), free_name(docs, "_before")
    met = docs.sparkSession.read.schema(f"key string, hits {_HITS}").parquet(*[f"{folder}/share={share}" for share in range(shares)])
    met = met.groupBy(F.col("key").alias(key)).agg(
        F.struct(F.flatten(F.collect_list("hits.spans")).alias("spans"), F.flatten(F.collect_list("hits.items")).alias("items")).alias(before)
    )
    joined = docs.withColumn(key, F.sha2("text", 256)).join(met, key, "left")

    def start():
        words = Windows([])

        def unite(batch: pa.RecordBatch) -> pa.Array:
            found = [b or {"spans": [], "items": []} for b in batch.column(before).to_pylist()]
            spans = [_merged([tuple(x.values()) for x in b["spans"]]) for b in found]
            return _as_array([(len(words.coded(text)) // _DIGITS, s, set(b["items"])) for text, s, b in zip(texts_of(batch), spans, found, strict=True)])

        return unite

    return with_texts_mapped(joined, into, _HITS, start, (*drop, key, before))


def hit_words(hits_of: str) -> Column:
    return F.aggregate(f"{hits_of}.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])


def contaminated(hits_of: str) -> Column:
    """Hit at all, and a twentieth of the words or more."""
    n = hit_words(hits_of)
    return (n > 0) & (20 * n >= F.col(f"{hits_of}.n_words"))


def decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans for every row of ``docs``."""
    return with_hits(docs.select("doc_id", "text"), items, "hits", drop=("text",)).select(
        "doc_id",
        "hits.n_words",
        hit_words("hits").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hits.items")), 256).alias("items_sha256"),
        contaminated("hits").alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; their columns, whatever their names, stay as they are."""
    hits_of = free_name(docs, "_hits")
    return with_hits(docs, items, hits_of).where(~contaminated(hits_of)).select(docs.columns)
