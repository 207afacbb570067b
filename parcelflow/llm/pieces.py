"""Token ids of whole texts, with every distinct piece encoded once.

A text is cut at single spaces that stand between two printable characters.
All three vocabularies start a token at such a space, or drop it, so the tokens
of a text are those of its pieces in order; the tests compare both ways of
encoding. Where white space meets other white space, or stands at an end of the
text, the pieces around it stay together. Pieces repeat far more often than
texts do, so a bounded cache of piece tokens saves most of the encoding.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept in a cache; each takes some 200 bytes.
CACHED = 600_000
#: Characters of a text that are cut into pieces at a time.
SPAN = 1 << 20
#: Characters whose pieces are told apart at a time: the more, the fewer pieces are looked up again.
BLOCK = 4 << 20
#: Pieces that are encoded as one string.
JOINED = 500

_UNSAFE = ()  # stands for a piece that does not stand alone; joins and sums refuse it
_SPACE_MARK = "▁"  # stands for a space inside one of the vocabularies
_SPACE_BYTE = "Ġ"  # stands for a space in a byte-level vocabulary
_TAILS = ".,;:!?*#$%&()|"  # neither letter, digit, white space nor apostrophe: byte-level BPE cuts between such and a letter


class PieceEncoder:
    """``encode`` gives one value per text: the total over its pieces.

    ``runs`` measures strings as they are, ``pieces`` does so for printable
    pieces without white space inside; ``total`` adds values up, and ``by_span``
    does so for many spans, given as places in a list of values. With ``lead``, every piece is measured with the space before it, but for a text's first and
    those that start a line. ``tails`` are characters that start a token of their
    own after a letter: words are then measured without them. ``open_up`` makes a
    text easier to cut, ``close_up`` undoes that.
    """

    def __init__(
        self,
        runs: Callable[[list[str]], list],
        pieces: Callable[[list[str]], list],
        total: Callable[[Iterable], object],
        by_span: Callable[[list, np.ndarray, np.ndarray], list],
        lead: bool = False,
        tails: str = "",
        open_up: Callable[[str], str] = str,
        close_up: Callable[[str], str] = str,
    ):
        self._runs, self._pieces, self._total, self._by_span, self._lead = runs, pieces, total, by_span, " " if lead else ""
        self._tails, self._open_up, self._close_up = tails, open_up, close_up
        self._known: dict[str, object] = {}
        self._first: dict[str, object] = {}  # with ``lead``: pieces as they start a text

    def encode(self, texts: list[str]) -> list:
        """Values of whole texts; give it a few megabytes at a time."""
        values, spans, starts, held = [[] for _ in texts], [], [], 0
        for k, text in enumerate(texts):
            for n, span in enumerate(_spans(self._open_up(text))):
                spans.append(span)
                starts.append((k, n == 0))
                held += len(span)
                if held >= BLOCK:
                    self._add(spans, starts, values)
                    spans, starts, held = [], [], 0
        if spans:
            self._add(spans, starts, values)
        return [of[0] if len(of) == 1 else self._total(of) for of in values]

    def _add(self, spans: list[str], starts: list[tuple[int, bool]], values: list[list]) -> None:
        """Measure spans together: Arrow cuts them and tells equal pieces, so that Python meets every piece once."""
        cut = pc.split_pattern(pa.array(spans, pa.large_string()), " ")
        ends, words = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        codes, distinct = words.indices.to_numpy().copy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self._known.get, distinct))
        new = [place for place, value in enumerate(known) if value is None]
        self._learn({distinct[place] for place in new}, self._known, self._lead)
        for place in new:
            known[place] = self._known[distinct[place]]
        if self._lead:
            places = ends[:-1][[first for _, first in starts]]
            firsts = [distinct[c] for c in codes[places].tolist()]
            self._learn(set(firsts).difference(self._first), self._first, "")
            codes[places] = np.arange(len(known), len(known) + len(firsts))
            known += map(self._first.__getitem__, firsts)
        unsafe = np.fromiter((v is _UNSAFE for v in known), bool, len(known))
        for place in np.flatnonzero(unsafe).tolist():
            known[place] = self._total(())
        found = self._by_span(known, codes, ends)
        for s in np.flatnonzero(np.logical_or.reduceat(unsafe[codes], ends[:-1])).tolist():
            runs = list(_joined_where_unsafe(spans[s].split(" ")))
            leads = ["" if starts[s][1] else self._lead, *[self._lead] * (len(runs) - 1)]
            found[s] = self._total(self._runs([self._close_up(lead + run) for lead, run in zip(leads, runs, strict=True)]))
        for (k, _), value in zip(starts, found, strict=True):
            values[k].append(value)
        for cache in (self._known, self._first):
            if len(cache) > CACHED:  # frequent pieces come early
                for piece in list(cache)[CACHED // 2 :]:
                    del cache[piece]

    def _learn(self, new: set[str], into: dict[str, object], lead: str) -> None:
        plain = [p for p in new if p.isprintable() and p and p[0] != _SPACE_MARK and p[-1] != _SPACE_MARK]
        rest = new.difference(plain)
        other = [p for p in rest if _stands_alone(p)]
        into.update(dict.fromkeys(rest.difference(other), _UNSAFE))
        if lead:  # a line break is a token of its own before a printable character, and takes the space before it
            lines = [p for p in other if p[0] == "\n" and p[1:].isprintable()]
            other = list(set(other).difference(lines))
            break_ = self._runs(["\n"])[0]
            into.update(zip(lines, [break_ + value for value in self._pieces([p[1:] for p in lines])], strict=True))
        tails = self._tails
        stems = {p: s for p in plain if p[-1] in tails and (s := p.rstrip(tails)) and s[-1] < "\u0250" and s[-1].isalpha()} if tails else {}
        whole = [w for w in {stems.get(p, p) for p in plain} if w not in into] if stems else plain
        ends = list({p[len(s) :] for p, s in stems.items()})
        into.update(zip(whole, self._pieces([lead + p for p in whole]), strict=True))
        into.update(zip(other, self._runs([self._close_up(lead + p) for p in other]), strict=True))
        end = dict(zip(ends, self._pieces(ends), strict=True))
        into.update([(p, into[s] + end[p[len(s) :]]) for p, s in stems.items()])


def _spans(text: str) -> Iterator[str]:
    """The text; a long one in spans that end at a safe space."""
    start = 0
    while True:
        stop = text.find(" ", start + SPAN)
        while stop >= 0 and not (_safe(text[stop - 1]) and _starts_safely(text[stop + 1 : stop + 3])):
            stop = text.find(" ", stop + 1)
        yield text[start : len(text) if stop < 0 else stop]
        if stop < 0:
            return
        start = stop + 1


def _safe(ch: str) -> bool:
    return ch.isprintable() and ch not in (" ", _SPACE_MARK)


def _starts_safely(piece: str) -> bool:
    """A line break before a printable character is as good a start as that character."""
    first = piece[1:2] if piece[:1] == "\n" else piece[:1]
    return first != "" and _safe(first)


def _stands_alone(piece: str) -> bool:
    return _starts_safely(piece) and _safe(piece[-1])


def _joined_where_unsafe(parts: list[str]) -> Iterator[str]:
    run = [parts[0]]
    for left, right in pairwise(parts):
        if left and _safe(left[-1]) and _starts_safely(right):
            yield " ".join(run)
            run = []
        run.append(right)
    yield " ".join(run)


_PUNCTUATION = re.compile(r"(?<=[A-Za-z\u00df-\u00f6\u00f8-\u00ff])[.,;:!?*#$%&()|]+(?=[\s]|\Z)")


def _words_apart(text: str, specials: tuple[str, ...] = ()) -> str:
    """For a vocabulary that knows neither white space nor case, but in its special strings: set words and punctuation apart."""
    text = text.replace("\n", " ")
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    folded = text.lower()
    if any(folded.count(s) != text.count(s) for s in specials):
        return text
    return _PUNCTUATION.sub(r" \g<0>", folded)


def _ids_by_span(values: list[bytes], codes: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids of spans; span k is the values at ``codes[ends[k]:ends[k + 1]]``."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    counts = sizes[codes]
    stops = np.concatenate(([0], np.cumsum(counts)))
    places = np.repeat((np.cumsum(sizes) - sizes)[codes] - stops[:-1], counts) + np.arange(stops[-1])
    data = np.frombuffer(b"".join(values), "<u4")[places].tobytes()
    return [data[a:b] for a, b in pairwise((4 * stops[ends]).tolist())]


def _sums_by_span(values: list[int], codes: np.ndarray, ends: np.ndarray) -> list[int]:
    return np.add.reduceat(np.array(values, np.int64)[codes], ends[:-1]).tolist()


@lru_cache(maxsize=4)
def id_encoder(path: str, kind: str) -> PieceEncoder:
    """Texts to their ids as little-endian unsigned 32-bit integers; one per worker process.

    ``kind``: ``byte`` for byte-level BPE, ``word`` for BPE with word ends that
    drops white space. Pieces are encoded many in one string. With a space before
    each, they start where a token starts with a space, as none does inside a
    printable piece; others have a mark between them that is always one token and
    that no printable piece holds.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    mark = {"byte": "\n", "word": " \x01 "}[kind]
    (mark_id,) = tokenizer.encode(mark, add_special_tokens=False).ids
    vocabulary = tokenizer.get_vocab()
    spaced = np.zeros(max(vocabulary.values()) + 1, bool)
    spaced[[i for token, i in vocabulary.items() if token.startswith(_SPACE_BYTE)]] = True

    def runs(texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(texts: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(texts), JOINED):
            joined = texts[k : k + JOINED]
            led = kind == "byte" and joined[0][0] == " "  # then all of them are
            (encoded,) = tokenizer.encode_batch_fast([("" if led else mark).join(joined)], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            cuts = [*np.flatnonzero(spaced[ids]).tolist(), len(ids)] if led else [-1, *np.flatnonzero(ids == mark_id).tolist(), len(ids)]
            data, past = ids.tobytes(), 0 if led else 4
            out += [data[4 * a + past : 4 * b] for a, b in pairwise(cuts)]
        return out

    if kind == "word":
        specials = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
        return PieceEncoder(runs, pieces, b"".join, _ids_by_span, open_up=lambda t: _words_apart(t, specials))
    return PieceEncoder(runs, pieces, b"".join, _ids_by_span, lead=True, tails=_TAILS, open_up=lambda t: t.replace("\n", " \n"), close_up=lambda t: t.replace(" \n", "\n"))


@lru_cache(maxsize=4)
def length_encoder(path: str) -> PieceEncoder:
    """Texts to their number of sentencepiece tokens; one per worker process."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def lengths(texts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(texts, num_threads=1)]

    return PieceEncoder(lengths, lengths, sum, _sums_by_span)
