import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from llm.data import ODD_TEXTS, given, no_documents, odd_documents
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from parcelflow.llm import pieces, records
from parcelflow.llm.packing import OpenBins, pack_documents
from parcelflow.llm.records import framed, read_records, token_records, unframed, write_records
from parcelflow.llm.token_counts import token_counts

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PLAIN = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
COUNTER = SentencePieceProcessor(model_file=PIECE)


def plain_ids(path, text):
    return PLAIN[path].encode(text, add_special_tokens=False).ids


parts = st.lists(
    st.sampled_from(["a", "The", "word,", "word.", "x!!", ".", " ", "  ", "\n", "\n\n", "\t", " ", "É", "ß", "İ", "Σ", "́", "漢字", "12", "'s", "n't", "▁", "<|endoftext|>", "<s>", "\x01", "\x1c", "​", "🙂"]),
    max_size=24,
)


@settings(max_examples=300, deadline=None)
@drawn(parts, st.sampled_from([5, 1 << 20]))
def test_pieces_give_the_tokens_of_the_whole_text(words, span):
    text, kept = "".join(words), pieces.SPAN
    pieces.SPAN = span
    try:
        for path, kind in ((BYTE, "byte"), (WORD, "word")):
            (ids,) = pieces.id_encoder(path, kind).encode([text])
            assert np.frombuffer(ids, "<u4").tolist() == plain_ids(path, text)
        assert pieces.length_encoder(PIECE).encode([text]) == [len(COUNTER.encode(text))]
    finally:
        pieces.SPAN = kept


def test_special_strings_keep_their_case():
    for text in ("see <|EndOfText|> now", "<|ENDOFTEXT|>", "A <|StartOfText|> b <|endoftext|>, C!!", "É<|endOfText|>.", "Go <|endoftext|> on"):
        for path, kind in ((BYTE, "byte"), (WORD, "word")):
            (ids,) = pieces.id_encoder(path, kind).encode([text])
            assert np.frombuffer(ids, "<u4").tolist() == plain_ids(path, text)


def test_a_full_cache_changes_no_token(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 6)
    encoder = pieces.id_encoder.__wrapped__(BYTE, "byte")
    for text in ("one two three four five six seven eight nine", "nine eight one two"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain_ids(BYTE, text)


def test_repeated_pieces_are_looked_up_once():
    class Counted(dict):
        def get(self, piece, default=None):
            seen.append(piece)
            return super().get(piece, default)

        def __getitem__(self, piece):
            seen.append(piece)
            return super().__getitem__(piece)

    seen, texts = [], ["one two three " * 1000, "", "two one\n\nthree " * 1000]
    for path, kind in ((BYTE, "byte"), (WORD, "word")):
        encoder = pieces.id_encoder.__wrapped__(path, kind)
        encoder._known = Counted()
        ids = encoder.encode(texts)
        assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [plain_ids(path, t) for t in texts]
    assert len(seen) < 100


def test_token_counts_are_those_of_whole_texts(spark):
    for docs in (odd_documents(spark), given(spark, "documents")):
        texts = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
        want = [(i, len(t.encode()), n := len(COUNTER.encode(t)), n > 4096) for i, t in texts]
        got = token_counts(docs, PIECE).collect()
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(want)
    assert token_counts(no_documents(spark), PIECE).collect() == []


def test_records_come_back_whole(spark):
    for docs in (odd_documents(spark), given(spark, "documents")):
        rows = token_records(docs, BYTE).collect()
        want = {}
        for r in docs.collect():
            ids = np.array([*plain_ids(BYTE, r.text or ""), 2], "<u4")
            want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
        got = {}
        for r in rows:
            got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        start, before = 0, -1
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == start and (-1 if r.doc_id is None else r.doc_id) >= before
            start, before = start + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    assert token_records(no_documents(spark), BYTE).collect() == []


def test_records_are_read_in_any_order_from_files_of_bounded_size(spark, tmp_path, monkeypatch):
    index = write_records(odd_documents(spark), BYTE, f"file://{tmp_path}/out")
    want = sorted(map(str, read_records(index, f"file://{tmp_path}/out").collect()))
    assert sorted(map(str, read_records(index.orderBy("size"), f"file://{tmp_path}/out").collect())) == want


@pytest.mark.parametrize("ids", [[], [1, 2, 65535], [70000, 3]])
def test_a_damaged_record_is_noticed(ids):
    record = framed(None if not ids else -5, np.array(ids, np.uint32))
    assert struct.unpack_from("<Q", record)[0] == len(record) - 16
    doc_id, back = unframed(record)
    assert (doc_id, back.tolist()) == (None if not ids else -5, ids)
    for k in range(len(record)):
        with pytest.raises(ValueError):
            unframed(record[:k] + bytes([record[k] ^ 1]) + record[k + 1 :])
    assert records.masked(b"") != records.masked(b"\0")


def test_packing_places_every_piece_once(spark):
    for docs in (odd_documents(spark), given(spark, "documents")):
        rows = pack_documents(docs, WORD).collect()
        want = []
        for r in docs.collect():
            ids = np.array([*plain_ids(WORD, r.text or ""), 0], "<u4")
            want += [(r.doc_id or 0, n, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for n, k in enumerate(range(0, len(ids), 2048))]
        assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
        filled = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == filled.get(r.sequence_id, 0)
            filled[r.sequence_id] = r.offset + r.length
        assert max(filled.values()) <= 2048
    assert len(filled) <= 1.05 * sum(filled.values()) / 2048 + 1
    assert pack_documents(no_documents(spark), WORD).collect() == []


@settings(deadline=None)
@drawn(st.lists(st.integers(1, 16), max_size=80), st.integers(1, 5))
def test_bins_are_best_fit_in_bounded_space(lengths, most):
    bins, open_, made = OpenBins(16, most), {}, 0
    for length in lengths:
        number, offset = bins.place(length)
        fits = [free for free in open_.values() if free >= length]
        if fits:
            assert open_[number] == min(fits)
        else:
            assert number == made
            open_[number], made = 16, made + 1
        assert offset == 16 - open_[number]
        open_[number] -= length
        if open_[number] == 0:
            del open_[number]
        elif len(open_) > most:
            least = min(open_.values())
            closed = [n for n, free in open_.items() if free == least]
            del open_[closed[-1] if number not in closed else number]
