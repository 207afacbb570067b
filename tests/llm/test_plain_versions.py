"""The learned operators and the pipeline's stages against plain versions, text by text and word by word."""

import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tokenizers
from llm.data import SF, given, no_documents, odd_documents

import corpus_pipeline
from parcelflow.llm import language, quality
from parcelflow.llm.columns import fold
from parcelflow.llm.wordhash import mix, word_hashes


def kind(byte):
    """Letters, digits, non-ASCII and control bytes are a kind each; any other byte is its own."""
    if 65 <= byte <= 90 or 97 <= byte <= 122:
        return "A" if byte <= 90 else "a"
    if 48 <= byte <= 57:
        return "0"
    if byte >= 128:
        return "high"
    return "control" if byte <= 8 or 14 <= byte <= 31 or byte == 127 else byte


def plain_terms(text):
    """The counts of pairs of kinds as a bag, and the other terms in order."""
    data = text.encode()
    kinds = [kind(b) for b in data]
    pairs = Counter(zip([kind(32), *kinds], [*kinds, kind(32)])) if kinds else Counter()
    words = word_hashes(np.frombuffer(data, np.uint8)).tolist()
    back = [sum(words[k] == words[k - n] for k in range(n, len(words))) for n in (1, 2, 3)]
    seen = len(words) - len(set(words))
    bucket = lambda v, n: int(mix(np.array([v], np.uint64))[0]) % n
    lower = data.lower()
    grams = [int.from_bytes(lower[k : k + quality.GRAM], "big") for k in range(len(lower) - quality.GRAM + 1)]
    hashed = np.bincount([bucket(w, quality.WORDS) for w in words], minlength=quality.WORDS)
    runs = np.bincount([bucket(g, quality.GRAMS) for g in grams], minlength=quality.GRAMS)
    return pairs, [*back, seen, *hashed, *runs]


def test_quality_scores_by_brute_force(spark):
    docs = given(spark, "documents")
    model = quality.fit(docs, given(spark, "labels"))
    scores = Counter({r.doc_id: r.s for r in quality.with_scores(docs, model, "s").collect()})
    vectors, labels = model.vectors.astype(float), model.labels.astype(float)
    places = {}  # of a pair of kinds, by the kinds' representatives
    for byte in range(256):
        places.setdefault(kind(byte), int(quality._KIND[byte]))
    for r in docs.orderBy("doc_id").limit(25).collect():
        pairs, rest = plain_terms(r.text or "")
        counts = np.zeros(quality.TERMS)
        for (a, b), n in pairs.items():
            counts[places[a] * quality._KINDS + places[b]] += n
        counts[-len(rest) :] = rest
        vector = sum(math.log1p(n) * model.weights[k] * model.axes[k].astype(float) for k, n in enumerate(counts) if n)
        length = math.sqrt(sum(x * x for x in vector))
        cosines = [sum(x * y for x, y in zip(vector, other)) / length for other in vectors]
        near = sorted(range(len(cosines)), key=lambda k: -cosines[k])[: quality.NEIGHBOURS]
        votes = {k: max(cosines[k], 0) ** quality.POWER for k in near}
        want = (sum(v * labels[k] for k, v in votes.items()) + 0.01 * model.prior) / (sum(votes.values()) + 0.01)
        assert math.isclose(scores[r.doc_id], want, abs_tol=1e-3), r.doc_id


def plain_words(text):
    """Runs of letters and marks with a letter in them, lower-cased where that is one character."""
    words, word = [], ""
    for c in [*text, "\n"]:
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            word += c
        elif word:
            words.append(word)
            word = ""
    return ["".join(c.lower() if len(c.lower()) == 1 else c for c in w) for w in words if any(c.isalpha() for c in w)]


def triples(word):
    """Buckets of each letter with its neighbours in the word."""
    points, out, full = [0, *map(ord, word), 0], [], (1 << 32) - 1
    for a, b, c in zip(points, points[1:], points[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & full
        h = (h ^ h >> 15) * 0x2C1B3C6D & full
        out.append((h >> 16) % language.BUCKETS)
    return out


def script(word):
    return sum(start <= ord(word[0]) for start in language.SCRIPT_STARTS.tolist())


def plain_languages(taught, texts):
    """Language and score of each text, from texts with their languages: counts, candidates by script, and the best path."""
    counts, letters = {}, {}
    for lang, text in taught:
        own, used = counts.setdefault(lang, Counter()), letters.setdefault(lang, Counter())
        for word in plain_words(text):
            own.update(triples(word))
            used[script(word)] += len(word)
    names, size = sorted(counts), language.BUCKETS
    logs = {n: (counts[n], math.log(counts[n].total() + 0.02 * size)) for n in names}
    each = lambda n, m: sum(k * (math.log(logs[n][0][t] + 0.02) - logs[n][1]) for t, k in counts[m].items()) / counts[m].total()
    least = {n: (each(n, n) + sum(each(n, m) for m in names if m != n) / (len(names) - 1)) / 2 for n in names}
    found = []
    for text in texts:
        words = plain_words(text)
        total, paths = {n: 0.0 for n in names}, {n: [] for n in names}
        for at, word in enumerate(words):
            uses = [n for n in names if letters[n][script(word)] >= language.SCRIPT_SHARE * max(1, letters[n].total())] or names
            worth = {n: sum(math.log(logs[n][0][t] + 0.02) - logs[n][1] for t in triples(word)) if n in uses else -1e6 for n in names}
            best = max(names, key=lambda n: total[n])
            moved = {n: best if at and total[n] < total[best] - language.SWITCH else n for n in names}
            paths = {n: [*paths[moved[n]], n] for n in names}
            total = {n: max(total[n], total[best] - language.SWITCH if at else total[n]) + worth[n] for n in names}
        share, margin = Counter(), 0.0
        for n, word in zip(paths[max(names, key=lambda n: total[n])] if words else [], words):
            share[n] += len(word)
            margin += sum(math.log(logs[n][0][t] + 0.02) - logs[n][1] - least[n] for t in triples(word))
        lang = max(names, key=lambda n: share[n]) if words else "und"
        found.append((lang, share[lang] / share.total() if words else 0.0, margin))
    return found


def test_languages_by_brute_force(spark, monkeypatch):
    docs = given(spark, "documents").where("doc_id < 60")
    rows = docs.orderBy("doc_id").collect()
    assert max(Counter(r.lang for r in rows).values()) <= language.TAUGHT  # so all texts teach
    taught = {(r.lang, r.text) for r in rows if r.text is not None and r.lang is not None}
    texts = [(r.text or "")[:600] for r in rows[:30]]
    texts += [texts[0] + " " + texts[1] + " " + texts[2], "", "́́ 123", "漢字 и слово", "naïve Ünïcode ǅ İx"]
    got = language.label(texts, language.fit(docs)).to_pylist()
    for text, row, (lang, score, margin) in zip(texts, got, plain_languages(sorted(taught), texts), strict=True):
        assert row["lang"] == lang and math.isclose(row["score"], score, abs_tol=1e-9), text[:60]
        if margin > -1e5:  # all words in a script that a language uses
            assert math.isclose(row["margin"], margin, rel_tol=1e-4, abs_tol=0.05), text[:60]


def test_the_language_stage_keeps_what_is_in_a_learned_language(spark):
    docs = given(spark, "documents")
    foreign = ["Szanowni mieszkańcy, w dniu jutrzejszym odbędzie się zebranie w sali gimnastycznej naszej szkoły", "xkq zvbw qqjx wkvz pfhg tzxk qpwm jvkx", "Добрый день, как ваши дела"]
    docs = docs.unionByName(docs.sparkSession.createDataFrame([(10**9 + k, t) for k, t in enumerate(foreign)], "doc_id long, text string"), allowMissingColumns=True)
    model = language.fit(docs.where(fold(4) != 2))
    rows = language.with_languages(docs, model, "f").collect()
    found = {r.doc_id for r in rows if r.f.lang != "und" and r.f.margin >= -4 * 12}
    assert len(rows) - len(found) <= 3 + sum(r.f.lang == "und" for r in rows) + 0.002 * len(rows) and max(found) < 10**9
    kept = [r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()]
    assert sorted(kept) == sorted(r.doc_id for r in docs.collect() if r.doc_id in found)
    assert corpus_pipeline.language_id(spark, no_documents(spark), SF).collect() == []


def test_the_packing_stage_packs_every_id_once(spark):
    tokenizer = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    for docs in (given(spark, "documents"), odd_documents(spark)):
        want = []
        for r in docs.collect():
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
            for k, start in enumerate(range(0, len(ids), 2048)):
                part = ids[start : start + 2048]
                want.append((r.doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        got = corpus_pipeline.best_fit_packing(spark, docs, SF).collect()
        by_piece = lambda rows: sorted(rows, key=str)
        assert by_piece(want) == by_piece((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
        sequences = {}
        for r in got:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in sequences.values():
            ends = [0, *(at + n for at, n in sorted(parts))]
            assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
        used = [sum(n for _, n in parts) for parts in sequences.values()]
        assert sum(2 * n <= 2048 for n in used) <= 1  # two half empty sequences would be one
