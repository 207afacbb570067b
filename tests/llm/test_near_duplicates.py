import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from llm.data import ODD_TEXTS, given, no_documents, odd_documents

from parcelflow.llm import near_duplicates as nd
from parcelflow.llm.wordhash import WINDOW_BYTES, word_hashes
from parcelflow.llm.decontamination import normalised


def plain_bag(text):
    words = normalised(text or "").split(" ")[1:-1]
    n = max(1, len(words) - 4)
    return Counter(tuple(words[k : k + 5]) for k in range(n)) if words else Counter()


def plain_groups(rows):
    """Least doc_id of each row's component, by comparing all pairs."""
    bags = [plain_bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        shared = (bags[a] & bags[b]).total()
        if shared and shared / (bags[a].total() + bags[b].total() - shared) >= 0.8:
            root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i, key=lambda x: (x is None, x))
    return sorted(((i, least[top(k)]) for k, (i, _) in enumerate(rows)), key=str)


def groups(df):
    return sorted(((r.doc_id, r.group_doc) for r in nd.near_duplicates(df).collect()), key=str)


def edited(words, edits, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), edits):
        out[k] = f"new{rng.random()}"
    return " ".join(out)


def documents(seed=3):
    """Families around a text, a chain of texts, texts that share a half, repeated shingles."""
    rng = random.Random(seed)
    words = [f"word{k}" for k in range(400)]
    texts = []
    for _ in range(4):
        base = rng.choices(words, k=120)
        texts += [" ".join(base), *(edited(base, n, rng) for n in (1, 1, 2, 2, 3, 3, 4, 5))]
    chain = rng.choices(words, k=150)
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = edited(chain, 2, rng).split()
    half = rng.choices(words, k=80)
    texts += [" ".join(half + rng.choices(words, k=25)) for _ in range(8)]
    loop = rng.choices(words, k=6)
    texts += [" ".join(loop * n) for n in (10, 11, 12, 14, 20, 40)]
    rng.shuffle(texts)
    return list(enumerate(texts + texts[:10]))


@pytest.mark.parametrize("blocks", [(1024, 4 << 20), (2, 4 << 20)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(nd, "BLOCK_CLASSES", blocks[0])
    rows = documents()
    assert groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == plain_groups(rows)


def test_groups_of_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in given(spark, "documents").collect()]
    assert groups(given(spark, "documents")) == plain_groups(rows)


def test_odd_rows_and_one_of_each(spark):
    found = nd.near_duplicates(odd_documents(spark)).collect()
    assert len(found) == len(ODD_TEXTS)
    by = Counter((r.doc_id, r.group_doc, r.group_size, r.n_copies) for r in found)
    assert by[(3, 3, 3, 3)] == 2 and by[(4, 3, 3, 3)] == 1
    assert by[(1, 1, 1, 1)] == by[(2, 2, 1, 1)] == by[(5, 5, 1, 1)] == by[(None, None, 1, 1)] == 1
    kept = nd.one_of_each_group(odd_documents(spark))
    assert kept.schema == odd_documents(spark).schema
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(i for i, _, _ in ODD_TEXTS) - Counter([3, 4])
    assert nd.near_duplicates(no_documents(spark)).collect() == []
    assert nd.one_of_each_group(no_documents(spark)).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = documents(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in nd.one_of_each_group(df).collect()) == sorted({g for _, g in plain_groups(rows)})


def bag(rng, size, most):
    shingles = np.unique(rng.integers(0, 4000, size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return shingles, rng.integers(1, most + 1, len(shingles))


@pytest.mark.parametrize("most", [1, 3, 20])
def test_signatures_estimate_the_weighted_overlap(most):
    rng = np.random.default_rng(most)
    shingles, counts = bag(rng, 600, most)
    for keep in (1.0, 0.85, 0.5):
        on = rng.random(len(shingles)) < keep
        other = shingles[on], np.maximum(1, counts[on] - rng.integers(0, 2, on.sum()))
        both = np.concatenate([shingles, other[0]]), np.concatenate([counts, other[1]]), np.repeat([0, 1], [len(shingles), len(other[0])])
        a, b = nd.signatures(*both, 2, size=4000)
        assert abs((a == b).mean() - nd.overlap((shingles, counts), other)) < 0.04


def test_a_signature_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(0)
    bags = [bag(rng, n, 9) for n in (1, 3, 50, 2000)]
    together = nd.signatures(*(np.concatenate(x) for x in zip(*bags)), np.repeat(range(4), [len(s) for s, _ in bags]), 4)
    for row, (s, c) in zip(together, bags):
        assert (row == nd.signatures(s, c, np.zeros(len(s), int), 1)[0]).all()


def test_shared_counts_are_those_of_single_pairs():
    rng = np.random.default_rng(4)
    for _ in range(20):
        left, right = ([(np.unique(rng.integers(0, 60, 25).astype(np.uint64)), None) for _ in range(rng.integers(1, 9))] for _ in range(2))
        left, right = ([(s, rng.integers(1, 4, len(s))) for s, _ in side] for side in (left, right))
        got = nd.shared_counts(left, right)
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                _, x, y = np.intersect1d(a[0], b[0], return_indices=True)
                assert got[i, j] == np.minimum(a[1][x], b[1][y]).sum()


def test_word_hashes_are_of_words_alone():
    one = lambda t: word_hashes(np.frombuffer(t.encode(), np.uint8)).tolist()
    assert one("Ab-é 12x") == [*one("aB"), *one("é"), *one("12X")]
    assert one("") == one(" .!") == []
    long = "word other " * (WINDOW_BYTES // 8)
    assert set(one(long)) == {*one("word other")} and len(one(long)) == 2 * (WINDOW_BYTES // 8)
    words = {f"w{k}" for k in range(20000)}
    assert len(set(one(" ".join(words)))) == len(words)
