import time

import numpy as np
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from llm.data import ODD_TEXTS, given, no_documents, odd_documents

from parcelflow.llm import decontamination, neighbours
from parcelflow.llm.decontamination import without_contaminated
from parcelflow.llm.neighbours import nearest

VECTORS = "vec_id long, embedding array<float>, label int, score double"


def plain_nearest(rows, k=20):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = []
    for q, x in usable:
        if q % 20 == 0:
            found = []
            for i, y in usable:
                if i != q and len(x) == len(y):
                    score = 0.0
                    for a, b in zip(x, y):
                        score += a * b
                    found.append((-score, i))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def check(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], VECTORS).repartition(3)
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(tuple(r) for r in nearest(df, k).collect()) == plain_nearest(stored, k)


def test_neighbours_are_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATE_ROWS", 32)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(150)]
    check(spark, rows)


def test_neighbours_of_odd_rows(spark):
    same = [1.0, 2.0, -3.0]
    rows = [(i, same) for i in range(60)] + [(20, same), (25, same), (25, same)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [None, 1.0, 2.0]), (104, [float("nan"), 1.0, 1.0]), (105, [float("inf"), 1.0, 1.0]), (None, same)]
    rows += [(120, [5.0, 1.0]), (121, [1.0, 1.0]), (140, [2.0, 0.0, 1e-30]), (160, [1e30, 0.0, 0.0]), (161, [-1.0, 0.5, 0.25])]
    check(spark, rows, k=5)
    check(spark, rows, k=20)
    assert nearest(spark.createDataFrame([], VECTORS)).collect() == []


def test_no_block_goes_through_the_driver(spark, monkeypatch):
    # Query blocks are copied for every group, so their files say little about the copies.
    monkeypatch.setattr(neighbours, "CANDIDATE_ROWS", 32)
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(1000)]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_neighbours_of_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in given(spark, "embeddings").collect()]
    got = sorted(tuple(r) for r in nearest(given(spark, "embeddings")).collect())
    assert got == plain_nearest(rows)


def test_error_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = (rng.normal(size=(40, 16)) * 10.0 ** rng.integers(-3, 4, (40, 1)) for _ in range(2))
    a, b = (neighbours.Tile.of(16, np.arange(40).tobytes(), v.tobytes(), "f8") for v in (x, y))
    about = a.codes.astype(float) @ b.codes.T.astype(float) * a.scale[:, None] * b.scale
    off = a.coded[:, None] * b.rest + a.rest[:, None] * b.length + 1e-12 * a.length[:, None] * b.length
    assert (abs(x @ y.T - about) <= off).all()


def plain_hits(text, items):
    words = decontamination.normalised(text or "").split(" ")[1:-1]
    hit, found = set(), set()
    for item, body in items:
        own = decontamination.normalised(body or "").split(" ")[1:-1]
        n = min(13, len(own))
        windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(item)
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "same text"),
    (11, "ONE"),
    (12, "one!"),
    (13, None),
    (14, "..."),
    (None, "eta THETA"),
    (2, "same text"),
]


def test_hits_are_those_of_a_plain_search(spark, monkeypatch):
    docs = [
        (1, "x alpha Beta gamma delta epsilon-zeta eta theta iota kappa lambda mu nu xi y eta theta"),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
        (3, "the same-text and the same text text; one"),
        (4, "someone onex ones"),
    ]
    rows = docs + [(k + 10, t) for k, (_, t, _) in enumerate(ODD_TEXTS) if t is None or len(t) < 1000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_words string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted((i, *plain_hits(t, [("" if k is None else str(k), b) for k, b in ITEMS])) for i, t in rows)
    for limit in (1 << 20, 40):  # one automaton, and one for nearly each item
        monkeypatch.setattr(decontamination, "ITEM_BYTES", limit)
        found = decontamination.with_hits(df, items, "hits").collect()
        assert sorted((r.doc_id, r.hits.n_words, sum(s.stop - s.first for s in r.hits.spans), r.hits["items"]) for r in found) == want
        text = dict(rows)
        for r in found:
            for s in r.hits.spans:
                assert len(decontamination.normalised(text[r.doc_id][s.start : s.end]).split()) == s.stop - s.first
    short = decontamination.decontamination(df, items).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in short) == [(i, n, h, len(f)) for i, n, h, f in want]
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in short)
    kept = without_contaminated(df, items)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in short if not r.contaminated}


def test_no_items_and_no_documents(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontamination.decontamination(odd_documents(spark), items).collect()] == [0] * len(ODD_TEXTS)
    assert decontamination.decontamination(no_documents(spark), given(spark, "benchmark")).collect() == []


def test_hits_in_the_given_table(spark):
    items = [(str(r.item_id), r.text) for r in given(spark, "benchmark").collect()]
    want = sorted((r.doc_id, *plain_hits(r.text, items)) for r in given(spark, "documents").collect())
    got = decontamination.with_hits(given(spark, "documents"), given(spark, "benchmark"), "hits").collect()
    assert sorted((r.doc_id, r.hits.n_words, sum(s.stop - s.first for s in r.hits.spans), r.hits["items"]) for r in got) == want
    assert any(h for _, _, h, _ in want)


@settings(max_examples=200, deadline=None)
@drawn(st.lists(st.lists(st.sampled_from("abc"), min_size=0, max_size=40), max_size=4), st.integers(0, 10**6))
def test_windows_in_blocks_are_those_of_a_plain_search(items, seed):
    rng = np.random.default_rng(seed)
    items = [(str(k), " ".join(words)) for k, words in enumerate(items)]
    parts = [" ".join(text.split()[a : a + 20]) for _, text in items for a in rng.integers(0, 20, 2)]
    text = ", ".join([*parts, *rng.choice(list("abcX"), 12)])
    n, spans, found = decontamination.hits(text, decontamination.Windows(items))
    assert (n, sum(s[1] - s[0] for s in spans), sorted(found)) == plain_hits(text, items)
    assert all(len(decontamination.normalised(text[start:end]).split()) == stop - first for first, stop, start, end in spans)


def test_repeated_words_and_common_blocks_stay_cheap():
    same = "which of the following is the correct"
    items = [("r", "word " * 5000), *((str(k), f"a{k} b{k} c{k} {same} d{k} e{k} f{k} g{k}") for k in range(5000))]
    windows = decontamination.Windows(items)
    text = "Word " * 20000 + f"{same} one. " * 5000 + items[7][1]
    start = time.process_time()
    n, spans, found = decontamination.hits(text, windows)
    assert found == {"r", items[7][0]} and [s[:2] for s in spans] == [(0, 20000), (n - 14, n)]
    assert time.process_time() - start < 10


def test_very_long_texts_are_scanned_whole():
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    windows = decontamination.Windows([("a", item)])
    filler = "Other, words. " * 350_000  # beyond the bytes that are taken apart at once
    for at in (0, 7 * 2**19, len(filler)):
        n, spans, found = decontamination.hits(f"{filler[:at]} {item} {filler[at:]}", windows)
        ((first, stop, start, end),) = spans
        assert found == {"a"} and (stop - first, end - start) == (14, len(item)) and n in (700_014, 700_015)
