"""The operators that SQL gives too: compared with plain versions on odd and skewed rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm.data import LONG, SF, given, no_documents, odd_documents
from oracle import connect, duck_rows, spark_rows

from parcelflow.llm import divergence, lexical_search, pivot_search
from parcelflow.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<double>, label int, score double, block long"


@pytest.mark.parametrize("name", ["op11_exact_top_k", "op12_ranked_lexical_search", "op13_source_divergence"])
def test_query_matches_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(connect(SF), ORACLES[name])


def plain_products(rows, k=10, every=100):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))}
    coded = [(i, [math.floor(x) * 1024 if abs(x) > 2**53 else math.floor(1024 * x) for x in v]) for i, v in usable]
    out = set()
    for q, x in coded:
        if q % every == 0:
            found = {(-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(x, y)))), i) for i, y in coded if i != q and len(x) == len(y)}
            out.update((q, i, -s) for s, i in sorted(found)[:k])
    return out


def check_products(spark, rows, **given):
    df = spark.createDataFrame([(i, v, 0, 0.0, 7) for i, v in rows], VECTORS).repartition(3)
    got = pivot_search.top_products(df, **given).collect()
    assert {(r.query_id, r.vec_id, r.score) for r in got} == plain_products(rows, **given)
    ranks = defaultdict(list)
    for r in got:
        ranks[r.query_id].append((r["rank"], -r.score, r.vec_id))
    for ranked in ranks.values():
        ranked.sort()
        assert [n for n, _, _ in ranked] == list(range(1, len(ranked) + 1)) and ranked == sorted(ranked, key=lambda r: r[1:])
    return df


def test_products_are_exact_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "ROWS", 16)
    monkeypatch.setattr(pivot_search, "GROUP_BLOCKS", 2)
    monkeypatch.setattr(pivot_search, "QUERY_ROWS", 4)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(9, 6)) * 4
    rows = [(i, (centres[i % 9] + rng.normal(size=6) * 0.02).tolist()) for i in range(400)]
    df = check_products(spark, rows, every=20)
    met = pivot_search.top_products(df, every=20, statistics=True).first()
    assert 0 < met.products < met.compared < 400 * 20


def test_products_of_odd_rows(spark):
    same = [1.0, 2.0, -3.0]
    rows = [(i, same) for i in range(60)] + [(100, same), (25, same), (25, same), (25, [3.0, 3.0, 3.0]), (None, same)]
    rows += [(101, None), (102, []), (200, []), (103, [0.0, 0.0, 0.0]), (104, [None, 1.0, 2.0]), (105, [float("nan"), 1.0, 1.0]), (106, [float("-inf"), 1.0, 1.0])]
    rows += [(300, [1e200, -1e200, 1.0]), (107, [5e-324, -5e-324, 0.0]), (400, [1e12, 3.0, 1e12]), (108, [-1e12, 1e12, 0.1]), (500, [2.0, 1.0]), (109, [1.0, 1.0]), (600, [7.0])]
    check_products(spark, rows, k=5)
    check_products(spark, rows, k=30)
    assert pivot_search.top_products(spark.createDataFrame([], VECTORS)).collect() == []


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_ranking(docs, items, k=20):
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    total, length = len(bags), sum(n for _, _, n in bags)
    spread = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        asked = Counter(TERM.findall(lower(text)))
        found = []
        for doc, bag, n in bags:
            m = 75 + 25 * n * total // length
            score = sum(times * math.floor(1000 * math.log((2 * total + 2) / (2 * spread[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, times in asked.items() if t in bag)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


ITEMS = [
    (1, "The SAME text twice; same, same id"),
    (1, "The SAME text twice; same, same id"),
    (1, "another text of the id"),
    (2, None),
    (3, "..."),
    (None, "w1x1 w5x5 W5X5 words 漢字 x"),
    (4, "not-there"),
    (5, LONG),
]


@pytest.mark.parametrize("small", [False, True])
def test_ranking_of_odd_rows(spark, monkeypatch, small):
    if small:
        for name, value in (("VOCABULARY_BYTES", 0), ("CLASSES", 3), ("ITEM_TERMS", 40)):
            monkeypatch.setattr(lexical_search, name, value)
    odd = odd_documents(spark)
    rows = [(100 + k, f"the same text {k % 3 or 'again'} and the word{k % 7}") for k in range(150)] + [(k, "same SAME text") for k in range(900, 930)]
    docs = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, score int, doc_id string")
    got = Counter(tuple(r) for r in lexical_search.ranked_documents(docs, items).collect())
    assert got == plain_ranking([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    if not small:
        assert lexical_search.ranked_documents(no_documents(spark), items).collect() == []
        assert lexical_search.ranked_documents(docs, items.limit(0)).collect() == []


def plain_divergence(docs, least=10, top=10):
    counts, spread, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source, found = lang or "", source or "", LETTERS.findall(lower(text))
        sources[lang].add(source)
        counts[lang, source].update(found)
        spread[lang].update(set(found))
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in spread[lang].items() if n >= least]
        every = sum((counts[lang, s] for s in names), Counter())

        def shares(own):
            below = sum(own[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (own[t] + 2) // below for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in names}, shares(every)
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in names:
            pairs = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in names if o != s]
            terms = [(-apart(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(sorted(found)[:most], 1)]
    return Counter(out)


def test_divergence_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "TERMS", 5)
    rng = np.random.default_rng(3)
    rows = []
    for k in range(600):
        names = [f"{'Éa' if w % 3 else 'B'}{chr(97 + w % 23)}" for w in rng.zipf(1.4, 30).tolist()]
        rows.append((" ".join(names), ["en", "de", None][k % 3], "hot" if k % 3 else f"src{rng.integers(12)}"))
    rows += [("...", "en", "silent"), (None, "en", None), ("only few", "xx", "a"), ("words here", "xx", "b"), ("alone", "yy", "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert Counter(tuple(r) for r in divergence.divergences(docs).collect()) == plain_divergence(rows)


def test_divergence_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert Counter(tuple(r) for r in divergence.divergences(docs, least=1).collect()) == plain_divergence(rows, least=1)
    assert divergence.divergences(no_documents(spark)).collect() == []


def test_divergence_cell_takes_its_sides_in_any_order():
    """Shuffles hand the rows of a block to the two sides in orders of their own."""
    rows = [("en", 0, s, 12, 2, t, c) for n, s in enumerate(["a", "b", "c", ""]) for t, c in ((None, 0), ("x", 8 - n), ("y", n))]
    names = ["lang", "cut", "source", "below", "terms", "term", "count"]
    left, right = (pa.Table.from_pylist([dict(zip(names, r)) for r in order]) for order in (rows, rows[5:][::-1] + rows[:5]))
    key = tuple(map(pa.scalar, ("en", 0, 0, 0)))
    cells = lambda a, b: {(r["source"], r["item"]): r["part_value"] for r in divergence._cell(key, a, b).to_pylist()}
    found = cells(left, right)
    assert set(found) == {(s, o) for s in ("a", "b", "c", "") for o in ("a", "b", "c", "") if s != o}
    assert found == cells(left, left) and all(found[s, o] == found[o, s] for s, o in found)
