"""Clashing column names in every stage, texts without letters, many languages, vectors near the ends of doubles."""

import unicodedata
from collections import Counter

import numpy as np
import pytest
from llm.data import SF, given, odd_documents
from llm.test_search import plain_nearest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelflow.llm import language
from parcelflow.llm.columns import free_name, with_texts_mapped
from parcelflow.llm.neighbours import nearest

CLASHES = ["_score", "_found", "_doc", "_hash", "_text_hash", "_hits", "_HITS_1", "_repeated", "label", "lang_pred", "hits", "spans", "_order", "_rank"]


def clashing(spark):
    """Odd documents and given ones, with a column for each name that a stage may want."""
    docs = odd_documents(spark).drop("hits", "_score", "label").unionByName(given(spark, "documents"), allowMissingColumns=True)
    return docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES])


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_leaves_columns_of_any_name_alone(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = clashing(spark)
    made = stage(spark, docs, SF)
    if name == "best_fit_packing":
        assert made.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
        return
    assert made.columns == docs.columns
    before, after = (Counter(tuple(r) for r in df.collect()) for df in (docs, made))
    assert after and not after - before


def test_free_names():
    class Of:
        columns = ["a", "A_1", "b"]

    assert [free_name(Of, n) for n in ("a", "B", "c")] == ["a_2", "B_1", "c"]


def test_a_name_that_is_taken_is_refused(spark):
    with pytest.raises(ValueError, match="already"):
        with_texts_mapped(spark.createDataFrame([("x", 1)], "text string, Score int"), "score", "double", lambda: None)


TAUGHT = [("en", "the cat and the dog"), ("de", "die Katze und der Hund"), ("ru", "кот и собака"), ("hi", "किताब और कलम")]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(lang, " ".join([text] * 20)) for lang, text in TAUGHT] + [("zz", "123"), (None, "the"), ("en", None)], "lang string, text string")
    return language.fit(docs)


def test_texts_without_a_letter_have_no_language(model):
    assert model.names == ["de", "en", "hi", "ru", "zz"]
    texts = ["́̂ 12 ̃", "", "12 -- ิ", "́the cat", "किताब और", "1a1", "\U0001f642"]
    got = language.label(texts, model).to_pylist()
    assert [r["lang"] == "und" for r in got] == [not any(c.isalpha() for c in t) for t in texts]
    assert all((r["score"], r["spans"]) == (0.0, []) for r in got if r["lang"] == "und")
    assert got[3]["lang"] == "en" and got[4]["lang"] == "hi"


def plain_scores(model, word):
    """The score of a word from its letters' triples, one at a time."""
    inside, _, lower = language._tables()
    points = [int(lower[ord(c)]) for c in word]
    made = np.zeros(len(model.names))
    for left, here, right in zip([0, *points], points, [*points[1:], 0]):
        x = (left * 0x9E3779B1 + here * 0x85EBCA77 + right * 0xC2B2AE3D) % 2**32
        x = (x ^ (x >> 15)) * 0x2C1B3C6D % 2**32
        made += model.scores[(x >> 16) % language.BUCKETS]
    return made


def test_word_scores_and_candidates_are_those_of_a_plain_count(model):
    texts = ["The cat und Собака 12 किताब", "x́y Katze"]
    words = language.words_of(texts)
    plain = []
    for n, text in enumerate(texts):
        run = ""
        for at, c in enumerate(text + " "):
            if c.isalpha() or unicodedata.category(c)[0] == "M":
                run += c
            elif run:
                plain.append((n, at - len(run), at, run))
                run = ""
    assert [w[:3] for w in plain] == list(zip(words.text.tolist(), words.start.tolist(), words.stop.tolist()))
    got = model.word_scores(words)
    for (*_, word), script, row in zip(plain, words.script.tolist(), got):
        allowed = model.allowed[script]
        want = np.where(allowed | (not allowed.any()), plain_scores(model, word), -1e6)
        assert np.allclose(row, want, rtol=1e-4)


def test_many_languages_are_learned_in_one_plan(spark):
    rows = [(f"l{n:03d}", f"{chr(0x4E00 + 3 * n)}{chr(0x4E01 + 3 * n)} wort{n} " * 5) for n in range(150)]
    found = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert found.names == [lang for lang, _ in rows]
    labelled = language.label([text for _, text in rows], found).to_pylist()
    assert np.mean([r["lang"] == lang for r, (lang, _) in zip(labelled, rows)]) > 0.95


def test_neighbours_of_vectors_near_the_ends_of_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.choice([-320, -310, -160, 0, 150])).tolist()) for i in range(120)]
    rows += [(200, [1e200, 2e-310, 0.0, 0.0]), (201, [-1e200, 1.0, 0.0, 0.0]), (202, [5e-324, 0.0, 0.0, 0.0]), (220, [1e100, 1e100, 0.0, 1.0]), (221, [1e203, 0.0, 0.0, 1e50])]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert sorted(tuple(r) for r in nearest(df, 10).collect()) == plain_nearest(rows, 10)
