"""One query per operator, with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import decontamination, divergence, html_content, language, language_model, lexical_search, near_duplicates, neighbours, packing, pivot_search, quality, records, token_counts
from parcelflow.llm.columns import fold, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs.where(fold(3) != 1), table(spark, sf_dir, "labels"))
    scored = quality.with_scores(docs, model, "score", drop=("text",))
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model.language_scores(docs.where(fold(7) != 2), docs)
    return scored.select("doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("group_doc").alias("class_id"), F.col("class_doc").alias("copy_of"), "n_verified", "n_copies", F.col("group_size").alias("class_size"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(fold(4) != 2))
    found = language.with_languages(docs.select("doc_id", "text"), model, "found", drop=("text",))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_products(table(spark, sf_dir, "embeddings"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_nearest_neighbours,
        op3_token_counts,
        op4_lm_scores,
        op5_minhash_near_duplicates,
        op6_decontamination,
        op7_best_fit_packing,
        op8_language_id,
        op9_html_extraction,
        op10_token_records,
        op11_exact_top_k,
        op12_ranked_lexical_search,
        op13_source_divergence,
    )
}
#: The other operators have no SQL form, or one too slow for whole tables.
ORACLES: dict[str, str] = {
    "op2_nearest_neighbours": """
WITH usable AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op11_exact_top_k": """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op12_ranked_lexical_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM docs WHERE len(words) > 0
), items AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term
), found AS (
  SELECT row, doc_id, term, CAST(count(*) AS BIGINT) AS tf, any_value(n) AS n
  FROM (SELECT row, doc_id, CAST(len(words) AS BIGINT) AS n, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY row, doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM found, totals GROUP BY term
), scored AS (
  SELECT item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM found JOIN weights USING (term) JOIN items USING (term), totals GROUP BY item_id, row, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
    "op13_source_divergence": r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words,
    row_number() OVER () AS row
  FROM documents
), words AS (SELECT lang, source, row, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS BIGINT) AS count FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, CAST(count(*) AS BIGINT) AS v, CAST(sum(count) AS BIGINT) AS total FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, CAST(count(*) AS BIGINT) AS count FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (
  SELECT s.lang, s.source, CAST(coalesce(sum(c.count), 0) AS BIGINT) AS total
  FROM sources s LEFT JOIN counts c USING (lang, source) GROUP BY s.lang, s.source
), shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.count, 0) AS count,
         1 + (1000000000 * (coalesce(c.count, 0) + 2)) // (t.total + 2 * l.v) AS p,
         1 + (1000000000 * (k.count + 2)) // (l.total + 2 * l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE count > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
