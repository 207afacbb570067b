"""Small tables with the odd cases every operator must take, and rows of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, hits int, _score int, label int"

LONG = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
ODD_TEXTS = [
    (1, None, "en"),
    (2, "", "en"),
    (None, "a text without an id and some more words", None),
    (3, "the same text twice for two rows of one id", "en"),
    (3, "the same text twice for two rows of one id", "en"),
    (4, "the same text twice for two rows of one id", None),
    (5, " \t\n  \x0b ", "en"),
    (6, "... --- !!! 123 456", "en"),
    (7, LONG, "en"),
    (8, "x" * 300_000, "en"),
    (9, "É è ñ 漢字 かな ́ \U0001f642 <s></s> <|endoftext|> İstanbul ß ▁ a▁b", "fr"),
    (10, "one", "en"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    rows = [(i, t, lang, None, len(t or ""), "clash", 1, 2, 3) for i, t, lang in ODD_TEXTS]
    return spark.createDataFrame(rows, COLUMNS)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COLUMNS)


def given(spark: SparkSession, name: str, sf_dir: str = SF) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
