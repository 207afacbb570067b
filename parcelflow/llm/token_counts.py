"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, texts_of
from parcelflow.llm.pieces import length_encoder


def token_counts(docs: DataFrame, model_path: str, context: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    Texts are encoded in Arrow batches of about equal bytes; only lengths come
    back. Long texts are cut at safe spaces (``pieces``), so a task holds one
    span of a text at a time. Null and empty texts have 0 bytes and 0 tokens;
    repeated rows are counted each; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = length_encoder(model_path)
        for batch in by_bytes(batches, "text"):
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            tokens = pa.array(encoder.encode(texts_of(batch)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > context)
