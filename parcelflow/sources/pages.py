"""Feed pages: landed envelopes in, records out.

A page is one JSON envelope: an array of records under ``value`` and, on all
but the last page, a link to the next. Pages are landed one per file, with the
page number in the path (``page-000012.json`` or ``page_no=12/...``). The pages of a
run are numbered from 0 without gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE_DDL = "value array<string>, `@odata.nextLink` string"
# The last such number in the path: folders above may be called anything.
_PAGE_NUMBER = r".*page(?:_no=|[-_]?)0*(\d+)"


def _numbered(df: DataFrame) -> DataFrame:
    number = F.regexp_extract(F.col("_metadata.file_path"), _PAGE_NUMBER, 1)
    return df.select(number.cast("bigint").alias("page_no"), F.col("value").alias("body"))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """All landed pages as ``(page_no, body)``."""
    return _numbered(
        spark.read.schema("value string").option("wholetext", True).text(path)
    )


def stream_landed(spark: SparkSession, path: str, pages_per_batch: int) -> DataFrame:
    """Landed pages as a stream of ``(page_no, body)``.

    The file source orders files by modification time, not by page, so
    nothing downstream relies on arrival order: ``page_no`` travels along.
    """
    return _numbered(
        spark.readStream.schema("value string")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", pages_per_batch)
        # Landed copies may keep old file times; none is too old to read.
        .option("maxFileAge", "36500d")
        .text(path)
    )


def _envelope(body: Column) -> Column:
    # FAILFAST: a cut-off page must stop the run, not pass for an empty one.
    return F.from_json(body, ENVELOPE_DDL, {"mode": "FAILFAST"})


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_no, next_link)`` of pages, without their records."""
    link = F.from_json("body", "`@odata.nextLink` string", {"mode": "FAILFAST"})
    return pages.select("page_no", link.getField("@odata.nextLink").alias("next_link"))


def open_pages(pages: DataFrame) -> DataFrame:
    """One row per record: ``(page_no, next_link, pos, raw)``.

    A page whose ``value`` is empty, null or missing keeps one row with a NULL
    ``pos`` so that its link still moves the cursor. The link is taken out
    beforehand: taken out of the exploded rows, each of them would carry a
    copy of its whole page.
    """
    env = F.col("env")
    opened = pages.select("page_no", _envelope(F.col("body")).alias("env")).select(
        "page_no", env.getField("@odata.nextLink").alias("next_link"), env.getField("value").alias("records")
    )
    return opened.select("page_no", "next_link", F.posexplode_outer("records").alias("pos", "raw"))


def follow_chain(pages: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Keep pages up to and including the first one without a link.

    With no such page the chain is still open and every page counts. The end
    is a single number, computed once as a scalar subquery. ``links`` may be a
    narrower source of ``(page_no, next_link)``, such as the page ledger, which
    saves a second look at the bodies.
    """
    source = pages if links is None else links
    end = source.where(F.col("next_link").isNull()).agg(F.min("page_no")).scalar()
    return pages.where(F.col("page_no") <= F.coalesce(end, F.lit(2**63 - 1)))


def pages_after(pages: DataFrame, committed: DataFrame) -> DataFrame:
    """Pages still to be read: those past the last committed one.

    Pages commit in chain order, so the committed ones are a prefix and one
    number bounds them. Page bodies are neither joined nor shuffled.
    """
    last = committed.agg(F.max("page_no")).scalar()
    return pages.where(F.col("page_no") > F.coalesce(last, F.lit(-1)))


def pack_pages(records: DataFrame) -> DataFrame:
    """Records ``(page_no, next_link, pos, raw)`` to envelopes ``(page_no, body)``.

    The inverse of ``open_pages``, marker rows of empty pages included. One
    output row holds one page, so a group never exceeds the page size.
    """
    record = F.when(F.col("pos").isNotNull(), F.struct("pos", "raw"))
    in_order = F.sort_array(F.collect_list(record))
    value = F.concat_ws(",", F.transform(in_order, lambda r: r["raw"]))
    link = F.when(
        F.col("next_link").isNotNull(),
        F.concat(F.lit(',"@odata.nextLink":"'), "next_link", F.lit('"')),
    ).otherwise("")
    return (
        records.groupBy("page_no", "next_link")
        .agg(value.alias("records"))
        .select(
            "page_no",
            F.concat(F.lit('{"value":['), "records", F.lit("]"), link, F.lit("}")).alias(
                "body"
            ),
        )
    )


def land_pages(pages: DataFrame, path: str) -> None:
    """Write each page as one file below ``page_no=<n>/``."""
    pages.select("page_no", "body").write.mode("overwrite").partitionBy("page_no").text(path)
