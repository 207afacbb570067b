"""The bulk-load file: quoted fields, bare ``\\N`` for NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.functions.text import csv_field, csv_fields, csv_line, csv_value, n_quotes, without_escapes


def line_of(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The columns of a row as one line of the file."""
    types = dict(df.dtypes)
    return csv_line(*[csv_field(F.col(c), types[c]) for c in columns or df.columns])


def write_bulk_file(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Write the rows as text, one file per task.

    ``write.csv`` would quote the NULL marker and cut times to milliseconds.
    """
    df.select(line_of(df, columns).alias("value")).write.mode("overwrite").text(path)


def records_of(lines: DataFrame) -> DataFrame:
    """Whole records, without escapes, of lines ``(file, block, line_no, plain)``.

    A line end inside quotes belongs to a field, so a record may span lines: a
    line with an odd number of quotes opens or closes one. Whether a line starts
    inside a field follows from the quotes before it: added up inside its block
    of the file, and for the blocks of a file once more. Only lines of records
    that span several are gathered again; all others are records as they stand.
    """
    turns = lines.withColumn("turn", n_quotes(F.col("plain")) % 2)
    before = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum("turn").over(before), F.lit(0))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("file", "block").agg(F.sum("turn").alias("turns"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"))
    placed = turns.withColumn("so_far", so_far).join(blocks, ["file", "block"])
    at = F.col("turns_before") + F.col("so_far")
    # An opening and the lines up to its closing share a number: half the turns before.
    placed = placed.select("file", "block", "line_no", "plain", at.alias("at"), ((at % 2 == 1) | (F.col("turn") == 1)).alias("part"))
    whole = placed.where(~F.col("part")).select("plain")
    parts = F.sort_array(F.collect_list(F.struct("block", "line_no", "plain")))
    spanning = placed.where("part").groupBy("file", F.expr("at div 2")).agg(F.concat_ws("\n", F.transform(parts, lambda p: p["plain"])).alias("plain"))
    return whole.unionByName(spanning.select("plain"))


def read_bulk_file(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of a file in the bulk-load dialect: the inverse of :func:`write_bulk_file`.

    Bare ``\\N`` is NULL, the quoted text ``"\\\\N"`` is not. Times are UTC. A
    value that its column cannot hold is NULL, as are fields that a record lacks.
    Files are read in blocks, so a large one is shared by many tasks.
    """
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        without_escapes(F.col("value")).alias("plain"),
    )
    fields = records_of(lines).select(csv_fields(F.col("plain")).alias("f"))
    return fields.select(*[csv_value(F.get("f", F.lit(n)), c.dataType.simpleString()).alias(c.name) for n, c in enumerate(kind.fields)])
