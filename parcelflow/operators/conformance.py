"""How well payloads and tables fit the promoted columns: names, types, lengths, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import coerce as co
from parcelflow.schema import PROMOTED, Field


def _expected(field: Field) -> str:
    return f"string({field.width})" if field.width else field.sql_type


def _required(spark: SparkSession, fields: Sequence[Field]) -> DataFrame:
    rows = [(n, f.name, _expected(f)) for n, f in enumerate(fields)]
    return spark.createDataFrame(rows, "position int, column_name string, expected string")


def _verdict(held: Column, other: Column, too_long: Column, gaps: Column) -> Column:
    """The first fault that applies, in the order of how much it breaks."""
    return (
        F.when(~held, "missing")
        .when(other, "other type")
        .when(too_long, "too long")
        .when(gaps, "nullable")
        .otherwise("sound")
    )


def payload_conformance(
    payloads: DataFrame, fields: Sequence[Field] = PROMOTED, raw: str = "raw"
) -> DataFrame:
    """One row per required column: what the payloads send for it.

    ``sent`` is the type that all values of the column have in common,
    ``VARIANT`` where they have none. A value counts as of another type if it
    cannot be read as the column's; text that only is too long counts apart.
    A payload that is no JSON object carries no column. Each payload is
    parsed once and gives one narrow row a column; types and counts are merged
    per task, so the shuffle carries one row per column and task.
    """
    names = [f.name for f in fields]

    def fault(field: Field) -> Column:
        kind, text = F.col(f"_kind_{field.name}"), F.col(f"_text_{field.name}")
        too_long = F.lit(False)
        if field.is_text and field.width:
            too_long = F.coalesce((kind == "STRING") & (F.length(text) > field.width), F.lit(False))
        unread = co.unusable(F.col("_in").getField(field.name), co.coerce(kind, text, field))
        return F.when(too_long, "long").when(unread, "other").alias(f"_fault_{field.name}")

    def seen(name: str) -> Column:
        return F.struct(F.lit(name).alias("column_name"), F.col("_in").getField(name).alias("value"), F.col(f"_fault_{name}").alias("fault"))

    # Kind and text are named columns so that each is taken out only once.
    faults = (
        payloads.select(co.read_fields(F.col(raw), names).alias("_in"))
        .select(
            "_in",
            *[co.json_kind(F.col("_in").getField(n)).alias(f"_kind_{n}") for n in names],
            *[co.json_text(F.col("_in").getField(n)).alias(f"_text_{n}") for n in names],
        )
        .select("_in", *[fault(f) for f in fields])
    )
    value = F.col("s.value")
    found = (
        faults.select(F.explode(F.array(*[seen(n) for n in names])).alias("s"))
        .groupBy(F.col("s.column_name").alias("column_name"))
        .agg(
            F.schema_of_variant_agg(value).alias("sent"),
            F.count("*").alias("n_payloads"),
            F.count_if(value.isNull()).alias("n_missing"),
            F.count_if(F.coalesce(F.is_variant_null(value), F.lit(False))).alias("n_null"),
            F.count_if(F.col("s.fault") == "other").alias("n_other_type"),
            F.count_if(F.col("s.fault") == "long").alias("n_too_long"),
        )
    )
    counts = ["n_payloads", "n_missing", "n_null", "n_other_type", "n_too_long"]
    whole = _required(payloads.sparkSession, fields).join(found, "column_name", "left").na.fill(0, counts)
    gaps = F.col("n_missing") + F.col("n_null")
    verdict = _verdict(gaps < F.col("n_payloads"), F.col("n_other_type") > 0, F.col("n_too_long") > 0, gaps > 0)
    return whole.select("position", "column_name", "expected", "sent", *counts, verdict.alias("verdict"))


def table_conformance(table: DataFrame, fields: Sequence[Field] = PROMOTED) -> DataFrame:
    """One row per required column: what the stored table holds for it.

    Names are compared without regard to case. Lengths and gaps come from one
    aggregation over the columns that the table has; columns of another type
    are not measured for length.
    """
    held = {f.name.lower(): f for f in table.schema.fields}

    def measured(field: Field) -> Column:
        own = held.get(field.name.lower())
        actual = own.dataType.simpleString() if own is not None else None
        length = F.lit(None).cast("int")
        if actual == "string" and field.width:
            length = F.max(F.length(F.col(own.name)))
        empty = F.count("*") - (F.count(F.col(own.name)) if own is not None else F.lit(0))
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(actual).cast("string").alias("actual"),
            length.alias("longest"),
            empty.alias("n_null"),
            F.lit(field.width).cast("int").alias("_width"),
            F.lit(field.sql_type).alias("_type"),
        )

    columns = table.agg(F.array(*[measured(f) for f in fields]).alias("m")).select(F.inline("m"))
    verdict = _verdict(
        F.col("actual").isNotNull(),
        F.col("actual") != F.col("_type"),
        F.coalesce(F.col("longest") > F.col("_width"), F.lit(False)),
        F.col("n_null") > 0,
    )
    return _required(table.sparkSession, fields).join(columns, "column_name").select(
        "position", "column_name", "expected", "actual", "longest", "n_null", verdict.alias("verdict")
    )
