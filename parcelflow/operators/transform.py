"""Record to row: key check, typing, validation and payload."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import coerce as co
from parcelflow.functions.text import has_text
from parcelflow.schema import (
    EMPTY_PAGE,
    HOT_COLUMNS,
    IDENTIFYING,
    INVALID,
    KEY,
    NO_KEY,
    PROMOTED,
    PROMOTED_NAMES,
    RAW_COLUMNS,
    STORED,
    Field,
)


def lacks_key(key: Column) -> Column:
    """True where the key (VARIANT) is absent, null, empty or blank.

    A key that is present but not text is not "lacking"; it fails validation.
    """
    return _is_blank(co.json_kind(key), co.json_text(key))


def _is_blank(kind: Column, text: Column) -> Column:
    blank = (kind == "STRING") & ~has_text(text)
    return ~co.sent(kind) | F.coalesce(blank, F.lit(False))


def with_key(records: DataFrame, raw: str = "raw") -> DataFrame:
    """Records that carry a usable key; the key itself is left untrimmed."""
    return records.where(~lacks_key(_key_of(raw)))


def without_key(records: DataFrame, raw: str = "raw") -> DataFrame:
    return records.where(lacks_key(_key_of(raw)))


def _key_of(raw: str) -> Column:
    return co.read_fields(F.col(raw), [KEY]).getField(KEY)


def identifying(raw: Column) -> Column:
    """What is known of a keyless record, as a map of its non-null fields."""
    fields = F.from_json(raw, ", ".join(f"`{n}` string" for n in IDENTIFYING))
    entries = F.create_map(
        *[part for n in IDENTIFYING for part in (F.lit(n), fields.getField(n))]
    )
    return F.map_filter(entries, lambda _, v: v.isNotNull())


def skip_report(records: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per record dropped for want of a key."""
    return without_key(records, raw).withColumn("identifying", identifying(F.col(raw)))


def _computed_once(column: Column) -> Column:
    """Keep filters on this column above the projection that computes it.

    A filter on an ordinary column moves below its projection with the whole
    expression in place of the name; for ``outcome`` that would parse the
    record again for every field. Filters never move below a projection that
    holds a non-deterministic column, while unused columns are still pruned.
    A random number is one that streams allow too. It is not compared as it is,
    since Spark knows its range and drops a comparison that always holds.
    """
    return F.when(F.rand(0) + 1 > 0, column)


@cache
def _typing(application: str, fields: tuple[Field, ...], raw: str) -> dict[str, list[Column]]:
    """The column expressions of ``type_records``.

    Building some hundred expressions takes seconds in Python, so they are
    kept per application and reused for every batch.
    """

    def source(field: Field) -> Column:
        return F.col("_in").getField(field.name)

    bad = [
        F.when(F.col(f.name).isNull() & co.sent(F.col(f"_kind_{f.name}")), F.lit(f.name))
        for f in fields
    ]
    outcome = (
        F.when(F.col("pos").isNull(), EMPTY_PAGE)
        .when(~F.coalesce(F.col(raw).startswith("{"), F.lit(False)), INVALID)
        .when(_is_blank(F.col(f"_kind_{KEY}"), F.col(f"_text_{KEY}")), NO_KEY)
        .when(F.col("_bad") != "", INVALID)
        .otherwise(STORED)
    )
    return {
        "parse": [co.read_fields(F.col(raw), [f.name for f in fields]).alias("_in")],
        # Kind and text are named columns so that each is taken out only once.
        "scalars": [
            *[co.json_kind(source(f)).alias(f"_kind_{f.name}") for f in fields],
            *[co.json_text(source(f)).alias(f"_text_{f.name}") for f in fields],
        ],
        "typed": [
            co.coerce(F.col(f"_kind_{f.name}"), F.col(f"_text_{f.name}"), f).alias(f.name)
            for f in fields
        ],
        # One text, since lambdas over arrays are not compiled: they took a fifth of the time.
        "bad": [F.concat_ws(",", *bad).alias("_bad")],
        "outcome": [
            _computed_once(outcome).alias("outcome"),
            F.array_remove(F.split("_bad", ","), "").alias("bad_fields"),
        ],
    }


def type_records(
    records: DataFrame, fields: Sequence[Field] = PROMOTED, raw: str = "raw"
) -> DataFrame:
    """Add the typed columns, ``bad_fields`` and ``outcome`` to each record.

    The record's JSON is parsed once. ``pos`` is NULL only for the marker row
    of an empty page.
    """
    application = records.sparkSession.sparkContext.applicationId
    columns = _typing(application, tuple(fields), raw)
    passed = [c for c in records.columns if c != raw]
    names = [f.name for f in fields]
    kinds = [f"_kind_{n}" for n in names]
    # Each step copies its rows: what no later step reads is left behind.
    return (
        records.select(*passed, raw, *columns["parse"])
        .select(*passed, raw, *columns["scalars"])
        .select(*passed, raw, *kinds, f"_text_{KEY}", *columns["typed"])
        .select(*passed, raw, f"_kind_{KEY}", f"_text_{KEY}", *names, *columns["bad"])
        .select(*passed, *columns["outcome"], *names, F.col(raw).alias("raw_data"))
    )


def enforce(typed: DataFrame) -> DataFrame:
    """Stop at the first record with a field that cannot be read."""
    message = F.concat(
        F.lit("invalid record: key="),
        F.coalesce(F.col(KEY), F.lit("?")),
        F.lit(" fields="),
        F.concat_ws(",", "bad_fields"),
    )
    checked = F.when(
        F.col("outcome") == INVALID, F.raise_error(message).cast("string")
    ).otherwise(F.col("outcome"))
    return typed.withColumn("outcome", checked)


def stored_rows(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("outcome") == STORED)


def rejected_rows(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("outcome") == INVALID)


def unknown_fields(raw: Column) -> Column:
    """Fields outside the promoted set, as a map of name to text."""
    every = F.from_json(raw, "map<string,string>")
    return F.map_filter(every, lambda name, _: ~name.isin(*PROMOTED_NAMES))


def json_field(raw: Column, name: str, sql_type: str = "string") -> Column:
    """One field of the payload by name, promoted or not."""
    return F.try_variant_get(F.try_parse_json(raw), f"$.{name}", sql_type)


def stamp(df: DataFrame, loaded_at: Column) -> DataFrame:
    """Give a whole batch one load time (pass a literal)."""
    return df.withColumn("loaded_at", loaded_at)


def hot_half(rows: DataFrame) -> DataFrame:
    """The narrow search half of each row."""
    return rows.select(*HOT_COLUMNS)


def raw_half(rows: DataFrame) -> DataFrame:
    """The payload half of each row."""
    return rows.select(*RAW_COLUMNS)
