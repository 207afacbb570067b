"""JSON field to typed column, keeping "absent" apart from "unusable".

Fields are read as VARIANT in one parse of the record, so the JSON type is
still known: text is not accepted where a number stood, nor the reverse.
A field is handed on as its JSON kind and its text, each taken out once.
Every function returns NULL for what it cannot read; ``unusable`` turns that
NULL into a fault when the record did carry a value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.schema import Field

# The words read as flags, in lower case.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")

_ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}"
_MIDNIGHT = (
    r"^\s*\d{4}-\d{2}-\d{2}([Tt ]00:00(:00(\.0+)?)?([Zz]|[+-]\d{2}:?\d{2})?)?\s*$"
)
_WHOLE_NUMBER = r"^\s*([+-]?\d+)(\.0*)?\s*$"

# Fixed value: an epoch number past this many seconds is in milliseconds.
_EPOCH_SECONDS_LIMIT = 20_000_000_000


def read_fields(raw: Column, names: Iterable[str]) -> Column:
    """One struct of VARIANT fields from one pass over the record's JSON."""
    return F.from_json(raw, ", ".join(f"`{n}` variant" for n in names))


def json_kind(value: Column) -> Column:
    """``STRING``, ``BOOLEAN``, ``BIGINT`` and so on; NULL for an absent field."""
    return F.schema_of_variant(value)


def json_text(value: Column) -> Column:
    """A scalar as text, without quotes; NULL for ``null``, objects and arrays."""
    return F.try_variant_get(value, "$", "string")


def present(value: Column) -> Column:
    """True where the record carries the field with something but ``null``."""
    return value.isNotNull() & ~F.is_variant_null(value)


def sent(kind: Column) -> Column:
    """``present`` from the field's JSON kind; never NULL."""
    return kind.isNotNull() & (kind != "VOID")


def to_text(kind: Column, text: Column, width: int | None = None) -> Column:
    fits = kind == "STRING"
    if width is not None:
        fits = fits & (F.length(text) <= width)
    return F.when(fits, text)


def to_boolean(kind: Column, text: Column) -> Column:
    # A number counts as a flag only when it is exactly zero or one.
    number = text.try_cast("double")
    word = F.lower(text)
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind != "STRING", F.when(number == 1, True).when(number == 0, False))
        .when(word.isin(*TRUE_WORDS), True)
        .when(word.isin(*FALSE_WORDS), False)
    )


def to_integer(kind: Column, text: Column, sql_type: str) -> Column:
    whole = F.regexp_extract(text, _WHOLE_NUMBER, 1)
    flag = F.when(kind == "BOOLEAN", (text == "true").cast(sql_type))
    return F.coalesce(text.try_cast(sql_type), whole.try_cast(sql_type), flag)


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 text to an instant; text without an offset is UTC.

    The session zone is UTC (see ``session.configure``). Spark alone would
    also read a bare year or a bare time of day, so a full date is required.
    """
    return F.when(text.rlike(_ISO_DATE), F.upper(text)).try_cast("timestamp")


def to_timestamp(text: Column) -> Column:
    epoch = text.try_cast("decimal(20,6)")
    seconds = F.when(F.abs(epoch) > _EPOCH_SECONDS_LIMIT, epoch / 1000).otherwise(epoch)
    return F.coalesce(
        iso_to_utc(text), F.timestamp_micros((seconds * 1_000_000).cast("bigint"))
    )


def to_date(text: Column) -> Column:
    return F.when(text.rlike(_MIDNIGHT), F.upper(text)).try_cast("date")


def coerce(kind: Column, text: Column, field: Field) -> Column:
    """The typed value of one promoted column."""
    if field.is_text:
        return to_text(kind, text, field.width)
    if field.sql_type == "boolean":
        return to_boolean(kind, text)
    if field.sql_type in ("int", "smallint"):
        return to_integer(kind, text, field.sql_type)
    if field.sql_type.startswith("decimal"):
        return text.try_cast(field.sql_type)
    if field.sql_type == "timestamp":
        return to_timestamp(text)
    if field.sql_type == "date":
        return to_date(text)
    raise ValueError(f"no coercion for {field.sql_type}")


def unusable(value: Column, typed: Column) -> Column:
    """True where a value was sent but could not be read as its type."""
    return typed.isNull() & present(value)
