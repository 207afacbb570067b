"""Text predicates and renderings, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters text is stripped of when testing for emptiness
# are Unicode white space plus the four ASCII information separators.
_NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"


def has_text(value: Column) -> Column:
    """True where the text holds a non-blank character; false for NULL."""
    return F.coalesce(value.rlike(_NOT_BLANK), F.lit(False))


def _with_micros(ts: Column, pattern: str) -> Column:
    # Whole seconds carry no fraction, anything else carries six digits.
    fraction = F.when(
        F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")
    ).otherwise("")
    return F.concat(F.date_format(ts, pattern), fraction)


def iso_z(ts: Column) -> Column:
    """ISO-8601 text in UTC with a trailing ``Z``."""
    return F.concat(_with_micros(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def csv_scalar(value: Column, sql_type: str) -> Column:
    """Text of one value as the bulk-load file spells it."""
    if sql_type.startswith("timestamp"):
        return _with_micros(value.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    if sql_type == "boolean":
        return value.cast("int").cast("string")
    return value.cast("string")


def csv_field(value: Column, sql_type: str) -> Column:
    """One bulk-load field: bare ``\\N`` for NULL, otherwise quoted.

    Backslash and quote are each preceded by a backslash; separators and line
    ends need nothing inside the quotes.
    """
    text = csv_scalar(value, sql_type)
    escaped = F.regexp_replace(text, r'(["\\])', r"\\$1")
    return F.when(value.isNull(), F.lit("\\N")).otherwise(
        F.concat(F.lit('"'), escaped, F.lit('"'))
    )


def csv_line(*fields: Column) -> Column:
    return F.concat_ws(",", *fields)


# Stand-ins without quotes and backslashes for what a field may hold; the first
# of them keeps the others unambiguous.
_MARK, _MARKED, _BACKSLASH, _QUOTE = "\x01", "\x01a", "\x01b", "\x01c"


def without_escapes(line: Column) -> Column:
    """Bulk-load text in which every quote left opens or closes a field.

    Pairs are taken from the left, as they were written: an escaped backslash first,
    then an escaped quote.
    """
    marked = F.replace(line, F.lit(_MARK), F.lit(_MARKED))
    return F.replace(F.replace(marked, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))


def n_quotes(plain: Column) -> Column:
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def csv_fields(plain: Column) -> Column:
    """The fields of a record without escapes, still quoted; ``\\N`` for NULL."""
    return F.regexp_extract_all(plain, F.lit(r'"[^"]*"|\\N'), F.lit(0))


def csv_value(field: Column, sql_type: str) -> Column:
    """The value of one such field; NULL where it cannot be read as its type."""
    inner = F.substr(field, F.lit(2), F.length(field) - 2)
    for mark, meant in ((_QUOTE, '"'), (_BACKSLASH, "\\"), (_MARKED, _MARK)):
        inner = F.replace(inner, F.lit(mark), F.lit(meant))
    text = F.when(field != "\\N", inner)
    if sql_type == "boolean":
        return F.when(text == "1", True).when(text == "0", False)
    return text if sql_type == "string" else text.try_cast(sql_type)
