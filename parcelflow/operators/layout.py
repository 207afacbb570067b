"""File layout for selective searches, in place of secondary indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from parcelflow.schema import KEY

#: Steps that the ranks of a curve column have at most, as a power of two.
RANK_BITS = 10
#: Columns that one curve may serve; each further one halves what a search can skip.
MOST_COLUMNS = 8


def write_layout(
    rows: DataFrame, path: str, layout: Sequence[str], key: str = KEY
) -> None:
    """Write ``rows`` so that searches on ``layout`` skip most files.

    Range partitioning and sorting give each file, and each row group in it, a
    narrow span of the search columns for Parquet's min/max statistics. The
    key ends the sort order, so one common search value still spreads over
    many files, and it carries a Bloom filter for point lookups.
    """
    order = [*layout, key]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path)
    )


def _as_number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column; of text, its first seven bytes."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, NumericType):
        return column.cast("double")
    if isinstance(kind, BooleanType):
        return column.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        first = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(first, 16, 10).cast("double")
    raise ValueError(f"no order for a layout by {name}: {kind.simpleString()}")


def _rank(number: Column, bounds: Sequence[float], bits: int) -> Column:
    """How many of the sorted bounds the number reaches, found bit by bit; NULL ranks lowest."""
    held = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def climb(at: Column, step: Column) -> Column:
        return at + F.when(number >= F.element_at(held, at + step), step).otherwise(0)

    return F.when(number.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), climb))


def curve_position(df: DataFrame, layout: Sequence[str]) -> Column:
    """The place of a row on a space-filling curve through the ranks of the columns.

    Ranks come from approximate quantiles, so that every column is cut into
    steps of about equal numbers of rows, however its values are spread; their bits
    are interleaved from the highest down. Only the quantiles reach the driver,
    at most ``2 ** RANK_BITS`` a column.
    """
    if not 0 < len(layout) <= MOST_COLUMNS:
        raise ValueError(f"a curve serves 1 to {MOST_COLUMNS} columns, got {len(layout)}")
    bits = min(RANK_BITS, 62 // len(layout))
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    numbers = [_as_number(df, c) for c in layout]
    # An accuracy of several times the number of steps keeps neighbouring steps apart.
    quantiles = df.agg(*[F.percentile_approx(x, shares, 8 << bits).alias(f"q{n}") for n, x in enumerate(numbers)]).first()
    curve = F.lit(0).cast("long")
    for n, number in enumerate(numbers):
        bounds = quantiles[n] or [0.0] * len(shares)
        rank = _rank(number, bounds, bits).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            curve = curve + F.shiftleft(bit, b * len(layout) + len(layout) - 1 - n)
    return curve


def write_curve_layout(
    rows: DataFrame, path: str, layout: Sequence[str], key: str = KEY, rows_per_page: int = 20_000
) -> None:
    """Write ``rows`` so that searches on any one of ``layout`` skip most pages.

    Sorted by several columns, a file serves its first column alone. Along the
    curve every page spans a narrow range of each of them, so Parquet's page
    statistics rule pages out by whichever column is searched: of ``p`` pages about
    ``p ** (1 - 1 / len(layout))`` stay, and up to twice as many for a range
    across the middle of a column. The key ends the order, so that rows
    alike in all columns still spread over files, and carries a Bloom filter.
    """
    (
        rows.withColumn("_curve", curve_position(rows, layout))
        .repartitionByRange("_curve", key)
        .sortWithinPartitions("_curve", key)
        .drop("_curve")
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.page.row.count.limit", rows_per_page)
        .parquet(path)
    )
