"""The given tables as listing feeds.

``orders``, ``events`` and ``customer`` stand in for the feed. What a real
feed gets wrong (blank keys, offsets, repeated keys, unreadable fields) is
derived from the row's own key, so every run sees the same faults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.schema import PROMOTED, Field

PAGE_SIZE = 1000

# The columns carried by the slim feed, in schema order.
SLIM: tuple[Field, ...] = tuple(
    f
    for f in PROMOTED
    if f.name
    in (
        "ListingKey",
        "ListingId",
        "MlsStatus",
        "InternetAddressDisplayYN",
        "ListPrice",
        "ModificationTimestamp",
        "CloseDate",
        "PhotosCount",
        "ListAgentKey",
    )
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the narrow rows evenly over the shuffle partitions of the session.

    Building records costs far more than moving the rows they come from, and
    the splits of a file say little about how many rows each holds.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def iso_text(ts: Column, style: Column) -> Column:
    """A UTC time spelled with Z, with no offset, or with one of two offsets."""
    full = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ahead = later(ts, F.lit(19_800))
    behind = later(ts, F.lit(-28_800))
    return (
        F.when(style == 0, F.concat(F.date_format(ts, full), F.lit("Z")))
        .when(style == 1, F.concat(F.date_format(ahead, full), F.lit("+05:30")))
        .when(style == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.concat(F.date_format(behind, full), F.lit("-08:00")))
    )


def _paged(orders: DataFrame, empty_pages: bool = False) -> DataFrame:
    """Orders with a page, a position and a link to the next page.

    With ``empty_pages`` the numbers leave room for a page after every sixth.
    """
    k = F.col("o_orderkey")
    page = F.expr(f"o_orderkey div {PAGE_SIZE}")
    last = F.expr(f"max(o_orderkey) div {PAGE_SIZE}")
    if empty_pages:
        page = F.expr(f"o_orderkey div {PAGE_SIZE} + o_orderkey div {6 * PAGE_SIZE}")
        last = F.expr(f"max(o_orderkey) div {PAGE_SIZE} + max(o_orderkey) div {6 * PAGE_SIZE}")
    last = orders.agg(last).scalar()
    return spread(orders).select(
        "*",
        k.alias("k"),
        page.alias("page_no"),
        F.when(page < last, F.concat(F.lit("page/"), (page + 1).cast("string"))).alias(
            "next_link"
        ),
        (k % PAGE_SIZE).cast("int").alias("p"),
        F.timestamp_add(
            "MICROSECOND", (k % 86_400) * 1_000_000 + (k % 5) * 250_000, F.col("o_orderdate")
        ).alias("modified"),
    )


def _key_text(k: Column) -> Column:
    fault = k % 97
    return (
        F.when(F.col("page_no") % 7 == 3, None)
        .when(fault == 13, None)
        .when(fault == 29, "")
        .when(fault == 31, " \t ")
        .when(fault == 43, "\u00a0 ")
        .when(fault == 59, F.concat(F.lit("  "), k.cast("string"), F.lit(" ")))
        .otherwise(k.cast("string"))
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slim records ``(page_no, next_link, pos, raw)`` with every fault.

    Page 3 of every seven has no usable key at all; page 6 of every seven is
    empty and shows as a single marker row besides all orders.
    """
    k = F.col("k")
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    record = F.struct(
        _key_text(k).alias("ListingKey"),
        F.when(k % 3 != 0, F.concat(F.lit("ID-"), k.cast("string"))).alias("ListingId"),
        F.col("o_orderstatus").alias("MlsStatus"),
        F.when(k % 5 != 0, k % 2 == 0).alias("InternetAddressDisplayYN"),
        F.when(k % 101 == 7, "n/a")
        .when(k % 101 == 11, "9999999999999.00")
        .otherwise(price)
        .alias("ListPrice"),
        F.when(k % 53 != 0, iso_text(F.col("modified"), k % 4)).alias("ModificationTimestamp"),
        F.when(k % 6 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("CloseDate"),
        F.when(k % 7 != 0, k % 50).alias("PhotosCount"),
        F.col("o_custkey").cast("string").alias("ListAgentKey"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 9).cast("string")).alias("SourceSystem"),
        F.struct((k % 4).alias("n")).alias("Media"),
    )
    orders = table(spark, sf_dir, "orders")
    records = _paged(orders, empty_pages=True).select(
        "page_no", "next_link", F.col("p").alias("pos"), F.to_json(record).alias("raw")
    )
    return records.unionByName(_empty_pages(orders))


def _empty_pages(orders: DataFrame) -> DataFrame:
    """A marker row for the page after every sixth one, but for a page past the last order."""
    full = orders.select(F.expr(f"o_orderkey div {PAGE_SIZE}").alias("f"))
    last = full.agg(F.expr("max(f) + max(f) div 6")).scalar()
    page = F.col("page_no")
    return (
        full.where("f % 6 = 5")
        .select(F.expr("f + f div 6 + 1").alias("page_no"))
        .distinct()
        .where(page <= last)
        .select(
            "page_no",
            F.when(page < last, F.concat(F.lit("page/"), (page + 1).cast("string"))).alias("next_link"),
            F.lit(None).cast("int").alias("pos"),
            F.lit(None).cast("string").alias("raw"),
        )
    )


def _full_value(i: int, field: Field) -> Column:
    """A clean value of one promoted column as the feed would send it."""
    k = F.col("k")
    special = {
        "ListingKey": k.cast("string"),
        "MlsStatus": F.col("o_orderstatus"),
        "ListPrice": F.col("o_totalprice").cast("decimal(14,2)").cast("string"),
        "ModificationTimestamp": iso_text(F.col("modified"), k % 4),
        "PropertyType": F.col("o_orderpriority"),
        "ListAgentKey": F.col("o_custkey").cast("string"),
    }
    if field.name in special:
        return special[field.name]
    if field.is_text and field.width == 2:
        value = ((k + i) % 90 + 10).cast("string")
    elif field.is_text:
        value = F.concat(F.lit(f"{field.name[:8]}-"), (k % (i + 7)).cast("string"))
    elif field.sql_type == "boolean":
        value = (k + i) % 2 == 0
    elif field.sql_type in ("int", "smallint"):
        value = (k * (i + 1)) % 1000
    elif field.sql_type.startswith("decimal"):
        cents = F.lpad((k % 100).cast("string"), 2, "0")
        value = F.concat(((k * (i + 3)) % 1000).cast("string"), F.lit("."), cents)
    elif field.sql_type == "timestamp":
        value = iso_text(later(F.col("o_orderdate"), k % 3600 + i * 3600), (k + i) % 4)
    else:
        value = F.date_format(F.date_add("o_orderdate", i), "yyyy-MM-dd")
    return F.when((k + i) % 5 != 0, value)


def full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that carry all promoted columns, and one unknown field."""
    record = F.struct(
        *[_full_value(i, f).alias(f.name) for i, f in enumerate(PROMOTED)],
        F.struct((F.col("k") % 3).alias("level"), F.lit("as sent").alias("note")).alias("VendorHints"),
    )
    return _paged(table(spark, sf_dir, "orders")).select(
        "page_no", "next_link", F.col("p").alias("pos"), F.to_json(record).alias("raw")
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records; ``props`` is kept as a nested document."""
    e = F.col("event_id")
    events = table(spark, sf_dir, "events")
    last = events.agg(F.expr(f"max(event_id) div {PAGE_SIZE}")).scalar()
    page = F.expr(f"event_id div {PAGE_SIZE}")
    record = F.struct(
        e.cast("string").alias("ListingKey"),
        F.col("event_type").alias("MlsStatus"),
        F.col("value").cast("decimal(14,2)").cast("string").alias("ListPrice"),
        iso_text(F.col("ts"), e % 4).alias("ModificationTimestamp"),
        F.col("user_id").alias("UserId"),
        F.from_json("props", "k int").alias("Props"),
    )
    return spread(events).select(
        page.alias("page_no"),
        F.when(page < last, F.concat(F.lit("page/"), (page + 1).cast("string"))).alias(
            "next_link"
        ),
        (e % PAGE_SIZE).cast("int").alias("pos"),
        F.to_json(record).alias("raw"),
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    record = F.struct(
        F.concat(F.lit("C"), c.cast("string")).alias("ListingKey"),
        F.col("c_mktsegment").alias("MlsStatus"),
        F.col("c_acctbal").cast("decimal(14,2)").cast("string").alias("ListPrice"),
        F.lit("2024-01-01T00:00:00Z").alias("ModificationTimestamp"),
    )
    customers = table(spark, sf_dir, "customer")
    last = customers.agg(F.expr(f"max(c_custkey) div {PAGE_SIZE}")).scalar()
    page = F.expr(f"c_custkey div {PAGE_SIZE}")
    return customers.select(
        page.alias("page_no"),
        F.when(page < last, F.concat(F.lit("page/"), (page + 1).cast("string"))).alias("next_link"),
        (c % PAGE_SIZE).cast("int").alias("pos"),
        F.to_json(record).alias("raw"),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as already typed rows of a first run."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.cast("string").alias("ListingKey"),
        F.col("o_orderstatus").alias("MlsStatus"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("ListPrice"),
        F.col("o_orderdate").cast("timestamp").alias("ModificationTimestamp"),
        F.lit(0).alias("run_no"),
        F.expr(f"o_orderkey div {PAGE_SIZE}").alias("page_no"),
        (k % PAGE_SIZE).cast("int").alias("pos"),
    )


def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over ``order_rows``.

    A third of it is one and the same key. The rest updates known keys (some
    twice, some with an older time, with the status set to NULL) and inserts
    new ones.
    """
    k = F.col("o_orderkey")
    key = (
        F.when(k % 3 == 1, "HOT")
        .when(k % 10 == 0, F.concat(F.lit("N"), k.cast("string")))
        .otherwise((k - k % 2).cast("string"))
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("ListingKey"),
        F.when(k % 4 != 0, F.col("o_orderstatus")).alias("MlsStatus"),
        (F.col("o_totalprice").cast("decimal(14,2)") + 1).cast("decimal(14,2)").alias("ListPrice"),
        later(F.col("o_orderdate"), (k % 5 - 2) * 86_400)
        .cast("timestamp")
        .alias("ModificationTimestamp"),
        F.lit(1).alias("run_no"),
        F.expr(f"o_orderkey div {PAGE_SIZE}").alias("page_no"),
        (k % PAGE_SIZE).cast("int").alias("pos"),
    )


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payloads that fit their columns in different degrees.

    Some states are spelled out, some prices are words, some stories are text,
    bedrooms may be null or left out, and a few payloads are cut off.
    """
    k = F.col("o_orderkey")
    record = F.struct(
        F.when(k % 97 != 13, k.cast("string")).alias("ListingKey"),
        F.col("o_orderpriority").alias("City"),
        F.when(k % 11 == 3, "Nebraska").otherwise("NE").alias("StateOrProvince"),
        F.when(k % 101 == 7, "n/a")
        .when(k % 5 != 0, F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
        .alias("ListPrice"),
        (k % 30).alias("Stories"),
        F.when(k % 3 != 0, k % 7).alias("BedroomsTotal"),
        (k % 2 == 0).alias("SpaYN"),
    )
    raw = F.to_json(record)
    raw = F.when(k % 13 == 4, F.regexp_replace(raw, r'"Stories":\d+', '"Stories":"two"')).otherwise(raw)
    raw = F.when(k % 4 == 1, F.regexp_replace(raw, r'"BedroomsTotal":\d+', '"BedroomsTotal":null')).otherwise(raw)
    cut = F.when(k % 1009 == 5, F.substring(raw, 1, 20)).otherwise(raw)
    return spread(table(spark, sf_dir, "orders")).select(cut.alias("raw"))
