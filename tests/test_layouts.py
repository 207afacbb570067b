"""Files that a search reads in part: curves, pages by number, folders by time; digests and sketches."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from test_plans import plan, scanned_rows

from parcelflow.operators import audit, paging, upsert
from parcelflow.operators.layout import write_curve_layout
from parcelflow.session import new_work_dir
from parcelflow.sources import scans

N = 300_000


def spread(seed, below):
    return F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(below))


@pytest.fixture(scope="module")
def listings(spark):
    path = new_work_dir(spark, "listings")
    spark.range(N).select(
        F.col("id").cast("string").alias("ListingKey"),
        F.concat(F.lit("C"), spread(1, 150).cast("string")).alias("City"),
        spread(2, 100_000).cast("decimal(14,2)").alias("ListPrice"),
        F.timestamp_seconds(F.lit(1_700_000_000) + spread(3, 10_000_000)).alias("ModificationTimestamp"),
    ).write.parquet(path)
    return spark.read.parquet(path)


SEARCHES = [
    "City = 'C77'",
    "ListPrice BETWEEN 50000 AND 51000",
    "ModificationTimestamp BETWEEN timestamp_seconds(1703000000) AND timestamp_seconds(1703100000)",
]
# Half of the rows lie on either side: the curve's worst case.
ACROSS = "ModificationTimestamp BETWEEN timestamp_seconds(1704950000) AND timestamp_seconds(1705050000)"


def test_any_column_of_a_curve_narrows_the_scan(spark, listings):
    path = new_work_dir(spark, "curve")
    write_curve_layout(listings, path, ["City", "ListPrice", "ModificationTimestamp"], rows_per_page=500)
    stored = spark.read.parquet(path)
    assert stored.columns == listings.columns and stored.count() == N
    for search in SEARCHES:
        assert sorted(stored.where(search).collect()) == sorted(listings.where(search).collect())
        assert 0 < scanned_rows(stored.where(search)) < N / 4
    assert 0 < scanned_rows(stored.where(ACROSS)) < N / 2


def test_a_curve_takes_gaps_and_constants(spark):
    rows = spark.createDataFrame(
        [(str(k), None if k % 3 else "x", None, k % 2 == 0, dt.date(2024, 1, 1 + k % 9)) for k in range(50)],
        "ListingKey string, City string, Stories smallint, SpaYN boolean, CloseDate date",
    )
    for n, df in enumerate((rows, rows.limit(0))):
        path = new_work_dir(spark, f"gaps-{n}")
        write_curve_layout(df, path, ["City", "Stories", "SpaYN", "CloseDate"])
        assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError, match="1 to 8"):
        write_curve_layout(rows, path, ["ListingKey"] * 9)


def test_a_page_by_number_is_the_page_of_the_whole_order(spark, listings):
    order, path = ["ModificationTimestamp", "ListingKey"], new_work_dir(spark, "paged")
    # A third of the rows share one time.
    tied = listings.limit(9_000).withColumn("ModificationTimestamp", F.when(F.col("ListPrice") % 3 != 0, F.col("ModificationTimestamp")).otherwise(F.timestamp_seconds(F.lit(1_705_000_000))))
    tied.write.parquet(f"{path}/in")
    rows = spark.read.parquet(f"{path}/in")
    paging.write_pages(rows, order, 700, path)
    whole = {}
    for r in paging.paginate(rows, order, 700).collect():
        whole.setdefault(r.page_no, []).append(r)
    for page in range(14):
        got = paging.read_page(spark, path, page, order, 700).collect()
        assert sorted(got, key=lambda r: r.pos) == sorted(whole.get(page, []), key=lambda r: r.pos)
    assert max(whole) == 12 and paging.read_page(spark, path, -1, order, 700).count() == 0


def test_a_page_by_number_reads_little(spark, listings):
    order, path = ["ModificationTimestamp", "ListingKey"], new_work_dir(spark, "pages")
    paging.write_pages(listings, order, 1000, path)
    page = paging.read_page(spark, path, 123, order, 1000)
    assert page.count() == 1000
    assert scanned_rows(page) < N / 4


def test_folders_by_time_are_ruled_out_by_the_watermark(spark, listings):
    path = new_work_dir(spark, "days")
    rows = listings.limit(20_000).withColumn("ModificationTimestamp", F.when(F.col("ListPrice") % 7 != 0, F.col("ModificationTimestamp")))
    rows.write.parquet(f"{path}/in")
    rows = spark.read.parquet(f"{path}/in")
    scans.write_by_time(rows, f"{path}/out", "ListingKey")
    stored = spark.read.parquet(f"{path}/out")
    mark = spark.createDataFrame([(1_709_000_000,)], "s bigint").select(F.timestamp_seconds("s").alias("max_ts"))
    newer = scans.newer_in_folders(stored, scans.stored_watermark(mark))
    assert re.search(r"PartitionFilters: \[[^\]]*modified_from[^\]]*", plan(newer))
    assert re.search(r"PartitionFilters: \[.*?[Ss]ubquery", plan(newer))
    want = rows.where("ModificationTimestamp > timestamp_seconds(1709000000)")
    assert sorted(newer.select(*rows.columns).collect()) == sorted(want.collect()) and want.count() > 0
    assert scanned_rows(newer) < 20_000 / 4
    exact = dt.datetime(2024, 2, 1)
    assert scans.newer_in_folders(stored, exact, inclusive=True).count() == rows.where("ModificationTimestamp >= '2024-02-01'").count()


def test_digests_stand_for_equal_states(spark, listings):
    same = listings.repartition(5).select("City", "ModificationTimestamp", "ListPrice", "ListingKey")
    same = same.withColumn("loaded_at", F.lit(dt.datetime(2024, 1, 1)))
    left = listings.withColumn("loaded_at", F.lit(dt.datetime(2025, 1, 1)))
    difference = upsert.digested_difference(left, same)
    assert difference.collect() == []
    # The second pass has met an empty side: it is gone from the plan that ran.
    ran = plan(difference).split("Initial Plan")[0]
    assert "ListingKey" not in ran.replace("== Final Plan ==", "").split("Scan parquet")[0]


def test_digests_find_what_a_comparison_of_rows_finds(spark):
    def state(rows):
        return spark.createDataFrame(rows, "ListingKey string, City string, Stories int, loaded_at string").repartition(3)

    left = [("a", "x", 1, "p"), ("b", None, None, "p"), ("c", "y", 2, "p"), ("c", "y", 2, "p"), ("d", "", 0, "p"), (None, "n", 1, "p")]
    right = [("a", "x", 1, "q"), ("b", None, 0, "q"), ("c", "y", 2, "q"), ("d", None, 0, "q"), ("e", "z", 5, "q"), (None, "n", 1, "q")]
    for buckets in (1, 3, 4096):
        got = upsert.digested_difference(state(left), state(right), buckets=buckets)
        want = upsert.state_difference(state(left), state(right))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert got.count() == 6
    # NULL in one column and in another are different rows.
    assert upsert.digested_difference(state([("a", None, 1, "")]), state([("a", "1", None, "")])).count() == 2


def test_an_audit_from_sketches(spark, listings):
    typed = listings.select("*", F.lit("stored").alias("outcome"), F.col("City").alias("MlsStatus"), spread_page().alias("page_no"))
    typed = typed.unionByName(typed.where("page_no = 3").withColumn("outcome", F.lit("no_key")).withColumn("ListingKey", F.lit("never")))
    batches = audit.batch_sketches(typed)
    assert batches.count() == 40
    got, exact = audit.sketched_audit(batches).first(), listings.agg(F.min("ModificationTimestamp"), F.max("ModificationTimestamp"), F.countDistinct("City")).first()
    assert (got.n_rows, got.min_ts, got.max_ts) == (N, exact[0], exact[1])
    assert abs(got.n_keys - N) < 0.05 * N and abs(got.n_statuses - exact[2]) <= 1
    # A batch loaded twice adds rows, but no keys.
    twice = audit.sketched_audit(batches.unionByName(batches.where("page_no < 10"))).first()
    assert twice.n_keys == got.n_keys and twice.n_rows > got.n_rows
    none = audit.sketched_audit(batches.limit(0)).first()
    assert none.n_batches == 0 and none.n_rows is None


def spread_page():
    return F.pmod(F.xxhash64("ListingKey"), F.lit(40))
