"""The keyed upsert against a plain dictionary."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow.operators import upsert
from parcelflow.schema import ARRIVAL

DDL = "ListingKey string, MlsStatus string, run_no int, page_no bigint, pos int"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def state(df):
    return {r.ListingKey: r.MlsStatus for r in df.collect()}


rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", "d", "e"]),
        st.sampled_from([None, "x", "y", "z"]),
        st.integers(1, 2),
        st.integers(0, 3),
    ),
    max_size=25,
)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows, rows)
def test_last_arrival_wins(spark, first, second):
    def arrivals(batch):
        return [(k, v, run, page, i) for i, (k, v, run, page) in enumerate(batch)]

    def replay(start, batch):
        held = dict(start)
        for k, v, *_ in sorted(batch, key=lambda r: r[2:]):
            held[k] = v
        return held

    base_rows, batch_rows = arrivals(first), arrivals(second)
    base = upsert.latest_per_key(frame(spark, base_rows))
    want_base = replay({}, base_rows)
    assert state(base) == want_base

    batch = frame(spark, batch_rows)
    merged = upsert.apply_batch(base, batch)
    assert state(merged) == replay(want_base, batch_rows)
    assert merged.count() == len(state(merged))
    # Applying a batch twice is the same as applying it once.
    assert upsert.state_difference(merged, upsert.apply_batch(merged, batch)).count() == 0

    actions = {r.ListingKey: r.action for r in upsert.classify_batch(base, batch).collect()}
    assert actions == {
        k: "updated" if k in want_base else "inserted" for k in {r[0] for r in batch_rows}
    }


def test_state_difference_counts_copies_and_ignores_load_time(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "ListingKey string, loaded_at int")
    b = spark.createDataFrame([("k", 9), ("n", 3)], "ListingKey string, loaded_at int")
    got = sorted((r.ListingKey, r.side) for r in upsert.state_difference(a, b).collect())
    assert got == [("k", "left"), ("m", "left"), ("n", "right")]


def test_newest_wins_option(spark):
    ddl = DDL + ", ModificationTimestamp timestamp"
    df = spark.sql(
        """SELECT * FROM VALUES
        ('k', 'new', 1, 0L, 0, timestamp'2024-01-02'), ('k', 'old', 2, 0L, 0, timestamp'2024-01-01'),
        ('m', 'timed', 1, 0L, 0, timestamp'2024-01-01'), ('m', 'untimed', 2, 0L, 0, NULL)
        AS t(ListingKey, MlsStatus, run_no, page_no, pos, ModificationTimestamp)"""
    )
    assert ddl
    assert state(upsert.latest_per_key(df)) == {"k": "old", "m": "untimed"}
    assert state(upsert.latest_per_key(df, newest_wins=True)) == {"k": "new", "m": "timed"}
    base, batch = df.where("run_no = 1"), df.where("run_no = 2")
    assert state(upsert.apply_batch(base, batch, newest_wins=True)) == {"k": "new", "m": "timed"}


def test_keys_under_a_collation(spark):
    base = frame(spark, [("Ab", "1", 0, 0, 0), ("c", "2", 0, 0, 1)])
    batch = frame(spark, [("aB ", "3", 1, 0, 0), ("áb", "4", 1, 0, 1), ("d", "5", 1, 0, 2)])
    merged = upsert.apply_batch(base, batch, collation="UNICODE_CI_AI_RTRIM")
    assert state(merged) == {"áb": "4", "c": "2", "d": "5"}
    assert len(state(upsert.apply_batch(base, batch))) == 5


def test_a_key_with_a_third_of_all_rows(spark):
    n = 60_000
    rows = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("ListingKey"),
        F.col("id").cast("string").alias("MlsStatus"),
        F.lit(1).alias("run_no"),
        F.floor(F.col("id") / 1000).alias("page_no"),
        (F.col("id") % 1000).cast("int").alias("pos"),
    )
    latest = upsert.latest_per_key(rows)
    assert latest.count() == n - n // 3 + 1
    assert latest.where("ListingKey = 'hot'").first().MlsStatus == str(n - 3)
    assert set(ARRIVAL) <= set(latest.columns)


def test_sides_with_a_row_per_key_are_not_broadcast(spark):
    """However small Spark takes them for: what is held whole by each task grows with the store."""
    rows = spark.range(3).selectExpr("string(id) AS ListingKey", "int(id) AS run_no", "id AS page_no", "int(id) AS pos", "timestamp_seconds(id) AS ModificationTimestamp")
    for joined in (upsert.latest_wide_rows(rows), upsert.not_older(rows, rows)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
