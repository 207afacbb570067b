"""Whole runs through the store: golden load, crash, resume, audit."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import audit
from parcelflow.operators import transform as tr
from parcelflow.plans.store import ListingStore
from parcelflow.session import new_work_dir
from parcelflow.sources import pages as pg
from parcelflow.streaming import sync


def key(n):
    return f"H{37 * n:05d}"


def price(n):
    return f"{180_000 + 1_250 * n}.50"


def city(n):
    return ("Omaha", "Boise", "Tampa", "Duluth", "Reno")[n % 5]


def record(n, day, **extra):
    return {
        "ListingKey": key(n),
        "ModificationTimestamp": f"2023-11-{day:02d}T06:30:00+02:00",
        "ListPrice": price(n),
        "City": city(n),
        **extra,
    }


def at(day):
    return dt.datetime(2023, 11, day, 4, 30)


FEED = [
    [record(11, 7), record(12, 7), record(13, 9)],
    [record(14, 8)],
    [record(15, 11, VendorHints={"level": 2, "tags": ["corner", None, {"x": 1.5}]}), record(16, 10), record(17, 12)],
    [record(18, 12), record(19, 13)],
]
KEYS = range(11, 20)


def land(spark, batches, closed=True):
    path = new_work_dir(spark, "landing")
    rows = []
    for n, records in enumerate(batches):
        body = {"value": records}
        if n < len(batches) - 1 or not closed:
            body["@odata.nextLink"] = f"next/{n + 1}"
        rows.append((n, json.dumps(body)))
    pg.land_pages(spark.createDataFrame(rows, "page_no bigint, body string"), path)
    return path


@pytest.fixture
def store(spark):
    return ListingStore(spark, new_work_dir(spark, "store")).create()


def prices(store):
    rows = store.property(["ListingKey", "ListPrice"]).collect()
    return {r.ListingKey: str(r.ListPrice) for r in rows}


def test_golden_full_sync_dry_run_and_later_runs(spark, store):
    landing = land(spark, FEED)
    trial = sync.dry_run(store, landing)
    assert (trial.total_rows, trial.watermark) == (9, at(13))
    assert store.commits().count() == 0 and store.read("change_log").count() == 0

    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    result = sync.full_sync(store, landing, "full", pages_per_batch=2)
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert (result.total_rows, result.watermark) == (9, at(13))
    hot = {r.ListingKey: r for r in store.property().collect()}
    assert {k: (str(r.ListPrice), r.City) for k, r in hot.items()} == {
        key(n): (price(n), city(n)) for n in KEYS
    }
    assert all(before <= r.loaded_at <= after for r in hot.values())
    raw = {r.ListingKey: r for r in store.property_raw().collect()}
    assert {k: json.loads(r.raw_data) for k, r in raw.items()} == {
        r["ListingKey"]: r for page in FEED for r in page
    }
    assert all(raw[k].loaded_at == hot[k].loaded_at for k in hot)
    assert store.last_run()["done"] and sync.plan_full_sync(store) == "fresh"
    checked = audit.load_audit(store.property(), store.property_raw()).first()
    assert (checked.n_rows, checked.n_raw_rows, checked.n_orphans) == (9, 9, 0)

    # Running the finished run again commits nothing.
    n_commits = store.commits().count()
    assert sync.full_sync(store, landing, "full").total_rows == 9
    assert store.commits().count() == n_commits

    # Strictly newer rows only; the boundary record stays as it was.
    update = land(spark, [[record(19, 13, ListPrice="1.00"), record(30, 14), record(11, 16, City=None)]])
    result = sync.incremental(store, update, "inc")
    assert (result.total_rows, result.watermark) == (2, at(16))
    assert prices(store)[key(19)] == price(19) and prices(store)[key(30)] == price(30)
    cities = {r.ListingKey: r.City for r in store.property(["ListingKey", "City"]).collect()}
    assert cities[key(11)] is None

    # An older start re-reads rows, and never lowers the watermark.
    old = land(spark, [[record(12, 8, ListPrice="5.00"), record(13, 2)]])
    result = sync.since(store, old, "since", at(5))
    assert (result.total_rows, result.watermark) == (1, at(16))
    assert prices(store)[key(12)] == "5.00"

    # Compaction changes nothing; later runs still win over the snapshot.
    state = sorted(store.property().collect())
    payload = sorted(store.property_raw().collect())
    assert store.compact() == 0 and store.compact() == 0
    assert sorted(store.property().collect()) == state
    assert sorted(store.property_raw().collect()) == payload
    sync.since(store, land(spark, [[record(13, 20, ListPrice="7.00")]]), "since-2", at(18))
    assert prices(store)[key(13)] == "7.00" and len(prices(store)) == 10
    assert json.loads({r.ListingKey: r.raw_data for r in store.property_raw().collect()}[key(13)])[
        "ListPrice"
    ] == "7.00"
    assert store.compact() == 1
    assert prices(store)[key(13)] == "7.00"
    store.register_views()
    assert spark.sql("SELECT count(*) FROM property p JOIN property_raw r USING (ListingKey)").first()[0] == 10

    assert store.create(recreate=True).property().count() == 0
    assert store.commits().count() == 0
    # A run of a known name starts anew.
    assert sync.full_sync(store, landing, "full").total_rows == 9 == len(prices(store))


def test_incremental_needs_a_watermark(spark, store):
    with pytest.raises(RuntimeError, match="no watermark yet"):
        sync.incremental(store, land(spark, FEED), "inc")


def test_failed_batch_leaves_data_and_state_unchanged(spark, store):
    sync.full_sync(store, land(spark, FEED), "full")
    state = sorted(store.property().collect())
    commits = sorted(store.commits().collect())
    bad = land(spark, [[record(11, 18, ListPrice="2.00"), record(40, 19, ListPrice="dear")]])
    with pytest.raises(Exception, match="invalid record"):
        sync.since(store, bad, "broken", at(1))
    assert sorted(store.property().collect()) == state
    assert sorted(store.commits().collect()) == commits

    # The same pages load when unreadable records are set aside instead.
    result = sync.since(store, bad, "lenient", at(1), quarantine=True)
    assert (result.total_rows, result.watermark) == (1, at(18))
    assert [r.bad_fields for r in store.rejected().collect()] == [["ListPrice"]]


def test_crash_and_resume_lose_nothing(spark, store):
    batches = [[record(3 * n + i + 1, n + 1) for i in range(3)] for n in range(4)]
    landing = land(spark, batches)
    healthy, calls = store.ingest, []

    def failing(*args, **kwargs):
        if len(calls) == 2:
            raise OSError("disk gone")
        calls.append(1)
        return healthy(*args, **kwargs)

    store.ingest = failing
    with pytest.raises(Exception, match="disk gone"):
        sync.full_sync(store, landing, "full", pages_per_batch=1)
    store.ingest = healthy
    assert store.commits().count() == 2 and len(prices(store)) == 6
    assert not store.last_run()["done"] and sync.plan_full_sync(store) == "resume"
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=4)
    assert sync.plan_full_sync(store, later) == "pivot"
    # An unfinished run is not folded into a snapshot.
    assert store.compact() == -1
    seen = store.ledger().select("page_no")
    observed = spark.createDataFrame(
        [(n, r["ListingKey"]) for n, page in enumerate(batches) for r in page],
        "page_no bigint, ListingKey string",
    ).join(seen, "page_no", "left_semi")
    kept = store.property(["ListingKey"])
    assert observed.join(kept, "ListingKey", "left_anti").count() == 0

    result = sync.full_sync(store, landing, "full", pages_per_batch=1)
    assert result.total_rows == 12 and len(prices(store)) == 12
    assert store.last_run()["done"]


def test_graceful_stop_after_the_batch_in_flight(spark, store):
    landing = land(spark, [[record(n, n)] for n in (1, 2, 3)])
    result = sync.full_sync(store, landing, "full", pages_per_batch=1, should_stop=lambda: True)
    assert result.stopped and result.total_rows == 1 and store.commits().count() == 1
    result = sync.full_sync(store, landing, "full", pages_per_batch=1)
    assert not result.stopped and result.total_rows == 3


def test_a_run_is_typed_once_and_reads_its_state_once(spark, store, monkeypatch):
    landing = land(spark, [[record(n, n)] for n in (1, 2, 3)])
    calls = []

    def counted(name):
        plain = getattr(ListingStore, name)
        monkeypatch.setattr(ListingStore, name, lambda *args: calls.append(name) or plain(*args))

    counted("_next")
    typed = tr.type_records
    monkeypatch.setattr(tr, "type_records", lambda *args: calls.append("typed") or typed(*args))
    assert sync.full_sync(store, landing, "full", pages_per_batch=1).total_rows == 3
    assert sorted(calls) == ["_next", "typed"]
    assert [(r.batch_id, r.run_no, r.epoch) for r in store.commits().orderBy("batch_id").collect()] == [
        (0, 0, 0), (1, 0, 1), (2, 0, 2)
    ]


def test_a_batch_leaves_out_pages_past_the_end_it_brings(spark, store):
    # Page 1 has no link; what follows is no part of the load, not even its faults.
    bodies = [{"value": [record(n + 1, n + 1)], "@odata.nextLink": "next"} for n in range(4)]
    del bodies[1]["@odata.nextLink"]
    bodies[3]["value"][0]["ListPrice"] = "dear"
    landing = new_work_dir(spark, "landing")
    rows = [(n, json.dumps(body)) for n, body in enumerate(bodies)]
    pg.land_pages(spark.createDataFrame(rows, "page_no bigint, body string"), landing)
    assert sync.full_sync(store, landing, "full").total_rows == 2
    assert set(prices(store)) == {key(1), key(2)} and store.last_run()["done"]
    assert sorted(r.page_no for r in store.ledger().collect()) == [0, 1]
    assert store.read("change_log").where("page_no > 1").count() == 0


def test_another_run_may_write_between_two_batches(spark, store):
    landing = land(spark, [[record(n, n)] for n in (1, 2)])
    other = json.dumps({"value": [record(1, 9, ListPrice="9.00")]})
    pages = spark.createDataFrame([(0, other)], "page_no bigint, body string")
    healthy, written = store.ingest, []

    def two(*args):
        commit = healthy(*args)
        if not written:
            written.append(healthy(pages, "other"))
        return commit

    store.ingest = two
    assert sync.full_sync(store, landing, "full", pages_per_batch=1).total_rows == 2
    commits = store.commits().orderBy("batch_id").collect()
    assert [(r.batch_id, r.run_key, r.run_no) for r in commits] == [(0, "full", 0), (1, "other", 1), (2, "full", 2)]


def test_pages_without_rows_still_move_the_cursor(spark, store):
    landing = land(spark, [[record(1, 1)], [], [{"ListingId": "x"}, {"ListingKey": " "}]])
    sync.full_sync(store, landing, "full")
    rows = {r.page_no: (r.n_rows, r.n_skipped, r.max_ts) for r in store.ledger().collect()}
    assert rows == {0: (1, 0, at(1)), 1: (0, 0, None), 2: (0, 2, None)}
    assert store.skipped().where(F.col("identifying")["ListingId"] == "x").count() == 1
    assert store.last_run()["done"]


def test_same_key_twice_and_uncommitted_rows(spark, store):
    landing = land(spark, [[record(1, 5), record(1, 1, ListPrice="2.00")], [record(2, 2)]])
    sync.full_sync(store, landing, "full", pages_per_batch=1)
    assert prices(store)[key(1)] == "2.00"
    ghost = store.read("change_log").drop("batch_id").withColumn("run_no", F.lit(9))
    ghost.withColumn("ListPrice", F.lit(0).cast("decimal(14,2)")).write.parquet(
        store.path("change_log/batch_id=77")
    )
    assert prices(store) == {key(1): "2.00", key(2): price(2)}


def test_a_page_landed_twice(spark, store):
    body = json.dumps({"value": [record(1, 1), record(2, 2)]})
    pages = spark.createDataFrame([(0, body)], "page_no bigint, body string")
    with pytest.raises(ValueError, match="page 0 was landed more than once"):
        store.ingest(pages.unionAll(pages), "run", epoch=0)
    assert store.commits().count() == 0
    # Landed again later, the page replaces itself.
    store.ingest(pages, "run", epoch=0)
    store.ingest(pages, "run", epoch=1)
    assert store.property().count() == 2 and store.property_raw().count() == 2
    assert store.last_run()["done"]


def test_an_unreadable_time_is_not_taken_for_an_old_one(spark, store):
    bad = land(spark, [[record(1, 5), record(2, 1, ModificationTimestamp="soon"), record(3, 1)]])
    with pytest.raises(Exception, match="fields=ModificationTimestamp"):
        sync.since(store, bad, "strict", at(2))
    result = sync.since(store, bad, "lenient", at(2), quarantine=True)
    assert result.total_rows == 1 and store.rejected().count() == 1


def test_what_is_no_record_is_reported_under_since_too(spark, store):
    body = '{"value": [' + json.dumps(record(1, 9)) + ', 5, "x", ' + json.dumps(record(2, 1)) + "]}"
    pages = spark.createDataFrame([(0, body)], "page_no bigint, body string")
    with pytest.raises(Exception, match="invalid record"):
        store.ingest(pages, "strict", since=at(5))
    assert store.commits().count() == 0
    store.ingest(pages, "lenient", since=at(5), quarantine=True)
    assert list(prices(store)) == [key(1)] and store.rejected().count() == 2


def test_a_page_landed_twice_with_other_links(spark, store):
    pages = [(0, json.dumps({"value": [record(1, 1)], "@odata.nextLink": link})) for link in ("a", "b")]
    with pytest.raises(ValueError, match="page 0 was landed more than once"):
        store.ingest(spark.createDataFrame(pages, "page_no bigint, body string"), "run")
    assert store.commits().count() == 0 and store.property_raw().count() == 0


@pytest.mark.parametrize("fold", [False, True])
def test_a_continued_run_arrives_last(spark, store, fold):
    def page(n, *records, last=False):
        body = {"value": list(records)} | ({} if last else {"@odata.nextLink": f"p{n + 1}"})
        return spark.createDataFrame([(n, json.dumps(body))], "page_no bigint, body string")

    store.ingest(page(0, record(1, 1)), "a", epoch=0)
    store.ingest(page(0, record(2, 2, ListPrice="9.00"), record(3, 2, ListPrice="9.00"), last=True), "b")
    if fold:
        assert store.compact() == 0
    store.ingest(page(1, record(2, 1, ListPrice="1.00"), last=True), "a", epoch=1)
    assert prices(store) == {key(1): price(1), key(2): "1.00", key(3): "9.00"}
    run = store.last_run()
    assert run["run_key"] == "a" and run["done"]
    if fold:
        assert store.compact() == 1
        assert prices(store)[key(2)] == "1.00"


def test_pages_past_the_end_of_the_chain_are_not_loaded(spark, store):
    bodies = [{"value": [record(1, 1)], "@odata.nextLink": "x"}, {"value": [record(2, 2)]}, {"value": [record(3, 3)]}]
    path = new_work_dir(spark, "landing")
    rows = [(n, json.dumps(b)) for n, b in enumerate(bodies)]
    pg.land_pages(spark.createDataFrame(rows, "page_no bigint, body string"), path)
    assert sync.dry_run(store, path).total_rows == 2
    assert sync.full_sync(store, path, "full").total_rows == 2
    # A page that comes later finds the end in the ledger.
    store.ingest(spark.createDataFrame([(3, json.dumps(bodies[2]))], "page_no bigint, body string"), "full", epoch=9)
    assert sorted(prices(store)) == [key(1), key(2)]


def test_a_stale_run_is_not_its_own_pivot(spark, store):
    landing = land(spark, [[record(1, 1)], [record(2, 2)]], closed=False)
    sync.full_sync(store, landing, "stuck")
    with pytest.raises(ValueError, match="new name"):
        sync.planned_sync(store, landing, "stuck", now=dt.datetime(2124, 1, 1))


def test_the_log_is_bounded_without_a_join(spark, store):
    sync.full_sync(store, land(spark, [[record(1, 1)], [record(2, 2)]]), "plain", pages_per_batch=1)
    plan = store.committed_log()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PartitionFilters" in plan
    assert store.progress().where("batch_no = 2").first()["cumulative_rows"] == 2
