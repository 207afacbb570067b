"""Envelopes, chains and paging."""

import json
import re

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import transform as tr
from parcelflow.operators.paging import check_batch_size, oversized, paginate
from parcelflow.session import new_work_dir
from parcelflow.sources import pages as pg

PAGES = [
    (0, {"value": [{"a": 1}, {"a": "ä\n\"x\\"}], "@odata.nextLink": "p/1"}),
    (1, {"value": [], "@odata.nextLink": "p/2"}),
    (2, {"value": None, "@odata.nextLink": "p/3"}),
    (3, {"@odata.nextLink": "p/4"}),
    (4, {"value": [{"a": [1, {"b": None}]}]}),
]


@pytest.fixture
def pages(spark):
    rows = [(n, json.dumps(body, ensure_ascii=False)) for n, body in PAGES]
    return spark.createDataFrame(rows, "page_no bigint, body string")


def opened(df):
    rows = pg.open_pages(df).collect()
    return sorted(
        (r.page_no, r.next_link, -1 if r.pos is None else r.pos, r.raw and json.loads(r.raw))
        for r in rows
    )


def expected():
    out = []
    for n, body in PAGES:
        records = body.get("value") or []
        link = body.get("@odata.nextLink")
        out += [(n, link, i, record) for i, record in enumerate(records)] or [(n, link, -1, None)]
    return out


def test_records_of_each_page(pages):
    assert opened(pages) == [(n, k, p, r) for n, k, p, r in expected()]


def test_pack_is_the_inverse_of_open(pages):
    assert opened(pg.pack_pages(pg.open_pages(pages))) == expected()


def test_records_carry_their_link_but_not_their_page(spark, pages):
    """A page beside each of its records is copied as often as it has records."""
    plan = tr.type_records(pg.open_pages(pages))._jdf.queryExecution().executedPlan().toString()
    (carried,) = re.findall(r"Generate posexplode\(.*\), \[([^\]]*)\], true", plan)
    assert {re.sub(r"#.*", "", name) for name in carried.split(", ")} == {"page_no", "next_link"}


def test_landed_files_read_back(spark, pages):
    path = new_work_dir(spark, "landed")
    pg.land_pages(pages, path)
    assert opened(pg.read_landed(spark, path)) == expected()


def test_a_cut_off_page_is_an_error(spark):
    broken = spark.createDataFrame([(0, '{"value":[{"a":1},{"a"')], "page_no bigint, body string")
    with pytest.raises(Exception, match="(?i)malformed"):
        pg.open_pages(broken).collect()


@pytest.mark.parametrize("last", [0, 3, 6, None])
def test_chain_ends_at_the_first_page_without_link(spark, last):
    rows = [(n, None if n in (last, 8) and last is not None else f"p/{n + 1}") for n in range(9)]
    pages = spark.createDataFrame(rows, "page_no bigint, next_link string")
    kept = sorted(r.page_no for r in pg.follow_chain(pages).collect())
    assert kept == list(range(9 if last is None else last + 1))


def test_pages_after_the_last_committed_one(spark):
    pages = spark.range(6).withColumnRenamed("id", "page_no")
    done = pages.where("page_no < 4")
    assert sorted(r[0] for r in pg.pages_after(pages, done).collect()) == [4, 5]
    assert pg.pages_after(pages, done.where("false")).count() == 6


@pytest.mark.parametrize("size", [1, 7, 1000, 5000])
def test_paging_of_a_time_shared_by_a_third(spark, size):
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise((F.col("id") * 7919) % 1000).alias("t"), "id"
    )
    got = paginate(rows, ["t", "id"], size).collect()
    order = sorted((r.t, r.id) for r in got)
    place = {pair: i for i, pair in enumerate(order)}
    assert len(place) == n
    assert all(r.page_no * size + r.pos == place[(r.t, r.id)] for r in got)


def test_page_sizes(spark):
    ledger = spark.createDataFrame([(0, 999), (1, 1000), (2, 1001)], "page_no int, n_rows int")
    assert [r.page_no for r in oversized(ledger, 1000).collect()] == [2]
    assert check_batch_size(5000) == 5000
    for bad in (0, -1, 5001):
        with pytest.raises(ValueError):
            check_batch_size(bad)
