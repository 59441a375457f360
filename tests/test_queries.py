"""Every feed query against its DuckDB statement on the smallest tables."""

import hashlib
import json
import math
from decimal import Decimal

import duckdb
import pytest

from isobar.plans.registry import ORACLES, QUERIES
from isobar.sources.adapters import ADAPTERS, TABLES, duck, feed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, Decimal | float):
        return None if math.isnan(v) else round(float(v), 6) + 0.0
    return v


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    got = rows(frame.columns, frame.collect())
    if name in ORACLES:
        r = db.sql(ORACLES[name])
        assert sorted(frame.columns) == sorted(r.columns)
        assert got == rows(r.columns, r.fetchall())
    else:
        assert got


@pytest.mark.parametrize("name", sorted(ADAPTERS))
def test_adapter(spark, db, name):
    n = db.sql(f"select count(*) from ({duck(ADAPTERS[name])})").fetchall()[0][0]
    assert feed(spark, SF, name).count() == n


def test_flagship_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1


def result(spark, name):
    got = [tuple(r) for r in QUERIES[name](spark, SF).collect()]
    assert len(got) == len(set(got))
    return got


def test_hourly_stream_has_all_hours(spark, db):
    sql = "select user_id, event_type, cast(floor(epoch(date_trunc('hour', ts))) as bigint), max(cast(floor(value) as int)) from events group by all"
    assert set(result(spark, "K2_hourly_max_stream")) == set(db.sql(sql).fetchall())


def test_flash_stream_has_all_bins_once(spark, db):
    bins = "user_id % 50 * 100, (-(user_id % 40) - 60) * 100, cast(floor(epoch(ts)) as bigint) // 30"
    assert sorted(result(spark, "K1_rolling_flashes")) == sorted(db.sql(f"select distinct {bins} from events").fetchall())


def test_companion_stream_has_all_pairs(spark, db):
    sql = """select a.user_id % 20, a.event_id, b.event_id from events a join events b on a.user_id % 20 = b.user_id % 20
 and b.ts between a.ts - interval 3600 seconds and a.ts + interval 900 seconds where a.event_type = 'click' and b.event_type = 'view'"""
    assert set(result(spark, "K6_companion_stream")) == set(db.sql(sql).fetchall())


def test_nearest_runs_are_of_all_events(spark, db):
    got = result(spark, "J6_nearest_run_of_all")
    assert {r[0] % 10 for r in got} == set(range(10))
    assert {r[2] for r in got} == {h * 3600 for h in range(-3, 4)}
    assert len(got) > 0.8 * db.sql("select count(*) from events").fetchall()[0][0]


def test_signature_of_each_customer(spark, db):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = {}
    for c, k, p in db.sql("select o_custkey, o_orderkey, o_orderpriority from orders").fetchall():
        rows.setdefault(c, []).append(sha(json.dumps({"o_orderkey": k, "o_orderpriority": p}, separators=(",", ":"))))
    assert dict(result(spark, "A27_signature")) == {c: sha("\n".join(sorted(d))) for c, d in rows.items()}
