"""Plans and results that hold when tables grow."""

import math
import random

import duckdb
from pyspark.sql import functions as F

from isobar.functions import scalar as S
from isobar.operators import grids as G
from isobar.operators import listings as L
from isobar.operators import points as P
from isobar.plans.registry import ORACLES, QUERIES
from isobar.streaming import feeds as K


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def below(text, node):
    """The lines of a plan under the first line with ``node``."""
    lines = text.splitlines()
    at = next((i for i, line in enumerate(lines) if node in line), None)
    if at is None:
        return []
    depth = lambda line: len(line) - len(line.lstrip(" :+-*|"))
    out = []
    for line in lines[at + 1 :]:
        if depth(line) <= depth(lines[at]):
            break
        out.append(line)
    return out


def test_tries_are_not_broadcast(spark):
    """The cycles are sent to the tries, not the tries of all rows to everyone."""
    wanted = spark.range(1000).selectExpr("id", "1704067200 + id * 60 as t")
    there = spark.range(5000).selectExpr("'ru' as source", "1704067200 + id * 900 as cycle", "0L as fhr")
    frames = [L.newest_cycles(wanted, there, [("ru", 900, 9000, False)]), L.walk_back(wanted, there.selectExpr("cycle as run"), [0, 3600, -3600])]
    for frame in frames:
        assert "Generate" in plan(frame)
        assert not any("Generate" in line for line in below(plan(frame), "BroadcastExchange"))


def test_as_of_makes_no_pairs(spark):
    """Many rows and companions of one key and span are not joined with each other."""
    r = random.Random(3)
    rows = [(r.randrange(2), r.randrange(4000), i) for i in range(3000)]
    there = [(r.randrange(2), r.randrange(4000), i) for i in range(300)]
    got = L.as_of(spark.createDataFrame(rows, "key long, t long, id long"), spark.createDataFrame(there, "key long, t long, obj long"), 9, 5)
    assert "bin" not in "".join(line for line in plan(got).splitlines() if "Join" in line)
    best = lambda key, t: max(((ct, obj) for k, ct, obj in there if k == key and t - 9 <= ct <= t + 5), default=(None, None))
    assert sorted(map(tuple, got.select("key", "t", "id", "ct", "obj").collect()), key=str) == sorted(((*row, *best(row[0], row[1])) for row in rows), key=str)


def test_hours_without_a_reading_are_not_laid_out(spark):
    """No grid of all hours is joined; a later null does not end what is held."""
    rows = spark.sql("""select * from values (1, 'a', timestamp'2024-01-01 00:00:00', 5), (1, 'a', timestamp'2024-01-01 02:00:00', 7), (1, 'a', timestamp'2034-01-01 00:00:00', 9),
 (1, 'a', timestamp'2024-01-01 03:00:00', null), (2, 'a', timestamp'2024-01-01 00:00:00', null), (null, 'a', timestamp'2024-01-01 00:00:00', 1) as t(s, p, hour, aqi)""")
    out = P.carried_forward(rows, ["s", "p"])
    assert "Join" not in plan(out)
    got = sorted((r["s"], r["p"], r["hour"].strftime("%Y %H"), r["aqi"]) for r in out.collect())
    assert got == [(1, "a", f"2024 0{h}", v) for h, v in enumerate([5, 5, 7, 7, 7, 7])] + [(1, "a", f"2034 0{h}", 9) for h in range(4)]


def test_incidents_that_cannot_win_are_not_compared(spark):
    """Of many incidents at a place those with a smaller id and no smaller radius are enough."""
    fires = [(i, 40.0, -100.0 + i % 2 * 0.01, float(a)) for i, a in enumerate([10, 500, 300, 4000, 100, 90000, 90000, 50, 8, 1])]
    spots = [(i, 40.0, -100.0 + i * 0.02) for i in range(20)]
    got = P.nearest_incident(spark.createDataFrame(spots, "spot_id long, lat double, lon double"), spark.createDataFrame(fires, "fire_id long, lat double, lon double, acres double"))
    assert "Window" in plan(got)
    far = lambda a, b, c, d: 2 * 6371 * math.asin(math.sqrt(math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2))
    want = {}
    for i, lat, lon in spots:
        near = [(round(far(lat, lon, y, x), 9), f) for f, y, x, a in fires if max(far(lat, lon, y, x), abs(lon - x) * math.cos(math.radians(lat)) * 111) <= min(max(1.2 * math.sqrt(a * 0.00404686), 3), 60)]
        if near:
            want[i] = min(near)[1]
    assert len(want) > 3
    assert {r["spot_id"]: r["fire_id"] for r in got.collect()} == want


def test_digits_that_the_steps_leave_to_chance_are_cut(spark):
    """M9: results of engines that differ in their last bits are one."""
    rows = spark.createDataFrame([(1.0462371173640436e37,), (1.0462371173642062e37,), (float("inf"),), (1e308,)], "x double")
    a, b, inf, most = (r[0] for r in rows.select(S.leading_bits(F.col("x"))).collect())
    assert a == b and abs(a / 1.0462371173640436e37 - 1) < 1e-6
    assert inf == float("inf") and abs(most / 1e308 - 1) < 1e-6


def test_amounts_near_half_a_step(spark, tmp_path):
    """P10: 0.8500000000000001 is above the half, though ten times it is 8.5 in doubles."""
    db = duckdb.connect()
    values = "[92.5, 217.5, 232.5, 402.5, 447.5, 152.5]"
    db.sql(f"create table events as select k event_id, timestamp '2024-01-01' + to_seconds(k) ts, k % 7 user_id, 'view' event_type, {values}[k % 6 + 1]::double as \"value\" from range(3000) t(k)")
    db.sql(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    name = "P10_P11_quality_control"
    frame = QUERIES[name](spark, str(tmp_path))
    sql = db.sql(ORACLES[name])
    got = sorted((r["event_id"], r["pr"]) for r in frame.collect())
    assert {v for _, v in got} >= {0.9, 3.3, 3.7, 7.1, 7.9}
    assert got == sorted((r[sql.columns.index("event_id")], r[sql.columns.index("pr")]) for r in sql.fetchall())


def test_companions_are_met_by_time(spark):
    """K6: rows are joined on key and bin, so a key with many rows is not compared with all its rows."""
    r = random.Random(5)
    left = [(r.randrange(2), r.randrange(40000) / 10, i) for i in range(300)]
    right = [(r.randrange(2), r.randrange(40000) / 10, i) for i in range(300)]
    frame = lambda rows, t, i: spark.createDataFrame(rows, "key long, s double, i long").selectExpr("key", f"timestamp_millis(cast(s * 1000 as long)) as {t}", f"i as {i}")
    got = K.companions(frame(left, "t", "id"), frame(right, "ct", "obj"), 40, 15)
    assert "bin" in "".join(line for line in plan(got).splitlines() if "Join" in line).split("Inner")[0]
    want = sorted((i, j) for k, t, i in left for k2, u, j in right if k == k2 and -400 <= round(10 * (u - t)) <= 150)
    assert sorted((x["id"], x["obj"]) for x in got.collect()) == want


def test_carried_stream_is_an_hourly_aggregate(spark):
    """K3: no task code or state for each key beside Spark's own aggregation."""
    rows = spark.sql("select * from values (1L, 'a', timestamp'2024-01-01 00:10:00', 5), (1L, 'a', timestamp'2024-01-01 00:50:00', 3), (1L, 'a', timestamp'2024-01-01 02:00:00', 1), (null, null, timestamp'2024-01-02 00:00:00', null) as t(station_id, param, ts, aqi)")
    out = K.carried_forward(rows)
    assert "Python" not in plan(out) and "Pandas" not in plan(out)
    assert sorted((r["hour"].hour, r["aqi"]) for r in out.collect()) == [(0, 5), (1, 5), (2, 1), (3, 1), (4, 1), (5, 1)]


def test_crowded_points_go_to_few_nodes(spark):
    """Where nodes have enough points nearby, farther ones are not sent to them; the surface is that of all points."""
    r = random.Random(11)
    rows = [(h, i, round(r.uniform(-6, 4), 2), round(r.uniform(-3, 7), 2), float(r.randrange(300))) for h, n in [(0, 4000), (1, 30), (2, 2)] for i in range(n)]
    rows += [(3, i, 1.0, 2.0, float(i)) for i in range(40)] + [(3, 50, 5.25, 2.5, 9.0), (3, 51, float("nan"), 2.0, 7.0), (3, 52, None, 2.0, 7.0), (4, 0, 0.5, 0.5, 1.0), (4, 1, None, 0.0, 1.0), (4, 2, None, None, 1.0)]
    points = spark.createDataFrame(rows, "hour long, station_id long, lat double, lon double, v double")
    want, pairs = {}, 0
    for h in (0, 1, 3, 4):
        there = [x for x in rows if x[0] == h and x[2] is not None and x[2] == x[2]]
        for gy in range(-11, 11):
            for gx in range(-8, 13):
                near = sorted(((gy - y) ** 2 + (gx - x) ** 2, i, v) for _, i, y, x, v in there if (gy - y) ** 2 + (gx - x) ** 2 <= 16)
                pairs += len(near) if h == 0 else 0
                if near:
                    w = [1 / (d2 + 0.09) for d2, _, _ in near[:20]]
                    want[h, gy, gx] = (len(w), round(sum(a * v for a, (_, _, v) in zip(w, near, strict=False)) / sum(w), 6))
    got = {(x["hour"], x["lat"], x["lon"]): (x["n"], round(x["v"], 6)) for x in G.idw_surface(points, ["hour"]).collect()}
    assert got == want
    assert G.sent_to_nodes(points.where("hour = 0"), ["hour"]).count() < pairs / 4
