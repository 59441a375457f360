"""Operators against loops over small random tables, and against stated cases."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isobar.operators import grids as G
from isobar.operators import listings as L
from isobar.operators import points as P
from isobar.operators import volumes as V
from isobar.plans import catalog as C
from isobar.sources import parsers, publish


@pytest.mark.parametrize("seed", [1, 2])
def test_declutter_rank_equals_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(f"s{i:03}", rng.uniform(24, 32), rng.uniform(-100, -92), rng.choice([0, 1, 2, 3])) for i in range(120)]
    rank = {}
    for level, size in enumerate(P.CELLS):
        claimed = set()
        for i, lat, lon, prio in sorted(rows, key=lambda r: (r[3], r[0])):
            cell = (math.floor((lat + 90) / size), math.floor((lon + 180) / size))
            if i not in rank and (prio == 0 or level >= 2) and cell not in claimed:
                claimed.add(cell)
                rank[i] = level
    got = P.declutter_rank(spark.createDataFrame(rows, "id string, lat double, lon double, prio int")).collect()
    assert {r["id"]: r["rank"] for r in got} == {r[0]: rank.get(r[0], 5) for r in rows}


def test_carried_forward_equals_a_loop(spark):
    rng = random.Random(3)
    hours = sorted(rng.sample(range(60), 20))
    rows = [("a", "p", f"2024-01-{1 + h // 24:02} {h % 24:02}:00:00", h) for h in hours]
    frame = spark.createDataFrame(rows, "station_id string, param string, h string, aqi int").withColumn("hour", F.to_timestamp("h")).drop("h")
    got = {(r["hour"].day - 1) * 24 + r["hour"].hour: r["aqi"] for r in P.carried_forward(frame, ["station_id", "param"]).collect()}
    expected = {h: max(x for x in hours if x <= h) for h in range(hours[0], hours[-1] + 4) if any(h - 3 <= x <= h for x in hours)}
    assert got == expected


def test_nearest_incident_equals_a_loop(spark):
    rng = random.Random(4)
    spots = [(i, rng.uniform(30, 33), rng.uniform(-101, -98)) for i in range(80)]
    fires = [(i, rng.uniform(30, 33), rng.uniform(-101, -98), rng.choice([0.0, 1e5, 1e6])) for i in range(25)]

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    expected = {}
    for i, lat, lon in spots:
        near = [(km(lat, lon, fa, fo), k) for k, fa, fo, acres in fires if km(lat, lon, fa, fo) <= min(max(1.2 * math.sqrt(acres * 0.00404686), 3), 60)]
        if near:
            expected[i] = min(near)[1]
    got = P.nearest_incident(spark.createDataFrame(spots, "spot_id long, lat double, lon double"), spark.createDataFrame(fires, "fire_id long, lat double, lon double, acres double")).collect()
    assert {r["spot_id"]: r["fire_id"] for r in got} == expected


def cells(spark, grid):
    rows = [(1, r, c, v) for r, line in enumerate(grid) for c, v in enumerate(line) if v is not None]
    return spark.createDataFrame(rows, "field int, r int, c int, v double")


def values(frame, r="r", c="c"):
    return {(x[r], x[c]): x["v"] for x in frame.collect()}


def test_decimate_and_box_mean(spark):
    grid = [[1.0, 3.0, None, None], [None, 2.0, None, None], [None] * 4, [None, None, None, 9.0]]
    assert values(G.decimate(cells(spark, grid))) == {(0, 0): 2.0, (1, 1): 9.0}
    assert values(G.box_mean(cells(spark, [[None] * 3, [None, 9.0, None], [None] * 3]))) == {(1, 1): 1.0}


@pytest.mark.parametrize("s", [2, 3, 4])
def test_block_mean_pads_edges(spark, s):
    rng = random.Random(s)
    n, m = 7, 9
    grid = [[float(rng.randint(0, 50)) for _ in range(m)] for _ in range(n)]
    half, expected = s // 2, {}
    for tr in range(-(-n // s)):
        for tc in range(-(-m // s)):
            block = [grid[min(max(tr * s - half + i, 0), n - 1)][min(max(tc * s - half + j, 0), m - 1)] for i in range(s) for j in range(s)]
            expected[tr, tc] = pytest.approx(sum(block) / len(block))
    assert values(G.block_reduce(cells(spark, grid), s, "mean"), "tr", "tc") == expected


def test_dilation_and_fringe(spark):
    one = spark.createDataFrame([(1, 0, 0, 5.0)], "field int, r int, c int, v double")
    assert {(x["r"], x["c"]) for x in G.dilated(one, 1, 3, 3).collect()} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert len(values(G.fringe_filled(one, 2, 3, 3))) == 9


def test_unexpected_grid_is_refused(spark):
    with pytest.raises(PySparkException):
        G.checked_grid(cells(spark, [[1.0, 2.0]]), 1, 1).collect()


def test_level_plan(spark):
    heights = spark.createDataFrame(list(enumerate(V.NATIVE_M)), "lvl int, height_m int")
    targets = spark.createDataFrame([(k, 250 + 500 * k) for k in range(38)], "k int, height_m int")
    plan = {r["k"]: (r["lower"], r["upper"], r["t"]) for r in V.bracketing(heights, targets).collect()}
    assert len(plan) == 38 and len(V.NATIVE_M) == 33
    assert plan[0] == (0, 0, 0.0) and plan[1] == (1, 1, 0.0) and plan[5] == (9, 9, 0.0)
    assert plan[6] == (10, 11, 0.5) and plan[37] == (31, 32, 0.75)


def test_blend_vectors(spark):
    def blend(pairs, t, none, fade):
        rows = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "a double, b double")
        return [r[0] for r in rows.select(V.blended(F.col("a"), F.col("b"), F.lit(t), none, fade)).collect()]

    assert blend([(0, 0), (0, 66), (66, 0), (100, 200)], 0.5, 0.0, 2.0) == [0, 34, 34, 150]
    assert blend([(128, 128), (178, 128)], 0.5, 128.0, 128.0) == [128, 153]


def test_as_of_takes_the_newest_in_the_span(spark):
    rows = spark.createDataFrame([("k", 1000, 1), ("k", 9000, 2)], "key string, t long, id long")
    there = spark.createDataFrame([("k", 500, 1), ("k", 1039, 2), ("k", 1119, 3), ("k", 900, 4)], "key string, t long, obj long")
    assert {r["id"]: r["ct"] for r in L.as_of(rows, there, 360, 90).collect()} == {1: 1039, 2: None}


def test_retention_of_stamps(spark):
    rows = spark.createDataFrame([("p", 0), ("p", 100), ("p", 200), ("p", None)], "product string, t long")
    assert sorted(r["t"] for r in L.merged_stamps(rows.withColumn("tile", F.lit(1)), rows.withColumn("tile", F.lit(1)), 120).collect()) == [100, 200]


def test_calendar(spark):
    rows = C.calendar(C.models(spark).where("model in ('HRRR', 'ECMWF', 'RRFS15')"))
    hours = {(r["model"], r["run_hour"]): r["n"] for r in rows.groupBy("model", "run_hour").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert hours["HRRR", 6] == 49 and hours["HRRR", 7] == 19
    assert hours["ECMWF", 3] == 49 + 16 and hours["RRFS15", 0] == 72
    assert len(C.product_rows()) == 192 and len(C.model_rows()) == 46


def test_patterns(spark):
    row = spark.range(1).select(C.filled_pattern(F.lit("APCP:{fh_minus_1}-{fh} hour"), F.lit(7)), C.implied_floor(F.lit("x{fh_minus_3}"))).first()
    assert tuple(row) == ("APCP:6-7 hour", 3)


def test_every_formula_is_an_expression(spark):
    inputs = spark.createDataFrame([tuple([1] + [float(i) for i in range(1, 8)])], "k int, A double, B double, C double, D double, E double, F double, G double")
    codes = [r["code"] for r in C.product_rows() if r["expr"]]
    assert len(C.evaluated(inputs, codes, ["k"]).first()) == len(codes) + 1


def test_parsers_drop_bad_rows(spark):
    lines = spark.createDataFrame([("5;a/b",), ("x;a",), ("7",), (None,)], "line string")
    assert [tuple(r) for r in parsers.listing(lines).collect()] == [(5, "a/b")]
    idx = spark.createDataFrame([("3.2:100:d=2024010100:TMP:500 mb:6 hour fcst",), ("bad",)], "line string")
    assert [r["msg"] for r in parsers.inventory_text(idx).collect()] == ["3.2"]


def test_guard_refuses(spark):
    assert publish.guarded(spark.range(5), 5, "rows").count() == 5
    with pytest.raises(PySparkException):
        publish.guarded(spark.range(4), 5, "rows").collect()
    with pytest.raises(ValueError):
        publish.union_of_feeds([None])


def test_tiles_and_pointer_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2, "x")], "run int, tile int, v string")
    publish.write_tiles(rows, str(tmp_path / "t"), ["run", "tile"])
    assert (tmp_path / "t" / "run=1" / "tile=2").is_dir()
    publish.publish(rows, rows.select("run"), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p" / "pointer")).count() == 1


def test_csv_feeds_that_fail_are_left_out(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lat,lon\n1,2\n")
    feeds = publish.readable(spark, [str(tmp_path / "a.csv"), str(tmp_path / "none.csv")])
    assert publish.union_of_feeds(feeds).count() == 1


def test_places_in_sorted_groups_that_are_spread_over_tasks(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, rng.randrange(50) / 4, rng.gauss(0, 9)])) for k in ["a"] * 3000 + ["b"] * 8 + ["c", None, None, None, None]] + [("d", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put into one range
    try:
        out = L.at_places(frame, "k", "v", L.middle() | {"p90": L.nearest_rank(0.9)})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for k in {k for k, _ in rows}:
        v = sorted(x for j, x in rows if j == k and x is not None)
        if v:
            want[k] = (v[(len(v) - 1) // 2], v[len(v) // 2], v[round(0.9 * (len(v) - 1))])
    assert {r["k"]: tuple(r)[1:] for r in out.collect()} == want
    ranges = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
    assert ranges.where("g = 'a'").select("part").distinct().count() > 1  # a large group isn't in one task


def test_walk_back_equals_a_loop(spark):
    rng = random.Random(4)
    offsets = [0, 1, -1, -2, -3, 2, 3]
    wanted = [(i, rng.randrange(60)) for i in range(100)]
    there = [rng.randrange(60) for _ in range(15)]
    got = L.walk_back(spark.createDataFrame(wanted, "id long, t long"), spark.createDataFrame([(r,) for r in there], "run long"), offsets)
    want = {i: next(((t + o, o) for o in offsets if t + o in there), None) for i, t in wanted}
    assert {r["id"]: (r["run"], r["offset"]) for r in got.collect()} == {i: x for i, x in want.items() if x}


def test_no_level_is_planned_above_the_highest_native(spark):
    """38 levels of 500 m, with centres from 250 m: all lie below 19 km, and 16 below 8 km."""
    targets = spark.createDataFrame([(k, 250 + 500 * k) for k in range(V.LEVELS)], "k int, height_m int")
    natives = lambda top: spark.createDataFrame([(i, h) for i, h in enumerate(V.NATIVE_M) if h <= top], "lvl int, height_m int")
    full = {r["k"]: (r["lower"], r["upper"], r["t"]) for r in V.bracketing(natives(19000), targets).collect()}
    assert len(full) == 38 and full[0] == (0, 0, 0.0) and full[1] == (1, 1, 0.0) and full[5] == (9, 9, 0.0) and full[6] == (10, 11, 0.5)
    assert full[37] == (31, 32, 0.75)
    low = V.bracketing(natives(8000), targets).collect()
    assert sorted(r["k"] for r in low) == list(range(16))
    top = spark.createDataFrame([(0, 8000)], "k int, height_m int")
    assert [(r["upper"], r["t"]) for r in V.bracketing(natives(8000), top).collect()] in ([(V.NATIVE_M.index(8000), 0.0)], [(V.NATIVE_M.index(8000), 1.0)])


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_fringe_by_distance_equals_rounds(spark, rounds):
    rng = random.Random(rounds)
    cells = {(r, c): rng.randrange(100) for r in range(12) for c in range(12) if rng.random() < 0.12}
    frame = spark.createDataFrame([(1, r, c, float(v)) for (r, c), v in cells.items()], "field int, r int, c int, v double")
    for _ in range(rounds):
        old = dict(cells)
        for r in range(12):
            for c in range(12):
                near = [old[r + i, c + j] for i in (-1, 0, 1) for j in (-1, 0, 1) if (r + i, c + j) in old]
                if (r, c) not in old and near:
                    cells[r, c] = max(near)
    assert {(r["r"], r["c"]): r["v"] for r in G.fringe_filled(frame, rounds, 12, 12).collect()} == cells


def test_gaps_between_rows_that_are_spread_over_tasks(spark):
    rng = random.Random(6)
    rows = [(rng.choice("aaab"), rng.randrange(10_000), i) for i in range(2000)] + [(None, 5, 9001), (None, 9, 9002), ("one", 3, 9003)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(((r["k"], r["gap"]) for r in L.gaps_between(spark.createDataFrame(rows, "k string, t long, i long"), "k", ["t", "i"], "t").collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for k in {k for k, _, _ in rows}:
        t = [x for _, x in sorted((i, x) for j, x, i in rows if j == k)] and [x for x, _ in sorted((x, i) for j, x, i in rows if j == k)]
        want += [(k, b - a) for a, b in zip(t, t[1:], strict=False)]
    assert got == sorted(want, key=str)


def test_newest_runs_and_stamps(spark):
    rows = [("p", run, i) for i, run in enumerate([5, 5, 4, 3, 3, 1])] + [("q", 2, 9)]
    frame = spark.createDataFrame(rows, "product string, run long, fh long")
    assert {(r["product"], r["run"]): r["purged"] for r in L.newest_runs(frame, 2).collect()} == {("p", 5): False, ("p", 4): False, ("p", 3): True, ("p", 1): True, ("q", 2): False}
    stamps = spark.createDataFrame([("p", 10), ("p", 100), ("q", 7), ("q", None)], "product string, t long").withColumn("tile", F.lit(1))
    assert sorted((r["product"], r["t"]) for r in L.merged_stamps(stamps, stamps, 50).collect()) == [("p", 100), ("q", 7)]


def test_runs_are_patched(spark):
    manifest = spark.createDataFrame([(1, "a", [0], [], 5), (1, "b", [0, 3], [0], 6)], "run long, product string, expected array<int>, available array<int>, src long")
    updates = spark.createDataFrame([(1, "a", 7), (1, "b", 6), (2, "b", 9)], "run long, product string, src long")
    got = {(r["run"], r["product"]): (r["expected"], r["available"], r["src"], r["changed"]) for r in L.patched_runs(manifest, updates).collect()}
    assert got == {(1, "a"): ([0], [0], 7, True), (1, "b"): ([0, 3], [0], 6, False), (2, "a"): ([0], [], None, False), (2, "b"): ([0, 3], [0], 9, True)}


def test_sites_off_the_grid_have_no_value(spark):
    sites = spark.createDataFrame([("in", 49.5, -124.5), ("off", 51.0, -124.5), ("gap", 48.5, -124.5)], "id string, lat double, lon double")
    cells = spark.createDataFrame([(0, 0, 3.0)], "r long, c long, v double")
    assert {r["id"]: r["v"] for r in V.sampled(sites, cells, 50.0, -125.0, 1.0, 5, 5).collect()} == {"in": 3.0, "off": None, "gap": None}
