"""Stated cases, one or more for each rule that is easily read another way."""

import math

import pytest
from pyspark.sql import functions as F

from isobar.functions import scalar as S
from isobar.operators import grids as G
from isobar.operators import listings as L
from isobar.operators import points as P
from isobar.operators import volumes as V
from isobar.plans import catalog as C
from isobar.sources import parsers


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_rows_without_a_confidence_stay_and_are_not_high(spark):
    assert values(spark, S.confidence(F.col("c")), [(None,), ("",), (" HIGH ",), ("45",)], "c string") == [False, False, True, None]


def test_brightness_is_whole_half_to_even(spark):
    rows = [("330.5", None), ("331.5", "1"), ("", "7.4"), ("x", "n/a"), ("0", "9")]
    assert values(spark, S.first_usable(F.col("a"), F.col("b")), rows, "a string, b string") == [330, 332, 7, 0, 0]


def test_pixel_sizes_and_day_flags(spark):
    rows = [("0.36", "0.41"), ("", "0.4"), (None, None), ("x", "0.4"), ("1.25", "1")]
    assert values(spark, S.footprint(F.col("a"), F.col("b")), rows, "a string, b string") == [0.4, 0.4, 0.0, 0.0, 1.2]
    assert values(spark, S.is_day(F.col("a")), [("D",), (" d",), ("N",), (None,)], "a string") == [True, True, False, False]


def test_parallax_by_force(spark):
    """Along the great circle away from the point under the satellite, by 4 km times the tangent of the zenith angle."""
    for lat, lon, sub in ((30.0, -100.0, -75.0), (47.0, -106.0, -137.0), (25.0, -75.0, -75.0), (-20.0, -60.0, -75.0)):
        a, b = S.parallax(F.col("lat"), F.col("lon"), sub)
        row = spark.createDataFrame([(lat, lon)], "lat double, lon double").select(a.alias("a"), b.alias("b")).first()
        p, d = math.radians(lat), math.radians(sub - lon)
        gamma = math.acos(math.cos(p) * math.cos(d))
        km = 4 * math.sin(gamma) / (math.cos(gamma) - 6378.137 / 42164.16)
        north = -math.sin(p) * math.cos(d) / math.sin(gamma) * km
        east = math.sin(d) / math.sin(gamma) * km
        assert row["a"] == pytest.approx(lat + north / 110.574, abs=1e-9)
        assert row["b"] == pytest.approx(lon + east / (111.320 * math.cos(p)), abs=1e-9)


def test_reflectivity_below_the_least_code_is_none(spark):
    assert values(spark, S.byte_dbz(F.col("x")), [(-31.51,), (-31.7,), (-31.5,), (-31.3,), (-31.2,)], "x double") == [0, 0, 3, 3, 4]


def test_incidents_without_an_area_reach_three_kilometres(spark):
    spots = spark.createDataFrame([(1, 40.0, -100.0), (2, 40.02, -100.0), (3, 40.2, -100.0)], "spot_id long, lat double, lon double")
    for acres in (-1.0, None, 0.0):
        fires = spark.createDataFrame([(9, 40.0, -100.0, acres)], "fire_id long, lat double, lon double, acres double")
        assert sorted(r["spot_id"] for r in P.nearest_incident(spots, fires).collect()) == [1, 2]
    wide = spark.createDataFrame([(9, 40.0, -100.0, 500_000.0)], "fire_id long, lat double, lon double, acres double")
    assert sorted(r["spot_id"] for r in P.nearest_incident(spots, wide).collect()) == [1, 2, 3]


OBS = "event_id int, type string, t_k double, t_k_flag string, td_k double, td_k_flag string, rh double, rh_flag string, wd double, wd_flag string, ws double, ws_flag string, wg double, wg_flag string, pr double, pr_flag string, pst1 int, pst3 int, elev double"
FINE = {"event_id": 0, "type": "g", "t_k": 290.0, "t_k_flag": "V", "td_k": 280.0, "td_k_flag": "V", "rh": 50.0, "rh_flag": None, "wd": 359.6, "wd_flag": "", "ws": 5.0, "ws_flag": "V", "wg": 9.0, "wg_flag": "V", "pr": 1.25, "pr_flag": "V", "pst1": 1, "pst3": 0, "elev": 120.5}


def test_quality_rules_one_by_one(spark):
    cases = [
        ({}, {"t_k": 290.0, "td_k": 280.0, "rh": 50.0, "wd": 0, "ws": 5.0, "wg": 9.0, "pr": 1.2, "period": "1h", "elev": 120}),
        ({"t_k": 340.0}, None), ({"t_k": 200.0}, None), ({"t_k_flag": "B"}, None), ({"t_k": None}, None), ({"type": "c", "t_k_flag": "C"}, None), ({"type": "c", "t_k_flag": None}, None), ({"type": "c", "t_k_flag": "K"}, {"t_k": 290.0}),
        ({"td_k_flag": "X"}, {"td_k": None}), ({"td_k": 290.5}, {"td_k": 290.5}), ({"td_k": 290.6}, {"td_k": None}), ({"td_k": 320.0, "t_k": 330.0}, {"td_k": None}), ({"td_k": 180.0}, {"td_k": None}),
        ({"rh": 105.0}, {"rh": 100.0}), ({"rh": 105.1}, {"rh": None}), ({"rh_flag": "Q"}, {"rh": None}), ({"rh": None}, {"rh": None}),
        ({"wd": 360.0}, {"wd": 0}), ({"wd": 360.1}, {"wd": None}), ({"wd": 12.5}, {"wd": 12}), ({"wd_flag": "X"}, {"wd": None}),
        ({"ws": 100.0}, {"ws": None, "wg": 9.0}), ({"ws_flag": "Q"}, {"ws": None, "wg": 9.0}), ({"wg": 4.9}, {"wg": None, "ws": 5.0}), ({"wg": 120.0}, {"wg": None}), ({"wg_flag": "B"}, {"wg": None}), ({"ws": None}, {"ws": None, "wg": 9.0}),
        ({"pr": 2000.0}, {"pr": None, "period": None}), ({"pst1": 2}, {"pr": None}), ({"pst3": 1}, {"pr": None}), ({"pr_flag": "X"}, {"pr": None, "period": None}), ({"pst1": -4}, {"period": "5m"}),
        ({"elev": 9000.5}, {"elev": None}), ({"elev": -9000.0}, {"elev": -9000}), ({"elev": None}, {"elev": None}),
    ]
    names = [c.split()[0] for c in OBS.split(", ")]
    rows = [tuple((FINE | change | {"event_id": i})[n] for n in names) for i, (change, _) in enumerate(cases)]
    got = {r["event_id"]: r for r in P.quality_controlled(spark.createDataFrame(rows, OBS)).collect()}
    for i, (change, want) in enumerate(cases):
        assert (want is None) == (i not in got), change
        for k, v in (want or {}).items():
            assert got[i][k] == v, (change, k)


def test_declutter_cells_count_from_the_south_pole(spark):
    rows = [("a", 1.0, 0.5, 0), ("b", 3.0, 0.5, 0), ("c", 1.5, 0.6, 0)]
    got = {r["id"]: r["rank"] for r in P.declutter_rank(spark.createDataFrame(rows, "id string, lat double, lon double, prio int")).collect()}
    assert got == {"a": 0, "b": 0, "c": 1}  # 91 // 4 is 22 and 93 // 4 is 23; each size begins without claims, so c has the next one


def test_byte_ranges_keep_an_open_end(spark):
    rows = [(1, 0, 9), (1, 10, 19), (1, 20, None), (2, 0, 9), (2, 40, 49), (3, 5, None), (3, 5, None), (4, 0, 9), (4, 11, 20)]
    spans = lambda gap: sorted(map(str, ((r["file_id"], r["off"], r["end"], r["n"]) for r in L.coalesced(spark.createDataFrame(rows, "file_id int, off long, end long"), gap).collect())))
    assert spans(0) == sorted(map(str, [(1, 0, None, 3), (2, 0, 9, 1), (2, 40, 49, 1), (3, 5, None, 1), (3, 5, None, 1), (4, 0, 9, 1), (4, 11, 20, 1)]))
    assert spans(30) == sorted(map(str, [(1, 0, None, 3), (2, 0, 49, 2), (3, 5, None, 1), (3, 5, None, 1), (4, 0, 20, 2)]))


def test_the_first_hour_starts_at_the_total_of_hour_zero(spark):
    rows = [("a", 0, 2.0), ("a", 1, 5.0), ("a", 3, 9.0), ("b", 1, 5.0), ("b", 2, 4.0), ("c", 2, 6.0), ("d", 0, 1.0)]
    got = {(r["site"], r["fh"]): r["amount"] for r in V.hourly_amounts(spark.createDataFrame(rows, "site string, fh int, total double")).collect()}
    assert got == {("a", 1): 3.0, ("b", 1): 5.0, ("b", 2): 0.0}


def test_blends_at_the_fade_code_are_none(spark):
    rows = [(0.0, 0.0, 0.5), (0.0, 3.0, 0.25), (3.0, 0.0, 0.9), (2.0, 2.0, 0.5), (2.0, 9.0, 0.0), (9.0, 2.0, 1.0), (0.0, 66.0, 0.5), (100.0, 200.0, 0.5), (255.0, 255.0, 0.5)]
    frame = spark.createDataFrame(rows, "a double, b double, t double")
    got = [r[0] for r in frame.select(V.blended(F.col("a"), F.col("b"), F.col("t"), 0.0, 2.0)).collect()]
    assert got == [0.0, 0.0, 0.0, 0.0, 2.0, 2.0, 34.0, 150.0, 255.0]
    same = [r[0] for r in spark.createDataFrame([(128.0, 128.0, 0.5), (178.0, 128.0, 0.5)], "a double, b double, t double").select(V.blended(F.col("a"), F.col("b"), F.col("t"), 128.0, 128.0)).collect()]
    assert same == [128.0, 153.0]


def test_columns_with_one_of_two_levels_fade(spark):
    plan = spark.createDataFrame([(0, 1, 2, 0.5), (1, 2, 2, 0.0)], "k int, lower int, upper int, t double")
    columns = spark.createDataFrame([("low", 1, 66.0), ("high", 2, 66.0)], "col_id string, lvl int, v double")
    got = {(r["col_id"], r["k"]): r["v"] for r in V.interpolated(columns, plan).collect()}
    assert got == {("low", 0): 34.0, ("high", 0): 34.0, ("high", 1): 66.0}


def test_cyan_rows_spoil_a_frame(spark):
    rows = [(f, y, x, *rgb) for f, rgb in ((1, (110, 190, 200)), (2, (150, 190, 200)), (3, (110, 150, 200)), (4, (110, 190, 180))) for y in range(6) for x in range(10)]
    got = {r["frame"]: (r["cyan_rows"], r["good"]) for r in G.frame_quality(spark.createDataFrame(rows, "frame int, y int, x int, r int, g int, b int")).collect()}
    assert got == {1: (6, False), 2: (0, True), 3: (0, True), 4: (0, True)}


def test_inventory_keys_depend_on_level_and_step(spark):
    cases = [
        ("REFC", "500 mb", "6 hour fcst", None), ("REFC", "entire atmosphere", "6 hour fcst", "REFC:col"), ("REFC", "entire atmosphere", "", None), ("APCP", "2 m above ground", "0-6 hour acc fcst", None),
        ("APCP", "surface", "0-6 hour acc fcst", "APCP:total"), ("APCP", "surface", "5-6 hour acc fcst", None), ("MAXREF", "1000 m above ground", "5-6 hour max fcst", "MAXREF:1km"), ("MAXREF", "1000 m above ground", "6 hour fcst", None),
        ("RH", "2 m above ground", "6 hour fcst", None), ("TMP", "850 mb", None, "TMP:850"), ("TMP", "825 mb", None, None), ("RH", "850 mb", None, None), ("PRES", "surface", None, "PRES:sfc"), ("HGT", "surface", None, "HGT:sfc"),
        ("DPT", "2 m above ground", None, "DPT:2m"), ("VGRD", "10 m above ground", None, "VGRD:10m"), ("TMP", "surface", None, None), ("TMP", "x mb", None, None),
    ]
    got = values(spark, parsers.inventory_key(F.col("v"), F.col("l"), F.col("s")), [c[:3] for c in cases], "v string, l string, s string")
    assert got == [c[3] for c in cases]


def test_objects_of_products_that_the_catalog_has(spark):
    paths = ["refc/2024010112/F003.png", "refc/2024010112/F003.json", "gone/2024010112/F003.png", "refc/202401011200/M00915.png", "refc/latest/F000.png", "manifest.json", "refc/2024010113/F000.src-130412", "refc/2024010113/F000.src-125959", "refc/2024010113/F000.src-1304"]
    frame, catalog = spark.createDataFrame([(p,) for p in paths], "path string"), C.products(spark)
    rows = sorted((r["run"], r["fh"] or -1, r["unit"] or "") for r in parsers.frame_keys(frame, catalog).collect())
    assert rows == [("2024010112", -1, ""), ("2024010112", 3, "h"), ("202401011200", 915, "m"), ("2024010113", -1, ""), ("2024010113", -1, ""), ("2024010113", -1, "")]
    row = parsers.source_times(frame, catalog).select("product", "run", "src", F.unix_timestamp("t")).collect()
    assert [tuple(r) for r in row] == [("refc", "2024010113", "130412", 1704114252)]
