"""Frames, images, ramps, admission, soundings, cycles and guards against plain loops and stated cases."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import grids as G
from isobar.operators import listings as L
from isobar.operators import volumes as V
from isobar.plans import catalog as C
from isobar.sources import parsers, publish


def pixels(spark, frames):
    rows = [(f, y, x, int(v), 0, 0) for f, a in frames.items() for (y, x), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "frame int, y int, x int, r int, g int, b int")


def verdict_by_force(lum):
    n, dark = len(lum), lum <= 6
    ring = dark.copy()
    for _ in range(3):
        ring = ring | np.roll(ring, 1, 0) | np.roll(ring, -1, 0) | np.roll(ring, 1, 1) | np.roll(ring, -1, 1)
    ring &= ~dark
    ring[:4], ring[-4:], ring[:, :4], ring[:, -4:] = False, False, False, False
    longest = 0
    for edges in ((dark[:, :-1] != dark[:, 1:]).T, dark[:-1] != dark[1:]):
        for line in edges:
            for run in re.findall("1+", "".join("01"[int(v)] for v in line)):
                longest = max(longest, len(run))
    ok = 0.005 <= dark.mean() <= 0.97 and ring.sum() >= 40 and lum[ring].mean() >= 45 and longest / n >= 0.12
    return float(dark.mean()), int(ring.sum()), longest, bool(ok)


def test_frame_verdicts_equal_loops(spark):
    rng = np.random.default_rng(1)
    n = 40
    day = rng.integers(60, 200, (n, n))
    frames = {0: day, 1: day.copy(), 2: day.copy(), 3: np.full((n, n), 20), 4: rng.integers(0, 14, (n, n)), 5: day.copy(), 6: day.copy(), 7: np.zeros((n, n), int)}
    frames[1][10:22, 8:20] = 0
    frames[2][:, 36:] = 3  # dark at one side is a neighbour of the other, where the border doesn't count
    frames[3][10:22, 8:20] = 0
    frames[5][np.add.outer(np.arange(n), np.arange(n)) % 80 < 25] = 0
    frames[6][0:12, 0:12] = 6
    got = {r["frame"]: (r["share"], r["ring"], r["longest"], r["void"]) for r in G.void_verdict(pixels(spark, frames), n).collect()}
    want = {k: verdict_by_force(a) for k, a in frames.items()}
    assert got == want and {v[3] for v in want.values()} == {True, False}
    quality = {r["frame"]: r["rejected"] for r in G.rejected_frames(pixels(spark, frames), n).collect()}
    assert quality[1] and quality[7] and not quality[0]


def test_pixels_that_are_absent_are_dark(spark):
    day = {0: np.full((40, 40), 100)}
    rows = pixels(spark, day).where("not (y between 10 and 21 and x between 8 and 19)")
    assert G.void_verdict(rows, 40).first()["void"] is True


def test_images_equal_loops(spark):
    rng = random.Random(2)
    grid = {(r, c): float(rng.randrange(100)) for r in range(30) for c in range(24) if rng.random() < 0.8}
    cells = spark.createDataFrame([(1, r, c, v) for (r, c), v in grid.items()], "field int, r long, c long, v double")
    box, lat0, lon0, step = (-9.0, 33.0, 12.0, 58.0), 60.0, -10.0, 1.0
    for width, height in ((7, 6), (50, 60)):
        rows, columns = G.mercator_lines(spark, box, width, height, lat0, lon0, step, step)
        y = lambda lat: math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))
        lat = lambda k, h=height: math.degrees(2 * math.atan(math.exp(y(box[3]) - k * (y(box[3]) - y(box[1])) / h))) - 90
        row = lambda k, f=lat: lat0 - f(k)
        column = lambda k, w=width: box[0] + k * (box[2] - box[0]) / w - lon0
        near, top, four = {}, {}, {}
        for i in range(height):
            for j in range(width):
                v = grid.get((math.floor(row(i + 0.5)), math.floor(column(j + 0.5))))
                if v is not None:
                    near[i, j] = v
                touched = [v for (r, c), v in grid.items() if r < row(i + 1) and r + 1 > row(i) and c < column(j + 1) and c + 1 > column(j)]
                if touched:
                    top[i, j] = max(touched)
                a, b, total, weight = row(i + 0.5) - 0.5, column(j + 0.5) - 0.5, 0.0, 0.0
                for r in (math.floor(a), math.floor(a) + 1):
                    for c in (math.floor(b), math.floor(b) + 1):
                        w = (1 - abs(a - r)) * (1 - abs(b - c))
                        if (r, c) in grid and w > 1e-12:
                            total, weight = total + w * grid[r, c], weight + w
                if weight:
                    four[i, j] = total / weight
        for how, want in (("near", near), ("max", top), ("bilinear", four)):
            got = {(r["i"], r["j"]): r["v"] for r in G.to_mercator(cells, rows, columns, how).collect()}
            assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want), how


def test_products_are_resampled_as_the_catalog_has_it(spark):
    cells = spark.createDataFrame([(p, r, c, float(r * 10 + c)) for p in "abc" for r in range(4) for c in range(4)], "code string, r long, c long, v double")
    products = spark.createDataFrame([("a", "near"), ("b", "max"), ("c", "bilinear")], "code string, resample string")
    dims = G.mercator_lines(spark, (0.0, -1.0, 4.0, 1.0), 1, 1, 2.0, 0.0, 1.0, 1.0)
    got = {r["code"]: r["v"] for r in G.products_to_mercator(cells, products, *dims).collect()}
    assert got["b"] == 23.0 and got["c"] == pytest.approx(16.5) and got["a"] in (12.0, 22.0)


def test_ramps(spark):
    text = ["10 0 0 0", "20 100 50 10 0", "40 200 50 30", "nv 1 2 3", "# all others"]
    lines = spark.createDataFrame([(k, t) for k in ("smooth", "steps") for t in text] + [("one", "5 7 8 9 10")], "ramp string, line string")
    modes = spark.createDataFrame([("smooth", True), ("steps", False), ("one", True)], "ramp string, linear boolean")
    cases = [("smooth", 15.0), ("smooth", 30.0), ("smooth", -9.0), ("smooth", 99.0), ("smooth", 20.0), ("smooth", None), ("smooth", float("nan")), ("steps", 14.9), ("steps", 15.0), ("steps", 40.0), ("one", 3.0), ("one", 5.0), ("one", None), ("gone", 1.0)]
    values = spark.createDataFrame([(i, r, v) for i, (r, v) in enumerate(cases)], "id int, ramp string, v double")
    got = {r["id"]: (r["red"], r["green"], r["blue"], r["alpha"]) for r in G.coloured(values, parsers.ramp_lines(lines), modes).collect()}
    none = (1, 2, 3, 255)
    want = [(50, 25, 5, 128), (150, 50, 20, 128), (0, 0, 0, 255), (200, 50, 30, 255), (100, 50, 10, 0), none, none, (0, 0, 0, 255), (100, 50, 10, 0), (200, 50, 30, 255), (7, 8, 9, 10), (7, 8, 9, 10), (0, 0, 0, 0), (None,) * 4]
    assert [got[i] for i in range(len(cases))] == want


def test_admission_equals_a_loop(spark):
    rng = random.Random(4)
    models, codes, hours = ["M", "N"], ["a", "b", "c"], list(range(0, 30))
    own = {"a": (None, 24, None, []), "b": (2, None, 3, ["x:{fh_minus_1}-{fh}", "y:{fh_minus_6}"]), "c": (None, None, None, [None, "{fh_minus_12}{fh_minus_3}"])}
    mins, caps, skips = [("M", "a", 4), ("M", "a", 2), ("N", "c", 20)], [("N", "a", 12), ("N", "a", 15)], [("M", "a", 8, 10), ("M", "a", 9, 13), ("N", "b", 0, 40), ("M", "c", rng.randrange(20), 21)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    listed = [(m, c) for m in models for c in codes if (m, c) != ("N", "c")]
    got = C.admissions(frame([*listed, listed[0]], "model string, code string"), frame([(c, *v) for c, v in own.items()], "code string, fh_min int, fh_cap int, fh_step int, patterns array<string>"), frame([(m, h) for m in models for h in hours], "model string, fh int"), frame(mins, "model string, code string, fh int"), frame(caps, "model string, code string, fh int"), frame(skips, "model string, code string, lo int, hi int"))
    want = []
    for m, c in listed:
        lo, hi, step, patterns = own[c]
        floor = max([lo or 0, *(int(n) for p in patterns if p for n in re.findall(r"\{fh_minus_(\d+)\}", p)), *(h for x, y, h in mins if (x, y) == (m, c))])
        top = min([hi if hi is not None else 99, *(h for x, y, h in caps if (x, y) == (m, c))])
        want += [(m, c, h) for h in hours if floor <= h <= top and h % (step or 1) == 0 and not any((x, y) == (m, c) and a <= h <= b for x, y, a, b in skips)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_patterns_with_several_hours(spark):
    row = spark.range(1).select(C.filled_pattern(F.lit("{fh_minus_1}-{fh}|{fh_minus_6}-{fh}|{fh_minus_1}"), F.lit(9)), C.implied_floor(F.lit("{fh_minus_1} {fh_minus_6}"), F.lit(None).cast("string"), F.lit("{fh_minus_2}"))).first()
    assert tuple(row) == ("8-9|3-9|8", 6)


def test_messages_meet_patterns_of_their_variable_and_others(spark):
    messages = spark.createDataFrame([("M", 1, ":TMP:2 m:"), ("M", 2, ":RH:2 m:"), ("M", 3, "WIND:10 m"), ("N", 1, ":TMP:2 m:")], "model string, msg int, text string")
    patterns = spark.createDataFrame([("M", "t", "^:TMP:2 m"), ("M", "any", "10 m$"), ("M", "w", "^WIND:9"), ("M", "rh", "^:(RH|DPT):")], "model string, code string, match string")
    assert sorted(map(tuple, C.matched(messages, patterns).collect())) == [("M", 1, "t"), ("M", 2, "rh"), ("M", 3, "any")]


SOUNDING = {"PRES:sfc": 92000.0, "HGT:sfc": 700.04, "TMP:2m": 295.15, "DPT:2m": 300.0, "UGRD:10m": 1.0, "VGRD:10m": -2.0}


def level(mb, t=280.0, td=270.0, h=1000.0):
    return {f"TMP:{mb}": t, f"DPT:{mb}": td, f"HGT:{mb}": h, f"UGRD:{mb}": 5.0}


def test_soundings_begin_at_the_surface(spark):
    cases = {
        "all": SOUNDING | level(1000) | level(850) | level(700) | level(500),
        "no dew point": SOUNDING | level(850) | level(700, td=None) | level(500) | level(300),
        "no surface": level(850) | level(700) | level(500) | level(300) | {"HGT:sfc": 5.0},
        "too few": SOUNDING | level(850) | level(700),
        "celsius": SOUNDING | {"TMP:2m": 22.0, "DPT:2m": 10.0} | level(850, 12.0, 20.0) | level(700) | level(500),
    }
    rows = [(s, 1, k, v) for s, d in cases.items() for k, v in d.items()]
    got = {r["site"]: r for r in V.profiles(spark.createDataFrame(rows, "site string, fh int, key string, v double"), (1000, 850, 700, 500, 300)).collect()}
    assert set(got) == {"all", "no dew point", "no surface", "celsius"}
    a = got["all"]
    assert a["pres_hpa"] == [920.0, 850.0, 700.0, 500.0] and a["elev_m"] == 700.0 and a["temp_c"] == [22.0, 6.85, 6.85, 6.85]
    assert a["dewpoint_c"][0] == 22.0 and a["u_ms"] == [1.0, 5.0, 5.0, 5.0] and a["v_ms"] == [-2.0, 0.0, 0.0, 0.0]
    assert got["no dew point"]["pres_hpa"] == [920.0, 850.0, 500.0, 300.0]
    assert got["no surface"]["pres_hpa"] == [850.0, 700.0, 500.0, 300.0] and got["no surface"]["elev_m"] == 5.0
    assert got["celsius"]["temp_c"][:2] == [22.0, 12.0] and got["celsius"]["dewpoint_c"][:2] == [10.0, 12.0]


def test_tiles_hold_hours_that_hold_columns(spark):
    levels = (850, 500)
    rows = []
    for r in range(3):
        for c in range(3):
            for fh in (0, 1, 2):
                fields = SOUNDING | level(850, 280.0 + c) | level(500, 250.0 + r) | {"VGRD:850": 1.0, "VGRD:500": 1.0, "APCP:total": float(fh * 3 + r), "REFC:col": 30.0}
                if fh == 0:
                    del fields["APCP:total"]
                rows += [(r, c, fh, k, v) for k, v in fields.items() if not (fh == 2 and k == "DPT:500")]
    tiles = {(t["tr"], t["tc"]): t for t in V.profile_tiles(spark.createDataFrame(rows, "r int, c int, fh int, key string, v double"), levels, 2).collect()}
    assert set(tiles) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    t = tiles[0, 0]
    assert [(x["r"], x["c"]) for x in t["columns"]] == [(0, 0), (0, 1), (1, 0), (1, 1)] and t["pres_hpa"] == [850.0, 500.0]
    assert (t["r0"], t["r1"], t["c0"], t["c1"]) == (-0.75, 1.75, -0.75, 1.75)
    assert [h["fh"] for h in t["hours"]] == [0, 1]  # hour 2 lacks a field
    first, second = t["hours"]
    assert first["qpf_mm"] == [None] * 4 and second["qpf_mm"] == [3.0, 3.0, 4.0, 4.0] and second["refl_dbz"] == [30.0] * 4
    assert second["temp_c"][1] == [7.8, -23.2] or second["temp_c"][1] == [7.9, -23.1]  # 281 K and 250 K to a tenth, half to even
    assert second["sfc_dewpoint_c"] == [22.0] * 4


def test_newest_cycles_equal_a_loop(spark):
    rng = random.Random(7)
    sources = [("ru", 900, 3600, False), ("gfs", 21600, 64800, True)]
    there = {("ru", rng.randrange(60, 115) * 900, 0) for _ in range(6)} | {("gfs", rng.randrange(5) * 21600, rng.randrange(20)) for _ in range(40)}
    wanted = [(i, rng.randrange(50_000, 110_000)) for i in range(200)] + [(900, 64800 + 5400), (901, 64800 + 9000)]
    want = {}
    for i, t in wanted:
        for name, step, back, forecasts in sources:
            cycle = t // step * step
            while t - cycle <= back and i not in want:
                hour = max(0, round((t - cycle) / 3600)) if forecasts else 0
                if (name, cycle, hour) in there:
                    want[i] = (name, cycle, hour)
                cycle -= step
    got = L.newest_cycles(spark.createDataFrame(wanted, "id long, t long"), spark.createDataFrame(sorted(there), "source string, cycle long, fhr long"), sources)
    assert {r["id"]: (r["source"], r["cycle"], r["fhr"]) for r in got.collect()} == want and {v[0] for v in want.values()} == {"ru", "gfs"}


def test_partial_runs_and_stamps_of_other_tiles(spark):
    runs = [("p", r, h, c) for r, h, c in ((9, 30, False), (8, 5, True), (7, 30, True), (6, 5, True), (5, 40, True), (4, 40, None))]
    got = {r["run"]: r["kept"] for r in L.two_class_retention(spark.createDataFrame(runs, "product string, run int, hours int, complete boolean"), 1, 2).collect()}
    assert got == {9: False, 8: True, 7: True, 6: False, 5: True, 4: False}
    stamps = lambda rows: spark.createDataFrame(rows, "product string, tile int, t long")
    rows = L.merged_stamps(stamps([("p", 16, 100)]), stamps([("p", 8, 120), ("p", 16, 60), ("p", 16, 90), ("p", 16, 100), ("q", 16, 5)]), 30).collect()
    assert sorted((r["t"], r["place"]) for r in rows) == [(90, 2), (100, 1)]


def test_a_failed_listing_leaves_no_stamp(spark):
    listed = spark.createDataFrame([(n, s) for s in (1, 2) for n in "ab"] + [("a", 3)], "level_name string, stamp int")
    failed = spark.createDataFrame([("b",)], "level_name string")
    assert [r["stamp"] for r in V.newest_stamp(listed, 2).collect()] == [2]
    assert V.newest_stamp(listed, 2, failed).count() == 0 and V.newest_stamp(listed, 2, failed.limit(0)).count() == 1
    assert V.newest_stamp(listed, 3).count() == 0


def test_nothing_is_published_over_a_good_feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    frame = lambda rows: spark.createDataFrame(rows, "kind string, n int")
    good = [("fires", 1), ("fires", 2), ("spots", 3)]
    assert publish.write_guarded(frame(good), path, "kind", {"fires": 2, "spots": 1, "lines": 1}, optional=("lines",)) == {"fires": 2, "spots": 1, "lines": 0}
    for rows, least, of in (([("fires", 9)], {"fires": 2}, None), ([("spots", 9)], {"fires": 0}, None), (good, {"fires": 1}, (2, 3)), ([], {}, None), ([("fires", 9), ("lines", 1)], {"fires": 1, "lines": 2}, None)):
        with pytest.raises(publish.Refused):
            publish.write_guarded(frame(rows), path, "kind", least, optional=("lines",), of=of)
        assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(good)
    publish.write_guarded(frame([("fires", 7)]), path, "kind", {"fires": 1})
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("fires", 7)]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["feed"]


def test_files_that_break_while_they_are_read(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 5).coalesce(1).write.parquet(str(tmp_path / f"f{k}"))
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 not a table PAR1")
    paths = [str(tmp_path / f"f{k}") for k in range(3)] + [str(tmp_path / "broken.parquet"), str(tmp_path / "none")]
    assert publish.tolerant_union(spark, paths, "id long", 3).count() == 15
    with pytest.raises(publish.Refused):
        publish.tolerant_union(spark, paths, "id long", 4)
    with pytest.raises(publish.Refused):
        publish.tolerant_union(spark, [str(tmp_path / "none")], "id long")
