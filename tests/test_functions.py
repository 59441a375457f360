"""Column functions against published vectors and plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from isobar.functions import scalar as S


def values(spark, column, rows, schema="x double"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_byte_codes(spark):
    dbz = [(None,), (-999.0,), (-99.0,), (-32.0,), (-31.5,), (0.0,), (30.0,), (94.5,), (120.0,)]
    assert values(spark, S.byte_dbz(F.col("x")), dbz) == [0, 0, 0, 0, 3, 66, 126, 255, 255]
    cc = [(None,), (1.05,), (1.0,), (0.8,), (0.5,), (0.2,)]
    assert values(spark, S.byte_correlation(F.col("x")), cc) == [0, 0, 10, 50, 110, 170]
    rotation = [(None,), (0.0,), (0.006,), (-0.006,), (0.01,), (0.03,), (-0.03,)]
    assert values(spark, S.byte_rotation(F.col("x")), rotation) == [128, 128, 158, 98, 178, 255, 0]


def test_categories(spark):
    assert values(spark, S.aqi_category(F.col("x")), [(0.0,), (50.0,), (51.0,), (300.0,), (301.0,), (None,)]) == [1, 1, 2, 5, 6, None]
    rows = [(" Unhealthy for Sensitive Groups", 10), ("usg", 10), ("?", 160), (None, 10)]
    assert values(spark, S.named_category(F.col("n"), F.col("v")), rows, "n string, v int") == [3, 3, 4, 1]


def test_confidence(spark):
    rows = [(c,) for c in ("low", "L", "49", "50", "79", "80", "high", "H", "nominal", None)]
    assert values(spark, S.confidence(F.col("c")), rows, "c string") == [None, None, None, False, False, True, True, True, False, False]


def test_distance_and_humidity(spark):
    assert values(spark, S.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.col("x")), [(90.0,)])[0] == pytest.approx(6371 * math.pi / 2)
    assert values(spark, S.dewpoint_c(F.col("x"), F.lit(100.0)), [(20.0,)])[0] == pytest.approx(20.0)
    assert values(spark, S.dewpoint_c(F.col("x"), F.lit(0.0)), [(20.0,)]) == values(spark, S.dewpoint_c(F.col("x"), F.lit(1.0)), [(20.0,)])


def test_parallax_moves_towards_the_satellite(spark):
    lat, lon = S.parallax(F.lit(40.0), F.col("x"), -75.0)
    row = spark.createDataFrame([(-100.0,)], "x double").select(lat.alias("a"), lon.alias("o")).first()
    assert 39.8 < row["a"] < 40.0 and -100.0 < row["o"] < -99.8


def test_rotation_keeps_speed(spark):
    u, v = S.rotated(F.col("x"), F.lit(4.0), F.lit(1.1))
    row = spark.createDataFrame([(3.0,)], "x double").select(S.magnitude(u, v)).first()
    assert row[0] == pytest.approx(5.0)
