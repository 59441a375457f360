"""Streams run to their end, against the batch answer and with late rows."""

from pyspark.sql import functions as F

from isobar.streaming import feeds as K


def files(spark, tmp_path, parts, schema):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        yield i


def drain(spark, tmp_path, make, schema, parts):
    """One run for each part, so that watermarks move in between."""
    typed = schema.replace("ts string", "ts timestamp")
    for _ in files(spark, tmp_path, parts, schema):
        stream = make(spark.readStream.schema(typed).parquet(str(tmp_path / "in")))
        writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
        writer.format("parquet").option("path", str(tmp_path / "out")).start().awaitTermination()
    return spark.read.parquet(str(tmp_path / "out")).collect()


def test_late_rows_are_dropped_and_others_count(spark, tmp_path):
    schema = "station_id long, param string, ts string, aqi int"
    parts = [
        [(1, "p", "2024-01-01 00:10:00", 5), (1, "p", "2024-01-01 01:10:00", 7)],
        [(1, "p", "2024-01-01 00:50:00", 9), (1, "p", "2024-01-01 06:00:00", 1)],
        [(1, "p", "2024-01-01 00:55:00", 99), (1, "p", "2024-01-01 12:00:00", 1)],
    ]
    got = {r["hour"].hour: r["aqi"] for r in drain(spark, tmp_path, K.hourly_max, schema, parts)}
    assert got[0] == 9 and got[1] == 7


def test_first_flash_of_a_cell_wins(spark, tmp_path):
    schema = "id long, ts string, lat double, lon double"
    parts = [[(1, "2024-01-01 00:00:01", 1.0, 2.0)], [(2, "2024-01-01 00:00:05", 1.001, 2.001), (3, "2024-01-01 00:00:05", 5.0, 2.0)]]
    assert sorted(r["id"] for r in drain(spark, tmp_path, K.rolling_flashes, schema, parts)) == [1, 3]


def test_newest_wins_per_key(spark, tmp_path):
    rows = [("a", 1, 1.0), ("a", 3, 3.0), ("b", 2, 2.0)]
    frame = spark.createDataFrame(rows, "key string, epoch long, value double").select("key", F.timestamp_seconds("epoch").alias("ts"), "value")
    frame.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = K.newest_wins(spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in")))
    writer = stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    writer.foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).start().awaitTermination()
    assert sorted(seen) == [("a", 3, 3.0), ("b", 2, 2.0)]
