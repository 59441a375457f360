"""The feeds as Structured Streaming queries.  State is bounded by watermarks or by expiry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_max(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """K2: tumbling hourly maximum of ``station_id, param, ts, aqi``; K4: rows later than the watermark are dropped."""
    hour = F.window("ts", "1 hour")
    rows = stream.withWatermark("ts", late).groupBy(hour, "station_id", "param").agg(F.max("aqi").alias("aqi"))
    return rows.select("station_id", "param", F.col("window.start").alias("hour"), "aqi")


def rolling_flashes(stream: DataFrame, late: str = "2 minutes", cell: float = 0.01, seconds: int = 30) -> DataFrame:
    """K1: the first flash of each cell and time bin; duplicates within the watermark are dropped."""
    rows = stream.withColumn("cy", F.rint(F.col("lat") / cell).cast("long")).withColumn("cx", F.rint(F.col("lon") / cell).cast("long"))
    rows = rows.withColumn("tb", F.floor(F.unix_timestamp("ts") / seconds))
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(["cy", "cx", "tb"])


def companions(left: DataFrame, right: DataFrame, before: int = 360, after: int = 90, late: str = "10 minutes") -> DataFrame:
    """K6: pairs of ``key, t, id`` and ``key, ct, obj`` within the span; both sides are dropped from state once it has passed.

    Time is cut into bins as long as the span, and a row of the left meets the
    bins that its span touches: a row is compared with those of its key and bin,
    not with all of its key that are in the state.
    """
    width = before + after
    bin_of = lambda seconds: F.floor(seconds / width)
    at = F.unix_timestamp("t")
    a = left.withWatermark("t", late).withColumn("bin", F.explode(F.sequence(bin_of(at - before), bin_of(at + after + 1))))  # stamps have parts of seconds
    b = right.withColumnRenamed("key", "ckey").withWatermark("ct", late).withColumn("cbin", bin_of(F.unix_timestamp("ct")))
    span = (F.col("ct") >= F.col("t") - F.expr(f"interval {before} seconds")) & (F.col("ct") <= F.col("t") + F.expr(f"interval {after} seconds"))
    return a.join(b, (F.col("key") == F.col("ckey")) & (F.col("bin") == F.col("cbin")) & span).drop("ckey", "bin", "cbin")


def ingested(granules: DataFrame, schema: str) -> DataFrame:
    """K5: the rows of JSON granules (``line``); the file source's checkpoint sees to it that each file is parsed once."""
    return granules.select(F.from_json("line", schema).alias("g")).where("g is not null").select("g.*")


def newest_wins(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """K3 over ``key, ts, value``: each key's newest value of each hour, output whenever it changes; hours are forgotten once the watermark has passed them."""
    rows = stream.withWatermark("ts", late).withColumn("epoch", F.unix_timestamp("ts"))
    newest = rows.groupBy("key", F.window("ts", "1 hour")).agg(F.max(F.struct("epoch", "value")).alias("b"))
    return newest.select("key", "b.epoch", "b.value")


def carried_forward(stream: DataFrame, late: str = "2 hours", slots: int = 3) -> DataFrame:
    """K3 over ``station_id, param, ts, aqi``: the hourly maxima, held for so many hours, as ``W1`` gives them.

    A reading counts in its hour and in the ``slots`` after it, and each hour takes
    the value of the newest hour that reaches it, once the watermark has passed its
    end.  So the state is that of an hourly aggregate, without a task's own code.
    A late reading counts in those of its hours that are still open.
    """
    held = stream.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(slots))))
    held = held.withColumn("at", F.col("ts") + F.make_dt_interval(hours=F.col("k")))
    held = held.withWatermark("at", f"{late} {slots} hours")  # as the newest reading's hours reach so much further
    # rows without a value move the watermark, so they are not filtered before
    value = F.when(F.col("station_id").isNotNull() & F.col("param").isNotNull() & F.col("aqi").isNotNull(), F.struct((-F.col("k")).alias("newer"), F.col("aqi").cast("int").alias("aqi")))
    hours = held.groupBy("station_id", "param", F.window("at", "1 hour")).agg(F.max(value).alias("b")).where("b is not null")
    return hours.select("station_id", "param", F.col("window.start").alias("hour"), "b.aqi")
