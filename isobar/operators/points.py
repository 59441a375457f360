"""Operators on point feeds: readings, flashes, incidents, hotspots, observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions import scalar as S


def hourly_max(readings: DataFrame) -> DataFrame:
    """A1."""
    return readings.groupBy("station_id", "param", F.date_trunc("hour", "hour").alias("hour")).agg(F.max("aqi").alias("aqi"))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A2: each key's newest row; ties go to the last in ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return newest.select(*keys, *(f"r.{c}" for c in rest))


def strongest(rows: DataFrame, keys: list[Column], strength: str, tie: str) -> DataFrame:
    """A5: each key's whole row of greatest strength, ties to the smallest tie-break."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    best = rows.groupBy(*named).agg(F.max_by(F.struct(*rows.columns), F.struct(F.col(strength), -F.col(tie))).alias("r"))
    return best.select("r.*")


def worst_of(hourly: DataFrame) -> DataFrame:
    """A3: over all parameters of a station and hour."""
    return hourly.groupBy("station_id", "hour").agg(F.max("aqi").alias("aqi"))


def carried_forward(hourly: DataFrame, keys: list[str], slots: int = 3) -> DataFrame:
    """W1 over C2: each reading's hour and those after it up to the key's next reading, ``slots`` at most, with its value.

    ``hourly`` has one row for each key and hour.  Hours without a value are not
    laid out, so the rows follow the readings and not the time that they span.
    """
    rows = hourly.where(" and ".join(f"{c} is not null" for c in [*keys, "hour", "aqi"]))
    following = F.lead("hour").over(Window.partitionBy(*keys).orderBy("hour"))
    last = F.least(following - F.expr("interval 1 hour"), F.col("hour") + F.expr(f"interval {slots} hours"))
    rows = rows.withColumn("last", F.greatest(last, "hour"))
    return rows.select(*keys, F.explode(F.expr("sequence(hour, last, interval 1 hour)")).alias("hour"), "aqi")


def grid_dedup(flashes: DataFrame, now: int, recent_minutes: int = 30, fine: tuple[float, int] = (0.01, 30), coarse: tuple[float, int] = (0.08, 120)) -> DataFrame:
    """A4: one flash, the newest, of each cell and time bin; coarser cells for older ones."""
    recent = F.col("epoch") >= now - 60 * recent_minutes
    size = F.when(recent, fine[0]).otherwise(coarse[0])
    bin_s = F.when(recent, fine[1]).otherwise(coarse[1])
    cell = [recent, F.rint(F.col("lat") / size).cast("long"), F.rint(F.col("lon") / size).cast("long"), F.floor(F.col("epoch") / bin_s)]
    return strongest(flashes, cell, "epoch", "event_id")


def split_satellites(flashes: DataFrame, meridian: float = -106.0) -> DataFrame:
    """With both satellites live each keeps its side; a single one keeps all."""
    live = flashes.agg(F.count_distinct("sat").alias("live"))  # one row
    east = F.col("lon") >= meridian
    own = F.when(F.col("sat") == "E", east).otherwise(~east)
    return flashes.crossJoin(F.broadcast(live)).where((F.col("live") < 2) | own).drop("live")


def top_k(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """T1, T2."""
    return rows.orderBy(*order).limit(k)


def capped_per_group(rows: DataFrame, group: list[str], k: int, *order: Column) -> DataFrame:
    """T3."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def nearest_incident(spots: DataFrame, incidents: DataFrame, cell: float = 0.5) -> DataFrame:
    """The nearest incident within its own radius (1.2 times the root of its area, 3 to 60 km), ties to the first.

    Both differences of degrees, at 111 km each and by the spot's latitude, must
    be within the radius too.  Unknown and negative areas are none.

    Incidents are laid out over the cells that their radius can reach, so the
    join is on cells and the distance is checked on what they share.  Of those at
    one place only some can win: an incident counts if its radius is greater than
    that of each with a smaller id there.
    """
    radius = S.clip(1.2 * F.sqrt(F.greatest(F.coalesce("acres", F.lit(0.0)), F.lit(0.0)) * 0.00404686), 3.0, 60.0)
    fires = incidents.select("fire_id", F.col("lat").alias("f_lat"), F.col("lon").alias("f_lon"), radius.alias("r"))
    ahead = F.max("r").over(Window.partitionBy("f_lat", "f_lon").orderBy("fire_id").rowsBetween(Window.unboundedPreceding, -1))
    fires = fires.withColumn("ahead", ahead).where("ahead is null or r > ahead").drop("ahead")
    d_lat = F.col("r") / 111.0
    d_lon = F.col("r") / (111.0 * F.greatest(F.cos(F.radians(F.abs(F.col("f_lat")) + d_lat)), F.lit(0.05)))
    span = lambda x, d: F.sequence(F.floor((x - d) / cell), F.floor((x + d) / cell))
    fires = fires.withColumn("cy", F.explode(span(F.col("f_lat"), d_lat))).withColumn("cx", F.explode(span(F.col("f_lon"), d_lon)))
    rows = spots.withColumn("cy", F.floor(F.col("lat") / cell)).withColumn("cx", F.floor(F.col("lon") / cell))
    rows = rows.join(fires, ["cy", "cx"])
    near = (F.abs(F.col("lat") - F.col("f_lat")) * 111.0 <= F.col("r")) & (F.abs(F.col("lon") - F.col("f_lon")) * F.cos(F.radians("lat")) * 111.0 <= F.col("r"))
    rows = rows.where(near)
    rows = rows.withColumn("km", S.haversine_km(F.col("lat"), F.col("lon"), F.col("f_lat"), F.col("f_lon"))).where("km <= r")
    best = rows.groupBy("spot_id").agg(F.min_by(F.struct("fire_id", "km"), F.struct("km", "fire_id")).alias("b"))
    return best.select("spot_id", "b.fire_id", "b.km")


def activity(spots: DataFrame, pairs: DataFrame, now: int) -> DataFrame:
    """Of each incident: spots, recent ones (6 h), peak power, least age, satellites."""
    age = S.age_minutes(F.col("epoch"), now)
    rows = pairs.join(spots, "spot_id").withColumn("age", age)
    return rows.groupBy("fire_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("age") <= 360).alias("n6"), F.max("frp").alias("peak"), F.min("age").alias("least_age"), F.count_distinct("sat_code").alias("sats")
    )


def with_activity(incidents: DataFrame, summary: DataFrame, feed_ok: bool = True) -> DataFrame:
    """Zeros where nothing matched; nothing at all where the hotspot feed failed."""
    rows = incidents.join(summary, "fire_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)) if feed_ok else F.lit(None).cast("long")
    return rows.withColumn("n", zero(F.col("n"))).withColumn("n6", zero(F.col("n6"))).withColumn("sats", zero(F.col("sats")))


def without_stations(obs: DataFrame, metars: DataFrame) -> DataFrame:
    """Drops a station that reports as METAR under its id, or under K and a 3-letter id."""
    keys = metars.select(F.col("id").alias("key"))
    keys = keys.union(metars.where(F.length("id") == 4).where(F.col("id").startswith("K")).select(F.substring("id", 2, 3)))
    return obs.join(keys.distinct(), obs["id"] == F.col("key"), "left_anti")


def allowed(obs: DataFrame, providers: DataFrame, category: int) -> DataFrame:
    """Rows of providers that the list has at this restriction or below."""
    return obs.join(providers.where(F.col("category") <= category), "provider_key", "left_semi")


def provider_outcomes(obs: DataFrame, providers: DataFrame, category: int) -> DataFrame:
    """How many rows of each provider are allowed, restricted or of an unknown provider."""
    rows = obs.groupBy("provider_key").agg(F.count(F.lit(1)).alias("n")).join(providers.select("provider_key", "category"), "provider_key", "left")
    outcome = F.when(F.col("category").isNull(), "unknown").when(F.col("category") > category, "restricted").otherwise("allowed")
    return rows.select(outcome.alias("outcome"), "provider_key", "n")


#: fixed values: quality flags that pass the second stage
PASSED = ("S", "V", "K", "G")


def quality_controlled(obs: DataFrame) -> DataFrame:
    """What has a bad flag, is impossible or contradicts another value becomes null; a temperature is required.

    ``obs`` has ``t_k, td_k, rh, wd, ws, wg, pr``, each with a ``_flag``, and
    ``elev``, ``type`` and the codes ``pst1, pst3`` of what ``pr`` is of.  A dew
    point may exceed the temperature by half a degree.  A gust below the wind
    goes; one without a wind stays.  An amount without a known period goes.
    """
    good = lambda name, lo, hi, ends: S.ranged(S.masked(F.col(name), F.col(f"{name}_flag")), lo, hi, ends)
    rows = obs.withColumn("t_k", good("t_k", 200.0, 340.0, "()")).where("t_k is not null")
    rows = rows.where((F.col("type") != "c") | F.coalesce(F.col("t_k_flag").isin(*PASSED), F.lit(False)))
    td, ws, wg = good("td_k", 180.0, 320.0, "()"), good("ws", 0.0, 100.0, "[)"), good("wg", 0.0, 120.0, "[)")
    period = S.accumulation_period(F.col("pst1"), F.col("pst3"))
    pr = F.when(period.isNotNull(), F.bround(good("pr", 0.0, 2000.0, "[)"), 1))
    return rows.withColumns({
        "td_k": F.when(td <= F.col("t_k") + 0.5, td),
        "rh": S.clip(good("rh", 0.0, 105.0, "[]"), 0.0, 100.0),
        "wd": F.rint(good("wd", 0.0, 360.0, "[]")).cast("int") % 360,
        "ws": ws,
        "wg": F.when(~F.coalesce(wg < ws, F.lit(False)), wg),
        "pr": pr,
        "period": F.when(pr.isNotNull(), period),
        "elev": F.when(F.abs("elev") <= 9000, F.rint("elev").cast("int")),
    })


CELLS = (4.0, 2.0, 1.0, 0.5, 0.25)


def declutter_rank(stations: DataFrame, cells: tuple[float, ...] = CELLS, only_first: int = 2) -> DataFrame:
    """At each cell size the first station without a rank, by priority and id, claims the cell; the rest rank last.

    Cells count from the south pole and the date line.  The first ``only_first`` sizes are for stations of priority 0 alone.  The
    eligible are a partition of their own, so that others can't hold rank one.
    """
    rows = stations.withColumn("rank", F.lit(None).cast("int"))
    for level, size in enumerate(cells):
        eligible = F.col("rank").isNull() & ((F.col("prio") == 0) | F.lit(level >= only_first))
        rows = rows.withColumn("_e", eligible)
        place = Window.partitionBy(F.floor((F.col("lat") + 90) / size), F.floor((F.col("lon") + 180) / size), "_e").orderBy("prio", "id")
        first = F.col("_e") & (F.row_number().over(place) == 1)
        rows = rows.withColumn("rank", F.when(first, level).otherwise(F.col("rank"))).drop("_e")
    return rows.withColumn("rank", F.coalesce("rank", F.lit(len(cells))))
