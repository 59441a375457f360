"""Profiles and volumes: levels, columns, sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: fixed values: 33 native heights in metres
NATIVE_M = [*range(500, 3001, 250), *range(3500, 9001, 500), *range(10000, 19001, 1000)]
STEP_M, LEVELS = 500, 38


def bracketing(heights: DataFrame, targets: DataFrame) -> DataFrame:
    """``heights`` (lvl, height_m), ``targets`` (k, height_m) to ``k, lower, upper, t``.

    The lowest level holds below it; a target above the highest one has no row.
    Both are small dims.
    """
    order = Window.orderBy("height_m")
    spans = heights.select(F.col("lvl").alias("lower"), F.col("height_m").alias("h0"), F.lead("lvl").over(order).alias("upper"), F.lead("height_m").over(order).alias("h1"), (F.row_number().over(order) == 1).alias("bottom"))
    rows = targets.join(F.broadcast(spans), (F.col("bottom") | (F.col("height_m") >= F.col("h0"))) & (F.coalesce("h1", F.col("h0") + 1e-9) > F.col("height_m")))
    exact = (F.col("height_m") <= F.col("h0")) | F.col("h1").isNull()
    return rows.select("k", "lower", F.when(exact, F.col("lower")).otherwise(F.col("upper")).alias("upper"), F.when(exact, 0.0).otherwise((F.col("height_m") - F.col("h0")) / (F.col("h1") - F.col("h0"))).alias("t"))


def blended(a: Column, b: Column, t: Column, none: float, fade: float) -> Column:
    """Between two levels' codes; a missing one is replaced by ``fade``.

    What comes out as the fade code itself is none, as is what has neither; at a
    level itself its own code holds.
    """
    x, y = F.when(a == none, fade).otherwise(a), F.when(b == none, fade).otherwise(b)
    v = F.greatest(F.lit(0.0), F.least(F.rint(x + t * (y - x)), F.lit(255.0)))
    faded = (a == none) & (b == none) | (v == fade) & F.lit(fade != none)
    return F.when(t <= 0, a).when(t >= 1, b).when(faded, F.lit(none)).otherwise(v)


def interpolated(columns: DataFrame, plan: DataFrame, none: float = 0.0, fade: float = 2.0) -> DataFrame:
    """``columns`` (col_id, lvl, v) at the plan's levels."""
    side = lambda x, v: columns.join(F.broadcast(plan), F.col("lvl") == F.col(x)).select("col_id", "k", "t", F.col("v").alias(v))
    rows = side("lower", "a").join(side("upper", "b"), ["col_id", "k", "t"], "full")  # a column may lack either level
    v = blended(F.coalesce("a", F.lit(none)), F.coalesce("b", F.lit(none)), F.col("t"), none, fade)
    return rows.select("col_id", "k", v.alias("v"))


def debris_columns(levels: DataFrame, ref: int, cc: int, shear: DataFrame | None) -> DataFrame:
    """Columns grounded at level 0 (ref and cc at least), and within the dilated shear where there is a shear product."""
    ground = levels.where((F.col("lvl") == 0) & (F.col("ref") >= ref) & (F.col("cc") > cc)).select("r", "c").distinct()
    return ground if shear is None else ground.join(shear, ["r", "c"], "left_semi")


def extruded(layer: DataFrame, centres: DataFrame, lo: float, hi: float) -> DataFrame:
    """A layer's value at the levels with their centre in the range; ``centres`` is a small dim."""
    return layer.join(F.broadcast(centres.where((F.col("centre_m") >= lo) & (F.col("centre_m") < hi))))


def complete_stamps(listed: DataFrame, n_levels: int, failed: DataFrame | None = None) -> DataFrame:
    """A10: stamps that every level has; none at all where the listing of a level has failed (``failed``: level_name)."""
    rows = listed.groupBy("stamp").agg(F.count_distinct("level_name").alias("n")).where(F.col("n") == n_levels).select("stamp")
    return rows if failed is None else rows.join(F.broadcast(failed.limit(1)), F.lit(True), "left_anti")  # one row


def newest_stamp(listed: DataFrame, n_levels: int, failed: DataFrame | None = None) -> DataFrame:
    """A10: the newest stamp that every level has, or no row."""
    return complete_stamps(listed, n_levels, failed).agg(F.max("stamp").alias("stamp")).where("stamp is not null")


def _celsius(c: Column) -> Column:
    return F.when(c > 100, c - 273.15).otherwise(c)


def _levels(get, levels: tuple[int, ...]) -> list[Column]:
    """A level for each pressure: ``p, h, t, td, u, v``; the dew point is no higher than the temperature, and wind that isn't there is none."""
    wind = lambda k: F.coalesce(get(k), F.lit(0.0)).alias(k[0].lower())
    t = lambda mb: _celsius(get(f"TMP:{mb}"))
    td = lambda mb: F.when(get(f"DPT:{mb}").isNotNull(), F.least(_celsius(get(f"DPT:{mb}")), t(mb)))
    return [F.struct(F.lit(float(mb)).alias("p"), get(f"HGT:{mb}").alias("h"), t(mb).alias("t"), td(mb).alias("td"), wind(f"UGRD:{mb}"), wind(f"VGRD:{mb}")) for mb in levels]


def _keyed(fields: DataFrame, by: list[str]) -> DataFrame:
    """``fields`` (by, key, v) to a row for each of ``by`` with its values as a map; a row has as many keys as a profile has."""
    rows = fields.where("v is not null").groupBy(*by, "key").agg(F.max("v").cast("double").alias("v"))
    return rows.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias("m"))


def profiles(fields: DataFrame, levels: tuple[int, ...], least: int = 4) -> DataFrame:
    """``fields`` (site, fh, key, v; keys as ``inventory_key`` gives them) to soundings from the surface up.

    The surface comes first where its pressure, height, temperature and dew point
    are there.  Levels below the ground, and those without a temperature, dew
    point or height, are left out; with fewer than ``least`` there is no sounding.
    """
    rows = _keyed(fields, ["site", "fh"])
    get = lambda k: F.try_element_at("m", F.lit(k))
    ground, height = get("PRES:sfc"), get("HGT:sfc")
    t2, td2 = _celsius(get("TMP:2m")), _celsius(get("DPT:2m"))
    wind = lambda k: F.coalesce(get(f"{k}:10m"), F.lit(0.0)).alias(k[0].lower())
    surface = F.struct((ground / 100).alias("p"), height.alias("h"), t2.alias("t"), F.least(td2, t2).alias("td"), wind("UGRD"), wind("VGRD"))
    there = ground.isNotNull() & height.isNotNull() & t2.isNotNull() & td2.isNotNull()
    above = F.filter(F.array(*_levels(get, levels)), lambda x: (ground.isNull() | (x["p"] * 100 <= ground)) & x["t"].isNotNull() & x["td"].isNotNull() & x["h"].isNotNull())
    ordered = F.array_sort(F.transform(F.concat(F.when(there, F.array(surface)).otherwise(F.slice(above, 1, 0)), above), lambda x, i: F.struct((-x["p"]).alias("o"), i.alias("i"), x.alias("l"))))
    rows = rows.select("site", "fh", height.alias("h0"), F.transform(ordered, lambda x: x["l"]).alias("l")).where(F.size("l") >= least)
    part = lambda f, digits: F.transform("l", lambda x: F.bround(x[f], digits))
    elevation = F.bround(F.coalesce("h0", F.get("l", F.lit(0))["h"]), 1).alias("elev_m")
    return rows.select("site", "fh", elevation, part("p", 1).alias("pres_hpa"), part("h", 1).alias("hgt_msl_m"), part("t", 2).alias("temp_c"), part("td", 2).alias("dewpoint_c"), part("u", 2).alias("u_ms"), part("v", 2).alias("v_ms"))


SURFACE_KEYS = ("PRES:sfc", "HGT:sfc", "TMP:2m", "DPT:2m", "UGRD:10m", "VGRD:10m")


def profile_tiles(fields: DataFrame, levels: tuple[int, ...], size: int = 16, pad: float = 0.75) -> DataFrame:
    """``fields`` (r, c, fh, key, v) to a document for each tile of columns, with their hours nested in it.

    An hour counts if every field of the surface and of all levels is there
    (A11).  Its values are arrays over the tile's columns in order; storm fields
    are null where the source lacks them: the strongest reflectivity (of the
    hour, else of the column) and the hour's rain, the gain of the run's total
    over the hour before, or over none in the first hour.  A tile's box is padded.
    """
    needed = [*SURFACE_KEYS, *(f"{k}:{mb}" for k in ("TMP", "DPT", "HGT", "UGRD", "VGRD") for mb in levels)]
    listed = fields.where(F.col("key").isin(*needed) & F.col("v").isNotNull()).select("fh", "key").distinct()
    hours = listed.groupBy("fh").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(needed)).select("fh")
    columns = _keyed(fields, ["r", "c", "fh"])
    get = lambda k: F.try_element_at("m", F.lit(k))
    order = Window.partitionBy("r", "c").orderBy("fh")
    total = get("APCP:total")
    before = F.coalesce(F.when(F.lag("fh").over(order) == F.col("fh") - 1, F.lag(total).over(order)), F.when(F.col("fh") == 1, 0.0))
    rain = F.when(F.col("fh") > 0, F.when(total.isNotNull() & before.isNotNull(), F.greatest(total - before, F.lit(0.0))))
    rows = columns.withColumn("rain", rain).join(F.broadcast(hours), "fh")  # a run's hours
    t2 = _celsius(get("TMP:2m"))
    td2 = F.when(get("DPT:2m").isNotNull(), F.least(_celsius(get("DPT:2m")), t2))
    own = {"sfc_pres_hpa": (get("PRES:sfc") / 100, 1), "sfc_temp_c": (t2, 1), "sfc_dewpoint_c": (td2, 1), "sfc_u_ms": (get("UGRD:10m"), 1), "sfc_v_ms": (get("VGRD:10m"), 1), "refl_dbz": (F.coalesce(get("MAXREF:1km"), get("REFC:col")), 0), "qpf_mm": (F.col("rain"), 1)}
    stacked = {"temp_c": ("t", 1), "dewpoint_c": ("td", 1), "hgt_msl_m": ("h", 0), "u_ms": ("u", 1), "v_ms": ("v", 1)}
    stack = F.array(*_levels(get, levels))
    values = F.struct("r", "c", get("HGT:sfc").alias("elev"), *(F.bround(v, d).alias(k) for k, (v, d) in own.items()), stack.alias("l"))
    rows = rows.select(F.floor(F.col("r") / size).alias("tr"), F.floor(F.col("c") / size).alias("tc"), "fh", values.alias("x"))
    cells = rows.groupBy("tr", "tc", "fh").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # size x size columns at most

    def by_level(f: str, digits: int) -> Column:
        return F.transform("xs", lambda x: F.transform(x["l"], lambda y: F.bround(y[f], digits)))

    hour = F.struct("fh", *(F.col(f"xs.{k}").alias(k) for k in own), *(by_level(f, d).alias(k) for k, (f, d) in stacked.items()))
    place = F.transform("xs", lambda x: F.struct(x["r"].alias("r"), x["c"].alias("c"), F.bround(x["elev"], 1).alias("elev_m")))
    tiles = cells.select("tr", "tc", hour.alias("hour"), place.alias("columns"), "fh")
    tiles = tiles.groupBy("tr", "tc").agg(F.min_by("columns", "fh").alias("columns"), F.array_sort(F.collect_list("hour")).alias("hours"))  # a run's hours
    edge = lambda f, k, d: (f(F.transform("columns", lambda x: x[k])) + d).alias
    return tiles.select("tr", "tc", edge(F.array_min, "r", -pad)("r0"), edge(F.array_max, "r", pad)("r1"), edge(F.array_min, "c", -pad)("c0"), edge(F.array_max, "c", pad)("c1"), F.array(*(F.lit(float(mb)) for mb in levels)).alias("pres_hpa"), "columns", "hours")


def assembled(levels: DataFrame, least: int = 4) -> DataFrame:
    """A site's levels above ground from the surface up as arrays, dewpoint not above temperature; levels without either go, and fewer than ``least`` are none."""
    rows = levels.where("pressure <= surface and t is not null and td is not null").withColumn("td", F.least("td", "t"))
    parts = F.array_sort(F.collect_list(F.struct((-F.col("pressure")).alias("o"), "pressure", "t", "td")))
    out = rows.groupBy("site").agg(parts.alias("p")).where(F.size("p") >= least)
    return out.select("site", F.col("p.pressure").alias("pressure"), F.col("p.t").alias("t"), F.col("p.td").alias("td"))


def hourly_amounts(totals: DataFrame) -> DataFrame:
    """The gain over the hour before, which must be there; a first hour without one before starts at 0; never negative."""
    order = Window.partitionBy("site").orderBy("fh")
    adjacent = F.lag("fh").over(order) == F.col("fh") - 1
    gain = F.when(adjacent, F.col("total") - F.lag("total").over(order)).when(F.col("fh") == 1, F.col("total"))
    rows = totals.withColumn("gain", gain).where("gain is not null")
    return rows.withColumn("amount", F.greatest("gain", F.lit(0.0))).drop("gain")


def sampled(sites: DataFrame, cells: DataFrame, lat0: float, lon0: float, step: float, rows: int, columns: int, step_lon: float | None = None) -> DataFrame:
    """Each site's cell value; null off the grid."""
    at = sites.withColumn("r", F.floor((F.lit(lat0) - F.col("lat")) / step)).withColumn("c", F.floor((F.col("lon") - lon0) / (step_lon or step)))
    inside = F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1)
    at = at.withColumn("r", F.when(inside, F.col("r"))).withColumn("c", F.when(inside, F.col("c")))
    return at.join(cells.select("r", "c", "v"), ["r", "c"], "left")


def merged(*sources: DataFrame) -> DataFrame:
    """By key, later sources overwrite; ``key, v``."""
    rows = None
    for i, s in enumerate(sources):
        s = s.select("key", "v", F.lit(i).alias("i"))
        rows = s if rows is None else rows.unionByName(s)
    return rows.groupBy("key").agg(F.max_by("v", "i").alias("v"))


def packed(columns: DataFrame, size: int = 16, pad: float = 0.75) -> DataFrame:
    """Columns by tile, in order, with the tile's padded box."""
    rows = columns.withColumn("tr", F.floor(F.col("r") / size)).withColumn("tc", F.floor(F.col("c") / size))
    parts = F.array_sort(F.collect_list(F.struct("r", "c", "v")))  # size x size columns at most
    return rows.groupBy("tr", "tc").agg((F.min("r") - pad).alias("r0"), (F.max("r") + pad).alias("r1"), (F.min("c") - pad).alias("c0"), (F.max("c") + pad).alias("c1"), parts.alias("columns"))


def tile_of(points: DataFrame, boxes: DataFrame, size: int = 16) -> DataFrame:
    """The tiles whose padded box holds a point; candidates are the point's tile and its neighbours, so the join is on tiles."""
    near = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    rows = points.withColumn("dr", near).withColumn("dc", near)
    rows = rows.withColumn("tr", F.floor(F.col("pr") / size) + F.col("dr")).withColumn("tc", F.floor(F.col("pc") / size) + F.col("dc"))
    rows = rows.join(boxes, ["tr", "tc"])
    return rows.where(F.col("pr").between(F.col("r0"), F.col("r1")) & F.col("pc").between(F.col("c0"), F.col("c1"))).select("id", "tr", "tc")


def complete_hours(listed: DataFrame, needed: DataFrame) -> DataFrame:
    """Hours of ``listed`` (fh, var, level) with every pair of ``needed`` (var, level), a small dim."""
    met = listed.select("fh", "var", "level").distinct().join(F.broadcast(needed.distinct()), ["var", "level"])
    n = needed.distinct().agg(F.count(F.lit(1)).alias("needed"))
    return met.groupBy("fh").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(n), F.col("n") == F.col("needed")).select("fh")


def wind_profiles(levels: DataFrame, least: int = 4) -> DataFrame:
    """A12, wind only: levels with height and wind, from the surface up; temperature and dewpoint only where every level has them."""
    rows = levels.where("h is not null and u is not null and v is not null")
    parts = F.array_sort(F.collect_list(F.struct((-F.col("pressure")).alias("o"), "pressure", "u", "v", "t", "td")))  # a site's levels
    out = rows.groupBy("site").agg(parts.alias("p")).where(F.size("p") >= least)
    whole = lambda c: F.when(F.forall("p", lambda x: x[c].isNotNull()), F.col(f"p.{c}"))
    return out.select("site", F.col("p.pressure").alias("pressure"), F.col("p.u").alias("u"), F.col("p.v").alias("v"), whole("t").alias("t"), whole("td").alias("td"))
