"""Parsers of the feeds' text forms: a column of text to typed rows, bad rows dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.scalar import named_category

READING = "Latitude string, Longitude string, AQI string, Value string, Parameter string, SiteName string, UTC string"


def readings(lines: DataFrame) -> DataFrame:
    """``value`` holds JSON objects; AQI falls back to Value; no place, parameter or value, or a negative one, drops the row."""
    r = lines.select(F.from_json("value", READING).alias("r")).select("r.*")
    aqi = F.coalesce(F.col("AQI").try_cast("double"), F.col("Value").try_cast("double"))
    hour = F.try_to_timestamp(F.replace("UTC", F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm"))
    rows = r.select(F.col("SiteName").alias("site"), F.col("Parameter").alias("param"), F.col("Latitude").try_cast("double").alias("lat"), F.col("Longitude").try_cast("double").alias("lon"), aqi.cast("int").alias("aqi"), hour.alias("hour"))
    return rows.where("lat is not null and lon is not null and aqi >= 0 and param is not null and hour is not null")


def area_forecasts(lines: DataFrame) -> DataFrame:
    """Pipe fields; type F, sequence 0 to 2; an empty AQI is fine where the category is known."""
    f = F.split("line", r"\|", -1)
    at = lambda i: F.trim(F.try_element_at(f, F.lit(i + 1)))
    rows = lines.where(F.size(f) >= 15).select(
        at(0).alias("issue"), F.try_to_timestamp(at(1), F.lit("MM/dd/yy")).cast("date").alias("valid"), at(4).try_cast("int").alias("seq"), at(5).alias("kind"), at(7).alias("area"),
        at(9).try_cast("double").alias("lat"), at(10).try_cast("double").alias("lon"), at(11).alias("param"), at(12).try_cast("int").alias("aqi"), at(13).alias("category"), (F.lower(at(14)) == "yes").alias("action"),
    )
    rows = rows.withColumn("category", named_category(F.col("category"), F.col("aqi")))
    return rows.where("kind = 'F' and seq between 0 and 2 and valid is not null and category is not null")


def listing(lines: DataFrame) -> DataFrame:
    """``size;path``."""
    f = F.split("line", ";", 2)
    rows = lines.select(F.try_element_at(f, F.lit(1)).try_cast("long").alias("size"), F.try_element_at(f, F.lit(2)).alias("path"))
    return rows.where("size is not null and path is not null and path <> ''")


def _run_objects(paths: DataFrame, products: DataFrame) -> DataFrame:
    """Objects ``product, run, leaf`` of ``product/run/leaf`` paths, of runs with a stamp and of the catalog's products (``code``) only."""
    f = F.split(F.trim("path"), "/")
    rows = paths.where(F.size(f) == 3).select(f[0].alias("product"), f[1].alias("run"), f[2].alias("leaf"))
    rows = rows.where(F.col("run").rlike(r"^\d{10}(\d{2})?$"))
    return rows.join(F.broadcast(products.select(F.col("code").alias("product"))), "product", "left_semi")  # the catalog


def frame_keys(paths: DataFrame, products: DataFrame) -> DataFrame:
    """Frames of the catalog's products; F### leaves are hours, M##### minutes; any other registers the run without an hour."""
    number = lambda p: F.regexp_extract("leaf", p, 1).try_cast("int")
    hours, minutes = number(r"^F(\d{3})\.png$"), number(r"^M(\d{5})\.png$")
    return _run_objects(paths, products).select("product", "run", F.coalesce(hours, minutes).alias("fh"), F.when(hours.isNotNull(), "h").when(minutes.isNotNull(), "m").alias("unit"))


def source_times(paths: DataFrame, products: DataFrame) -> DataFrame:
    """``product, run, src``: the latest time of day in each run's markers ``F000.src-HHMMSS``, and as ``t`` with the run's day."""
    mark = F.nullif(F.regexp_extract("leaf", r"^F000\.src-(\d{6})$", 1), F.lit(""))
    rows = _run_objects(paths, products).select("product", "run", mark.alias("src")).where("src is not null")
    rows = rows.groupBy("product", "run").agg(F.max("src").alias("src"))
    return rows.withColumn("t", F.try_to_timestamp(F.concat(F.substring("run", 1, 8), "src"), F.lit("yyyyMMddHHmmss")))


def stamp(name: Column) -> Column:
    """The time in a file's name, in any of the feeds' forms."""
    get = lambda p: F.regexp_extract(name, p, 1)
    return F.coalesce(
        F.try_to_timestamp(F.nullif(get(r"_(\d{8}-\d{6})"), F.lit("")), F.lit("yyyyMMdd-HHmmss")),
        F.try_to_timestamp(F.nullif(get(r"_s(\d{13})\d"), F.lit("")), F.lit("yyyyDDDHHmmss")),
        F.try_to_timestamp(F.nullif(get(r"^(\d{11})(?!\d)"), F.lit("")), F.lit("yyyyDDDHHmm")),
        F.try_to_timestamp(F.nullif(get(r"^(\d{12})(?!\d)"), F.lit("")), F.lit("yyyyMMddHHmm")),
        F.try_to_timestamp(F.nullif(get(r"^(\d{10})(?!\d)"), F.lit("")), F.lit("yyyyMMddHH")),
    )


def inventory_text(lines: DataFrame) -> DataFrame:
    """``msg:offset:d=date:VAR:LEVEL:STEP[:...]``; sub-messages keep their dotted number."""
    f = F.split("line", ":")
    at = lambda i: F.try_element_at(f, F.lit(i + 1))
    rows = lines.select(at(0).alias("msg"), at(1).try_cast("long").alias("off"), F.regexp_replace(at(2), "^d=", "").alias("date"), at(3).alias("var"), at(4).alias("lvl"), at(5).alias("step"), at(6).alias("prob"))
    return rows.where(F.col("msg").rlike(r"^\d+(\.\d+)?$") & F.col("off").isNotNull() & F.col("step").isNotNull())


def inventory_json(lines: DataFrame) -> DataFrame:
    """JSON lines with ``param, levtype, levelist, _offset, _length``."""
    r = lines.select(F.from_json("line", "param string, levtype string, levelist string, _offset long, _length long").alias("r")).select("r.*")
    rows = r.select(F.concat_ws(":", "param", "levtype", "levelist").alias("key"), F.col("_offset").alias("off"), (F.col("_offset") + F.col("_length") - 1).alias("end"))
    return rows.where("off is not null and `end` is not null")


#: fixed values: pressure levels of profiles, from the ground up, and the variables on them
LEVELS = tuple(range(1000, 99, -50))
ISOBARIC = ("UGRD", "VGRD", "HGT", "TMP", "DPT")


def inventory_key(var: Column, level: Column, step: Column, levels: tuple[int, ...] = LEVELS) -> Column:
    """A canonical key, or null.  Storm fields need a step: the strongest at 1 km, that of the column, and the total since hour 0."""
    mb = F.regexp_extract(level, r"^(\d+)( .*)? mb$", 1).try_cast("int")
    key = lambda at: F.concat(var, F.lit(f":{at}"))
    step = F.coalesce(step, F.lit(""))
    return (
        F.when((var == "MAXREF") & (level == "1000 m above ground") & step.contains("max"), key("1km"))
        .when((var == "REFC") & level.startswith("entire atmosphere") & (step != ""), key("col"))
        .when((var == "APCP") & (level == "surface") & step.startswith("0-") & step.contains(" acc"), key("total"))
        .when(var.isin(*ISOBARIC) & mb.isin(*levels), F.concat_ws(":", var, mb.cast("string")))
        .when(var.isin("PRES", "HGT") & (level == "surface"), key("sfc"))
        .when(var.isin("TMP", "DPT") & (level == "2 m above ground"), key("2m"))
        .when(var.isin("UGRD", "VGRD") & (level == "10 m above ground"), key("10m"))
    )


def html_cell(html: Column, label: str) -> Column:
    """The table cell after a label's cell."""
    return F.nullif(F.regexp_extract(html, rf"<t[dh]>{label}</t[dh]>\s*<td>([^<]*)</td>", 1), F.lit(""))


def point_features(documents: DataFrame) -> DataFrame:
    """``value`` holds GeoJSON collections; features with a usable point: in range and not 0, 0."""
    schema = "features array<struct<geometry:struct<type:string,coordinates:array<double>>,properties:map<string,string>>>"
    f = documents.select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
    rows = f.select(F.try_element_at("f.geometry.coordinates", F.lit(1)).alias("lon"), F.try_element_at("f.geometry.coordinates", F.lit(2)).alias("lat"), F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"))
    return rows.where("kind = 'Point' and lon between -180 and 180 and lat between -90 and 90 and not (lon = 0 and lat = 0)").drop("kind")


def site_list(rows: DataFrame) -> DataFrame:
    """Sites (``id, lat, lon``: text, as from a CSV file with a header) with valid positions; of equal ids the first by position."""
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    good = rows.select(F.trim("id").alias("id"), lat.alias("lat"), lon.alias("lon")).where("id <> '' and lat between -90 and 90 and lon between -180 and 180")
    return good.groupBy("id").agg(F.min(F.struct("lat", "lon")).alias("p")).select("id", "p.lat", "p.lon")


def ramp_lines(lines: DataFrame) -> DataFrame:
    """Colour ramps (``ramp, line``: value, red, green, blue and maybe alpha) to a row for each stop; comments and other lines have none, ``nv`` is the colour of no value."""
    part = F.split(F.trim(F.split_part("line", F.lit("#"), F.lit(1))), r"[\s,]+")
    number = lambda i: F.get(part, F.lit(i)).try_cast("double")
    rows = lines.select("ramp", (F.get(part, F.lit(0)) == "nv").alias("none"), number(0).alias("value"), *(number(i).cast("int").alias(c) for i, c in enumerate("rgb", 1)), F.coalesce(number(4), F.lit(255)).cast("int").alias("a"))
    return rows.where("(none or value is not null) and r is not null and g is not null and b is not null")
