"""Queries over the point feeds, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.functions import scalar as S
from isobar.operators import grids as G
from isobar.operators import listings as L
from isobar.operators import points as P
from isobar.sources import parsers
from isobar.sources.adapters import NOW, duck, feed, query, table
from isobar.sources.publish import documents, guarded, publish, tolerant_union, union_of_feeds, verdicts, versioned, write_guarded, write_tiles
from isobar.sources.storage import kept, work_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = duck(sql)
        return f

    return add


def _epoch(c: str):
    return F.unix_timestamp(F.col(c).cast("timestamp")).alias(c)


READINGS = "(select station_id, param, hour, max(aqi) aqi from $F1 group by 1, 2, 3)"
CARRIED = f"""(select * from (select g.station_id, g.param, g.hour,
  last_value(r.aqi ignore nulls) over (partition by g.station_id, g.param order by g.hour rows between 3 preceding and current row) aqi
  from (select station_id, param, unnest(generate_series(min(hour), max(hour) + interval 3 hours, interval 1 hour)) as hour from {READINGS} group by 1, 2) g
  left join {READINGS} r on r.station_id = g.station_id and r.param = g.param and r.hour = g.hour) where aqi is not null)"""


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.hourly_max(feed(spark, sf_dir, "F1"))


@register(f"""with worst as (select station_id, hour, max(aqi) v from {CARRIED} group by 1, 2),
 pts as (select w.hour, w.station_id, s.lat, s.lon, cast(w.v as double) v from worst w join $F2 s using (station_id)
         qualify count(*) over (partition by w.hour) >= 3),
 a as (select *, unnest(range(cast(ceil(lat - 4.0e0) as bigint), cast(floor(lat + 4.0e0) as bigint) + 1)) gy from pts),
 b as (select *, unnest(range(cast(ceil(lon - 4.0e0) as bigint), cast(floor(lon + 4.0e0) as bigint) + 1)) gx from a),
 c as (select *, (gy - lat) * (gy - lat) + (gx - lon) * (gx - lon) d2 from b),
 k as (select * from c where d2 <= 16 qualify row_number() over (partition by hour, gy, gx order by d2, station_id) <= 20),
 g as (select hour, gy, gx, sum(v / (d2 + 0.09e0)) / sum(1 / (d2 + 0.09e0)) v, count(*) n from k group by 1, 2, 3)
 select cast(floor(epoch(hour)) as bigint) as hour, cast(gy as double) lat, cast(gx as double) lon, v, n,
  case when v <= 50 then 1 when v <= 100 then 2 when v <= 150 then 3 when v <= 200 then 4 when v <= 300 then 5 else 6 end category from (select * replace (round_even(v, 4) as v) from g)""")
def flagship_aqi_surface(spark, sf_dir):
    """Readings, hourly maximum, carried forward, worst of all, surface, category."""
    hourly = _hourly(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "station_id")  # of a station one row at most for each hour and parameter; all steps before the surface go by station
    worst = P.worst_of(P.carried_forward(hourly, ["station_id", "param"]))
    points = worst.join(feed(spark, sf_dir, "F2"), "station_id").select("hour", "station_id", "lat", "lon", F.col("aqi").cast("double").alias("v"))
    points = kept(points, "points")
    surface = G.idw_surface(points, ["hour"]).withColumn("v", F.bround("v", 4))
    return surface.select(_epoch("hour"), "lat", "lon", "v", "n", S.aqi_category(F.col("v")).alias("category"))


@register(f"select station_id, param, cast(floor(epoch(hour)) as bigint) as hour, aqi from {READINGS}")
def A1_hourly_max(spark, sf_dir):
    return _hourly(spark, sf_dir).select("station_id", "param", _epoch("hour"), "aqi")


@register(f"select station_id, param, cast(floor(epoch(max(hour))) as bigint) as hour, arg_max(aqi, hour) aqi from {READINGS} group by 1, 2")
def A2_latest_per_key(spark, sf_dir):
    return P.latest(_hourly(spark, sf_dir), ["station_id", "param"], ["hour"]).select("station_id", "param", _epoch("hour"), "aqi")


@register(f"select station_id, cast(floor(epoch(hour)) as bigint) as hour, max(aqi) aqi from {READINGS} group by station_id, hour")
def A3_worst_of(spark, sf_dir):
    return P.worst_of(_hourly(spark, sf_dir)).select("station_id", _epoch("hour"), "aqi")


@register(f"""select event_id, sat, epoch from $F3 qualify row_number() over (partition by epoch >= {NOW - 1800},
 round_even(lat / case when epoch >= {NOW - 1800} then 0.01e0 else 0.08e0 end, 0), round_even(lon / case when epoch >= {NOW - 1800} then 0.01e0 else 0.08e0 end, 0),
 floor(epoch / case when epoch >= {NOW - 1800} then 30 else 120 end) order by epoch desc, event_id) = 1""")
def A4_grid_dedup(spark, sf_dir):
    return P.grid_dedup(feed(spark, sf_dir, "F3"), NOW).select("event_id", "sat", "epoch")


_AGE = f"greatest(cast(floor(({NOW} - epoch) / 60) as bigint), 0)"


@register(f"select spot_id, frp from $F5 qualify row_number() over (partition by round_even(lat, 4), round_even(lon, 4), cast(floor({_AGE} / 30) as bigint) order by frp desc, spot_id) = 1")
def A5_strongest_wins(spark, sf_dir):
    age = S.age_minutes(F.col("epoch"), NOW)
    keys = [F.bround("lat", 4), F.bround("lon", 4), F.floor(age / 30)]
    return P.strongest(feed(spark, sf_dir, "F5"), keys, "frp", "spot_id").select("spot_id", "frp")


_KM = "2 * 6371.0e0 * atan2(sqrt(h), sqrt(greatest(1 - h, 0)))"
_PAIRS = f"""(select spot_id, fire_id, km, epoch, frp, sat_code from (select *, {_KM} km from (select s.*, f.fire_id, f.rad, f.lat f_lat, f.lon f_lon,
  pow(sin(radians(f.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(f.lat)) * pow(sin(radians(f.lon - s.lon) / 2), 2) h
  from $F5 s join (select *, greatest(least(1.2e0 * sqrt(greatest(coalesce(acres, 0), 0) * 0.00404686e0), 60.0e0), 3.0e0) rad from $F4) f on abs(s.lat - f.lat) <= 0.6 and abs(s.lon - f.lon) <= 1.0))
  where km <= rad and abs(lat - f_lat) * 111.0e0 <= rad and abs(lon - f_lon) * cos(radians(lat)) * 111.0e0 <= rad qualify row_number() over (partition by spot_id order by km, fire_id) = 1)"""


@register(f"select spot_id, fire_id, round_even(km, 4) km from {_PAIRS}")
def J1_nearest_incident(spark, sf_dir):
    return P.nearest_incident(feed(spark, sf_dir, "F5"), feed(spark, sf_dir, "F4")).select("spot_id", "fire_id", F.bround("km", 4).alias("km"))


def _activity(spark, sf_dir):
    spots = feed(spark, sf_dir, "F5")
    return P.activity(spots, P.nearest_incident(spots, feed(spark, sf_dir, "F4")), NOW)


_ACT = f"""(select fire_id, count(*) n, count(*) filter (where {_AGE} <= 360) n6, max(frp) peak, min({_AGE}) least_age, count(distinct sat_code) sats from {_PAIRS} group by 1)"""


@register(f"select * from {_ACT}")
def A6_activity(spark, sf_dir):
    return _activity(spark, sf_dir)


@register(f"select f.fire_id, coalesce(n, 0) n, coalesce(n6, 0) n6, peak, least_age, coalesce(sats, 0) sats from $F4 f left join {_ACT} a using (fire_id)")
def J11_incidents_with_activity(spark, sf_dir):
    return P.with_activity(feed(spark, sf_dir, "F4").select("fire_id"), _activity(spark, sf_dir))


@register(f"select station_id, param, cast(floor(epoch(hour)) as bigint) as hour, aqi from {CARRIED}")
def W1_carried_forward(spark, sf_dir):
    rows = P.carried_forward(_hourly(spark, sf_dir), ["station_id", "param"])
    return rows.select("station_id", "param", _epoch("hour"), "aqi")


_STATIONS = "(select id, lat, lon, case type when 'a' then 1 when 'c' then 3 when 'r' then 2 else 0 end prio from (select *, row_number() over (partition by id order by obs desc, event_id desc) n from $F6) where n = 1)"


def _stations(spark, sf_dir):
    rows = P.latest(feed(spark, sf_dir, "F6"), ["id"], ["obs", "event_id"])
    return rows.select("id", "lat", "lon", F.when(F.col("type") == "a", 1).when(F.col("type") == "c", 3).when(F.col("type") == "r", 2).otherwise(0).alias("prio"))


def _rank_sql() -> str:
    sql = f"(select *, cast(null as int) rk from {_STATIONS})"
    for level, size in enumerate(P.CELLS):
        e = f"(rk is null and (prio = 0 or {level} >= 2))"
        sql = f"(select id, lat, lon, prio, case when {e} and row_number() over (partition by floor((lat + 90) / {size}e0), floor((lon + 180) / {size}e0), {e} order by prio, id) = 1 then {level} else rk end rk from {sql})"
    return sql


@register(f"select id, prio, coalesce(rk, 5) as \"rank\" from {_rank_sql()}")
def W2_declutter_rank(spark, sf_dir):
    return P.declutter_rank(_stations(spark, sf_dir)).select("id", "prio", "rank")


@register("""with p as (select *, category c from $F7 where provider_key % 7 <> 6)
 select case when c is null then 'unknown' when c > 3 then 'restricted' else 'allowed' end outcome, o.provider_key, count(*) n from $F6 o left join p on p.provider_key = o.provider_key group by 1, 2""")
def J3_outcomes_by_provider(spark, sf_dir):
    """Rows by what becomes of them, where the list lacks some providers."""
    return P.provider_outcomes(feed(spark, sf_dir, "F6"), feed(spark, sf_dir, "F7").where("provider_key % 7 <> 6"), 3)


@register("select event_id, provider_key from $F6 o where provider_key in (select provider_key from $F7 where category <= 3)")
def J3_allowed_providers(spark, sf_dir):
    return P.allowed(feed(spark, sf_dir, "F6"), feed(spark, sf_dir, "F7"), 3).select("event_id", "provider_key")


@register("select event_id, id from $F6 where id not in (select id from $F8) and concat('K', id) not in (select id from $F8)")
def J4_without_metars(spark, sf_dir):
    return P.without_stations(feed(spark, sf_dir, "F6"), feed(spark, sf_dir, "F8")).select("event_id", "id")


@register("""select event_id, sat, lat, lon from $F3, (select count(distinct sat) live from $F3) where live < 2 or (sat = 'E' and lon >= -106) or (sat = 'W' and lon < -106)""")
def P9_satellite_split(spark, sf_dir):
    return P.split_satellites(feed(spark, sf_dir, "F3")).select("event_id", "sat", "lat", "lon")


@register("select event_id, epoch from $F3 order by epoch desc, event_id limit 60000")
def T1_newest_capped(spark, sf_dir):
    return P.top_k(feed(spark, sf_dir, "F3"), 60000, F.col("epoch").desc(), F.col("event_id")).select("event_id", "epoch")


@register("select spot_id, frp from $F5 order by frp desc, spot_id limit 30000")
def T2_strongest_capped(spark, sf_dir):
    return P.top_k(feed(spark, sf_dir, "F5"), 30000, F.col("frp").desc(), F.col("spot_id")).select("spot_id", "frp")


@register("select product, obj from $F12 qualify row_number() over (partition by product order by run desc, obj) <= 6")
def T3_capped_per_product(spark, sf_dir):
    return P.capped_per_group(feed(spark, sf_dir, "F12"), ["product"], 6, F.col("run").desc(), F.col("obj")).select("product", "obj")


@register(f"select coalesce(rk, 5) as \"rank\", id from {_rank_sql()}")
def T4_ordered_publication(spark, sf_dir):
    return P.declutter_rank(_stations(spark, sf_dir)).select("rank", "id").orderBy("rank", "id")


@register("select station_id, param, cast(floor(epoch(hour)) as bigint) as hour, aqi, case when aqi <= 50 then 1 when aqi <= 100 then 2 when aqi <= 150 then 3 when aqi <= 200 then 4 when aqi <= 300 then 5 else 6 end category from $F1")
def P1_category(spark, sf_dir):
    return feed(spark, sf_dir, "F1").select("station_id", "param", _epoch("hour"), "aqi", S.aqi_category(F.col("aqi")).alias("category"))


_NAMED = "case replace(lower(trim(n)), ' ', '') when 'good' then 1 when 'moderate' then 2 when 'usg' then 3 when 'unhealthy' then 4 else case when v <= 50 then 1 when v <= 100 then 2 when v <= 150 then 3 when v <= 200 then 4 when v <= 300 then 5 else 6 end end"


@register(f"select event_id, {_NAMED} category from (select event_id, floor(value) v, case event_id % 5 when 0 then ' Good' when 1 then 'MODERATE ' when 2 then 'u s g' when 3 then 'Unhealthy' else 'n/a' end n from events)")
def P2_named_category(spark, sf_dir):
    rows = query(spark, sf_dir, "select event_id, floor(value) v, case event_id % 5 when 0 then ' Good' when 1 then 'MODERATE ' when 2 then 'u s g' when 3 then 'Unhealthy' else 'n/a' end n from events")
    return rows.select("event_id", S.named_category(F.col("n"), F.col("v")).alias("category"))


@register("select spot_id, coalesce(confidence, '') in ('high', '85') high from $F5 where coalesce(confidence, '') not in ('low', '45')")
def P3_confidence_gate(spark, sf_dir):
    return feed(spark, sf_dir, "F5").select("spot_id", S.confidence(F.col("confidence")).alias("high")).where("high is not null")


_COLS = "select event_id, case when event_id % 3 = 0 then 'n/a' else cast(event_id % 400 / 2.0e0 as string) end a, case when event_id % 2 = 0 then '' else cast(event_id % 77 / 4.0e0 as string) end b from events"


@register(f"select event_id, cast(round_even(coalesce(try_cast(a as double), try_cast(b as double), 0), 0) as int) bright from ({_COLS})")
def P4_first_usable(spark, sf_dir):
    return query(spark, sf_dir, _COLS).select("event_id", S.first_usable(F.col("a"), F.col("b")).alias("bright"))


_SAT = """select event_id, event_type sat, case event_id % 7 when 0 then '' when 1 then 'x' else cast(event_id % 160 / 16.0e0 as string) end scan, case when event_id % 5 = 0 then null else cast(event_id % 77 / 8.0e0 as string) end track,
 case event_id % 4 when 0 then ' d' when 1 then 'D' when 2 then 'N' end daynight from events"""


@register("""select event_id, case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 else -1 end code, event_id % 4 < 2 as is_day,
 case when event_id % 7 = 1 then 0.0e0 else round_even(greatest(case when event_id % 7 = 0 then 0 else event_id % 160 / 16.0e0 end, case when event_id % 5 = 0 then 0 else event_id % 77 / 8.0e0 end), 1) end footprint from events""")
def P5_satellite_code(spark, sf_dir):
    codes = {"CLICK": 0, "VIEW": 1, "PURCHASE": 2}
    return query(spark, sf_dir, _SAT).select("event_id", S.satellite_code(F.col("sat"), codes).alias("code"), S.is_day(F.col("daynight")).alias("is_day"), S.footprint(F.col("scan"), F.col("track")).alias("footprint"))


@register(f"select spot_id, {_AGE} age from $F5 where {_AGE} <= 2880")
def P6_age_gate(spark, sf_dir):
    rows = feed(spark, sf_dir, "F5").withColumn("age", S.age_minutes(F.col("epoch"), NOW))
    return rows.where("age <= 2880").select("spot_id", "age")


@register(f"select event_id from $F6 where {NOW} - obs between -600 and 86400 * case type when 'a' then 18 else 9 end")
def P7_age_by_type(spark, sf_dir):
    limit = F.when(F.col("type") == "a", 18).otherwise(9) * 86400
    return feed(spark, sf_dir, "F6").where((F.lit(NOW) - F.col("obs")).between(-600, limit)).select("event_id")


@register("select event_id, lat, lon from $F3 where lat between 24 and 40 and lon between -120 and -70")
def P8_box(spark, sf_dir):
    return feed(spark, sf_dir, "F3").where(F.col("lat").between(24, 40) & F.col("lon").between(-120, -70)).select("event_id", "lat", "lon")


_OK = lambda k: f"coalesce({k}_flag, '') not in ('X', 'Q', 'B')"
_QC = f"""with o as (select *, case when {_OK('td_k')} and td_k > 180 and td_k < 320 then td_k end d, case when {_OK('ws')} and ws >= 0 and ws < 100 then ws end s, case when {_OK('wg')} and wg >= 0 and wg < 120 then wg end g,
  case when pst3 = 0 then case pst1 when 1 then '1h' when 3 then '3h' when 6 then '6h' when 12 then '12h' when 18 then '18h' when -1 then 'local-midnight' when -2 then 'utc-midnight' when -3 then '24h' when -4 then '5m' when -5 then '15m' end end p
  from $F6 where {_OK('t_k')} and t_k > 200 and t_k < 340 and (type <> 'c' or t_k_flag in ('S', 'V', 'K', 'G')))
 select event_id, t_k, case when d > t_k + 0.5 then null else d end td_k, case when {_OK('rh')} and rh between 0 and 105 then least(rh, 100) end rh, case when {_OK('wd')} and wd between 0 and 360 then cast(round_even(wd, 0) as int) % 360 end wd,
  s ws, case when s is not null and g < s then null else g end wg, case when p is not null and {_OK('pr')} and pr >= 0 and pr < 2000 then cast(round_even(cast(cast(pr as varchar) as decimal(38, 20)), 1) as double) end pr, case when {_OK('pr')} and pr >= 0 and pr < 2000 then p end period,
  case when abs(elev) <= 9000 then cast(round_even(elev, 0) as int) end elev from o"""


@register(_QC)
def P10_P11_quality_control(spark, sf_dir):
    return P.quality_controlled(feed(spark, sf_dir, "F6")).select("event_id", "t_k", "td_k", "rh", "wd", "ws", "wg", "pr", "period", "elev")


@register("select event_id, provider, case category when 2 then 'hour' when 3 then 'day' else null end period from $F6 left join $F7 using (provider_key)")
def P12_coded_period(spark, sf_dir):
    rows = feed(spark, sf_dir, "F6").join(F.broadcast(feed(spark, sf_dir, "F7")), "provider_key", "left")  # a row for each nation
    return rows.select("event_id", "provider", S.lookup(F.col("category"), {2: "hour", 3: "day"}).alias("period"))


@register("select fire_id, round_even(0.55e0 + 1.25e0 * greatest(0, least((log10(greatest(acres, 0.1e0)) + 1) / 7, 1)), 3) size from $F4")
def P13_size_ramp(spark, sf_dir):
    return feed(spark, sf_dir, "F4").select("fire_id", S.size_ramp(F.col("acres")).alias("size"))


@register("select fire_id, kind from $F4 where kind in ('WF', 'RX', 'CX') and not is_child")
def P14_kinds(spark, sf_dir):
    return feed(spark, sf_dir, "F4").where(F.col("kind").isin("WF", "RX", "CX") & ~F.col("is_child")).select("fire_id", "kind")


_DENS = "select event_id, case event_id % 6 when 0 then 'Heavy' when 1 then ' medium' when 2 then '27' when 3 then '16.000' when 4 then '5' else '?' end d from events"


@register(f"select event_id, case event_id % 6 when 0 then 'heavy' when 1 then 'medium' when 2 then 'heavy' when 3 then 'medium' else 'light' end density from events")
def P15_smoke_density(spark, sf_dir):
    return query(spark, sf_dir, _DENS).select("event_id", S.smoke_density(F.col("d")).alias("density"))


@register("""select c_custkey, case when c_custkey % 4 < 2 then concat('D', c_custkey) end as start_date from customer""")
def P16_html_cell(spark, sf_dir):
    """Tables with the label in a cell or a heading, with an empty cell after it, and without it."""
    rows = query(spark, sf_dir, """select c_custkey, concat('<table><tr><td>End_Date</td><td>E</td></tr><tr>', case c_custkey % 4 when 0 then '<td>Start_Date</td> ' when 1 then '<th>Start_Date</th>' when 2 then '<td>Start_Date</td>' else '<td>Start</td>' end, '<td>',
 case when c_custkey % 4 = 2 then '' else concat('D', c_custkey) end, '</td></tr></table>') h from customer""")
    return rows.select("c_custkey", parsers.html_cell(F.col("h"), "Start_Date").alias("start_date"))


@register("select field, r, c, case when v >= 0 then v * (1 / 25.4e0) end v from $F9")
def P19_mask_and_scale(spark, sf_dir):
    return feed(spark, sf_dir, "F9").select("field", "r", "c", S.unmasked(F.col("v"), 0.0, 1 / 25.4).alias("v"))


@register("select event_id, case when x > 180 then x - 360 else x end lon from (select event_id, cast(event_id % 360 as double) x from events)")
def P20_longitude(spark, sf_dir):
    return query(spark, sf_dir, "select event_id, cast(event_id % 360 as double) x from events").select("event_id", S.longitude(F.col("x")).alias("lon"))


_F17 = """(select split_part(line, '|', 1) issue, cast(strptime(split_part(line, '|', 2), '%m/%d/%y') as date) as valid, cast(split_part(line, '|', 5) as int) seq, split_part(line, '|', 6) kind,
 split_part(line, '|', 8) area, try_cast(split_part(line, '|', 13) as int) aqi, replace(lower(trim(split_part(line, '|', 14))), ' ', '') cat, lower(split_part(line, '|', 15)) = 'yes' as action from $F17)"""


@register(f"select * from (select issue, cast(valid as string) as valid, seq, area, aqi, case cat when 'moderate' then 2 when 'good' then 1 when 'usg' then 3 when 'unhealthy' then 4 when 'veryunhealthy' then 5 else case when aqi <= 50 then 1 when aqi <= 100 then 2 when aqi <= 150 then 3 when aqi <= 200 then 4 when aqi <= 300 then 5 when aqi > 300 then 6 end end category, action from {_F17} where kind = 'F' and seq between 0 and 2) where category is not null")
def S2_P22_area_forecasts(spark, sf_dir):
    rows = parsers.area_forecasts(feed(spark, sf_dir, "F17"))
    return rows.select("issue", F.col("valid").cast("string").alias("valid"), "seq", "area", "aqi", "category", "action")


_JSON = """select to_json(named_struct('Latitude', lat, 'Longitude', lon, 'AQI', if(event_id % 7 = 0, null, cast(floor(value) as string)), 'Value', cast(floor(value) - 20 as string),
 'Parameter', if(event_id % 11 = 0, null, event_type), 'SiteName', cast(event_id as string), 'UTC', date_format(cast(ts as timestamp), "yyyy-MM-dd'T'HH:mm"))) value
 from events join $F2 on user_id = station_id"""


@register("""select cast(event_id as string) site, event_type param, aqi, cast(floor(epoch(date_trunc('minute', ts))) as bigint) as hour from (select *, cast(case when event_id % 7 = 0 then floor(value) - 20 else floor(value) end as int) aqi from events) where event_id % 11 <> 0 and aqi >= 0""")
def S1_json_readings(spark, sf_dir):
    return parsers.readings(query(spark, sf_dir, _JSON)).select("site", "param", "aqi", _epoch("hour"))


@register("select event_id, lat, lon from $F3 where lon between -120 and -70")
def S3_csv_with_bad_rows(spark, sf_dir):
    """Hotspot CSV lines with a broken column here and there, as text."""
    lines = feed(spark, sf_dir, "F3").select(F.concat_ws(",", "event_id", F.when(F.col("lon").between(-120, -70), F.col("lat").cast("string")).otherwise("broken"), "lon").alias("line"))
    r = lines.select(F.from_csv("line", "event_id long, lat string, lon string").alias("r")).select("r.*")
    return r.select("event_id", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon")).where("lat is not null")


@register("select fire_id, lat, lon from $F4 where fire_id % 9 <> 0")
def S4_geojson_points(spark, sf_dir):
    f = feed(spark, sf_dir, "F4").withColumn("zero", F.col("fire_id") % 9 == 0)
    at = F.when(F.col("zero"), F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array("lon", "lat"))
    feature = F.struct(F.struct(F.lit("Point").alias("type"), at.alias("coordinates")).alias("geometry"), F.create_map(F.lit("id"), F.col("fire_id").cast("string")).alias("properties"))
    docs = f.groupBy((F.col("fire_id") % 50).alias("k")).agg(F.collect_list(feature).alias("features")).select(F.to_json(F.struct("features")).alias("value"))
    rows = parsers.point_features(docs)
    return rows.select(F.element_at("properties", "id").cast("long").alias("fire_id"), "lat", "lon")


@register("select r // 50 tr, c // 50 tc, count(*) n, round_even(max(v), 6) most from $F9 group by 1, 2")
def S13_tiled_sink(spark, sf_dir):
    """Cells written by tile, a folder for each, and read back."""
    path = work_path(spark, "tiles")
    cells = feed(spark, sf_dir, "F9").withColumns({"tr": F.floor(F.col("r") / 50), "tc": F.floor(F.col("c") / 50)})
    write_tiles(cells, path, ["tr", "tc"])
    back = spark.read.schema(cells.schema).parquet(path)
    return back.groupBy("tr", "tc").agg(F.count(F.lit(1)).alias("n"), F.bround(F.max("v"), 6).alias("most"))


@register("select station_id, param, cast(floor(epoch(hour)) as bigint) as hour, aqi, (select cast(floor(epoch(max(hour))) as bigint) from $F1) newest from " + READINGS)
def S14_data_then_pointer(spark, sf_dir):
    """What a reader finds that follows the pointer to the data."""
    path = work_path(spark, "published")
    data = _hourly(spark, sf_dir).select("station_id", "param", _epoch("hour"), "aqi")
    publish(data, data.agg(F.max("hour").alias("newest")).withColumn("data", F.lit(f"{path}/data")), path)
    pointer = spark.read.schema("newest long, data string").json(f"{path}/pointer").first()
    return spark.read.schema(data.schema).parquet(pointer["data"]).withColumn("newest", F.lit(pointer["newest"]))


_AT = "strftime(hour, '%Y-%m-%dT%H:%M:%S.000Z')"


@register(f"""select station_id, concat('{{"schemaVersion":1,"n":', count(*), ',"rows":[', string_agg(concat('{{"hour":"', {_AT}, '","param":"', param, '","aqi":', aqi, '}}'), ',' order by hour, param, aqi), ']}}') as "value" from {READINGS} group by 1""")
def S12_json_documents(spark, sf_dir):
    return documents(_hourly(spark, sf_dir).select("station_id", "hour", "param", "aqi"), ["station_id"], "hour", {"schemaVersion": F.lit(1)})


@register("select event_type as feed, count(*) n, count(*) >= 1000 as ok from events group by 1")
def S15_guards(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("feed")).agg(F.count(F.lit(1)).alias("n"))
    kinds = ("click", "view", "purchase", "signup", "error", "logout", "login", "search", "scroll", "refund")
    return verdicts(guarded(counts, 1, "events"), dict.fromkeys(kinds, 1000))


@register("select sat, count(*) n from $F3 group by 1")
def S16_union_of_feeds(spark, sf_dir):
    f = feed(spark, sf_dir, "F3")
    return union_of_feeds([f.where("sat = 'E'"), None, f.where("sat = 'W'")]).groupBy("sat").agg(F.count(F.lit(1)).alias("n"))


@register("select event_type, count(*) n from events where event_type <> 'error' group by 1")
def S15_published(spark, sf_dir):
    """The feeds that were published: one that is optional has no rows, and the others are counted while they are written."""
    path = work_path(spark, "guarded")
    rows = table(spark, sf_dir, "events").where("event_type <> 'error'")
    write_guarded(rows, path, "event_type", {"click": 10, "view": 10, "purchase": 1, "error": 1}, optional=("error",), of=(3, 3))
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("select event_type, count(*) n from events where event_id % 5 <> 4 group by 1")
def S16_tolerant_union(spark, sf_dir):
    """Events of five files, of which one is gone and one isn't whole."""
    path = work_path(spark, "feeds")
    rows = table(spark, sf_dir, "events")
    for k in range(4):
        rows.where(F.col("event_id") % 5 == k).coalesce(1).write.parquet(f"{path}/{k}")
    rows.where("event_id % 5 = 4").selectExpr("cast(event_id as string) value").coalesce(1).write.text(f"{path}/4")
    broken = spark.read.text(f"{path}/4").inputFiles()[0]
    union = tolerant_union(spark, [*(f"{path}/{k}" for k in range(4)), f"{path}/none", broken], "event_id long, event_type string", 4)
    return union.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("select doc_id, concat_ws('.', 'sig', lang, substr(sha256(text), 1, 8)) as key from documents")
def S17_content_versions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("value"))
    return versioned(docs, F.lit("sig"), F.col("lang")).select("doc_id", "key")


@register("select type, count(*) n, count(*) filter (where t_k_flag in ('X', 'Q', 'B')) bad from $F6 group by 1")
def A14_counts(spark, sf_dir):
    return feed(spark, sf_dir, "F6").groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t_k_flag").isin("X", "Q", "B")).alias("bad"))


@register("select provider, count(*) n from $F6 join $F7 using (provider_key) where category in (2, 4) group by 1")
def J13_restricted_audit(spark, sf_dir):
    tags = feed(spark, sf_dir, "F7").select("provider_key", "provider", F.array("category").alias("tags"))
    rows = feed(spark, sf_dir, "F6").join(F.broadcast(tags), "provider_key")  # a row for each nation
    return rows.where(F.arrays_overlap("tags", F.array(F.lit(2), F.lit(4)))).groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


@register("select sat, lat, lon, max(epoch) epoch from $F3 group by 1, 2, 3")
def SO1_union_then_latest(spark, sf_dir):
    f = feed(spark, sf_dir, "F3").select("sat", "lat", "lon", "epoch")
    both = f.where("epoch % 2 = 0").unionByName(f.where("epoch % 2 = 1"))
    return P.latest(both, ["sat", "lat", "lon"], ["epoch"])


@register("select provider_key from $F6 intersect select provider_key from $F7 where category = 3")
def SO2_intersection(spark, sf_dir):
    return feed(spark, sf_dir, "F6").select("provider_key").intersect(feed(spark, sf_dir, "F7").where("category = 3").select("provider_key"))


@register("select provider_key from $F7 except select provider_key from $F6 where provider_key % 2 = 0")
def SO3_difference(spark, sf_dir):
    return feed(spark, sf_dir, "F7").select("provider_key").exceptAll(feed(spark, sf_dir, "F6").where("provider_key % 2 = 0").select("provider_key").distinct())


# scalar functions

@register("""select event_id, round_even(case when t_k > 100 then t_k - 273.15e0 else t_k end, 8) c, round_even((case when t_k > 100 then t_k - 273.15e0 else t_k end) * 1.8e0 + 32, 8) f, round_even(ws * 1.94384e0, 9) kt, round_even(sqrt(ws * ws + wg * wg), 8) mag from $F6""")
def M1_M2_units(spark, sf_dir):
    c = S.celsius(F.col("t_k"))
    return feed(spark, sf_dir, "F6").select("event_id", F.bround(c, 8).alias("c"), F.bround(S.fahrenheit(c), 8).alias("f"), F.bround(S.knots(F.col("ws")), 9).alias("kt"), F.bround(S.magnitude(F.col("ws"), F.col("wg")), 8).alias("mag"))


@register("""with a as (select event_id, lat, lon, radians(lat) p, radians(case sat when 'E' then -75.0e0 else -137.0e0 end - lon) d from $F3),
 b as (select *, cos(p) * cos(d) c from a), k as (select *, 4.0e0 * sqrt(1 - c * c) / (c - 6378.137e0 / 42164.16e0) s, atan2(sin(d), -sin(p) * cos(d)) z from b)
 select event_id, round_even(lat - s * -cos(z) / 110.574e0, 5) lat, round_even(lon - s * -sin(z) / (111.320e0 * cos(p)), 5) lon from k""")
def M4_parallax(spark, sf_dir):
    sub = F.when(F.col("sat") == "E", -75.0).otherwise(-137.0)
    lat, lon = S.parallax(F.col("lat"), F.col("lon"), sub)
    return feed(spark, sf_dir, "F3").select("event_id", F.bround(lat, 5).alias("lat"), F.bround(lon, 5).alias("lon"))


@register("select event_id, round_even(radians(lon) * 6378137.0e0, 3) x, round_even(ln(tan(0.7853981633974483e0 + radians(lat) / 2)) * 6378137.0e0, 3) y from $F3")
def M5_mercator(spark, sf_dir):
    x, y = S.mercator(F.col("lat"), F.col("lon"))
    return feed(spark, sf_dir, "F3").select("event_id", F.bround(x, 3).alias("x"), F.bround(y, 3).alias("y"))


@register("select event_id, round_even(ws * cos(a) + wg * sin(a), 5) u, round_even(wg * cos(a) - ws * sin(a), 5) v from (select *, radians(event_id % 90) a from $F6)")
def M6_rotation(spark, sf_dir):
    u, v = S.rotated(F.col("ws"), F.col("wg"), F.radians(F.col("event_id") % 90))
    return feed(spark, sf_dir, "F6").select("event_id", F.bround(u, 5).alias("u"), F.bround(v, 5).alias("v"))


@register("""with a as (select event_id, t_k - 273.15e0 t, greatest(1, least(rh, 100)) h from $F6),
 b as (select *, ln(h / 100) + 17.67e0 * t / (243.5e0 + t) g, ln(h / 100) + 17.625e0 * t / (243.04e0 + t) g2 from a)
 select event_id, round_even(243.5e0 * g / (17.67e0 - g), 4) td, round_even(243.04e0 * g2 / (17.625e0 - g2) * 1.8e0 + 32, 4) td_f from b""")
def M7_M8_dewpoint(spark, sf_dir):
    t, rh = F.col("t_k") - 273.15, F.col("rh")
    return feed(spark, sf_dir, "F6").select("event_id", F.bround(S.dewpoint_c(t, rh), 4).alias("td"), F.bround(S.dewpoint_c(t, rh, 17.625, 243.04) * 1.8 + 32, 4).alias("td_f"))


@register("""with i as (select event_id, t_k t, least(td_k, t_k) d, case when event_id % 50 = 0 then 20.0e0 else 850.0e0 end p from $F6), a as (select *, 6.112e0 * exp(17.67e0 * (d - 273.15e0) / ((d - 273.15e0) + 243.5e0)) e from i),
 b as (select *, 0.622e0 * e / greatest(p - e, 1) r, 56 + 1 / (1 / (t - 56) + ln(t / d) / 800) l from a),
 c as (select event_id, t * pow(1000 / p, 0.2854e0 * (1 - 0.28e0 * r)) * exp((3.376e0 / l - 0.00254e0) * 1000 * r * (1 + 0.81e0 * r)) te from b), y as (select *, te * 5.421010862427522e-20 y from c)
 select event_id, case when te < 10000 then round_even(te, 3) when te = 'infinity'::double then te else (y * 8589934593.0e0 - (y * 8589934593.0e0 - y)) * 18446744073709551616.0e0 end te from y""")
def M9_theta_e(spark, sf_dir):
    """To three decimals; beyond 10,000 K, where the formula multiplies the last bits of its steps, to 20 bits (six digits)."""
    te = S.theta_e(F.col("t_k"), F.col("td_k"), F.when(F.col("event_id") % 50 == 0, 20.0).otherwise(850.0))
    return feed(spark, sf_dir, "F6").select("event_id", te.alias("te")).select("event_id", F.when(F.col("te") < 10000, F.bround("te", 3)).otherwise(S.leading_bits(F.col("te"))).alias("te"))


@register("select event_id, case when event_id % 7 > 5 then 4 when event_id % 5 > 3 then 3 when event_id % 3 > 1 then 2 when event_id % 2 > 0 then 1 else 0 end ptype from events")
def M11_precip_type(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", S.precip_type(e % 2, (e % 3 > 1).cast("int"), (e % 5 > 3).cast("int"), (e % 7 > 5).cast("int")).alias("ptype"))


@register("""select field, r, c, cast(case when v / 2 - 33 >= -31.5 then greatest(2, least(round_even((v / 2 - 33 + 32) * 2, 0) + 2, 255)) else 0 end as int) dbz, cast(greatest(0, least(round_even(v / 0.4e0 + 128, 0), 255)) as int) wind,
 cast(round_even(1 + 254 * (greatest(-20, least(v, 80)) + 20) / 100, 0) as int) gray from $F9""")
def M12_bytes(spark, sf_dir):
    v = F.col("v")
    return feed(spark, sf_dir, "F9").select("field", "r", "c", S.byte_dbz(v / 2 - 33).cast("int").alias("dbz"), S.byte_wind(v).cast("int").alias("wind"), S.byte_gray(v, -20.0, 80.0).cast("int").alias("gray"))


@register("""select o_orderkey, cast(floor(epoch(o_orderdate)) as bigint) run_s, cast(floor(epoch(o_orderdate + to_hours(cast(o_orderkey % 49 as int)))) as bigint) valid_s, cast(floor(epoch(o_orderdate) / 900) * 900 as bigint) quarter_s from orders""")
def DT1_times(spark, sf_dir):
    run = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    valid = F.unix_timestamp(F.timestamp_millis(run * 1000) + F.make_dt_interval(hours=(F.col("o_orderkey") % 49).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", run.alias("run_s"), valid.alias("valid_s"), (F.floor(run / 900) * 900).cast("long").alias("quarter_s"))


@register("select station_id, case station_id % 4 when 1 then -25200 when 2 then 0 when 3 then 20700 else cast(round_even(lon / 15, 0) * 3600 as bigint) end offset_s from $F2")
def DT2_utc_offset(spark, sf_dir):
    """Offsets of zones on the day of all queries; stations without a zone go by their longitude."""
    k = F.col("station_id") % 4
    zone = F.when(k == 1, "America/Denver").when(k == 2, "UTC").when(k == 3, "Asia/Kathmandu")
    return feed(spark, sf_dir, "F2").select("station_id", S.utc_offset_seconds(zone, F.timestamp_seconds(F.lit(NOW)), F.col("lon")).alias("offset_s"))


@register("select event_id, EPOCH(ts) + case when abs(value - 50) <= 25 then value - 50 else 0 end as t from events")
def DT3_event_time(spark, sf_dir):
    start = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", S.event_time(start, F.col("value") - 50).alias("t"))


@register("select c_custkey, concat('a ', c_custkey, ' b') nm, lpad(cast(c_custkey % 100 as string), 3, '0') pad from customer")
def ST1_names(spark, sf_dir):
    rows = query(spark, sf_dir, "select c_custkey, concat('  US-a   ', c_custkey, ' b US ') n from customer")
    return rows.select("c_custkey", S.place_name(F.col("n")).alias("nm"), F.lpad((F.col("c_custkey") % 100).cast("string"), 3, "0").alias("pad"))


@register("select event_id, cast(event_id % 90 as int) lat, -cast(event_id % 180 as int) lon from events")
def ST3_tags(spark, sf_dir):
    lat, lon = S.lat_lon_tag(F.concat((F.col("event_id") % 90).cast("string"), F.lit("N-"), (F.col("event_id") % 180).cast("string"), F.lit("W")))
    return table(spark, sf_dir, "events").select("event_id", lat.alias("lat"), lon.alias("lon"))


_SERIES = f"(select station_id, param, max(aqi) aqi, hour(hour) h from $F1 group by station_id, param, hour(hour))"


@register(f"select station_id, param, string_agg(coalesce(cast(aqi as string), '-'), ',' order by s.h) series from (select distinct station_id, param, unnest(range(24)) h from $F1) s left join {_SERIES} r using (station_id, param, h) group by 1, 2")
def AR1_daily_series(spark, sf_dir):
    """Fixed-length series by hour of day, with gaps."""
    rows = feed(spark, sf_dir, "F1").groupBy("station_id", "param", F.hour("hour").alias("h")).agg(F.max("aqi").alias("aqi"))
    maps = rows.groupBy("station_id", "param").agg(F.map_from_entries(F.collect_list(F.struct("h", "aqi"))).alias("m"))  # 24 entries
    series = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.coalesce(F.try_element_at("m", h).cast("string"), F.lit("-")))
    return maps.select("station_id", "param", F.array_join(series, ",").alias("series"))


@register(f"""select station_id, concat('{{', string_agg(concat('"', param, '":[', s, ']'), ',' order by param), '}}') series from (select station_id, param, string_agg(cast(aqi as string), ',' order by hour) s from {READINGS} group by 1, 2) group by 1""")
def AR2_JS1_series_maps(spark, sf_dir):
    rows = _hourly(spark, sf_dir).groupBy("station_id", "param").agg(F.sort_array(F.collect_list(F.struct("hour", "aqi"))).alias("s"))
    return rows.groupBy("station_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("param", F.col("s.aqi")))))).alias("series"))


@register("select event_type, min(gap) least, round_even(median(gap), 2) mid from (select event_type, EPOCH(ts) - lag(EPOCH(ts)) over (partition by event_type order by ts, event_id) gap from events) group by 1")
def A21_cadence(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"), "ts")
    gaps = L.gaps_between(rows, "event_type", ["ts", "event_id"], "t")
    middle = L.at_places(gaps, "event_type", "gap", L.middle())
    least = gaps.groupBy("event_type").agg(F.min("gap").alias("least"))
    return least.join(middle, "event_type").select("event_type", "least", F.bround((F.col("low") + F.col("high")) / 2, 2).alias("mid"))
