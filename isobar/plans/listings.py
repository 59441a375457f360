"""Queries over listings, inventories, calendars and reports, and the streams."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import listings as L
from isobar.operators.sizes import maybe_broadcast
from isobar.plans import catalog as C
from isobar.plans.points import CARRIED, register
from isobar.sources import parsers
from isobar.sources.adapters import NOW, feed, query, table
from isobar.sources.storage import ship, work_path
from isobar.streaming import feeds as K
from isobar.streaming.slots import FlashFeed, SlotTable, recomputing, upserting


def _seconds(c: str):
    return F.unix_timestamp(F.col(c).cast("timestamp"))


_LINES = "select case when n_chars % 9 = 0 then concat('x', n_chars, ';', path) else concat(cast(size as string), ';', path) end line from (select *, size n_chars from $F13)"


@register("select size, path from $F13 where size % 9 <> 0")
def S5_listing(spark, sf_dir):
    return parsers.listing(query(spark, sf_dir, _LINES))


_KEYS = """select concat(case c_custkey % 6 when 0 then 'refc' when 1 then 't2m' when 2 then 'mesh' when 3 then 'gone' when 4 then 'wind10m' else 'mslp' end, '/',
 case when c_custkey % 13 = 0 then 'latest' else concat('20240', 101 + c_custkey % 28, lpad(cast(c_custkey % 24 as string), 2, '0')) end, '/',
 case c_custkey % 4 when 0 then concat('F', lpad(cast(c_custkey % 49 as string), 3, '0'), '.png') when 1 then concat('M', lpad(cast(c_custkey % 900 as string), 5, '0'), '.png')
  when 2 then concat('F000.src-', lpad(cast(c_custkey % 24 as string), 2, '0'), lpad(cast(c_custkey * 7 % 60 as string), 2, '0'), lpad(cast(c_custkey * 11 % 60 as string), 2, '0')) else 'manifest.json' end) path, c_custkey k from customer"""
_KEYS_SQL = "(select split_part(path, '/', 1) product, split_part(path, '/', 2) run, split_part(path, '/', 3) leaf, k from (" + _KEYS + ") where k % 13 <> 0 and k % 6 <> 3)"


@register(f"""select product, run, cast(case k % 4 when 0 then k % 49 when 1 then k % 900 end as int) fh, case k % 4 when 0 then 'h' when 1 then 'm' end unit from {_KEYS_SQL}""")
def S6_frame_keys(spark, sf_dir):
    """Keys of five products that the catalog has and of one that is gone."""
    return parsers.frame_keys(query(spark, sf_dir, _KEYS), C.products(spark))


@register(f"""select product, run, src, cast(floor(epoch(strptime(substr(run, 1, 8) || src, '%Y%m%d%H%M%S'))) as bigint) t from (select product, run, max(substr(leaf, 10)) src from {_KEYS_SQL} where k % 4 = 2 group by 1, 2)""")
def S7_source_markers(spark, sf_dir):
    rows = parsers.source_times(query(spark, sf_dir, _KEYS), C.products(spark))
    return rows.select("product", "run", "src", F.unix_timestamp("t").alias("t"))


@register("select event_id, cast(case event_id % 5 when 2 then floor(epoch(ts) / 60) * 60 when 3 then floor(epoch(ts) / 60) * 60 when 4 then floor(epoch(ts) / 3600) * 3600 else floor(epoch(ts)) end as bigint) t from events")
def S7_source_stamps(spark, sf_dir):
    t = F.col("ts").cast("timestamp")
    form = lambda p: F.date_format(t, p)
    k = F.col("event_id") % 5
    name = F.when(k == 0, F.concat(F.lit("REF_"), form("yyyyMMdd-HHmmss"), F.lit(".gz"))).when(k == 1, F.concat(F.lit("GLM_s"), form("yyyyDDDHHmmss"), F.lit("0_e1"))).when(k == 2, form("yyyyDDDHHmm")).when(k == 3, form("yyyyMMddHHmm")).otherwise(form("yyyyMMddHH"))
    return table(spark, sf_dir, "events").select("event_id", F.unix_timestamp(parsers.stamp(name)).alias("t"))


_IDX = "select concat(msg, case when msg % 10 = 0 then '.2' else '' end, ':', off, ':d=2024010100:', var, ':', lvl, ':', file_id, ' hour fcst') line, file_id from $F14"


@register("select concat(msg, case when msg % 10 = 0 then '.2' else '' end) msg, cast(off as bigint) off, var, lvl, concat(file_id, ' hour fcst') step from $F14")
def S8_text_inventory(spark, sf_dir):
    return parsers.inventory_text(query(spark, sf_dir, _IDX)).select("msg", "off", "var", "lvl", "step")


@register("select concat_ws(':', var, lvl, cast(file_id as string)) as key, cast(off as bigint) off, cast(off + 99 as bigint) as \"end\" from $F14")
def S9_json_inventory(spark, sf_dir):
    f = feed(spark, sf_dir, "F14")
    lines = f.select(F.to_json(F.struct(F.col("var").alias("param"), F.col("lvl").alias("levtype"), F.col("file_id").cast("string").alias("levelist"), F.col("off").alias("_offset"), F.lit(100).alias("_length"))).alias("line"))
    return parsers.inventory_json(lines)


_INV = """(select p_partkey, case p_partkey % 8 when 0 then 'TMP' when 1 then 'UGRD' when 2 then 'APCP' when 3 then 'REFC' when 4 then 'HGT' when 5 then 'MAXREF' when 6 then 'RH' else 'PRES' end v,
 case p_partkey % 7 when 0 then concat(p_partkey % 20 * 25 + 500, ' mb') when 1 then '2 m above ground' when 2 then '10 m above ground' when 3 then '1000 m above ground' when 4 then 'entire atmosphere (considered as a single layer)' when 5 then 'low mb' else 'surface' end l,
 case p_partkey % 5 when 0 then '0-6 hour acc fcst' when 1 then '5-6 hour max fcst' when 2 then '' when 3 then '5-6 hour acc fcst' else '6 hour fcst' end s from part)"""


@register(f"""select p_partkey, case when s <> '' and v = 'MAXREF' and l = '1000 m above ground' and s like '%max%' then 'MAXREF:1km' when s <> '' and v = 'REFC' and l like 'entire atmosphere%' then 'REFC:col'
 when v = 'APCP' and l = 'surface' and s like '0-%' and s like '% acc%' then 'APCP:total' when v in ('UGRD', 'VGRD', 'HGT', 'TMP', 'DPT') and l like '% mb' then case when try_cast(split_part(l, ' ', 1) as int) % 50 = 0 then concat(v, ':', split_part(l, ' ', 1)) end
 when v in ('PRES', 'HGT') and l = 'surface' then concat(v, ':sfc') when v in ('TMP', 'DPT') and l = '2 m above ground' then concat(v, ':2m') when v in ('UGRD', 'VGRD') and l = '10 m above ground' then concat(v, ':10m') end as key from {_INV}""")
def P17_inventory_keys(spark, sf_dir):
    key = parsers.inventory_key(F.col("v"), F.col("l"), F.col("s"))
    return query(spark, sf_dir, f"select * from {_INV}").select("p_partkey", key.alias("key"))


@register("select msg, file_id, k fh from (select msg, file_id, file_id % 9 - 1 a, file_id % 9 b, file_id % 9 - 6 c from $F14), (select unnest(range(9)) k) where b = k and a = k - 1 and c = k - 6")
def P18_pattern_match(spark, sf_dir):
    """Steps that name two hours before, against the pattern of each hour."""
    k = F.col("file_id") % 9
    rows = feed(spark, sf_dir, "F14").withColumn("step", F.concat((k - 1).cast("string"), F.lit("-"), k.cast("string"), F.lit(" since "), (k - 6).cast("string")))
    hours = spark.range(9).select(F.col("id").alias("fh"), C.filled_pattern(F.lit("^{fh_minus_1}-{fh} since {fh_minus_6}$"), F.col("id")).alias("pattern"))
    return rows.join(F.broadcast(hours), F.expr("regexp_like(step, pattern)")).select("msg", "file_id", "fh")  # nine hours


_ENDS = "(select file_id, msg, off, en as \"end\", lvl from $F14 join (select file_id, off, lead(off) over (partition by file_id order by off) - 1 en from (select distinct file_id, off from $F14)) using (file_id, off))"


@register(f"select file_id, msg, cast(off as bigint) off, cast(\"end\" as bigint) as \"end\" from {_ENDS}")
def W3_next_offsets(spark, sf_dir):
    return L.next_offsets(feed(spark, sf_dir, "F14")).select("file_id", "msg", F.col("off").cast("long").alias("off"), F.col("end").cast("long").alias("end"))


@register(f"""with recursive s as (select file_id, off, "end" e, row_number() over (partition by file_id order by off, "end" nulls last, msg) k from {_ENDS} where lvl in ('ECONOMY', 'PROMO', 'LARGE')),
 m as (select file_id, k, off b, e, 1 n, 1 g from s where k = 1 union all
  select s.file_id, s.k, case when j then m.b else s.off end, s.e, case when j then m.n + 1 else 1 end, case when j then m.g else m.g + 1 end from (select m.*, s.off o, s.e se, m.e is not null and s.off - m.e - 1 <= 20 j from m join s on s.file_id = m.file_id and s.k = m.k + 1) m join s on s.file_id = m.file_id and s.k = m.k + 1)
 select file_id, cast(b as bigint) off, cast(e as bigint) as "end", cast(n as bigint) n from m qualify row_number() over (partition by file_id, g order by k desc) = 1""")
def W4_coalesced_ranges(spark, sf_dir):
    """The spans of three kinds of messages, the last of a file without an end."""
    rows = L.next_offsets(feed(spark, sf_dir, "F14")).where("lvl in ('ECONOMY', 'PROMO', 'LARGE')")
    return L.coalesced(rows, 20).select("file_id", F.col("off").cast("long").alias("off"), F.col("end").cast("long").alias("end"), "n")


@register("select product, cast(floor(epoch(run)) as bigint) run, fh, obj, dense_rank() over (partition by product order by run desc) > 10 as purged from $F12")
def W6_newest_runs(spark, sf_dir):
    return L.newest_runs(feed(spark, sf_dir, "F12"), 10).select("product", _seconds("run").alias("run"), "fh", "obj", "purged")


_RUNS = "(select product, run, count(distinct fh) as hours, max(obj) % 7 > 0 as complete from $F12 group by 1, 2)"


@register(f"""with e as (select product, run, hours, row_number() over (partition by product order by run desc) n from {_RUNS} where complete), l as (select product, run, row_number() over (partition by product order by run desc) n from e where hours > 1)
 select r.product, cast(floor(epoch(r.run)) as bigint) run, r.hours, exists (select 1 from e where e.product = r.product and e.run = r.run and n <= 5) or exists (select 1 from l where l.product = r.product and l.run = r.run and n <= 4) as kept from {_RUNS} r""")
def W7_two_class_retention(spark, sf_dir):
    """Runs of which one in seven is partial."""
    runs = feed(spark, sf_dir, "F12").groupBy("product", "run").agg(F.count_distinct("fh").alias("hours"), (F.max("obj") % 7 > 0).alias("complete"))
    return L.two_class_retention(runs, 5, 4, 1).select("product", _seconds("run").alias("run"), "hours", "kept")


_EXP = "(select product, run, fh from (select distinct product, run from $F12), (select unnest(range(0, 49, 12)) fh))"


@register(f"""with p as (select distinct product, run, fh // 12 * 12 fh from $F12), j as (select e.*, p.fh is not null t from {_EXP} e left join p on p.product = e.product and p.run = e.run and p.fh = e.fh),
 c as (select *, row_number() over (partition by product, run order by fh) n, sum(t::int) over (partition by product, run order by fh) m from j)
 select product, cast(floor(epoch(run)) as bigint) run, cast(max(fh) as bigint) frontier, max(n) as hours from c where n = m group by 1, 2""")
def W8_publish_frontier(spark, sf_dir):
    f = feed(spark, sf_dir, "F12")
    expected = f.select("product", "run").distinct().withColumn("fh", F.explode(F.sequence(F.lit(0), F.lit(48), F.lit(12))))
    published = f.select("product", "run", (F.floor(F.col("fh") / 12) * 12).alias("fh"))
    return L.publish_frontier(expected, published).select("product", _seconds("run").alias("run"), F.col("frontier").cast("long").alias("frontier"), F.col("hours").cast("long").alias("hours"))


@register(f"""select product, cast(floor(epoch(run)) as bigint) run, cast(fh as bigint) fh from (select * from {_EXP} e where not exists (select 1 from $F12 r where r.obj % 2 = 0 and r.product = e.product and r.run = e.run and r.fh // 12 * 12 = e.fh)
 and exists (select 1 from $F12 r where r.product = e.product and r.run = e.run and r.fh // 12 * 12 = e.fh))""")
def J10_gaps(spark, sf_dir):
    f = feed(spark, sf_dir, "F12").withColumn("fh", F.floor(F.col("fh") / 12) * 12)
    needed = f.select("product", "run").distinct().withColumn("fh", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(48).cast("long"), F.lit(12).cast("long"))))
    rows = L.gaps(needed, f.where("obj % 2 = 0").select("product", "run", "fh"), f.select("product", "run", "fh"), ["product", "run", "fh"])
    return rows.select("product", _seconds("run").alias("run"), "fh")


_EV = lambda t: f"(select event_id id, user_id % 20 as key, EPOCH(ts) t from events where event_type = '{t}')"


@register(f"select a.id, a.t, max(b.t) ct from {_EV('click')} a left join {_EV('view')} b on a.key = b.key and b.t between a.t - 3600 and a.t + 900 group by 1, 2")
def J5_as_of(spark, sf_dir):
    rows = lambda t: query(spark, sf_dir, f"select * from {_EV(t)}")
    return L.as_of(rows("click"), rows("view").withColumnRenamed("id", "obj"), 3600, 900).select("id", "t", "ct")


@register("""with w as (select event_id id, EPOCH(ts) // 3600 * 3600 t from events), r as (select distinct 1704067200 + EPOCH(o_orderdate) // 86400 % 30 * 86400 + o_orderkey % 3 * 28800 run from orders),
 o as (select * from (values (0, 0), (1, 3600), (2, -3600), (3, -7200), (4, -10800), (5, 7200), (6, 10800)) x(rk, off))
 select id, run, off as "offset" from (select id, run, off, row_number() over (partition by id order by rk) n from w join o on true join r on r.run = t + off) where n = 1""")
def J6_nearest_run_of_all(spark, sf_dir):
    """J6 over every event; orders stand for runs at 0, 8 and 16 hours of the events' days, so one hour in eight has none near."""
    wanted = query(spark, sf_dir, "select event_id id, EPOCH(ts) div 3600 * 3600 t from events")
    there = query(spark, sf_dir, "select 1704067200 + EPOCH(o_orderdate) div 86400 % 30 * 86400 + o_orderkey % 3 * 28800 run from orders")
    return L.walk_back(wanted, there, [0, 3600, -3600, -7200, -10800, 7200, 10800])


_CYCLES = """select case when o_orderkey % 5 = 0 then 'ru' when o_orderkey % 5 = 1 then 'hourly' else 'gfs' end source, 1704067200 + EPOCH(o_orderdate) div 86400 % 30 * 86400 + case when o_orderkey % 5 = 0 then o_orderkey % 96 * 900 when o_orderkey % 5 = 1 then o_orderkey % 24 * 3600 else o_orderkey % 4 * 21600 end cycle,
 case when o_orderkey % 5 < 2 then 0 else o_custkey % 20 end fhr from orders"""


@register(f"""with th as (select distinct source, cycle, fhr from ({_CYCLES.replace(' div ', ' // ')})), w as (select event_id id, EPOCH(ts) t from events),
 c as (select id, t, 0 rk, 'ru' source, t // 900 * 900 - k * 900 cycle from w, (select unnest(range(11)) k) where t - (t // 900 * 900 - k * 900) <= 9000 union all select id, t, 1, 'hourly', t // 3600 * 3600 - k * 3600 from w, (select unnest(range(4)) k) where t - (t // 3600 * 3600 - k * 3600) <= 12600
  union all select id, t, 2, 'gfs', t // 21600 * 21600 - k * 21600 from w, (select unnest(range(4)) k) where t - (t // 21600 * 21600 - k * 21600) <= 64800),
 h as (select *, case when rk < 2 then 0 else cast(round_even((t - cycle) / 3600.0e0, 0) as bigint) end fhr from c)
 select id, h.source, h.cycle, h.fhr from h join th on th.source = h.source and th.cycle = h.cycle and th.fhr = h.fhr qualify row_number() over (partition by id order by rk, t - h.cycle) = 1""")
def J6_newest_cycles(spark, sf_dir):
    """Every event's newest analysis of two kinds, else the newest forecast that is valid then."""
    sources = [("ru", 900, 9000, False), ("hourly", 3600, 12600, False), ("gfs", 21600, 64800, True)]
    return L.newest_cycles(query(spark, sf_dir, "select event_id id, EPOCH(ts) t from events"), query(spark, sf_dir, _CYCLES), sources)


@register("""select prefix, depth, bytes, objects, round_even(bytes * 100.0e0 / sum(bytes) over (partition by depth), 3) share from (
 select concat('v1/', source) prefix, 2 as depth, sum(n_chars) bytes, count(*) objects from documents group by 1 union all select concat('v1/', source, '/', lang), 3, sum(n_chars), count(*) from documents group by 1)""")
def A15_storage_rollup(spark, sf_dir):
    return L.rolled_up(feed(spark, sf_dir, "F13"))


_AGES = f"(select o_orderpriority p, o_totalprice size, {NOW} - EPOCH(o_orderdate) age from orders)"


@register(f"""select p, case when age < 86400 then '<1' when age < 172800 then '1-2' when age < 604800 then '2-7' else '>7' end bin, count(*) n, round_even(sum(size), 2) bytes, max(age) oldest from {_AGES} group by 1, 2""")
def A16_age_histogram(spark, sf_dir):
    rows = query(spark, sf_dir, f"select * from {_AGES}").withColumn("bin", L.age_bin(F.col("age")))
    return rows.groupBy("p", "bin").agg(F.count(F.lit(1)).alias("n"), F.bround(F.sum("size"), 2).alias("bytes"), F.max("age").alias("oldest"))


@register(f"select p, count(*) n from {_AGES} where age > 86400 * case p when '1-URGENT' then 100 else 700 end + 3600 group by 1")
def A17_stale_by_region(spark, sf_dir):
    window = F.when(F.col("p") == "1-URGENT", 100).otherwise(700) * 86400 + 3600
    return query(spark, sf_dir, f"select * from {_AGES}").where(F.col("age") > window).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


@register(f"select p, count(*) n, round_even(sum(size), 2) bytes, max(age) - min(age) span, max(age) - min(age) >= 86400 * 365 as ok from {_AGES} group by 1")
def A18_span_by_region(spark, sf_dir):
    span = F.max("age") - F.min("age")
    return query(spark, sf_dir, f"select * from {_AGES}").groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.bround(F.sum("size"), 2).alias("bytes"), span.alias("span"), (span >= 86400 * 365).alias("ok"))


@register("select product, cast(floor(epoch(max(run))) as bigint) newest from $F12 group by 1")
def A19_newest_source(spark, sf_dir):
    return feed(spark, sf_dir, "F12").groupBy("product").agg(F.max(_seconds("run")).alias("newest"))


@register("""select code, round_even(median(live_age), 4) mid, round_even(list_sort(list(live_age))[cast(round_even(0.9e0 * (count(*) - 1), 0) as bigint) + 1], 4) p90, round_even(median(live_age - source_age), 4) lag from $F16 group by 1""")
def A20_U3_median_and_rank(spark, sf_dir):
    rows = feed(spark, sf_dir, "F16").withColumn("lag", F.col("live_age") - F.col("source_age"))
    ages = L.at_places(rows, "code", "live_age", L.middle() | {"p90": L.nearest_rank(0.9)})
    lags = L.at_places(rows, "code", "lag", L.middle())
    mean = F.bround((F.col("low") + F.col("high")) / 2, 4)
    out = rows.select("code").distinct().alias("r")
    for found in (ages.select("code", mean.alias("mid"), F.bround("p90", 4).alias("p90")), lags.select("code", mean.alias("lag"))):
        out = out.join(found.withColumnRenamed("code", "__code"), F.col("code").eqNullSafe(F.col("__code")), "left").drop("__code")
    return out


@register("select product, count(*) n, bool_or(obj % 2 = 0) has_work from $F12 group by 1")
def A22_pending_work(spark, sf_dir):
    return feed(spark, sf_dir, "F12").groupBy("product").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("obj") % 2 == 0).alias("has_work"))


@register("select product, cast(floor(epoch(run)) as bigint) run from (select distinct product, run from $F12) qualify row_number() over (partition by product order by run desc) <= 5")
def A23_newest_run_list(spark, sf_dir):
    runs = feed(spark, sf_dir, "F12").groupBy("product").agg(F.slice(F.sort_array(F.collect_set(_seconds("run")), False), 1, 5).alias("runs"))  # as many as there are runs
    return runs.select("product", F.explode("runs").alias("run"))


_HOURS = "(select run, product, string_agg(cast(fh as string), ',' order by fh) h from (select distinct run, product, fh from $F12 where WHICH) group by 1, 2)"
_MAP = "(select run, concat('{', string_agg(concat('\"', product, '\":[', h, ']'), ',' order by product), '}') m from " + _HOURS + " group by 1)"


@register(f"select cast(floor(epoch(e.run)) as bigint) run, a.m available, e.m expected from {_MAP.replace('WHICH', 'true')} e left join {_MAP.replace('WHICH', 'obj % 2 = 0')} a on a.run = e.run")
def A24_manifest(spark, sf_dir):
    f = feed(spark, sf_dir, "F12")
    rows = L.manifest(f.where("obj % 2 = 0"), f)
    return rows.select(_seconds("run").alias("run"), F.to_json("available").alias("available"), F.to_json("expected").alias("expected"))


@register("""select o_custkey, sha256(string_agg(h, chr(10) order by h)) signature from (select o_custkey, sha256(concat('{"o_orderkey":', o_orderkey, ',"o_orderpriority":"', o_orderpriority, '"}')) h from orders) group by 1""")
def A27_signature(spark, sf_dir):
    """Orders by customer: the groups are small and grow in number with the table."""
    return L.signature(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderpriority")


@register("""with t as (select s_suppkey product, k tier, 1000 + s_suppkey * (7 + k * 3) % 900 - k * 250 bytes, 8 - k * 2 z from supplier, (select unnest(range(3)) k)),
 w as (select product, max(bytes) filter (where tier = 0) a, max(bytes) filter (where tier = 1) b, max(bytes) filter (where tier = 2) c from t group by 1), k as (select *, b <= 0.8e0 * a k1, c <= 0.8e0 * case when b <= 0.8e0 * a then b else a end k2 from w)
 select product, 0 as tier, cast(a as bigint) bytes, case when k1 then 8 when k2 then 6 else 4 end min_zoom from k union all select product, 1, b, case when k2 then 6 else 4 end from k where k1 union all select product, 2, c, 4 from k where k2""")
def W10_tier_inheritance(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("product"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("tier"))
    size = F.lit(1000) + F.col("product") * (F.lit(7) + F.col("tier") * 3) % 900 - F.col("tier") * 250
    return L.inherited_tiers(rows.select("product", "tier", size.cast("long").alias("bytes"), (F.lit(8) - F.col("tier") * 2).cast("int").alias("min_zoom")))


@register("""with m as (select distinct product, EPOCH(run) t from $F12 where obj % 2 = 0), u as (select product, t from m union select product, EPOCH(run) t from $F12 where obj % 2 = 1 and obj % 5 > 0 and product in (select product from m)),
 k as (select *, max(t) over (partition by product) x from u) select product, cast(16 as int) tile, t, cast(row_number() over (partition by product order by t desc) as int) place from k where t >= x - 2592000""")
def SO4_merged_stamps(spark, sf_dir):
    """Published stamps of which one in five is of other tiles."""
    f = feed(spark, sf_dir, "F12").select("product", "obj", F.when((F.col("obj") % 2 == 1) & (F.col("obj") % 5 == 0), 8).otherwise(16).alias("tile"), _seconds("run").alias("t"))
    return L.merged_stamps(f.where("obj % 2 = 0"), f.where("obj % 2 = 1"), 2592000)


@register("""with o as (select product, fh, max(obj) v from $F12 where obj % 3 <> 0 group by 1, 2), n as (select product, fh, max(obj) v from $F12 where obj % 5 = 0 group by 1, 2)
 select coalesce(o.product, n.product) product, coalesce(o.fh, n.fh) fh, coalesce(n.v, o.v) v, n.v is not null and n.v is distinct from o.v as changed from o full join n on o.product = n.product and o.fh = n.fh""")
def SO5_upsert(spark, sf_dir):
    f = feed(spark, sf_dir, "F12")
    newest = lambda rows: rows.groupBy("product", "fh").agg(F.max("obj").alias("v"))
    return L.upserted(newest(f.where("obj % 3 <> 0")), newest(f.where("obj % 5 = 0")), ["product", "fh"])


# catalog: the forecast calendar meets what is there


_MODELS = ", ".join(f"({i}, '{r['model']}', '{r['calendar']}')" for i, r in enumerate(C.model_rows()))
_SPAN = lambda t, k: f"cast(regexp_extract({t}, '(\\d+)\\.\\.(\\d+)/(\\d+)', {k}) as int)"
_CALENDARS = f"""md as (select * from (values {_MODELS}) t(k, model, cal)), pt as (select k, unnest(string_split(regexp_replace(trim(split_part(cal, ';', 1)), '^(seg|min) ', ''), ' + ')) x from md), pl as (select k, {_SPAN('x', 1)} a, {_SPAN('x', 2)} b, {_SPAN('x', 3)} s from pt),
 sy as (select k, {_SPAN('x', 1)} a, {_SPAN('x', 2)} b, {_SPAN('x', 3)} s, list_transform(string_split(regexp_extract(x, '\\[(.*)\\]', 1), ', '), lambda h: cast(h as int)) hs from (select k, split_part(cal, ';', 2) x from md where cal like '%syn%')),
 ca as (select k, model, h run_hour, a, b, s from md join pl using (k), (select unnest(range(24)) h) where not exists (select 1 from sy where sy.k = md.k and list_contains(hs, h)) union all select k, model, unnest(hs), a, b, s from md join sy using (k))"""


def _numbered(spark, names: list[str]) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(enumerate(names)), "k long, name string"))  # the catalog


@register(f"with {_CALENDARS} select o_orderkey, model, cast(o_orderkey % 24 as int) run_hour, cast(o_orderkey * 7 % 400 as int) fh from orders where exists (select 1 from ca where ca.k = o_custkey % 46 and run_hour = o_orderkey % 24 and o_orderkey * 7 % 400 between a and b and (o_orderkey * 7 % 400 - a) % s = 0)".replace("select o_orderkey, model", "select o_orderkey, (select model from md where md.k = o_custkey % 46) model"))
def C1_calendar(spark, sf_dir):
    """Orders, as frames of all models, that the models' calendars expect."""
    names = _numbered(spark, [r["model"] for r in C.model_rows()])
    k = F.col("o_orderkey")
    frames = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 46).alias("k"), (k % 24).cast("int").alias("run_hour"), (k * 7 % 400).cast("int").alias("fh"))
    frames = frames.join(names, "k").withColumnRenamed("name", "model")
    expected = C.calendar(C.models(spark)).select("model", "run_hour", "fh")
    return frames.join(maybe_broadcast(expected, 200_000), ["model", "run_hour", "fh"], "left_semi").select("o_orderkey", "model", "run_hour", "fh")


@register("""select o_orderkey, cast(floor((epoch(o_orderdate) - 5400) / 21600) as bigint) * 21600 - k * 21600 run from orders, (select unnest(range(3)) k)""")
def C2_candidate_runs(spark, sf_dir):
    runs = C.candidate_runs(F.col("o_orderdate").cast("timestamp"), 3, 6, 90)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(runs).alias("run")).select("o_orderkey", F.unix_timestamp("run").alias("run"))


_CODES = ", ".join(f"({i}, '{r['code']}', {r.get('fh_min', 'null')}, {r.get('fh_cap', 'null')}, {r.get('fh_step', 'null')})" for i, r in enumerate(C.product_rows()))


@register(f"""with {_CALENDARS}, pr as (select * from (values {_CODES}) t(c, code, lo, cap, st)), ls as (select distinct p_partkey % 46 k, p_partkey % 192 c from part), ex as (select distinct k, unnest(range(a, b + 1, s)) fh from ca where run_hour = 6),
 mi as (select s_suppkey % 46 k, s_suppkey % 192 c, max(s_suppkey % 9) fh from supplier group by 1, 2), cp as (select p_partkey % 46 k, p_partkey % 192 c, min(p_size + 20) fh from part where p_partkey % 4 = 0 group by 1, 2), sk as (select c_custkey % 46 k, c_custkey % 192 c, c_custkey % 40 a, c_custkey % 40 + 5 b from customer where c_custkey % 3 = 0)
 select model, code, cast(ex.fh as int) fh from ls join md using (k) join pr using (c) join ex using (k) left join mi on mi.k = ls.k and mi.c = ls.c left join cp on cp.k = ls.k and cp.c = ls.c
 where ex.fh >= greatest(coalesce(lo, 0), case c % 4 when 0 then 6 when 1 then 12 else 0 end, coalesce(mi.fh, 0)) and (cap is null or ex.fh <= cap) and (cp.fh is null or ex.fh <= cp.fh) and (st is null or ex.fh % st = 0)
 and not exists (select 1 from sk where sk.k = ls.k and sk.c = ls.c and ex.fh between sk.a and sk.b)""")
def P21_admissions(spark, sf_dir):
    """Products of all models at the hours of their runs at 6, with floors out of several patterns, and each model's own limits and skipped ranges."""
    models, codes = (_numbered(spark, [r[k] for r in rows]) for rows, k in ((C.model_rows(), "model"), (C.product_rows(), "code")))

    def named(rows: DataFrame, key: str, *columns) -> DataFrame:
        rows = rows.select((F.col(key) % 46).alias("mk"), (F.col(key) % 192).alias("ck"), *columns)
        rows = rows.join(models.select(F.col("k").alias("mk"), F.col("name").alias("model")), "mk").join(codes.select(F.col("k").alias("ck"), F.col("name").alias("code")), "ck")
        return rows.drop("mk", "ck")

    part, supplier, customer = (table(spark, sf_dir, t) for t in ("part", "supplier", "customer"))
    patterns = F.when(F.col("k") % 4 == 0, F.array(F.lit("APCP:{fh_minus_1}-{fh} hour, {fh_minus_6}-{fh} hour"))).when(F.col("k") % 4 == 1, F.array(F.lit("x:{fh_minus_12}"), F.lit(None), F.lit("y:{fh_minus_3}"))).otherwise(F.array(F.lit("TMP")))
    products = C.products(spark).join(codes.select(F.col("name").alias("code"), patterns.alias("patterns")), "code")
    expected = C.calendar(C.models(spark)).where("run_hour = 6")
    mins = named(supplier, "s_suppkey", (F.col("s_suppkey") % 9).alias("fh"))
    caps = named(part.where("p_partkey % 4 = 0"), "p_partkey", (F.col("p_size") + 20).alias("fh"))
    skips = named(customer.where("c_custkey % 3 = 0"), "c_custkey", (F.col("c_custkey") % 40).alias("lo"), (F.col("c_custkey") % 40 + 5).alias("hi"))
    return C.admissions(named(part, "p_partkey"), products, expected, mins, caps, skips).select("model", "code", F.col("fh").cast("int").alias("fh"))


@register("select obj, fh from $F12 where fh >= 6 and fh <= 36 and fh % 3 = 0 and fh not between 12 and 18")
def P21_admission(spark, sf_dir):
    floor = F.greatest(C.implied_floor(F.lit("APCP:{fh_minus_1}-{fh}"), F.lit("APCP:{fh_minus_6}-{fh}")), F.lit(3))
    ok = C.admitted(F.col("fh"), floor, F.lit(36), F.lit(3), [(12, 18)])
    return feed(spark, sf_dir, "F12").where(ok).select("obj", "fh")


@register("select obj, concat('gfs.20240101/', lpad(cast(obj % 24 as string), 2, '0'), '/f', lpad(cast(fh as string), 3, '0'), '.', cast(ceil(fh / 60.0e0) as bigint)) as key from $F12")
def ST2_object_keys(spark, sf_dir):
    key = C.object_key(F.lit("gfs.{date}/{run:02d}/f{fh:03d}.{fhour}"), F.lit("20240101"), F.col("obj") % 24, F.col("fh"))
    return feed(spark, sf_dir, "F12").select("obj", key.alias("key"))


_UNITS = ", ".join(f"({i}, '{r['units']}', '{r['class']}')" for i, r in enumerate(C.product_rows()))


@register(f"select event_id, u units, cl as \"class\" from events join (values {_UNITS}) t(k, u, cl) on k = event_id % 192")
def S11_catalog(spark, sf_dir):
    """Events with the units and class of the product that they name; all products are named."""
    code = F.element_at(F.array(*(F.lit(r["code"]) for r in C.product_rows())), (F.col("event_id") % 192 + 1).cast("int"))
    units = F.broadcast(C.products(spark).select("code", "units", "class"))  # the catalog: 192 rows
    return table(spark, sf_dir, "events").select("event_id", code.alias("code")).join(units, "code").select("event_id", "units", "class")


# streams: run to the end of what is there, into a table


def _drained(spark: SparkSession, sf_dir: str, make, closing: bool = False) -> DataFrame:
    """What ``make`` (of a function that opens the events as a stream) gives for all events.

    The ranges of time come in one after another, each in one trigger, so event
    time never runs backwards and no row is late.  They begin at whole hours, so
    no hour lies in two.  ``closing`` puts a row without values a day after the
    last, which moves the watermark past all windows but its own.
    """
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_timestamp("ts")
    middle = rows.select(F.avg(seconds)).first()[0]
    cuts = [] if middle is None else [int(middle // 3600 * 3600)]
    parts = [rows.where(F.lit(a is None) | (seconds >= a)).where(F.lit(b is None) | (seconds < b)) for a, b in zip([None, *cuts], [*cuts, None], strict=True)]
    if closing:
        parts.append(_closing(rows))
    return _fed(spark, parts, make)


def _closing(rows: DataFrame) -> DataFrame:
    """A row without values, a day after the last."""
    end = rows.agg((F.max("ts") + F.expr("interval 1 day")).alias("ts"))
    return end.select(*(F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema))


def _fed(spark: SparkSession, parts: list[DataFrame], make, mode: str = "append", run=None) -> DataFrame | None:
    """What the stream gives when the parts come in one after another, each in a run of its own from the last checkpoint.

    With ``run``, for ``foreachBatch``, what it does is the result.
    """
    path = work_path(spark, "stream")
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        stream = make(lambda: spark.readStream.schema(parts[0].schema).parquet(f"{path}/in"))
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
        if run is not None:
            writer = writer.foreachBatch(run)
        elif mode == "append":
            writer = writer.format("parquet").option("path", f"{path}/out")
        else:  # files hold no updates, so each batch is a folder, which a repeated batch replaces
            writer = writer.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{path}/out/batch={i}"))
        writer.start().awaitTermination()
    return None if run is not None else spark.read.schema(stream.schema).parquet(f"{path}/out")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of a few files, for queries that take them in any order."""
    path = work_path(spark, "events")
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


@register("select distinct cast(user_id % 50 * 100 as bigint) cy, cast((-(user_id % 40) - 60) * 100 as bigint) cx, cast(floor(EPOCH(ts) / 30) as bigint) tb from events")
def K1_rolling_flashes(spark, sf_dir):
    """The cells and bins with a flash; which of those in one bin comes first isn't fixed by the data."""
    flashes = lambda e: e.select("event_id", "ts", (F.col("user_id") % 50 + 0.0).alias("lat"), (-F.col("user_id") % 40 - 60.0).alias("lon"))
    return _drained(spark, sf_dir, lambda events: K.rolling_flashes(flashes(events()))).select("cy", "cx", "tb")


_DENSE = "(select event_id, user_id % 50 + 0.0e0 lat, -(user_id % 40) - 60.0e0 lon, 1704067200 + EPOCH(ts) % 7200 as epoch from events)"


@register(f"""with m as (select max(epoch) // 30 * 30 + 30 m from {_DENSE}), x as (select *, epoch >= m - 1800 n from {_DENSE}, m where epoch >= m - 3600)
 select event_id, epoch from (select event_id, epoch from x qualify row_number() over (partition by n, round_even(lat / case when n then 0.01e0 else 0.08e0 end, 0), round_even(lon / case when n then 0.01e0 else 0.08e0 end, 0),
 floor(epoch / case when n then 30 else 120 end) order by epoch desc, event_id) = 1) order by epoch desc, event_id limit 60000""")
def K1_flash_feed(spark, sf_dir):
    """The feed after the last of three passes; each pass adds the flashes that came in since, folded into two hours."""
    rows = query(spark, sf_dir, f"select * from {_DENSE}")
    feed = FlashFeed(spark, work_path(spark, "flashes"))
    _fed(spark, [rows.where(F.col("event_id") % 3 == k) for k in range(3)], lambda flashes: feed.changes(flashes()), "update", feed.run)
    return feed.published().select("event_id", "epoch")


@register("select user_id station_id, event_type param, cast(EPOCH(ts) // 3600 * 3600 as bigint) as hour, max(cast(floor(value) as int)) aqi from events group by 1, 2, 3")
def K2_hourly_max_stream(spark, sf_dir):
    readings = lambda e: e.select(F.col("user_id").alias("station_id"), F.col("event_type").alias("param"), "ts", F.floor("value").cast("int").alias("aqi"))
    return _drained(spark, sf_dir, lambda events: K.hourly_max(readings(events())), closing=True).select("station_id", "param", _seconds("hour").alias("hour"), "aqi")


_K3 = "(select cast(user_id % 20 as string) k, EPOCH(ts) e, value v from events)"


@register(f"select k as key, max(e) epoch, max(v) filter (where e = m) as \"value\" from (select *, max(e) over (partition by k) m from {_K3}) group by 1")
def K3_newest_wins_stream(spark, sf_dir):
    """The last value that each key had, out of all the changes that the stream put out."""
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 20).cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value"))
    middle = rows.select(F.avg(F.unix_timestamp("ts"))).first()[0] or 0
    early = F.unix_timestamp("ts") < middle
    changes = _fed(spark, [rows.where(early), rows.where(~early)], lambda events: K.newest_wins(events()), "update")
    return changes.groupBy("key").agg(F.max_by(F.struct("epoch", "value"), F.struct("epoch", "value")).alias("b")).select("key", "b.epoch", "b.value")


@contextmanager
def _rocks(spark: SparkSession):
    """State that is kept in RocksDB, as arbitrary state needs it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@register(f"select station_id, param, cast(floor(epoch(hour)) as bigint) as hour, aqi from {CARRIED}")
def K3_carried_forward_stream(spark, sf_dir):
    """Every reading of all hours, and the hours after it that it is held for."""
    named = F.when(F.col("event_type") == "click", "OZONE").when(F.col("event_type") == "view", "PM2.5").when(F.col("event_type") == "purchase", "PM10").otherwise("OTHER")
    readings = lambda e: e.select(F.col("user_id").alias("station_id"), named.alias("param"), "ts", F.floor("value").cast("int").alias("aqi"))
    ship(spark)
    with _rocks(spark):
        rows = _drained(spark, sf_dir, lambda events: K.carried_forward(readings(events())), closing=True)
    return rows.select("station_id", "param", _seconds("hour").alias("hour"), "aqi")


@register("select user_id station_id, event_type param, cast(EPOCH(ts) // 3600 * 3600 as bigint) as hour, max(cast(floor(value) as int)) aqi from events where not (event_id % 10 = 0 and ts < (select max(ts) from events) - interval 1 day) group by 1, 2, 3")
def K4_late_rows_are_dropped(spark, sf_dir):
    """A tenth of the events come when the watermark has passed their hours, and don't count."""
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    end = rows.agg((F.max("ts") - F.expr("interval 1 day")).alias("end"))
    late = rows.crossJoin(F.broadcast(end)).withColumn("late", (F.col("event_id") % 10 == 0) & (F.col("ts") < F.col("end"))).drop("end")  # one row
    parts = [late.where("not late").drop("late"), late.where("late").drop("late"), _closing(rows)]
    readings = lambda e: e.select(F.col("user_id").alias("station_id"), F.col("event_type").alias("param"), "ts", F.floor("value").cast("int").alias("aqi"))
    return _fed(spark, parts, lambda events: K.hourly_max(readings(events()))).select("station_id", "param", _seconds("hour").alias("hour"), "aqi")


_OVERLAP = 10 * 86400


@register(f"""select user_id station_id, event_type param, cast(EPOCH(ts) // 3600 * 3600 as bigint) as hour, max(cast(floor(value) as int)) aqi from events
 where event_id % 10 <> 0 or EPOCH(ts) // 86400 * 86400 >= (select max(EPOCH(ts) // 86400 * 86400) from events) - {_OVERLAP} group by 1, 2, 3""")
def K4_recomputed_overlap(spark, sf_dir):
    """A tenth of the events come last: those within the overlap count in their hours again, the others are dropped."""
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = work_path(spark, "overlap")
    kinds = "station_id long, param string, hour long, aqi int, day long"
    raw, out = SlotTable(spark, f"{path}/raw", kinds, "day"), SlotTable(spark, f"{path}/hours", kinds, "day")
    hour = F.expr("unix_timestamp(ts) div 3600 * 3600")
    readings = lambda e: e.select(F.col("user_id").alias("station_id"), F.col("event_type").alias("param"), hour.alias("hour"), F.floor("value").cast("int").alias("aqi"), F.expr("unix_timestamp(ts) div 86400 * 86400").alias("day"))
    hourly = lambda r: r.groupBy("station_id", "param", "hour").agg(F.max("aqi").alias("aqi"), F.first("day").alias("day"))
    late, week = F.col("event_id") % 10 == 0, F.floor(F.unix_timestamp("ts") / (8 * 86400))
    weeks = [r[0] for r in rows.select(week).distinct().orderBy(week).collect()]  # of 30 days
    _fed(spark, [*(rows.where(~late & (week == w)) for w in weeks), rows.where(late)], lambda events: readings(events()), run=recomputing(raw, out, _OVERLAP, hourly))
    return out.read().select("station_id", "param", "hour", "aqi")


@register("select event_id, 1 as times from events")
def K5_incremental_ingest(spark, sf_dir):
    """Granules come in three lots; a run takes only what the runs before it didn't, so each event is parsed once."""
    rows = table(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "value")).alias("line"), (F.col("event_id") % 3).alias("lot"))
    parts = [rows.where(F.col("lot") == k).select("line") for k in range(3)]
    parsed = _fed(spark, parts, lambda granules: K.ingested(granules(), "event_id long, value double"))
    return parsed.groupBy("event_id").agg(F.count(F.lit(1)).cast("int").alias("times"))


@register("select a.user_id % 20 as key, a.event_id id, b.event_id obj from events a join events b on a.event_type = 'click' and b.event_type = 'view' and a.user_id % 20 = b.user_id % 20 and b.ts between a.ts - interval 3600 seconds and a.ts + interval 900 seconds")
def K6_companion_stream(spark, sf_dir):
    left = lambda e: e.where("event_type = 'click'").select((F.col("user_id") % 20).alias("key"), F.col("ts").alias("t"), F.col("event_id").alias("id"))
    right = lambda e: e.where("event_type = 'view'").select((F.col("user_id") % 20).alias("key"), F.col("ts").alias("ct"), F.col("event_id").alias("obj"))
    return _drained(spark, sf_dir, lambda events: K.companions(left(events()), right(events()), 3600, 900)).select("key", "id", "obj")


def _upserted(spark: SparkSession, stream: DataFrame, schema: str, keys: list[str], order: list[str]) -> DataFrame:
    """The table of slots after all batches; a day's slots are one folder."""
    path = work_path(spark, "slots")
    slots = SlotTable(spark, f"{path}/table", schema, "day")
    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer.foreachBatch(upserting(slots, keys, order)).start().awaitTermination()
    return slots.read()


def _slotted(stream: DataFrame, *columns) -> DataFrame:
    """By hour, and the day that the hour is kept with."""
    at = F.unix_timestamp("ts")
    return stream.select((F.col("user_id") % 50).alias("product"), F.floor(at / 3600).alias("slot"), *columns, F.col("event_id").alias("payload"), F.floor(at / 86400).alias("day"))


@register("select user_id % 50 as product, EPOCH(ts) // 3600 as slot, max(event_id) filter (where event_id % 2 = p) as payload, p as pass from (select *, max(event_id % 2) over (partition by user_id % 50, EPOCH(ts) // 3600) p from events) group by 1, 2, 4")
def K7_final_overwrites(spark, sf_dir):
    e = _slotted(_event_stream(spark, sf_dir), (F.col("event_id") % 2).alias("pass"))
    return _upserted(spark, e, "product long, slot long, pass long, payload long, day long", ["product", "slot"], ["pass"]).select("product", "slot", "pass", "payload")


@register("select user_id % 50 as product, EPOCH(ts) // 3600 as slot, max(EPOCH(ts)) src, arg_max(event_id, EPOCH(ts) * 1000000 + event_id) as payload from events group by 1, 2")
def K8_slot_overwrites(spark, sf_dir):
    e = _slotted(_event_stream(spark, sf_dir), F.unix_timestamp("ts").alias("src"))
    return _upserted(spark, e, "product long, slot long, src long, payload long, day long", ["product", "slot"], ["src"]).select("product", "slot", "src", "payload")
