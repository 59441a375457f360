"""Queries for the rarer branches of some operators, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.functions import scalar as S
from isobar.operators import grids as G
from isobar.operators import listings as L
from isobar.operators import volumes as V
from isobar.plans import catalog as C
from isobar.plans.points import register
from isobar.sources import parsers
from isobar.sources.adapters import NOW, feed, query, table

_CODES = "(select event_id, cast(event_id % 30 - 8 as int) a, cast(user_id % 3 as int) b from events)"


@register(f"""select event_id, case when b = 0 then case a when 1 then '1h' when 3 then '3h' when 6 then '6h' when 12 then '12h' when 18 then '18h' when -1 then 'local-midnight' when -2 then 'utc-midnight' when -3 then '24h'
 when -4 then '5m' when -5 then '15m' end end as period from {_CODES}""")
def P12_accumulation_period(spark, sf_dir):
    return query(spark, sf_dir, f"select * from {_CODES}").select("event_id", S.accumulation_period(F.col("a"), F.col("b")).alias("period"))


@register("select c_custkey, concat('name=', c_name, case when c_custkey % 3 = 0 then '' else concat(',seg=', c_mktsegment) end) props from customer")
def P16_property_pruning(spark, sf_dir):
    props = F.map_from_arrays(F.array(F.lit("name"), F.when(F.col("c_custkey") % 3 == 0, "AREA").otherwise("seg"), F.lit("Perimeter")), F.array("c_name", "c_mktsegment", F.lit("7")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", S.pruned(props, ("area", "perimeter")).alias("p"))
    text = F.array_join(F.transform(F.map_entries("p"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return rows.select("c_custkey", text.alias("props"))


_BOX = "(select c_custkey k, cast(-125 + c_custkey % 30 as double) w, cast(20 + c_custkey % 11 as double) s, cast(5 + c_custkey % 50 as double) dx, cast(4 + c_custkey % 23 as double) dy from customer)"
_MERC = "ln(tan(0.7853981633974483e0 + radians({}) / 2)) * 6378137.0e0"


@register(f"""select k, cast(wd as int) width, cast(least(round_even(wd * h / x, 0), 4096) as int) height from (select *, greatest(2048, least(round_even(x / 1200, 0), 4096)) wd
 from (select k, radians(dx) * 6378137.0e0 x, {_MERC.format('(s + dy)')} - {_MERC.format('s')} h from {_BOX}))""")
def M5_region_size(spark, sf_dir):
    width, height = S.region_size(F.col("w"), F.col("s"), F.col("w") + F.col("dx"), F.col("s") + F.col("dy"), 1200.0)
    return query(spark, sf_dir, f"select * from {_BOX}").select("k", width.alias("width"), height.alias("height"))


@register("select o_orderkey, n, t from (select o_orderkey, cast(row_number() over (partition by o_orderkey order by t desc) - 1 as int) n, t from (select o_orderkey, cast(floor(epoch(o_orderdate) / 3600) as bigint) * 3600 - k * 3600 t from orders, (select unnest(range(10)) k)) where t % 10800 = 0)")
def C2_allowed_hours(spark, sf_dir):
    runs = C.hourly_runs(F.col("o_orderdate").cast("timestamp"), 9, tuple(range(0, 24, 3)))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(runs).alias("n", "run"))
    return rows.select("o_orderkey", "n", F.unix_timestamp("run").alias("t"))


@register("select event_id, cast(12 - k as int) n, cast(floor((EPOCH(ts) - 2400) / 600) as bigint) * 600 - k * 600 t from events, (select unnest(range(13)) k)")
def C2_dense_slots(spark, sf_dir):
    slots = C.slots(F.col("ts").cast("timestamp"), 120, 10, 40)
    rows = table(spark, sf_dir, "events").select("event_id", F.posexplode(slots).alias("n", "at"))
    return rows.select("event_id", "n", F.unix_timestamp("at").alias("t"))


_VOX = "(select r, c, field - 1 lvl, cast(floor(v * 1.6e0) as int) ref, cast((r * 7 + c * 3 + field) % 256 as int) cc, cast((r + c * 5 + field * 11) % 256 as int) rot from $F9)"


@register(f"""with x as (select *, r // 20 tr, c // 20 tc from {_VOX}), s as (select * from x qualify row_number() over (partition by tr, tc order by ref desc, lvl, r, c) = 1),
 k as (select r, c, max(lvl) k from x where ref >= 102 group by 1, 2), n as (select tr, tc, count(*) filter (where ref >= 126 and cc > 50) debris, count(*) filter (where ref >= 76 and abs(rot - 128) >= 30) rotation from x group by 1, 2)
 select s.tr, s.tc, case when ref >= 2 then (ref - 2) / 2.0e0 - 32 end max_dbz, (coalesce(k, -1) + 1) * 500 / 1000.0e0 top_km, coalesce(k, -1) >= 6 as clipped, debris, rotation from s join n on n.tr = s.tr and n.tc = s.tc left join k on k.r = s.r and k.c = s.c""")
def A8_tile_summary(spark, sf_dir):
    codes = feed(spark, sf_dir, "F9").select(
        "r", "c", (F.col("field") - 1).alias("lvl"), F.floor(F.col("v") * 1.6).cast("int").alias("ref"),
        ((F.col("r") * 7 + F.col("c") * 3 + F.col("field")) % 256).cast("int").alias("cc"), ((F.col("r") + F.col("c") * 5 + F.col("field") * 11) % 256).cast("int").alias("rot"),
    )
    rows = G.tile_summary(codes, 20, 7, 500.0)
    return rows.select(F.col("tr").cast("long").alias("tr"), F.col("tc").cast("long").alias("tc"), F.col("max_dbz").cast("double").alias("max_dbz"), F.col("top_km").cast("double").alias("top_km"), "clipped", "debris", "rotation")


@register("select fh from (select distinct fh, product, obj % 2 l from $F12) group by fh having count(*) = 10")
def A11_complete_variables_and_levels(spark, sf_dir):
    rows = feed(spark, sf_dir, "F12").select("fh", F.col("product").alias("var"), (F.col("obj") % 2).alias("level"))
    return V.complete_hours(rows, rows.select("var", "level").distinct())


_WIND = "(select col_id site, height_m pressure, case when (col_id + height_m) % 7 > 0 then height_m end h, v u, v - 20 v, case when col_id % 3 > 0 or height_m % 500 = 0 then v end t, case when col_id % 2 = 0 then v - 5 end td from $F10)"


@register(f"""select site, string_agg(cast(pressure as string), ',' order by pressure desc) ps, cast(sum(u) as bigint) su, case when count(t) = count(*) then cast(sum(t) as bigint) end st, case when count(td) = count(*) then cast(sum(td) as bigint) end std
 from {_WIND} where h is not null group by 1 having count(*) >= 4""")
def A12_wind_profiles(spark, sf_dir):
    rows = V.wind_profiles(query(spark, sf_dir, f"select * from {_WIND}"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x).cast("long")
    return rows.select("site", F.array_join(F.transform("pressure", lambda x: x.cast("string")), ",").alias("ps"), total("u").alias("su"), total("t").alias("st"), total("td").alias("std"))


@register("""select prefix, depth, bytes, objects from (select concat('v1/', source) prefix, 2 as depth, sum(n_chars) bytes, count(*) objects from documents group by 1 union all select concat('v1/', source, '/', lang), 3, sum(n_chars), count(*) from documents group by 1)
 qualify row_number() over (partition by depth order by bytes desc, prefix) <= 18""")
def A15_largest_prefixes(spark, sf_dir):
    return L.top_prefixes(L.rolled_up(feed(spark, sf_dir, "F13"))).select("prefix", "depth", "bytes", "objects")


_VERSIONS = f"(select o_orderpriority p, o_custkey as key, EPOCH(o_orderdate) t, o_orderkey % 1000 + 1 size from orders)"


@register(f"""select p, cast(sum(size) as bigint) bytes, cast(sum(case when t = m then 0 else size end) as bigint) overhead, cast(sum(case when t < m and {NOW} - t > 1000 * 86400 then size else 0 end) as bigint) past,
 sum(case when t < m and {NOW} - t > 1000 * 86400 then size else 0 end) * 100 > sum(case when t = m then 0 else size end) * 25 as stale from (select *, max(t) over (partition by p, key) m from {_VERSIONS}) group by 1""")
def A16_version_overhead(spark, sf_dir):
    return L.version_overhead(query(spark, sf_dir, f"select * from {_VERSIONS}"), "p", NOW, days=1000)


@register("""with p as (select distinct run, fh from $F12 where obj % 3 = 0), n as (select product, count(*) k from (select product, run, fh from $F12 where obj % 4 = 1) x where exists (select 1 from p where p.run = x.run and p.fh = x.fh) group by 1),
 g as (select distinct substr(product, 1, 1) grp, product from $F12) select grp, cast(coalesce(sum(k), 0) as bigint) frames, count(k) products, coalesce(sum(k), 0) > 0 as has_work from g left join n using (product) group by 1""")
def A22_pending_groups(spark, sf_dir):
    f = feed(spark, sf_dir, "F12")
    groups = f.select(F.substring("product", 1, 1).alias("grp"), "product").distinct()
    return L.pending_groups(f.where("obj % 4 = 1").select("product", "run", "fh"), f.where("obj % 3 = 0"), groups)


_MAN = "(select o_orderpriority product, EPOCH(o_orderdate) // 86400 run, max(o_orderkey) src, 0 as e from orders where o_orderkey % 3 > 0 and o_orderdate < (select max(o_orderdate) from orders) - interval 90 day group by 1, 2)"
_UPD = "(select o_orderpriority product, EPOCH(o_orderdate) // 86400 run, max(o_orderkey) src from orders where o_orderkey % 5 = 0 group by 1, 2)"


@register(f"""with m as (select product, cast(run as bigint) run, src, '' a from {_MAN}), u as (select product, cast(run as bigint) run, src from {_UPD}), w as (select product from m where run = (select max(run) from m)),
 n as (select product, run, cast(null as bigint) src, '' a from (select distinct run from u where run not in (select run from m)), w), j as (select x.product, x.run, x.src, u.src nw from (select * from m union all select * from n) x left join u on u.product = x.product and u.run = x.run)
 select product, run, coalesce(nw, src) src, case when nw is not null and nw is distinct from src then '0' else '' end available, nw is not null and nw is distinct from src as changed from j""")
def SO5_patched_runs(spark, sf_dir):
    """Source times come into runs, some of them new ones."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("product"), F.expr("unix_timestamp(cast(o_orderdate as timestamp)) div 86400").alias("run"), "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("d"))
    end = orders.agg((F.max("d") - F.expr("interval 90 days")).alias("end"))
    old = orders.crossJoin(F.broadcast(end)).where("o_orderkey % 3 > 0 and d < end").groupBy("product", "run").agg(F.max("o_orderkey").alias("src"))  # one row
    manifest = old.withColumns({"expected": F.array(F.lit(0)), "available": F.array().cast("array<int>")})
    updates = orders.where("o_orderkey % 5 = 0").groupBy("product", "run").agg(F.max("o_orderkey").alias("src"))
    rows = L.patched_runs(manifest, updates)
    return rows.select("product", "run", "src", F.array_join(F.transform("available", lambda x: x.cast("string")), ",").alias("available"), "changed")


@register("""select field, r, c, cast(case when w is null or w > 1.05e0 then 0 else greatest(0, least(round_even((1.05e0 - w) * 200, 0), 255)) end as int) cc, cast(greatest(0, least(round_even(128 + x * 5000, 0), 255)) as int) rot
 from (select *, v / 80 w, (v - 40) / 1000 x from $F9)""")
def M12_volume_codes(spark, sf_dir):
    rows = feed(spark, sf_dir, "F9").withColumns({"w": F.col("v") / 80, "x": (F.col("v") - 40) / 1000})
    return rows.select("field", "r", "c", S.byte_correlation(F.col("w")).cast("int").alias("cc"), S.byte_rotation(F.col("x")).cast("int").alias("rot"))


_SRC = "select run, product, case when max(obj) % 7 > 0 then max(obj) end t from $F12 group by 1, 2"


@register(f"""with m as (select distinct run from $F12), s as (select run, concat('{{', string_agg(concat('"', product, '":', t), ',' order by product), '}}') j from ({_SRC}) where t is not null group by 1)
 select cast(floor(epoch(m.run)) as bigint) run, s.j src_times from m left join s on s.run = m.run""")
def A24_source_times(spark, sf_dir):
    f = feed(spark, sf_dir, "F12")
    newest = f.groupBy("run", "product").agg(F.max("obj").alias("o")).select("run", "product", F.when(F.col("o") % 7 > 0, F.col("o")).alias("t"))
    rows = L.with_sources(L.manifest(f, f), newest)
    return rows.select(F.unix_timestamp(F.col("run").cast("timestamp")).alias("run"), F.to_json("src_times").alias("src_times"))


_SIGNED = """(select o_custkey, sha256(string_agg(h, chr(10) order by h)) s from (select o_custkey, sha256(concat('{"o_orderkey":', o_orderkey, ',"o_orderpriority":"', o_orderpriority, '"}')) h from orders WHERE) group by 1)"""


@register(f"""select n.o_custkey, n.s is distinct from a.s and n.s is distinct from b.s as changed from {_SIGNED.replace('WHERE', '')} n left join {_SIGNED.replace('WHERE', 'where o_orderkey % 7 <> 0')} a on a.o_custkey = n.o_custkey
 left join {_SIGNED.replace('WHERE', 'where o_orderkey % 11 <> 0')} b on b.o_custkey = n.o_custkey""")
def A27_changed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    signed = lambda rows: L.signature(rows, "o_custkey", "o_orderkey", "o_orderpriority")
    rows = L.changed_signatures(signed(orders), signed(orders.where("o_orderkey % 7 <> 0")), signed(orders.where("o_orderkey % 11 <> 0")), "o_custkey")
    return rows.select("o_custkey", "changed")


_Y = "ln(tan(0.7853981633974483e0 + radians({}) / 2)) * 6378137.0e0"
_LAT = lambda k: f"(50 - (degrees(2 * atan(exp((y1 - {k} * (y1 - y0) / 90) / 6378137.0e0))) - 90)) / 0.13e0"
_LON = lambda k: f"(-120 + {k} * 50 / 120 + 125) / 0.3e0"
_IMAGE = f"""li as (select i, {_LAT('(i + 0.5e0)')} mid, {_LAT('i')} t, {_LAT('(i + 1)')} b from (select unnest(range(90)) i, {_Y.format('28.0e0')} y0, {_Y.format('48.0e0')} y1)),
 co as (select j, {_LON('(j + 0.5e0)')} mid, {_LON('j')} t, {_LON('(j + 1)')} b from (select unnest(range(120)) j))"""
_TWO = lambda d: f"(select * from (select * exclude (mid, t, b), cast(floor(mid - 0.5e0) as bigint) s, 1 - (mid - 0.5e0 - floor(mid - 0.5e0)) w from {d} union all select * exclude (mid, t, b), cast(floor(mid - 0.5e0) as bigint) + 1, mid - 0.5e0 - floor(mid - 0.5e0) from {d}) where w > 0)"
_NEAR = "select field, i, j, v from {} s join li on s.r = floor(li.mid) join co on s.c = floor(co.mid)"
_MAX = "select field, i, j, max(v) v from {} s join li on s.r < li.b and s.r + 1 > li.t join co on s.c < co.b and s.c + 1 > co.t group by 1, 2, 3"
_FOUR = "select field, i, j, sum(v * x.w * y.w) / sum(x.w * y.w) v from {} s join " + _TWO("li") + " x on x.s = s.r join " + _TWO("co") + " y on y.s = s.c group by 1, 2, 3"


def _image(spark):
    return G.mercator_lines(spark, (-120.0, 28.0, -70.0, 48.0), 120, 90, 50.0, -125.0, 0.13, 0.3)


@register(f"with {_IMAGE} {_NEAR.format('$F9')}")
def G1_mercator_nearest(spark, sf_dir):
    return G.to_mercator(feed(spark, sf_dir, "F9"), *_image(spark), "near").select("field", "i", "j", "v")


@register(f"with {_IMAGE} {_MAX.format('$F9')}")
def G1_mercator_max(spark, sf_dir):
    return G.to_mercator(feed(spark, sf_dir, "F9"), *_image(spark), "max").select("field", "i", "j", "v")


@register(f"with {_IMAGE} select field, i, j, round_even(v, 6) v from ({_FOUR.format('$F9')})")
def G1_mercator_bilinear(spark, sf_dir):
    return G.to_mercator(feed(spark, sf_dir, "F9"), *_image(spark), "bilinear").select("field", "i", "j", F.bround("v", 6).alias("v"))


#: products of the catalog that stand for the fields, by how they are resampled there
_CODES_OF = {how: [r["code"] for r in C.product_rows() if r.get("resample", "bilinear") == how] for how in ("near", "max", "bilinear")}
_FIELD_CODES = {1: _CODES_OF["near"][0], 2: _CODES_OF["near"][1], 3: _CODES_OF["max"][0], 4: _CODES_OF["max"][1], 5: _CODES_OF["bilinear"][0], 6: _CODES_OF["bilinear"][1], 7: _CODES_OF["bilinear"][2]}
_CODED = "(select case field " + " ".join(f"when {k} then '{c}'" for k, c in _FIELD_CODES.items()) + " end field, r, c, v, field f from $F9)"


@register(f"with {_IMAGE} select field code, i, j, round_even(v, 6) v from ({_NEAR.format(f'(select * from {_CODED} where f <= 2)')} union all {_MAX.format(f'(select * from {_CODED} where f in (3, 4))')} union all {_FOUR.format(f'(select * from {_CODED} where f > 4)')})")
def G1_mercator_by_catalog(spark, sf_dir):
    """Fields under the names of products that the catalog resamples in three ways."""
    cells = query(spark, sf_dir, f"select field as code, r, c, v from {_CODED}")
    return G.products_to_mercator(cells, C.products(spark), *_image(spark)).select("code", "i", "j", F.bround("v", 6).alias("v"))


_SITE = "(select case when s_suppkey % 11 = 0 then '' else concat('K', s_suppkey % 40) end id, case when s_suppkey % 7 = 0 then 'x' else cast(s_suppkey % 50 + 0.5e0 as string) end lat, cast(-60.25e0 - s_suppkey % 130 as string) lon from supplier)"


@register(f"select id, min(struct_pack(a := try_cast(lat as double), o := try_cast(lon as double))).a lat, min(struct_pack(a := try_cast(lat as double), o := try_cast(lon as double))).o lon from {_SITE.replace('as string', 'as varchar')} where id <> '' and try_cast(lat as double) between -90 and 90 and try_cast(lon as double) between -180 and 180 group by 1")
def S11_sites(spark, sf_dir):
    return parsers.site_list(query(spark, sf_dir, f"select * from {_SITE}"))


_RAMP = "(select p_brand as ramp, case p_partkey % 5 when 0 then '# comment' when 1 then concat('nv ', p_partkey % 200, ' 0 0 0') when 2 then concat(p_size, '   10 20 ', p_partkey % 256) when 3 then concat(p_size, '.5 1 2 3 ', p_partkey % 256, ' # top') else 'x y' end line from part)"


@register("""select p_brand ramp, p_partkey % 5 = 1 as none, case p_partkey % 5 when 2 then cast(p_size as double) when 3 then p_size + 0.5e0 end as "value", cast(case p_partkey % 5 when 1 then p_partkey % 200 when 2 then 10 else 1 end as int) r,
 cast(case p_partkey % 5 when 1 then 0 when 2 then 20 else 2 end as int) g, cast(case p_partkey % 5 when 1 then 0 when 2 then p_partkey % 256 else 3 end as int) b, cast(case p_partkey % 5 when 1 then 0 when 2 then 255 else p_partkey % 256 end as int) a from part where p_partkey % 5 between 1 and 3""")
def S11_ramps(spark, sf_dir):
    return parsers.ramp_lines(query(spark, sf_dir, f"select * from {_RAMP}"))


_PROD = "(select p_brand code, concat('^', p_brand, ':') match from part group by 1)"
_OVER = "(select n_name model, p_brand code, case when n_nationkey % 2 = 0 then concat('^', p_brand, ':.*[02468]$') end match from nation join (select distinct p_brand from part) on n_nationkey % 5 = cast(substr(p_brand, 7, 1) as int) - 1)"
_TEXTS = "(select n_name model, p_partkey msg, concat(p_brand, ':', p_size) as text from part join nation on n_nationkey = p_partkey % 25)"


@register(f"""with o as (select n_nationkey k, n_name model, p_partkey msg, p_brand code, p_size z from part join nation on n_nationkey = p_partkey % 25)
 select model, msg, code from o where k % 5 <> cast(substr(code, 7, 1) as int) - 1 or (k % 2 = 0 and z % 2 = 0)""")
def U2_catalog_projection(spark, sf_dir):
    """Messages by product, under models that match some products their own way or not at all."""
    rows = lambda sql: query(spark, sf_dir, f"select * from {sql}")
    return C.matched(rows(_TEXTS), C.projected(rows(_PROD), table(spark, sf_dir, "nation").select(F.col("n_name").alias("model")), rows(_OVER)))
