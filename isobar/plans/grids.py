"""Queries over grids, volumes and profiles."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from isobar.operators import grids as G
from isobar.operators import volumes as V
from isobar.plans import catalog as C
from isobar.plans.points import register
from isobar.sources import parsers
from isobar.sources.adapters import feed, query, table

N = 200  # the adapters' grids are N x N
LONG = {"r": "long", "c": "long", "tr": "long", "tc": "long"}


def _cells(spark, sf_dir):
    return feed(spark, sf_dir, "F9")


def _out(rows, *columns, digits=6):
    """Keys as longs, values rounded."""
    return rows.select(*(F.col(c).cast("long").alias(c) if c in LONG else F.bround(c, digits).alias(c) if c == "v" else F.col(c) for c in columns))


@register("select field, count(*) n from $F9 where r between 0 and 199 and c between 0 and 199 group by 1")
def S10_checked_grid(spark, sf_dir):
    return G.checked_grid(_cells(spark, sf_dir), N, N).where("v is not null").groupBy("field").agg(F.count(F.lit(1)).alias("n"))


_LAST = "(select field, max(r) lr, max(c) lc from $F9 group by 1)"


@register(f"select field, (r + 2) // 4 tr, (c + 2) // 4 tc, max(v) v from $F9 join {_LAST} using (field) where (r + 2) // 4 * 4 <= lr and (c + 2) // 4 * 4 <= lc group by 1, 2, 3")
def A7_block_max(spark, sf_dir):
    return _out(G.block_reduce(_cells(spark, sf_dir), 4, "max"), "field", "tr", "tc", "v")


@register(f"""with p as (select field, x.r, x.c, v, lr, lc from $F9 x join {_LAST} using (field)),
 pad as (select field, lr, lc, unnest(range(-2, lr + 4)) pr from {_LAST}), padc as (select field, unnest(range(-2, lc + 4)) pc from {_LAST}),
 rr as (select field, pr, least(greatest(pr, 0), lr) r, lr from pad), cc as (select b.field, pc, least(greatest(pc, 0), lc) c, lc from padc b join {_LAST} l on l.field = b.field)
 select p.field, (pr + 2) // 4 tr, (pc + 2) // 4 tc, round_even(avg(v), 6) v from p join rr on rr.field = p.field and rr.r = p.r join cc on cc.field = p.field and cc.c = p.c
 where (pr + 2) // 4 * 4 <= p.lr and (pc + 2) // 4 * 4 <= p.lc and pr >= (pr + 2) // 4 * 4 - 2 and pr + 2 >= 0 and pc + 2 >= 0 group by 1, 2, 3""")
def A7_block_mean(spark, sf_dir):
    return _out(G.block_reduce(_cells(spark, sf_dir), 4, "mean"), "field", "tr", "tc", "v")


@register("select field, r // 2 r, c // 2 c, round_even(avg(v), 6) v from $F9 group by 1, 2, 3")
def A26_decimate(spark, sf_dir):
    return _out(G.decimate(_cells(spark, sf_dir)), "field", "r", "c", "v")


@register("select field, r // 5 r, c // 5 c, v from $F9 where r % 5 = 2 and c % 5 = 2")
def G3_stride(spark, sf_dir):
    return _out(G.stride(_cells(spark, sf_dir), 5), "field", "r", "c", "v")


@register("""select a.field, a.r, a.c, round_even(sum(b.v) / 9, 6) v from $F9 a join (select field, r + dr r, c + dc c, v from $F9, (values (-1), (0), (1)) x(dr), (values (-1), (0), (1)) y(dc)) b
 on a.field = b.field and a.r = b.r and a.c = b.c group by 1, 2, 3""")
def G4_box_mean(spark, sf_dir):
    return _out(G.box_mean(_cells(spark, sf_dir)), "field", "r", "c", "v")


@register("""select distinct field, r + dr r, c + dc c from $F9, (select unnest(range(-2, 3)) dr), (select unnest(range(-2, 3)) dc) where v >= 70 and r + dr between 0 and 199 and c + dc between 0 and 199""")
def G5_dilated(spark, sf_dir):
    return _out(G.dilated(_cells(spark, sf_dir).where("v >= 70"), 2, N, N), "field", "r", "c")


def _fill_sql(rounds: int) -> str:
    sql = "(select field, r, c, v from $F9 where v >= 60)"
    for _ in range(rounds):
        sql = f"""(with b as {sql} select field, r, c, v from b union all select field, r, c, max(v) v from (select field, r + dr r, c + dc c, v from b, (values (-1), (0), (1)) x(dr), (values (-1), (0), (1)) y(dc)) g
          where r between 0 and 199 and c between 0 and 199 and not exists (select 1 from b where b.field = g.field and b.r = g.r and b.c = g.c) group by 1, 2, 3)"""
    return sql


@register(f"select field, r, c, cast(floor(100 * (field % 4) + greatest(0, least(v, 75))) as bigint) code from {_fill_sql(2)}")
def G6_fringe_fill(spark, sf_dir):
    cells = _cells(spark, sf_dir).where("v >= 60").select("field", "r", "c", "v")
    filled = G.fringe_filled(cells, 2, N, N)
    return _out(filled.withColumn("code", G.typed_reflectivity(F.col("field") % 4, F.col("v"))), "field", "r", "c", "code")


_NEAR = "(select field, tr.i r, tc.i c, v from $F9 s join (select unnest(range(80)) i) tr on s.r = floor((tr.i + 0.5e0) * 2.5e0) join (select unnest(range(60)) i) tc on s.c = floor((tc.i + 0.5e0) * 2.5e0))"


@register(f"select field, r, c, v from {_NEAR}")
def G1_regrid_nearest(spark, sf_dir):
    return _out(G.regrid_nearest(_cells(spark, sf_dir), 2.5, 80, 60), "field", "r", "c", "v")


@register("select field, cast(floor((r + 0.5e0) / 2.5e0) as bigint) r, cast(floor((c + 0.5e0) / 2.5e0) as bigint) c, max(v) v from $F9 group by 1, 2, 3")
def G1_regrid_max(spark, sf_dir):
    return _out(G.regrid_max(_cells(spark, sf_dir), 2.5), "field", "r", "c", "v")


_CORNER = lambda n: f"(select i, s, w from (select i, floor(a) s, 1 - (a - floor(a)) w from (select i, (i + 0.5e0) * 2.5e0 - 0.5e0 a from (select unnest(range({n})) i)) union all select i, floor(a) + 1, a - floor(a) from (select i, (i + 0.5e0) * 2.5e0 - 0.5e0 a from (select unnest(range({n})) i))) where w > 0)"


@register(f"select field, x.i r, y.i c, round_even(sum(v * x.w * y.w) / sum(x.w * y.w), 6) v from $F9 f join {_CORNER(80)} x on f.r = x.s join {_CORNER(60)} y on f.c = y.s group by 1, 2, 3")
def G1_regrid_bilinear(spark, sf_dir):
    return _out(G.regrid_bilinear(_cells(spark, sf_dir), 2.5, 80, 60), "field", "r", "c", "v")


@register(f"select f.field, string_agg(coalesce(cast(cast(v as bigint) as string), ''), ',' order by k) as vals from (select distinct field from $F9) f cross join (select unnest(range(4800)) k) left join {_NEAR} n on n.field = f.field and n.r * 60 + n.c = k group by 1")
def G2_value_grid(spark, sf_dir):
    rows = G.value_grid(_cells(spark, sf_dir), 60, 80, 2.5, 0)
    return rows.select("field", F.array_join(F.transform("values", lambda v: F.coalesce(v.cast("long").cast("string"), F.lit(""))), ",").alias("vals"))


@register("select field, r, c, round_even(greatest(0, least(v, 100)), 6) v from $F9")
def G13_probability(spark, sf_dir):
    return _out(_cells(spark, sf_dir).withColumn("v", G.probability(F.col("v"))), "field", "r", "c", "v")


STOPS = [(-20.0, 0, 0, 0), (0.0, 0, 0, 255), (30.0, 0, 255, 0), (60.0, 255, 255, 0), (80.0, 255, 0, 0)]


def _channel(k: int) -> str:
    out = f"case when v <= {STOPS[0][0]} then {STOPS[0][k]}"
    for a, b in zip(STOPS, STOPS[1:], strict=False):
        out += f" when v <= {b[0]} then round_even({a[k]} + (v - {a[0]}e0) / ({b[0]}e0 - {a[0]}e0) * ({b[k]} - {a[k]}), 0)"
    return f"cast({out} else {STOPS[-1][k]} end as int)"


@register(f"select field, r, c, {_channel(1)} red, {_channel(2)} green, {_channel(3)} blue from $F9")
def G9_colour_ramp(spark, sf_dir):
    """One linear ramp for all fields."""
    stops = spark.createDataFrame([("one", False, *stop, 255) for stop in STOPS], "ramp string, none boolean, value double, r int, g int, b int, a int")
    modes = spark.createDataFrame([("one", True)], "ramp string, linear boolean")
    rows = G.coloured(_cells(spark, sf_dir).withColumn("ramp", F.lit("one")).withColumnsRenamed({"r": "row", "c": "col"}), stops, modes)
    return _out(rows.withColumnsRenamed({"row": "r", "col": "c"}), "field", "r", "c", "red", "green", "blue")


# ramps: their stops are rows, three of them linear, one with a colour for no value, one of a single stop and one without stops
_STOP = """(select concat('ramp', cast(p_partkey % 5 as string)) ramp, concat(cast(case when p_partkey % 5 = 4 then 30 else p_partkey * 7 % 130 - 30 end as string), case when p_partkey % 2 = 0 then '.5 ' else ' ' end,
 cast(p_partkey * 3 % 256 as string), ' ', cast(p_partkey * 5 % 256 as string), ' ', cast(p_partkey * 11 % 256 as string), case when p_partkey % 3 = 0 then concat(' ', cast(p_partkey % 256 as string)) else '' end) line from part where p_partkey <= 60
 union all select 'ramp1' as ramp, 'nv 9 8 7 6' as line)"""
_SHADES = "(select r, c, field, concat('ramp', cast(field - 1 as string)) ramp, case when (r + c) % 9 = 0 then null else v end v from $F9)"


def _shade_sql() -> str:
    mix = lambda k: f"case when v is null then case when ramp = 'ramp1' then n{k} else 0 end when linear then round_even(a{k} + t * (b{k} - a{k}), 0) when t < 0.5 then a{k} else b{k} end"
    return f"""with w as (select ramp, string_split(line, ' ') w from {_STOP}), s as (select ramp, cast(w[1] as double) x, max({{'r': cast(w[2] as int), 'g': cast(w[3] as int), 'b': cast(w[4] as int), 'a': coalesce(try_cast(w[5] as int), 255)}}) c from w where w[1] <> 'nv' group by 1, 2),
 h as (select *, case when v is not null then greatest((select min(x) from s where s.ramp = q.ramp), least(v, (select max(x) from s where s.ramp = q.ramp))) end h, ramp in (select ramp from s) known from {_SHADES} q),
 l as (select h.*, s.x lo, s.c ca from h asof left join s on h.ramp = s.ramp and h.h >= s.x), u as (select l.*, s.x hi, s.c cb from l asof left join s on l.ramp = s.ramp and l.h <= s.x),
 m as (select *, ramp in ('ramp0', 'ramp1', 'ramp4') linear, case when hi > lo then (h - lo) / (hi - lo) else 0.0e0 end t, ca.r ar, ca.g ag, ca.b ab, ca.a aa, cb.r br, cb.g bg, cb.b bb, cb.a ba, 9 nr, 8 ng, 7 nb, 6 na from u)
 select field, r, c, cast(case when known then {mix('r')} end as int) red, cast(case when known then {mix('g')} end as int) green, cast(case when known then {mix('b')} end as int) blue, cast(case when known then {mix('a')} end as int) alpha from m"""


@register(_shade_sql())
def G9_colour_ramps(spark, sf_dir):
    """Seven fields by their ramps; two have none."""
    stops = parsers.ramp_lines(query(spark, sf_dir, f"select * from {_STOP}"))
    modes = stops.select("ramp", F.col("ramp").isin("ramp0", "ramp1", "ramp4").alias("linear")).distinct()
    rows = G.coloured(query(spark, sf_dir, f"select * from {_SHADES}"), stops, modes)
    return _out(rows, "field", "r", "c", "red", "green", "blue", "alpha")


@register("select field, r // 20 tr, c // 20 tc, count(*) n from $F9 group by 1, 2, 3 having max(v) >= 75")
def G11_tiles(spark, sf_dir):
    return _out(G.tiles(_cells(spark, sf_dir), 20, 75.0).groupBy("field", "tr", "tc").agg(F.count(F.lit(1)).alias("n")), "field", "tr", "tc", "n")


_COLS = "(select r // 20 tr, c // 20 tc, r, c, max(v) top, max(case when v >= 60 then field end) lv from $F9 group by 1, 2, 3, 4)"


@register(f"""select a.tr, a.tc, top, lv as level, n_high from (select *, row_number() over (partition by tr, tc order by top desc, r, c) n from {_COLS}) a
 join (select tr, tc, count(lv) n_high from {_COLS} group by 1, 2) b on a.tr = b.tr and a.tc = b.tc where n = 1""")
def A8_tile_statistics(spark, sf_dir):
    voxels = _cells(spark, sf_dir).withColumnRenamed("field", "lvl")
    return _out(G.tile_statistics(voxels, 20, 60.0), "tr", "tc", "top", "level", "n_high")


_UV = lambda a, b: f"(select r, c, max(v) filter (where field = {a}) u, max(v) filter (where field = {b}) v from $F9 where field in ({a}, {b}) group by 1, 2)"


@register(f"""select coalesce(b.r, d.r) r, coalesce(b.c, d.c) c, case when d.u is not null and d.v is not null then d.u else b.u end u, case when d.u is not null and d.v is not null then d.v else b.v end w
 from {_UV(1, 2)} b full join {_UV(3, 4)} d on b.r = d.r and b.c = d.c""")
def J7_prefer_left(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    wind = lambda a, b: C.inputs_of(cells.where(F.col("field").isin(a, b)), {a: "u", b: "v"}, ["r", "c"])
    return G.prefer_left(wind(1, 2), wind(3, 4)).select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "u", F.col("v").alias("w"))


_LINES = "(select frame, y, count(*) n, count(*) filter (where greatest(r, g, b) >= 16) lit, count(*) filter (where b > 180 and g > 150 and r < b - 60) cy from $F18 group by 1, 2)"


@register(f"select frame, round_even(sum(lit) / sum(n), 6) lit, count(*) filter (where cy > 0.4e0 * n) cyan_rows, sum(lit) / sum(n) >= 0.02 and count(*) filter (where cy > 0.4e0 * n) < 5 as good from {_LINES} group by 1")
def A25_frame_quality(spark, sf_dir):
    return G.frame_quality(feed(spark, sf_dir, "F18")).withColumn("lit", F.bround("lit", 6))


# 96 x 96 frames of the given pixels on a ground: 1 has a hole within bright imagery, 2 a hole at the frame's edge, 3 a slanted dark part, 4 a hole within night, 5 cyan rows, 6 next to nothing, 7 no hole
_FRAMES = """(select frame, y, x, case when frame = 1 and y between 20 and 60 and x between 30 and 70 then 0 when frame = 2 and x < 30 then 3 when frame = 3 and y + x * 3 / 4 < 60 then 0
  when frame = 4 then case when y between 20 and 60 and x between 30 and 70 then 0 else 20 end when frame = 5 and y % 9 = 4 then 90 when frame = 6 then case when y = 5 and x < 40 then 200 else 2 end else 60 + (y * 7 + x) % 100 end as r,
 case when frame in (1, 2, 3, 4, 6) then 0 when frame = 5 and y % 9 = 4 then 180 else 40 end as g, case when frame in (1, 2, 3, 4, 6) then 0 when frame = 5 and y % 9 = 4 then 220 else 40 end as b
 from (select distinct l_linenumber frame from lineitem) f, (select distinct l_orderkey % 96 y from lineitem) a, (select distinct l_partkey % 96 x from lineitem) b where (frame + y * 31 + x) % 41 > 0 or frame <> 7)"""
_DARK = f"""i as (select frame, y, x from (select distinct frame from {_FRAMES}), (select unnest(range(96)) y), (select unnest(range(96)) x)),
 d as (select i.*, coalesce(greatest(r, g, b), 0) lum, coalesce(greatest(r, g, b), 0) <= 6 blk from i left join {_FRAMES} p on p.frame = i.frame and p.y = i.y and p.x = i.x)"""


def _grown_sql(steps: int) -> str:
    sql = "(select frame, y, x from d where blk)"
    for _ in range(steps):
        sql = f"(select distinct frame, (y + dy + 96) % 96 y, (x + dx + 96) % 96 x from {sql}, (values (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) m(dy, dx))"
    return sql


_RUNS = """e as (select a.frame, a.y, a.x, 'v' kind from d a join d b on a.frame = b.frame and a.y = b.y and b.x = a.x + 1 and a.blk <> b.blk union all select a.frame, a.x, a.y, 'h' from d a join d b on a.frame = b.frame and a.x = b.x and b.y = a.y + 1 and a.blk <> b.blk),
 j as (select frame, kind, x, y - row_number() over (partition by frame, kind, x order by y) k from e), l as (select frame, max(n) longest from (select frame, count(*) n from j group by frame, kind, x, k) group by 1)"""
_VOID = f"""g as (select distinct * from {_grown_sql(3)}), ring as (select frame, count(*) ring, avg(lum) ring_lum from d join g using (frame, y, x) where not blk and y between 4 and 91 and x between 4 and 91 group by 1),
 sh as (select frame, avg(case when blk then 1.0e0 else 0.0e0 end) share from d group by 1),
 vv as (select frame, share, coalesce(ring, 0) ring, ring_lum, coalesce(longest, 0) longest, coalesce(share between 0.005 and 0.97 and ring >= 40 and ring_lum >= 45 and longest / 96.0e0 >= 0.12, false) as void from sh left join ring using (frame) left join l using (frame))"""


def _frames(spark, sf_dir):
    return query(spark, sf_dir, f"select * from {_FRAMES}")


@register(f"with {_DARK}, {_RUNS} select frame, longest from l")
def W9_longest_run(spark, sf_dir):
    return G.straight_edges(G.luminance(_frames(spark, sf_dir), 96))


@register(f"with {_DARK}, {_RUNS}, {_VOID} select frame, round_even(share, 6) share, ring, round_even(ring_lum, 4) ring_lum, longest, void from vv")
def G12_void_ring(spark, sf_dir):
    rows = G.void_verdict(_frames(spark, sf_dir), 96)
    return rows.select("frame", F.bround("share", 6).alias("share"), "ring", F.bround("ring_lum", 4).alias("ring_lum"), "longest", "void")


@register(f"""with {_DARK}, {_RUNS}, {_VOID}, q as (select frame, y, count(*) n, count(*) filter (where greatest(r, g, b) >= 16) lit, count(*) filter (where b > 180 and g > 150 and r < b - 60) cy from {_FRAMES} group by 1, 2),
 f as (select frame, sum(lit) / sum(n) lit, count(*) filter (where cy > 0.4e0 * n) band from q group by 1)
 select frame, band cyan_rows, void, lit < 0.02 or band >= 5 or void as rejected from f join vv using (frame)""")
def A25_G12_rejected_frames(spark, sf_dir):
    return G.rejected_frames(_frames(spark, sf_dir), 96).select("frame", "cyan_rows", "void", "rejected")


@register("select frame, round_even(avg(case when greatest(r, g, b) > 100 then 1.0e0 else 0.0e0 end), 6) covered from $F18 where y between 10 and 60 and x between 20 and 80 group by 1")
def G15_coverage(spark, sf_dir):
    return G.coverage(feed(spark, sf_dir, "F18"), 10, 60, 20, 80, 100).withColumn("covered", F.bround("covered", 6))


@register("""with s as (select poly, seq, round_even(lat / 2, 0) * 2 lat, round_even(lon / 2, 0) * 2 lon from $F19), t as (select *, lag(lat) over (partition by poly order by seq, lat, lon) a, lag(lon) over (partition by poly order by seq, lat, lon) o from s)
 select poly, seq, lat, lon from t where a is null or a <> lat or o <> lon""")
def G14_thinned(spark, sf_dir):
    return G.thinned(feed(spark, sf_dir, "F19"), 2.0)


# volumes and profiles


def _plan(spark):
    heights = spark.createDataFrame([(i, h) for i, h in enumerate(range(500, 3501, 500), 1)], "lvl int, height_m int")
    targets = spark.createDataFrame([(k, 400 + 350 * k) for k in range(10)], "k int, height_m int")
    return V.bracketing(heights, targets)


_PLAN = """(select k, case when h <= 500 then 1 when h >= 3500 then 7 else h // 500 end as lo, case when h <= 500 then 1 when h >= 3500 then 7 when h % 500 = 0 then h // 500 else h // 500 + 1 end as hi,
 case when h <= 500 or h >= 3500 then 0.0e0 else (h % 500) / 500.0e0 end t from (select k, 400 + 350 * k h from (select unnest(range(10)) k)) where h <= 3500)"""


@register(f"select col_id, k, round_even(a.v + t * (b.v - a.v), 4) v from $F10 a join {_PLAN} p on a.lvl = p.lo join (select col_id cid, lvl l, v from $F10) b on cid = a.col_id and l = p.hi")
def J9_level_bracketing(spark, sf_dir):
    """Column values at heights between native levels."""
    columns, plan = feed(spark, sf_dir, "F10"), F.broadcast(_plan(spark))  # a row for each output level
    low = columns.select("col_id", F.col("lvl").alias("lower"), F.col("v").alias("a")).join(plan, "lower")
    rows = low.join(columns.select("col_id", F.col("lvl").alias("upper"), F.col("v").alias("b")), ["col_id", "upper"])
    return rows.select("col_id", F.col("k").cast("long").alias("k"), F.bround(F.col("a") + F.col("t") * (F.col("b") - F.col("a")), 4).alias("v"))


@register(f"""with x as (select col_id, lvl, case when v < 15 then 0.0e0 when v < 30 then 3.0e0 else v end v from $F10 where (col_id + lvl) % 4 > 0),
 w as (select i.col_id, p.k, p.t, coalesce(a.v, 0) a, coalesce(b.v, 0) b from (select distinct col_id from x) i cross join {_PLAN} p left join x a on a.col_id = i.col_id and a.lvl = p.lo left join x b on b.col_id = i.col_id and b.lvl = p.hi where a.v is not null or b.v is not null),
 f as (select *, round_even(case when a = 0 then 2 else a end + t * (case when b = 0 then 2 else b end - case when a = 0 then 2 else a end), 0) v from w)
 select col_id, k, case when t <= 0 then a when t >= 1 then b when (a = 0 and b = 0) or v = 2 then 0 else v end v from f""")
def G7_vertical_interpolation(spark, sf_dir):
    """Columns that lack a level in four, with codes next to the one that fades out."""
    columns = feed(spark, sf_dir, "F10").where("(col_id + lvl) % 4 > 0").select("col_id", "lvl", F.when(F.col("v") < 15, 0.0).when(F.col("v") < 30, 3.0).otherwise(F.col("v").cast("double")).alias("v"))
    return V.interpolated(columns, _plan(spark)).select("col_id", F.col("k").cast("long").alias("k"), "v")


@register("""with s as (select distinct r + dr r, c + dc c from $F9, (select unnest(range(-5, 6)) dr), (select unnest(range(-5, 6)) dc) where field = 4 and v >= 78)
 select r, c, v from $F9 where field = 1 and v >= 50 and exists (select 1 from s where s.r = $F9X.r and s.c = $F9X.c)""".replace("from $F9 where field = 1", "from $F9 f9x where field = 1").replace("$F9X", "f9x"))
def G8_debris_columns(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    shear = G.dilated(cells.where("field = 4 and v >= 78"), 5, N, N).select("r", "c")
    levels = cells.select((F.col("field") - 1).alias("lvl"), "r", "c", F.col("v").alias("ref"), F.lit(60).alias("cc"))
    keep = V.debris_columns(levels, 50, 50, shear)
    return _out(cells.where("field = 1").join(keep, ["r", "c"], "left_semi"), "r", "c", "v")


@register("select r, c, k, v from $F9, (select unnest(range(38)) k) where field = 2 and v >= 5 and (k + 0.5e0) * 500 >= 3000 and (k + 0.5e0) * 500 < 6000")
def G10_extruded(spark, sf_dir):
    centres = spark.range(V.LEVELS).select(F.col("id").alias("k"), ((F.col("id") + 0.5) * V.STEP_M).alias("centre_m"))
    return _out(V.extruded(_cells(spark, sf_dir).where("field = 2 and v >= 5"), centres, 3000.0, 6000.0), "r", "c", "k", "v")


@register("select cast(floor(epoch(stamp)) as bigint) stamp from $F15 group by stamp having count(distinct level_name) = 5")
def A10_complete_stamps(spark, sf_dir):
    return V.complete_stamps(feed(spark, sf_dir, "F15"), 5).select(F.unix_timestamp(F.col("stamp").cast("timestamp")).alias("stamp"))


@register("select cast(floor(epoch(stamp)) as bigint) stamp from $F15 group by stamp having count(distinct level_name) = 5 order by stamp desc limit 1")
def A10_newest_stamp(spark, sf_dir):
    return V.newest_stamp(feed(spark, sf_dir, "F15"), 5).select(F.unix_timestamp(F.col("stamp").cast("timestamp")).alias("stamp"))


@register("select fh from $F12 group by fh having count(distinct product) = 5")
def A11_complete_hours(spark, sf_dir):
    rows = feed(spark, sf_dir, "F12").select(F.col("fh").alias("stamp"), F.col("product").alias("level_name"))
    return V.complete_stamps(rows, 5).withColumnRenamed("stamp", "fh")


_SOUND = "(select col_id site, height_m p, 850 + col_id % 4 * 500 sfc, v t, v * 2 - 30 td from $F10)"


@register(f"select site, string_agg(cast(p as string), ',' order by p desc) ps, string_agg(cast(cast(least(td, t) as bigint) as string), ',' order by p desc) tds from {_SOUND} where p <= sfc group by 1 having count(*) >= 4")
def A12_profiles(spark, sf_dir):
    levels = feed(spark, sf_dir, "F10").select(F.col("col_id").alias("site"), F.col("height_m").alias("pressure"), (F.lit(850) + F.col("col_id") % 4 * 500).alias("surface"), F.col("v").alias("t"), (F.col("v") * 2 - 30).alias("td"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("long").cast("string")), ",")
    return V.assembled(levels).select("site", text("pressure").alias("ps"), text("td").alias("tds"))


_MB = (1000, 850, 700, 500, 300)
_KINDS = [(k, m) for k in ("TMP", "DPT", "HGT", "UGRD", "VGRD") for m in _MB]
_ISO = " union all ".join(f"select '{k}:{m}' as key, {i} as n from region where r_regionkey = 0" for i, (k, m) in enumerate(_KINDS))
_SFC = " union all ".join(f"select '{k}' as key, {100 + i} as n from region where r_regionkey = 0" for i, k in enumerate((*V.SURFACE_KEYS, "APCP:total", "REFC:col", "MAXREF:1km")))
# values of every key at a place and hour, out of one number of that place and hour; some are not there
_VALUE = """case when key like 'TMP:%' then 240 + q + n % 7 when key like 'DPT:%' then 238 + q + (q * n) % 13 when key like 'HGT:%' then 100 * n + q when key = 'PRES:sfc' then 60000 + q * 800 when key = 'APCP:total' then q * 2 + fh * 30 when key like '%RE%' then q + n % 3 else q - 20 + n % 9 end"""
_FIELDS = f"(select a, b, fh, key, cast({_VALUE} as double) v from (select l_orderkey % 40 a, l_partkey % 40 b, l_linenumber - 1 fh, cast(max(l_quantity) as int) q from lineitem group by 1, 2, 3), ({_ISO} union all {_SFC}) where HOLES)"
_SITES = f"(select concat('s', a, '-', b) site, fh, key, v from {_FIELDS.replace('HOLES', '(a * 7 + b * 5 + n * 3 + fh) % 11 > 0')})"


def _get(k: str) -> str:
    return f"max(v) filter (where key = '{k}')"


def _profile_sql() -> str:
    kelvin = lambda x: f"case when {x} > 100 then {x} - 273.15e0 else {x} end"
    level = lambda p, h, t, d, u, w, i: f"select site, fh, {i} i, h0, ps, {p} p, {h} h, {kelvin(t)} t, case when {d} is not null then least({kelvin(d)}, {kelvin(t)}) end d, coalesce({u}, 0) u, coalesce({w}, 0) w from w"
    columns = ", ".join(f"{_get(k)} s{i}" for i, k in enumerate(V.SURFACE_KEYS)) + ", " + ", ".join(f"{_get(f'{k}:{m}')} {k.lower()}{m}" for k, m in _KINDS)
    rows = [level("s0 / 100", "s1", "s2", "s3", "s4", "s5", 0) + " where s0 is not null and s1 is not null and s2 is not null and s3 is not null"]
    rows += [level(f"{m}.0e0", f"hgt{m}", f"tmp{m}", f"dpt{m}", f"ugrd{m}", f"vgrd{m}", i) + f" where not coalesce({m} * 100 > s0, false) and tmp{m} is not null and dpt{m} is not null and hgt{m} is not null" for i, m in enumerate(_MB, 1)]
    text = lambda c, digits: f"string_agg(cast(cast(round_even({c}, {digits}) * 100 as bigint) as varchar), ',' order by p desc, i)"
    return f"""with w as (select site, fh, {_get('HGT:sfc')} h0, {_get('PRES:sfc')} ps, {columns} from {_SITES} group by 1, 2), l as ({' union all '.join(rows)})
 select site, fh, round_even(coalesce(any_value(h0), arg_max(h, p)), 1) elev_m, {text('p', 1)} ps, {text('h', 1)} hs, {text('t', 2)} ts, {text('d', 2)} ds, {text('u', 2)} us, {text('w', 2)} vs from l group by 1, 2 having count(*) >= 4"""


@register(_profile_sql())
def A12_soundings(spark, sf_dir):
    """Soundings of 1,600 sites and seven hours, from keyed fields of which one in eleven is absent."""
    rows = V.profiles(query(spark, sf_dir, f"select * from {_SITES}"), _MB)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.rint(x * 100).cast("long").cast("string")), ",")
    columns = {"ps": "pres_hpa", "hs": "hgt_msl_m", "ts": "temp_c", "ds": "dewpoint_c", "us": "u_ms", "vs": "v_ms"}
    return rows.select("site", F.col("fh").cast("long").alias("fh"), "elev_m", *(text(c).alias(k) for k, c in columns.items()))


_TILED = f"(select a r, b c, fh, key, v from {_FIELDS.replace('HOLES', 'not (fh = 5 and n = 6) and not (n >= 106 and (a + b + n) % 5 = 0) and not (fh = 1 and n = 106)')})"


def _tile_sql() -> str:
    ten = lambda x: f"cast(round_even({x}, 1) * 10 as bigint)"
    kelvin = lambda x: f"case when {x} > 100 then {x} - 273.15e0 else {x} end"
    temps = " || ',' || ".join(f"cast({ten(kelvin(_get(f'TMP:{m}')))} as varchar)" for m in _MB)
    dews = " || ',' || ".join(f"cast({ten('least(' + kelvin(_get(f'DPT:{m}')) + ', ' + kelvin(_get(f'TMP:{m}')) + ')')} as varchar)" for m in _MB)
    return f"""with f as {_TILED}, h as (select fh from f where key in ({', '.join(f"'{k}'" for k in [*V.SURFACE_KEYS, *(f'{k}:{m}' for k, m in _KINDS)])}) group by fh having count(distinct key) = {len(V.SURFACE_KEYS) + len(_KINDS)}),
 c as (select r, c, fh, {ten(_get('PRES:sfc') + ' / 100')} p, {ten(kelvin(_get('TMP:2m')))} t, {_get('APCP:total')} total, cast(round_even(coalesce({_get('MAXREF:1km')}, {_get('REFC:col')}), 0) as bigint) refl, {temps} ts, {dews} ds from f group by 1, 2, 3)
 select x.r // 16 tr, x.c // 16 tc, x.fh, cast(row_number() over (partition by x.r // 16, x.c // 16, x.fh order by x.r, x.c) - 1 as int) k, x.p sfc_p, x.t sfc_t, x.ts temps, x.ds dews, x.refl, {ten('greatest(x.total - coalesce(y.total, case when x.fh = 1 then 0 end), 0)')} qpf
 from (select c.* from c join h using (fh)) x left join c y on y.r = x.r and y.c = x.c and y.fh = x.fh - 1""".replace("greatest(x.total - coalesce(y.total, case when x.fh = 1 then 0 end), 0)", "case when x.fh > 0 and x.total is not null and coalesce(y.total, case when x.fh = 1 then 0 end) is not null then greatest(x.total - coalesce(y.total, case when x.fh = 1 then 0 end), 0) end")


@register(_tile_sql())
def A13_profile_tiles(spark, sf_dir):
    """The documents of all tiles, opened again: hours in them, columns in these.  One hour lacks a field and isn't there."""
    tiles = V.profile_tiles(query(spark, sf_dir, f"select * from {_TILED}"), _MB)
    rows = tiles.select("tr", "tc", F.explode("hours").alias("h"))
    ten = lambda x: F.rint(x * 10).cast("long")
    text = lambda c: F.array_join(F.transform(c, lambda x: ten(x).cast("string")), ",")
    names = ("sfc_pres_hpa", "sfc_temp_c", "temp_c", "dewpoint_c", "refl_dbz", "qpf_mm")
    rows = rows.select("tr", "tc", F.col("h.fh").alias("fh"), F.posexplode(F.arrays_zip(*(F.col(f"h.{n}").alias(n) for n in names))).alias("k", "x"))
    return rows.select("tr", "tc", F.col("fh").cast("long").alias("fh"), "k", ten(F.col("x.sfc_pres_hpa")).alias("sfc_p"), ten(F.col("x.sfc_temp_c")).alias("sfc_t"), text(F.col("x.temp_c")).alias("temps"), text(F.col("x.dewpoint_c")).alias("dews"), F.col("x.refl_dbz").cast("long").alias("refl"), ten(F.col("x.qpf_mm")).alias("qpf"))


_TOP = "(select r, c, arg_max(v, field) v from $F9 group by 1, 2)"


def _top(spark, sf_dir):
    """One grid of all fields: the last one's value of each cell."""
    return _cells(spark, sf_dir).groupBy("r", "c").agg(F.max_by("v", "field").alias("v"))


@register(f"select r // 16 tr, c // 16 tc, count(*) n, sum(v) total, min(r) - 0.75e0 r0, max(c) + 0.75e0 c1 from {_TOP} group by 1, 2")
def A13_tile_packing(spark, sf_dir):
    rows = V.packed(_top(spark, sf_dir))
    rows = rows.withColumn("total", F.aggregate("columns", F.lit(0.0), lambda a, x: a + x["v"]))
    return _out(rows.select("tr", "tc", F.size("columns").cast("long").alias("n"), "total", F.col("r0").cast("double").alias("r0"), F.col("c1").cast("double").alias("c1")), "tr", "tc", "n", "total", "r0", "c1")


@register("""with b as (select r // 16 tr, c // 16 tc, min(r) - 0.75e0 r0, max(r) + 0.75e0 r1, min(c) - 0.75e0 c0, max(c) + 0.75e0 c1 from $F9 group by 1, 2),
 p as (select s_suppkey id, cast(s_suppkey * 7 % 1990 as double) / 10 pr, cast(s_suppkey * 11 % 1990 as double) / 10 pc from supplier)
 select id, tr, tc from p join b on pr between r0 and r1 and pc between c0 and c1""")
def J14_tile_lookup(spark, sf_dir):
    boxes = V.packed(_top(spark, sf_dir)).drop("columns")
    k = F.col("s_suppkey")
    points = table(spark, sf_dir, "supplier").select(k.alias("id"), ((k * 7 % 1990).cast("double") / 10).alias("pr"), ((k * 11 % 1990).cast("double") / 10).alias("pc"))
    return _out(V.tile_of(points, boxes), "id", "tr", "tc")


@register("select site, fh, total, greatest(total - before, 0) amount from (select a.*, case when b.fh is null and a.fh = 1 then 0 else b.total end before from $F11 a left join $F11 b on b.site = a.site and b.fh = a.fh - 1) where fh > 0 and before is not null")
def W5_hourly_amounts(spark, sf_dir):
    return V.hourly_amounts(feed(spark, sf_dir, "F11"))


@register("select station_id, v from (select *, cast(floor((50 - lat) / 0.13e0) as bigint) rr, cast(floor((lon + 125) / 0.3e0) as bigint) cc from $F2) s left join (select r, c, arg_max(v, field) v from $F9 group by 1, 2) f on f.r = rr and f.c = cc and rr between 0 and 199 and cc between 0 and 199")
def J8_point_sampling(spark, sf_dir):
    return V.sampled(feed(spark, sf_dir, "F2"), _top(spark, sf_dir), 50.0, -125.0, 0.13, N, N, 0.3).select("station_id", "v")


@register("select r * 1000 + c as key, arg_max(v, field) v from $F9 group by 1")
def J12_field_merge(spark, sf_dir):
    cells = _cells(spark, sf_dir).select("field", (F.col("r") * 1000 + F.col("c")).alias("key"), "v")
    return V.merged(*(cells.where(F.col("field") == k) for k in range(1, 8)))


# catalog


def _named(spark, sf_dir):
    """Cells whose place has names that no input has."""
    return _cells(spark, sf_dir).withColumnsRenamed({"r": "row", "c": "col"})


@register("""select r, c, round_even(case when a is not null then a * 1.8e0 + 32 end, 4) t2m, round_even(sqrt(a * a + b * b) * 1.94384e0, 4) wind10m, round_even((a - b) / greatest((c2 - d) / 1000, 0.1e0), 4) lapse75,
 case when d > 0 then 4 when c2 > 0 then 3 when b > 0 then 2 when a > 0 then 1 else 0 end ptype, round_even(greatest(a * b / 160000, 0), 6) ehi1, round_even(case when a >= 0 then a * 0.0393701e0 end, 5) mesh
 from (select r, c, max(v) filter (where field = 1) a, max(v) filter (where field = 2) b, max(v) filter (where field = 3) c2, max(v) filter (where field = 4) d from $F9 where field <= 4 group by 1, 2)""")
def U1_M10_formulas(spark, sf_dir):
    inputs = C.inputs_of(_named(spark, sf_dir).where("field <= 4"), {1: "A", 2: "B", 3: "C", 4: "D"}, ["row", "col"])
    rows = C.evaluated(inputs, ["t2m", "wind10m", "lapse75", "ptype", "ehi1", "mesh"], ["row", "col"])
    digits = {"t2m": 4, "wind10m": 4, "lapse75": 4, "ehi1": 6, "mesh": 5}
    return rows.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), F.col("ptype").cast("int").alias("ptype"), *(F.bround(k, d).alias(k) for k, d in digits.items()))


@register("""select r, c, round_even(greatest((a / 1500) * greatest(0, least((2000 - (c2 - d)) / 1000, 1)) * (e / 150) * case when s < 12.5 then 0 else least(s, 30) / 20 end * greatest(0, least((200 + b) / 150, 1)), 0), 6) stp,
 round_even(greatest((a / 1000) * (b / 50) * case when s2 < 10 then 0 else least(s2, 20) / 20 end, 0), 6) scp from (select *, sqrt(f * f + g * g) s, sqrt(c2 * c2 + d * d) s2 from (select r, c,
 max(v) filter (where field = 1) a, max(v) filter (where field = 2) b, max(v) filter (where field = 3) c2, max(v) filter (where field = 4) d, max(v) filter (where field = 5) e, max(v) filter (where field = 6) f, max(v) filter (where field = 7) g from $F9 group by 1, 2))
 where a is not null and b is not null and c2 is not null and d is not null and e is not null and f is not null and g is not null""")
def U2_severe_indices(spark, sf_dir):
    inputs = C.inputs_of(_named(spark, sf_dir), dict(zip(range(1, 8), "ABCDEFG", strict=True)), ["row", "col"]).dropna()
    rows = C.evaluated(inputs, ["stp", "scp"], ["row", "col"])
    return rows.select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), F.bround("stp", 6).alias("stp"), F.bround("scp", 6).alias("scp"))


_ABSENT = {n: 20.0 + 7 * k for k, n in enumerate("ABCDEFG")}
_INPUTS = "(select " + ", ".join(f"coalesce(max(v) filter (where field = {k}), {_ABSENT[n]}e0) {n}" for k, n in enumerate("ABCDEFG", 1)) + " from $F9 group by r, c)"
_EVERY = [r["code"] for r in C.product_rows() if r["expr"]]


def _every_sql() -> str:
    """A row for each product, of its expression in this dialect; below a radar product's sentinel there is nothing."""
    parts = []
    for r in C.product_rows():
        if r["expr"]:
            value = f"cast({re.sub(r'(?<=[0-9])D(?![0-9A-Za-z])', 'e0', r['expr'])} as double)"
            if "sentinel_lt" in r or r["class"].startswith("mrms"):
                value = f"case when A >= {float(r.get('sentinel_lt', 0))} then {value} end"
            parts.append(f"select '{r['code']}' code, count(x) n, round_even(min(x), 4) least, round_even(max(x), 4) most, round_even(avg(x), 3) mean from (select {value} x from w)")
    return f"with w as (select * from {_INPUTS}) " + " union all ".join(parts)


@register(_every_sql())
def U1_every_formula(spark, sf_dir):
    """What every formula of the catalog makes of all cells, with a constant for each field that isn't there."""
    inputs = C.inputs_of(_named(spark, sf_dir), dict(zip(range(1, 8), "ABCDEFG", strict=True)), ["row", "col"]).na.fill(_ABSENT)
    rows = C.evaluated(inputs, _EVERY, ["row", "col"])
    rows = rows.unpivot(["row", "col"], _EVERY, "code", "x")
    return rows.groupBy("code").agg(F.count("x").alias("n"), F.bround(F.min("x"), 4).alias("least"), F.bround(F.max("x"), 4).alias("most"), F.bround(F.avg("x"), 3).alias("mean"))
