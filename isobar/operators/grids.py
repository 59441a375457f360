"""Operators on grids: long tables of cells ``field, r, c, v``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.scalar import mercator
from isobar.operators.sizes import maybe_broadcast


#: distances, in steps, at which a node may have enough points; those to the far corners of the tiles around it, then coarser
_REACHES = (0.71, 1.12, 1.42, 1.81, 2.24, 2.7, 3.2, 3.7)


def _near(x: Column, r, step: float) -> Column:
    """The nodes of a line from x - r to x + r."""
    return F.sequence(F.ceil((x - r) / step), F.floor((x + r) / step))


def _wanted(points: DataFrame, frame: list[str], step: float, radius: float, most: int) -> DataFrame:
    """Unit cells and the nodes that may want points of them: ``cy, cx, gy, gx, r2``.

    Points are counted by tiles of half a step.  Where tiles wholly within a
    distance of a node hold ``most`` points, no point beyond it counts there; r2 is
    the square of that distance, or of the radius.  A frame's tiles are as many as
    its area has, however many points there are, and are one partition.
    """
    size = step / 2
    tile = lambda x: F.when(~F.isnan(x), F.floor(F.col(x) / size))
    tiles = points.groupBy(*frame, tile("lat").alias("ty"), tile("lon").alias("tx")).agg(F.count(F.lit(1)).alias("n")).repartition(*frame)
    middle = lambda t: (F.col(t) + 0.5) * size
    tiles = tiles.withColumn("gy", F.explode(_near(middle("ty"), radius + size / 2, step))).withColumn("gx", F.explode(_near(middle("tx"), radius + size / 2, step)))
    off = lambda g, t: F.abs(F.col(g) * step - middle(t))
    square = lambda y, x: y * y + x * x
    gap = lambda g, t: F.greatest(off(g, t) - size / 2, F.lit(0.0))
    tiles = tiles.where(square(gap("gy", "ty"), gap("gx", "tx")) <= radius * radius * (1 + 1e-9))
    far = square(off("gy", "ty") + size / 2, off("gx", "tx") + size / 2)
    reaches = [r * step for r in _REACHES if r * step < radius]
    nodes = tiles.groupBy(*frame, "gy", "gx").agg(*(F.sum(F.when(far <= r * r, F.col("n"))).alias(f"n{i}") for i, r in enumerate(reaches)), F.sum("n").alias("all"))
    r2 = F.coalesce(*(F.when(F.col(f"n{i}") >= most, F.lit(r * r * (1 + 1e-9))) for i, r in enumerate(reaches)), F.lit(float(radius * radius)))
    nodes = nodes.select(*frame, "gy", "gx", r2.alias("r2"), (F.sqrt(r2) / step + 1e-9).alias("r"))
    cells = lambda g: F.sequence(F.floor(F.col(g) - F.col("r")), F.floor(F.col(g) + F.col("r")))
    nodes = nodes.withColumn("cy", F.explode(cells("gy"))).withColumn("cx", F.explode(cells("gx")))
    out = lambda g, c: F.greatest(F.abs(F.col(g) - F.col(c) - 0.5) - 0.5, F.lit(0.0))
    nodes = nodes.where(square(out("gy", "cy"), out("gx", "cx")) <= F.col("r") * F.col("r"))
    return nodes.select(*frame, "cy", "cx", "gy", "gx", "r2")


def sent_to_nodes(points: DataFrame, frame: list[str], step: float = 1.0, radius: float = 4.0, most: int = 20, least: int = 3, crowd: float = 2.0) -> DataFrame:
    """Points with each grid node within reach that may want them: ``gy, gx, station_id, v, d2``.

    In frames with more than ``crowd`` points to a cell that has any, a point goes
    only to nodes without ``most`` nearer ones by ``_wanted``; in others to all,
    line by line of a circle.  Frames of fewer than ``least`` points are left out.
    """
    of = lambda x: F.floor(F.col(x) / step)
    cells = points.groupBy(*frame, of("lat").alias("cy"), of("lon").alias("cx")).agg(F.count(F.lit(1)).alias("_n"))
    frames = cells.groupBy(*frame).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_cells")).where(F.col("_n") >= least)
    frames = maybe_broadcast(frames.select(*frame, (F.col("_n") > crowd * F.col("_cells")).alias("_crowded")))
    rows = points.join(frames.where(~F.col("_crowded")), frame)
    rows = rows.withColumn("gy", F.explode(_near(F.col("lat"), F.lit(radius), step)))
    half = F.sqrt(F.greatest(F.lit(radius * radius) - F.pow(F.col("gy") * step - F.col("lat"), 2), F.lit(0.0))) + 1e-9 * step
    across = F.ceil((F.col("lon") - half) / step) <= F.floor((F.col("lon") + half) / step)  # a line may pass between nodes
    rows = rows.where(across).withColumn("gx", F.explode(_near(F.col("lon"), half, step)))
    columns = [*frame, "station_id", "v", "lat", "lon", "gy", "gx"]
    rows = rows.select(*columns, F.lit(float(radius * radius)).alias("r2"))
    crowded = points.join(frames.where("_crowded"), frame)
    wanted = _wanted(crowded, frame, step, radius, most).hint("merge")  # more rows than the planner takes them for
    there = crowded.withColumn("cy", of("lat")).withColumn("cx", of("lon")).join(wanted, [*frame, "cy", "cx"])
    rows = rows.union(there.select(*columns, "r2"))
    dy, dx = F.col("gy") * step - F.col("lat"), F.col("gx") * step - F.col("lon")
    return rows.withColumn("d2", dy * dy + dx * dx).where("d2 <= r2").select(*frame, "gy", "gx", "station_id", "v", "d2")


def idw_surface(points: DataFrame, frame: list[str], step: float = 1.0, radius: float = 4.0, most: int = 20, power: float = 2.0, smooth: float = 0.3, least: int = 3, cell: float = 4.0) -> DataFrame:
    """Inverse-distance weighted mean of the nearest points at every grid node within reach.

    Points are sent to the nodes around them, so the grouping key is the node.
    They are read several times for that, so they should come from a table.
    Frames of fewer than ``least`` points are left out.
    """
    rows = sent_to_nodes(points, frame, step, radius, most, least)
    place = Window.partitionBy(*frame, "gy", "gx").orderBy("d2", "station_id")
    rows = rows.withColumn("k", F.row_number().over(place)).where(F.col("k") <= most)
    w = 1 / F.pow(F.col("d2") + smooth * smooth, power / 2)
    rows = rows.groupBy(*frame, "gy", "gx").agg((F.sum(w * F.col("v")) / F.sum(w)).alias("v"), F.count(F.lit(1)).alias("n"))
    return rows.select(*frame, (F.col("gy") * step).alias("lat"), (F.col("gx") * step).alias("lon"), "v", "n")


def checked_grid(cells: DataFrame, rows: int, columns: int) -> DataFrame:
    """Fails where a cell lies outside of the expected grid."""
    inside = F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1)
    return cells.withColumn("v", F.when(inside, F.col("v")).otherwise(F.raise_error(F.lit("unexpected grid"))))


def block_reduce(cells: DataFrame, s: int, how: str = "max") -> DataFrame:
    """S x s blocks centred on the subsample's pixel; at the edges the outer cells count as often as padding repeats them."""
    half = s // 2
    last = cells.groupBy("field").agg(F.max("r").alias("last_r"), F.max("c").alias("last_c"))
    rows = cells.join(maybe_broadcast(last), "field").where("v is not null")
    target = lambda x: F.floor((F.col(x) + half) / s)
    rows = rows.withColumn("tr", target("r")).withColumn("tc", target("c"))
    rows = rows.where((F.col("tr") * s <= F.col("last_r")) & (F.col("tc") * s <= F.col("last_c")))
    if how == "max":
        out = F.max("v")
    else:
        lo = lambda x: F.when(F.col(x) == 0, half).otherwise(0)
        hi = lambda x, t, last: F.when(F.col(x) == F.col(last), F.greatest(F.col(t) * s - half + s - 1 - F.col(last), F.lit(0))).otherwise(0)
        w = (1 + lo("r") + hi("r", "tr", "last_r")) * (1 + lo("c") + hi("c", "tc", "last_c"))
        out = F.sum(F.col("v") * w) / F.sum(w)
    return rows.groupBy("field", "tr", "tc").agg(out.alias("v"))


def decimate(cells: DataFrame) -> DataFrame:
    """2:1 mean of the cells that have a value."""
    return cells.groupBy("field", F.floor(F.col("r") / 2).alias("r"), F.floor(F.col("c") / 2).alias("c")).agg(F.avg("v").alias("v"))


def stride(cells: DataFrame, s: int) -> DataFrame:
    """Every s-th cell from s / 2 on."""
    here = lambda x: F.pmod(F.col(x) - s // 2, F.lit(s)) == 0
    return cells.where(here("r") & here("c")).withColumn("r", F.floor(F.col("r") / s)).withColumn("c", F.floor(F.col("c") / s))


def _around(cells: DataFrame, r: int, corners: bool = True) -> DataFrame:
    """Each cell at all places within r of it."""
    rows = cells.withColumn("dr", F.explode(F.sequence(F.lit(-r), F.lit(r)))).withColumn("dc", F.explode(F.sequence(F.lit(-r), F.lit(r))))
    if not corners:
        rows = rows.where(F.abs("dr") + F.abs("dc") <= r)
    return rows.withColumn("r", F.col("r") + F.col("dr")).withColumn("c", F.col("c") + F.col("dc")).drop("dr", "dc")


def box_mean(cells: DataFrame) -> DataFrame:
    """Mean of 3 x 3 with missing cells as 0, where the centre has a value."""
    centres = cells.where("v is not null").select("field", "r", "c")
    sums = _around(cells.where("v is not null"), 1).groupBy("field", "r", "c").agg((F.sum("v") / 9).alias("v"))
    return sums.join(centres, ["field", "r", "c"], "left_semi")


def dilated(mask: DataFrame, r: int, rows: int, columns: int) -> DataFrame:
    """Cells within Chebyshev distance r, in two passes of lines."""
    line = lambda m, x: m.withColumn(x, F.explode(F.sequence(F.col(x) - r, F.col(x) + r))).distinct()
    out = line(line(mask.select("field", "r", "c").distinct(), "r"), "c")
    return out.where(F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1))


def fringe_filled(cells: DataFrame, rounds: int, rows: int, columns: int) -> DataFrame:
    """So many times, empty cells take the greatest of their 3 x 3 neighbours.

    An empty cell is filled in round d if d is its distance (Chebyshev) to the
    nearest cell with a value, and takes the greatest of those at that distance;
    so all rounds are one explode and one grouping.
    """
    own = cells.where("v is not null").select("field", "r", "c", "v")
    at = F.explode(F.sequence(F.lit(-rounds), F.lit(rounds)))
    near = own.withColumn("dr", at).withColumn("dc", at)
    near = near.select("field", (F.col("r") + F.col("dr")).alias("r"), (F.col("c") + F.col("dc")).alias("c"), F.struct((-F.greatest(F.abs("dr"), F.abs("dc"))).alias("d"), "v").alias("b"))
    near = near.where(F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1))
    filled = near.groupBy("field", "r", "c").agg(F.max("b").alias("b")).where("b.d < 0").select("field", "r", "c", "b.v")
    return own.unionByName(filled)


def typed_reflectivity(kind: Column, dbz: Column) -> Column:
    """100 times the type plus the clipped reflectivity, whole."""
    return F.floor(kind * 100 + F.greatest(F.lit(0.0), F.least(dbz, F.lit(75.0)))).cast("long")


def regrid_nearest(cells: DataFrame, scale: float, rows: int, columns: int) -> DataFrame:
    """G1 nearest: each target cell takes the source cell under its centre; target index times scale is the source's."""
    source = cells.select("field", F.col("r").alias("sr"), F.col("c").alias("sc"), "v")
    # a source cell knows which targets fall into it, so nothing but existing cells is expanded
    span = lambda x, n: F.sequence(F.ceil(F.col(x) / scale - 0.5), F.least(F.ceil((F.col(x) + 1) / scale - 0.5) - 1, F.lit(n - 1).cast("long")))
    has = lambda x, n: F.ceil(F.col(x) / scale - 0.5) <= F.least(F.ceil((F.col(x) + 1) / scale - 0.5) - 1, F.lit(n - 1).cast("long"))
    source = source.where(has("sr", rows) & has("sc", columns))
    return source.withColumn("r", F.explode(span("sr", rows))).withColumn("c", F.explode(span("sc", columns))).select("field", "r", "c", "v")


def regrid_max(cells: DataFrame, scale: float) -> DataFrame:
    """G1 max: the strongest source cell of each target cell."""
    at = lambda x: F.floor((F.col(x) + 0.5) / scale).alias(x)
    return cells.groupBy("field", at("r"), at("c")).agg(F.max("v").alias("v"))


def regrid_bilinear(cells: DataFrame, scale: float, rows: int, columns: int) -> DataFrame:
    """G1 bilinear: weights of up to four source cells; missing ones are left out and the rest weigh as one."""
    rows_t = cells.sparkSession.range(rows).select(F.col("id").alias("r"))
    cols_t = cells.sparkSession.range(columns).select(F.col("id").alias("c"))

    def corners(dim: DataFrame, x: str) -> DataFrame:  # a target line and its two source lines with weights
        at = (F.col(x) + 0.5) * scale - 0.5
        low = F.floor(at)
        pair = F.explode(F.array(F.struct(low.alias("s"), (1 - (at - low)).alias("w")), F.struct((low + 1).alias("s"), (at - low).alias("w"))))
        return dim.withColumn("p", pair).select(x, F.col("p.s").alias(f"s{x}"), F.col("p.w").alias(f"w{x}")).where(F.col(f"w{x}") > 0)

    near_r, near_c = corners(rows_t, "r"), corners(cols_t, "c")
    source = cells.where("v is not null").select("field", F.col("r").alias("sr"), F.col("c").alias("sc"), "v")
    joined = source.join(near_r, "sr").join(near_c, "sc")
    w = F.col("wr") * F.col("wc")
    return joined.groupBy("field", "r", "c").agg((F.sum(w * F.col("v")) / F.sum(w)).alias("v"))


def value_grid(cells: DataFrame, w: int, h: int, scale: float, decimals: int = 1) -> DataFrame:
    """W x h nearest samples of each field, row by row, null where there is none."""
    near = regrid_nearest(cells, scale, h, w)
    values = near.groupBy("field").agg(F.map_from_entries(F.collect_list(F.struct((F.col("r") * w + F.col("c")).alias("k"), F.bround("v", decimals).alias("v")))).alias("m"))
    return values.select("field", F.transform(F.sequence(F.lit(0).cast("long"), F.lit(w * h - 1).cast("long")), lambda k: F.try_element_at(F.col("m"), k)).alias("values"))


BINS = 64  # of a ramp's range


def ramp_intervals(stops: DataFrame) -> DataFrame:
    """``stops`` (ramp, value, r, g, b, a) to the intervals between them by bins of the ramp's range.

    Of stops with one value the last by colour holds.  A ramp of a single stop is
    one interval.
    """
    order = Window.partitionBy("ramp").orderBy("value")
    whole = Window.partitionBy("ramp")
    stops = stops.groupBy("ramp", "value").agg(F.max(F.struct("r", "g", "b", "a")).alias("c"))
    rows = stops.select("ramp", F.col("value").alias("lo"), F.col("c").alias("c0"), F.coalesce(F.lead("value").over(order), "value").alias("hi"), F.coalesce(F.lead("c").over(order), "c").alias("c1"), F.min("value").over(whole).alias("least"), F.max("value").over(whole).alias("most"), F.row_number().over(order.orderBy(F.desc("value"))).alias("from_top"), F.count(F.lit(1)).over(whole).alias("n"))
    rows = rows.where("from_top > 1 or n = 1").drop("from_top", "n")
    return rows.withColumn("bin", F.explode(F.sequence(ramp_bin(F.col("lo")), ramp_bin(F.col("hi")))))


def ramp_bin(v: Column) -> Column:
    width = (F.col("most") - F.col("least")) / BINS
    return F.coalesce(F.floor((v - F.col("least")) / F.nullif(width, F.lit(0.0))), F.lit(0)).cast("long")


def coloured(values: DataFrame, stops: DataFrame, modes: DataFrame) -> DataFrame:
    """``values`` (ramp, v, ...) with ``red, green, blue, alpha``.

    ``stops`` is a row for each stop, as ``ramp_lines`` gives them; that of
    ``none`` is the colour of no value, which is transparent without one.
    ``modes`` (ramp, linear) tells which ramps go from stop to stop and which
    take the nearer one, the upper in the middle.  Ends hold outside.  A value
    meets the intervals of its bin and the exact one is kept.  A ramp that isn't
    there gives no colour.
    """
    intervals = ramp_intervals(stops.where("not none"))
    bounds = intervals.groupBy("ramp").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    none = stops.where("none").groupBy("ramp").agg(F.max(F.struct("r", "g", "b", "a")).alias("nv"))
    dims = maybe_broadcast(bounds.join(none, "ramp", "left").join(modes.select("ramp", "linear"), "ramp", "left"))
    rows = values.join(dims, "ramp", "left")
    held = F.when(F.isnan("v"), None).otherwise(F.greatest("least", F.least("v", "most")))  # greatest and least skip nulls
    rows = rows.withColumn("held", F.when(F.col("v").isNotNull() & F.col("least").isNotNull(), held))
    rows = rows.withColumn("bin", ramp_bin(F.col("held")))
    parts = maybe_broadcast(intervals.select(F.col("ramp").alias("of"), F.col("bin").alias("in_bin"), "lo", "hi", "c0", "c1", (F.col("hi") == F.col("most")).alias("top")))
    inside = (F.col("held") >= F.col("lo")) & ((F.col("held") < F.col("hi")) | (F.col("top") & (F.col("held") == F.col("hi"))))
    rows = rows.join(parts, (F.col("ramp") == F.col("of")) & (F.col("bin") == F.col("in_bin")) & inside, "left")
    t = F.coalesce((F.col("held") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)), F.lit(0.0))

    def channel(k: str) -> Column:
        a, b = F.col(f"c0.{k}"), F.col(f"c1.{k}")
        own = F.when(F.col("linear"), F.bround(a + t * (b - a))).otherwise(F.when(t < 0.5, a).otherwise(b))
        return F.when(F.col("held").isNotNull(), own).otherwise(F.when(F.col("least").isNotNull(), F.coalesce(F.col(f"nv.{k}"), F.lit(0)))).cast("int")

    return rows.select(*values.columns, *(channel(k).alias(n) for k, n in zip("rgba", ("red", "green", "blue", "alpha"), strict=True)))


def tiles(cells: DataFrame, size: int, floor: float) -> DataFrame:
    """Cells with their tile; tiles without a cell at the floor or above are dropped."""
    rows = cells.withColumn("tr", F.floor(F.col("r") / size)).withColumn("tc", F.floor(F.col("c") / size))
    lit = rows.groupBy("field", "tr", "tc").agg(F.max("v").alias("m")).where(F.col("m") >= floor)
    return rows.join(lit, ["field", "tr", "tc"], "left_semi")


def tile_statistics(voxels: DataFrame, size: int, high: float = 18.0) -> DataFrame:
    """Of each tile the greatest value, its column's highest level at ``high`` or above, and how many columns reach it."""
    rows = voxels.withColumn("tr", F.floor(F.col("r") / size)).withColumn("tc", F.floor(F.col("c") / size))
    columns = rows.groupBy("tr", "tc", "r", "c").agg(F.max("v").alias("top"), F.max(F.when(F.col("v") >= high, F.col("lvl"))).alias("level"))
    return columns.groupBy("tr", "tc").agg(F.max("top").alias("top"), F.max_by("level", F.struct("top", -F.col("r"), -F.col("c"))).alias("level"), F.count_if(F.col("level").isNotNull()).alias("n_high"))


def prefer_left(base: DataFrame, detail: DataFrame) -> DataFrame:
    """Where the detail has both components it wins, both together."""
    rows = base.select("r", "c", F.col("u").alias("bu"), F.col("v").alias("bv")).join(detail.select("r", "c", F.col("u").alias("du"), F.col("v").alias("dv")), ["r", "c"], "full")
    both = F.col("du").isNotNull() & F.col("dv").isNotNull()
    return rows.select("r", "c", F.when(both, F.col("du")).otherwise(F.col("bu")).alias("u"), F.when(both, F.col("dv")).otherwise(F.col("bv")).alias("v"))


def frame_quality(pixels: DataFrame) -> DataFrame:
    """Share of lit pixels and number of mostly cyan rows; a good frame has 2 % of the first and under 5 of the second."""
    lum = F.greatest("r", "g", "b")
    cyan = (F.col("b") > 180) & (F.col("g") > 150) & (F.col("r") < F.col("b") - 60)
    lines = pixels.groupBy("frame", "y").agg(F.count(F.lit(1)).alias("n"), F.count_if(lum >= 16).alias("lit"), F.count_if(cyan).alias("cyan"))
    rows = lines.groupBy("frame").agg((F.sum("lit") / F.sum("n")).alias("lit"), F.count_if(F.col("cyan") > 0.4 * F.col("n")).alias("cyan_rows"))
    return rows.withColumn("good", (F.col("lit") >= 0.02) & (F.col("cyan_rows") < 5))


DARK = 6
BORDER = 4


def luminance(pixels: DataFrame, n: int) -> DataFrame:
    """``frame, y, x, dark, lum`` of all n x n places of each frame; one without a pixel is black."""
    at = F.sequence(F.lit(0), F.lit(n - 1))
    places = pixels.select("frame").distinct().withColumn("y", F.explode(at)).withColumn("x", F.explode(at))
    rows = places.join(pixels.select("frame", "y", "x", F.greatest("r", "g", "b").alias("lum")), ["frame", "y", "x"], "left")
    rows = rows.withColumn("lum", F.coalesce("lum", F.lit(0)))
    return rows.withColumn("dark", F.col("lum") <= DARK)


def straight_edges(dark: DataFrame) -> DataFrame:
    """``dark`` (frame, y, x, dark, all places) to ``frame, longest``: the longest straight edge between dark and lit, of either kind, along either axis.

    An edge lies between a pixel and the next one across; edges at consecutive
    places along the axis are one run.
    """
    def runs(along: str, across: str) -> DataFrame:
        edge = F.col("dark") != F.lead("dark").over(Window.partitionBy("frame", along).orderBy(across))
        edges = dark.withColumn("edge", edge).where("edge")
        run = F.col(along) - F.row_number().over(Window.partitionBy("frame", across).orderBy(along))
        return edges.withColumn("run", run).groupBy("frame", across, "run").agg(F.count(F.lit(1)).alias("n")).select("frame", "n")

    return runs("y", "x").union(runs("x", "y")).groupBy("frame").agg(F.max("n").alias("longest"))


def void_ring(dark: DataFrame, n: int, steps: int = 3) -> DataFrame:
    """``frame, share, ring, ring_lum``: the share of dark pixels, and how many pixels surround them and how bright these are.

    The dark grow by their four neighbours so many times, over the frame's edges
    to the other side; what they gain is the ring, without a border of the frame.
    """
    share = dark.groupBy("frame").agg(F.avg(F.when(F.col("dark"), 1.0).otherwise(0.0)).alias("share"))
    at = F.explode(F.sequence(F.lit(-steps), F.lit(steps)))
    grown = dark.where("dark").select("frame", "y", "x").withColumn("dy", at).withColumn("dx", at).where(F.abs("dy") + F.abs("dx") <= steps)  # so many steps of four neighbours
    grown = grown.select("frame", F.pmod(F.col("y") + F.col("dy"), F.lit(n)).alias("y"), F.pmod(F.col("x") + F.col("dx"), F.lit(n)).alias("x")).distinct()
    inside = F.col("y").between(BORDER, n - BORDER - 1) & F.col("x").between(BORDER, n - BORDER - 1)
    ring = dark.where(~F.col("dark") & inside).join(grown, ["frame", "y", "x"], "left_semi")
    ring = ring.groupBy("frame").agg(F.count(F.lit(1)).alias("ring"), F.avg("lum").alias("ring_lum"))
    return share.join(ring, "frame", "left").na.fill(0, ["ring"])


def void_verdict(pixels: DataFrame, n: int) -> DataFrame:
    """G12 with W9: whether a frame has a hole: dark parts that bright imagery surrounds, with a straight edge over 12 % of the frame."""
    dark = luminance(pixels, n)
    rows = void_ring(dark, n).join(straight_edges(dark), "frame", "left").na.fill(0, ["longest"])
    bounded = F.col("share").between(0.005, 0.97) & (F.col("ring") >= 40) & (F.col("ring_lum") >= 45)
    return rows.withColumn("void", F.coalesce(bounded & (F.col("longest") / n >= 0.12), F.lit(False)))


def rejected_frames(pixels: DataFrame, n: int) -> DataFrame:
    """A25 with G12: frames that are blank, banded or have a hole."""
    rows = frame_quality(pixels).join(void_verdict(pixels, n).select("frame", "void"), "frame")
    return rows.withColumn("rejected", ~F.col("good") | F.col("void"))


def coverage(pixels: DataFrame, y0: int, y1: int, x0: int, x1: int, floor: int = 6) -> DataFrame:
    """The share of a box that carries imagery."""
    box = pixels.where(F.col("y").between(y0, y1) & F.col("x").between(x0, x1))
    return box.groupBy("frame").agg(F.avg(F.when(F.greatest("r", "g", "b") > floor, 1.0).otherwise(0.0)).alias("covered"))


def probability(v: Column) -> Column:
    """G13."""
    return F.coalesce(F.least(F.greatest(v, F.lit(0.0)), F.lit(100.0)), F.lit(0.0))


def thinned(vertices: DataFrame, step: float) -> DataFrame:
    """Vertices snapped to a tier's grid, repeats in a row dropped; shared borders snap alike."""
    snap = lambda c: F.bround(F.col(c) / step) * step
    rows = vertices.withColumn("lat", snap("lat")).withColumn("lon", snap("lon"))
    order = Window.partitionBy("poly").orderBy("seq", "lat", "lon")
    same = (F.lag("lat").over(order) == F.col("lat")) & (F.lag("lon").over(order) == F.col("lon"))
    return rows.withColumn("_s", F.coalesce(same, F.lit(False))).where(~F.col("_s")).drop("_s")


#: fixed values: codes of 5, 18 and 30 dBZ, of a correlation of 0.8, of no rotation and the least notable one
REF_5, REF_18, REF_30, CORRELATION_LOW, NO_ROTATION, ROTATION = 76, 102, 126, 50, 128, 30


def tile_summary(voxels: DataFrame, size: int, levels: int, step_m: float) -> DataFrame:
    """``voxels`` (r, c, lvl, ref, cc, rot: codes) by tile.

    ``max_dbz``; the ``top_km`` of 18 dBZ in the column of the strongest voxel
    (of equal ones the lowest, then by row and column) and whether it is
    ``clipped`` at the highest level; voxels of ``debris`` and of ``rotation``.
    """
    rows = voxels.withColumns({"tr": F.floor(F.col("r") / size), "tc": F.floor(F.col("c") / size)})
    strongest = F.min(F.struct((-F.col("ref")).alias("o"), "lvl", "r", "c"))
    debris = F.count_if((F.col("ref") >= REF_30) & (F.col("cc") > CORRELATION_LOW))
    rotation = F.count_if((F.col("ref") >= REF_5) & (F.abs(F.col("rot") - NO_ROTATION) >= ROTATION))
    tiles = rows.groupBy("tr", "tc").agg(strongest.alias("s"), debris.alias("debris"), rotation.alias("rotation"))
    tops = rows.where(F.col("ref") >= REF_18).groupBy("r", "c").agg(F.max("lvl").alias("k"))
    tiles = tiles.select("tr", "tc", (-F.col("s.o")).alias("ref"), F.col("s.r").alias("r"), F.col("s.c").alias("c"), "debris", "rotation").join(tops, ["r", "c"], "left")
    k = F.coalesce("k", F.lit(-1))
    dbz = F.when(F.col("ref") >= 2, (F.col("ref") - 2) / 2 - 32)
    return tiles.select("tr", "tc", dbz.alias("max_dbz"), ((k + 1) * step_m / 1000).alias("top_km"), (k >= levels - 1).alias("clipped"), "debris", "rotation")


def mercator_lines(spark, box: tuple[float, float, float, float], width: int, height: int, lat0: float, lon0: float, step_lat: float, step_lon: float) -> tuple[DataFrame, DataFrame]:
    """G1: of a Mercator image of ``box`` (west, south, east, north) where each line ``i`` and each column ``j`` lies in the source.

    ``at`` is the place of its centre in source rows or columns, ``top`` and
    ``bottom`` those of its ends; source row r reaches from r to r + 1, begins at
    lat0 - r step_lat and goes south, source column c at lon0 + c step_lon.  As
    lines of a Mercator image differ in height, they cover a varying number of
    rows.  Both are dims of an image's height and width.
    """
    west, south, east, north = box
    _, y0 = mercator(F.lit(south), F.lit(west))
    _, y1 = mercator(F.lit(north), F.lit(west))
    row = lambda k: (lat0 - (F.degrees(2 * F.atan(F.exp((y1 - k * (y1 - y0) / height) / 6378137.0))) - 90)) / step_lat
    column = lambda k: (west + k * (east - west) / width - lon0) / step_lon
    ends = lambda of: [of(F.col("id") + 0.5).alias("at"), of(F.col("id") + 0.0).alias("top"), of(F.col("id") + 1.0).alias("bottom")]
    return spark.range(height).select(F.col("id").alias("i"), *ends(row)), spark.range(width).select(F.col("id").alias("j"), *ends(column))


def to_mercator(cells: DataFrame, rows: DataFrame, columns: DataFrame, how: str = "near") -> DataFrame:
    """G1 to a Mercator target (dims of ``mercator_lines``).

    ``near``: the cell under a pixel's centre; ``max``: the strongest of the cells
    that the pixel touches; ``bilinear``: the four cells around its centre, of
    which missing ones are left out and the rest weigh as one.  A pixel without a
    cell has no row.
    """
    if how == "near":
        rows, columns = (d.select(x, F.floor("at").alias(s)) for d, x, s in ((rows, "i", "r"), (columns, "j", "c")))
        return cells.join(F.broadcast(rows), "r").join(F.broadcast(columns), "c").select("field", "i", "j", "v")
    if how == "max":
        touched = lambda d, x, s: d.select(x, F.explode(F.sequence(F.floor("top"), F.greatest(F.ceil("bottom") - 1, F.floor("top")))).alias(s))
        rows, columns = touched(rows, "i", "r"), touched(columns, "j", "c")
        found = cells.where("v is not null").join(F.broadcast(rows), "r").join(F.broadcast(columns), "c")
        return found.groupBy("field", "i", "j").agg(F.max("v").alias("v"))

    def corners(dim: DataFrame, x: str, s: str, w: str) -> DataFrame:
        low = F.floor(F.col("at") - 0.5)
        share = F.col("at") - 0.5 - low
        pair = F.explode(F.array(F.struct(low.alias("s"), (1 - share).alias("w")), F.struct((low + 1).alias("s"), share.alias("w"))))
        return dim.withColumn("p", pair).select(x, F.col("p.s").alias(s), F.col("p.w").alias(w)).where(F.col(w) > 0)

    joined = cells.where("v is not null").join(F.broadcast(corners(rows, "i", "r", "wr")), "r").join(F.broadcast(corners(columns, "j", "c", "wc")), "c")
    w = F.col("wr") * F.col("wc")
    return joined.groupBy("field", "i", "j").agg((F.sum(w * F.col("v")) / F.sum(w)).alias("v"))


def products_to_mercator(cells: DataFrame, products: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """G1: ``cells`` (code, r, c, v) of many products, each as its catalog row (code, resample) has it; categories are never blended."""
    kinds = cells.withColumnRenamed("code", "field").join(F.broadcast(products.select(F.col("code").alias("field"), "resample")), "field")  # the catalog
    parts = [to_mercator(kinds.where(F.col("resample") == how), rows, columns, how) for how in ("near", "max", "bilinear")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumnRenamed("field", "code")
