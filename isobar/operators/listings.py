"""Listings, inventories and reconciliation: what exists, what should, what goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.operators.sizes import maybe_broadcast, met
from isobar.sources.storage import kept, work_path


def next_offsets(inventory: DataFrame) -> DataFrame:
    """A message's last byte is one before the next distinct offset of its file; the last is open."""
    ends = inventory.select("file_id", "off").distinct()
    ends = ends.withColumn("end", F.lead("off").over(Window.partitionBy("file_id").orderBy("off")) - 1)
    return inventory.join(ends, ["file_id", "off"])


def coalesced(ranges: DataFrame, gap: int) -> DataFrame:
    """Byte ranges merged where at most ``gap`` bytes lie between; one without an end takes those before it in, and none after it."""
    order = Window.partitionBy("file_id").orderBy("off", F.col("end").asc_nulls_last())
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    follows = F.lag("end").over(order).isNotNull() & (F.col("off") - before - 1 <= gap)
    rows = ranges.withColumn("new", F.when(follows, 0).otherwise(1))
    rows = rows.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.when(F.bool_and(F.col("end").isNotNull()), F.max("end"))
    return rows.groupBy("file_id", "span").agg(F.min("off").alias("off"), end.alias("end"), F.count(F.lit(1)).alias("n")).drop("span")


def newest_runs(listed: DataFrame, keep: int) -> DataFrame:
    """Rows of each product's newest runs; ``purged`` is the rest.

    Only distinct runs are ranked, so a product with many files is no large group.
    """
    place = F.row_number().over(Window.partitionBy("product").orderBy(F.col("run").desc()))
    runs = listed.select("product", "run").distinct().withColumn("purged", place > keep)
    return listed.join(maybe_broadcast(runs), ["product", "run"])


def two_class_retention(runs: DataFrame, keep_all: int, keep_long: int, long_hours: int = 19) -> DataFrame:
    """Of whole runs (``runs``: product, run, hours, complete) the newest of all, and the newest of those with more than ``long_hours`` hours.

    A run that isn't complete is neither kept nor counted.
    """
    whole = F.coalesce("complete", F.lit(False))
    long = F.col("hours") > long_hours
    any_place = F.row_number().over(Window.partitionBy("product", whole).orderBy(F.col("run").desc()))
    long_place = F.row_number().over(Window.partitionBy("product", whole, long).orderBy(F.col("run").desc()))
    return runs.withColumn("kept", whole & ((any_place <= keep_all) | (long & (long_place <= keep_long))))


def publish_frontier(expected: DataFrame, published: DataFrame) -> DataFrame:
    """The last hour of the longest fully published beginning, and how many hours that is."""
    rows = expected.join(published.select("product", "run", "fh").distinct().withColumn("there", F.lit(1)), ["product", "run", "fh"], "left")
    order = Window.partitionBy("product", "run").orderBy("fh")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("m", F.sum(F.coalesce("there", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("n = m").groupBy("product", "run").agg(F.max("fh").alias("frontier"), F.max("n").alias("hours"))


def gaps(needed: DataFrame, rendered: DataFrame, published: DataFrame, keys: list[str]) -> DataFrame:
    """Needed and published, but not rendered."""
    return needed.join(rendered, keys, "left_anti").join(published, keys, "left_semi")


def as_of(rows: DataFrame, companions: DataFrame, before: int, after: int) -> DataFrame:
    """The newest companion stamp in ``[t - before, t + after]`` seconds; both have ``key`` and ``t``, companions ``obj``.

    Time is cut into bins as long as the span, by its end.  The newest companion
    up to there is in the same bin or the newest of the bin before, which is
    handed on; older ones are outside of the span.  So rows and companions meet in
    their order within a bin, and never as pairs.
    """
    width = before + after
    bin_of = F.floor(F.col("at") / width)
    right = companions.select("key", F.col("t").alias("at"), "obj").where("key is not null and at is not null").groupBy("key", "at").agg(F.max("obj").alias("obj")).withColumn("bin", bin_of)
    right = right.select("key", "bin", "at", F.struct(F.col("at").alias("ct"), "obj").alias("c"))
    handed = right.groupBy("key", (F.col("bin") + 1).alias("bin")).agg(F.max("c").alias("c")).select("key", "bin", F.col("c.ct").alias("at"), "c")
    left = rows.select("key", (F.col("t") + after).alias("at"), "t").where("key is not null and at is not null").distinct()
    left = left.select("key", bin_of.alias("bin"), "at", F.lit(None).cast(right.schema["c"].dataType).alias("c"), "t")
    none = F.lit(None).cast(left.schema["t"].dataType).alias("t")
    both = left.union(right.select("*", none)).union(handed.select("*", none))
    upto = Window.partitionBy("key", "bin").orderBy("at", F.col("t").isNotNull(), "c").rowsBetween(Window.unboundedPreceding, 0)
    newest = both.withColumn("c", F.last("c", ignorenulls=True).over(upto)).where(F.col("t").isNotNull() & (F.col("c.ct") >= F.col("t") - before))
    return rows.join(newest.select("key", "t", "c.ct", "c.obj"), ["key", "t"], "left")


def walk_back(wanted: DataFrame, there: DataFrame, offsets: list[int]) -> DataFrame:
    """``wanted`` (id, t) to the first of the offsets, in order of preference, at which a run is there."""
    tries = F.posexplode(F.array(*map(F.lit, offsets))).alias("rank", "offset")
    rows = wanted.select("id", "t", tries).withColumn("run", F.col("t") + F.col("offset"))
    rows = met(rows, kept(there.select("run").where("run is not null").distinct(), "runs"), ["run"])
    first = rows.groupBy("id", "t").agg(F.min("rank").alias("rank"))
    first = first.withColumn("offset", F.element_at(F.array(*map(F.lit, offsets)), F.col("rank") + 1)).withColumn("run", F.col("t") + F.col("offset"))
    best = first.groupBy("id").agg(F.min_by(F.struct("run", "offset"), F.struct("rank", "run")).alias("b"))
    return best.select("id", "b.run", "b.offset")


def newest_cycles(wanted: DataFrame, there: DataFrame, sources: list[tuple[str, int, int, bool]]) -> DataFrame:
    """``wanted`` (id, t) to the newest cycle that is there and valid at about t: ``id, source, cycle, fhr``.

    ``sources`` in order of preference: name, seconds between cycles, how many
    seconds to look back, and whether it forecasts.  A forecast is taken at the
    hour nearest to t, half to even, an analysis at hour 0.  ``there`` has
    ``source, cycle, fhr``.  The cycles looked at are a few dozen constants.
    """
    def tried(rank: int, name: str, step: int, back: int, forecasts: bool) -> Column:
        last = F.floor(F.col("t") / step) * step
        hour = lambda c: F.greatest(F.rint((F.col("t") - c) / 3600.0), F.lit(0.0)).cast("long") if forecasts else F.lit(0).cast("long")
        cycles = F.filter(F.transform(F.sequence(F.lit(0), F.lit(back // step)), lambda k: last - k * step), lambda c: F.col("t") - c <= back)
        return F.transform(cycles, lambda c: F.struct(F.lit(rank).alias("rank"), (F.col("t") - c).alias("age"), F.lit(name).alias("source"), c.cast("long").alias("cycle"), hour(c).alias("fhr")))

    tries = [tried(rank, *source) for rank, source in enumerate(sources)]
    rows = wanted.select("id", "t", F.explode(F.concat(*tries)).alias("x")).select("id", "t", "x.*")
    there = there.select("source", "cycle", "fhr").where("source is not null and cycle is not null and fhr is not null").distinct()
    rows = met(rows, kept(there, "cycles"), ["source", "cycle", "fhr"])
    # as one number, which an id's tries are folded into before the shuffle
    most = max(back for _, _, back, _ in sources) + 1
    rows = rows.groupBy("id", "t").agg(F.min(F.col("rank") * F.lit(most).cast("long") + F.col("age")).alias("m"))
    age, rank = F.col("m") % most, F.expr(f"m div {most}").cast("int")
    fhr = F.element_at(F.array(*(F.lit(s[3]) for s in sources)), rank + 1)
    rows = rows.select("id", "m", F.element_at(F.array(*(F.lit(s[0]) for s in sources)), rank + 1).alias("source"), (F.col("t") - age).alias("cycle"), F.when(fhr, F.rint(age / 3600.0)).otherwise(0).cast("long").alias("fhr"))
    best = rows.groupBy("id").agg(F.min_by(F.struct("source", "cycle", "fhr"), F.struct("m", "cycle")).alias("b"))
    return best.select("id", "b.*")


def rolled_up(sizes: DataFrame) -> DataFrame:
    """Bytes and objects by the first two and the first three parts of the path, with their share."""
    part = lambda i: F.try_element_at(F.split("path", "/"), F.lit(i))
    rows = sizes.select("size", part(1).alias("p1"), part(2).alias("p2"), part(3).alias("p3"))
    total = rows.agg(F.sum("size").alias("total"))
    sums = rows.groupingSets([["p1", "p2"], ["p1", "p2", "p3"]], "p1", "p2", "p3").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("objects"), F.grouping("p3").alias("g"))
    return sums.crossJoin(F.broadcast(total)).select(F.concat_ws("/", "p1", "p2", "p3").alias("prefix"), (3 - F.col("g")).cast("int").alias("depth"), "bytes", "objects", F.bround(F.col("bytes") * F.lit(100.0) / F.col("total"), 3).alias("share"))


def age_bin(seconds: Column) -> Column:
    """Under a day, to two, to seven, older."""
    return F.when(seconds < 86400, "<1").when(seconds < 2 * 86400, "1-2").when(seconds < 7 * 86400, "2-7").otherwise(">7")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """SO5: new values where they changed, added rows where there were none; ``changed`` tells which."""
    a = old.select(*keys, F.col("v").alias("old_v"))
    b = new.select(*keys, F.col("v").alias("new_v"))
    rows = a.join(b, keys, "full")
    changed = F.col("new_v").isNotNull() & ~F.col("new_v").eqNullSafe(F.col("old_v"))
    return rows.select(*keys, F.coalesce("new_v", "old_v").alias("v"), changed.alias("changed"))


def merged_stamps(mine: DataFrame, published: DataFrame, retain_s: int) -> DataFrame:
    """SO4: distinct stamps of both (product, tile, t), no older than the newest minus the retention, newest first as ``place`` from 1.

    Published stamps count only where their tiles have the size that mine have.
    """
    own = mine.select("product", "tile", "t").where("t is not null")
    rows = own.union(published.select("product", "tile", "t").join(own.select("product", "tile").distinct(), ["product", "tile"], "left_semi")).distinct()
    newest = rows.groupBy("product", "tile").agg(F.max("t").alias("m"))
    rows = rows.join(maybe_broadcast(newest), ["product", "tile"]).where(F.col("t") >= F.col("m") - retain_s).drop("m")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("product", "tile").orderBy(F.col("t").desc())))


def gaps_between(rows: DataFrame, key: str, order: list[str], t: str) -> DataFrame:
    """``gap`` from each row's ``t`` to the one before it in its group's order; a group's first row has none.

    Rows are cut into ranges of key and order, so a large group is spread over
    tasks; a range's first row looks back at the last row of the range before.
    """
    spark = rows.sparkSession
    path = work_path(spark, "gaps")
    rows = rows.select(F.col(key), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.col(t).alias("t"))
    by = [f"o{i}" for i in range(len(order))]
    rows = rows.repartitionByRange(key, *by).withColumn("part", F.spark_partition_id())
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    last = rows.groupBy(F.col(key).alias("of"), F.col("part").alias("held")).agg(F.max_by("t", F.struct(*by)).alias("t"))
    last = last.withColumn("before", F.lag("t").over(Window.partitionBy("of").orderBy("held"))).drop("t")  # a row for each range
    here = F.lag("t").over(Window.partitionBy(key, "part").orderBy(*by))
    rows = rows.withColumn("here", here).join(maybe_broadcast(last), F.col(key).eqNullSafe(F.col("of")) & (F.col("part") == F.col("held")))
    return rows.select(key, (F.col("t") - F.coalesce("here", "before")).alias("gap")).where("gap is not null")


def at_places(rows: DataFrame, key: str, value: str, places: dict[str, Column]) -> DataFrame:
    """Of each key, the values at the ``places`` (from 0, by ``n``, how many values there are) of its sorted values; nulls don't count.

    Equal values are one row with their number.  Rows are cut into ranges of key
    and value, so a large group is spread over tasks; the counts of the ranges
    tell which one holds a place, and only that one is sorted.
    """
    spark = rows.sparkSession
    path = work_path(spark, "ranks")
    counts = rows.select(F.col(key).alias("g"), F.col(value).alias("v")).where("v is not null").groupBy("g", "v").agg(F.count(F.lit(1)).alias("m"))
    counts = counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id())
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    by_key = Window.partitionBy("g")
    parts = counts.groupBy("g", "part").agg(F.sum("m").alias("k"))
    parts = parts.withColumn("before", F.sum("k").over(by_key.orderBy("part")) - F.col("k")).withColumn("n", F.sum("k").over(by_key))
    wanted = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), place.cast("long").alias("at")) for name, place in places.items())))
    parts = parts.withColumn("w", wanted).where((F.col("w.at") >= F.col("before")) & (F.col("w.at") < F.col("before") + F.col("k")))
    parts = parts.groupBy(F.col("g").alias("of"), F.col("part").alias("held")).agg(F.first("before").alias("before"), F.collect_list("w").alias("ws"))
    near = counts.join(parts, F.col("g").eqNullSafe(F.col("of")) & (F.col("part") == F.col("held")))
    near = near.withColumn("upto", F.col("before") + F.sum("m").over(Window.partitionBy("g", "part").orderBy("v"))).withColumn("w", F.explode("ws"))
    near = near.where((F.col("w.at") >= F.col("upto") - F.col("m")) & (F.col("w.at") < F.col("upto")))
    return near.groupBy(F.col("g").alias(key)).agg(*(F.max(F.when(F.col("w.name") == name, F.col("v"))).alias(name) for name in places))


def nearest_rank(p: float) -> Column:
    """The place round(p (n - 1))."""
    return F.rint(F.lit(p) * (F.col("n") - 1))


def middle() -> dict[str, Column]:
    """The places whose mean is the median."""
    half = (F.col("n") - 1) / 2
    return {"low": F.floor(half), "high": F.ceil(half)}


def manifest(frames: DataFrame, expected: DataFrame) -> DataFrame:
    """Of each run, maps from product to available and to expected hours."""
    per = lambda t: t.groupBy("run", "product").agg(F.sort_array(F.collect_set("fh")).alias("hours"))
    as_map = lambda t, name: per(t).groupBy("run").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("product", "hours")))).alias(name))
    return as_map(expected, "expected").join(as_map(frames, "available"), "run", "left")


def signature(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """A digest of each group's attribute rows, in order of their own digests; only these are collected."""
    each = F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256)
    return rows.groupBy(group).agg(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(each))).cast("binary"), 256).alias("signature"))


def inherited_tiers(tiers: DataFrame, ratio: float = 0.8) -> DataFrame:
    """From fine to coarse, a tier over ``ratio`` times the last kept finer one is dropped and that one takes over its least zoom.

    ``tiers`` (product, tier, bytes, min_zoom): a few rows a product, tier 0 the finest.
    """
    parts = F.array_sort(F.collect_list(F.struct("tier", "bytes", "min_zoom")))
    rows = tiers.groupBy("product").agg(parts.alias("p"))
    kept = F.expr(
        f"aggregate(p, cast(array() as array<struct<tier:int,bytes:bigint,min_zoom:int>>), (k, x) -> case"
        f" when size(k) = 0 or x.bytes <= {ratio}D * element_at(k, -1).bytes then concat(k, array(named_struct('tier', int(x.tier), 'bytes', bigint(x.bytes), 'min_zoom', int(x.min_zoom))))"
        f" else concat(slice(k, 1, size(k) - 1), array(named_struct('tier', element_at(k, -1).tier, 'bytes', element_at(k, -1).bytes, 'min_zoom', least(element_at(k, -1).min_zoom, int(x.min_zoom))))) end)"
    )
    rows = rows.select("product", F.explode(kept).alias("k"))
    return rows.select("product", "k.tier", "k.bytes", "k.min_zoom")


def top_prefixes(rolled: DataFrame, n: int = 18) -> DataFrame:
    """Of each depth the largest prefixes."""
    place = F.row_number().over(Window.partitionBy("depth").orderBy(F.col("bytes").desc(), "prefix"))
    return rolled.withColumn("place", place).where(F.col("place") <= n).drop("place")


def version_overhead(versions: DataFrame, group: str, now: int, days: int = 2, percent: int = 25) -> DataFrame:
    """``versions`` (group, key, t, size): what versions other than a key's newest take, and whether more than so many per cent of it is older than so many days."""
    newest = versions.groupBy(group, "key").agg(F.max("t").alias("newest"))
    rows = versions.join(newest, [group, "key"]).withColumn("live", F.col("t") == F.col("newest"))
    past = F.sum(F.when(~F.col("live") & (now - F.col("t") > days * 86400), F.col("size")).otherwise(0))
    out = rows.groupBy(group).agg(F.sum("size").alias("bytes"), F.sum(F.when(F.col("live"), 0).otherwise(F.col("size"))).alias("overhead"), past.alias("past"))
    return out.withColumn("stale", F.col("past") * 100 > F.col("overhead") * percent)


def pending_groups(needed: DataFrame, published: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each group (``grp, product``, a small dim) the frames (product, run, fh) that are published and not rendered yet, and whether there are any."""
    pending = needed.join(published.select("run", "fh").distinct(), ["run", "fh"], "left_semi")
    by_product = pending.groupBy("product").agg(F.count(F.lit(1)).alias("frames"))
    rows = groups.join(by_product, "product", "left").groupBy("grp").agg(F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"), F.count("frames").alias("products"))
    return rows.withColumn("has_work", F.col("frames") > 0)


def patched_runs(manifest: DataFrame, updates: DataFrame, first_hour: int = 0) -> DataFrame:
    """SO5: ``manifest`` (run, product, expected, available, src) after ``updates`` (run, product, src).

    A run that the manifest doesn't have is added with the expected hours of the
    newest run there is.  What is updated has ``first_hour`` among its available
    hours and the new source time.  ``changed``: whether the row differs.
    """
    newest = manifest.agg(F.max("run").alias("run"))
    model = manifest.join(F.broadcast(newest), "run").select("product", "expected")
    runs = updates.select("run").distinct().join(manifest.select("run").distinct(), "run", "left_anti")
    added = runs.crossJoin(F.broadcast(model)).select("run", "product", "expected", F.array().cast("array<int>").alias("available"), F.lit(None).cast(updates.schema["src"].dataType).alias("src"))  # a run's products
    rows = manifest.select("run", "product", "expected", "available", "src").union(added).join(updates.withColumnRenamed("src", "new"), ["run", "product"], "left")
    changed = F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("src"))
    hours = F.when(changed, F.array_sort(F.array_union("available", F.array(F.lit(first_hour))))).otherwise(F.col("available"))
    return rows.select("run", "product", "expected", hours.alias("available"), F.coalesce("new", "src").alias("src"), changed.alias("changed"))


def with_sources(manifest: DataFrame, sources: DataFrame) -> DataFrame:
    """The manifest's runs with ``sources`` (run, product, t) as a map from product to the newest source time; null where there is none."""
    newest = sources.where("t is not null").groupBy("run", "product").agg(F.max("t").alias("t"))
    maps = newest.groupBy("run").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("product", "t")))).alias("src_times"))  # a run's products
    return manifest.join(maps, "run", "left")


def changed_signatures(now: DataFrame, stored: DataFrame, failed: DataFrame, group: str) -> DataFrame:
    """Groups whose signature differs from the stored one and from the one that failed last."""
    named = lambda t, name: t.select(group, F.col("signature").alias(name))
    rows = now.join(named(stored, "stored"), group, "left").join(named(failed, "failed"), group, "left")
    changed = ~F.col("signature").eqNullSafe(F.col("stored")) & ~F.col("signature").eqNullSafe(F.col("failed"))
    return rows.select(group, "signature", changed.alias("changed"))
