"""Sinks and guards: documents, partitions, versions, and what must hold before anything is published."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def documents(rows: DataFrame, keys: list[str], order: str, header: dict[str, Column] | None = None) -> DataFrame:
    """One compact JSON document for each key, with its rows in order.  A key's rows are one feed, bounded as the feed is."""
    body = [c for c in rows.columns if c not in keys]
    parts = F.array_sort(F.collect_list(F.struct(order, *(c for c in body if c != order))))
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), parts.alias("rows"))
    extra = [v.alias(k) for k, v in (header or {}).items()]
    return out.select(*keys, F.to_json(F.struct(*extra, "n", "rows")).alias("value"))


def write_documents(docs: DataFrame, path: str) -> None:
    docs.select("value").write.option("compression", "gzip").text(path)


def write_tiles(rows: DataFrame, path: str, by: list[str]) -> None:
    """A folder for each tile; what has no row has no folder."""
    rows.repartition(*by).write.partitionBy(*by).parquet(path)


def publish(data: DataFrame, pointer: DataFrame, path: str) -> None:
    """The payload first, then what points at it."""
    data.write.parquet(f"{path}/data")
    pointer.write.mode("overwrite").json(f"{path}/pointer")


def guarded(rows: DataFrame, least: int, what: str) -> DataFrame:
    """The rows, if there are so many; else reading them fails."""
    n = rows.agg(F.count(F.lit(1)).alias("_n"))
    check = F.when(F.col("_n") < least, F.raise_error(F.concat(F.lit(f"refused: {what} has "), F.col("_n").cast("string")))).otherwise(F.lit(True))
    return rows.crossJoin(F.broadcast(n)).where(check).drop("_n")


class Refused(ValueError):
    """What was written isn't published."""


def write_guarded(rows: DataFrame, path: str, feed: str, least: dict[str, int], optional: tuple[str, ...] = (), of: tuple[int, int] | None = None) -> dict[str, int]:
    """Writes ``rows`` and publishes them only if they pass; returns how many there are of each feed.

    Counts are observed while the rows are written, to a folder beside ``path``;
    this takes the place of ``path`` at the end, or is deleted.  Each feed of
    ``least`` needs so many rows, one at least; an ``optional`` one may be absent
    as a whole, and the rest is published.  ``of``: so many parts of the input
    came, of so many; with fewer nothing is published.
    """
    if of is not None and of[0] < of[1]:
        raise Refused(f"{of[0]} of {of[1]} parts of the input are there")
    seen = Observation()
    counts = {f"n{i}": F.count_if(F.col(feed) == name) for i, name in enumerate(least)}
    context = rows.sparkSession.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(context._jsc.hadoopConfiguration())
    beside = f"{path.rstrip('/')}.new"
    rows.observe(seen, F.count(F.lit(1)).alias("all"), *(c.alias(k) for k, c in counts.items())).write.mode("overwrite").parquet(beside)
    found = {name: seen.get[f"n{i}"] for i, name in enumerate(least)}
    bad = {f: n for f, n in found.items() if n < max(least[f], 1) and not (f in optional and n == 0)}
    if bad or not seen.get["all"]:
        files.delete(at(beside), True)
        raise Refused("too few rows of " + ", ".join(f"{f} ({n})" for f, n in sorted(bad.items())) if bad else "no rows")
    old = f"{path.rstrip('/')}.old"
    files.delete(at(old), True)
    if files.exists(at(path)):
        files.rename(at(path), at(old))
    files.rename(at(beside), at(path))
    files.delete(at(old), True)
    return found


def tolerant_union(spark, paths: list[str], schema: str, least_files: int = 1) -> DataFrame:
    """The rows of all files that can be read to their end, with the ``file`` each is of; too few such files fail.

    Files that are missing, broken or break while they are read count for
    nothing, the rows of a file cut off no more than the rest of it.
    """
    there = []
    context = spark.sparkContext
    for p in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(p)
        if place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place):
            there.append(p)
    if len(there) < least_files:
        raise Refused(f"{len(there)} of {len(paths)} feeds are there")
    kept = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(*there)
    rows = kept.select("*", F.col("_metadata.file_path").alias("file"))
    read = rows.select("file").distinct().count()
    if read < least_files:
        raise Refused(f"{read} of {len(paths)} feeds could be read")
    return rows


def verdicts(counts: DataFrame, least: dict[str, int]) -> DataFrame:
    """Which feeds (``feed, n``) may be published."""
    limit = F.lit(0)
    for feed, n in least.items():
        limit = F.when(F.col("feed") == feed, n).otherwise(limit)
    return counts.withColumn("ok", F.col("n") >= limit)


def union_of_feeds(feeds: Iterable[DataFrame | None]) -> DataFrame:
    """The feeds that could be read, as one; one at least."""
    good = [f for f in feeds if f is not None]
    if not good:
        raise ValueError("no feed could be read")
    out = good[0]
    for f in good[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def readable(spark, paths: list[str], **options) -> list[DataFrame | None]:
    """CSV feeds with a header, None for those that can't be read."""
    out = []
    for p in paths:
        try:
            out.append(spark.read.options(header=True, mode="PERMISSIVE", **options).csv(p))
        except Exception:  # a feed that fails is left out; union_of_feeds asks for one at least
            out.append(None)
    return out


def versioned(docs: DataFrame, signature: Column, tier: Column) -> DataFrame:
    """A key by content: ``<signature>.<tier>.<first 8 of sha256>``."""
    return docs.withColumn("key", F.concat_ws(".", signature, tier, F.substring(F.sha2(F.col("value").cast("binary"), 256), 1, 8)))
