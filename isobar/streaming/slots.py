"""A table of slots that a stream rewrites: what a batch doesn't touch is neither read nor written.

Rows lie in folders ``data/of_slot=S/of_batch=B``.  A batch writes the touched slots
whole, as a version of its own, and then an index of all slots with the batch
that holds each.  An index counts once it is complete, so readers see a batch
whole or not at all, and a batch that is repeated starts from the index before it
and writes the same again.  Versions that neither of the last two indexes names
are deleted after.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.points import grid_dedup, strongest, top_k


def best_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each key's row of highest order; of equal ones that with the highest rest."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *(c for c in rest if c not in order))).alias("r"))
    return best.select(*keys, *(f"r.{c}" for c in rest))


class SlotTable:
    """Rows of ``schema`` by their long column ``slot``, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, slot: str):
        self.spark, self.path, self.schema, self.slot = spark, path, schema, slot

    def _files(self):
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(context._jsc.hadoopConfiguration()), context._jvm.org.apache.hadoop.fs.Path

    def _listed(self, folder: str) -> list[str]:
        files, at = self._files()
        place = at(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def batches(self) -> list[int]:
        """Batches with a complete index, the oldest first."""
        files, at = self._files()
        found = [int(n[6:]) for n in self._listed("index") if re.fullmatch(r"batch=\d+", n)]
        return sorted(b for b in found if files.exists(at(f"{self.path}/index/batch={b}/_SUCCESS")))

    def index(self, before: int | None = None) -> DataFrame:
        """``slot, batch``: the version of each slot, after the last batch or the last one ``before``."""
        known = [b for b in self.batches() if before is None or b < before]
        if not known:
            return self.spark.createDataFrame([], "slot long, batch long")
        return self.spark.read.schema("slot long, batch long").parquet(f"{self.path}/index/batch={known[-1]}")

    def _at(self, versions: list[tuple[int, int]]) -> DataFrame:
        paths = [f"{self.path}/data/of_slot={s}/of_batch={b}" for s, b in versions]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, at_least: int | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those of slots from ``at_least`` on.  The driver lists the slots' folders, as it does for any partitioned table."""
        index = self.index(before) if at_least is None else self.index(before).where(F.col("slot") >= at_least)
        return self._at([(r["slot"], r["batch"]) for r in index.collect()])

    def replace(self, rows: DataFrame, batch: int, drop_before: int | None = None) -> None:
        """The slots of ``rows`` get these rows in place of their own; slots below ``drop_before`` go."""
        column = F.col(self.slot)
        if drop_before is not None:
            rows = rows.where(column >= drop_before)
        folders = rows.withColumns({"of_slot": column, "of_batch": F.lit(batch).cast("long")})
        writer = folders.repartition("of_slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("of_slot", "of_batch").parquet(f"{self.path}/data")
        files, at = self._files()
        written = files.globStatus(at(f"{self.path}/data/of_slot=*/of_batch={batch}")) or []
        touched = self.spark.createDataFrame([(int(w.getPath().getParent().getName()[8:]), batch) for w in written], "slot long, batch long")
        kept = self.index(batch).join(touched.select("slot"), "slot", "left_anti").unionByName(touched)
        if drop_before is not None:
            kept = kept.where(F.col("slot") >= drop_before)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index/batch={batch}")  # two numbers a slot
        self._vacuum()

    def merge(self, rows: DataFrame, batch: int, into: Callable[[DataFrame], DataFrame], drop_before: int | None = None) -> None:
        """The slots of ``rows`` get what ``into`` makes of their rows, old and new."""
        rows = rows.persist()
        touched = rows.select(F.col(self.slot).cast("long").alias("slot")).distinct()
        old = self._at([(r["slot"], r["batch"]) for r in self.index(batch).join(touched, "slot", "left_semi").collect()])
        self.replace(into(old.unionByName(rows.select(*old.columns))), batch, drop_before)
        rows.unpersist()

    def _vacuum(self) -> None:
        """Deletes what neither of the last two indexes names, and the indexes before them."""
        files, at = self._files()
        known = self.batches()
        live = {(r["slot"], r["batch"]) for b in known[-2:] for r in self.spark.read.schema("slot long, batch long").parquet(f"{self.path}/index/batch={b}").collect()}
        for b in known[:-2]:
            files.delete(at(f"{self.path}/index/batch={b}"), True)
        for slot in self._listed("data"):
            if not re.fullmatch(r"of_slot=-?\d+", slot):
                continue
            versions = self._listed(f"data/{slot}")
            dead = [v for v in versions if re.fullmatch(r"of_batch=\d+", v) and (int(slot[8:]), int(v[9:])) not in live]
            for v in dead:
                files.delete(at(f"{self.path}/data/{slot}/{v}"), True)
            if len(dead) == len(versions):
                files.delete(at(f"{self.path}/data/{slot}"), True)


def upserting(table: SlotTable, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """K7, K8: for ``foreachBatch``: each key's row of highest order (pass, or source time), old or new."""
    return lambda batch, i: table.merge(batch, i, lambda rows: best_rows(rows, keys, order))


def recomputing(raw: SlotTable, out: SlotTable, overlap: int, of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """K4: for ``foreachBatch``: rows come into ``raw``, and the slots they touch are recomputed by ``of`` and replaced in ``out``.

    A row counts if its slot is at most ``overlap`` before the newest slot that
    has come in, this batch included; older ones are dropped.
    """

    def run(batch: DataFrame, i: int) -> None:
        batch = batch.persist()
        slot = F.col(raw.slot)
        newest = raw.index(i).agg(F.max("slot").alias("m")).union(batch.agg(F.max(slot).cast("long"))).agg(F.max("m")).first()[0]
        if newest is not None:
            fresh = batch.where(slot >= newest - overlap)
            touched = fresh.select(slot.alias("touched")).distinct()
            raw.merge(fresh, i, lambda rows: rows)
            out.replace(of(raw.read(newest - overlap).join(touched, slot == F.col("touched"), "left_semi")), i)
        batch.unpersist()

    return run


class FlashFeed:
    """K1: the flashes of the last ``minutes``, the newest of each cell and time bin, in two tiers.

    Flashes (``event_id, lat, lon, epoch``) come in as a stream.  Its state is the
    newest flash of each fine cell and bin (within one coarse cell, as a fine one
    may lie in two); it ends with the window, by the watermark.  What changed goes
    into a table by bins of ten minutes.  A pass then puts out the feed as of the
    end of the newest flash's bin: bins of the recent half hour by fine cells, the
    others by coarse ones, so flashes move from one tier to the other as time
    passes.  The feed is written first and then what points at it; a repeated
    batch replaces both.
    """

    SCHEMA = "slot long, event_id long, lat double, lon double, epoch long"
    BIN = 600

    def __init__(self, spark: SparkSession, path: str, minutes: int = 60, recent_minutes: int = 30, fine: tuple[float, int] = (0.01, 30), coarse: tuple[float, int] = (0.08, 120), most: int = 60_000):
        self.table = SlotTable(spark, f"{path}/cells", self.SCHEMA, "slot")
        self.spark, self.path, self.minutes, self.recent, self.fine, self.coarse, self.most = spark, path, minutes, recent_minutes, fine, coarse, most

    def _cells(self, size: float) -> list:
        return [F.rint(F.col(x) / size).cast("long") for x in ("lat", "lon")]

    def changes(self, flashes: DataFrame) -> DataFrame:
        """The stream's state, put out where it changed."""
        late = f"{self.minutes} minutes"
        rows = flashes.withColumn("at", F.timestamp_seconds("epoch")).withWatermark("at", late)
        names = ("fy", "fx", "cy", "cx")
        cells = [c.alias(n) for n, c in zip(names, [*self._cells(self.fine[0]), *self._cells(self.coarse[0])], strict=True)]
        newest = F.max_by(F.struct("event_id", "lat", "lon", "epoch"), F.struct("epoch", -F.col("event_id")))
        state = rows.groupBy(F.window("at", f"{self.fine[1]} seconds"), *cells).agg(newest.alias("f"))
        return state.select((F.floor(F.col("f.epoch") / self.BIN) * self.BIN).alias("slot"), "f.*")

    def feed(self, flashes: DataFrame, now: int) -> DataFrame:
        """What is published at ``now``, a multiple of a bin: oldest first."""
        rows = flashes.where((F.col("epoch") >= now - 60 * self.minutes) & (F.col("epoch") < now))
        newest = top_k(grid_dedup(rows, now, self.recent, self.fine, self.coarse), self.most, F.col("epoch").desc(), F.col("event_id"))
        return newest.orderBy("epoch", F.col("event_id").desc())

    def run(self, changed: DataFrame, batch: int) -> None:
        """For ``foreachBatch``."""
        if changed.isEmpty():  # a batch that only moves the watermark; the feed is as of the newest flash
            return
        keys = [*self._cells(self.fine[0]), *self._cells(self.coarse[0]), F.floor(F.col("epoch") / self.fine[1])]
        newest = changed.agg(F.max("epoch")).union(self.table.read(before=batch).agg(F.max("epoch"))).agg(F.max("max(epoch)")).first()[0]
        now = newest // self.fine[1] * self.fine[1] + self.fine[1]
        self.table.merge(changed, batch, lambda rows: strongest(rows, keys, "epoch", "event_id"), (now - 60 * self.minutes) // self.BIN * self.BIN)
        rows = self.feed(self.table.read(), now).withColumn("now", F.lit(now))
        rows.write.mode("overwrite").parquet(f"{self.path}/feeds/batch={batch}")
        pointer = self.spark.createDataFrame([(batch, now)], "batch long, now long")
        pointer.write.mode("overwrite").json(f"{self.path}/pointer")

    def published(self) -> DataFrame:
        """The feed of the last pass."""
        batch = self.spark.read.schema("batch long, now long").json(f"{self.path}/pointer").first()["batch"]
        return self.spark.read.parquet(f"{self.path}/feeds/batch={batch}")
