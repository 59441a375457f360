"""Nearest neighbours by an inverted multi-index.

Vectors are quantised in two halves, each with centroids of its own, fitted on
a bounded sample (``Index.sample`` vectors, expected).  A cell is a pair of
centroids, and every vector is an entry of its cell.  For a query the pairs are
taken in order of summed distance from a heap that starts with the nearest pair
and is given the next one along each half.  Entries of the cells taken are
reranked by their exact distance on the original vectors.

A query takes cells twice: first until they hold ``Index.first`` entries, which
gives a distance within which there are as many neighbours as wanted; then all
cells whose summed distance is at most that, squared, plus ``spread``.  For near
pairs (q, x) of the sample, ``spread`` is the quantile ``Index.share`` of the
summed distance from q to the cell of x minus the squared distance of q and x.
So how many entries are looked at follows the data, and no number of cells or
candidates limits it.

Equal vectors are one entry with its ``k + 1`` smallest ids (more are never
needed, as a query leaves out no more than its own), and equal queries are one
search.  Entries are dealt into buckets of some ``Index.bucket`` entries: whole
cells put together, or parts of a large cell.  A query goes once to each bucket
that holds cells of it, tasks hold a bucket's entries and pass its queries by,
and each gives at most ``k + 1`` rows for a query and bucket.

On the driver: the sample, the centroids and the cells' numbers of entries
(``Index.most_centroids`` squared at most).

Vectors that are null, zero or hold null or non-finite entries take no part, nor
do those of another length than most have.  A null vec_id is a candidate, after
all others in ties, and no query.  Rows that share a vec_id are candidates each,
and none of a query with that id; equal rows count once.  With fewer candidates
all are returned.  Other columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.natives import maybe_broadcast
from isobar.llm.store import ship, written
from isobar.llm.whitening import finite, usual_length

HOT_PART = 1000
BROADCAST_ROWS = 50_000


@dataclass(frozen=True)
class Index:
    sample: int = 16_384  #: vectors that centroids and spread are fitted on, expected
    most_centroids: int = 1_024  #: of a half
    rounds: int = 12  #: of moving centroids
    first: int = 1_000  #: entries that the first cells hold at least
    share: float = 0.95  #: of near pairs whose cell is within reach
    bucket: int = 2_048  #: entries
    seed: int = 5


@dataclass(frozen=True)
class Cells:
    """Centroids of both halves and, once counted, the entries and buckets of each cell."""

    halves: tuple[np.ndarray, np.ndarray]
    spread: float
    count: np.ndarray | None = None
    bucket: np.ndarray | None = None  #: a cell's first bucket
    parts: np.ndarray | None = None  #: a cell's number of buckets

    @property
    def sides(self) -> tuple[int, int]:
        return len(self.halves[0]), len(self.halves[1])

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared distances of both halves of the rows of ``x`` to all centroids."""
        cut = self.halves[0].shape[1]
        return [np.maximum((h * h).sum(1)[:, None] + (c * c).sum(1) - 2 * h @ c.T, 0) for h, c in zip((x[:, :cut], x[:, cut:]), self.halves, strict=True)]

    def of(self, x: np.ndarray) -> np.ndarray:
        a, b = (d.argmin(1) for d in self.distances(x))
        return a * self.sides[1] + b

    def counted(self, count: np.ndarray, size: int) -> Cells:
        """With buckets: cells in order are put together up to ``size`` entries, larger ones are split."""
        parts = np.maximum(1, -(-count // size))
        bucket, now, held = np.zeros(len(count), np.int64), 0, 0
        for cell in np.flatnonzero(count):
            if held and (parts[cell] > 1 or held + count[cell] > size):
                now, held = now + 1, 0
            bucket[cell] = now
            held += count[cell]
            if parts[cell] > 1:
                now, held = now + parts[cell], 0
        return Cells(self.halves, self.spread, count, bucket, parts)


def moved_centroids(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids that start at rows of ``x`` and move to the mean of the rows nearest to them."""
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, column, k) for column in x.T], 1) if x.shape[1] else np.zeros((k, 0))
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def fitted(sample: np.ndarray, n: int, k: int, index: Index) -> Cells:
    """Centroids for ``n`` entries, about the fourth root of that for each half, and the spread of near pairs."""
    rng = np.random.default_rng(index.seed)
    centroids = int(min(index.most_centroids, 2 ** np.ceil(np.log2(max(n, 1)) / 4 + 2), max(1, len(sample) // 8)))
    cut = (sample.shape[1] + 1) // 2
    cells = Cells(tuple(moved_centroids(h, centroids, index.rounds, rng) for h in (sample[:, :cut], sample[:, cut:])), 0.0)
    queries = rng.choice(len(sample), min(256, len(sample)), replace=False)
    away = (sample * sample).sum(1) - 2 * sample[queries] @ sample.T + (sample[queries] ** 2).sum(1)[:, None]
    away[np.arange(len(queries)), queries] = np.inf
    near = np.argsort(away, axis=1)[:, : min(k, len(sample) - 1)]
    if not near.size:
        return cells
    a, b = cells.distances(sample[queries])
    home = cells.of(sample)[near]
    summed = np.take_along_axis(a, home // centroids, 1) + np.take_along_axis(b, home % centroids, 1)
    return Cells(cells.halves, float(np.quantile(summed - np.take_along_axis(away, near, 1), index.share)))


def pairs_in_order(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of places of two lists, by the sum of what they hold: ``(sum, place in a, place in b)``.

    A pair waits in the heap once the one before it in the second list has been
    taken; the first of each row once the row before it has begun.
    """
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    p, q = a[by_a].tolist(), b[by_b].tolist()
    heap = [(p[0] + q[0], 0, 0)]
    while heap:
        s, i, j = heapq.heappop(heap)
        yield s, int(by_a[i]), int(by_b[j])
        if j + 1 < len(q):
            heapq.heappush(heap, (p[i] + q[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(p):
            heapq.heappush(heap, (p[i + 1] + q[0], i + 1, 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d).astype(float)


def _coded(cells, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cell = cells.value.of(_matrix(part.column("v"), d)) if part.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell), part.column("hash"), part.column("v"), part.column("ids")], names=["cell", "hash", "v", "ids"])

    return run


def _probes(cells, d: int, index: Index, again: bool):
    """The buckets and cells of each query (hash, v, reach): the first cells, or ``again`` those within reach that weren't among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Cells = cells.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                one, two = c.distances(_matrix(part.column("v"), d))
                reach = part.column("reach").to_pylist()
                row, bucket, held = [], [], []
                for i in range(part.num_rows):
                    seen, by_bucket = 0, {}
                    limit = np.inf if reach[i] is None else reach[i] ** 2 + c.spread
                    for s, x, y in pairs_in_order(one[i], two[i]):
                        enough = seen >= index.first
                        if enough and (not again or s > limit):
                            break
                        cell = x * c.sides[1] + y
                        if not c.count[cell]:
                            continue
                        if enough or not again:
                            for p in range(c.bucket[cell], c.bucket[cell] + c.parts[cell]):
                                by_bucket.setdefault(int(p), []).append(cell)
                        seen += c.count[cell]
                    for p, own in by_bucket.items():
                        row.append(i)
                        bucket.append(p)
                        held.append(sorted(own))
                at_rows = pa.array(row, pa.int64())
                columns = [pa.array(bucket, pa.int64()), part.column("hash").take(at_rows), part.column("v").take(at_rows), pa.array(held, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "hash", "v", "cells"])

    return run


def _reranked(d: int, k: int):
    """Entries of a bucket, then its queries, to the nearest of these cells: ``hash, vec_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells, vectors, ids = None, [], [], []
        table = None
        for batch in batches:
            found: tuple[list, list, list] = ([], [], [])
            buckets = batch.column("bucket").to_numpy()
            is_query = batch.column("query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((buckets[1:] != buckets[:-1]) | (is_query[1:] != is_query[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(buckets)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                x = _matrix(part.column("v"), d)
                if buckets[lo] != now:
                    now, cells, vectors, ids, table = buckets[lo], [], [], [], None
                if not is_query[lo]:
                    cells.append(part.column("cell").to_numpy(zero_copy_only=False))
                    vectors.append(x)
                    ids.extend(part.column("ids").to_pylist())
                    continue
                if not vectors:
                    continue
                if table is None:
                    cell = np.concatenate(cells)
                    order = np.argsort(cell, kind="stable")
                    table = cell[order], np.concatenate(vectors)[order], order
                cell, rows, order = table
                for q, own, key in zip(x, part.column("cells").to_pylist(), part.column("hash").to_pylist(), strict=True):
                    starts, ends = np.searchsorted(cell, own), np.searchsorted(cell, own, "right")
                    places = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends, strict=True)])
                    if not len(places):
                        continue
                    away = rows[places] - q
                    score = np.sqrt((away * away).sum(1))
                    if len(score) > k + 1:  # ties of the last one stay
                        near = score <= np.partition(score, k)[k]
                        places, score = places[near], score[near]
                    best = heapq.nsmallest(k + 1, ((s, i is None, i or 0) for s, p in zip(score.tolist(), places, strict=True) for i in ids[order[p]]))
                    found[0].extend([key] * len(best))
                    found[1].extend(None if none else i for _, none, i in best)
                    found[2].extend(s for s, _, _ in best)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=["hash", "vec_id", "score"])

    return run


def _search(entries: DataFrame, queries: DataFrame, cells, d: int, k: int, index: Index, again: bool) -> DataFrame:
    """``queries`` (hash, v, reach) to their ``k + 1`` nearest in the cells taken."""
    probes = queries.mapInArrow(_probes(cells, d, index, again), "bucket long, hash binary, v array<double>, cells array<long>")
    own = entries.select("bucket", F.lit(False).alias("query"), "cell", "hash", "v", "ids", F.lit(None).cast("array<long>").alias("cells"))
    their = probes.select("bucket", F.lit(True).alias("query"), F.lit(None).cast("long").alias("cell"), "hash", "v", F.lit(None).cast("array<long>").alias("ids"), "cells")
    met = own.unionByName(their).repartition("bucket").sortWithinPartitions("bucket", "query")
    return met.mapInArrow(_reranked(d, k), "hash binary, vec_id long, score double")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """``hash, near``: the ``k + 1`` best (score, vec_id) in order."""
    place = F.row_number().over(Window.partitionBy("hash").orderBy("score", F.col("vec_id").asc_nulls_last()))
    best = found.withColumn("place", place).where(F.col("place") <= k + 1)
    return best.groupBy("hash").agg(F.array_sort(F.collect_list(F.struct("place", "score", "vec_id"))).alias("near"))


def _smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (vec_id, hash, v), all different, to ``hash, v, ids``: a row for each vector with its ``k`` smallest ids."""
    place = F.row_number().over(Window.partitionBy("hash", "v").orderBy(F.col("vec_id").asc_nulls_last()))
    rows = rows.withColumn("place", place).where(F.col("place") <= k)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "vec_id"))), lambda x: x["vec_id"])
    return rows.groupBy("hash", "v").agg(ids.alias("ids"))


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, hash, v`` of the rows that take part, equal ones once; the hash is of the vector."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(finite("v") & F.exists("v", lambda c: c != 0)).withColumn("v", F.transform("v", lambda c: c + F.lit(0.0)))  # no negative zero
    rows = written(rows.withColumn("hash", F.unhex(F.md5(F.to_binary(F.concat_ws(",", F.col("v").cast("array<string>")), F.lit("utf-8"))))))
    return written(rows.where(F.size("v") == usual_length(rows, "v")).distinct())


def neighbours(embeddings: DataFrame, k: int = 10, query_of: int = 100, index: Index = Index(), vector: str = "embedding") -> DataFrame:
    """``embeddings`` (vec_id, vector) to ``query_id, rank, vec_id, score`` of the rows whose id is divisible by ``query_of``."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = usable(embeddings, vector)
    entries = written(_smallest_ids(rows, k + 1))
    n = entries.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part = F.conv(F.substring(F.hex("hash"), 1, 8), 16, 10).cast("long") / 2**32
    sample = entries.where(part < index.sample / n).select("v", "hash").limit(2 * index.sample).collect()
    sample = np.array([r["v"] for r in sorted(sample, key=lambda r: r["hash"])] or [entries.first()["v"]])
    d = sample.shape[1]
    cells = fitted(sample, n, k, index)

    context = spark.sparkContext
    schema = "cell long, hash binary, v array<double>, ids array<long>"
    coded = written(entries.mapInArrow(_coded(context.broadcast(cells), d), schema))
    count = np.zeros(cells.sides[0] * cells.sides[1], np.int64)
    for r in coded.groupBy("cell").count().collect():  # most_centroids squared at most
        count[r["cell"]] = r["count"]
    cells = cells.counted(count, index.bucket)
    places = spark.createDataFrame([(int(i), int(cells.bucket[i]), int(cells.parts[i])) for i in np.flatnonzero(count)], "cell long, first long, parts long")
    salt = F.pmod(F.xxhash64("hash"), F.col("parts"))
    coded = coded.join(F.broadcast(places), "cell").withColumn("bucket", F.col("first") + salt)

    asked = rows.where(F.col("vec_id") % query_of == 0)
    queries = written(asked.select("hash", "v").distinct())
    shared = context.broadcast(cells)
    near = written(_nearest(_search(coded, queries.withColumn("reach", F.lit(None).cast("double")), shared, d, k, index, False), k))
    # one of the k + 1 may be the query itself, so the last is the reach; with fewer all cells are looked at
    reach = near.select("hash", F.when(F.size("near") > k, F.element_at("near", -1)["score"]).alias("reach"))
    more = _search(coded, queries.join(reach, "hash", "left"), shared, d, k, index, True)
    first = near.select("hash", F.explode("near").alias("x")).select("hash", "x.vec_id", "x.score")
    best = written(_nearest(first.unionByName(more), k))
    return _answers(asked.select("vec_id", "hash"), best, k)


def _answers(asked: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Each query's own list without itself; vectors that many queries share are fewer than ``HOT_PART``, so these lists are broadcast."""
    shares = written(asked.groupBy("hash").count().where(F.col("count") * HOT_PART > asked.count()).select("hash"))
    hot = F.broadcast(best.join(F.broadcast(shares), "hash", "left_semi"))
    rest = asked.join(F.broadcast(shares), "hash", "left_anti").join(maybe_broadcast(best, BROADCAST_ROWS), "hash")
    rows = asked.join(hot, "hash").unionByName(rest).withColumnRenamed("vec_id", "query_id")
    others = F.slice(F.filter("near", lambda x: ~x["vec_id"].eqNullSafe(F.col("query_id"))), 1, k)
    rows = rows.select("query_id", F.posexplode(others).alias("at", "x"))
    return rows.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
