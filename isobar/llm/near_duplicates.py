"""N-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct 5-word shingles.  Two sets are linked when
their Jaccard similarity reaches the threshold; the join returns every
document's component of linked documents.

1.  All shingles are counted over all sets (``set_counts``).
2.  All shingles have one global order, by that count: rare first.  Two linked
    sets share a shingle among their first ``tau + 1``, ``tau`` being the number
    of a set's shingles that the other may miss.  A set whose shared shingles are
    too few to be linked with anything is dropped here.
3.  Sets under one shingle are first compared with the one that has the fewest
    shingles before it, the nearest to what copies have in common.  That joins a
    large group of near copies by as many comparisons as it has members.
4.  What is then still in different components is compared in full under rare
    shingles.  Frequent ones form further classes (``CLASSES``): where the first
    shared shingle is in class k, so are all later ones or in higher classes.
    The prefix is extended and its shingles of class k and above are dealt into
    parts by hash, such that two linked sets share k of them in one part; those
    k together are the key.  The number of parts follows the size of the sets, so
    a set has keys in proportion to its prefix.
5.  A shingle's place in both sets' order bounds what they can share, as nothing
    before the first shared one is; so sets with many shingles of their own are
    no candidates.  Every candidate is verified on the whole sets.

Shingles and sets are compared by 64-bit hashes.

Null, empty and wordless texts have an empty set and are linked with nothing.  A
document with a null doc_id is compared like any other; the least doc_id of its
component is its component_id, null where all are null.  Rows that share a
doc_id are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.blocks import U, Block, blocks, mix
from isobar.llm.components import components
from isobar.llm.set_counts import Part, ordered_sets, possible, prefixes, set_ids, sets_of, spare, verify
from isobar.llm.store import discard, ship, written

#: shingles in at most so many sets are of class 1, of class 2, and so on; a row
#: of a combination costs about as much as comparing a set's ranks with some
#: hundred others under a single shingle
CLASSES = (512, 16_384)
#: about so many shingles of an extended prefix are in one part
PART = 8
LABELS = ("doc_id", "text_key")


def shingle_sets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a block's texts, by text and then hash, and where each text's begin."""
    block = block.lower()
    starts, ends, owner = block.words()
    return sets_of(block.hashes(starts, ends), owner, block.n)


def _texts(batch: pa.RecordBatch) -> Iterator[Part]:
    for block in blocks(batch["text"]):
        shingles, bounds = shingle_sets(block)
        yield shingles, bounds, set_ids(shingles, bounds), [batch[c].slice(block.rows.start, block.n) for c in LABELS]


# ---- candidates


def size_class(n: int, percent: int) -> int:
    """Classes of sizes such that linked sets are in the same or in neighbouring ones."""
    k, top = 0, 1
    while n >= (top := top * 100 // percent + 1):
        k += 1
    return k


def _parts(size: int, percent: int) -> int:
    top = 1
    for _ in range(size + 1):
        top = top * 100 // percent + 1
    return max(1, int(spare(top - 1, percent)) // PART)


def combination_keys(shingles: np.ndarray, n: int, upto: list[int], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of k shingles for each class k from 2 on, and how many shingles the set loses at least, if two sets meet there first.

    No shingle of a lower class is shared then; and of those up to the key's last,
    at most k in its part and k - 1 in each other part.
    """
    own, tau = n - len(shingles), int(spare(n, percent))
    edges = [0, *upto, len(shingles)]
    own_size = size_class(n, percent)
    for k in range(2, len(edges)):
        if edges[k - 1] == edges[k] or own + edges[k - 1] + 1 > tau + 1:
            continue  # no shingle of class k can be the first shared one
        for size in (own_size, own_size + 1):
            parts = _parts(size, percent)
            end = min(len(shingles), tau + 1 + parts * (k - 1) - own)
            part = shingles[edges[k - 1] : end] % U(parts)
            for p in range(parts):
                at = np.flatnonzero(part == p) + edges[k - 1]
                if len(at) < k:
                    continue
                chosen = at[np.array(list(combinations(range(len(at)), k)))]
                key = np.full(len(chosen), (k << 32) + size, U)
                for j in range(k):
                    key = mix(key ^ shingles[chosen[:, j]])
                yield key.view(np.int64), own + np.maximum(edges[k - 1], chosen[:, -1] + 1 - k - (parts - 1) * (k - 1))


def _combinations(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for key, lost in combination_keys(np.frombuffer(row["shared"], U), row["n"], row["upto"], percent):
                    columns = [key, np.full(len(key), row["set_id"]), np.full(len(key), row["n"]), lost + 1, np.full(len(key), row["component"])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "set_id", "n", "rank", "component"])

    return run


def _crossing(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets under one key (``key, set_id, n, rank, component``) in different components, within the bounds.

    The key's largest component is only ever on one side.
    """
    counts = rows.groupBy("key", "component").count()
    most = counts.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("most"), F.count(F.lit(1)).alias("met")).where("met > 1").drop("met")
    rows = rows.join(most, "key")
    left = rows.where("component <> most").select("key", F.col("set_id").alias("l"), F.col("component").alias("cl"), F.col("n").alias("nl"), F.col("rank").alias("il"))
    right = rows.select("key", F.col("set_id").alias("r"), F.col("component").alias("cr"), F.col("n").alias("nr"), F.col("rank").alias("ir"), "most")
    near = possible("nl", "il", "nr", "ir", percent)
    pairs = left.join(right, "key").where((F.col("cl") != F.col("cr")) & ((F.col("cr") == F.col("most")) | (F.col("cl") < F.col("cr"))) & near)
    return pairs.select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked; shingles that only one set has are in no intersection, so ``shared`` is enough."""
    a = sets.select(F.col("set_id").alias("a"), F.col("shared").alias("x"), F.col("n").alias("na"))
    b = sets.select(F.col("set_id").alias("b"), F.col("shared").alias("y"), F.col("n").alias("nb"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "x", "y", "na", "nb").mapInArrow(verify(percent), "a long, b long")


# ---- the join


def linked_components(docs: DataFrame, percent: int = 80, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """``duplicate_components`` with ``text_key``, a hash of the text."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    rows = written(ordered_sets(texts, _texts, LABELS, percent, classes))
    sets = rows.where("shared is not null").groupBy("set_id").agg(*(F.first(c).alias(c) for c in ("n", "shared", "upto")))
    sets = written(sets)
    prefix = written(sets.mapInArrow(prefixes(percent), "token long, set_id long, n long, rank long, class long"))

    # each with one set under the same shingle
    nearest = F.struct("rank", "set_id")
    centre = prefix.groupBy("token").agg(*(F.min_by(c, nearest).alias(x) for c, x in (("set_id", "a"), ("n", "na"), ("rank", "ia"))))
    stars = prefix.join(centre, "token").where((F.col("set_id") != F.col("a")) & possible("n", "rank", "na", "ia", percent))
    stars = stars.select(F.least("a", "set_id").alias("a"), F.greatest("a", "set_id").alias("b"))
    links = written(_verified(stars.distinct(), sets, percent))
    found = components(links)

    # the rest, where components meet
    placed = prefix.join(found.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    meet = placed.groupBy("token").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("token")
    open_ = written(placed.join(meet, "token"))
    pairs = _crossing(open_.where("class = 1").select(F.col("token").alias("key"), "set_id", "n", "rank", "component"), percent)
    frequent = open_.where("class > 1").select("set_id", "component").distinct()
    keys = written(sets.join(frequent, "set_id").mapInArrow(_combinations(percent), "key long, set_id long, n long, rank long, component long"))
    pairs = pairs.union(_crossing(keys, percent))
    more = written(_verified(pairs.distinct(), sets, percent))
    if not more.isEmpty():
        found = components(links.union(more))
    discard(prefix, open_, keys, links, more, sets)

    # the smallest document of each component
    full = rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_doc"))
    full = full.join(found.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    least = full.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    ids = full.join(least, "component").select("set_id", "component_id", "component")
    out = rows.where("n > 0").join(ids, "set_id").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", "component")
    return out.union(rows.where("n = 0").select("doc_id", "text_key", F.col("n"), F.col("doc_id"), F.lit(None).cast("long")))


def duplicate_components(docs: DataFrame, percent: int = 80, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """``docs`` (doc_id, text) to ``doc_id, n_shingles, component_id``: the smallest doc_id reachable by links.

    Links are pairs whose shared shingles are ``percent`` or more of all theirs.
    ``classes`` changes the work, not the result.  Other columns of ``docs`` are
    ignored.  An empty table gives an empty result.
    """
    return linked_components(docs, percent, classes).select("doc_id", "n_shingles", "component_id")


def without_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each component, and all rows with empty sets.

    The row with the smallest doc_id stays (null last), of several texts with
    that id one by a hash, of equal rows any one.
    """
    found = written(linked_components(docs, percent))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    stays = found.where("component is not null").groupBy("component").agg(F.min(order).alias("s"))
    found = found.where("component is not null").join(stays, "component").withColumn("stays", order == F.col("s"))
    gone = found.where("not stays").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    again = found.where("stays").groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).count().where("count > 1").drop("count")
    keyed = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__text": F.xxhash64("text")})
    same = lambda other: keyed["__doc"].eqNullSafe(other["__id"]) & (keyed["__text"] == other["__key"])
    kept = keyed.join(gone, same(gone), "left_anti")
    once = kept.join(again, (kept["__doc"].eqNullSafe(again["__id"])) & (kept["__text"] == again["__key"]), "left_anti")
    repeated = kept.join(again, (kept["__doc"].eqNullSafe(again["__id"])) & (kept["__text"] == again["__key"]), "left_semi").dropDuplicates(["__doc", "__text"])
    return once.union(repeated).select(*docs.columns)
