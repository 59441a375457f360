"""Mixing sources to target weights by systematic sampling.

Every source gets a target size.  A document's expected number of copies is its
source's target over the source's size; the documents of a source are put in an
order, their expected copies summed up from one random offset, and each is
taken once per integer that its part of the sum crosses.

Documents that are much of their source (more than one part in ``LARGE``; so
there are fewer than that many) come first in the order.  What they bring more
or less than expected is made up by the others: their expected copies are what
is left of the target over what is left of the source, and the sum goes on with
these.  So a source's taken words miss its target by the size of a few small
documents, not by that of its largest, unless the others can't make it up.

The others are in order of size class (first two digits), then of a digest of
the id, so every class is taken at the same rate within one copy.  The sum is
never made in one task: a document's place is the number of documents in
smaller classes, plus those in its class whose digest has a smaller beginning,
plus its rank among the rest, and each of these counts is over a bounded number
of groups.  The beginning has more digits, the more documents there are.

Null texts have size 0.  A null source is a source, after all others.  Rows
that share a doc_id are documents of their own; of rows that are equal in
doc_id, source and text it doesn't matter which one is taken.  Very long texts
count like others.  Other columns are carried along by ``mixed``.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.natives import maybe_broadcast, word_count
from isobar.llm.store import written

WEIGHTS = (5, 2, 1)
LARGE = 50
BROADCAST_ROWS = 200_000


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, size) to a row for each source: ``source, source_size, n_docs, target``.

    Weights repeat over the sources in order.  A target stops at ``cap`` times
    the source's size and the excess goes to the others by weight, until none
    is above: with the sources in order of cap over weight, the first ones are
    at their cap, as long as what is left for a unit of weight would exceed it.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * F.lit(cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sources = sources.withColumn("capped", left * F.col("weight") >= F.col("most") * rest)
    total = F.sum("source_size").over(whole) * F.lit(share) - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(whole)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("capped"), F.col("most")).otherwise(total * F.col("weight") / open_weight)
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def _key(source: Column) -> Column:
    """Never null, so that it can be joined."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def _numbered(rows: DataFrame, n_docs: int) -> DataFrame:
    """Rows (``key, class, digest, doc_id, text_key``) with their ``place`` in the order of their source, from 1."""
    digits = 2
    while n_docs > 10**9 * 16 ** (digits - 2):
        digits += 1
    rows = rows.withColumn("part", F.substring("digest", 1, digits))
    groups = rows.groupBy("key", "class", "part").agg(F.count(F.lit(1)).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_class = before(Window.partitionBy("key", "class").orderBy("part"))
    classes = groups.groupBy("key", "class").agg(F.sum("n").alias("n"))
    classes = classes.select("key", "class", before(Window.partitionBy("key").orderBy("class")).alias("before"))
    groups = groups.select("key", "class", "part", in_class.alias("in_class")).join(classes, ["key", "class"])
    rank = F.row_number().over(Window.partitionBy("key", "class", "part").orderBy("digest", "doc_id", "text_key"))
    return rows.join(groups, ["key", "class", "part"]).withColumn("place", F.col("before") + F.col("in_class") + rank)


def _row_copies(docs: DataFrame, seed: int, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """``copies`` with ``text_key``, a hash of the text."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    digits = F.col("size").cast("string")
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), digest.alias("digest"), F.xxhash64("text").alias("text_key"))
    sizes = written(sizes.withColumn("class", (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).cast("int")).withColumn("key", _key(F.col("source"))))

    targets = source_targets(sizes.select("source", "size"), share, cap, weights)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("key")).cast("binary")), 1, 5), 16, 10).cast("double") / 2**20
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = written(targets.withColumn("key", _key(F.col("source"))).withColumns({"start": start, "rate": rate}).drop("source"))
    n_docs = targets.agg(F.sum("n_docs")).first()[0] or 0
    rows = sizes.join(maybe_broadcast(targets.drop("n_docs"), BROADCAST_ROWS), "key")
    is_large = F.col("size") * LARGE > F.col("source_size")

    def taken(begin: Column, rate: Column, place: Column) -> Column:
        return F.least(F.floor(begin + rate * place) - F.floor(begin + rate * (place - 1)), F.lit(int(cap))).cast("long")

    place = F.row_number().over(Window.partitionBy("key").orderBy("size", "digest", "doc_id", "text_key"))  # fewer than LARGE of a source
    large = written(rows.where(is_large).withColumn("place", place).withColumn("copies", taken(F.col("start"), F.col("rate"), F.col("place"))))
    done = large.groupBy("key").agg(F.sum(F.col("size") * F.col("copies")).alias("done"), F.sum("size").alias("large_size"), F.count(F.lit(1)).alias("n_large"))
    rest = targets.select("key", "source_size", "target", "start", "rate").join(done, "key", "left").na.fill(0, ["done", "large_size", "n_large"])
    left = F.col("source_size") - F.col("large_size")
    again = F.when(left > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(cap)), (F.col("target") - F.col("done")) / left))).otherwise(0.0)
    rest = written(rest.select("key", (F.col("start") + F.col("rate") * F.col("n_large")).alias("begin"), again.alias("again")))
    small = _numbered(rows.where(~is_large), n_docs).join(maybe_broadcast(rest, BROADCAST_ROWS), "key")
    small = small.withColumn("copies", taken(F.col("begin"), F.col("again"), F.col("place")))
    columns = ["doc_id", "source", "size", "source_size", "target", "copies", "text_key"]
    return small.select(*columns).union(large.select(*columns))


def copies(docs: DataFrame, seed: int = 0, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``docs`` (doc_id, text, source) to ``doc_id, source, size, source_size, target, copies``; the same at each run."""
    return _row_copies(docs, seed, share, cap, weights).drop("text_key")


def mixed(docs: DataFrame, seed: int = 0, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken.

    Equal rows (doc_id, source and text) share their copies out among them.
    """
    by = [F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_key").alias("__key")]
    taken = written(_row_copies(docs, seed, share, cap, weights).groupBy(*by).agg(F.sum("copies").alias("__n"), F.count(F.lit(1)).alias("__rows")))
    keyed = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__from": F.col("source").cast("string"), "__text": F.xxhash64("text")})

    def joined(taken: DataFrame) -> DataFrame:
        return keyed.join(taken, keyed["__doc"].eqNullSafe(taken["__id"]) & keyed["__from"].eqNullSafe(taken["__source"]) & (keyed["__text"] == taken["__key"]))

    rows = joined(taken.where("__n > 0 and __rows = 1"))
    again = taken.where("__n > 0 and __rows > 1")
    if not again.isEmpty():
        place = F.row_number().over(Window.partitionBy("__doc", "__from", "__text").orderBy(F.lit(1)))
        each = F.floor(F.col("__n") / F.col("__rows")) + F.when(F.col("__place") <= F.col("__n") % F.col("__rows"), 1).otherwise(0)
        more = joined(maybe_broadcast(again, BROADCAST_ROWS)).withColumn("__place", place).withColumn("__n", each).drop("__place")
        rows = rows.unionByName(more.where("__n > 0"))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*docs.columns)
