"""Audit of how filters act together: one row for each part, order of the filters and step.

Every document has a mask of the filters that it fails, and a part keeps no
more than a count for each mask.  For a coalition S of filters the removal game
is worth the documents that fail any of S.  Its Hart-Mas-Colell potential
follows from that of the coalitions with one filter less,

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is P(all) - P(all without it).  Potentials are kept
as whole numbers, Q(S) = |S|! P(S), so that

    Q(S) = (|S| - 1)! v(S) + sum of Q(S without i),

and the value times the number of orders, n! P(all) - n! P(all without i), is
Q(all) - n Q(all without i), without rounding.  A step of an order takes what
its coalition is worth more than the one before.

Copies are found by the SHA-256 of the text.  Digests of more than one row in
``HOT_PART`` of them are fewer than ``HOT_PART``, so they are broadcast; the
rows of the others meet their digest's smallest id in a join.

A null text is empty.  A null ``lang`` is the part named by the empty string, as
is an empty one.  A null doc_id is no smaller than any other and has none
smaller, so it never fails E; neither does a row whose equals share its doc_id.
Labels that repeat an id count as 1 where any of them is 1; null ids have none.
Rows that share a doc_id are documents of their own.  Very long texts are read
whole.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.natives import SPACES, maybe_broadcast
from isobar.llm.store import written

FILTERS = "ABCDE"
HOT_PART = 1000
BROADCAST_ROWS = 200_000


def text_failures(text: Column) -> Column:
    """The bits of filters A to D: few words, repeated words, capitals, signs."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACES, -1), "")
    n, chars = F.size(words), F.length(text)
    capitals = chars - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (n < 100, F.lit(100) * F.size(F.array_distinct(words)) < F.lit(80) * n, F.lit(100) * capitals > F.lit(10) * chars, text.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def _copies(rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` (doc_id, digest, mask) with the bit set where a smaller doc_id has the digest too."""
    shared = written(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1 and least is not null"))
    many = F.col("n") * HOT_PART > rows.count()
    hot, rest = (shared.where(c).select("digest", "least") for c in (many, ~many))
    hot = F.broadcast(hot)  # fewer than HOT_PART rows
    common = rows.join(hot, "digest")
    others = rows.join(hot, "digest", "left_anti").join(maybe_broadcast(rest, BROADCAST_ROWS), "digest", "left")
    fails = F.when(F.col("doc_id") > F.col("least"), bit).otherwise(0)
    return common.unionByName(others).withColumn("mask", F.col("mask").bitwiseOR(fails)).drop("least")


def failures(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang) to ``doc_id, part, mask`` of the five filters."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_failures(text).alias("mask"),
    )
    return _copies(written(rows), 1 << FILTERS.index("E")).select("doc_id", "part", "mask")


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (doc_id) with ``good`` and ``toxic``, each 0 or 1, from ``labels`` (doc_id, quality, toxic)."""
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    labels = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    known = rows.where("doc_id is not null").join(labels, "doc_id", "left").na.fill(0, ["good", "toxic"])
    return known.unionByName(rows.where("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))


def removal_games(rows: DataFrame, n: int, measures: tuple[str, ...]) -> DataFrame:
    """``rows`` (part, mask, measures) to a row for each part: of each measure an array with what every coalition removes, by its bits."""
    masks = rows.groupBy("part", "mask").agg(*(F.sum(F.col(m).cast("long")).alias(m) for m in measures))
    worth = lambda m: F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(m)).otherwise(0)) for s in range(2**n)))
    return masks.groupBy("part").agg(*(worth(m).alias(m) for m in measures), F.sum(measures[0]).alias("total"))


def potentials(game: Column, n: int) -> Column:
    """``|S|! P(S)`` of every coalition S, by its bits; smaller numbers are done first, so what a coalition needs is there."""

    def following(done: Column, s: Column) -> Column:
        smaller = (F.when(s.bitwiseAND(1 << i) != 0, F.get(done, s - (1 << i))).otherwise(F.lit(0).cast("long")) for i in range(n))
        return F.concat(done, F.array(F.factorial(F.bit_count(s) - 1) * F.get(game, s) + sum(smaller, F.lit(0).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2**n - 1)), F.array(F.lit(0).cast("long")), following)


def steps(games: DataFrame, filters: str) -> DataFrame:
    """``games`` (part, total, docs, good, toxic) to a row for each part, order and step."""
    n = len(filters)
    everything = 2**n - 1
    rows = games.withColumn("potential", potentials(F.col("docs"), n))
    rows = rows.withColumn("filter_order", F.explode(F.array(*(F.lit("".join(p)) for p in permutations(filters)))))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    place = lambda f: F.instr("filter_order", f)
    before = sum((F.when(place(f) < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    own = sum((F.when(place(f) == F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    rows = rows.withColumns({"before": before, "own": own})
    after = F.col("before") + F.col("own")
    worth = lambda m, s: F.get(F.col(m), s)
    more = lambda m: worth(m, after) - worth(m, F.col("before"))
    rest = F.lit(everything) - F.col("own")
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - worth("docs", after)).alias("kept"),
        more("docs").alias("removed"),
        (worth("docs", F.col("own")) - more("docs")).alias("redundant"),
        (worth("docs", F.lit(everything)) - worth("docs", rest)).alias("unique_fails"),
        more("good").alias("good_lost"),
        more("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(everything)) - F.lit(n) * F.get("potential", rest)).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang) and ``labels`` (doc_id, quality, toxic) to the audit of filters A to E."""
    rows = marked(failures(docs), labels).withColumn("docs", F.lit(1))
    return steps(removal_games(rows, len(FILTERS), ("docs", "good", "toxic")), FILTERS)


#: orders that a filter's values are summed over
ORDERS = factorial(len(FILTERS))
