"""Line de-duplication by an exact set-similarity join.

A line's set holds its distinct word shingles (five words, in lower case; a
shorter line is one shingle).  A line is removed when an earlier one, by
document and place, is equal to it as a set or has a Jaccard similarity of the
threshold or more with it.

1.  Equal sets are one line; all but its first occurrence go.
2.  A line's shingles are put in the order of their hashes.  Lines that match
    share one of the first ``tau + 1`` in it, ``tau`` being how many a match may
    lack; these are a line's prefix.  So a line's shingles are never moved, only
    its prefix is, and a line that shares nothing in its prefix is done.
3.  Lines are candidates under a shingle that both have in their prefix, within
    the bounds that their lengths and the number of such shingles set.
4.  Lines under a shingle are compared with the earliest one there and with the
    one that has the fewest shingles before it, which settles large groups of
    copies; lines that neither settles are compared with all earlier ones.  All
    candidates are verified on the whole sets.
5.  Where more than ``CROWD`` lines are under a shingle with such a line, all
    its lines get a new order, of rarity among them, and new prefixes by it: the
    lines of a match that share crowded shingles alone are both among these.

Shingles are compared by 64-bit hashes, and lines with equal hashes of their
sets are equal.

Lines without a word are kept.  Null and empty texts have no lines; a very long
line is a set like any other.  Documents are in the order of doc_id, null last.
Rows that share a doc_id are one after the other, by a hash of the text; rows
that are equal in both are one document that is there several times, whose lines
are not earlier than their own repetitions: what one of them loses all lose.
Other columns are ignored, and kept by
``deduplicated``.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.natives import SPACES, maybe_broadcast, small
from isobar.llm.set_counts import SHINGLE
from isobar.llm.store import discard, tidily

LABELS = ("doc_id", "text_key", "pos")
#: more lines under one shingle are put in order of rarity
CROWD = 256
BROADCAST_ROWS = 1_000_000
_BLANK = " \t\n\x0b\x0c\r"


def _spare(percent: int, n: str = "n") -> Column:
    """How many shingles of a set of n a match may lack."""
    return F.col(n) - F.floor((percent * F.col(n) + 99) / 100).cast("int")


def _sets(lines: DataFrame, *keep: str) -> DataFrame:
    """Lines with a word to ``keep`` and ``shingles``: the hashes of their shingles in order, each once."""
    # lower case letter by letter: the two capitals whose lower case is longer, or hangs on what follows
    lower = F.lower(F.replace(F.replace(F.col("line"), F.lit("\u0130"), F.lit("i")), F.lit("\u03a3"), F.lit("\u03c3")))
    other = F.col("line").rlike(r"[\x09-\x0D]")
    words = F.array_remove(F.when(other, F.split(lower, SPACES, -1)).otherwise(F.split(lower, " ", -1)), "")
    words = lines.where(F.btrim("line", F.lit(_BLANK)) != "").select(*keep, words.alias("w"))
    n = F.greatest(F.size("w") - SHINGLE + 1, F.lit(1))
    each = F.arrays_zip(*(F.slice("w", i + 1, n) for i in range(SHINGLE)))  # a shorter line's is filled up with nulls, which hashes skip
    return words.select(*keep, F.sort_array(F.array_distinct(F.transform(each, lambda x: F.xxhash64(x)))).alias("shingles"))


def _met(rows: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of a line and an earlier one that share enough of their prefixes to match.

    One of them has nothing in common with the other's rest but what lies behind
    its own prefix.  ``more`` shingles of a line's prefix are not in ``rows``.
    """
    other = others.select("token", F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("f").alias("f2"))
    near = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    pairs = rows.join(other, "token").where((F.col("f2") < F.col("f")) & near).groupBy("key", "key2", "n", "n2", "more").agg(F.count(F.lit(1)).alias("both"))
    rest = F.greatest(F.col("n") - _spare(percent) - 1, F.col("n2") - _spare(percent, "n2") - 1)
    return pairs.where((F.col("both") + F.col("more") + rest) * (100 + percent) >= (F.col("n") + F.col("n2")) * percent).select("key", "key2")


def _sets_of(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """``key`` and ``shingles`` of ``lines`` (key, f), from their texts."""
    wanted = lines.groupBy("f.text_key").agg(F.collect_set(F.struct("f.pos", "key")).alias("at"))  # at most a text's lines
    held = texts.join(maybe_broadcast(lines.select("f.text_key").distinct(), BROADCAST_ROWS), "text_key", "left_semi")
    held = held.groupBy("text_key").agg(F.first("text").alias("text")).join(wanted, "text_key").select(F.split("text", "\n", -1).alias("l"), "at")
    return _sets(held.select("l", F.explode("at").alias("at")).select("at.key", F.get("l", F.col("at.pos")).alias("line")), "key")


def _matches(pairs: DataFrame, rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The keys of the later lines of pairs (key, key2) of ``rows`` that match on their whole sets."""
    pairs = tidily(pairs)
    keys = pairs.select("key").union(pairs.select("key2")).distinct()
    lines = tidily(rows.select("key", "f").distinct().join(keys, "key", "left_semi"))
    sets = tidily(_sets_of(lines, texts))
    a = sets.select("key", F.col("shingles").alias("x"))
    b = sets.select(F.col("key").alias("key2"), F.col("shingles").alias("y"))
    met = pairs.join(b, "key2").join(a, "key").select("key", F.size("x").alias("na"), F.size("y").alias("nb"), F.size(F.array_intersect("x", "y")).alias("both"))
    out = tidily(met.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("key").distinct())
    discard(pairs, lines, sets)
    return out


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose token more than one line has."""
    return rows.withColumn("lines", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("lines > 1").drop("lines")


def _by_rarity(rows: DataFrame, crowded: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The lines under crowded tokens, with prefixes in the order of how many of them have a shingle."""
    members = rows.join(crowded, "token", "left_semi").select("key", "n", "f").distinct()
    each = _sets_of(members, texts).join(members, "key").select("key", "n", "f", F.explode("shingles").alias("token"))
    each = each.withColumn("lines", F.count(F.lit(1)).over(Window.partitionBy("token")))
    each = each.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("lines", "token")))
    return each.where((F.col("rank") <= _spare(percent) + 1) & (F.col("lines") > 1)).select("token", "key", "n", "f", F.lit(0).alias("more"))


def matched_lines(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All lines with a word (``doc_id, text_key, pos, key, exact``: whether an equal one is earlier) and the keys that match an earlier line."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    split = texts.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    sets = _sets(split, *LABELS).select(*LABELS, F.xxhash64("shingles").alias("key"), F.size("shingles").alias("n"), "shingles")
    other = 100 * F.col("n") >= percent * (F.col("n") + 1)  # else only equal sets match
    lines = tidily(sets.select(*LABELS, "key", "n", F.when(other, F.slice("shingles", 1, _spare(percent) + 1)).alias("prefix")))
    here = F.struct(F.col("doc_id").isNull().alias("last"), *LABELS)
    first = tidily(lines.groupBy("key").agg(F.min(here).alias("f"), F.first("n").alias("n"), F.first("prefix").alias("prefix")))
    shared = _shared(first.select("key", "n", F.posexplode("prefix").alias("rank", "token")).withColumn("rank", F.col("rank") + 1))
    rows = tidily(shared.join(first.select("key", "f"), "key"))
    out = tidily(lines.join(first.select("key", "f"), "key").select(*LABELS, "key", (here > F.col("f")).alias("exact")))
    discard(lines, first)

    # the earliest and the nearest line under each shingle settle most
    pick = lambda order: rows.groupBy("token").agg(F.min_by(F.struct("token", "key", "n", "f"), order).alias("r")).select("r.*")
    centres = pick(F.col("f")).union(pick(F.struct("rank", "f"))).distinct()
    settled = _matches(_met(rows.withColumn("more", F.lit(0)), centres, percent), rows, texts, percent)
    still = tidily(rows.join(settled, "key", "left_anti"))
    crowded = tidily(still.groupBy("token").agg(F.count(F.lit(1)).alias("more")).where(F.col("more") > CROWD))
    if small(crowded, 0):
        pairs = _met(still.withColumn("more", F.lit(0)), rows, percent)
    else:
        rest = still.join(crowded, "token", "left").withColumn("crowded", F.col("more").isNotNull())
        rest = rest.withColumn("more", F.count_if("crowded").over(Window.partitionBy("key"))).where("not crowded")
        rare = tidily(_by_rarity(rows, crowded, texts, percent))
        pairs = _met(rest, rows, percent).union(_met(rare.join(settled, "key", "left_anti"), rare, percent)).distinct()
    more = _matches(pairs, rows, texts, percent)
    discard(rows, still, crowded)
    return out, settled.union(more)


def _lines_of(text) -> Column:
    """How many lines of a text have a word."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D][^\n]*")), F.lit(0)).cast("long")


def _cleaned(docs: DataFrame, percent: int) -> DataFrame:
    """The rows of ``docs`` with ``__text``, the text without the removed lines, and ``__equal``, how many of these equal an earlier line."""
    lines, found = matched_lines(docs, percent)
    gone = lines.join(found.withColumn("similar", F.lit(True)), "key", "left").where("exact or similar")
    gone = gone.select(*LABELS, "exact").distinct()  # equal rows lose the same lines
    gone = gone.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_set("pos").alias("__gone"), F.count_if("exact").alias("__equal"))  # at most a text's lines
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__key"]), "left")
    kept = F.array_join(F.filter(F.split(docs["text"], "\n", -1), lambda _, i: ~F.array_contains("__gone", i)), "\n")
    return rows.select(*(docs[c] for c in docs.columns), F.when(F.col("__gone").isNull(), docs["text"]).otherwise(kept).alias("__text"), F.coalesce("__equal", F.lit(0).cast("long")).alias("__equal"))


def line_report(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text) to ``doc_id, n_lines`` (with a word), ``n_equal`` and ``n_similar``: lines removed as equal to, or as like an earlier one.

    The texts without these lines are written as a table, and the counts are what
    is missing there.  A row for each doc_id; rows that share one are counted together.
    """
    rows = _cleaned(docs.select("doc_id", "text"), percent)
    texts = tidily(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__text").alias("text"), _lines_of("text").alias("n_lines"), F.col("__equal").alias("n_equal")), "texts")
    missing = F.col("n_lines") - _lines_of("text")
    return texts.groupBy("doc_id").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_equal").alias("n_equal"), F.sum(missing - F.col("n_equal")).alias("n_similar"))


def deduplicated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with the removed lines gone from ``text``.

    Rows with equal doc_id and text lose the same lines: those that are gone from all of them.
    """
    rows = _cleaned(docs, percent)
    return rows.select(*(F.col("__text").alias("text") if c == "text" else rows[c] for c in docs.columns))
