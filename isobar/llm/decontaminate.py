"""Benchmark decontamination by a prefix-filtered set join.

A window is ``size`` consecutive words of an item, or a whole shorter item.  A
document contains a window where it has all of the window's shingles in their
places, so the threshold is the whole window and its necessary prefix is one
shingle: the rarest.  Rarity is counted over all documents, for the shingles of
the benchmark; a window with a shingle that no document has can't occur.  Places
of prefix shingles in documents are joined with the windows, and the window's
length and the shingle's position bound where it may lie.  A place carries no
text; the words of documents with candidates are read once more and compared
with the windows, exactly.

The benchmark's shingles and windows are broadcast while they are at most
``BROADCAST_ROWS``; a larger benchmark is joined by shuffles.

Null, empty and wordless texts have no words and no hits.  Items without words
and null items are in no document; equal windows of several items count for all
of them.  An empty benchmark leaves all documents clean, and an empty table
gives an empty result.  Null doc_ids are kept.  Rows that share doc_id and text
have equal results.  Very long texts are rows of places, never rows of rows of
words.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.natives import ascii_lower, fenced, maybe_broadcast
from isobar.llm.store import written

WINDOW = 13
SHINGLE = 3
BROADCAST_ROWS = 200_000
#: everything but digits, letters of either case and characters beyond ASCII
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _shingle(words: Column, at: Column, n: int = SHINGLE) -> Column:
    """A hash of n words from place ``at`` (from 0) on, in full lower case: equal words have equal hashes."""
    return F.xxhash64(*(F.lower(F.get(words, at + j)) for j in range(n)))


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``window`` (its words joined), ``length``, ``items`` (ids as strings) and each shingle with its ``offset``."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item"), fenced(F.col("text"), _BETWEEN).alias("w"))
    items = items.withColumn("n", F.size("w") - 2).where("n > 0").withColumn("length", F.least("n", F.lit(size)))
    items = items.withColumn("first", F.explode(F.expr("sequence(1, n - length + 1)")))
    items = items.withColumn("window", ascii_lower(F.array_join(F.expr("slice(w, first + 1, length)"), " ")))
    windows = items.groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))
    windows = windows.withColumn("w", F.split("window", " ")).withColumn("k", F.least("length", F.lit(SHINGLE)))
    windows = windows.withColumn("offset", F.explode(F.expr("sequence(0, length - k)")))
    hashes = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        hashes = F.when(F.col("k") == k, _shingle(F.col("w"), F.col("offset"), k)).otherwise(hashes)
    return windows.select("window", "length", "items", "k", "offset", hashes.alias("shingle"))


def _places(docs: DataFrame, kinds: list[int], *keep: str) -> DataFrame:
    """Every place ``at`` of a document where k words begin, for each k in ``kinds``, with the hash of their shingle."""
    rows = docs.select(*keep, fenced(F.col("text"), _BETWEEN).alias("w"))
    rows = rows.select(*keep, "w", F.posexplode("w").alias("at", "word")).where((F.col("at") > 0) & (F.col("at") + 1 < F.size("w")))
    each = [F.struct(F.lit(k).alias("k"), _shingle(F.col("w"), F.col("at"), k).alias("shingle"), (F.col("at") + k < F.size("w")).alias("whole")) for k in kinds]
    if len(each) == 1:
        rows = rows.select(*keep, "at", each[0].alias("s"))
    else:
        rows = rows.select(*keep, "at", F.explode(F.array(*each)).alias("s"))
    return rows.where("s.whole").select(*keep, "at", "s.k", "s.shingle")


def _spans(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates (doc_id, text_key, start, length, window, items) whose words are the window's: ``spans`` of each document."""
    wanted = maybe_broadcast(candidates.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).distinct(), BROADCAST_ROWS)
    held = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["c_id"]) & (docs["text_key"] == wanted["c_key"]), "left_semi")
    held = held.select(F.col("doc_id").alias("d_id"), F.col("text_key").alias("d_key"), fenced(F.col("text"), _BETWEEN).alias("w"))
    of_doc = candidates.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length", "window", "items")).alias("c"))  # a text's own
    rows = of_doc.join(held, of_doc["doc_id"].eqNullSafe(held["d_id"]) & (of_doc["text_key"] == held["d_key"]))
    same = F.filter("c", lambda c: ascii_lower(F.array_join(F.slice("w", c["start"] + 1, c["length"]), " ")) == c["window"])
    rows = rows.select("doc_id", "text_key", same.alias("c")).dropDuplicates(["doc_id", "text_key"])
    return rows.select("doc_id", "text_key", F.array_sort(F.transform("c", lambda c: F.struct(c["start"], (c["start"] + c["length"]).alias("end"), c["items"]))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, hit_percent: int = 5) -> DataFrame:
    """``docs`` (doc_id, text) and ``benchmark`` (item_id, text) to a row for each document.

    ``n_words``; ``n_hit``: its words inside any window; ``n_items`` and
    ``items_sha256``: the items of its windows; ``contaminated``: whether hits
    are at least ``hit_percent`` of its words; ``text_key``: a hash of the text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    windows = written(_windows(benchmark, size))
    kinds = [r["k"] for r in windows.select("k").distinct().collect()]  # at most SHINGLE

    if kinds:
        kinds = sorted(kinds)
        listed = maybe_broadcast(windows.select("k", "shingle").distinct(), BROADCAST_ROWS)
        seen = _places(texts, kinds).join(listed, ["k", "shingle"], "left_semi").groupBy("k", "shingle").count()
        rated = windows.join(seen, ["k", "shingle"], "left")
        rarest = rated.groupBy("window", "length", "k").agg(F.min_by(F.struct("shingle", "offset"), F.struct("count", "shingle", "offset")).alias("r"), F.first("items").alias("items"), F.count_if(F.col("count").isNull()).alias("absent"))
        anchors = written(rarest.where("absent = 0").select("window", "length", "items", "k", "r.shingle", "r.offset"))
        found = _places(texts, kinds, "doc_id", "text_key").join(maybe_broadcast(anchors, BROADCAST_ROWS), ["k", "shingle"])
        found = found.withColumn("start", F.col("at") - F.col("offset")).where("start > 0")
        spans = _spans(texts, written(found.select("doc_id", "text_key", "start", "length", "window", "items")))
    else:
        spans = texts.limit(0).select("doc_id", "text_key", F.expr("cast(array() as array<struct<start int, end int, items array<string>>>)").alias("spans"))

    covered = F.expr("aggregate(spans, struct(0L as n, 0 as upto), (a, s) -> struct(a.n + greatest(0, s.end - greatest(s.start, a.upto)) as n, greatest(a.upto, s.end) as upto), a -> a.n)")
    of_doc = spans.select("doc_id", "text_key", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.col("spans.items")))).alias("items"))
    of_doc = of_doc.withColumnsRenamed({"doc_id": "h_id", "text_key": "h_key"})
    rows = texts.select("doc_id", "text_key", (F.size(fenced(F.col("text"), _BETWEEN)) - 2).cast("long").alias("n_words"))
    rows = rows.join(of_doc, rows["doc_id"].eqNullSafe(of_doc["h_id"]) & (rows["text_key"] == of_doc["h_key"]), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    rows = rows.select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"), "text_key")
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * hit_percent)).alias("contaminated"),
        "text_key",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, hit_percent: int = 5) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, as they are."""
    bad = contamination(docs, benchmark, size, hit_percent).where("contaminated").select(F.col("doc_id").alias("b_id"), F.col("text_key").alias("b_key")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["b_id"]) & (F.xxhash64(docs["text"]) == bad["b_key"]), "left_anti")
