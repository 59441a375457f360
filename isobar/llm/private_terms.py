"""Personal data: spans by pattern, and terms that reveal them.

The protected entities are e-mail and IP addresses, card and phone numbers.
They are found by pattern and check.  A term near them (a word that is partly
or all within ``REACH`` characters, up to the next entity of the kind) discloses them to the degree that its pointwise mutual information
with the entity nears the entity's information content: over the whole corpus,
``PMI = log2 p(entity near | term) / p(entity near)`` and ``IC = -log2 p(entity
near)``.  An estimate out of few texts says little, so it is the lower limit of
``p(entity near | term)`` that counts (Wilson's, ``z`` standard errors down, with
the texts that hold the term as the number of trials).  A term whose PMI is at
least ``alpha * IC`` even then is a span too where it stands near an entity.  In
the sanitised text entities and such terms are generalised to their kind; terms
that give the entity away entirely (``PMI >= removal * IC``) are removed.

Positions are in code points.  Null and empty texts have no spans.  Very long
texts are searched whole.  Null doc_ids are kept.  Rows that share doc_id and
text have equal results, and count as one text.  Terms with equal figures fare
alike.  Other columns are ignored, and kept by ``sanitised``.  An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.natives import SPACES, maybe_broadcast, word_count
from isobar.llm.store import written

REACH = 48
#: from an entity on, as many characters and the rest of the word that the last of them is in
_REACHED = rf"(?s)^(?:.{{0,{REACH - 1}}}[^\x20\x09-\x0D]++|.{{0,{REACH}}})"
BROADCAST_ROWS = 200_000

#: leftmost matches as the plain patterns have them; possessive, and begun only
#: where a run begins or the last match ended, so that no text takes quadratic time
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)


@dataclass(frozen=True)
class Disclosure:
    alpha: float = 0.9
    removal: float = 0.99
    z: float = 3.0  #: standard errors that the estimate is lowered by


_LUHN = (
    "aggregate(sequence(1, length(digits)), 0, (s, i) -> s + case when i % 2 = 1 then int(substr(digits, length(digits) + 1 - i, 1))"
    " else int(substr('0246813579', int(substr(digits, length(digits) + 1 - i, 1)) + 1, 1)) end) % 10 = 0"
)


def _passes() -> Column:
    """Whether a match is one; ``digits`` is a column."""
    n = F.length("digits")
    small = F.forall(F.split("match", r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    card = F.when(n.between(14, 19), F.expr(_LUHN)).otherwise(False)
    return F.when(F.col("kind") == "email", True).when(F.col("kind") == "ip", small).when(F.col("kind") == "card", card).otherwise(n.between(10, 15))


def _matches(docs: DataFrame) -> DataFrame:
    """A row for each match of a pattern: ``start``, the match, and the text around it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")).where("text is not null")
    guard = {"email": F.instr("text", "@") > 0, "phone": F.instr("text", "+") > 0}
    found = {k: F.regexp_extract_all("text", F.lit(p), 0) for k, p in PATTERNS.items()}
    rows = rows.select("doc_id", "text_key", "text", *(F.when(guard.get(k, F.lit(True)), found[k]).otherwise(F.array().cast("array<string>")).alias(k) for k in KINDS))
    rows = rows.where(" or ".join(f"size({k}) > 0" for k in KINDS))
    each = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("m"), F.when(F.size(k) > 0, F.split("text", PATTERNS[k], -1)).alias("p")) for k in KINDS]
    rows = rows.select("doc_id", "text_key", F.explode(F.array(*each)).alias("k")).where("size(k.m) > 0")
    rows = rows.select("doc_id", "text_key", "k.kind", "k.p", F.posexplode("k.m").alias("i", "match"))
    rows = rows.select("doc_id", "text_key", "kind", "i", "match", F.length(F.get("p", F.col("i"))).alias("gap"), F.regexp_extract(F.reverse(F.get("p", F.col("i"))), _REACHED, 0).alias("back"), F.regexp_extract(F.get("p", F.col("i") + 1), _REACHED, 0).alias("ahead"))
    rows = rows.repartition("doc_id", "text_key").distinct()
    earlier = Window.partitionBy("doc_id", "text_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.length("match")).over(earlier), F.lit(0)) + F.col("gap")
    rows = rows.withColumn("start", start.cast("long")).withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
    return rows.where(_passes()).select("doc_id", "text_key", "kind", "start", (F.col("start") + F.length("match")).alias("end"), F.reverse("back").alias("back"), "ahead")


def _near(entities: DataFrame) -> DataFrame:
    """The words near entities, whole: ``kind, term, start, end``."""
    parts = lambda c: F.split(c, r"(?<=[\x20\x09-\x0D])|(?=[\x20\x09-\x0D])", -1)  # noqa: E731  white space and words, in turn
    back = entities.select("doc_id", "text_key", "kind", parts(F.col("back")).alias("w"), (F.col("start") - F.length("back")).alias("from"))
    ahead = entities.select("doc_id", "text_key", "kind", parts(F.col("ahead")).alias("w"), F.col("end").alias("from"))
    rows = back.union(ahead).select("doc_id", "text_key", "kind", "w", "from", F.posexplode("w").alias("i", "word"))
    start = F.col("from") + F.expr("aggregate(slice(w, 1, i), 0, (s, x) -> s + length(x))")
    rows = rows.where(F.col("word").rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("doc_id", "text_key", "kind", F.lower("word").alias("term"), start.cast("long").alias("start"), F.length("word").alias("n"))
    return rows.select("doc_id", "text_key", "kind", "term", "start", (F.col("start") + F.col("n")).alias("end")).distinct()


def _weighed(docs: DataFrame) -> DataFrame:
    """``text`` with a ``weight``: rows that share doc_id and text are one text together."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")).where("text is not null")
    again = rows.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    rows = rows.join(maybe_broadcast(again, BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    return rows.select("text", (1 / F.coalesce("copies", F.lit(1))).alias("weight"))


def disclosing_terms(docs: DataFrame, near: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``kind, term, pmi, ic`` of the terms over the threshold; all documents' words count.

    Terms that are in too few texts to reach it, were they near entities always,
    are left out before words are counted.
    """
    zz = rule.z * rule.z
    texts = _weighed(docs)
    n_words = texts.agg(F.rint(F.coalesce(F.sum(word_count(F.col("text")) * F.col("weight")), F.lit(0.0))).alias("n_words"))
    kinds = near.groupBy("kind").agg((F.count(F.lit(1)) + 1).alias("n_kind")).crossJoin(F.broadcast(n_words))  # a row for each kind
    kinds = written(kinds.select("kind", (-F.log2(F.col("n_kind") / (F.col("n_words") + 1))).alias("ic")))
    by_text = near.groupBy("kind", "term", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    by_term = by_text.groupBy("kind", "term").agg(F.sum("n").alias("n_near"), F.count(F.lit(1)).alias("texts")).join(F.broadcast(kinds), "kind")
    by_term = written(by_term.where(F.log2(1 + zz / F.col("texts")) <= (1 - rule.alpha) * F.col("ic") + 1e-9))
    words = texts.select(F.explode(F.split(F.lower("text"), SPACES)).alias("term"), "weight").where("term <> ''")
    listed = maybe_broadcast(by_term.select("term").distinct(), BROADCAST_ROWS)
    counts = words.join(listed, "term", "left_semi").groupBy("term").agg(F.rint(F.sum("weight")).alias("n"))
    rows = by_term.join(counts, "term").withColumn("p", F.least(F.lit(1.0), F.col("n_near") / F.col("n")))
    rows = rows.withColumn("trials", F.col("texts") / F.col("p"))
    least = (F.col("p") + zz / (2 * F.col("trials")) - rule.z * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("trials") + zz / (4 * F.col("trials") * F.col("trials")))) / (1 + zz / F.col("trials"))
    rows = rows.withColumn("pmi", F.log2("p") + F.col("ic")).withColumn("sure", F.log2(F.greatest(least, F.lit(1e-300))) + F.col("ic"))
    return rows.where(F.col("sure") >= rule.alpha * F.col("ic")).select("kind", "term", "pmi", "ic")


def private_spans(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """A row for each text with spans: ``doc_id, text_key`` and ``spans``: structs of start, rank of the kind, end, kind and action, in order."""
    entities = written(_matches(docs))
    near = written(_near(entities))
    terms = disclosing_terms(docs, near, rule)
    action = F.when(F.col("pmi") >= rule.removal * F.col("ic"), "remove").otherwise("generalise")
    told = near.join(terms, ["kind", "term"]).select("doc_id", "text_key", "start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("term").alias("kind"), action.alias("action"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    base = entities.select("doc_id", "text_key", "start", rank.alias("rank"), "end", "kind", F.lit("generalise").alias("action"))
    spans = base.union(told).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "rank", "end", "kind", "action"))).alias("spans"))
    clear = (  # a term inside an entity is part of it; one found near two kinds is one span
        "filter(spans, (s, i) -> s.kind <> 'term' or (not exists(spans, b -> b.kind <> 'term' and b.start < s.end and s.start < b.end)"
        " and (i = 0 or spans[i - 1].kind <> 'term' or spans[i - 1].start <> s.start)))"
    )
    return spans.withColumn("spans", F.expr(clear))


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def found(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` (doc_id, text) to each document's counts, the digest of its pattern spans, and all ``spans``."""
    spans = private_spans(docs, rule).withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    rows = rows.join(spans, rows["doc_id"].eqNullSafe(spans["s_id"]) & (rows["text_key"] == spans["s_key"]), "left")
    rows = rows.withColumn("base", F.expr("filter(spans, s -> s.kind <> 'term')"))
    count = lambda k: F.coalesce(F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long"), F.lit(0).cast("long"))
    counts = [F.when(F.col("base").isNull(), F.lit(0).cast("long")).otherwise(count(k)).alias(f"n_{k}") for k in KINDS]
    digest = F.sha2(F.coalesce(_joined("base"), F.lit("")).cast("binary"), 256)
    return rows.select("doc_id", *counts, digest.alias("base_sha256"), F.coalesce(_joined("spans"), F.lit("")).alias("spans"))


def sanitised(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The rows of ``docs`` with ``text`` sanitised; overlapping spans are one, named by the first."""
    spans = private_spans(docs, rule).withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "spans": "__spans"})
    rows = docs.join(spans, docs["doc_id"].eqNullSafe(spans["__id"]) & (F.xxhash64(docs["text"]) == spans["__key"]), "left")
    new = F.expr(
        "aggregate(__spans, struct('' as done, cast(0 as bigint) as at), (a, s) -> case when s.end <= a.at then a else struct("
        "concat(a.done, substr(text, a.at + 1, greatest(s.start - a.at, 0)), case when s.start < a.at or s.action = 'remove' then '' else concat('<', upper(s.kind), '>') end) as done,"
        " s.end as at) end, a -> concat(a.done, substr(text, a.at + 1)))"
    )
    return rows.select(*(F.when(F.col("__spans").isNull(), docs["text"]).otherwise(new).alias("text") if c == "text" else docs[c] for c in docs.columns))
