"""Quality classification by nearest-neighbour voting in a latent-semantic space.

A bounded sample of labelled texts, half of each label, is turned into weighted
term vectors; their singular vectors span the latent space.  The sample's
latent vectors are broadcast (their number and length are parameters), every
text's cosine with all of them is computed in blocks, and the nearest vote with
their similarity as weight.

Terms are hashed words, trigrams of the shape of a text (runs of letters,
capitals, digits, signs) and how often words repeat.  Null, empty and wordless
texts have no terms and get the share of label 1 among training rows; where no
label can be learned from, all scores are 0.5.

Neighbours as near as the last one that counts vote too, so ties don't hang on
the order of the sample.  Labels of one document that differ count as 1; null
labels and labels of null ids are left out.  A document with a null doc_id has a
score, and no fold.  Rows that share a doc_id are scored each by its own text; of
a labelled id the longest text is learned from.  Very long texts are read whole.
Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.blocks import LOWER, Block, U, blocks, firsts
from isobar.llm.store import ship

WORD_TERMS = 1024
SHAPES = 12
OTHER_TERMS = 4
TERMS = WORD_TERMS + SHAPES**3 + OTHER_TERMS

_SHAPE = np.full(256, 8, np.int64)
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), range(0x80, 0x100), b" ", b"\n\r\t", b".", b",;:")):
    _SHAPE[list(_chars)] = _k
_SHAPE[list(b"!?")] = 9
_SHAPE[list(b"#*$%&|<>@^~_=+/\\{}[]")] = 10
_SHAPE[list(b"'\"()-")] = 11


@dataclass(frozen=True)
class Vote:
    sample: int = 2048  #: labelled texts learned from, at most
    rank: int = 48
    neighbours: int = 15
    power: float = 4.0  #: a neighbour's weight is its cosine to this power


def terms(block: Block) -> np.ndarray:
    """Damped term frequencies, a row for each text."""
    low = Block(LOWER[block.data], block.at, block.rows)
    starts, ends, owner = low.words()
    words = low.hashes(starts, ends)
    bounds = firsts(owner, block.n)
    counts = np.zeros((block.n, TERMS), np.float32)
    flat = owner * WORD_TERMS + (words % U(WORD_TERMS)).astype(np.int64)
    counts[:, :WORD_TERMS] = np.bincount(flat, minlength=block.n * WORD_TERMS).reshape(block.n, -1)
    shape = _SHAPE[block.data]
    new = np.ones(len(shape), bool)
    new[1:] = shape[1:] != shape[:-1]
    new[block.at[:-1][np.diff(block.at) > 0]] = True
    shape, text = shape[new], np.repeat(np.arange(block.n), np.diff(block.at))[new]
    if len(shape) > 2:
        inside = text[2:] == text[:-2]
        flat = (text[2:] * SHAPES**3 + (shape[:-2] * SHAPES + shape[1:-1]) * SHAPES + shape[2:])[inside]
        counts[:, WORD_TERMS:-OTHER_TERMS] = np.bincount(flat, minlength=block.n * SHAPES**3).reshape(block.n, -1)
    again = np.zeros(len(words), np.int64)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner, again, block.n)
    n = np.maximum(np.diff(bounds), 1)
    counts = np.log1p(counts)
    total = np.log1p(n)[:, None]
    counts[:, -4] = (20 * again / n).astype(np.float32) * total[:, 0]
    distinct = np.bincount(np.unique(np.stack([owner, (words >> U(1)).astype(np.int64)]), axis=1)[0], minlength=block.n) if len(words) else np.zeros(block.n)
    counts[:, -3] = (5 * (1 - distinct / n)).astype(np.float32) * total[:, 0] * (n >= 5)
    return counts / total


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["text"], 200_000):
            rows = terms(block).astype(np.float32)
            vectors = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["quality"].slice(block.rows.start, block.n), vectors], names=["quality", "vector"])


@dataclass(frozen=True)
class Space:
    """``weights`` of terms, ``axes`` (terms x rank), unit ``vectors`` of the sample, their ``labels`` and the ``prior``."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        out = (counts * self.weights) @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def latent_space(counts: np.ndarray, labels: np.ndarray, rank: int, prior: float) -> Space:
    weights = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 0.2).astype(np.float32)
    x = counts * weights
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    gram, basis = np.linalg.eigh((x @ x.T).astype(np.float64))
    keep = np.argsort(gram)[::-1][:rank]
    keep = keep[gram[keep] > 1e-6]
    axes = (x.T @ (basis[:, keep] / np.sqrt(gram[keep]))).astype(np.float32)
    space = Space(weights, axes, np.zeros((0, axes.shape[1])), labels, prior)
    return Space(weights, axes, space.place(counts), labels.astype(np.float32), prior)


def learn(docs: DataFrame, labels: DataFrame, vote: Vote = Vote(), fold_of: int = 3, fold: int = 1) -> Space | None:
    """The space of a sample of labelled rows whose id's crc32 isn't in the held-out fold; None without any."""
    ship(docs.sparkSession)
    ids = F.col("doc_id").cast("string")
    good = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = good.where(F.crc32(ids.cast("binary")) % fold_of != fold)
    prior, n = good.agg(F.avg("quality"), F.count(F.lit(1))).first()
    if not n:
        return None
    half = [good.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(vote.sample // 2) for k in (0, 1)]
    sample = half[0].union(half[1])  # at most vote.sample rows, so it can be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "quality", "doc_id")
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last()))
    rows = rows.withColumn("one", one).where("one = 1").select("text", F.col("quality").cast("int").alias("quality"))
    found = rows.mapInArrow(_vectors, "quality int, vector binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["vector"], r["quality"]))
    counts = np.stack([np.frombuffer(r["vector"], np.float32) for r in found])
    return latent_space(counts, np.array([r["quality"] for r in found]), vote.rank, float(prior))


def votes(space: Space, counts: np.ndarray, vote: Vote) -> np.ndarray:
    cosines = space.place(counts) @ space.vectors.T
    k = min(vote.neighbours, cosines.shape[1])
    last = np.partition(cosines, -k, axis=1)[:, -k]
    text, near = np.nonzero(cosines >= last[:, None])
    weight = np.maximum(cosines[text, near], 0) ** vote.power
    for_one = np.bincount(text, weight * space.labels[near], len(counts))
    return ((for_one + 1e-6 * space.prior) / (np.bincount(text, weight, len(counts)) + 1e-6)).clip(0, 1)


def _scores(space, vote: Vote):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"], 400_000):
                for lo in range(0, block.n, 256):  # also many short texts make no large matrix
                    hi = min(lo + 256, block.n)
                    part = Block(block.data[block.at[lo] : block.at[hi]], block.at[lo : hi + 1] - block.at[lo], slice(lo, hi))
                    score = votes(space.value, terms(part), vote) if space.value is not None else np.full(hi - lo, 0.5)
                    yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(block.rows.start + lo, hi - lo), pa.array(score.astype(float))], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, vote: Vote = Vote(), fold_of: int = 3, fold: int = 1) -> DataFrame:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, quality) to ``doc_id, held_out, score, predicted``."""
    ship(docs.sparkSession)
    space = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, vote, fold_of, fold))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scores(space, vote), "doc_id long, score double")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold_of == fold
    return rows.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
