"""Quality rules by distribution divergence.

Each document's histograms of character classes and of common words are compared
with references of its language by Jensen-Shannon distance.  The references are
the sums of all documents' histograms by language; the language of a document
is the reference that its words are nearest to, so ``lang`` need not be right.

Short texts have noisy histograms, so each comparison has a least length.
Null, empty and wordless texts have zero counts and fail the base rule.  Rows
are judged one by one, so repeated rows, ties and null doc_ids change nothing;
a null or unknown ``lang`` is in no reference.  A very long text is counted
whole, in a block of its own.  Other columns are ignored, and kept by
``passing``.  An empty table gives an empty result.
Without references (an empty table, no known language) only the base rule holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.blocks import LOWER, SPACE, Block, U, blocks, firsts, mix, segment_sum, windows
from isobar.llm.store import ship

#: fixed values: common words of four languages
COMMON = {
    "en": "the of and to in a is that for it was on are as with be by this from at".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es".split(),
}
LANGUAGES = tuple(COMMON)
WORD_BINS = 21

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_CLASS = np.full(256, 8, np.int32)  # other punctuation and control characters
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), range(0xC2, 0xF5), b" ", b"\n\t\r", b".,", b"#*$%&|<>")):
    _CLASS[list(_chars)] = _k
_CLASS[0x80:0xC0] = 9  # continuation bytes, not counted
CLASS_BINS = 9


@dataclass(frozen=True)
class Rules:
    """Limits.  Distances are in bits' square root, 0 to 1."""

    min_words: int = 10
    repeat_percent: int = 20
    class_distance: float = 0.30
    class_min_chars: int = 80
    word_distances: tuple[tuple[int, float], ...] = ((80, 0.30), (150, 0.23))  #: from so many words on, at most so far


def _word_table() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the common words in order, and their bins by language; the last bin is any other word."""
    words = sorted({w for ws in COMMON.values() for w in ws})
    joined = " ".join(words).encode()
    data = np.frombuffer(joined, np.uint8)
    block = Block(data, np.array([0, len(data)]), slice(0, 1))
    starts, ends, _ = block.words()
    hashes = block.hashes(starts, ends)
    bins = np.array([[COMMON[g].index(w) if w in COMMON[g] else WORD_BINS - 1 for g in LANGUAGES] for w in words])
    order = np.argsort(hashes)
    return hashes[order], np.vstack([bins[order], np.full((1, len(LANGUAGES)), WORD_BINS - 1)])


def histograms(block: Block, owner: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by text and class, and by text, language and common word; ``words`` are hashes of lower-cased words."""
    classes = _CLASS[block.data]
    text = np.repeat(np.arange(0, 10 * block.n, 10, dtype=np.int32), np.diff(block.at))
    by_class = np.bincount(text + classes, minlength=block.n * 10).reshape(block.n, 10)[:, :CLASS_BINS]
    known, bins = _word_table()
    at = np.searchsorted(known, words)
    at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != words)] = len(known)
    by_word = np.stack(
        [np.bincount(owner * WORD_BINS + bins[at, k], minlength=block.n * WORD_BINS).reshape(block.n, WORD_BINS) for k in range(len(LANGUAGES))], 1
    )
    return by_class, by_word


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance between counts in the last axis; 1 where one side is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / p.sum(-1, keepdims=True), q / q.sum(-1, keepdims=True)
        m = (p + q) / 2
        kl = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(-1)
        out = np.sqrt(np.maximum((kl(p) + kl(q)) / 2, 0))
    return np.where(np.isnan(out) | np.isnan(p).any(-1) | np.isnan(q).any(-1), 1.0, out)


def _folded(block: Block) -> tuple[np.ndarray, np.ndarray]:
    low = Block(LOWER[block.data], block.at, block.rows)
    starts, ends, owner = low.words()
    return owner, low.hashes(starts, ends)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of sums by language for each block."""
    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), object)
        for block in blocks(batch["text"]):
            by_class, by_word = histograms(block, *_folded(block))
            for k, lang in enumerate(LANGUAGES):
                own = langs[block.rows] == lang
                if own.any():
                    both = np.concatenate([by_class[own].sum(0), by_word[own, k].sum(0)])
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([both.tolist()], pa.list_(pa.int64()))], names=["lang", "counts"])


def references(docs: DataFrame) -> dict[str, list[int]]:
    """The histograms of whole languages; as many numbers at any size of the table."""
    sums = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(_sums, "lang string, counts array<long>")
    sums = sums.select("lang", *(F.col("counts")[i].alias(f"c{i}") for i in range(CLASS_BINS + WORD_BINS)))
    rows = sums.groupBy("lang").agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(CLASS_BINS + WORD_BINS))).collect()
    return {r["lang"]: list(r[1:]) for r in rows}


def base_counts(block: Block) -> dict[str, np.ndarray]:
    starts, ends, owner = block.words()
    bounds = firsts(owner, block.n)
    space = SPACE[block.data]
    points = ((block.data & 0xC0) != 0x80) & ~space
    line_start, line_end, line_of = block.runs(block.data != 10)
    filled = np.concatenate([[0], np.cumsum(~space)])
    lines = filled[line_end] > filled[line_start]
    line_of = line_of[lines]
    line_keys = block.hashes(line_start[lines], line_end[lines]) ^ mix(line_of.astype(U))
    kinds, once = np.unique(line_keys, return_index=True)
    keys, first = windows(block.hashes(starts, ends), owner, 5)
    keys ^= mix(owner[first].astype(U))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, first[twice], 1)
    np.add.at(change, first[twice] + 5, -1)
    return {
        "n_words": np.diff(bounds),
        "word_chars": segment_sum(points.astype(np.int64), block.at),
        "n_symbols": segment_sum(SYMBOLS[block.data].astype(np.int64), block.at),
        "n_dup_lines": np.bincount(line_of, minlength=block.n) - np.bincount(line_of[once], minlength=block.n),
        "n_repeat_words": segment_sum((np.cumsum(change)[:-1] > 0).astype(np.int64), bounds),
    }


def _verdict(block: Block, rules: Rules, known: dict[str, list[int]]) -> dict[str, np.ndarray]:
    names = [g for g in LANGUAGES if g in known]
    counts = base_counts(block)
    n_words = counts["n_words"]
    failed = (n_words < rules.min_words) | (100 * counts["n_repeat_words"] > rules.repeat_percent * n_words)
    by_class, by_word = histograms(block, *_folded(block))
    class_d, word_d = np.zeros(block.n), np.zeros(block.n)
    if names:
        ref = np.array([known[g] for g in names], float)
        words = np.stack([jensen_shannon(by_word[:, LANGUAGES.index(g)].astype(float), ref[k, CLASS_BINS:]) for k, g in enumerate(names)], 1)
        classes = np.stack([jensen_shannon(by_class.astype(float), r[:CLASS_BINS]) for r in ref], 1)
        word_d, class_d = words.min(1), classes.min(1)
    odd = (class_d > rules.class_distance) & (by_class.sum(1) >= rules.class_min_chars)
    for least, most in rules.word_distances:
        odd |= (word_d > most) & (n_words >= least)
    return counts | {"class_distance": class_d, "word_distance": word_d, "base_failed": failed, "kept": ~failed & ~odd}


def _judge(rules: Rules, known: dict[str, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                out = _verdict(block, rules, known)
                ids = batch["doc_id"].slice(block.rows.start, block.n)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, out.values())], names=["doc_id", *out])

    return run


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` (doc_id, text, lang) to each document's counts, distances, ``base_failed`` and ``kept``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"
    return rows.mapInArrow(_judge(rules, references(docs)), schema)


def passing(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; ``text`` and ``lang`` must be among them.

    Only texts go to the Python workers, and only the verdicts come back.
    """
    ship(docs.sparkSession)
    known = references(docs)

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        found = [_verdict(block, rules, known)["kept"] for block in blocks(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0, bool))

    return docs.where(kept(F.col("text")))
