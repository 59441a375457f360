"""Language-model scoring by a weighted backoff automaton.

Training counts all n-grams up to ``order`` in the texts that aren't held out.
A history that was seen is a state.  A seen n-gram is an arc, weighted with its
smoothed log10 probability; every state has a failure arc to its longest proper
suffix, weighted with the log10 of the mass it keeps for what it hasn't seen
(Dirichlet smoothing: ``mu / (count + mu)``).  Reading a text from left to
right, the state carried to a token is the longest seen suffix of what was
read, failure arcs are followed until an arc for the token is there, and the
weights on the way add up.  The root has an arc for every word: an add-k
unigram model.

The model is as large as the corpus, so it is never in one place.  Texts are
taken in chunks; each chunk asks for the counts of its distinct n-grams, in
packed sorted arrays, by ranges of the key space.  Each range adds up what all
chunks bring and answers each chunk.  Then each chunk compiles its part of the
automaton (states, arcs, failure arcs) and reads its texts with it, all of them
in step: long texts are read in segments, whose first state is carried there by
reading the ``order - 1`` tokens before.

Words have 64-bit keys.  Keys of longer n-grams have ``SPARE_BITS`` more bits
than it takes to count the words, so that at every size about one n-gram in
2**SPARE_BITS shares its key with another, and adds to its count.

``chunk_words`` and ``range_bytes`` are as much as a worker holds.  Rows go by
chunk and range; beyond ``direct`` ranges they go through relays, so that rows
don't grow with the square of the table.

Null and empty texts are one end token.  A document with a null doc_id has no
fold: it is scored, not learned from, and its ``held_out`` is null.  Rows that
share a doc_id are documents of their own, all learned from.  Very long texts
are read in segments like all others.  Other columns are ignored.  An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.blocks import U, blocks, firsts, mix, segment_sum
from isobar.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from isobar.llm.relay import DIRECT, Levels, by_slot, checked, levels, merged
from isobar.llm.store import settled, ship, written

END, START = U(0x5EED0E0D), U(0x5EED0B05)
_STEP = U(0x9FB21C651E98DF25)
SPARE_BITS = 20


@dataclass(frozen=True)
class Model:
    order: int = 3
    add_k: float = 0.1
    mu: float = 2.0
    held_out_of: int = 10
    chunk_words: int = 1_000_000
    range_bytes: int = 4_000_000
    segment: int = 256
    direct: int = DIRECT


@dataclass
class Chunk:
    """Texts as places in a sorted vocabulary; each text's tokens end with END.  ``held``: 0, 1, or 2 for a null id."""

    name: int
    doc_ids: list[int | None]
    bounds: np.ndarray
    held: np.ndarray
    vocab: np.ndarray
    codes: np.ndarray

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each length: the keys, and at which tokens they end.  A text's first history is START."""
        words = self.vocab[self.codes]
        place = np.arange(len(words)) - self.bounds[:-1].repeat(np.diff(self.bounds))
        keys, at = words.copy(), np.arange(len(words))
        yield 1, keys, at
        before = [words]
        for k in range(2, order + 1):
            shifted = np.empty_like(words)
            shifted[k - 1 :] = words[: len(words) - k + 1]
            shifted[place == k - 2] = START
            before.append(shifted)
            key = before[-1].copy()
            for w in before[-2::-1]:
                key = mix(key * _STEP + w)
            at = np.flatnonzero(place >= k - 2)
            yield k, key[at], at


def _fold(doc_id: int | None, of: int) -> int:
    return 2 if doc_id is None else int(zlib.crc32(b"%d" % doc_id) % of == 0)


def chunks(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[Chunk]:
    ids, parts, n, name = [], [], 0, TaskContext.get().partitionId() << 24

    def done() -> Chunk:
        words = np.concatenate([w for w, _ in parts])
        sizes = np.concatenate([c for _, c in parts])
        vocab, codes = np.unique(words, return_inverse=True)
        held = np.array([_fold(i, model.held_out_of) for i in ids], np.uint8)
        return Chunk(name, ids, np.concatenate([[0], np.cumsum(sizes)]), held, vocab, codes)

    for batch in batches:
        for block in blocks(batch["text"]):
            block = block.lower()
            starts, ends, owner = block.words()
            bounds = firsts(owner, block.n)
            parts.append((np.insert(block.hashes(starts, ends), bounds[1:], END), np.diff(bounds) + 1))
            ids += batch["doc_id"].slice(block.rows.start, block.n).to_pylist()
            n += len(starts)
            if n >= model.chunk_words:
                yield done()
                ids, parts, n, name = [], [], 0, name + 1
    if parts:
        yield done()


@dataclass
class Grams:
    """The distinct n-grams of one length in a chunk.

    Sorted ``keys``; ``of``: each token's n-gram (the one that ends there), -1
    where a text has fewer words before; ``last``: a token where each ends;
    ``counts`` in training; ``edges``: where each key range begins.
    """

    keys: np.ndarray
    of: np.ndarray
    last: np.ndarray
    counts: np.ndarray
    edges: np.ndarray


def _distinct(chunk: Chunk, order: int, ranges: int, bits: int) -> Iterator[Grams]:
    """N-grams of each length up to ``order``; the start symbol, which begins each text, is among the words."""
    trained = (chunk.held == 0).repeat(np.diff(chunk.bounds))
    for k, keys, at in chunk.grams(order):
        width = 64 if k == 1 else bits
        keys = np.append(keys, START) if k == 1 else keys >> U(64 - bits)
        own, last, place = np.unique(keys, return_index=True, return_inverse=True)
        weights = trained[at].astype(float)
        if k == 1:
            weights = np.append(weights, (chunk.held == 0).sum())
        counts = np.bincount(place, weights, len(own)).astype(np.int64)
        edges = np.searchsorted(own, np.array([(r << width) // ranges for r in range(ranges)], U))
        of = np.full(len(chunk.codes), -1)
        of[at] = place[: len(at)]
        yield Grams(own, of, np.append(at, -1)[last], counts, np.append(edges, len(own)))


def _asked(model: Model, ranges: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, model):
            for k, g in enumerate(_distinct(chunk, model.order, ranges, bits), 1):
                for r in np.flatnonzero(np.diff(g.edges)).tolist():
                    lo, hi = g.edges[r], g.edges[r + 1]
                    row = [[r * 8 + k], [chunk.name], [pack_sorted(g.keys[lo:hi])], [pack(g.counts[lo:hi])]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["range", "chunk", "keys", "counts"])

    return run


def _answered(key: tuple, rows: pa.Table) -> pa.Table:
    """Adds up one range's counts; a row for each chunk, and one of totals."""
    first_order = key[0].as_py() % 8 == 1
    names, keys, counts = rows["chunk"].to_pylist(), rows["keys"].to_pylist(), rows["counts"].to_pylist()
    keys = [unpack_sorted(x) for x in keys]
    own, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate([unpack(x) for x in counts]), len(own)).astype(np.int64)
    edges = np.cumsum([0, *map(len, keys)])
    answers = [pack(total[place[lo:hi]]) for lo, hi in zip(edges, edges[1:], strict=False)]
    words = total[own != START] if first_order else total[:0]
    passed = {c: pa.array([*rows[c].to_pylist(), None], rows.schema.field(c).type) for c in ("grp", "slots") if c in rows.column_names}
    return pa.table(
        passed
        | {
            "chunk": pa.array([*names, None], pa.int64()),
            "range": pa.array([key[0].as_py()] * (len(names) + 1), pa.int64()),
            "counts": pa.array([*answers, None], pa.binary()),
            "tokens": pa.array([None] * len(names) + [int(words.sum())], pa.int64()),
            "types": pa.array([None] * len(names) + [int((words > 0).sum())], pa.int64()),
        }
    )


def _spread(level: Levels, bits: int):
    """A relay on the way out: what a group of chunks asks of a coarse range, cut into fine ranges; and a row of the chunks' names."""

    def run(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["chunk"])
        (coarse, k), grp = divmod(rows[0]["range"], 8), rows[0]["grp"]
        keys, slots, counts = merged([unpack_sorted(r["keys"]) for r in rows], [unpack(r["counts"]) for r in rows])
        at = np.append(np.searchsorted(keys, level.edges(coarse, 64 if k == 1 else bits)), len(keys))
        first = coarse * level.fine
        out = []
        for j in np.flatnonzero(np.diff(at)).tolist():
            own = slice(at[j], at[j + 1])
            out.append({"range": (first + j) * 8 + k, "keys": pack_sorted(keys[own]), "counts": pack(counts[own]), "slots": pack(slots[own])})
        out.append({"range": (first + grp % level.fine) * 8 + k, "names": [r["chunk"] for r in rows], "sent": len(keys)})
        schema = pa.schema([("range", pa.int64()), ("grp", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("slots", pa.binary()), ("names", pa.list_(pa.int64())), ("sent", pa.int64())])
        return pa.Table.from_pylist([r | {"grp": grp} for r in out], schema)

    return run


def _answered_relays(key: tuple, rows: pa.Table) -> pa.Table:
    """``_answered`` to relays; rows of names go on as they are."""
    names = rows.filter(rows["keys"].is_null())
    rows = rows.filter(rows["keys"].is_valid())
    schema = pa.schema([("grp", pa.int64()), ("range", pa.int64()), ("counts", pa.binary()), ("slots", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()), ("names", pa.list_(pa.int64())), ("sent", pa.int64())])
    out = names.to_pylist()
    if len(rows):
        rows = rows.append_column("chunk", pa.nulls(len(rows), pa.int64()))
        out += _answered(key, rows).to_pylist()
    return pa.Table.from_pylist([{c: r.get(c) for c in schema.names} for r in out], schema)


def _gathered(level: Levels):
    """A relay on the way back: the fine ranges' answers to a group of chunks, to each chunk as if from one coarse range."""

    def run(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["range"])
        about = [r for r in rows if r["names"] is not None]
        rows = [r for r in rows if r["names"] is None]
        slots = [unpack(r["slots"]) for r in rows]
        checked(sum(r["sent"] for r in about), sum(map(len, slots)))
        fine, k = divmod(about[0]["range"], 8)
        (counts,) = by_slot(slots, len(about[0]["names"]), [unpack(r["counts"]) for r in rows])
        chunk, place = pa.array(about[0]["names"], pa.int64()), [fine // level.fine * 8 + k] * len(counts)
        return pa.table({"chunk": chunk, "range": pa.array(place, pa.int64()), "counts": pa.array(map(pack, counts), pa.binary())})

    return run


def _encoded(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, model):
            row = [pa.array([c.name]), pa.array([c.doc_ids], pa.list_(pa.int64())), *(pa.array([x]) for x in (pack(np.diff(c.bounds)), c.held.tobytes(), pack_sorted(c.vocab), pack(c.codes)))]
            yield pa.RecordBatch.from_arrays(row, names=["chunk", "ids", "sizes", "held", "vocab", "codes"])

    return run


@dataclass
class Automaton:
    """State 0 is the root, which has an arc for every word.

    Other states' arcs are in order of ``state * words + word``; where there is
    none, ``fail_to`` and ``fail_weight`` are taken instead.
    """

    words: int
    start: int
    root_weight: np.ndarray
    root_next: np.ndarray
    arc: np.ndarray
    arc_weight: np.ndarray
    arc_next: np.ndarray
    fail_to: np.ndarray
    fail_weight: np.ndarray

    def read(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One word from each state: the weights on the way and the next states."""
        weight, state = np.zeros(len(states)), states.copy()
        out = np.zeros(len(states), np.int64)
        left = np.arange(len(states))
        while len(left):
            key = state[left] * self.words + words[left]
            at = np.minimum(np.searchsorted(self.arc, key), max(len(self.arc) - 1, 0))
            hit = self.arc[at] == key if len(self.arc) else np.zeros(len(left), bool)
            went = left[hit]
            weight[went] += self.arc_weight[at[hit]]
            out[went] = self.arc_next[at[hit]]
            root = left[~hit & (state[left] == 0)]
            weight[root] += self.root_weight[words[root]]
            out[root] = self.root_next[words[root]]
            left = left[~hit & (state[left] > 0)]
            weight[left] += self.fail_weight[state[left]]
            state[left] = self.fail_to[state[left]]
        return weight, out


def compiled(grams: list[Grams], bounds: np.ndarray, root: np.ndarray, mu: float) -> Automaton:
    """The automaton of a chunk's n-grams; ``root``: the weights of the root's arcs."""
    words = grams[0]
    start = int(np.searchsorted(words.keys, START))
    begins = np.zeros(len(words.of) + 1, bool)
    begins[bounds[:-1]] = True
    seen = words.counts > 0
    state = np.where(seen, np.cumsum(seen), 0)  # of words as histories
    reached, weights, states = [state], [root], [state]
    n = 1 + int(seen.sum())
    fail_to, fail_weight = [np.zeros(n, np.int64)], [np.zeros(1), np.log10(mu / (words.counts[seen] + mu))]
    arcs = []
    for k, (shorter, own) in enumerate(zip(grams, grams[1:], strict=False), 2):
        suffix = shorter.of[own.last]
        history = np.where(begins[own.last], start, shorter.of[own.last - 1]) if k == 2 else shorter.of[own.last - 1]
        lower, before = weights[-1][suffix], shorter.counts[history]
        weights.append(np.where(before > 0, np.log10((own.counts + mu * 10.0**lower) / (before + mu)), lower))
        seen = own.counts > 0
        state = np.where(seen, n - 1 + np.cumsum(seen), reached[-1][suffix])
        if k < len(grams):
            fail_to.append(reached[-1][suffix[seen]])
            fail_weight.append(np.log10(mu / (own.counts[seen] + mu)))
            n += int(seen.sum())
        to = state if k < len(grams) else reached[-1][suffix]
        arcs.append((states[-1][history[seen]] * len(root) + words.of[own.last[seen]], weights[-1][seen], to[seen]))
        reached.append(state)
        states.append(state)
    arc, arc_weight, arc_next = (np.concatenate(x) for x in zip(*arcs, strict=True)) if arcs else [np.zeros(0, np.int64)] * 3
    order = np.argsort(arc)
    return Automaton(len(root), int(states[0][start]), root, reached[0], arc[order], arc_weight[order], arc_next[order], np.concatenate(fail_to), np.concatenate(fail_weight))


def traverse(automaton: Automaton, words: np.ndarray, bounds: np.ndarray, history: int, segment: int) -> np.ndarray:
    """log10 probability of each token; ``history``: how many tokens a state remembers."""
    sizes = np.diff(bounds)
    cuts = -(-sizes // segment)
    text = np.repeat(np.arange(len(sizes)), cuts)
    first = bounds[text] + segment * (np.arange(len(text)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    end = np.minimum(first + segment, bounds[text + 1])
    begin = np.maximum(first - history, bounds[text])
    state = np.where(begin == bounds[text], automaton.start, 0)
    order = np.argsort(begin - end)  # the longest first, so those still open are the first ones
    first, end, begin, state = first[order], end[order], begin[order], state[order]
    score = np.zeros(len(words))
    for step in range(int((end - begin).max(initial=0))):
        n = int(np.searchsorted(begin - end, -step))
        at = begin[:n] + step
        weight, state[:n] = automaton.read(state[:n], words[at])
        counted = at >= first[:n]
        score[at[counted]] = weight[counted]
    return score


def _scored(model: Model, ranges: int, bits: int, tokens: int, types: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        sizes = unpack(row["sizes"]).astype(np.int64)
        held = np.frombuffer(row["held"], np.uint8)
        c = Chunk(row["chunk"], row["ids"], np.concatenate([[0], np.cumsum(sizes)]), held, unpack_sorted(row["vocab"]), unpack(row["codes"]).astype(np.int64))
        answers = dict(zip(right["range"].to_pylist(), right["counts"].to_pylist(), strict=True))
        grams = []
        for k, g in enumerate(_distinct(c, model.order, ranges, bits), 1):
            wanted = [r * 8 + k for r in np.flatnonzero(np.diff(g.edges)).tolist()]
            g.counts = np.concatenate([unpack(answers[r]) for r in wanted if r in answers]).astype(np.int64) if wanted else g.counts
            if len(g.counts) != len(g.keys):
                raise ValueError("a chunk was read differently the second time")
            grams.append(g)
        root = np.log10((np.where(grams[0].keys == START, 0, grams[0].counts) + model.add_k) / (tokens + model.add_k * (types + 1)))
        words = grams[0].of
        score = traverse(compiled(grams, c.bounds, root, model.mu), words, c.bounds, model.order - 1, model.segment)
        return pa.table(
            {
                "doc_id": pa.array(c.doc_ids, pa.int64()),
                "held_out": pa.array(held == 1, mask=held == 2),
                "n_tokens": sizes,
                "n_known": segment_sum((grams[0].counts[words] > 0).astype(np.int64), c.bounds),
                "train_tokens": np.full(len(sizes), tokens, np.int64),
                "base_score": np.add.reduceat(root[words], c.bounds[:-1]),
                "score": np.add.reduceat(score, c.bounds[:-1]),
            }
        )

    return run


def scored(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """``docs`` (doc_id, text) to each text's log10 probability.

    ``held_out`` texts (crc32 of the id, modulo) aren't trained on.
    ``base_score`` is the root's part alone: the add-k unigram model.
    """
    ship(docs.sparkSession)
    texts = settled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    level = levels(int(max(64, size // model.range_bytes)), model.direct)
    bits = min(64, max(48, SPARE_BITS + (size // 5).bit_length()))
    asked = texts.mapInArrow(_asked(model, level.coarse, bits), "range long, chunk long, keys binary, counts binary")
    if level.groups:
        fine = asked.withColumn("grp", level.group()).groupBy("range", "grp")
        fine = fine.applyInArrow(_spread(level, bits), "range long, grp long, keys binary, counts binary, slots binary, names array<long>, sent long")
        relays = "grp long, range long, counts binary, slots binary, tokens long, types long, names array<long>, sent long"
        answers = written(fine.groupBy("range").applyInArrow(_answered_relays, relays))
    else:
        answers = written(asked.groupBy("range").applyInArrow(_answered, "chunk long, range long, counts binary, tokens long, types long"))
    tokens, types = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    encoded = texts.mapInArrow(_encoded(model), "chunk long, ids array<long>, sizes binary, held binary, vocab binary, codes binary")
    if level.groups:
        back = F.floor(F.shiftright("range", 3) / level.fine).alias("coarse")
        answers = answers.where("grp is not null").groupBy(back, F.expr("range & 7").alias("k"), "grp").applyInArrow(_gathered(level), "chunk long, range long, counts binary")
    else:
        answers = answers.where("chunk is not null").select("chunk", "range", "counts")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return encoded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scored(model, level.coarse, bits, tokens, types), schema)
