"""Sets of shingles, counted over the whole corpus and put in one global order, rare shingles first.

Items (texts, or lines) are taken in chunks.  Equal sets of a chunk are one.  A
chunk sends its shingles by ranges of the hash space, packed; a range counts the
sets with each shingle over all chunks and sends back those in more than one, so
a shingle in one set alone is moved once and never again.  A shingle that many
sets of one chunk have is sent once with its count, so no range grows with the
sets that share a passage.

``CHUNK_SHINGLES`` and ``RANGE_BYTES`` are as much as a worker holds.  Rows go by
chunk and range; beyond ``relay.DIRECT`` ranges they go through relays, so that
rows don't grow with the square of the table.

Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.blocks import U, firsts, mix, sequence_hash, windows
from isobar.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from isobar.llm.relay import DIRECT, Levels, by_slot, checked, levels, merged
from isobar.llm.store import settled

SHINGLE = 5
CHUNK_SHINGLES = 1_000_000
RANGE_BYTES = 8_000_000  #: of text, for each range of hashes
#: shingles in so many sets of one chunk are sent as a count
HEAVY = 64

#: sets of one batch: shingles by set, where each set's begin, its digest, and the items' labels, a column each
Part = tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]


def _by_text(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """The order by item, and by value within."""
    if n >= 1 << 16:
        return np.lexsort((values, of))
    order = np.argsort(values)
    return order[np.argsort(of[order].astype(np.uint16), kind="stable")]


def sets_of(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of n items by item and then hash, and where each item's begin; ``owner``: the item of each hashed word."""
    shingles, first = windows(words, owner, SHINGLE)
    of = owner[first]
    bounds = firsts(owner, n)
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < SHINGLE))
    if len(short):
        shingles, of = np.concatenate([shingles, sequence_hash(words, bounds[short], bounds[short + 1], SHINGLE - 1)]), np.concatenate([of, short])
    order = _by_text(shingles, of, n)
    shingles, of = shingles[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
    return shingles[new], firsts(of[new], n)


def set_ids(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A digest of each set, as a signed long; 0 for an empty one."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(shingles ^ U(0xA5A5A5A5)))])
    n = np.diff(bounds).astype(U)
    return np.where(n > 0, mix((total[bounds[1:]] - total[bounds[:-1]]) * U(3) + n), U(0)).view(np.int64)


def spare(n, percent: int):
    """How many shingles of a set of n a linked set may lack."""
    return n - -(-percent * n // 100)


_DOCS = [("labels", pa.list_(pa.list_(pa.int64()))), ("set_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("heavy_sets", pa.list_(pa.binary())), ("total", pa.int64())]
_ASKED = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("shingles", pa.binary()), ("sets", pa.binary()), ("heavy", pa.binary()), ("heavy_counts", pa.binary()), *_DOCS])
_ANSWERED = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("seen", pa.int64()), ("shingles", pa.binary()), ("sets", pa.binary()), ("counts", pa.binary()), ("heavy", pa.binary()), ("heavy_counts", pa.binary()), *_DOCS])
_RELAYED = pa.schema([("grp", pa.int64()), *_ANSWERED, ("slots", pa.binary()), ("heavy_slots", pa.binary()), ("chunks", pa.list_(pa.int64())), ("sent", pa.int64()), ("seen_by", pa.list_(pa.int64()))])
_SQL_DOCS = "labels array<array<long>>, set_ids array<long>, sizes array<long>, heavy_sets array<binary>, total long"
_SQL_ASKED = f"range long, chunk long, shingles binary, sets binary, heavy binary, heavy_counts binary, {_SQL_DOCS}"
_SQL_ANSWERED = f"range long, chunk long, seen long, shingles binary, sets binary, counts binary, heavy binary, heavy_counts binary, {_SQL_DOCS}"
_SQL_RELAYED = f"grp long, {_SQL_ANSWERED}, slots binary, heavy_slots binary, chunks array<long>, sent long, seen_by array<long>"


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name in schema.names} for row in rows], schema)


def chunk_rows(parts: list[Part], chunk: int, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each range that the chunk's shingles are in, and one for its documents."""
    sizes = np.concatenate([np.diff(bounds) for _, bounds, _, _ in parts])
    ids = np.concatenate([x for _, _, x, _ in parts])
    shingles = np.concatenate([x for x, _, _, _ in parts])
    distinct, once, own_set = np.unique(ids, return_index=True, return_inverse=True)
    first = np.zeros(len(ids), bool)
    first[once] = True
    keep = np.repeat(first, sizes)
    shingles, sets = shingles[keep], np.repeat(own_set, np.where(first, sizes, 0))
    order = np.argsort(shingles)
    shingles, sets = shingles[order], sets[order]
    begin = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]])) if len(shingles) else np.zeros(0, np.int64)
    runs = np.diff(np.append(begin, len(shingles)))
    many = runs >= HEAVY
    heavy, heavy_counts = shingles[begin[many]], runs[many]
    light = ~np.repeat(many, runs)
    heavy_sets = [pack(np.sort(sets[b : b + r])) for b, r in zip(begin[many].tolist(), heavy_counts.tolist(), strict=True)]
    shingles, sets = shingles[light], sets[light]
    at, heavy_at = np.append(np.searchsorted(shingles, edges), len(shingles)), np.append(np.searchsorted(heavy, edges), len(heavy))
    for r in np.flatnonzero((np.diff(at) > 0) | (np.diff(heavy_at) > 0)).tolist():
        lo, hi, a, b = at[r], at[r + 1], heavy_at[r], heavy_at[r + 1]
        yield _rows(_ASKED, [{"range": r, "chunk": chunk, "shingles": pack_sorted(shingles[lo:hi]), "sets": pack(sets[lo:hi]), "heavy": pack_sorted(heavy[a:b]), "heavy_counts": pack(heavy_counts[a:b])}])
    about = {
        "labels": [pa.chunked_array(column).to_pylist() for column in zip(*(labels for *_, labels in parts), strict=True)],
        "set_ids": ids.tolist(),
        "sizes": sizes.tolist(),
        "heavy_sets": heavy_sets,
        "total": len(shingles) + len(heavy),
    }
    spread = int(mix(np.array([chunk], U))[0] % U(len(edges)))  # any range will do, as long as these rows don't meet in one
    yield _rows(_ASKED, [{"range": spread, "chunk": chunk} | about])


def _asked(ranges: int, parts_of: Callable[[pa.RecordBatch], Iterator[Part]]):
    edges = np.array([(r << 64) // ranges for r in range(ranges)], U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, chunk = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in parts_of(batch):
                parts.append(part)
                held += len(part[0]) + len(part[2])
                if held >= CHUNK_SHINGLES:
                    yield from chunk_rows(parts, chunk, edges)
                    parts, held, chunk = [], 0, chunk + 1
        if parts:
            yield from chunk_rows(parts, chunk, edges)

    return run


def counted(rows: pa.Table, schema: pa.Schema = _ANSWERED) -> pa.Table:
    """One range: in how many sets each shingle is; to each chunk, or relay, those in more than one.  Rows without shingles go on as they are."""
    out = rows.filter(rows["shingles"].is_null()).to_pylist()
    rows = rows.filter(rows["shingles"].is_valid()).to_pylist()
    if rows:
        light = [unpack_sorted(r["shingles"]) for r in rows]
        heavy = [unpack_sorted(r["heavy"]) for r in rows]
        weights = [*(np.ones(len(x)) for x in light), *(unpack(r["heavy_counts"]) for r in rows)]
        _, place = np.unique(np.concatenate([*light, *heavy]), return_inverse=True)
        counts = np.bincount(place, np.concatenate(weights)).astype(np.int64)[place]
        ends = np.cumsum([len(x) for x in (*light, *heavy)])
        parts = np.split(counts, ends[:-1])
        for row, shingles, hit, found, found_heavy in zip(rows, light, heavy, parts, parts[len(rows) :], strict=False):
            more = found > 1
            answer = {
                "seen": len(shingles) + len(hit),
                "shingles": pack_sorted(shingles[more]),
                "sets": pack(unpack(row["sets"])[more]),
                "counts": pack(found[more]),
                "heavy_counts": pack(found_heavy),
            }
            if row.get("slots") is not None:
                answer["slots"] = pack(unpack(row["slots"])[more])
            out.append(row | answer)
    return pa.Table.from_batches([_rows(schema, out)])


def spread(level: Levels):
    """A relay on the way out: what a group of chunks sends to a coarse range, cut into fine ranges."""

    def run(rows: pa.Table) -> pa.Table:
        docs = rows.filter(rows["shingles"].is_null()).to_pylist()
        out = [r | {"range": r["range"] * level.fine + r["chunk"] % level.fine} for r in docs]
        rows = sorted(rows.filter(rows["shingles"].is_valid()).to_pylist(), key=lambda r: r["chunk"])
        if rows:
            coarse, grp = rows[0]["range"], rows[0]["grp"]
            each, each_heavy = [unpack_sorted(r["shingles"]) for r in rows], [unpack_sorted(r["heavy"]) for r in rows]
            shingles, slots, sets = merged(each, [unpack(r["sets"]) for r in rows])
            heavy, heavy_slots, heavy_counts = merged(each_heavy, [unpack(r["heavy_counts"]) for r in rows])
            edges = level.edges(coarse)
            at, heavy_at = np.append(np.searchsorted(shingles, edges), len(shingles)), np.append(np.searchsorted(heavy, edges), len(heavy))
            for j in np.flatnonzero((np.diff(at) > 0) | (np.diff(heavy_at) > 0)).tolist():
                own, own_heavy = slice(at[j], at[j + 1]), slice(heavy_at[j], heavy_at[j + 1])
                out.append(
                    {
                        "range": coarse * level.fine + j,
                        "grp": grp,
                        "shingles": pack_sorted(shingles[own]),
                        "sets": pack(sets[own]),
                        "slots": pack(slots[own]),
                        "heavy": pack_sorted(heavy[own_heavy]),
                        "heavy_counts": pack(heavy_counts[own_heavy]),
                        "heavy_slots": pack(heavy_slots[own_heavy]),
                    }
                )
            about = {"chunks": [r["chunk"] for r in rows], "sent": len(shingles) + len(heavy), "seen_by": [len(a) + len(b) for a, b in zip(each, each_heavy, strict=True)]}
            out.append({"range": coarse * level.fine + grp % level.fine, "grp": grp} | about)
        return pa.Table.from_batches([_rows(_RELAYED, out)])

    return run


def gathered(level: Levels):
    """A relay on the way back: the fine ranges' answers to a group of chunks, to each chunk its own, as if from one coarse range."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        out = [r for r in rows if r["total"] is not None]
        about = [r for r in rows if r["chunks"] is not None]
        rows = sorted((r for r in rows if r["shingles"] is not None), key=lambda r: r["range"])
        checked(sum(r["sent"] for r in about), sum(r["seen"] for r in rows))
        if about:
            chunks, n = about[0]["chunks"], len(about[0]["chunks"])
            light = by_slot([unpack(r["slots"]) for r in rows], n, [unpack_sorted(r["shingles"]) for r in rows], *([unpack(r[c]) for r in rows] for c in ("sets", "counts")))
            heavy = by_slot([unpack(r["heavy_slots"]) for r in rows], n, [unpack_sorted(r["heavy"]) for r in rows], [unpack(r["heavy_counts"]) for r in rows])
            for chunk, seen, a, b, c, x, y in zip(chunks, about[0]["seen_by"], *light, *heavy, strict=True):
                answer = {"shingles": pack_sorted(a), "sets": pack(b), "counts": pack(c), "heavy": pack_sorted(x), "heavy_counts": pack(y)}
                out.append({"range": about[0]["range"] // level.fine, "chunk": chunk, "seen": seen} | answer)
        return pa.Table.from_batches([_rows(_ANSWERED, out)])

    return run


def _sets_schema(labels: tuple[str, ...]) -> pa.Schema:
    return pa.schema([*((x, pa.int64()) for x in labels), ("set_id", pa.int64()), ("n", pa.int64()), ("shared", pa.binary()), ("upto", pa.list_(pa.int64()))])


def ordered(percent: int, classes: tuple[int, ...], labels: tuple[str, ...]):
    """One chunk: its items, and with the first of each set that may be linked the shared shingles in order.

    ``upto``: how many of these are in class 1, in class 2 or lower, and so on.
    """

    schema = _sets_schema(labels)

    def run(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: (r["total"] is not None, r["range"]))
        about, rows = rows[-1], rows[:-1]
        if about["total"] is None or about["total"] != sum(r["seen"] for r in rows):
            raise ValueError("a chunk's shingles are not complete: its texts were read differently a second time")
        ids, sizes = np.array(about["set_ids"], np.int64), np.array(about["sizes"], np.int64)
        distinct, once = np.unique(ids, return_index=True)
        none = [np.zeros(0, U)]
        shingles = [unpack_sorted(r["shingles"]) for r in rows] + none
        sets = [unpack(r["sets"]).astype(np.int64) for r in rows] + [np.zeros(0, np.int64)]
        counts = [unpack(r["counts"]).astype(np.int64) for r in rows] + [np.zeros(0, np.int64)]
        heavy = np.concatenate([unpack_sorted(r["heavy"]) for r in rows] + none)
        heavy_counts = np.concatenate([unpack(r["heavy_counts"]) for r in rows] + none).astype(np.int64)
        if len(heavy):
            with_it = [unpack(x).astype(np.int64) for x in about["heavy_sets"]]
            n = [len(x) for x in with_it]
            shingles, sets, counts = [*shingles, np.repeat(heavy, n)], [*sets, *with_it], [*counts, np.repeat(heavy_counts, n)]
        shingles, sets, counts = (np.concatenate(x) for x in (shingles, sets, counts))
        n = sizes[once]
        enough = np.bincount(sets, minlength=len(distinct)) >= n - spare(n, percent)
        use = enough[sets]
        shingles, sets, counts = shingles[use], sets[use], counts[use]
        order = np.lexsort((shingles, counts, sets))
        shingles, sets, counts = shingles[order], sets[order], counts[order]
        bounds = firsts(sets, len(distinct))
        shared, upto = [None] * len(ids), [None] * len(ids)
        for i in np.flatnonzero(enough & (n > 0)).tolist():
            lo, hi = bounds[i], bounds[i + 1]
            shared[once[i]] = shingles[lo:hi].tobytes()
            upto[once[i]] = np.searchsorted(counts[lo:hi], classes, "right").tolist()
        columns = [*about["labels"], ids, sizes, shared, upto]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def ordered_sets(texts: DataFrame, parts_of: Callable[[pa.RecordBatch], Iterator[Part]], labels: tuple[str, ...], percent: int, classes: tuple[int, ...] = (), direct: int = DIRECT) -> DataFrame:
    """``texts`` (with ``text``) to a row for each item: its ``labels``, ``set_id`` (0 for an empty set), ``n`` shingles.

    ``parts_of`` makes the items' sets of a batch.  With one item at least of each
    set that may be linked with another come ``shared``, its shingles that more
    than one set has, rare first, as bytes, and ``upto``: how many of them are in
    class 1, in class 2 or lower, and so on.  ``direct``: most ranges without relays.
    """
    texts = settled(texts)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    level = levels(int(max(16, size // RANGE_BYTES)), direct)
    asked = texts.mapInArrow(_asked(level.coarse, parts_of), _SQL_ASKED)
    if level.groups:
        fine = asked.withColumn("grp", level.group()).groupBy("range", "grp").applyInArrow(spread(level), _SQL_RELAYED)
        answered = fine.groupBy("range").applyInArrow(lambda rows: counted(rows, _RELAYED), _SQL_RELAYED)
        answered = answered.groupBy(F.floor(F.col("range") / level.fine).alias("coarse"), "grp").applyInArrow(gathered(level), _SQL_ANSWERED)
    else:
        answered = asked.groupBy("range").applyInArrow(lambda rows: counted(rows), _SQL_ANSWERED)
    out = "".join(f"{x} long, " for x in labels) + "set_id long, n long, shared binary, upto array<long>"
    return answered.groupBy("chunk").applyInArrow(ordered(percent, classes, labels), out)


def prefixes(percent: int):
    """The shared shingles among a set's first tau + 1, with their rank in it and their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for set_id, n, shared, upto in zip(batch["set_id"].to_pylist(), batch["n"].to_pylist(), batch["shared"], batch["upto"].to_pylist(), strict=True):
                shingles = np.frombuffer(shared.as_buffer(), np.int64)
                own = n - len(shingles)
                here = np.arange(max(0, spare(n, percent) + 1 - own))
                out.append((shingles[: len(here)], np.full(len(here), set_id), np.full(len(here), n), here + own + 1, np.searchsorted(upto, here, "right") + 1))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["token", "set_id", "n", "rank", "class"])

    return run


def possible(n: str, rank: str, other_n: str, other_rank: str, percent: int) -> Column:
    """Whether two sets can be linked that share nothing before these ranks."""
    most = 1 + F.least(F.col(n) - F.col(rank), F.col(other_n) - F.col(other_rank))
    return most * (100 + percent) >= (F.col(n) + F.col(other_n)) * percent


def verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y, m, n in zip(batch["x"], batch["y"], batch["na"].to_pylist(), batch["nb"].to_pylist(), strict=True):
                both = len(np.intersect1d(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), assume_unique=True))
                linked.append(100 * both >= percent * (m + n - both))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], names=["a", "b"])

    return run
