"""Text as arrays: words, lines and hashed word windows of many texts at once.

Used inside ``mapInArrow`` tasks.  A record batch is cut into blocks of a few
megabytes, so a worker's memory doesn't depend on the batch or the table; a
text longer than that is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000
#: longer byte ranges are hashed in pieces
_PIECE = 64

U = np.uint64
_MIX = (U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53))
_STEP = U(0xD6E8FEB86659FD93)
#: the lowest n bytes of eight
_TAIL = np.array([(1 << 8 * n) - 1 for n in range(9)], U)

#: the white space of all contracts: [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, all other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x *= _MIX[0]
    x ^= x >> U(33)
    x *= _MIX[1]
    x ^= x >> U(33)
    return x


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers."""
    return np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data).data, strides=(1,)) if len(data) > 7 else np.zeros(0, U)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; ``data`` has eight bytes more than any range ends at.

    Eight bytes at a time are mixed into a state that begins with the length.
    Each step is one to one in the state and in the bytes, and every bit of both
    reaches every bit of the next state, so no pattern of letters cancels out.  A
    long range is the hash of its pieces' hashes.
    """
    size = ends - starts
    state = mix(size.astype(U) + _STEP)
    long = np.flatnonzero(size > _PIECE)
    if len(long):
        pieces = -(-size[long] // _PIECE)
        last = np.cumsum(pieces)
        at = np.repeat(starts[long], pieces) + _PIECE * (np.arange(last[-1]) - np.repeat(last - pieces, pieces))
        inner = np.append(hash_ranges(data, at, np.minimum(at + _PIECE, np.repeat(ends[long], pieces))), U(0)).view(np.uint8)
        state[long] = mix(state[long] ^ hash_ranges(inner, 8 * (last - pieces), 8 * last))
    eights = _eights(data)
    rest = np.where(size > _PIECE, 0, size)
    open_ = np.flatnonzero(rest)
    step = 0
    while len(open_):
        left = rest[open_] - step
        got = eights[starts[open_] + step] & _TAIL[np.minimum(left, 8)]
        state[open_] = mix(state[open_] ^ got)
        step += 8
        open_ = open_[left > 8]
    return state


class Block:
    """Some whole texts: ``data`` holds their bytes end to end, ``at`` their borders."""

    def __init__(self, data: np.ndarray, at: np.ndarray, rows: slice):
        self.data, self.at, self.rows = data, at, rows
        self.n = len(at) - 1
        self._padded = None

    def lower(self) -> Block:
        return Block(LOWER[self.data], self.at, self.rows)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of the maximal runs of marked bytes, none across a border."""
        size = len(self.data)
        border = np.zeros(size + 1, bool)
        border[self.at] = True
        edge = np.empty(size, bool)
        edge[:1] = True
        np.logical_not(inside[:-1], out=edge[1:])
        starts = np.flatnonzero(inside & (edge | border[:-1]))
        edge[-1:] = True
        np.logical_not(inside[1:], out=edge[:-1])
        ends = np.flatnonzero(inside & (edge | border[1:])) + 1
        return starts, ends, np.searchsorted(self.at, starts, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges."""
        if self._padded is None:
            self._padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        return hash_ranges(self._padded, starts, ends)

    def equal(self, starts: np.ndarray, others: np.ndarray, size: np.ndarray) -> bool:
        """Whether all pairs of byte ranges, of the same sizes, are equal byte for byte."""
        if self._padded is None:
            self._padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights, step, open_ = _eights(self._padded), 0, np.flatnonzero(size)
        while len(open_):
            left = size[open_] - step
            if ((eights[starts[open_] + step] ^ eights[others[open_] + step]) & _TAIL[np.minimum(left, 8)]).any():
                return False
            step += 8
            open_ = open_[left > 8]
        return True


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts in order; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Block(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], slice(lo, hi))
        lo = hi


def firsts(owner: np.ndarray, n: int) -> np.ndarray:
    """For items in order of their owner: where each owner's items begin, and the end."""
    return np.searchsorted(owner, np.arange(n + 1))


def windows(words: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows within texts and the place of their first words."""
    if len(words) < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    acc = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        acc = acc * _STEP + words[j : len(words) - k + 1 + j]
    first = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])
    return mix(acc[first]), first


def sequence_hash(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """A hash of each whole sequence of at most so many words."""
    out = (ends - starts).astype(U)
    for j in range(most):
        here = np.flatnonzero(ends - starts > j)
        out[here] = out[here] * _STEP + words[starts[here] + j]
    return mix(out)


def segment_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i+1]]; 0 where empty."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
