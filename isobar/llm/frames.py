"""Token ids in seekable zstandard files.

A file is a run of independent zstandard frames, one for each document, then a
skippable frame with the documents' ids, then the trailing seek table of the
public zstandard seekable format: of each frame its compressed and decompressed
size and the low 32 bits of the XXH64 of its content.  A reader fetches the
table and then only the frames it wants.

Documents are dealt out by ranges of doc_id and sorted within, so files and
their frames are in ascending order; each task writes one file under a name of
its own and renames it, so a repeated task replaces it with the same content.

Null and empty texts are the end id alone.  A null doc_id sorts first and is
kept.  Rows that share a doc_id are all written, one after the other.  A very
long text is one frame.  Other columns are ignored.  An empty table gives no
file and an empty result.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.blocks import Block, blocks
from isobar.llm.store import shared_dir, ship, written

#: fixed values of the format
SKIPPABLE, SEEK_TABLE, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
TEXT_BYTES_PER_FILE = 16_000_000
_NONE = -(2**63)

_safe = np.zeros(256, bool)
_safe[33:127] = True
_safe[0xC3] = True  # the letters of Latin-1: no white space begins with this byte
_letter = np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True
_sign = _safe & ~_letter
_sign[48:58] = _sign[0xC3] = False


def _distinct_pieces(block: Block, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that stand for all equal ones, and for each piece which of these; grouped by hash and compared by bytes."""
    _, first, place = np.unique(block.hashes(starts, ends), return_index=True, return_inverse=True)
    size, like = ends - starts, first[place]
    if np.array_equal(size, size[like]) and block.equal(starts, starts[like], size):
        return first, place
    return np.arange(len(starts)), np.arange(len(starts))


class Encoder:
    """Encodes with the tokenizers library, distinct pieces only.

    The tokenizer's own pattern lets no token reach over a space into the sign
    or letter after it, nor from a letter into a sign, so texts can be cut
    there and equal pieces have equal ids.
    """

    def __init__(self, path: str, keep: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[bytes, int] = {}
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep = keep
        self._forget()

    def _forget(self) -> None:
        """Empties the cache: the place of each piece, where its ids begin and how many they are, and all ids."""
        self.pieces.clear()
        self.at, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum()))])
        self.pieces.update(zip(new, range(len(self.pieces), len(self.pieces) + len(new)), strict=True))

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin."""
        data = block.data
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            cut[: len(data) - 1] = (data[:-1] == 32) & _safe[data[1:]]
        raw = data.tobytes()
        if len(data) > 1 and not any(t in raw for t in self.special):  # a special token in a text stays whole
            cut[1 : len(data)] |= _letter[data[:-1]] & _sign[data[1:]]
        cut[block.at] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(block.n + 1, np.int64)
        if len(self.pieces) > self.keep:
            self._forget()
        order, at = _distinct_pieces(block, starts, ends)  # what is known of a piece goes by its bytes
        pieces = [raw[i:j] for i, j in zip(starts[order].tolist(), ends[order].tolist(), strict=True)]
        if new := [p for p in dict.fromkeys(pieces) if p not in self.pieces]:
            self._learn(new)
        known = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))[at]
        each = self.sizes[known]
        ends_at = np.cumsum(each)
        ids = self.ids[np.arange(int(ends_at[-1])) + np.repeat(self.at[known] - (ends_at - each), each)]
        return ids, np.concatenate([[0], ends_at])[np.searchsorted(edges, block.at)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    body = b"".join(struct.pack("<III", *f) for f in frames)
    return struct.pack("<II", SEEK_TABLE, len(body) + 9) + body + struct.pack("<IBI", len(frames), 0x80, SEEK_FOOTER)


def _write(path: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, compress = encoder(tokenizer), zstandard.ZstdCompressor(level=3, write_checksum=False).compress
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        temporary, name = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/part-{part:06d}.zst"
        frames, ids, tokens = [], [], 0
        with store.open_output_stream(temporary) as out:
            for batch in batches:
                ids += batch["doc_id"].to_pylist()
                for block in blocks(batch["text"], 2_000_000):
                    codes, at = encode(block)
                    for lo, hi in zip(at, at[1:], strict=False):
                        raw = np.append(codes[lo:hi], np.uint32(end_id)).astype("<u4").tobytes()
                        frame = compress(raw)
                        out.write(frame)
                        frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
                        tokens += len(raw) // 4
            listed = np.array([_NONE if i is None else i for i in ids], "<i8").tobytes()
            out.write(struct.pack("<II", SKIPPABLE, len(listed)) + listed + _seek_table(frames))
        if not frames:
            store.delete_file(temporary)
            return
        store.move(temporary, name)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, f"{path}/part-{part:06d}.zst", len(frames), tokens)], names=["part", "path", "n_docs", "n_tokens"])

    return run


class Reader:
    """One file; fetches the table at once and frames when asked."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(name)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self._get(size - 9, 9))
        if magic != SEEK_FOOTER:
            raise ValueError(f"{path} has no seek table")
        table = self._get(size - 9 - 12 * n, 12 * n)
        self.frames = np.frombuffer(table, "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        ids = np.frombuffer(self._get(int(self.at[-1]) + 8, 8 * n), "<i8")
        self.doc_ids = [None if i == _NONE else i for i in ids.tolist()]
        self._decompress = zstandard.ZstdDecompressor().decompress

    def _get(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def raw(self, lo: int, hi: int) -> Iterator[bytes]:
        """The checked contents of frames lo to hi, read in one go."""
        run = self._get(int(self.at[lo]), int(self.at[hi] - self.at[lo]))
        for i in range(lo, hi):
            frame = run[self.at[i] - self.at[lo] : self.at[i + 1] - self.at[lo]]
            raw = self._decompress(frame, max_output_size=int(self.frames[i, 1]))
            if len(raw) != self.frames[i, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[i, 2]:
                raise ValueError(f"frame {i} is damaged")
            yield raw

    def document(self, doc_id: int) -> np.ndarray:
        """The ids of one document, decompressing nothing else."""
        i = self.doc_ids.index(doc_id)
        return np.frombuffer(next(self.raw(i, i + 1)), "<u4")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
            reader = Reader(path)
            for lo in range(0, len(reader.frames), 512):
                hi = min(lo + 512, len(reader.frames))
                crcs = [zlib.crc32(raw) for raw in reader.raw(lo, hi)]
                sizes = reader.frames[lo:hi, 1] // 4
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                columns = [pa.array(reader.doc_ids[lo:hi], pa.int64()), pa.array(starts), pa.array(sizes), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes ``docs`` (doc_id, text) under ``path``; returns the files: ``part, path, n_docs, n_tokens``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(max(1, size // TEXT_BYTES_PER_FILE), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return written(rows.mapInArrow(_write(path, tokenizer, end_id), "part long, path string, n_docs long, n_tokens long"))


def read_tokens(files: DataFrame) -> DataFrame:
    """Reads files back, a task for each: ``doc_id, start, n_tokens, ids_crc32`` of each document; start counts the ids of all before it."""
    ship(files.sparkSession)
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    rows = files.withColumn("start", F.coalesce(before, F.lit(0))).select("part", "path", "start")
    n = files.count()
    return rows.repartition(max(1, n)).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Writes and reads back, by default in a new folder on shared storage."""
    return read_tokens(write_tokens(docs, path or _uri(shared_dir(docs.sparkSession)), tokenizer))


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"
