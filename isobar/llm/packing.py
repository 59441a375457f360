"""Arrays of unsigned numbers as compressed bytes, for rows that carry many numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes."""
    values = np.ascontiguousarray(values, dtype="<u8")
    planes = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    raw = bytes([planes]) + values.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    raw = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    out = np.zeros(((len(raw) - 1) // raw[0], 8), np.uint8)
    out[:, : raw[0]] = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1).T
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(values, prepend=np.zeros(1, np.uint64)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)
