"""Arrays of non-negative integers as compact bytes, for rows that carry a whole list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in the fewest bytes an element each, compressed."""
    out = []
    for a in arrays:
        kind = np.min_scalar_type(int(a.max()) if len(a) else 0)
        out += [np.array([len(a), kind.itemsize], "<i8").tobytes(), a.astype(kind).tobytes()]
    body = b"".join(out)
    return np.array([len(body)], "<i8").tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpack(packed: bytes) -> list[np.ndarray]:
    """The arrays as 64-bit integers; those above 2^63 come out as negative ones with the same bits."""
    body = pa.decompress(packed[8:], int(np.frombuffer(packed[:8], "<i8")[0]), "zstd", asbytes=True)
    out, at = [], 0
    while at < len(body):
        n, size = np.frombuffer(body, "<i8", 2, at).tolist()
        out.append(np.frombuffer(body, f"<u{size}", n, at + 16).astype(np.int64))
        at += 16 + n * size
    return out
