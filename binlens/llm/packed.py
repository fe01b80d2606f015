"""Several numpy arrays in one compressed binary value."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], "<i8").tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def unpack(raw: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(raw)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 2 * n, 8).reshape(-1, 2)
    out, at = [], 8 + 16 * n
    for kind, length in head:
        dtype = np.dtype(chr(kind))
        out.append(np.frombuffer(data, dtype, int(length), at))
        at += int(length) * dtype.itemsize
    return out
