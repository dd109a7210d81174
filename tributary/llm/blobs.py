"""Integer columns packed into bytes: fewer, larger rows to shuffle."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*columns: np.ndarray) -> bytes:
    """Byte planes of unsigned columns; a plane of few values (high bytes, say) takes little room.

    Sorted columns should be given as differences (``np.diff`` with a leading value).
    """
    planes = [
        c.astype(c.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, c.itemsize).T.tobytes()
        for c in columns
    ]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    data, out, at = np.frombuffer(zstandard.decompress(blob), np.uint8), [], 0
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = data[at : at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out
