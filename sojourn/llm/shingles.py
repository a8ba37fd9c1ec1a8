"""Hashed word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _SECOND
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all `width`-word shingles, A-Z lower-cased, words parted by
    ASCII white space. Fewer words than `width` make one shingle; none (or null), none."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(words) < width:
            whole = xxhash.xxh64_intdigest(h.tobytes(), seed=len(words))
            return np.array([whole], np.uint64).view(np.int64)
        out = h[: len(h) - width + 1]
        for j in range(1, width):
            out = _mixed(out * _FIRST + h[j : len(h) - width + 1 + j])
        return np.unique(_mixed(out).view(np.int64))
