"""Prefix polynomial hashes and word shingles of UTF-8 bytes, vectorised with NumPy.

``prefix[i]`` is the sum of ``CODE[byte j] * BASE**j`` for j < i, modulo 2**64, so
the hash of any range is a difference of two entries, shifted back to power
zero by the inverse base. All values are uint64 and wrap around.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# An odd base, the multipliers of a 64-bit finaliser, one odd factor per word of a shingle.
BASE = np.uint64(0x5851F42D4C957F2D)
INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))
MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
    dtype=np.uint64,
)
CODE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = 1 << 20
_tables: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX_1
    h = (h ^ (h >> np.uint64(33))) * MIX_2
    return h ^ (h >> np.uint64(33))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base**0 ... base**(n-1); short tables are kept."""
    name = str(base)
    have = _tables.get(name)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 16), np.uint64)
        have[1:] = base
        np.cumprod(have, out=have)
        if len(have) <= _KEEP:
            _tables[name] = have
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODE[data] * powers(len(data)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the ranges, the same wherever the bytes stand."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix), INVERSE)[start]
    return mix(raw + (end - start).astype(np.uint64) * PLACES[0])


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, A-Z lower-cased; words are runs without ASCII white space."""
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    return range_hashes(prefix_hashes(data), edge[::2], edge[1::2])


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words.

    Fewer words make one shingle; no words, or no text, none.
    """
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(text)
    n = min(size, len(words))
    if n == 0:
        return words
    parts = [words[i : len(words) - n + 1 + i] * PLACES[i] for i in range(n)]
    return np.unique(mix(sum(parts[1:], parts[0]) + np.uint64(n)))


def signed(h: np.ndarray) -> np.ndarray:
    """As Spark's bigint."""
    return h.view(np.int64)


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str | None]]:
    """(doc_id, text) of every row."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield ids[i].as_py(), texts[i].as_py()
