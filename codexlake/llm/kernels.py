"""Vectorised byte and word kernels (numpy, whole Arrow batches at a time).

Hashes are sums of random 64-bit byte values times powers of an odd base, so
the hash of any byte range comes from two prefix sums; a final mix spreads it.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240607)
#: Random value of each byte, for two independent hashes.
BYTE = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    have = _powers.get(which)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 19 if n < 1 << 19 else 1 << 21)
        made = []
        for b in (BASE[which], pow(BASE[which], -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = _powers[which] = (made[0], made[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def prefix(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums: one entry more than bytes."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    v = BYTE[which][data]
    v *= powers(len(data), which)[0][: len(data)]
    np.cumsum(v, out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of the byte ranges [start, end)."""
    return mix((sums[end] - sums[start]) * powers(len(sums), which)[1][start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offs: np.ndarray, spaces: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row its first word's number."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = spaces[data]
    inner = offs[1:-1]
    # a row starts at a word border even where no space stands
    before, after = gap[:-1].copy(), gap[1:].copy()
    before[inner], after_edge = True, inner
    solid = ~gap[1:-1]
    starts = np.flatnonzero(solid & before[: len(data)])
    ends_mark = after[1:].copy()
    edge = after_edge[(after_edge > 0) & (after_edge <= len(data))] - 1
    ends_mark[edge] = True
    ends = np.flatnonzero(solid & ends_mark) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words (rows not respected)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = h[:n] * _STEP[0]
    for j in range(1, size):
        acc = acc + h[j : j + n] * _STEP[j]
    return mix(acc)


def word_hashes(data: np.ndarray, offs: np.ndarray, spaces: np.ndarray = SPACE, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each row its first word's number. A row that
    is longer than a piece comes alone; its tables are made piece by piece, and
    a word that crosses a border is put together from its parts."""
    if len(data) <= piece:
        start, end, first = words(data, offs, spaces)
        return ranges(prefix(data), start, end), first
    out: list[np.ndarray] = []
    raw_open, size_open = np.uint64(0), 0
    for at in range(0, len(data), piece):
        part = data[at : at + piece]
        start, end, _ = words(part, np.array([0, len(part)]), spaces)
        sums = prefix(part)
        raw, size = (sums[end] - sums[start]) * powers(len(part))[1][start], (end - start).astype(np.uint64)
        if size_open and len(start) and start[0] == 0:
            raw[:1] = raw_open + raw[:1] * np.uint64(pow(BASE[0], size_open, 1 << 64))
            size[0] += np.uint64(size_open)
        elif size_open:
            raw, size = np.append(raw_open, raw), np.append(np.uint64(size_open), size)
        size_open = 0
        if len(end) and end[-1] == len(part) and at + piece < len(data):
            raw_open, size_open = raw[-1], int(size[-1])
            raw, size = raw[:-1], size[:-1]
        out.append(mix(raw + size))
    h = np.concatenate(out)
    return h, np.array([0, len(h)])
