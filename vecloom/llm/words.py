"""Words of UTF-8 texts as arrays: places and 64-bit hashes."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, base, np.uint64)])
                for base in (_BASE, pow(_BASE, -1, 1 << 64))
            ]
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word, a run of bytes other than space and 0x09 to 0x0D."""
    data = np.frombuffer(raw, np.uint8)
    found = []
    begin = 0
    while begin < len(data):
        stop = min(len(data), begin + BLOCK)
        while stop < len(data) and not _WHITE[data[stop]]:
            ahead = np.flatnonzero(_WHITE[data[stop : stop + BLOCK]])
            stop = stop + int(ahead[0]) if len(ahead) else min(len(data), stop + BLOCK)
        block = data[begin:stop]
        edge = np.diff(np.r_[True, _WHITE[block], True].astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _power_tables(len(block) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(_VALUES[block] * up[: len(block)], out=sums[1:])
            hashes = mixed((sums[ends] - sums[starts]) * down[starts])
        found.append((starts + begin, ends + begin, hashes))
        begin = stop
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
