"""Hashes of the words and marks of many texts at once."""

from __future__ import annotations

import string

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x5851F42D4C957F2D
#: texts are hashed in stretches of at most so many bytes
STRETCH = 4 << 20

#: 0 between runs (space and control characters), 1 letters and digits, 2 marks
_KIND = np.array(
    [0 if b <= 32 or b == 127 else 1 if b >= 128 or chr(b) in string.ascii_letters + string.digits else 2 for b in range(256)],
    dtype=np.uint8,
)
_powers: dict[str, np.ndarray] = {}


def _table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["up"]) < size:
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:size], _powers["down"][:size]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _ODD
    return values ^ (values >> np.uint64(29))


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, kind, hash) of each run of letters and digits, or of marks, in the text.

    Equal runs have equal hashes wherever they stand.
    """
    parts = []
    at = 0
    while at < len(data):
        end = min(len(data), at + STRETCH)
        while end < len(data) and end - at < 2 * STRETCH and _KIND[data[end - 1]] != 0:
            end += 1  # to the end of the run
        parts.append((at, _stretch(np.frombuffer(data, np.uint8, end - at, at))))
        at = end
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint64)
    return (
        np.concatenate([p[0] + at for at, p in parts]),
        np.concatenate([p[1] + at for at, p in parts]),
        np.concatenate([p[2] for _, p in parts]),
        np.concatenate([p[3] for _, p in parts]),
    )


def _stretch(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    kind = _KIND[raw]
    cuts = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts, [len(raw)]])
    inside = kind[starts] != 0
    starts, ends = starts[inside], ends[inside]
    up, down = _table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return starts, ends, kind[starts], mixed((sums[ends] - sums[starts]) * down[starts])
