"""Words of texts as arrays: places and 64-bit hashes."""

from __future__ import annotations

import numpy as np

BASE = 0xC2B2AE3D27D4EB4F | 1
INVERSE = pow(BASE, -1, 1 << 64)

#: Word bytes are digits, a-z (after lowering A-Z) and all above 7F.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_VALUE = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}
KEPT = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1; up to ``KEPT`` of them are held for the next call."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, 1), base, np.uint64)
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        if n > KEPT:
            return powers
        _POWERS[base] = powers
    return _POWERS[base][:n]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word of a byte array."""
    data = _LOWER[data]
    inside = _IS_WORD[data].view(np.int8)
    edge = np.diff(np.concatenate([[0], inside, [0]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _powers(BASE, len(data)), out=sums[1:])
    code = (sums[end] - sums[start]) * _powers(INVERSE, len(data) + 1)[start]
    return start, end, code ^ (code >> np.uint64(29))


def texts_words(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Document, start and end in it, and hash of all words of the texts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    start, end, code = words_of(data)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    document = np.searchsorted(begin, start, side="right") - 1
    return document, start - begin[document], end - begin[document], code
