"""Word shingles as 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, 256 + 64, dtype=np.uint64)
_BYTE = _RANDOM[:256] * np.uint64(2) + np.uint64(1)
_ODD = _RANDOM[256:] * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 5
_P_INVERSE = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_P, _STEP + 1), _powers(_P_INVERSE, _STEP + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of each word (run without ASCII white space; A-Z lower-cased), in text order.

    All words of a text at once: differences of a running polynomial sum over its bytes.
    """
    raw = np.frombuffer((text or "").encode().lower(), np.uint8)  # bytes: ASCII case only
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64)
    edge = np.diff(_SPACE[raw], prepend=True, append=True)
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    up = _UP if n <= _STEP else _powers(_P, n + 1)
    down = _DOWN if n <= _STEP else _powers(_P_INVERSE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a whole text.

    Fewer than k words make one shingle of them all; no words (or null) an empty set.
    """
    h = word_hashes(text)
    n = len(h)
    if not n:
        return h
    width = min(n, k)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out += h[i:n - width + 1 + i] * _ODD[i]
    return np.unique(mix(out))
