"""Hashes of any stretch of a byte buffer or of other letters, in numpy: a polynomial over random codes modulo 2**64.

Equal bytes have equal hashes wherever they stand. Unequal bytes may too, so what is found by hash is verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 at least of the base and of its inverse."""
    for k, base in enumerate((_BASE, _INVERSE)):
        p = _powers[k]
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        _powers[k] = p
    return _powers[0][:n], _powers[1][:n]


def sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums, one more than bytes; ``buf`` may also be an array of other letters."""
    codes = _CODES[buf] if buf.dtype == np.uint8 else mix(buf.astype(np.uint64) * np.uint64(_BASE) + _CODES[0]) | np.uint64(1)
    s = np.empty(len(buf) + 1, np.uint64)
    s[0] = 0
    np.cumsum(codes * _power(len(buf))[0], out=s[1:])
    return s


def stretch(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [a, b)."""
    h = (s[b] - s[a]) * _power(len(s))[1][a]
    return mix(h)


def windows(s: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte stretches, by start."""
    n = len(s) - k
    return mix((s[k:] - s[:-k]) * _power(len(s))[1][:n]) if n > 0 else np.empty(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without nulls, and the offsets of its values in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None and len(at) else np.empty(0, np.uint8)
    return buf, at - at[0] if len(at) else np.zeros(1, np.int64)
