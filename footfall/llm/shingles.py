"""Word shingles as arrays of 64-bit hashes, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _S)
    x *= _MIX1
    x ^= x >> _S
    x *= _MIX2
    x ^= x >> _S
    return x


_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_MASKS = np.array([2**(8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 64  # words of more bytes are hashed one by one


def hashed_words(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII white space, A-Z in lower case, and how many newlines stand
    before each: eight bytes of all words at a time, without a list of words."""
    raw = b" " + (text or "").encode("utf-8", "surrogatepass").lower() + b" " * 9
    content = np.frombuffer(raw, np.uint8)
    gap = _GAP[content]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    out = mix((eights[starts] & _MASKS[np.minimum(lengths, 8)]) * _ODD + lengths.astype(np.uint64))
    rows, k = np.flatnonzero(lengths > 8), 8
    while len(rows) and k < _LONG:
        out[rows] = mix(out[rows] * _ODD + (eights[starts[rows] + k] & _MASKS[np.minimum(lengths[rows] - k, 8)]))
        k += 8
        rows = rows[lengths[rows] > k]
    for i in rows.tolist():
        out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(raw[starts[i]:starts[i] + lengths[i]]))
    return out, np.searchsorted(np.flatnonzero(content == 10), starts)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; fewer words give one shingle, none give none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(size, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = mix(acc * _ODD + hashes[j:n - k + 1 + j])
    return acc


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(hashed_words(text)[0], size))


def set_hash(members: np.ndarray) -> int:
    """Signed 64-bit hash of a set of shingle hashes."""
    return int(np.array([xxhash.xxh3_64_intdigest(members.tobytes())], np.uint64).view(np.int64)[0])
