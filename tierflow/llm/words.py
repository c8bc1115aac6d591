"""Vectorised word hashing, shared by the operators on words and shingles.

A word is a maximal run of bytes other than space and tab..carriage return
in the UTF-8 text, i.e. a match of ``[^\\x20\\x09-\\x0D]+``.  Words become 64-bit
hashes that depend on their bytes alone, so every executor computes the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text hashed at a time: bounds the temporary arrays.
GROUP_BYTES = 1 << 19

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: a bijection whose output bits look random."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, GROUP_BYTES + 1), _U)
        have[1:] = _U(base)
        have = np.multiply.accumulate(have)
        if len(have) <= 2 * GROUP_BYTES:
            _powers[base] = have
    return have[:n]


def _hash_piece(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, hash) of each word of a byte array."""
    solid = ~_SPACE[piece]
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, _U)
    terms = _BYTE[piece] * _power(_BASE, len(piece))
    # spaces between a word and the next one are added to no word
    bounds = np.empty(2 * len(starts), np.int64)
    bounds[0::2], bounds[1::2] = starts, ends
    if bounds[-1] == len(piece):
        sums = np.add.reduceat(terms, bounds[:-1])[0::2]
    else:
        sums = np.add.reduceat(terms, bounds)[0::2]
    return starts, mix(sums * _power(_INVERSE, len(piece))[starts] + (ends - starts).astype(_U))


def word_hashes(data: bytes) -> np.ndarray:
    """The 64-bit hash of every word of one text, in order.  Long texts are
    cut at white space into pieces of about GROUP_BYTES."""
    if len(data) <= GROUP_BYTES:
        return _hash_piece(np.frombuffer(data, np.uint8))[1]
    whole, parts, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(whole):
        end = min(at + GROUP_BYTES, len(whole))
        while end < len(whole):
            gaps = np.flatnonzero(_SPACE[whole[end:end + 65536]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + 65536, len(whole))
        parts.append(_hash_piece(whole[at:end])[1])
        at = end
    return np.concatenate(parts)


def grouped(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hash texts in groups of about GROUP_BYTES: (index of the group's first
    text, word hashes of the whole group, number of words of each text)."""
    lo = 0
    while lo < len(texts):
        hi, n = lo + 1, len(texts[lo])
        while hi < len(texts) and n + len(texts[hi]) < GROUP_BYTES:
            n += len(texts[hi]) + 1
            hi += 1
        if hi == lo + 1:
            h = word_hashes(texts[lo])
            yield lo, h, np.array([len(h)])
        else:
            starts, h = _hash_piece(np.frombuffer(b"\n".join(texts[lo:hi]), np.uint8))
            ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
            yield lo, h, np.diff(np.searchsorted(starts, ends), prepend=0)
        lo = hi


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.zeros(n, _U)
    for j in range(k):
        out *= _U(0xD6E8FEB86659FD93)
        out += h[j:j + n]
    return mix(out)
