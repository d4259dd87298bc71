"""Words of many texts as keyed 64-bit fingerprints, and the sets of their shingles."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

from lineforge.llm.text import PIECE, mix, row_slices, runs, utf8

# Words of more bytes are hashed one by one.
LONG_WORD = 64

_KEY = b"lineforge.shingles"
_LANE = tuple(np.frombuffer(blake2b(_KEY, digest_size=16).digest(), np.uint64))
_ODD = np.uint64(0xD6E8FEB86659FD93)
# By the number of bytes left in a word: which bits of the next eight bytes are its own.
_OWN = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint per span of bytes; spans may overlap.

    Eight bytes at a time go through two keyed lanes that are mixed after every step, so that a
    fingerprint has no algebraic structure in which regular words could meet.
    """
    size = ends - starts
    padded = np.concatenate([np.ascontiguousarray(data), np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    one = size.astype(np.uint64) ^ _LANE[0]
    two = np.full(len(size), _LANE[1])
    active = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    for step in range(0, LONG_WORD, 8):
        active = active[size[active] > step]
        if not len(active):
            break
        left = np.minimum(size[active] - step, 8)
        chunk = eights[starts[active] + step] & _OWN[left]
        a, b = one[active], two[active]
        one[active] = mix(a ^ chunk) + b
        two[active] = mix(b + chunk * _ODD) ^ (a >> np.uint64(7))
    out = mix(one ^ (two * _ODD))
    for i in np.flatnonzero(size > LONG_WORD):
        digest = blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=_KEY).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per run of rows: first, last, the ascending distinct shingles of each, and row offsets into them.

    Only A-Z are folded, words are runs of anything but the six white-space characters, and a text
    of fewer than ``width`` words is one shingle; null or blank texts have none.
    """
    data, offsets = utf8(texts)
    for first, last in row_slices(offsets, 2 * PIECE):
        low, high = offsets[first], offsets[last]
        piece, places = data[low:high], offsets[first : last + 1] - low
        starts, ends = runs(~SPACE[piece], places)
        words = word_hashes(LOWER[piece], starts, ends)
        row = np.searchsorted(places, starts, "right") - 1
        n_words = np.bincount(row, minlength=last - first)
        begin = np.cumsum(n_words) - n_words
        # A shingle starts at each word that has width - 1 more after it in its text; else one at the first.
        place = np.arange(len(words)) - begin[row]
        size = np.minimum(width, n_words)[row]
        heads = np.flatnonzero(place + size <= n_words[row])
        h = np.full(len(heads), np.uint64(width))
        for k in range(width):
            inside = k < size[heads]
            h[inside] = mix(h[inside] ^ words[heads[inside] + k]) + np.uint64(k)
        order = np.lexsort((h, row[heads]))
        h, owner = h[order], row[heads][order]
        if len(h):
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            h, owner = h[fresh], owner[fresh]
        yield first, last, h, np.searchsorted(owner, np.arange(last - first + 1))


def set_name(h: np.ndarray) -> bytes:
    """A keyed name of 128 bits for a set of ascending fingerprints; empty for the empty set."""
    return blake2b(np.ascontiguousarray(h).tobytes(), digest_size=16, key=_KEY).digest() if len(h) else b""
