"""Words and word n-grams of a text as 64-bit hashes, computed over whole arrays of bytes.

A word is a longest run of characters other than ASCII non-alphanumerics, in lower case.
Everything here works on one text at a time, in pieces of a few megabytes, so memory does not
grow with the number of texts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

PIECE = 4 << 20
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[:128] = [chr(i).isalnum() for i in range(128)]
_SEPARATORS = bytes(i for i in range(128) if not chr(i).isalnum())
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(1 << 12, _BASE, dtype=np.uint64), dtype=np.uint64)
_NO_HASHES = np.empty(0, dtype=np.uint64)
_NO_PLACES = np.empty(0, dtype=np.int64)


class Words(NamedTuple):
    """Hashes of the words, and the byte range of each in the lower-cased UTF-8 text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def words(data: bytes) -> Words:
    """The words of a lower-cased text; none for an empty text."""
    if len(data) <= PIECE:
        return _words(data, 0)
    parts, at = [], 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            while end < len(data) and data[end] not in _SEPARATORS:
                end += 1
        parts.append(_words(data[at:end], at))
        at = end
    return Words(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _words(data: bytes, offset: int) -> Words:
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return Words(_NO_HASHES, _NO_PLACES, _NO_PLACES)
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    chosen = raw[np.flatnonzero(inside[1:-1])].astype(np.uint64)
    terms = mix(chosen + np.uint64(1)) * _POWERS[place & (len(_POWERS) - 1)]
    firsts = np.cumsum(lengths) - lengths
    hashes = mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))
    return Words(hashes, starts + offset, ends + offset)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, in order; none if there are fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return _NO_HASHES
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + hashes[k : k + count]
    return mix(total)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The set of word n-grams, sorted. A text of fewer words, but at least one, is one shingle."""
    if 0 < len(hashes) < n:
        return ngrams(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(ngrams(hashes, n))
