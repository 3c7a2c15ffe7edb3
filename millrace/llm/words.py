"""Word positions and word hashes of many texts at once, on their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from millrace.llm.columns import mix

# Every byte is a separator or not; bytes of 0x80 and above are parts of characters and never separate.
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_RADIXES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_RADIX = _RADIXES[0]
_AT_ONCE = 1 << 14


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one separator behind each text, and the place where each text begins (one more at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return data, np.concatenate([[0], ends])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of non-separators (ASCII white space)."""
    space = _SPACES[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if data.size and not space[0]:
        edge = np.concatenate([[0], edge])
    if data.size and not space[-1]:
        edge = np.concatenate([edge, [data.size]])
    return edge[0::2], edge[1::2]


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, radix: int = 0
) -> np.ndarray:
    """A 64-bit hash of each word's bytes; with ``lower`` A-Z count as a-z. ``radix`` 1 gives another one."""
    if not starts.size:
        return np.zeros(0, np.uint64)
    codes = _CODES[_LOWER] if lower else _CODES
    sizes = ends - starts
    powers = np.empty(int(sizes.max()), np.uint64)
    powers[0] = 1
    if powers.size > 1:
        powers[1:] = _RADIXES[radix]
        np.multiply.accumulate(powers, out=powers)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    at = place + np.repeat(starts, sizes)
    return mix(np.add.reduceat(codes[data[at]] * powers[place], first) + sizes.astype(np.uint64))


def two_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` by both radixes, for some words at a time, so that what they need in between is small."""
    out = np.empty((2, starts.size), np.uint64)
    for i in range(0, starts.size, _AT_ONCE):
        own, sizes = starts[i : i + _AT_ONCE], ends[i : i + _AT_ONCE] - starts[i : i + _AT_ONCE]
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        codes = _CODES[data[place + np.repeat(own, sizes)]]
        for k, radix in enumerate(_RADIXES):
            powers = np.full(int(sizes.max()), radix, np.uint64)
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
            out[k, i : i + _AT_ONCE] = mix(np.add.reduceat(codes * powers[place], first) + sizes.astype(np.uint64))
    return out[0], out[1]


def words_of(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, hashes, bounds): words of all texts in order; text i has words bounds[i]:bounds[i + 1]."""
    data, begins = joined(texts)
    starts, ends = word_spans(data)
    bounds = np.searchsorted(starts, begins)
    return data, starts, ends, word_hashes(data, starts, ends, lower), bounds


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (positions that cross a text's end are the caller's to drop)."""
    count = hashes.size - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for i in range(1, n):
        out *= _RADIX
        out += hashes[i : i + count]
    return mix(out)
