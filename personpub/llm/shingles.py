"""Shingle sets of whole texts, hashed by vector operations over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS, MOST_WORDS = 4, 16
#: bytes of text hashed at a time, cut at white space
STEP = 2 << 20
_rng = np.random.default_rng(4)
_BYTE = _rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C13
_PLACE = _rng.integers(1 << 63, size=MOST_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_powers = np.ones(1, dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    """The first n powers of the base, modulo 2^64."""
    global _powers
    while _powers.size < n:
        step = np.uint64(pow(_BASE, _powers.size, 1 << 64))
        _powers = np.concatenate((_powers, _powers * step))
    return _powers[:n]


def word_hashes(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of the bytes `text`; a word also begins at `starts`."""
    word = ~_GAP[text]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[starts[starts < text.size]] |= word[starts[starts < text.size]]
    out, places, low = [], [], 0
    while low < text.size:
        high = min(low + STEP, text.size)
        while high < text.size and word[high] and not first[high]:
            stops = np.flatnonzero(~word[high : high + 4096] | first[high : high + 4096])
            high += int(stops[0]) if stops.size else min(4096, text.size - high)
        at = np.flatnonzero(word[low:high])
        if at.size:
            begin = np.flatnonzero(first[low:high][at])
            lengths = np.diff(np.append(begin, at.size))
            inside = np.arange(at.size) - np.repeat(begin, lengths)
            values = _BYTE[text[low:high][at]] * _power(int(lengths.max()))[inside]
            out.append(mix(np.add.reduceat(values, begin)))
            places.append(at[begin] + low)
        low = high
    if not out:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(out), np.concatenate(places)


def shingle_sets(texts: pa.Array, k: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Sets of k-word shingles of a column of texts, in runs of rows with a few MB: first row, row count, the
    sets' hashes in ascending order one after the other, and their sizes.

    A-Z are lower-cased; a word is what stands between ASCII white space. A text of
    fewer words than a shingle has one shingle of them all; a text without words none.
    """
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + 2 * STEP, "right")) - 1)
        end = min(end, n)
        part = data[offsets[row] : offsets[end]]
        cuts = offsets[row : end + 1] - offsets[row]
        words, places = word_hashes(part, cuts[:-1])
        owner = np.searchsorted(cuts, places, "right") - 1
        counts = np.bincount(owner, minlength=end - row)
        yield row, end - row, *_sets(words, owner, counts, k)
        row = end


def _sets(words: np.ndarray, owner: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if words.size >= k:
        whole = owner[k - 1 :] == owner[: owner.size - k + 1]
        h = np.zeros(words.size - k + 1, dtype=np.uint64)
        for i in range(k):
            h += mix(words[i : words.size - k + 1 + i] * _PLACE[i] + np.uint64(i))
        h, who = mix(h[whole]), owner[: owner.size - k + 1][whole]
    else:
        h, who = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    few = np.flatnonzero((counts > 0) & (counts < k))
    if few.size:
        first = np.cumsum(counts) - counts
        short = np.zeros(few.size, dtype=np.uint64)
        for i in range(k - 1):
            has = counts[few] > i
            short[has] += mix(words[first[few[has]] + i] * _PLACE[i] + np.uint64(i))
        h, who = np.append(h, mix(short + counts[few].astype(np.uint64))), np.append(who, few)
    order = np.lexsort((h, who))
    h, who = h[order], who[order]
    new = np.ones(h.size, dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    return h[new], np.bincount(who[new], minlength=counts.size)
