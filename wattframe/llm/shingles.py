"""Distinct word shingles of texts, as hashes, for many texts at once."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .tokens import PART_BYTES, key_hash, part_keys, text_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(padded: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, A-Z in lower case, and where the words of each text begin and end among them."""
    text = _LOWER[padded]
    inside = ~_BLANK[text]
    inside[: bounds[0]] = inside[bounds[-1] :] = False
    cut = np.zeros(len(text), bool)
    cut[bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut[1:])) + 1
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut[1:])) + 1
    length = ends - starts
    hashes = np.empty(len(starts), np.uint64)
    short = np.flatnonzero(length <= PART_BYTES)
    hashes[short] = mixed(key_hash(part_keys(text, starts[short], length[short])))
    long = np.flatnonzero(length > PART_BYTES)
    if len(long):
        data = text.tobytes()
        pairs = zip(starts[long].tolist(), ends[long].tolist(), strict=True)
        hashes[long] = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in pairs]
    return hashes, np.searchsorted(starts, bounds)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts, the distinct shingles of each, in order, in a row; and where those of each begin and end.

    A text with fewer words than a shingle has is one shingle; without words it has none.
    """
    for padded, bounds in text_slices(texts):
        hashes, at = word_hashes(padded, bounds)
        n = np.diff(at)
        count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
        begin = np.concatenate([[0], np.cumsum(count)])
        first = np.repeat(at[:-1] - begin[:-1], count) + np.arange(begin[-1])
        has = np.repeat(np.minimum(n, words), count)
        folded = mixed(hashes[first] + has.astype(np.uint64))
        for k in range(1, words):
            more = hashes[np.minimum(first + k, max(len(hashes) - 1, 0))]
            folded = np.where(has > k, mixed(folded * np.uint64(3) + more), folded)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            if b - a > 1:
                folded[a:b].sort()
        distinct = np.ones(len(folded), bool)
        distinct[1:] = folded[1:] != folded[:-1]
        distinct[begin[:-1][count > 0]] = True
        kept = np.concatenate([[0], np.cumsum(distinct)])
        yield folded[distinct], kept[begin]
