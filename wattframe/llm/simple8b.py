"""Simple-8b: whole numbers packed word by word into 64 bits.

A word has a selector in its top four bits; it says how many numbers of how many
bits the other sixty hold. A number of more than sixty bits is an escape: its
word holds its place in a list beside the words. Numbers come in blocks of
``BLOCK``; a word never crosses a block, so blocks decode on their own, all
words of one selector at once.
"""

import numpy as np

BLOCK = 256
#: Fixed values of the scheme: numbers in a word and bits of each, by selector. Selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
_TOP = np.uint64(60)


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, words of each block, escaped numbers, and escapes of each block."""
    numbers = np.ascontiguousarray(numbers, np.uint64)
    size = len(numbers)
    blocks = -(-size // BLOCK)
    if not size:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(0, np.uint32), none, np.zeros(0, np.uint32)
    place = np.arange(size, dtype=np.int32)
    end = np.minimum((place // BLOCK + 1) * BLOCK, size).astype(np.int32)
    # the selector of the word that would begin at each place: the first, densest one whose numbers all fit
    selector = np.zeros(size, np.int8)
    open_ = numbers < (np.uint64(1) << _TOP)
    selector[open_] = 15
    for s in range(14, 0, -1):
        too_large = numbers >= (np.uint64(1) << BITS[s])
        next_large = np.where(too_large, place, size)
        next_large = np.minimum.accumulate(next_large[::-1])[::-1]
        selector[next_large >= np.minimum(place + np.int32(COUNTS[s]), end)] = s
    taken = np.minimum(COUNTS[selector], end - place)
    # all blocks take one word at a time
    begins = np.zeros(size, bool)
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    last = np.minimum(at + BLOCK, size)
    while len(at):
        begins[at] = True
        at = at + taken[at]
        at, last = at[at < last], last[at < last]
    first = np.flatnonzero(begins)
    chosen = selector[first]
    words = chosen.astype(np.uint64) << _TOP
    padded = np.concatenate([numbers, np.zeros(int(COUNTS.max()), np.uint64)])
    for s in range(2, 16):
        own = np.flatnonzero(chosen == s)
        if len(own):
            step = np.arange(COUNTS[s])
            rows = padded[first[own][:, None] + step]
            rows[step >= taken[first[own]][:, None]] = 0
            words[own] |= np.bitwise_or.reduce(rows << (step.astype(np.uint64) * BITS[s]), axis=1)
    escape = np.flatnonzero(chosen == 0)
    block = first // BLOCK
    words[escape] |= np.arange(len(escape), dtype=np.uint64) - _before(block[escape], blocks)
    per_block = np.bincount(block, minlength=blocks).astype(np.uint32)
    return words, per_block, numbers[first[escape]], np.bincount(block[escape], minlength=blocks).astype(np.uint32)


def _before(block: np.ndarray, blocks: int) -> np.ndarray:
    """For each escape, how many there are in earlier blocks."""
    each = np.bincount(block, minlength=blocks)
    return (np.cumsum(each) - each)[block].astype(np.uint64)


def unpack(
    words: np.ndarray, per_block: np.ndarray, escapes: np.ndarray, escapes_per_block: np.ndarray, size: int
) -> np.ndarray:
    """The ``size`` numbers of consecutive blocks; all but the last block are full."""
    out = np.zeros(size, np.uint64)
    if not size:
        return out
    chosen = (words >> _TOP).astype(np.int64)
    block = np.repeat(np.arange(len(per_block)), per_block)
    ends = np.cumsum(COUNTS[chosen])
    start = ends - COUNTS[chosen]
    first = np.cumsum(per_block.astype(np.int64)) - per_block
    start = start - start[first][block] + block * BLOCK
    stop = np.minimum((block + 1) * BLOCK, size)
    for s in range(2, 16):
        own = np.flatnonzero(chosen == s)
        if len(own):
            step = np.arange(COUNTS[s])
            rows = (words[own][:, None] >> (step.astype(np.uint64) * BITS[s])) & ((np.uint64(1) << BITS[s]) - np.uint64(1))
            to = start[own][:, None] + step
            inside = to < stop[own][:, None]
            out[to[inside]] = rows[inside]
    own = np.flatnonzero(chosen == 0)
    if len(own):
        skipped = np.cumsum(escapes_per_block.astype(np.int64)) - escapes_per_block
        out[start[own]] = escapes[(words[own] & np.uint64(0xFFFFFFFF)).astype(np.int64) + skipped[block[own]]]
    return out
