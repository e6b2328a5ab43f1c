"""Simple-8b: runs of unsigned integers in 64-bit words, coded and decoded as arrays."""

from __future__ import annotations

import numpy as np

#: Integers in a word, by selector (the upper four bits); each takes 60 // count bits, the first one the lowest.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
#: The selector of a word that the next word follows as it is: an integer of more than 60 bits.
ESCAPE = 15
#: Integers of a block at most. A block starts at a word of its own, so blocks are decoded apart from each other.
BLOCK = 256
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_OF_SELECTOR = np.array([*COUNTS, 0, 1], np.int64)


def block_counts(lengths: np.ndarray) -> np.ndarray:
    """Integers of each block where every run of `lengths` integers starts a block; an empty run has none."""
    blocks = -(-lengths // BLOCK)
    last = np.cumsum(blocks) - 1
    counts = np.full(int(blocks.sum()), BLOCK, np.int64)
    some = lengths > 0
    counts[last[some]] = lengths[some] - (blocks[some] - 1) * BLOCK
    return counts


def encode(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values, and how many each block has; counts are those of block_counts().

    At each place the selector with the most integers that fit is taken, a block's end filled up with zeros. Which fit
    is found for all places at once; then all blocks are walked side by side, a word of each in a step.
    """
    padded = np.append(values.astype(np.uint64), np.uint64(0))
    width = BLOCK + COUNTS[0]
    cells = (np.cumsum(counts) - counts)[:, None] + np.arange(width)
    cells[np.arange(width) >= counts[:, None]] = len(values)
    table = padded[cells]
    bits = np.searchsorted(_POWERS, padded, side="right").astype(np.uint8)[cells]

    selector = np.full((len(counts), BLOCK), ESCAPE, np.int8)
    largest, span = bits, 1
    for s in range(len(COUNTS) - 1, -1, -1):
        n = COUNTS[s]
        while span * 2 <= n:
            largest, span = np.maximum(largest[:, :-span], largest[:, span:]), span * 2
        window = np.maximum(largest[:, :BLOCK], largest[:, n - span : n - span + BLOCK])
        selector[window <= 60 // n] = s

    at = np.zeros(len(counts), np.int64)
    rows, places, selectors = [], [], []
    open_ = np.flatnonzero(counts > 0)
    while len(open_):
        place = at[open_]
        chosen = selector[open_, place]
        rows.append(open_)
        places.append(place)
        selectors.append(chosen)
        at[open_] = place + _OF_SELECTOR[chosen]
        open_ = open_[at[open_] < counts[open_]]
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    row, place, chosen = (np.concatenate(x) for x in (rows, places, selectors))
    order = np.argsort(row, kind="stable")
    row, place, chosen = row[order], place[order], chosen[order]

    lengths = 1 + (chosen == ESCAPE)
    word = np.cumsum(lengths) - lengths
    words = np.zeros(int(lengths.sum()), np.uint64)
    for s, n in enumerate(COUNTS):
        own = np.flatnonzero(chosen == s)
        packed = np.full(len(own), np.uint64(s) << np.uint64(60), np.uint64)
        for k in range(n):
            packed |= table[row[own], place[own] + k] << np.uint64(k * (60 // n))
        words[word[own]] = packed
    own = np.flatnonzero(chosen == ESCAPE)
    words[word[own]] = np.uint64(ESCAPE) << np.uint64(60)
    words[word[own] + 1] = table[row[own], place[own]]
    return words, np.bincount(row, weights=lengths, minlength=len(counts)).astype(np.int64)


def decode(words: np.ndarray, words_by_block: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values (uint64) of whole blocks, given the words and the integers that each has."""
    if not len(words):
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    marked = selector == ESCAPE
    # of words that look like escapes and stand next to each other, every other one is what an escape escapes
    change = np.flatnonzero(np.diff(np.concatenate([[False], marked])))
    begin = np.zeros(len(words), np.int64)
    begin[change] = change
    begin = np.maximum.accumulate(begin)
    escapes = marked & ((np.arange(len(words)) - begin) % 2 == 0)
    raw = np.concatenate([[False], escapes[:-1]])
    if (~raw & (selector == len(COUNTS))).any():
        raise ValueError("a word has a selector that is not in use")
    selector[raw], selector[escapes] = -1, ESCAPE - 1  # one integer; none

    held = _OF_SELECTOR[selector]
    some = words_by_block > 0
    last = np.cumsum(words_by_block)[some] - 1
    total = np.concatenate([[0], np.cumsum(held)])
    filled = total[last + 1] - total[last + 1 - words_by_block[some]]
    held[last] -= filled - counts[some]
    to = np.cumsum(held) - held
    values = np.zeros(int(counts.sum()), np.uint64)
    values[to[raw]] = words[raw]
    for s, n in enumerate(COUNTS):
        own = np.flatnonzero(selector == s)
        width = 60 // n
        mask = np.uint64((1 << width) - 1)
        for k in range(n):
            with_k = own[held[own] > k]
            values[to[with_k] + k] = words[with_k] >> np.uint64(k * width) & mask
    return values
