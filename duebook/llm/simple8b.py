"""Simple-8b: as many small integers per 64-bit word as its selector allows.

The top four bits of a word select how many values it holds and of how many bits each. Values are
coded in blocks of BLOCK; a block begins with a new word, so blocks can be coded and decoded side
by side. A value of more than 60 bits is an escape: a word with the selector ESCAPE and no
data, then the value as a word of its own.
"""

from __future__ import annotations

import numpy as np

#: Values per word and bits per value, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
BLOCK = 256
DATA = np.uint64((1 << 60) - 1)


def needed_selector(values: np.ndarray) -> np.ndarray:
    """The first selector whose values are wide enough (ESCAPE beyond 60 bits)."""
    tops = np.array([1 << int(b) for b in BITS], np.uint64)
    found = np.searchsorted(tops, values, "right")
    return np.where(found == len(BITS), ESCAPE, found).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, and the word at which each block begins (one more than blocks)."""
    values = np.asarray(values, np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    lengths = np.full(blocks, BLOCK)
    lengths[-1] = len(values) - BLOCK * (blocks - 1)
    width = BLOCK + int(COUNTS[0])
    table = np.zeros((blocks, width), np.uint64)  # zeros behind the last value fill its word
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[: len(values)] = values
    table[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    needs = needed_selector(table.ravel()).reshape(table.shape)
    best = best_selectors(needs)[:, :BLOCK]
    # Where the words of each block begin: all blocks step forward at once.
    steps = np.append(COUNTS, [0, 1])[best].astype(np.int16)
    place = np.zeros(blocks, np.int64)
    open_ = np.arange(blocks)
    rows, starts = [], []
    while len(open_):
        rows.append(open_)
        starts.append(place[open_])
        place[open_] += steps[open_, place[open_]]
        open_ = open_[place[open_] < lengths[open_]]
    row, start = np.concatenate(rows), np.concatenate(starts)
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    selector = best[row, start]
    # An escape takes two words.
    size = np.where(selector == ESCAPE, 2, 1)
    after = np.cumsum(size)
    at = after - size
    words = np.zeros(int(after[-1]), np.uint64)
    flat, first = table.ravel(), row * width + start
    for kind in range(len(COUNTS)):
        own = np.flatnonzero(selector == kind)
        word = np.full(len(own), kind << 60, np.uint64)
        for i in range(int(COUNTS[kind])):
            word |= flat[first[own] + i] << np.uint64(i * int(BITS[kind]))
        words[at[own]] = word
    own = np.flatnonzero(selector == ESCAPE)
    words[at[own]] = np.uint64(ESCAPE << 60)
    words[at[own] + 1] = flat[first[own]]
    last = np.append(np.flatnonzero(np.diff(row)), len(row) - 1)
    return words, np.append(0, after[last])


def best_selectors(needs: np.ndarray) -> np.ndarray:
    """For each place the selector of most values such that all values of a word there fit.

    ``needs`` holds a row per block. The most that any of the next n values needs comes from two
    such maxima over fewer values; the last columns see fewer values and are not meant to be used.
    """
    most = {1: needs}

    def over(n: int) -> np.ndarray:
        if n not in most:
            half = n // 2 if n % 2 == 0 else (n + 1) // 2  # two overlapping halves
            part = over(half)
            out = part.copy()
            shift = n - half
            np.maximum(part[:, :-shift], part[:, shift:], out=out[:, :-shift])
            most[n] = out
        return most[n]

    best = np.full(needs.shape, ESCAPE, np.uint8)
    for selector in range(len(COUNTS) - 1, -1, -1):
        np.copyto(best, np.uint8(selector), where=over(int(COUNTS[selector])) <= selector)
    return best


def decode(words: np.ndarray, starts: np.ndarray, total: int) -> np.ndarray:
    """All ``total`` values of the blocks that begin at ``starts``."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (selector == ESCAPE).any():
        # A raw word follows its escape; which words are raw shows from the front.
        for i in np.flatnonzero(selector == ESCAPE):
            raw[i + 1 : i + 2] = not raw[i]
    counts = np.where(raw, 1, np.append(COUNTS, [0, 0])[selector])
    after = np.cumsum(counts)
    out = np.zeros(int(after[-1]) if len(after) else 0, np.uint64)
    first = after - counts
    out[first[raw]] = words[raw]
    for kind in range(len(COUNTS)):
        own = np.flatnonzero((selector == kind) & ~raw)
        data = words[own] & DATA
        mask = np.uint64((1 << int(BITS[kind])) - 1)
        for i in range(int(COUNTS[kind])):
            out[first[own] + i] = (data >> np.uint64(i * int(BITS[kind]))) & mask
    # Each block's last word may hold zeros beyond its values.
    begins = np.append(first, len(out))[starts]
    blocks = len(starts) - 1
    lengths = np.full(blocks, BLOCK)
    if blocks:
        lengths[-1] = total - BLOCK * (blocks - 1)
    keep = np.repeat(begins[:-1] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
    return out[keep]
