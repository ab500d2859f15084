"""Simple-8b: integers packed into 64-bit words, in blocks with their own word offsets.

A word has a selector in its top four bits and equal slots in the other sixty. Values of more than 60
bits follow a word with the escape selector as they are. Blocks of BLOCK values start on a word of their
own, so that they are coded and decoded at once, one numpy step for all blocks of a batch.
"""

from __future__ import annotations

import numpy as np

# Slots and bits of a slot for the selectors 2 to 15; selector 1 is the escape.
SLOTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 1
BLOCK = 256
_LIMIT = np.uint64(1) << np.uint64(60)
_EDGES = np.array([1 << b for b in range(1, 61)], dtype=np.uint64)
# Bits of the values below 2^16.
_SMALL = (np.searchsorted(_EDGES, np.arange(1 << 16, dtype=np.uint64), side="right") + 1).astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, 1 at least; 61 stands for more than 60."""
    width = _SMALL[np.minimum(values, np.uint64(_SMALL.size - 1)).astype(np.int64)]
    large = np.flatnonzero(values >= _SMALL.size)
    width[large] = np.searchsorted(_EDGES, values[large], side="right") + 1
    return width


def _slots_taken(width: np.ndarray) -> np.ndarray:
    """For each place of the blocks, how many values the word that begins there takes."""
    most = {1: width}

    def shifted(a: np.ndarray, by: int) -> np.ndarray:
        out = np.ones_like(a)
        out[:, :-by] = a[:, by:]
        return out

    def window(n: int) -> np.ndarray:
        if n not in most:
            half = (n + 1) // 2
            most[n] = np.maximum(window(half), shifted(window(half), n - half))
        return most[n]

    taken = np.ones(width.shape, dtype=np.uint8)
    for slots, bits in zip(reversed(SLOTS), reversed(BITS), strict=True):
        np.copyto(taken, slots, where=window(slots) <= bits)
    return taken


def encode(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences laid end to end -> words, words per block, blocks per sequence."""
    lengths = np.asarray(lengths, dtype=np.int64)
    blocks = -(-lengths // BLOCK)
    n_blocks = int(blocks.sum())
    if n_blocks == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), blocks
    nth = np.arange(n_blocks) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begins = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * BLOCK
    sizes = np.minimum(BLOCK, np.repeat(lengths, blocks) - nth * BLOCK)
    # A row per block; behind its values come zeros, which any word may take.
    row = BLOCK + SLOTS[0]
    inside = np.arange(row) < sizes[:, None]
    grid, width = np.zeros(inside.shape, dtype=np.uint64), np.ones(inside.shape, dtype=np.uint8)
    grid[inside], width[inside] = values, _widths(values)
    taken = _slots_taken(width).ravel()
    grid, width = grid.ravel(), width.ravel()
    begin = np.zeros(grid.size, dtype=bool)
    here = np.arange(n_blocks) * row
    end = here + sizes
    while here.size:
        begin[here] = True
        here = here + taken[here]
        live = here < end
        here, end = here[live], end[live]
    starts = np.flatnonzero(begin)
    wide = width[starts] > 60
    words = np.bincount(starts // row, 1 + wide, n_blocks).astype(np.int64)
    target = np.cumsum(1 + wide) - (1 + wide)
    out = np.zeros(int(words.sum()), dtype=np.uint64)
    out[target[wide]] = np.uint64(ESCAPE) << np.uint64(60)
    out[target[wide] + 1] = grid[starts[wide]]
    count = np.where(wide, 0, taken[starts])
    for selector, (slots, bits) in enumerate(zip(SLOTS, BITS, strict=True), 2):
        chosen = np.flatnonzero(count == slots)
        if chosen.size:
            packed = np.full(chosen.size, selector, dtype=np.uint64) << np.uint64(60)
            first = starts[chosen]
            for k in range(slots):
                packed |= grid[first + k] << np.uint64(bits * k)
            out[target[chosen]] = packed
    return out, words, blocks


def decode(words: np.ndarray, words_per_block: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values that `encode` was given."""
    lengths = np.asarray(lengths, dtype=np.int64)
    blocks = -(-lengths // BLOCK)
    n_blocks = int(blocks.sum())
    out = np.zeros(int(lengths.sum()), dtype=np.uint64)
    if n_blocks == 0:
        return out
    nth = np.arange(n_blocks) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begins = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * BLOCK
    sizes = np.minimum(BLOCK, np.repeat(lengths, blocks) - nth * BLOCK)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(words.size, dtype=bool)
    for i in np.flatnonzero(selector == ESCAPE):  # a raw word may look like an escape itself
        if not raw[i]:
            raw[i + 1] = True
    slots_of = np.array([0, 1, *SLOTS])
    count = np.where(raw, 0, slots_of[selector])
    block = np.repeat(np.arange(n_blocks), words_per_block)
    first = np.cumsum(words_per_block) - words_per_block
    before = np.cumsum(count) - count
    inside = before - before[first][block]
    end = begins[block] + sizes[block]
    position = begins[block] + inside
    escapes = np.flatnonzero((selector == ESCAPE) & ~raw)
    out[position[escapes]] = words[escapes + 1]
    for k, (slots, bits) in enumerate(zip(SLOTS, BITS, strict=True), 2):
        chosen = np.flatnonzero((selector == k) & ~raw)
        if chosen.size:
            w, p, stop = words[chosen], position[chosen], end[chosen]
            mask = np.uint64((1 << bits) - 1)
            for j in range(slots):
                there = p + j < stop
                out[p[there] + j] = (w[there] >> np.uint64(bits * j)) & mask
    return out
