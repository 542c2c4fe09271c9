"""Simple-8b in numpy: each 64-bit word holds a selector and as many ids as fit its 60 bits.

Ids are coded in blocks of BLOCK; every block begins at a word of its own, so blocks decode independently and side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
#: Ids in a word and bits of each, for selectors 1 to 14. Selector 15 is the escape: the next word is one raw 64-bit id.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
WIDEST = COUNTS[0]
_COUNT_OF = np.array((0, *COUNTS, 1), np.int64)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Of each value, 1 at least."""
    out = np.ones(values.shape, np.uint8)
    bit, top = 1, int(values.max(initial=0))
    while top >> bit:
        out += (values >> np.uint64(bit)) > 0
        bit += 1
    return out


def _best_selectors(lengths: np.ndarray) -> np.ndarray:
    """For each position the selector that packs most ids from there on."""
    wide = np.concatenate([lengths, np.zeros((len(lengths), WIDEST), np.uint8)], axis=1)
    n = lengths.shape[1]
    largest = {1: wide}  # by count: the longest of so many values from each position on

    def over(count: int) -> np.ndarray:
        if count not in largest:
            half = (count + 1) // 2
            part = over(half)
            shifted = np.zeros_like(part)
            shifted[:, : part.shape[1] - (count - half)] = part[:, count - half :]
            largest[count] = np.maximum(part, shifted)
        return largest[count]

    best = np.where(lengths > BITS[-1], np.uint8(ESCAPE), np.uint8(len(COUNTS)))
    for selector in range(len(COUNTS) - 1, 0, -1):
        best[over(COUNTS[selector - 1])[:, :n] <= BITS[selector - 1]] = selector
    return best


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each block the number of its first word."""
    ids = np.asarray(ids, np.uint64)
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    values = np.zeros((n, BLOCK + WIDEST), np.uint64)
    flat = np.zeros(n * BLOCK, np.uint64)
    flat[: len(ids)] = ids
    values[:, :BLOCK] = flat.reshape(n, BLOCK)
    best = _best_selectors(_bit_lengths(values[:, :BLOCK]))
    ends = np.full(n, BLOCK)
    ends[-1] = len(ids) - (n - 1) * BLOCK
    rows, at = np.arange(n), np.zeros(n, np.int64)
    steps = []
    while len(rows):
        selectors = best[rows, at]
        steps.append((rows, at, selectors))
        at = at + _COUNT_OF[selectors]
        going = at < ends[rows]
        rows, at = rows[going], at[going]
    row, position, selector = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(row, kind="stable")
    row, position, selector = row[order], position[order], selector[order]
    size = 1 + (selector == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = selector.astype(np.uint64) << np.uint64(60)
    for k, (count, bits) in enumerate(zip(COUNTS, BITS), 1):
        own = np.flatnonzero(selector == k)
        if len(own):
            some = words[place[own]]
            for j in range(count):
                some |= values[row[own], position[own] + j] << np.uint64(bits * j)
            words[place[own]] = some
    own = np.flatnonzero(selector == ESCAPE)
    words[place[own] + 1] = values[row[own], position[own]]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    return words, place[first].astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids, all blocks at once."""
    n = len(offsets)
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    heads = np.ones(len(words), bool)
    if (selector == ESCAPE).any():  # a word behind an escape is an id, whatever its bits say
        at, bound = 0, len(words)
        while at < bound:
            if selector[at] == ESCAPE:
                heads[at + 1] = False
                at += 1
            at += 1
    head = np.flatnonzero(heads)
    selector = selector[head]
    count = _COUNT_OF[selector]
    row = np.searchsorted(offsets, head, "right") - 1
    before = np.cumsum(count) - count
    position = before - before[np.searchsorted(head, offsets)][row]
    out = np.zeros((n, BLOCK + WIDEST), np.uint64)
    for k, (size, bits) in enumerate(zip(COUNTS, BITS), 1):
        own = np.flatnonzero(selector == k)
        if len(own):
            some, mask = words[head[own]], np.uint64((1 << bits) - 1)
            for j in range(size):
                out[row[own], position[own] + j] = (some >> np.uint64(bits * j)) & mask
    own = np.flatnonzero(selector == ESCAPE)
    out[row[own], position[own]] = words[head[own] + 1]
    return out[:, :BLOCK].reshape(-1)[:n_ids]
