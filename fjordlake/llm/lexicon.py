"""A minimal acyclic transducer: words to id sequences, in one flat array that workers map into memory.

Words are bytes. States with equal futures (labels, outputs, targets and ends) are one, so that endings are shared; outputs sit as
close to the start as all words through an edge allow. A word's ids are what its edges give, and what its last state adds.

Layout: one array of little-endian 32-bit integers. Seven lengths come first, then, one behind the other: edge keys (256 * state +
label, rising), edge targets, begin and length of the edges' outputs in the pool, begin (-1: no end) and length of the states', and
the pool of ids. The start is state 0.
"""

from __future__ import annotations

import numpy as np

PARTS = 7


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class _Open:
    """A state whose edges are not all known yet."""

    __slots__ = ("ends", "labels", "outputs", "targets")

    def __init__(self):
        self.ends, self.labels, self.outputs, self.targets = None, [], [], []


def compiled(words: list[tuple[bytes, tuple[int, ...]]]) -> np.ndarray:
    """The automaton of words with their ids, each word once and rising in the order of bytes."""
    known: dict[tuple, int] = {}
    states: list[tuple] = []

    def close(state: _Open) -> int:
        key = (state.ends, tuple(state.labels), tuple(state.outputs), tuple(state.targets))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path, before = [_Open()], b""
    for word, ids in words:
        shared = _common(before, word)
        for _ in range(len(before) - shared):
            done = close(path.pop())
            path[-1].targets.append(done)
        rest = tuple(ids)
        for i in range(shared):
            # what the words through this edge do not have in common moves behind it
            own = path[i].outputs[-1]
            same = _common(own, rest)
            if same < len(own):
                path[i].outputs[-1] = own[:same]
                after, moved = path[i + 1], own[same:]
                after.outputs = [moved + o for o in after.outputs]
                after.ends = None if after.ends is None else moved + after.ends
            rest = rest[same:]
        for label in word[shared:]:
            path[-1].labels.append(label)
            path[-1].outputs.append(rest)
            path.append(_Open())
            rest = ()
        path[-1].ends = rest
        before = word
    while len(path) > 1:
        done = close(path.pop())
        path[-1].targets.append(done)
    root = close(path.pop())
    # states were numbered as they closed, the start last; here it is the first
    n = len(states)
    place = lambda s: (root - s) % n
    pool: list[int] = []
    begins: dict[tuple, int] = {(): 0}

    def kept(out: tuple) -> int:
        if out not in begins:
            begins[out] = len(pool)
            pool.extend(out)
        return begins[out]

    keys, targets, edge_begin, edge_length, end_begin, end_length = [], [], [], [], [], []
    for s in range(n):
        ends, labels, outputs, after = states[(root - s) % n]
        end_begin.append(-1 if ends is None else kept(ends))
        end_length.append(0 if ends is None else len(ends))
        for label, out, target in zip(labels, outputs, after):
            keys.append(256 * s + label)
            targets.append(place(target))
            edge_begin.append(kept(out))
            edge_length.append(len(out))
    parts = [np.array(x, "<i4") for x in (keys, targets, edge_begin, edge_length, end_begin, end_length, pool)]
    return np.concatenate([np.array([len(x) for x in parts], "<i4"), *parts])


class Lexicon:
    """Looks words up in the array of `compiled`, many at a time."""

    def __init__(self, data: np.ndarray):
        at, parts = PARTS, []
        for n in data[:PARTS].tolist():
            parts.append(data[at : at + n])
            at += n
        self.keys, self.targets, self.edge_begin, self.edge_length, self.end_begin, self.end_length, self.pool = parts

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, "<i4", mode="r"))

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is known, how many ids it has (0 if not known), and all their ids one behind the other."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        state = np.zeros(n, np.int64)
        alive = np.arange(n)
        steps: list[tuple[np.ndarray, np.ndarray]] = []  # words and the edges they took, step by step
        for step in range(int(sizes.max(initial=0))):
            alive = alive[sizes[alive] > step]
            if not len(alive) or not len(self.keys):
                break
            wanted = 256 * state[alive] + flat[starts[alive] + step]
            edge = np.searchsorted(self.keys, wanted)
            edge[edge == len(self.keys)] = 0
            found = self.keys[edge] == wanted
            sizes[alive[~found]] = -1  # no such word
            alive, edge = alive[found], edge[found]
            state[alive] = self.targets[edge]
            steps.append((alive, edge))
        known = (sizes >= 0) & (np.asarray(self.end_begin)[state] >= 0)
        if not len(self.keys):
            known &= sizes == 0
        counts = np.zeros(n, np.int64)
        pieces = []
        for alive, edge in steps:
            good = known[alive] & (self.edge_length[edge] > 0)
            pieces.append((alive[good], self.edge_begin[edge[good]].astype(np.int64), self.edge_length[edge[good]].astype(np.int64)))
        ends = np.flatnonzero(known & (np.asarray(self.end_length)[state] > 0))
        pieces.append((ends, self.end_begin[state[ends]].astype(np.int64), self.end_length[state[ends]].astype(np.int64)))
        for own, _, length in pieces:
            counts[own] += length  # a word takes one edge a step, so that none comes twice in a piece
        out = np.zeros(int(counts.sum()), np.int64)
        place = np.cumsum(counts) - counts
        for own, begin, length in pieces:
            for k in range(int(length.max(initial=0))):
                some = length > k
                out[place[own[some]] + k] = self.pool[begin[some] + k]
            place[own] += length
        return known, counts, out
