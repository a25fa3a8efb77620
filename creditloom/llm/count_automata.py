"""Weighted acyclic automata of n-gram counts: incremental build from sorted paths, union, cut by prefix range, composition.

A path is a row of ``order`` word numbers from 1 to 2^32 - 1, filled up with
zeros; rows ascend. A state of depth d is a prefix of d words, its weight the
count of the n-gram that ends there, 0 where it is only passed through. States
of the last depth but one with equal arcs and weights are one state: their arcs
lie in a register and are stored once. All steps are array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

Paths = tuple[np.ndarray, np.ndarray]


def ordered(keys: np.ndarray) -> np.ndarray:
    """The order of rows: lexicographic by column."""
    return np.lexsort(keys.T[::-1])


def comparable(keys: np.ndarray) -> np.ndarray:
    """Rows as byte strings of the same order, for binary search."""
    return np.ascontiguousarray(keys.astype(">u4")).view(f"S{4 * keys.shape[1]}").ravel()


def summed(keys: np.ndarray, weights: np.ndarray) -> Paths:
    """Distinct rows in order with the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = ordered(keys)
    keys, weights = keys[order], weights[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(1)
    starts = np.flatnonzero(new)
    return keys[starts], np.add.reduceat(weights, starts)


def _changes(keys: np.ndarray) -> np.ndarray:
    """Where the prefix of each depth differs from that of the row before."""
    changes = np.ones(keys.shape, bool)
    if len(keys):
        np.logical_or.accumulate(keys[1:] != keys[:-1], axis=1, out=changes[1:])
    return changes


@dataclass
class CountAutomaton:
    """Per depth: arc labels, weights and, but for the last, where the arcs of each state end.

    For the last depth but one ``ends`` holds the state's number in the register,
    whose arcs are the labels and weights of the last depth; ``register_ends``
    says where they end there.
    """

    labels: list[np.ndarray]
    weights: list[np.ndarray]
    ends: list[np.ndarray]
    register_ends: np.ndarray

    @property
    def order(self) -> int:
        return len(self.labels)

    @classmethod
    def of_positions(cls, keys: np.ndarray) -> CountAutomaton:
        """Counts of all prefixes of ascending rows, one row per position of a text."""
        changes = _changes(keys)
        starts, weights = [], []
        for d in range(keys.shape[1]):
            runs = np.flatnonzero(changes[:, d])
            real = keys[runs, d] != 0
            weights.append(np.diff(np.append(runs, len(keys)))[real])
            starts.append(runs[real])
        return cls._built(keys, changes, starts, weights)

    @classmethod
    def of_paths(cls, keys: np.ndarray, weights: np.ndarray) -> CountAutomaton:
        """From distinct ascending rows and their weights."""
        changes = _changes(keys)
        length = (keys != 0).sum(1)
        starts = [np.flatnonzero(changes[:, d] & (keys[:, d] != 0)) for d in range(keys.shape[1])]
        return cls._built(keys, changes, starts, [np.where(length[s] == d + 1, weights[s], 0) for d, s in enumerate(starts)])

    @classmethod
    def _built(cls, keys: np.ndarray, changes: np.ndarray, starts: list[np.ndarray], weights: list[np.ndarray]) -> CountAutomaton:
        ends = []
        for d in range(keys.shape[1] - 1):
            runs = np.append(np.flatnonzero(changes[:, d]), len(keys))
            stop = runs[np.searchsorted(runs, starts[d], "right")]
            ends.append(np.searchsorted(starts[d + 1], stop))
        labels = [keys[s, d].astype(np.int64) for d, s in enumerate(starts)]
        return cls(labels, weights, ends, np.zeros(0, np.int64))._registered()

    def _registered(self) -> CountAutomaton:
        """Make one state of all states of the last depth but one that have the same arcs."""
        last, amount, stop = self.labels[-1], self.weights[-1], self.ends[-1]
        begin = np.append(0, stop)[:-1]
        size = stop - begin
        state = np.zeros(len(size), np.int64)  # 0 is the state without arcs
        one = np.flatnonzero(size == 1)
        arcs = np.stack([last[begin[one]], amount[begin[one]]], 1)
        order = ordered(arcs)
        new = np.ones(len(one), bool)
        new[1:] = (arcs[order][1:] != arcs[order][:-1]).any(1)
        state[one[order]] = np.cumsum(new)
        chosen = one[order[new]]
        register: dict[bytes, int] = {}
        more, first = np.flatnonzero(size > 1), []
        both = np.stack([last, amount], 1) if len(more) else None
        for i in more.tolist():
            found = register.setdefault(both[begin[i]:stop[i]].tobytes(), len(register))
            if found == len(first):
                first.append(i)
            state[i] = len(chosen) + 1 + found
        chosen = np.append(chosen, np.array(first, np.int64))
        picked, sizes = _segments(begin[chosen], size[chosen]), size[chosen]
        return CountAutomaton([*self.labels[:-1], last[picked]], [*self.weights[:-1], amount[picked]], [*self.ends[:-1], state],
                              np.append(0, np.cumsum(sizes)))

    def paths(self) -> Paths:
        """All n-grams of the automaton in order, with their weights."""
        begins, sizes, labels, weights = [], [], list(self.labels), list(self.weights)
        for d in range(self.order - 1):
            if d < self.order - 2:
                stop = self.ends[d]
                begins.append(np.append(0, stop)[:-1])
                sizes.append(stop - begins[d])
            else:  # the shared states are told apart again
                register = np.append(0, self.register_ends)
                low, high = register[self.ends[d]], register[self.ends[d] + 1]
                sizes.append(high - low)
                begins.append(np.cumsum(high - low) - (high - low))
                arcs = _segments(low, high - low)
                labels[-1], weights[-1] = labels[-1][arcs], weights[-1][arcs]
        below = [np.ones(len(x), np.int64) for x in labels]  # states of a subtree, itself included
        for d in reversed(range(self.order - 1)):
            total = np.append(0, np.cumsum(below[d + 1]))
            below[d] += total[begins[d] + sizes[d]] - total[begins[d]]
        keys = np.zeros((sum(map(len, labels)), self.order), np.uint32)
        out = np.zeros(len(keys), np.int64)
        at, prefix = np.cumsum(below[0]) - below[0], labels[0][:, None]
        for d in range(self.order):
            keys[at, :d + 1], out[at] = prefix, weights[d]
            if d < self.order - 1:
                parent = np.repeat(np.arange(len(at)), sizes[d])
                total = np.cumsum(below[d + 1]) - below[d + 1]
                first = np.minimum(begins[d][parent], max(len(total) - 1, 0))
                at = at[parent] + 1 + total - total[first] if len(parent) else np.zeros(0, np.int64)
                prefix = np.concatenate([prefix[parent], labels[d + 1][:, None]], 1)
        real = out > 0
        return keys[real], out[real]

    def composed(self, keys: np.ndarray) -> np.ndarray:
        """The weights with which the automaton takes the paths of an acceptor: both are walked arc by arc; 0 where it has none."""
        state, alive = np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
        out = np.zeros(len(keys), np.int64)
        for d in range(self.order):
            alive &= keys[:, d] != 0
            if not alive.any() or not len(self.labels[d]):
                alive &= False
                break
            if d == 0:
                arcs = self.labels[0]
            else:
                sizes = np.diff(np.append(0, self.ends[d - 1])) if d < self.order - 1 else np.diff(np.append(0, self.register_ends))
                arcs = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64) << np.uint64(32) | self.labels[d].astype(np.uint64)
            wanted = keys[:, d].astype(np.uint64) if d == 0 else state.astype(np.uint64) << np.uint64(32) | keys[:, d].astype(np.uint64)
            arc = np.minimum(np.searchsorted(arcs.astype(np.uint64), wanted), len(arcs) - 1)
            alive &= arcs[arc].astype(np.uint64) == wanted
            ends_here = alive & (keys[:, d + 1] == 0 if d + 1 < self.order else True)
            out[ends_here] = self.weights[d][arc[ends_here]]
            state = np.where(alive, self.ends[d][arc] if d == self.order - 2 else arc, 0)
        return out

    def to_bytes(self) -> bytes:
        """Arrays in the smallest unsigned type that holds them, compressed together."""
        arrays = [*self.labels, *self.weights, *self.ends, self.register_ends]
        small = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
        head = np.array([[a.itemsize, len(a)] for a in small], np.int64)
        content = np.int64(len(self.labels)).tobytes() + head.tobytes() + b"".join(a.tobytes() for a in small)
        return zstandard.ZstdCompressor(level=1).compress(content)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountAutomaton:
        content = zstandard.ZstdDecompressor().decompress(data)
        order = int(np.frombuffer(content, np.int64, 1)[0])
        head = np.frombuffer(content, np.int64, 6 * order, 8).reshape(-1, 2)
        at, arrays = 8 + 48 * order, []
        for size, n in head.tolist():
            arrays.append(np.frombuffer(content, f"u{size}", n, at).astype(np.int64))
            at += size * n
        return cls(arrays[:order], arrays[order:2 * order], arrays[2 * order:-1], arrays[-1])


def _segments(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin[i] .. begin[i] + size[i] - 1 of all i."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def union(parts: list[CountAutomaton], order: int) -> Paths:
    """The n-grams of all automata with the sums of their weights."""
    paths = [p.paths() for p in parts]
    keys = np.concatenate([np.zeros((0, order), np.uint32), *[k for k, _ in paths]])
    return summed(keys, np.concatenate([np.zeros(0, np.int64), *[w for _, w in paths]]))


def cut(keys: np.ndarray, weights: np.ndarray, cuts: np.ndarray) -> list[tuple[int, CountAutomaton]]:
    """Automata of the prefix ranges that ascending rows fall into; range r is from cut r - 1 on and before cut r."""
    places = [0, *np.searchsorted(comparable(keys), comparable(cuts)).tolist(), len(keys)] if len(cuts) else [0, len(keys)]
    return [(r, CountAutomaton.of_paths(keys[a:b], weights[a:b])) for r, (a, b) in enumerate(zip(places, places[1:])) if b > a]
