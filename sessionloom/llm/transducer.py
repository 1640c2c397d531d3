"""Weighted acyclic automata that map word sequences to counts.

A sequence is spelled by arcs from the root, one word each; the state it leads to holds how
often exactly that sequence was added. Of the two deepest levels, states that have the same
count and at most one arc, the same, are one state, so shared tails are stored once. Arcs are numpy
arrays per depth, in the order of their states and, within a state, of their labels; a label
is the rank of its word in the automaton's own sorted vocabulary, from 1.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import zstandard


def sort_keys(rows: np.ndarray, words: int) -> list[np.ndarray]:
    """The columns of ``rows`` packed into as few 64-bit keys as hold them, most significant first."""
    bits = max(1, int(words).bit_length())
    per, out = 63 // bits, []
    for at in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), np.int64)
        for c in range(at, min(at + per, rows.shape[1])):
            key = key << bits | rows[:, c]
        out.append(key)
    return out


def summed(rows: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows with the sums of their counts."""
    if not len(rows):
        return rows, counts
    keys = sort_keys(rows, words)
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(new)
    return rows[order[at]], np.add.reduceat(counts[order], at)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every size, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


@dataclass
class CountTransducer:
    words: list[bytes]
    labels: list[np.ndarray]  # by depth: the arcs' labels
    targets: list[np.ndarray]  # by depth: the arcs' states, one deeper
    fans: list[np.ndarray]  # by depth: how many arcs a state has
    ends: list[np.ndarray]  # by depth: how often the sequences of a state were added

    @staticmethod
    def build(words: list[bytes], rows: np.ndarray, counts: np.ndarray, share: bool = True) -> "CountTransducer":
        """From sorted distinct rows of labels, padded with 0, and their counts; ``share`` makes equal tails one."""
        depth = rows.shape[1]
        labels, fans, ends = [], [], [np.zeros(1, np.int64)]
        state = np.zeros(len(rows), np.int64)  # of every row, as deep as it has come
        for d in range(depth):
            on = rows[:, d] > 0
            at, label = state[on], rows[on, d]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (label[1:] != label[:-1])
            labels.append(label[new])
            fans.append(np.bincount(at[new], minlength=len(ends[-1])).astype(np.int64))
            rows, counts, state = rows[on], counts[on], np.cumsum(new) - 1
            last = rows[:, d + 1] == 0 if d + 1 < depth else np.ones(len(rows), bool)
            end = np.zeros(int(new.sum()), np.int64)
            np.add.at(end, state[last], counts[last])
            ends.append(end)
        out = CountTransducer(words, labels, [np.arange(len(x)) for x in labels], [*fans, np.zeros(len(ends[-1]), np.int64)], ends)
        for d in (depth, depth - 1) if share else ():
            out._share(d)
        return out

    def _share(self, d: int) -> None:
        """Make one state of those at depth ``d`` that have the same end and at most one, equal arc."""
        fan, end = self.fans[d], self.ends[d]
        if not len(fan):
            return
        first = np.cumsum(fan) - fan
        tail = np.flatnonzero(fan <= 1)
        what = np.zeros((len(tail), 3), np.int64)
        what[:, 0] = end[tail]
        one = fan[tail] == 1
        if d < len(self.labels):
            what[one, 1], what[one, 2] = self.labels[d][first[tail[one]]], self.targets[d][first[tail[one]]] + 1
        order = np.lexsort(what.T[::-1])
        same = np.zeros(len(tail), bool)
        same[1:] = (what[order][1:] == what[order][:-1]).all(axis=1)
        heads = np.maximum.accumulate(np.where(same, 0, np.arange(len(tail))))
        stands = np.arange(len(fan))
        stands[tail[order]] = tail[order[heads]]
        kept = stands == np.arange(len(fan))
        if kept.all():
            return
        number = np.cumsum(kept) - 1
        if d < len(self.labels):
            arcs = np.repeat(kept, fan)
            self.labels[d], self.targets[d] = self.labels[d][arcs], self.targets[d][arcs]
        self.fans[d], self.ends[d] = fan[kept], end[kept]
        self.targets[d - 1] = number[stands[self.targets[d - 1]]]

    @property
    def depth(self) -> int:
        return len(self.labels)

    def _first(self, d: int) -> np.ndarray:
        return np.cumsum(self.fans[d]) - self.fans[d]

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences as rows of labels, padded with 0, and their counts; not sorted."""
        states, path = np.zeros(1, np.int64), np.zeros((1, self.depth), np.int32)
        out = []
        for d in range(self.depth):
            sizes = self.fans[d][states]
            arcs = _ranges(self._first(d)[states], sizes)
            path = np.repeat(path, sizes, axis=0)
            path[:, d] = self.labels[d][arcs]
            states = self.targets[d][arcs]
            end = self.ends[d + 1][states]
            out.append((path[end > 0], end[end > 0]))
        return np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out])

    @staticmethod
    def union(parts: list[bytes], depth: int) -> "CountTransducer":
        """The automaton of all sequences of the dumped parts, their counts added up; one part is open at a time."""
        number: dict[bytes, int] = {}
        rows, counts = [np.empty((0, depth), np.int32)], [np.empty(0, np.int64)]
        for part in parts:
            own = CountTransducer.load(part)
            named = np.zeros(len(own.words) + 1, np.int32)
            named[1:] = [number.setdefault(w, len(number) + 1) for w in own.words]
            found, count = own.rows()
            rows.append(named[found])
            counts.append(count)
        words = sorted(number)
        label = np.zeros(len(words) + 1, np.int32)
        label[[number[w] for w in words]] = np.arange(1, len(words) + 1)
        return CountTransducer.build(words, *summed(label[np.concatenate(rows)], np.concatenate(counts), len(words)), share=False)

    @staticmethod
    def of(phrases: list[tuple[bytes, ...]], counts: list[int], depth: int) -> "CountTransducer":
        """From sequences of words in any order."""
        words = sorted({w for p in phrases for w in p})
        label = {w: i for i, w in enumerate(words, 1)}
        rows = np.zeros((len(phrases), depth), np.int32)
        for i, p in enumerate(phrases):
            rows[i, : len(p)] = [label[w] for w in p]
        return CountTransducer.build(words, *summed(rows, np.array(counts, np.int64), len(words)))

    def totals(self) -> list[np.ndarray]:
        """By depth: how often the sequences through a state were added."""
        out = [e.copy() for e in self.ends]
        for d in range(self.depth - 1, -1, -1):
            has = self.fans[d] > 0
            if has.any():
                out[d][has] += np.add.reduceat(out[d + 1][self.targets[d]], self._first(d)[has])
        return out

    def prefixes(self, least: int, always: Iterable[tuple[bytes, ...]] = ()) -> Iterable[tuple[tuple[bytes, ...], int]]:
        """Prefixes that occur ``least`` times, those of one word and those in ``always``, with their totals.

        A prefix that is too rare is not followed any further, except along ``always``.
        """
        totals, label = self.totals(), {w: i for i, w in enumerate(self.words, 1)}
        special = {tuple(label[w] for w in p) for p in always if all(w in label for w in p)}
        states, path = np.zeros(1, np.int64), np.zeros((1, 0), np.int32)
        for d in range(self.depth):
            sizes = self.fans[d][states]
            arcs = _ranges(self._first(d)[states], sizes)
            path = np.concatenate([np.repeat(path, sizes, axis=0), self.labels[d][arcs][:, None]], axis=1)
            states = self.targets[d][arcs]
            total = totals[d + 1][states]
            keep = (total >= least) | (d == 0)
            for p in special:
                if len(p) == d + 1:
                    keep |= (path == np.array(p)).all(axis=1)
            path, states, total = path[keep], states[keep], total[keep]
            for p, t in zip(path.tolist(), total.tolist()):
                yield tuple(self.words[i - 1] for i in p), t

    def compose(self, wanted: "CountTransducer") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Walk both automata together: the sequences both hold, as rows of ``wanted``'s labels, with the counts of either."""
        label = {w: i for i, w in enumerate(self.words, 1)}
        here = np.zeros(len(wanted.words) + 1, np.int64)
        here[1:] = [label.get(w, -1) for w in wanted.words]
        a, b, path, out = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, wanted.depth), np.int32), []
        for d in range(wanted.depth):
            if d >= self.depth:
                break
            sizes = wanted.fans[d][b]
            arcs = _ranges(wanted._first(d)[b], sizes)
            a, path = np.repeat(a, sizes), np.repeat(path, sizes, axis=0)
            path[:, d] = wanted.labels[d][arcs]
            # an arc is found by its state and label, which are sorted
            span = len(self.words) + 1
            keys = np.repeat(np.arange(len(self.fans[d])), self.fans[d]) * span + self.labels[d]
            look = a * span + here[wanted.labels[d][arcs]]
            at = np.searchsorted(keys, look)
            found = (at < len(keys)) & (here[wanted.labels[d][arcs]] > 0)
            found[found] = keys[at[found]] == look[found]
            a, b, path = self.targets[d][at[found]], wanted.targets[d][arcs[found]], path[found]
            counts, asked = self.ends[d + 1][a], wanted.ends[d + 1][b]
            both = (counts > 0) & (asked > 0)
            out.append((path[both], counts[both], asked[both]))
        if not out:
            return path[:0], np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate([o[i] for o in out]) for i in range(3))

    def dump(self) -> bytes:
        """The words and arrays, compressed; every array is stored in the narrowest numbers that hold it."""
        arrays = [(1, b"".join(self.words))]
        for x in (np.array([len(w) for w in self.words], np.int64), *self.labels, *self.targets, *self.fans, *self.ends):
            size = next(s for s in (1, 2, 4, 8) if not len(x) or s == 8 or x.max() < 1 << 8 * s)
            arrays.append((size, x.astype(f"<u{size}").tobytes()))
        head = np.array([[size, len(x)] for size, x in arrays], "<u8")
        return zstandard.compress(np.uint64(len(arrays)).tobytes() + head.tobytes() + b"".join(x for _, x in arrays), 3)

    @staticmethod
    def load(data: bytes) -> "CountTransducer":
        data = zstandard.decompress(data)
        n = int(np.frombuffer(data, "<u8", 1)[0])
        head = np.frombuffer(data, "<u8", 2 * n, 8).reshape(n, 2).tolist()
        at, read = 8 + 16 * n, []
        for size, length in head:
            read.append(np.frombuffer(data, f"<u{size}", length // size, at))
            at += length
        text, cuts = read[0].tobytes(), [0, *np.cumsum(read[1], dtype=np.int64).tolist()]
        arrays = [x.astype(np.int64) for x in read[2:]]
        depth = (len(arrays) - 2) // 4
        groups = np.cumsum([depth, depth, depth + 1])
        return CountTransducer([text[a:b] for a, b in zip(cuts, cuts[1:])], *(
            arrays[a:b] for a, b in zip([0, *groups], [*groups, len(arrays)])))
