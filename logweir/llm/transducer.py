"""Minimal acyclic transducers: sorted words as a graph that gives each its ordinal.

States with the same words behind them are one state, so words share their beginnings
and their endings. An arc carries how many words come before those behind it; the sum of
these along a word's path is its place in the sorted list, and the way back from a place
to its word is as direct. Words are byte strings, so their order is that of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np


class Transducer(NamedTuple):
    """Arcs by ``keys`` (state * 256 + byte, ascending): ``target`` state, ``skip`` words.

    ``final`` says of each state whether a word ends there. Arrays of several transducers
    can be stacked; each then has a root of its own.
    """

    keys: np.ndarray
    target: np.ndarray
    skip: np.ndarray
    final: np.ndarray

    def ordinals(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, root: np.ndarray
    ) -> np.ndarray:
        """The place of each word ``data[start:end]`` behind its ``root``; -1: not in it.

        All words are followed together, a byte at a time.
        """
        out = np.full(len(start), -1, dtype=np.int64)
        alive = np.arange(len(start))
        state, at, end = root.astype(np.int64), start.astype(np.int64), end.astype(np.int64)
        total = np.zeros(len(start), dtype=np.int64)
        while len(alive):
            over = at == end
            if over.any():
                ends = over & self.final[state]
                out[alive[ends]] = total[ends]
                left = ~over
                alive, state, at, end, total = (x[left] for x in (alive, state, at, end, total))
            if not len(self.keys) or not len(alive):
                break
            key = (state << 8) | data[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[arc] == key
            arc = arc[known]
            alive, at, end = alive[known], at[known] + 1, end[known]
            state, total = self.target[arc].astype(np.int64), total[known] + self.skip[arc]
        return out

    def word(self, ordinal: int, root: int) -> bytes:
        """The word of a place behind ``root``."""
        out = bytearray()
        state = root
        while ordinal or not self.final[state]:
            low, high = np.searchsorted(self.keys, (state << 8, (state + 1) << 8))
            arc = low + int(np.searchsorted(self.skip[low:high], ordinal, side="right")) - 1
            out.append(int(self.keys[arc]) & 255)
            ordinal -= int(self.skip[arc])
            state = int(self.target[arc])
        return bytes(out)


def build(words: Iterable[bytes]) -> tuple[Transducer, int]:
    """The least transducer of distinct words in ascending order, and its root.

    Only the path of the last word is open; what leaves it is closed, and closed states
    are looked up among those that exist.
    """
    ids: dict[tuple, int] = {}
    closed: list[tuple] = []
    sizes: list[int] = []
    # Of each state on the open path: whether a word ends there, its arcs' bytes and targets.
    path: list[tuple[list[bool], list[int]]] = [([False], [])]
    last = b""

    def close(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            path[-1][1].extend((last[len(path) - 1], _id(final[0], tuple(arcs))))

    def _id(final: bool, arcs: tuple[int, ...]) -> int:
        state = (final, arcs)
        found = ids.get(state)
        if found is None:
            found = ids[state] = len(closed)
            closed.append(state)
            sizes.append(final + sum(sizes[t] for t in arcs[1::2]))
        return found

    for word in words:
        same = 0
        for x, y in zip(word, last, strict=False):
            if x != y:
                break
            same += 1
        close(same)
        path.extend(([False], []) for _ in range(len(word) - same))
        path[-1][0][0] = True
        last = word
    close(0)
    root = _id(path[0][0][0], tuple(path[0][1]))
    keys, target, skip = [], [], []
    for state, (final, arcs) in enumerate(closed):
        before = int(final)
        for byte, to in zip(arcs[::2], arcs[1::2], strict=True):
            keys.append(state << 8 | byte)
            target.append(to)
            skip.append(before)
            before += sizes[to]
    return Transducer(
        np.array(keys, dtype=np.int64), np.array(target, dtype=np.int32),
        np.array(skip, dtype=np.int32), np.array([f for f, _ in closed], dtype=bool),
    ), root


def stack(parts: Sequence[Transducer]) -> tuple[Transducer, list[int]]:
    """One set of arrays of several transducers, and how far each one's states move."""
    moves = np.cumsum([0, *(len(p.final) for p in parts)]).tolist()
    none = Transducer(*(np.zeros(0, dtype=t) for t in (np.int64, np.int32, np.int32, bool)))
    both = [(p, m) for p, m in zip(parts, moves, strict=False)]
    return Transducer(
        np.concatenate([none.keys, *(p.keys + (m << 8) for p, m in both)]),
        np.concatenate([none.target, *(p.target + np.int32(m) for p, m in both)]),
        np.concatenate([none.skip, *(p.skip for p, _ in both)]),
        np.concatenate([none.final, *(p.final for p, _ in both)]),
    ), moves[:-1]
