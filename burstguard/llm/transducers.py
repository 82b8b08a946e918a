"""Minimal acyclic transducers: sorted byte strings to their lexicographic ordinals.

Built from sorted terms one after the other: the path of the last term is kept open, and what the next term leaves behind
is folded into the register of states that are known already. The output of a transition is the number of terms that the
state accepts before it, so that the outputs along a term add up to its ordinal. Walking is done for many words at once
with whole arrays: all words step by one byte, those without a transition fall out.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


def build(terms: Iterable[bytes]) -> bytes:
    """The transducer of ascending, different, non-empty terms, as bytes."""
    register: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # open states: final, transitions (byte, target)
    previous = b""

    def fold(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            state = register.setdefault((final, tuple(edges)), len(register))
            last = path[-1][1]
            last[-1] = (last[-1][0], state)

    for term in terms:
        if term <= previous:
            raise ValueError("terms must ascend")
        shared = next((i for i, (a, b) in enumerate(zip(term, previous)) if a != b), min(len(term), len(previous)))
        fold(shared)
        for byte in term[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        previous = term
    fold(0)
    states = [*register, (path[0][0], tuple(path[0][1]))]  # targets come before their sources, the root is last
    accepted = np.zeros(len(states), np.int64)
    finals = np.array([final for final, _ in states], np.int8)
    keys, targets, outputs = [], [], []
    for state, (final, edges) in enumerate(states):
        before = int(final)
        for byte, target in edges:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(before)
            before += int(accepted[target])
        accepted[state] = before
    sizes = np.array([len(states), len(keys)], np.int64)
    edges = np.array([keys, outputs], np.int64).reshape(2, len(keys))
    return sizes.tobytes() + edges.tobytes() + np.array(targets, np.int32).tobytes() + finals.tobytes()


@dataclass
class Transducer:
    """What ``build`` has made, ready to walk."""

    root: int
    keys: np.ndarray
    outputs: np.ndarray
    targets: np.ndarray
    finals: np.ndarray

    @classmethod
    def load(cls, packed: bytes) -> Transducer:
        n_states, n_edges = (int(x) for x in np.frombuffer(packed, np.int64, 2))
        keys, outputs = np.frombuffer(packed, np.int64, 2 * n_edges, 16).reshape(2, n_edges)
        at = 16 + 16 * n_edges
        targets = np.frombuffer(packed, np.int32, n_edges, at)
        return cls(n_states - 1, keys, outputs, targets, np.frombuffer(packed, np.int8, n_states, at + 4 * n_edges))

    def walk(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each word ``text[start:end]``, -1 where it is no term."""
        ordinals = np.full(len(starts), -1, np.int64)
        if not len(self.keys):
            return ordinals
        words = np.arange(len(starts))
        state = np.full(len(starts), self.root, np.int64)
        gathered = np.zeros(len(starts), np.int64)
        at, ends = starts, ends
        while len(words):
            key = (state << 8) | text[at]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = np.flatnonzero(self.keys[edge] == key)
            edge = edge[known]
            state, gathered = self.targets[edge].astype(np.int64), gathered[known] + self.outputs[edge]
            words, at, ends = words[known], at[known] + 1, ends[known]
            over = at == ends
            done = over & (self.finals[state] == 1)
            ordinals[words[done]] = gathered[done]
            words, at, ends, state, gathered = (x[~over] for x in (words, at, ends, state, gathered))
        return ordinals

    def term(self, ordinal: int) -> bytes:
        """The term with this ordinal."""
        out, state = bytearray(), self.root
        while True:
            if self.finals[state] and ordinal == 0:
                return bytes(out)
            low, high = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = low + int(np.searchsorted(self.outputs[low:high], ordinal, "right")) - 1
            ordinal -= int(self.outputs[edge])
            out.append(int(self.keys[edge]) & 255)
            state = int(self.targets[edge])
