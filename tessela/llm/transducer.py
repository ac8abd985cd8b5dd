"""A minimal acyclic transducer from sorted words to their places in the order.

Words go in in order; states that can't change any more are replaced by an equal one if there is one, so common ends
are shared as common beginnings are. An arc's output is the number of words that lie before those it leads to, below
the same state; the sum of a word's outputs is its ordinal.
"""

from __future__ import annotations

import numpy as np

Node = dict[int, int]


class Transducer:
    """Built of distinct byte strings in rising order; ``ordinals`` looks many words up at once."""

    def __init__(self, words: list[bytes]) -> None:
        self._arcs: list[Node] = []  # of the frozen states
        self._final: list[bool] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[Node, bool]] = [({}, False)]  # of the last word: a state for each byte, the root first
        last = b""
        for i, word in enumerate(words):
            if i and word <= last:
                raise ValueError("words have to be distinct and in order")
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._freeze(path, same, last)
            path += [({}, False) for _ in word[same:]]
            path[-1] = (path[-1][0], True)
            last = word
        self._freeze(path, 0, last)
        self.root = self._state(*path[0])
        self._flatten(len(words))

    def _freeze(self, path: list[tuple[Node, bool]], keep: int, word: bytes) -> None:
        """Replaces the states of the last word beyond ``keep`` bytes."""
        while len(path) > keep + 1:
            node, final = path.pop()
            path[-1][0][word[len(path) - 1]] = self._state(node, final)

    def _state(self, arcs: Node, final: bool) -> int:
        name = (final, *arcs.items())
        if (found := self._known.get(name)) is None:
            found = self._known[name] = len(self._arcs)
            self._arcs.append(arcs)
            self._final.append(final)
        return found

    def _flatten(self, n_words: int) -> None:
        """Arcs as arrays sorted by state and byte. A state's targets are frozen before it, so counts come in one pass."""
        count = np.zeros(len(self._arcs), dtype=np.int64)
        keys, targets, outputs = [], [], []
        for state, arcs in enumerate(self._arcs):
            before = int(self._final[state])
            for byte in sorted(arcs):
                keys.append(state << 8 | byte)
                targets.append(arcs[byte])
                outputs.append(before)
                before += int(count[arcs[byte]])
            count[state] = before
        self.keys, self.targets, self.outputs = (np.array(x, dtype=np.int64) for x in (keys, targets, outputs))
        self.final = np.array(self._final, dtype=bool)
        self.n_states, self.n_words = len(self._arcs), n_words
        del self._arcs, self._final, self._known

    def ordinals(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The places of the words data[start:end], -1 for those that it doesn't have. All words go on by a byte in each step."""
        state, out = np.full(len(start), self.root, dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        live = np.flatnonzero(end > start) if len(self.keys) else np.zeros(0, np.int64)
        state[end > start] = self.root if len(self.keys) else -1
        step = 0
        while len(live):
            key = state[live] << 8 | data[start[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            state[live[~found]] = -1
            live, at = live[found], at[found]
            out[live] += self.outputs[at]
            state[live] = self.targets[at]
            step += 1
            live = live[end[live] > start[live] + step]
        good = state >= 0
        good[good] = self.final[state[good]]
        return np.where(good, out, -1)
