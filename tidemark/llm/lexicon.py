"""Minimal acyclic transducer over byte strings, in flat arrays.

Built from sorted words with shared prefixes and suffixes (equal subautomata are one
state). An edge carries how many words precede those behind it, so the sum along a
word's path is its rank among the sorted words: the transducer's output, and the index
of the word's id sequence. The automaton is one block of 32-bit integers that
readers map into memory, and walks are numpy steps over many words at once.

Layout: counts of edges, states, words and ids; then per edge ``state << 8 | byte``
(ascending), target state, words skipped; per state 1 if a word ends there; per word
the end of its ids; the ids.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

MAX_STATES = 1 << 23  # so that state << 8 | byte fits 32 bits


def compile_words(entries: dict[bytes, Iterable[int]]) -> bytes:
    """The transducer of ``word -> id sequence`` as one block of bytes."""
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    # path[i]: the state after i bytes of the word before, still open to new edges
    path: list[list] = [[False, []]]

    def close(depth: int) -> None:
        """Turn the open states below ``depth`` into registered ones, deepest first."""
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = (final, tuple(edges))
            state = register.get(key)
            if state is None:
                state = register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for byte in word[common:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))
    if len(states) >= MAX_STATES:
        raise ValueError("too many words for one transducer")

    behind: list[int] = []  # words that end in or below a state; targets come first
    keys, targets, skips = [], [], []
    for state, (final, edges) in enumerate(states):
        n = int(final)
        for byte, target in edges:
            keys.append(state << 8 | byte)
            targets.append(target)
            skips.append(n)
            n += behind[target]
        behind.append(n)
    ids = [list(entries[w]) for w in words]
    head = [len(keys), root + 1, len(words), sum(map(len, ids))]
    ends = np.cumsum([len(x) for x in ids])
    parts = [head, keys, targets, skips, [int(f) for f, _ in states], ends, [i for x in ids for i in x]]
    return np.concatenate([np.asarray(p, dtype="<i4") for p in parts]).tobytes()


class Lexicon:
    """A compiled transducer; ``open`` maps its file into memory."""

    def __init__(self, block: np.ndarray):
        edges, states, words, ids = (int(x) for x in block[:4])
        cuts = np.cumsum([4, edges, edges, edges, states, words, ids])
        _, self._keys, self._targets, self._skips, self._final, self._ends, self._ids = np.split(block[: cuts[-1]], cuts[:-1])
        self._root = states - 1
        self.words = words
        self.states = states

    @classmethod
    def open(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, dtype="<i4", mode="r"))

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word among the lexicon's, -1 for words it does not hold."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self._keys):
            return out
        sizes = np.fromiter(map(len, words), np.int64, n)
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        live = np.flatnonzero(sizes > 0)  # words still on a path
        state, rank = np.full(len(live), self._root, np.int64), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            key = (state << 8) | data[starts[live] + step]
            edge = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            ok = self._keys[edge] == key
            live, edge = live[ok], edge[ok]
            state, rank = self._targets[edge].astype(np.int64), rank[ok] + self._skips[edge]
            step += 1
            ended = sizes[live] == step
            hit = ended & (self._final[state] == 1)
            out[live[hit]] = rank[hit]
            live, state, rank = live[~ended], state[~ended], rank[~ended]
        return out

    def packed_ids(self, rank: int) -> bytes:
        """The ids of a word as little-endian unsigned 32-bit integers."""
        begin = int(self._ends[rank - 1]) if rank else 0
        return self._ids[begin : int(self._ends[rank])].tobytes()
