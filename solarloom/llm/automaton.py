"""Minimal acyclic transducer: words to id lists, with shared suffixes.

Words are inserted in sorted order and states are merged as soon as their right
language is known, so the automaton is minimal.  Outputs come from numbering:
each transition carries how many words sort before those that take it, the sums
along a path give the word's number, and the number gives its ids.  All of it
is a few flat arrays in one file, which workers memory-map; many words are
looked up together, one ``searchsorted`` a byte.
"""

from __future__ import annotations

import io

import numpy as np


def build(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the minimal automaton of distinct, non-empty ``words``."""
    pairs = sorted(zip(words, ids))
    registry: dict[tuple, int] = {}
    final: list[bool] = []
    arcs: list[tuple] = []
    count: list[int] = []

    def freeze(node: list) -> int:
        """Number of the state equal to [is_final, {label: state}]."""
        key = (node[0], tuple(node[1].items()))
        state = registry.get(key)
        if state is None:
            state = registry[key] = len(final)
            final.append(node[0])
            arcs.append(key[1])
            count.append(node[0] + sum(count[t] for _, t in key[1]))
        return state

    path: list[list] = [[False, {}]]  # the states of the last word, not yet frozen
    last = b""
    for word, _ in pairs:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for depth in range(len(last), common, -1):
            path[depth - 1][1][last[depth - 1]] = freeze(path[depth])
        del path[common + 1 :]
        path += [[False, {}] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1][last[depth - 1]] = freeze(path[depth])
    root = freeze(path[0])
    keys, targets, before = [], [], []
    for state, out in enumerate(arcs):
        n = int(final[state])
        for label, target in out:  # labels were added in sorted order
            keys.append(state * 256 + label)
            targets.append(target)
            before.append(n)
            n += count[target]
    lengths = [len(x) for _, x in pairs]
    return {
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int64),
        "before": np.array(before, np.int64),
        "final": np.array(final, np.int64),
        "root": np.array([root], np.int64),
        "offsets": np.r_[0, np.cumsum(lengths)].astype(np.int64),
        "ids": np.array([i for _, x in pairs for i in x], np.int64),
    }


NAMES = ("keys", "targets", "before", "final", "root", "offsets", "ids")


def dumps(arrays: dict[str, np.ndarray]) -> bytes:
    """One file: the lengths of the arrays, then the arrays, all int64."""
    out = io.BytesIO()
    out.write(np.array([len(arrays[n]) for n in NAMES], np.int64).tobytes())
    for n in NAMES:
        out.write(np.ascontiguousarray(arrays[n], np.int64).tobytes())
    return out.getvalue()


class Lexicon:
    """A compiled automaton over a memory map (path) or bytes."""

    def __init__(self, where: str | bytes):
        flat = np.memmap(where, np.int64, "r") if isinstance(where, str) else np.frombuffer(where, np.int64)
        at = len(NAMES)
        for name, n in zip(NAMES, flat[:at].tolist()):
            setattr(self, name, flat[at : at + n])
            at += n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words; -1 for words outside the lexicon."""
        out = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return out
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):  # words of like length together, so that a very long one costs nothing to the rest
            longest = max(8, 2 * len(words[order[at]]))
            end = at
            while end < len(order) and len(words[order[end]]) <= longest:
                end += 1
            rows = order[at:end]
            out[rows] = self._numbers([words[i] for i in rows])
            at = end
        return out

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        length = np.array([len(w) for w in words])
        width = max(1, int(length.max()))
        codes = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        state = np.full(len(words), int(self.root[0]), np.int64)
        number = np.zeros(len(words), np.int64)
        for k in range(width):
            live = np.flatnonzero((length > k) & (state >= 0))
            if not len(live):
                break
            key = state[live] * 256 + codes[live, k]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[i] == key
            state[live] = np.where(hit, self.targets[i], -1)
            number[live] += np.where(hit, self.before[i], 0)
        ends = (state >= 0) & (length > 0)
        ends[ends] = self.final[state[ends]] == 1
        return np.where(ends, number, -1)

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()
