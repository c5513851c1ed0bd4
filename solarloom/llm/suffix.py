"""Sparse suffix arrays of a batch's text, as immutable files, merged logarithmically.

A record is ``WORDS`` words of 64 bits and a value; the text of a batch is the
concatenation of its records.  A match must cover a whole record, so only
suffixes at which a record begins can start one: the array holds these in
sorted order (a sparse suffix array), each with its first words and the
record's value as one byte string that sorts like them, and the earliest run
that has it.  Records that differ only in their run are one entry.

Searching is one binary search for each end of a range; over a mapped file it
reads the pages that it probes, some log(n) for a record, and not the array.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyarrow import fs

from ..sinks.shared import located

WORDS = 3
WIDTH = 8 * (WORDS + 1)
#: Entries that a merge holds at a time.
STEP = 500_000


def sortable(value: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers of the same order."""
    bits = (np.asarray(value, np.float64) + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def suffix_keys(words: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Byte strings that compare like (words, value)."""
    out = np.empty((len(words), WORDS + 1), ">u8")
    out[:, :WORDS] = words.astype(np.int64).view(np.uint64).reshape(-1, WORDS)
    out[:, WORDS] = sortable(value)
    return out.reshape(-1).view(f"S{WIDTH}")


class RangeMin:
    """Minimum over ranges of a fixed array (sparse table)."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def query(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of values[lo:hi] of ranges that are not empty."""
        n = hi - lo
        level = np.log2(n).astype(np.int64)
        out = np.empty(len(lo), self.levels[0].dtype)
        for k in np.unique(level):
            w = np.flatnonzero(level == k)
            out[w] = np.minimum(self.levels[k][lo[w]], self.levels[k][hi[w] - (1 << k)])
        return out


class SuffixArray:
    """Immutable; ``keys`` sorted and distinct, ``order`` of each the number of
    its earliest run in ``runs``, which are sorted byte strings."""

    def __init__(self, keys: np.ndarray, order: np.ndarray, runs: np.ndarray):
        self.keys, self.order, self.runs = keys, order, runs

    def __len__(self) -> int:
        return len(self.keys)

    @staticmethod
    def of(keys: np.ndarray, run: np.ndarray) -> SuffixArray:
        """From the keys of records and their runs (byte strings)."""
        runs, order = np.unique(run, return_inverse=True)
        return SuffixArray(*_sorted(keys, order.astype(np.int32)), runs)

    def covered(self, keys: np.ndarray) -> np.ndarray:
        """Share of each record's words that its longest match covers."""
        if not len(self):
            return np.zeros(len(keys))
        words = lambda k: np.ascontiguousarray(k).view(">u8").reshape(-1, WORDS + 1)[:, :WORDS]
        own, at = words(keys), np.searchsorted(self.keys, keys)
        best = np.zeros(len(keys), np.int64)
        for near in (at - 1, at):  # the longest match is with a neighbour in the array
            same = own == words(self.keys[np.clip(near, 0, len(self) - 1)])
            best = np.maximum(best, np.where((near >= 0) & (near < len(self)), np.cumprod(same, axis=1).sum(axis=1), 0))
        return best / WORDS

    def earliest(self, words: np.ndarray, value: np.ndarray, tolerance: float) -> np.ndarray:
        """Earliest run of a record with all these words and a value within
        ``tolerance`` (share of the larger); b"" where there is none."""
        out = np.zeros(len(words), self.runs.dtype if self.runs.dtype.itemsize else "S1")
        if not len(self) or not len(words):
            return out
        wide = 1.0 - tolerance * (1 + 1e-9)
        a, b = np.where(value >= 0, value * wide, value / wide), np.where(value >= 0, value / wide, value * wide)
        lo, hi = np.searchsorted(self.keys, suffix_keys(words, a), "left"), np.searchsorted(self.keys, suffix_keys(words, b), "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return out
        lo, hi = lo[hit], hi[hit]
        if (hi - lo).sum() <= 64 * len(hit):  # short ranges: only their own entries are read
            ends = np.cumsum(hi - lo)
            at = np.arange(ends[-1]) - np.repeat(ends - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
            first = np.minimum.reduceat(self.order[at], np.r_[0, ends[:-1]])
        else:
            a, z = int(lo.min()), int(hi.max())
            first = RangeMin(np.asarray(self.order[a:z])).query(lo - a, hi - a)
        out[hit] = self.runs[first]
        return out

    def write(self, path: str) -> None:
        _write(path, [(self.keys, self.order)], self.runs)


def _sorted(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(order, kind="stable")
    by = by[np.argsort(keys[by], kind="stable")]
    keys, order = keys[by], order[by]
    first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    return keys[first], order[first]


def merged(parts: list[SuffixArray], step: int = STEP) -> tuple[Iterator[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Chunks of the merged array, and its runs.  A chunk holds the entries
    between two split keys, some ``step`` of each part."""
    widest = max([p.runs.dtype.itemsize for p in parts] + [1])
    runs = np.unique(np.concatenate([p.runs.astype(f"S{widest}") for p in parts])) if parts else np.zeros(0, "S1")
    renumber = [np.searchsorted(runs, p.runs.astype(f"S{widest}")).astype(np.int32) for p in parts]
    splits = np.unique(np.concatenate([np.asarray(p.keys[step::step]) for p in parts])) if parts else []

    def chunks():
        at = [0] * len(parts)
        for k in range(len(splits) + 1):
            to = [int(np.searchsorted(p.keys, splits[k : k + 1])[0]) if k < len(splits) else len(p) for p in parts]
            keys = [np.asarray(p.keys[a:z]) for p, a, z in zip(parts, at, to)]
            order = [r[p.order[a:z]] for p, r, a, z in zip(parts, renumber, at, to)]
            yield _sorted(np.concatenate(keys), np.concatenate(order))
            at = to

    return chunks(), runs


def write_merged(path: str, parts: list[SuffixArray]) -> None:
    chunks, runs = merged(parts)
    _write(path, chunks, runs)


def _write(path: str, chunks: Iterable[tuple[np.ndarray, np.ndarray]], runs: np.ndarray) -> None:
    """Keys, orders, runs and a footer; the file appears whole or not at all,
    and a repeated task writes the same file again."""
    at, name = located(path)
    at.create_dir(os.path.dirname(name), recursive=True)
    part, orders, n = f"{name}.{uuid.uuid4().hex}.part", [], 0
    with at.open_output_stream(part) as out:
        for keys, order in chunks:
            out.write(np.ascontiguousarray(keys).tobytes())
            orders.append(np.ascontiguousarray(order, np.int32))
            n += len(keys)
        for order in orders:
            out.write(order.tobytes())
        out.write(np.ascontiguousarray(runs).tobytes())
        footer = json.dumps({"n": n, "runs": len(runs), "width": runs.dtype.itemsize}).encode()
        out.write(footer + len(footer).to_bytes(8, "big"))
    at.move(part, name)


def read(path: str) -> SuffixArray:
    """The array of a file; a local one is mapped, not read."""
    at, name = located(path)
    if isinstance(at, fs.LocalFileSystem):
        data = np.memmap(name, np.uint8, "r")
    else:
        with at.open_input_file(name) as f:
            data = np.frombuffer(f.read(), np.uint8)
    end = len(data) - 8
    size = int.from_bytes(data[end:].tobytes(), "big")
    about = json.loads(data[end - size : end].tobytes())
    n, a = about["n"], about["n"] * WIDTH
    b = a + 4 * n
    return SuffixArray(data[:a].view(f"S{WIDTH}"), data[a:b].view(np.int32), data[b : b + about["runs"] * about["width"]].view(f"S{max(1, about['width'])}"))


def files_of(folder: str, segments: set[int]) -> list[str]:
    """Files ``<segment>.<part>.sa`` of the named segments in a shard's folder."""
    at, name = located(folder)
    found = at.get_file_info(fs.FileSelector(name, allow_not_found=True))
    own = [f.base_name for f in found if f.base_name.endswith(".sa") and int(f.base_name.split(".")[0]) in segments]
    return [f"{folder}/{n}" for n in sorted(own)]
