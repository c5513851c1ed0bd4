"""Exact byte-pair merging with a public vocabulary of ranks."""

from __future__ import annotations

import base64
import functools
import heapq

#: Splits a text into the pieces that are merged on their own (fixed value, the
#: pattern that the vocabulary was published with).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@functools.lru_cache(maxsize=4)
def ranks(path: str = DEFAULT_PATH) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=1)
def splitter():
    import regex

    return regex.compile(PATTERN)


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the lowest-ranked adjacent pair, leftmost first, is
    merged until none is left; O(n log n), so long pieces are no problem."""
    whole = rank.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here; 0: no part starts here
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of its parts has been merged since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            r = rank.get(word[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if before[i] >= 0:
            j = before[i]
            r = rank.get(word[j:stop])
            if r is not None:
                heapq.heappush(heap, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(rank[word[i : end[i]]])
        i = end[i]
    return out
