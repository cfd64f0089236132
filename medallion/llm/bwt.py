"""Repeated substrings of a block of strings by interval expansion on its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least (ties by place), by prefix doubling."""
    n = len(text)
    rank = text.astype(np.int64)
    step = 1
    order = np.argsort(rank, kind="stable")
    while step < depth and n > 1:
        behind = np.zeros(n, np.int64)
        behind[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2) + behind if step < n else rank
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = new
        step *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which starts (0 to len - length) begin ``length`` bytes that start anywhere else too.

    Breadth-first backward extension: the intervals of the strings of l symbols give those of
    l + 1 symbols; an interval whose right border has no common-prefix value yet gets l there and is
    extended further. Values come in increasing order and the search stops at ``length``: borders
    without a value have common prefixes of at least ``length``. An interval with one symbol in front is
    extended by its ends alone."""
    sizes = [len(s) for s in strings]
    text = np.zeros(sum(sizes) + len(sizes) + 1, np.int16)  # 0 separates; bytes are 1 to 256
    at, starts = 1, []
    for s in strings:
        starts.append(at)
        text[at : at + len(s)] = np.frombuffer(s, np.uint8).astype(np.int16) + 1
        at += len(s) + 1
    n = len(text)
    order = suffix_order(text, length)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    front = np.empty(n, np.int64)  # where a row goes when its symbol is put in front
    front[by_symbol] = np.arange(n)
    run = np.concatenate([[0], np.cumsum(bwt[1:] != bwt[:-1])])
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(length):
        if not len(low):
            break
        one = run[low] == run[high]
        new_low, new_high = [front[low[one]]], [front[high[one]]]
        if not one.all():
            a, b = low[~one], high[~one]
            width = b - a + 1
            owner = np.repeat(np.arange(len(a)), width)
            rows = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width) + a[owner]
            key = owner * 257 + bwt[rows]
            sort = np.argsort(key, kind="stable")
            key, rows = key[sort], rows[sort]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            last = np.concatenate([first[1:], [True]])
            new_low.append(front[rows[first]])
            new_high.append(front[rows[last]])
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
    long_ = ~known
    twice = np.zeros(n, bool)
    twice[order] = long_[:-1] | long_[1:]
    return [twice[s : s + max(0, size - length + 1)] for s, size in zip(starts, sizes, strict=True)]
