"""Which long substrings of some byte strings agree, by expanding intervals of a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

END = 0  # stands after each string; bytes are 1 to 256


PACKED = 7  # codes of 9 bits in one number


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` codes at least: those packed in one number, then by doubling ranks."""
    n = len(codes)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(PACKED):
        code = np.zeros(n, np.int64)
        code[: max(n - j, 0)] = codes[j:]
        key = (key << 9) | np.where(alive, code, 0)  # what follows a string's end must not count
        alive &= code != END
    known = PACKED
    while True:
        if known >= depth:
            return np.argsort(key, kind="stable")
        order = np.argsort(key)  # the order of equal keys does not matter yet
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([False], sorted_key[1:] != sorted_key[:-1]))[:n])
        far = np.zeros(n, np.int64)
        if known < n:
            far[:-known] = rank[known:] + 1
        far[_ended(codes, known)] = 0
        key = rank * (n + 1) + far
        known *= 2


def _ended(codes: np.ndarray, width: int) -> np.ndarray:
    """Whether an end stands among the next `width` codes of each place."""
    ends = np.concatenate([[0], np.cumsum(codes == END)])
    n = len(codes)
    return ends[np.minimum(np.arange(n) + width, n)] > ends[:n]


def short_borders(bwt: np.ndarray, least: int) -> np.ndarray:
    """True at each suffix, in order, that shares fewer than `least` codes with the one before it.

    Breadth first over the intervals of strings w, from the empty one: extending w to the left by a
    code c gives the interval of cw. Where its right border has no value yet, the two suffixes there
    share |w| codes, and the interval is expanded in the next round. So common prefixes come in
    increasing length, and the search stops at `least`: borders without a value by then are longer.
    """
    n = len(bwt)
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    order = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)
    step[order] = np.arange(n)  # from a suffix to the one that is a code longer
    head = bwt[order]  # first code of each suffix
    low, high = np.array([0]), np.array([n])
    for length in range(least):
        sizes = high - low
        total = int(sizes.sum())
        if not total:
            break
        owner = np.repeat(np.arange(len(low)), sizes)
        rows = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
        if length:
            real = bwt[rows] != END  # no string goes on over another's end
            rows, owner = rows[real], owner[real]
        to = step[rows]
        sort = np.argsort(to, kind="stable")
        to, owner = to[sort], owner[sort]
        if not len(to):
            break
        starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (head[to[1:]] != head[to[:-1]])])
        low, high = to[starts], to[np.r_[starts[1:] - 1, len(to) - 1]] + 1
        new = ~border[high]
        low, high = low[new], high[new]
        border[high] = True
    return border[:n]


def window_groups(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For every string, a number for each of its windows of `least` bytes: equal numbers, equal windows."""
    codes = np.zeros(sum(map(len, strings)) + len(strings), np.int64)
    starts, at = [], 0
    for s in strings:
        codes[at : at + len(s)] = np.frombuffer(s, np.uint8).astype(np.int64) + 1
        starts.append(at)
        at += len(s) + 1
    order = suffix_order(codes, least)
    bwt = codes[order - 1]  # the text ends with an end, which stands before its first suffix
    number = np.empty(len(codes), np.int64)
    number[order] = np.cumsum(short_borders(bwt, least))
    return [number[a : a + max(0, len(s) - least + 1)] for a, s in zip(starts, strings, strict=True)]
