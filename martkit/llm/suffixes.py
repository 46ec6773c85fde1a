"""Suffix arrays by induced sorting, in whole-array steps.

Suffixes are classified as smaller or larger than their right neighbour. The
leftmost smaller ones are sorted by inducing from their first characters,
named, and the string of names is sorted in turn: by the same routine while its
alphabet is small enough for a pass over its buckets, else by doubling ranks.
From the sorted leftmost smaller suffixes all others are induced
in two linear passes, bucket by bucket; all entries of a bucket move at once.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a sequence of small non-negative integers, in order."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = _smaller(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        first = _induce(text, smaller, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = first[is_lms[first]]
        names = np.zeros(n, np.int64)
        names[order] = _names(text, lms, order)
        reduced = names[lms]
        n_names = int(reduced.max()) + 1
        if n_names < len(lms):
            below = suffix_array(reduced) if n_names <= SMALL_ALPHABET else _doubled(reduced)
            order = lms[below]
        lms = order
    return _induce(text, smaller, lms)


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it (the last is not: the empty one is smallest)."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    out = np.zeros(n, bool)
    if len(differs):
        rises = text[differs] < text[differs + 1]
        out[: differs[-1] + 1] = np.repeat(rises, np.diff(np.concatenate(([-1], differs))))
    return out


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes from the leftmost smaller ones in their order."""
    n, size = len(text), int(text.max()) + 1
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    n_larger = np.bincount(text[~smaller], minlength=size)
    out = np.zeros(n, np.int64)
    lms_counts = np.bincount(text[lms], minlength=size)
    _put(out, text, lms, (ends - lms_counts).copy())
    chars = np.flatnonzero(counts).tolist()

    # Left to right: larger suffixes go to the heads of their buckets.
    head = starts.copy()
    out_larger = out
    out_larger[head[text[-1]]] = n - 1
    head[text[-1]] += 1
    lms_part = {c: out[ends[c] - lms_counts[c] : ends[c]].copy() for c in chars if lms_counts[c]}
    for c in chars:
        done = int(starts[c])
        while done < head[c]:
            upto = int(head[c])
            _put(out, text, _before(out[done:upto], smaller, False), head)
            done = upto
        if c in lms_part:
            _put(out, text, _before(lms_part[c], smaller, False), head)

    # Right to left: smaller suffixes go to the tails.
    tail = ends.copy()
    for c in reversed(chars):
        done = int(ends[c])
        while done > tail[c]:
            down = int(tail[c])
            _put_down(out, text, _before(out[down:done][::-1], smaller, True), tail)
            done = down
        if n_larger[c]:
            _put_down(out, text, _before(out[starts[c] : starts[c] + n_larger[c]][::-1], smaller, True), tail)
    return out


def _before(block: np.ndarray, smaller: np.ndarray, kind: bool) -> np.ndarray:
    """The suffixes one to the left that have the kind."""
    left = block - 1
    left = left[left >= 0]
    return left[smaller[left] == kind]


def _grouped(text: np.ndarray, suffixes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    chars = text[suffixes]
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    counts = np.bincount(chars, minlength=size)
    nth = np.arange(len(chars)) - (np.cumsum(counts) - counts)[chars]
    return suffixes[order], chars, nth, counts


def _put(out: np.ndarray, text: np.ndarray, suffixes: np.ndarray, head: np.ndarray) -> None:
    if len(suffixes):
        suffixes, chars, nth, counts = _grouped(text, suffixes, len(head))
        out[head[chars] + nth] = suffixes
        head += counts


def _put_down(out: np.ndarray, text: np.ndarray, suffixes: np.ndarray, tail: np.ndarray) -> None:
    if len(suffixes):
        suffixes, chars, nth, counts = _grouped(text, suffixes, len(tail))
        out[tail[chars] - 1 - nth] = suffixes
        tail -= counts


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the sorted leftmost-smaller substrings: equal ones share a name."""
    length = np.zeros(len(text), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = order[:-1], order[1:]
    same = (length[a] == length[b]) & (length[a] > 0)
    live = np.flatnonzero(same)
    offset = 0
    while len(live):
        equal = text[a[live] + offset] == text[b[live] + offset]
        same[live[~equal]] = False
        live = live[equal]
        offset += 1
        live = live[length[a[live]] > offset]
    return np.concatenate(([0], np.cumsum(~same)))


def _doubled(ranks: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names by doubling the sorted length."""
    n, step = len(ranks), 1
    rank = ranks.astype(np.uint64)
    while True:
        key = rank * np.uint64(n + 1)
        key[:-step] += rank[step:] + np.uint64(1)
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1]))).astype(np.uint64)
        rank[order] = new
        if int(new[-1]) == n - 1 or step >= n:
            return order
        step = min(2 * step, n)


def common_prefixes(text: np.ndarray, array: np.ndarray, restarts: np.ndarray, cap: int) -> np.ndarray:
    """Length of each suffix's common prefix with its predecessor in the array, in text order.

    Where the characters before both suffixes agree, the length is one less than that of the suffix to the left;
    only the others, and those at ``restarts``, are compared, over at most ``cap`` characters
    (a multiple of 8). ``text`` is bytes.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    at = np.arange(n)
    own = np.ones(n, bool)
    both = np.flatnonzero((before > 0) & (at > 0))
    own[both] = text[both - 1] != text[before[both] - 1]
    own[restarts] = True
    start = np.flatnonzero(own & (before >= 0))
    # Sentinels after the end differ for any two suffixes, as their distances to the end do.
    padded = np.concatenate((text, np.zeros(cap + 8, np.uint8)))
    words = np.ndarray((n + cap,), "<u8", padded, strides=(1,))
    length = np.zeros(n, np.int64)
    live, done = start, 0
    while len(live) and done < cap:
        odd = words[live + done] ^ words[before[live] + done]
        split = odd != 0
        low = odd[split]
        length[live[split]] = done + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3)
        live = live[~split]
        done += 8
    length[live] = cap
    length[start] = np.minimum(length[start], n - np.maximum(start, before[start]))
    base = np.maximum.accumulate(np.where(own, at, 0))
    return np.maximum(length[base] - (at - base), 0)
