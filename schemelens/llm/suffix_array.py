"""Suffix arrays by induced sorting, and common prefixes in text order."""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t``: numbers below ``k`` that end with the only 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    # 1. a suffix is smaller (S) if its first unequal step goes up; leftmost S after a larger one are the samples
    step = np.sign(np.diff(t.astype(np.int64)))
    at = np.arange(n - 1)
    unequal = np.where(step != 0, at, n)
    nxt = np.minimum.accumulate(unequal[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = step[np.minimum(nxt, n - 2)] > 0
    small[n - 2] = False
    leftmost = small.copy()
    leftmost[0] = False
    leftmost[1:] &= ~small[:-1]
    samples = np.flatnonzero(leftmost)
    induce = _induce_blocks if k * 16 < n else _induce_steps
    # 2. sort the samples' substrings by inducing from their first characters
    order = induce(t, k, small, samples)
    ordered = order[leftmost[order]]
    names, count = _name(t, samples, ordered)
    # 3. order the samples by recursion on their names, unless those tell them apart
    reduced = names[samples]
    if count < len(samples):
        by_rank = samples[suffix_array(reduced, count)]
    else:
        by_rank = ordered
    # 4. induce all suffixes from the ordered samples
    return induce(t, k, small, by_rank)


def _name(t: np.ndarray, samples: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each sample's substring (up to and with the next sample), equal substrings alike."""
    end = np.zeros(len(t), np.int64)
    end[samples[:-1]] = samples[1:]
    end[samples[-1]] = samples[-1]
    a, b = ordered[:-1], ordered[1:]
    la, lb = end[a] - a, end[b] - b
    same = la == lb
    for off in range(int(la.max(initial=0)) + 1):
        live = np.flatnonzero(same & (la >= off))
        if not len(live):
            break
        same[live] = t[a[live] + off] == t[b[live] + off]
    same &= la > 0  # the end alone is like no other
    rank = np.concatenate(([0], np.cumsum(~same)))
    names = np.zeros(len(t), np.int64)
    names[ordered] = rank
    return names, int(rank[-1]) + 1


def _induce_blocks(t: np.ndarray, k: int, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Induced order from ``seeds`` (in their order), whole buckets at a time; for few, full buckets."""
    n = len(t)
    sizes = np.bincount(t, minlength=k)
    heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    tails = heads + sizes
    larger = np.bincount(t[~small], minlength=k)  # larger ones fill the front of a bucket
    used = np.flatnonzero(sizes)
    sa = np.full(n, -1, np.int64)

    by_first = seeds[np.argsort(t[seeds], kind="stable")]
    seed_ends = np.cumsum(np.bincount(t[seeds], minlength=k))
    seed_starts = seed_ends - np.bincount(t[seeds], minlength=k)

    def put(preds, front):
        # positions in their order go to the next free places of their buckets
        keys = t[preds]
        order = np.argsort(keys, kind="stable")
        keys, preds = keys[order], preds[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        runs = np.diff(np.append(first, len(keys)))
        place = np.arange(len(keys)) - np.repeat(first, runs)
        buckets = keys[first]
        if front is not None:
            sa[front[keys] + place] = preds
            front[buckets] += runs
        else:
            sa[back[keys] - 1 - place] = preds
            back[buckets] -= runs

    front = heads.copy()
    for c in used:
        lo = heads[c]
        while lo < front[c]:  # larger ones of this bucket, among them those it induces itself
            hi = front[c]
            preds = sa[lo:hi] - 1
            preds = preds[preds >= 0]
            preds = preds[~small[preds]]
            if len(preds):
                put(preds, front)
            lo = hi
        preds = by_first[seed_starts[c]:seed_ends[c]] - 1
        preds = preds[preds >= 0]
        preds = preds[~small[preds]]
        if len(preds):
            put(preds, front)
    back = tails.copy()
    for c in used[::-1]:
        hi = tails[c]
        while hi > back[c]:
            lo = back[c]
            preds = sa[lo:hi][::-1] - 1
            preds = preds[preds >= 0]
            preds = preds[small[preds]]
            if len(preds):
                put(preds, None)
            hi = lo
        preds = sa[heads[c]:heads[c] + larger[c]][::-1] - 1
        preds = preds[preds >= 0]
        preds = preds[small[preds]]
        if len(preds):
            put(preds, None)
    sa[0] = n - 1
    return sa


def _induce_steps(t: np.ndarray, k: int, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The same order one suffix at a time; for many small buckets."""
    n = len(t)
    sizes = np.bincount(t, minlength=k)
    ends = np.cumsum(sizes)
    text, is_small = t.tolist(), small.tolist()
    sa = [-1] * n
    back = ends.tolist()
    for s in seeds[::-1].tolist():
        c = text[s]
        back[c] -= 1
        sa[back[c]] = s
    front = (ends - sizes).tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not is_small[j]:
            c = text[j]
            sa[front[c]] = j
            front[c] += 1
    back = ends.tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and is_small[j]:
            c = text[j]
            back[c] -= 1
            sa[back[c]] = j
    out = np.array(sa, np.int64)
    out[0] = n - 1
    return out


def permuted_lcp(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each place of ``t``: characters its suffix shares with the one before it in ``sa``, up to ``most``.

    Eight characters (below 2**8 each) are compared at a time.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate((t.astype(np.uint64), np.zeros(most + 8, np.uint64)))
    words = np.zeros(n + most, np.uint64)
    for i in range(8):
        words |= padded[i:i + n + most] << np.uint64(8 * i)
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0)
    for off in range(0, most, 8):
        x = words[live + off] ^ words[before[live] + off]
        differ = x != 0
        stop = x[differ]
        low = stop & (~stop + np.uint64(1))
        shared[live[differ]] = off + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        live = live[~differ]
    shared[live] = most
    return np.minimum(shared, most)
