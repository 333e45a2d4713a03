"""Runs (maximal repetitions) of the words of texts, inside Spark tasks: sorted
suffixes, their common prefixes, and the tree of LCP intervals bottom-up.

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from .kernels import _SPACE, steps
from .scan import _SEED, Words, gram_hashes, within


def repeated_grams(codes: np.ndarray, hashes: np.ndarray, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, group): every place whose ``width`` words stand in its text a
    second time, sorted by group, then position; a group is one text's places
    of the same words.  Hashes only choose whom to compare."""
    grams = gram_hashes(hashes, width)
    ok = np.flatnonzero(within(words, width))
    key = grams[ok] ^ (words.row[ok].astype(np.uint64) * _SEED)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = sorted_key[1:] == sorted_key[:-1]
    at = ok[order[same[:-1] | same[1:]]]
    columns = [words.row[at], *[codes[at + k] for k in range(width)]]
    order = np.lexsort([at, *columns[::-1]])
    at = at[order]
    new = np.zeros(len(at), bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    group = np.cumsum(new) - 1
    more = np.bincount(group, minlength=1)[group] > 1 if len(at) else np.zeros(0, bool)
    _, group = np.unique(group[more], return_inverse=True)
    return at[more], group


def sorted_suffixes(at: np.ndarray, group: np.ndarray, codes: np.ndarray, row: np.ndarray,
                    width: int) -> tuple[np.ndarray, list]:
    """The places in an order of their suffixes, and per prefix length ``width``,
    2 ``width``, 4 ``width``, ... (places, rank) of those not yet alone: equal rank
    for equal prefixes.  Prefix doubling, where words outside ``at`` (whose next
    ``width`` words are unique) are ordered by those words."""
    n = len(codes)
    first = np.searchsorted(group, group)  # a group's rank is where it starts in the order
    rank = np.arange(len(at), len(at) + n + 1)
    rank[at] = first
    order, levels, length = at.copy(), [], width
    active = np.arange(len(at))  # slots of the order whose group has more than one place
    while len(active):
        places = order[active]
        own = rank[places]
        levels.append((places, own))
        after = places + length
        # a text's end falls outside the places, or on those of another text: both differ from what is compared
        later = np.where(after < n, rank[np.minimum(after, n)], len(at) + n + 1 + places)
        next_words = []
        for k in range(width):
            x = np.minimum(after + k, n - 1)
            next_words.append(np.where((after + k < n) & (row[x] == row[places]), codes[x], -1))
        move = np.lexsort([later, *next_words[::-1], own])
        places, own, later = places[move], own[move], later[move]
        order[active] = places
        new = np.ones(len(places), bool)
        new[1:] = (own[1:] != own[:-1]) | (later[1:] != later[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(places)))
        rank[places] = np.repeat(active[starts], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
        length *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list, codes: np.ndarray, row: np.ndarray, width: int) -> np.ndarray:
    """Words that each suffix of the order shares with the one before it in
    the same text: from the longest prefixes down, then word by word."""
    n = len(codes)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    alone = -1 - np.arange(n + 1)
    for k in range(len(levels) - 1, -1, -1):
        places, rank = levels[k]
        scratch = alone.copy()
        scratch[places] = rank
        equal = scratch[np.minimum(a, n)] == scratch[np.minimum(b, n)]
        for x in (a, b, shared):
            x[equal] += width << k
    going = np.ones(len(a), bool)
    for _ in range(width - 1):
        going &= (a < n) & (b < n)
        x, y = np.minimum(a, n - 1), np.minimum(b, n - 1)
        going &= (codes[x] == codes[y]) & (row[x] == row[y]) & (row[x] == row[order[1:]])
        for z in (a, b, shared):
            z[going] += 1
    return np.concatenate([[0], shared])


def maximal_pairs(places: list[int], shared: list[int], left: dict[int, int], width: int,
                  least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal pairs that are runs, by the tree
    of LCP intervals, bottom-up.

    ``places`` are in suffix order and ``shared[i]`` is what place i shares with the
    one before.  An interval of depth d holds its places sorted, with their
    left words; when two children meet, places of the smaller are compared
    with their nearest neighbours of the larger: their suffixes share exactly
    d words, and where their left words differ the pair is maximal.  At
    distance q it is a stretch of d + q words of period q that goes no further.
    The nearest place is enough: one between the two would give the stretch a
    smaller period.
    """
    out = []

    def meet(depth: int, one: list[int], other: list[int]) -> list[int]:
        small, large = (one, other) if len(one) < len(other) else (other, one)
        reach = depth // (times - 1)
        for p in small:
            i = bisect_left(large, p)
            if i:
                o = large[i - 1]
                if p - o <= reach and left[o] != left[p] and depth + p - o >= least:
                    out.append((o, depth + p - o, p - o))
            if i < len(large):
                o = large[i]
                if o - p <= reach and left[o] != left[p] and depth + o - p >= least:
                    out.append((p, depth + o - p, o - p))
        if len(small) < 8:
            for p in small:
                insort(large, p)
            return large
        large += small
        large.sort()
        return large

    stack: list[list] = []
    child: list[int] = []
    for place, depth in zip([*places, -1], [*shared, 0]):
        if child:
            while stack and stack[-1][0] > depth:
                d, held = stack.pop()
                child = meet(d, held, child)
            if depth >= width:
                if stack and stack[-1][0] == depth:
                    stack[-1][1] = meet(depth, stack[-1][1], child)
                else:
                    stack.append([depth, child])
        child = [place]
    return out


def word_runs(words: Words, least: int, times: int) -> list[tuple[int, int, int]]:
    """Every run of the texts as (first word, length, period), sorted: stretches
    of smallest period q and length >= max(``least``, ``times`` * q)."""
    # the pair of a run of period q shares its length - q words
    width = min(max(least - q, (times - 1) * q) for q in range(1, max(least, 1) + 1))
    codes = words.codes()
    at, group = repeated_grams(codes, words.hashes(), words, width)
    if not len(at):
        return []
    near = np.full(len(at), words.n + 1)  # distance to the nearest place of the same words
    gap = np.where(group[1:] == group[:-1], at[1:] - at[:-1], words.n + 1)
    near[1:] = gap
    near[:-1] = np.minimum(near[:-1], gap)
    distance = np.zeros(words.n, np.int64)
    distance[at] = near
    order, levels = sorted_suffixes(at, group, codes, words.row, width)
    shared = common_prefixes(order, levels, codes, words.row, width)
    # a pair of distance q shares at least (times - 1) * q words; whoever has no place that near is in no pair
    most = np.maximum(shared, np.append(shared[1:], 0))
    stay = np.flatnonzero(distance[order] * (times - 1) <= most)
    if not len(stay):
        return []
    kept = np.minimum.reduceat(shared[:stay[-1] + 1], np.concatenate([[0], stay[:-1] + 1]))
    kept[0] = 0
    places = order[stay]
    before = np.where(places > words.first[words.row[places]], codes[places - 1], -1 - places)
    left = dict(zip(places.tolist(), before.tolist()))
    pairs = maximal_pairs(places.tolist(), kept.tolist(), left, width, least, times)
    best: dict[tuple[int, int], int] = {}
    for start, length, period in pairs:  # a multiple of the smallest period makes the same stretch
        best[start, length] = min(period, best.get((start, length), period))
    return sorted((s, n, q) for (s, n), q in best.items())


def run_rows(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``text``, then ``n_words``, ``runs`` (start, length,
    period; by start, then period) and ``collapsed``, the SHA-256 of the words
    that no run repeats, joined by one space."""
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in steps(batches):
        words = Words(batch.column("text"), ~_SPACE, lower=False)
        found = np.array(word_runs(words, least, times), np.int64).reshape(-1, 3)
        change = np.zeros(words.n + 1, np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        kept = np.cumsum(change)[:-1] == 0
        row = words.row[found[:, 0]]
        order = np.lexsort([found[:, 2], found[:, 0]])
        found, row = found[order], row[order]
        runs = pa.StructArray.from_arrays([pa.array(found[:, 0] - words.first[row]), pa.array(found[:, 1]),
                                           pa.array(found[:, 2])], fields=list(kind))
        upto = np.searchsorted(row, np.arange(batch.num_rows + 1))
        stream, start, end = words.stream(kept)
        upto_kept = np.searchsorted(words.row[kept], np.arange(batch.num_rows + 1))
        view = memoryview(stream)
        digests = [hashlib.sha256(view[start[a]:end[b - 1]] if b > a else b"").hexdigest()
                   for a, b in zip(upto_kept[:-1].tolist(), upto_kept[1:].tolist())]
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, words.counts(), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), runs),
             pa.array(digests, pa.string())], [*rest.schema.names, "n_words", "runs", "collapsed"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
