"""Word scans of texts inside Spark tasks (numpy and Arrow over one batch):
fingerprints for decontamination, prefix CRCs for importance resampling.

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from .kernels import _LOWER, _mix, list_array, steps, text_buffer

#: Fixed values of the query contracts: bytes of a word are digits, letters and all beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SEED = np.uint64(0x9E3779B97F4A7C15)
#: masks for the first 0 to 8 bytes of a little-endian integer
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """The words of a batch of texts: the bytes of word i are ``letters`` from
    ``bounds[i]`` to ``bounds[i + 1]`` (nothing stands between words), ``row`` is its
    text's, and ``first`` the number of words before each row.  ``table`` says
    which bytes belong to words; A-Z are lower-cased with ``lower``."""

    def __init__(self, texts: pa.Array, table: np.ndarray = _WORD, lower: bool = True):
        data, off = text_buffer(texts)
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = table[data]
        starts = inside[:-1].copy()
        starts[1:] &= ~inside[:-2]
        borders = off[:-1][off[:-1] < len(data)]
        starts[borders] = inside[borders]  # no word goes on into the next text
        ends = inside[:-1] & ~inside[1:]
        last = borders[borders > 0] - 1
        ends[last] = inside[last]
        at = np.flatnonzero(starts)
        self.letters = data[inside[:-1]]
        if lower:
            self.letters = _LOWER[self.letters]
        self.bounds = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - at)])
        self.first = np.searchsorted(at, off).astype(np.int64)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        self.n = len(at)

    def counts(self) -> pa.Array:
        return pa.array(np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word, eight bytes at a time."""
        padded = np.append(self.letters, np.zeros(8, np.uint8))
        eights = np.ndarray(len(self.letters) + 1, "<u8", padded, strides=(1,))  # at every byte
        at, left = self.bounds[:-1], np.diff(self.bounds)
        h = _mix((eights[at] & _FIRST[np.minimum(left, 8)]) + left.astype(np.uint64) * _SEED)
        rest = np.flatnonzero(left > 8)
        done = 8
        while len(rest):
            more = left[rest] - done
            h[rest] = _mix(h[rest] * _SEED + (eights[at[rest] + done] & _FIRST[np.minimum(more, 8)]))
            rest, done = rest[more > 8], done + 8
        return h

    def codes(self) -> np.ndarray:
        """A number for every word, equal for equal words only."""
        words = pa.Array.from_buffers(pa.large_binary(), self.n, [
            None, pa.py_buffer(self.bounds), pa.py_buffer(np.ascontiguousarray(self.letters))])
        return words.dictionary_encode().indices.to_numpy()

    def stream(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (kept) words with one space before each, and where each word
        starts and ends there."""
        lengths = np.diff(self.bounds)
        letters = self.letters
        if kept is not None:
            letters, lengths = letters[np.repeat(kept, lengths)], lengths[kept]
        end = np.cumsum(lengths + 1)
        start = end - lengths
        out = np.full(len(lengths) + len(letters), 0x20, np.uint8)
        letter = np.ones(len(out), bool)
        letter[start - 1] = False
        out[letter] = letters
        return out, start, end

    def text(self, start: int, width: int) -> str:
        """``width`` words from ``start``, joined by one space."""
        b = self.bounds[start:start + width + 1]
        raw = self.letters[b[0]:b[-1]].tobytes()
        return b" ".join(raw[x - b[0]:y - b[0]] for x, y in zip(b[:-1], b[1:])).decode()


# ---------------------------------------------------------------- winnowing

def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` words in a row."""
    h = np.full(max(len(words) - width + 1, 0), width, np.uint64)
    for k in range(width):
        h *= _SEED
        h += words[k:k + len(h)]
    return _mix(h)


def within(words: Words, width: int) -> np.ndarray:
    """Which starts have ``width`` words of one row."""
    n = max(words.n - width + 1, 0)
    return words.row[:n] == words.row[width - 1:width - 1 + n]


def winnowed(words: Words, hashes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints: of every ``window`` words in a
    row the ``k``-gram of smallest hash, the last of equal ones.  The choice
    depends on those words alone, so equal windows have equal fingerprints."""
    grams = gram_hashes(hashes, k)
    whole = within(words, window)
    best, offset = grams[:len(whole)].copy(), np.zeros(len(whole), np.int64)
    for j in range(1, window - k + 1):
        other = grams[j:j + len(whole)]
        lower = other <= best
        np.copyto(best, other, where=lower)
        np.copyto(offset, j, where=lower)
    chosen = np.zeros(len(grams), bool)
    chosen[(np.arange(len(whole)) + offset)[whole]] = True
    place = np.flatnonzero(chosen)
    return place, grams[place]


def item_prints(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    """Benchmark texts (``item``, ``text``) to ``item``, ``width`` of its windows,
    ``prints`` (distinct hashes) and ``windows`` (distinct texts).  A shorter
    item is one window, and its own print."""
    for batch in steps(batches):
        words = Words(batch.column("text"))
        hashes = words.hashes()
        place, grams = winnowed(words, hashes, k, window)
        width, prints, windows = [], [], []
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            w = min(window, b - a)
            width.append(w)
            if w == window:
                held = grams[np.searchsorted(place, a):np.searchsorted(place, b)]
                prints.append(np.unique(held).view(np.int64))
                windows.append(sorted({words.text(i, w) for i in range(a, b - w + 1)}))
            else:
                prints.append(gram_hashes(hashes[a:b], w).view(np.int64) if w else [])
                windows.append([words.text(a, w)] if w else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array(width, pa.int64()), pa.array(prints, pa.list_(pa.int64())),
             pa.array(windows, pa.list_(pa.string()))], ["item", "width", "prints", "windows"])


def text_hits(batches: Iterator[pa.RecordBatch], k: int, window: int, widths: list[int], bits,
              shift: int) -> Iterator[pa.RecordBatch]:
    """Documents (``rid``, ``id``, ``text``) to ``rid``, ``id``, ``n_words`` and ``hits``:
    their fingerprints that may be the benchmark's by the bitmap ``bits``,
    each extended to the windows that hold it (start, width, text)."""
    kind = pa.struct([("print", pa.int64()), ("start", pa.int64()), ("width", pa.int64()), ("window", pa.string())])
    table = np.frombuffer(bits.value, np.uint64)

    def known(h: np.ndarray) -> np.ndarray:
        bit = h >> np.uint64(shift)
        return (table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    for batch in steps(batches):
        words = Words(batch.column("text"))
        hashes = words.hashes()
        found = []  # (print, start, width)
        if window in widths:
            place, grams = winnowed(words, hashes, k, window)
            may = known(grams)
            place, grams = place[may], grams[may]
            whole = within(words, window)
            for back in range(window - k + 1):  # the windows that hold a fingerprint
                start = place - back
                ok = start >= 0
                ok[ok] = start[ok] < len(whole)
                ok[ok] = whole[start[ok]]
                found.append((grams[ok], start[ok], window))
        for w in widths:
            if w < window:  # short items are windows of their own width
                grams = gram_hashes(hashes, w)
                start = np.flatnonzero(within(words, w) & known(grams))
                found.append((grams[start], start, w))
        prints = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
        start = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        width = np.repeat([f[2] for f in found], [len(f[0]) for f in found]).astype(np.int64)
        order = np.argsort(start, kind="stable")
        prints, start, width = prints[order], start[order], width[order]
        row = words.row[start]
        hits = pa.StructArray.from_arrays(
            [pa.array(prints.view(np.int64)), pa.array(start - words.first[row]), pa.array(width),
             pa.array([words.text(s, w) for s, w in zip(start.tolist(), width.tolist())], pa.string())],
            fields=list(kind))
        upto = np.searchsorted(row, np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("id"), words.counts(),
             pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), hits)], ["rid", "id", "n_words", "hits"])


# ------------------------------------------------------------- prefix CRCs

def crc_step_table() -> np.ndarray:
    """CRC-32 of the 256 single bytes (reflected polynomial), by its rule."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_STEP = crc_step_table()


def apply_shift(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map over GF(2), held as a table for each byte of its argument."""
    return (operator[0][crc & 255] ^ operator[1][(crc >> np.uint32(8)) & 255]
            ^ operator[2][(crc >> np.uint32(16)) & 255] ^ operator[3][crc >> np.uint32(24)])


def shift_operators(n: int) -> list[np.ndarray]:
    """The maps that carry a CRC over 1, 2, 4, ... zero bytes; each is the last
    one applied twice."""
    basis = np.arange(256, dtype=np.uint32)
    one = np.stack([(v >> np.uint32(8)) ^ _STEP[v & 255] for v in (basis << np.uint32(8 * b) for b in range(4))])
    out = [one]
    while len(out) < n:
        out.append(np.stack([apply_shift(out[-1], row) for row in out[-1]]))
    return out


_SHIFTS = shift_operators(31)


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC carried over as many zero bytes as ``lengths`` says."""
    crc = crc.copy()
    for k in range(int(lengths.max()).bit_length() if len(lengths) else 0):
        on = (lengths >> k) & 1 == 1
        crc[on] = apply_shift(_SHIFTS[k], crc[on])
    return crc


class PrefixCrcs:
    """Running CRC-32 of the batch's normalised stream (every word with one
    space before it), scanned once: after each word, and before it."""

    def __init__(self, words: Words):
        stream, self.start, self.end = words.stream()
        pieces = re.findall(rb" [^ ]*", stream.tobytes())
        running = accumulate(pieces, lambda crc, piece: zlib.crc32(piece, crc), initial=0)
        after = np.fromiter(running, np.uint32, words.n + 1)
        # one more space after the word before: a step of the register, which zlib keeps inverted
        register = ~after[:-1]
        self.before = ~((register >> np.uint32(8)) ^ _STEP[(register ^ np.uint32(0x20)) & 255])
        self.after = after[1:]

    def grams(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """CRC-32 of the words ``first``..``last`` joined by one space, from two
        prefixes: what stands before is carried over their length and cancels."""
        return self.after[last] ^ shifted(self.before[first], self.end[last] - self.start[first])


def feature_buckets(batches: Iterator[pa.RecordBatch], max_n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``text``, then ``n_words`` and ``buckets``: that of
    every run of 1 to ``max_n`` words."""
    for batch in steps(batches):
        words = Words(batch.column("text"))
        crcs = PrefixCrcs(words)
        first, row = [], []
        found = []
        for n in range(1, max_n + 1):
            at = np.flatnonzero(within(words, n))
            found.append(crcs.grams(at, at + n - 1) % np.uint32(buckets))
            row.append(words.row[at])
        row = np.concatenate(row)
        order = np.argsort(row, kind="stable") if max_n > 1 else slice(None)
        first = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, words.counts(), list_array(first, np.concatenate(found)[order].astype(np.int32))],
            [*rest.schema.names, "n_words", "buckets"])


def bucket_counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """How often each bucket occurs in this task's rows."""
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])


def bucket_means(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``buckets``, then ``n_features`` and ``weight``, the
    floored mean of its features' gains (none: 0)."""
    for batch in batches:
        lists = batch.column("buckets")
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy()])])
        ends = np.cumsum(n)
        total = upto[ends] - upto[ends - n]
        rest = batch.drop_columns(["buckets"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(n), pa.array(np.floor_divide(total, np.maximum(n, 1)).astype(np.int64))],
            [*rest.schema.names, "n_features", "weight"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
