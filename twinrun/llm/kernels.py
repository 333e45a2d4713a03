"""Functions that run inside Spark tasks (numpy and Arrow over one batch).

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext, cloudpickle

#: bytes of text that one step of a kernel handles; a longer text is a step of its own
STEP_BYTES = 4 << 20
#: chunks that the tokenizer encodes as one row
ROW_CHUNKS = 200


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries summary of the first column of one partition: at most
    ``counters`` (value, lower bound of its count) rows.  Batches are merged
    by the summaries' merge rule: add counts, then take the count of rank
    ``counters`` + 1 off all."""
    held: dict = {}
    name = "digest"
    for batch in batches:
        counts = batch.column(0).value_counts()
        for value, n in zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()):
            held[value] = held.get(value, 0) + n
        if len(held) > counters:
            off = sorted(held.values(), reverse=True)[counters]
            held = {v: n - off for v, n in held.items() if n > off}
    values = list(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array(values, pa.binary()), pa.array([held[v] for v in values], pa.int64())], [name, "n"])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    col = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    if data is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def lean_memory() -> None:
    """Give freed Arrow buffers back to the system instead of keeping them:
    two Python workers share an executor's memory with its JVM."""
    pa.set_memory_pool(pa.system_memory_pool())


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``size`` bytes of text."""
    lean_memory()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + size, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


class Encoder:
    """Token ids of texts by the tokenizers library, each distinct chunk once.

    Byte-level BPE never merges across the start of a word, and a space after
    a visible character always starts one.  So a text may be cut before such
    spaces and its ids are those of the chunks in a row.  Distinct chunks are
    encoded once a step; a bounded table remembers earlier ones.  White space
    is taken widely: a space after any other byte is not a cut, which only
    makes chunks longer.  The file is used as it is: the string of a special
    token, which holds no space, gives that token's id.
    """

    def __init__(self, path: str, remembered: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.byte_length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a character of a token stands for a byte
            self.byte_length[i] = len(token)
        self.remembered = remembered
        self.keys = pa.array([], pa.large_string())
        self.ends = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def encode_distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each chunk, all ids).  Chunks that start with a
        space and end visibly are encoded in long rows, since their borders
        are cuts; token lengths in bytes tell whose an id is."""
        data, off = text_buffer(chunks)
        n = len(chunks)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        last = data[off[1:] - 1]
        plain = (data[off[:-1]] == 0x20) & (last > 0x20) & (last < 0x7F)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        n_plain = int(plain.sum())
        words = chunks.take(pa.array(order)).to_pylist()
        texts = ["".join(words[i:min(i + ROW_CHUNKS, n_plain)]) for i in range(0, n_plain, ROW_CHUNKS)] + words[n_plain:]
        coded = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(coded)
        ends = np.cumsum(np.diff(off)[order])
        upto = np.searchsorted(np.cumsum(self.byte_length[ids]), ends) + 1
        size = np.diff(np.concatenate([[0], upto]))
        lengths = np.zeros(n, np.int64)
        lengths[order] = size
        first = np.zeros(n, np.int64)
        first[order] = upto - size
        total = np.cumsum(lengths)
        return lengths, ids[np.repeat(first - (total - lengths), lengths) + np.arange(total[-1])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of the rows, all ids)."""
        data, off = text_buffer(texts)
        n = len(data)
        if n == 0:
            return np.zeros(len(off), np.int64), np.zeros(0, np.int32)
        before, before2 = np.empty_like(data), np.empty_like(data)
        before[0], before[1:] = 0, data[:-1]
        before2[:2], before2[2:] = 0, data[:-2]
        visible = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (before2 >= 0xC3) & (before2 < 0xE0))
        starts = np.zeros(n + 1, bool)
        starts[:n] = (data == 0x20) & visible
        starts[off] = True
        bounds = np.flatnonzero(starts)
        chunks = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1,
                                       [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        which, kinds = coded.indices.to_numpy(), coded.dictionary
        known = pc.index_in(kinds, value_set=self.keys)
        missing = known.is_null().to_numpy(zero_copy_only=False)
        new = kinds.filter(pa.array(missing))
        lengths, flat = self.encode_distinct(new)
        entry = pc.fill_null(known, 0).to_numpy().astype(np.int64)
        entry[missing] = len(self.keys) + np.arange(len(new))
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        all_ids = np.concatenate([self.ids, flat])

        used = entry[which]
        size = ends[used + 1] - ends[used]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = all_ids[np.repeat(ends[used] - upto[:-1], size) + np.arange(upto[-1])]

        if len(self.keys) + len(new) <= self.remembered:
            self.keys = pa.concat_arrays([self.keys, new])
            self.ends, self.ids = ends, all_ids
        else:  # start again with the chunks that this step had more than once
            often = np.flatnonzero(np.bincount(which, minlength=len(kinds)) > 1)[:self.remembered]
            e = entry[often]
            size = ends[e + 1] - ends[e]
            self.keys = kinds.take(pa.array(often))
            self.ends = np.concatenate([[0], np.cumsum(size)])
            self.ids = all_ids[np.repeat(ends[e] - self.ends[:-1], size) + np.arange(self.ends[-1])]
        return upto[np.searchsorted(bounds, off)], out


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process, which remembers chunks from task to task."""
    state = sys.modules.setdefault("_twinrun_worker_state", types.ModuleType("_twinrun_worker_state"))
    held = getattr(state, "encoders", None)
    if held is None or path not in held:
        state.encoders = held = {path: Encoder(path)}
    return held[path]


def with_end(off: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each row."""
    return off + np.arange(len(off)), np.insert(ids, off[1:], end_id).astype(np.int32)


def list_array(off: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))


def encode_rows(batches: Iterator[pa.RecordBatch], path: str, end_id: int,
                step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``text``, then ``part`` (this task), ``pos``
    (row in the task), ``tokens`` and ``n_tokens``."""
    encoder, part, pos = worker_encoder(path), TaskContext.get().partitionId(), 0
    for batch in steps(batches, size=step_bytes):
        off, ids = with_end(*encoder.encode(batch.column("text")), end_id)
        rest = batch.drop_columns(["text"])
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(pos, pos + n)),
             list_array(off, ids), pa.array(np.diff(off))],
            [*rest.schema.names, "part", "pos", "tokens", "n_tokens"])
        pos += n


def crc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``tokens``, then the CRC-32 of its tokens as
    little-endian unsigned 32-bit integers."""
    for batch in batches:
        tokens = batch.column("tokens")
        flat = np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False).astype("<u4"))
        off = tokens.offsets.to_numpy()
        view = memoryview(flat.view(np.uint8))
        crc = np.fromiter((zlib.crc32(view[4 * a:4 * b]) for a, b in zip(off[:-1], off[1:])), np.int64, len(off) - 1)
        rest = batch.drop_columns(["tokens"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(crc)], [*rest.schema.names, "ids_crc32"])


def piece_counts(batches: Iterator[pa.RecordBatch], path: str, end_id: int, top: int) -> Iterator[pa.RecordBatch]:
    """``encode_rows`` plus ``ranks``: per power of two up to 2**top, how many
    pieces of that length this task has had before the row."""
    had = np.zeros(top + 1, np.int64)
    for batch in encode_rows(batches, path, end_id):
        n = batch.column("n_tokens").to_numpy()
        each = (n[:, None] >> np.arange(top + 1)) & 1
        each[:, top] = n >> top
        upto = np.cumsum(each, axis=0)
        ranks = had + upto - each
        had = had + upto[-1]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, list_array(np.arange(len(n) + 1) * (top + 1), ranks.ravel())],
            [*batch.schema.names, "ranks"])


def piece_rows(batches: Iterator[pa.RecordBatch], top: int, digest: bool) -> Iterator[pa.RecordBatch]:
    """Documents (id, tokens, n_tokens, ranks, firsts) to their pieces: id,
    start, length, doc_tokens, sequence_id, offset, and the piece's tokens or,
    with ``digest``, their CRC-32 as little-endian unsigned 32-bit integers."""
    whole = 1 << top
    for batch in batches:
        tokens, ranks, firsts = (batch.column(c) for c in ("tokens", "ranks", "firsts"))
        flat = np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False).astype("<u4"))
        view, off = memoryview(flat.view(np.uint8)), tokens.offsets.to_numpy().astype(np.int64)
        rank = ranks.values.to_numpy()[ranks.offsets[0].as_py():].reshape(-1, top + 1)
        number = firsts.values.to_numpy()[firsts.offsets[0].as_py():].reshape(-1, top + 1)[:len(rank)] + rank[:batch.num_rows]
        doc, start, length, sequence, crc = [], [], [], [], []
        for i in range(batch.num_rows):
            n, at, base, numbers = int(off[i + 1] - off[i]), 0, int(off[i]), number[i].tolist()
            while at < n:
                k = min(top, (n - at).bit_length() - 1)
                size = 1 << k
                doc.append(i)
                start.append(at)
                length.append(size)
                sequence.append(numbers[k] + (at // whole if k == top else 0))
                if digest:
                    crc.append(zlib.crc32(view[4 * (base + at):4 * (base + at + size)]))
                at += size
        doc, length = pa.array(doc, pa.int64()), np.array(length, np.int64)
        last = pa.array(crc, pa.int64()) if digest else list_array(
            np.concatenate([[0], np.cumsum(length)]), flat[off[0]:off[-1]].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(doc), pa.array(start, pa.int64()), pa.array(length), batch.column("n_tokens").take(doc),
             pa.array(sequence, pa.int64()), pa.array(np.zeros(len(length), np.int64)), last],
            ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32" if digest else "tokens"])


# ---------------------------------------------------------------- shingles

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64: spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the rows, 64-bit hash of every word); words are what white
    space (ASCII) separates, A-Z lower-cased."""
    data, off = text_buffer(texts)
    if len(data) == 0:
        return np.zeros(len(off), np.int64), np.zeros(0, np.uint64)
    space = _SPACE[data]
    inside = ~space
    starts = inside.copy()
    starts[1:] &= space[:-1]
    borders = off[:-1][off[:-1] < len(data)]
    starts[borders] = inside[borders]
    letters = (_LOWER[data] if lower else data)[inside]
    place = np.cumsum(inside) - inside  # of each byte among the letters
    at = np.flatnonzero(starts)
    ends = np.append(place[at], len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    kinds = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return np.searchsorted(at, off).astype(np.int64), kinds[coded.indices.to_numpy()]


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Per row its sorted set of shingle hashes (uint64): ``width`` words in a
    row, or all words of a shorter text."""
    off, words = word_hashes(texts)
    h = np.full(max(len(words) - width + 1, 0), width, np.uint64)
    for k in range(width):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(h)])
    out = []
    for a, b in zip(off[:-1], off[1:]):
        if b - a >= width:
            out.append(np.unique(h[a:b - width + 1]))
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for w in words[a:b]:
                one = _mix(one * np.uint64(0x9E3779B97F4A7C15) + w)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sketches(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``text``, then ``n`` (set size), ``c`` (a 128-bit
    digest of the set) and ``sketch`` (its ``k`` smallest hashes)."""
    for batch in steps(batches):
        sets = shingle_sets(batch.column("text"), width)
        rest = batch.drop_columns(["text"])
        sketch = [s[:k] for s in sets]
        flat = np.concatenate(sketch).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array([len(s) for s in sets], pa.int64()),
             pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
             list_array(np.concatenate([[0], np.cumsum([len(s) for s in sketch])]), flat)],
            [*rest.schema.names, "n", "c", "sketch"])


def shingle_blobs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Each row's columns but ``text``, then ``shingles``, its set as bytes."""
    for batch in steps(batches):
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array([s.tobytes() for s in shingle_sets(batch.column("text"), width)], pa.binary())],
            [*rest.schema.names, "shingles"])


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of a partition that is sorted by it."""
    lean_memory()
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[-1].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets (each without repeats).

    Values of few sets are counted as pairs, values of many by multiplying
    incidence matrices, some columns at a time, so memory stays bounded."""
    n = len(sets)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(flat)))
    both = np.zeros(n * n, np.float64)
    few = 8
    for c in range(2, few):
        at = first[count == c]
        members = row[at[:, None] + np.arange(c)]
        for i in range(c):
            for j in range(i + 1, c):
                both += np.bincount(members[:, i] * n + members[:, j], minlength=n * n)
    both = both.reshape(n, n)
    both += both.T
    at, many = first[count >= few], count[count >= few]
    width = max(1, (4 << 20) // n)
    for lo in range(0, len(at), width):
        c = many[lo:lo + width]
        col = np.repeat(np.arange(len(c)), c)
        place = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        m = np.zeros((n, len(c)), np.float32)
        m[row[np.repeat(at[lo:lo + width], c) + place], col] = 1
        both += m @ m.T
    np.fill_diagonal(both, [len(s) for s in sets])
    return both.astype(np.int64)


def spanning_links(linked: np.ndarray, roots: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the rows as all links do, where rows of equal root
    are connected already: one breadth-first forest."""
    n = len(roots)
    _, mates = np.unique(roots, return_inverse=True)
    left, out = np.ones(n, bool), []
    for seed in range(n):
        queue = np.flatnonzero(left & (mates == mates[seed])).tolist() if left[seed] else []
        left[queue] = False
        while queue:
            p = queue.pop()
            while len(found := np.flatnonzero(linked[p] & left)):
                out.append((p, int(found[0])))
                joined = np.flatnonzero(left & (mates == mates[found[0]]))
                left[joined] = False
                queue += joined.tolist()
    return out


def region_candidates(sizes: np.ndarray, sketches: list[np.ndarray], least: int, percent: int) -> np.ndarray:
    """Which rows the sketches leave possible as links: sizes close enough
    and enough shared values."""
    need = np.minimum(least, (percent * sizes + 99) // 100)
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    return (intersections(sketches) >= np.minimum.outer(need, need)) & (100 * small >= percent * large)


def candidate_regions(batches: Iterator[pa.RecordBatch], least: int, percent: int) -> Iterator[pa.RecordBatch]:
    """For regions (``pivot``; rows ``rid``, ``n``, ``sketch``): the connected
    parts of their candidate pairs, as (``part``, ``rid``), ``part`` being a
    hash of its members, so that equal parts of several regions are one."""
    for t in groups(batches, "pivot"):
        if t.num_rows < 2:
            continue
        rid = t.column("rid").to_numpy()
        sketch = t.column("sketch").combine_chunks()
        values, off = sketch.values.to_numpy(), sketch.offsets.to_numpy()
        may = region_candidates(t.column("n").to_numpy(), [values[a:b] for a, b in zip(off[:-1], off[1:])], least, percent)
        part = np.arange(len(rid))
        for a, b in spanning_links(may, part):  # b is new to a's part
            part[b] = part[a]
        out = [np.sort(rid[part == one]) for one, n in zip(*np.unique(part, return_counts=True)) if n > 1]
        if out:
            parts = [xxhash.xxh64_intdigest(members.tobytes()) for members in out for _ in members]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(parts, np.uint64).view(np.int64)), pa.array(np.concatenate(out))], ["part", "rid"])


def shared_with(pivot: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Size of the intersection of ``pivot`` with each of the sets that are
    laid end to end in ``flat``."""
    at = np.searchsorted(pivot, flat)
    at[at == len(pivot)] = 0
    upto = np.concatenate([[0], np.cumsum(pivot[at] == flat)])
    return upto[ends[1:]] - upto[ends[:-1]]


def matrix_links(sets: list[np.ndarray], rows: np.ndarray, asks: np.ndarray, percent: int, block: int) -> Iterator[tuple[int, int]]:
    """All links of ``rows`` in which a row asks, by intersections of two
    blocks of rows at a time, so that no matrix is larger than that."""
    parts = [rows[i:i + block] for i in range(0, len(rows), block)]
    for i, one in enumerate(parts):
        for j, other in enumerate(parts[i:]):
            both = one if j == 0 else np.concatenate([one, other])
            if not asks[both].any():
                continue
            size, shared = np.array([len(sets[r]) for r in both]), intersections([sets[r] for r in both])
            linked = (100 * shared >= percent * (np.add.outer(size, size) - shared)) & np.logical_or.outer(asks[both], asks[both])
            for a, b in spanning_links(linked, np.arange(len(both))):
                yield int(both[a]), int(both[b])


def voronoi_links(sets: list[np.ndarray], roots: np.ndarray, asks: np.ndarray, percent: int,
                  pivots: int = 8, small: int = 8, block: int = 512) -> tuple[list[tuple[int, int]], Counter]:
    """(Links that connect the rows as all links in which a row asks do, where
    rows of equal root are connected already; what was done to find them).

    A cell takes pivots, each the farthest from those before it, and the exact
    distance of every row to them.  What is near enough to a pivot is linked
    to it.  Rows of one component need no links among each other, so those of
    the cell's largest one stop asking, or, where some rows asked nothing to
    begin with, those of their component, if they are of one.  The others go on
    in the Voronoi cells of the pivots, and where the triangle inequality lets
    a row that asks have a link into another cell, it visits that one too.
    A cell that this does not divide is small and takes the next pivot, or is
    settled by all its intersections."""
    reach, eps = 1 - percent / 100, 1e-9
    size = np.array([len(x) for x in sets])
    _, parent = np.unique(roots, return_inverse=True)
    parent = parent.copy()  # the component of each row
    links, done = [], Counter()

    def link(a: int, b: int) -> None:
        if parent[a] != parent[b]:
            links.append((a, b))
            parent[parent == parent[b]] = parent[a]

    def asking(rows: np.ndarray, asks: np.ndarray) -> np.ndarray:
        silent = np.unique(parent[rows[~asks[rows]]])
        if len(silent) > 1:  # rows of either may have links only with the other
            return asks
        largest = silent[0] if len(silent) else np.bincount(parent[rows]).argmax()
        return asks & (parent != largest)

    todo = [(np.arange(len(sets)), asks)]
    while todo:
        rows, asks = todo.pop()
        asks = asking(rows, asks)
        if len(rows) < 2 or not asks[rows].any():
            continue
        done["cells"] += 1
        ends = np.concatenate([[0], np.cumsum(size[rows])])
        flat = np.concatenate([sets[r] for r in rows])
        chosen, near = [], np.zeros((0, len(rows)))
        while len(chosen) < min(pivots, 1 + len(rows) // 16):
            left = asks[rows].copy()
            left[chosen] = False
            if not left.any():
                break
            may = np.flatnonzero(left)
            i = may[np.argsort(size[rows[may]], kind="stable")[len(may) // 2]] if not chosen else may[near.min(0)[may].argmax()]
            shared = shared_with(sets[rows[i]], flat, ends)
            either = size[rows] + size[rows[i]] - shared
            for j in np.flatnonzero(100 * shared >= percent * either):
                link(int(rows[i]), int(rows[j]))
            near = np.vstack([near, 1 - shared / either])
            chosen.append(int(i))
            asks = asking(rows, asks)
        done["pivots"] += len(chosen)
        rest = np.ones(len(rows), bool)
        rest[chosen] = False  # pivots are settled
        rows, near = rows[rest], near[:, rest]
        asked = asks[rows]
        if not asked.any():
            continue
        home, at = near.argmin(0), near.min(0)
        inner = at <= 2 * reach + eps
        parts = []
        for q in range(len(near) + 1):  # the last is the outer cell
            if q < len(near):
                own = inner & (home == q)
                visit = asked & ~own & (near[q] <= np.where(inner, at + 2 * reach, 3 * reach) + eps)
                d = near[q]
            else:
                own, visit, d = ~inner, asked & inner & (at > reach - eps), None
            who = asked & (own | visit)
            if not own.any() or not who.any():
                continue
            if d is not None:  # rows too far from all that ask stay behind
                own &= asked | (d >= d[who].min() - reach - eps) & (d <= d[who].max() + reach + eps)
            parts.append(np.flatnonzero(own | visit))
            done["visits"] += int(visit.sum())
        effort = sum(len(p) * int(asked[p].sum()) for p in parts)
        if 2 * effort <= len(rows) * int(asked.sum()):
            todo += [(rows[p], asks) for p in parts]
        elif len(rows) <= small:
            todo.append((rows, asks))
        else:
            done["matrices"] += 1
            for a, b in matrix_links(sets, rows, asks, percent, block):
                link(a, b)
    return links, done


def region_links(batches: Iterator[pa.RecordBatch], key: str, percent: int) -> Iterator[pa.RecordBatch]:
    """For regions (``key``; rows ``rid``, ``root``, ``asks``, ``shingles``):
    links (a, b) that connect, beside what has equal root, their rows as all
    links of rows that ask would.  Exact, by pivots and their cells."""
    for t in groups(batches, key):
        rid, asks = t.column("rid").to_numpy(), t.column("asks").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        links, _ = voronoi_links(sets, t.column("root").to_numpy(), asks, percent)
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([int(rid[a]) for a, _ in links], pa.int64()),
                                              pa.array([int(rid[b]) for _, b in links], pa.int64())], ["a", "b"])


def pivot_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, rid, shingles, pivots: array of (pivot, shingles)) to (cell,
    rid, near: array of (pivot, shared, either)): exact intersection and union."""
    kind = pa.list_(pa.struct([("pivot", pa.int64()), ("shared", pa.int64()), ("either", pa.int64())]))
    for batch in batches:
        out = []
        for own, pivots in zip(batch.column("shingles").to_pylist(), batch.column("pivots").to_pylist()):
            a = np.frombuffer(own, np.uint64)
            row = []
            for p in pivots:
                b = np.frombuffer(p["shingles"], np.uint64)
                shared = common(a, b)
                row.append({"pivot": p["pivot"], "shared": shared, "either": len(a) + len(b) - shared})
            out.append(row)
        yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("rid"), pa.array(out, kind)],
                                         ["cell", "rid", "near"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
