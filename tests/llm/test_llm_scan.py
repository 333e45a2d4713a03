"""Decontamination, periodic runs and importance resampling against plain Python."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from brute import WORD, alnum_words, collapsed, runs_of
from llm_helpers import DOCS, REPEATED, SF, documents, got, want
from pyspark.sql import functions as F

from twinrun.llm import lcp_tree, scan
from twinrun.llm.decontaminate import decontaminate
from twinrun.llm.kernels import _SPACE
from twinrun.llm.periodic_runs import find_runs, greatest_run, periodic_tail
from twinrun.llm.queries import op12_periodic_runs
from twinrun.llm.resample import resample

EDGES = [DOCS, REPEATED, [], [(None, None)] * 3, [(1, "")]]


# ------------------------------------------------------------ word scans

def test_words_of_a_batch():
    texts = ["Hello World, foo-bar é日本 x9", None, "", "ab", "cd ", "!!", "\x00z\x7fÀ"]
    words = scan.Words(pa.array(texts))
    found = [[words.text(i, 1) for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:])]
    assert found == [alnum_words(t) for t in texts]


def test_hashes_and_codes_tell_words_apart():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 30))) for _ in range(400)) for _ in range(5)]
    words = scan.Words(pa.array(texts), ~_SPACE, lower=False)
    plain = [w for t in texts for w in WORD.findall(t)]
    for numbers in (words.hashes(), words.codes()):
        pairs = set(zip(plain, numbers.tolist()))
        assert len(pairs) == len(set(plain)) == len({n for _, n in pairs})


# ---------------------------------------------------------- decontaminate

ITEMS = [
    (7, "a b c d e f g h i j k l m"), (7, "other words of the same item id"), (None, "no id here at all"), (9, None), (10, ""),
    (11, "one two three"), (12, "w7919 w15838 w23757"), (13, " ".join(f"w{i * 7919 % 104729}" for i in range(500, 530))),
    (14, "not to be found in any of them, whatever the text may be"), (15, "x"), (16, "é à ü"), (13, "c d e f g h i j k l"),
]


def items(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "item_id long, text string, rid string")


@pytest.mark.parametrize("rows", EDGES)
@pytest.mark.parametrize("k", [1, 5, 10])
def test_decontaminate_edges(spark, rows, k):
    if k != 5 and rows is not DOCS:
        pytest.skip("the other widths on one table")
    out = decontaminate(documents(spark, rows), items(spark, ITEMS), k=k)
    assert got(out, "doc_id", "n_words", "n_hit", "item_ids", "contaminated") == want(brute.decontaminate(rows, ITEMS))


def test_decontaminate_without_items(spark):
    for rows in ([], [(1, None)], [(1, " ,.")]):
        out = decontaminate(documents(spark, DOCS), items(spark, rows))
        assert got(out, "doc_id", "n_hit", "item_ids", "contaminated") == want((d, 0, [], False) for d, _ in DOCS)


def test_decontaminate_few_words(spark):
    """Texts over three words: windows, fingerprints and ties everywhere."""
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["a", "b", "B", "c"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 300))) for i in range(60)]
    tests = [(i, text(rng.randint(0, 16))) for i in range(40)]
    out = decontaminate(documents(spark, docs), items(spark, tests))
    assert got(out, "doc_id", "n_words", "n_hit", "item_ids", "contaminated") == want(brute.decontaminate(docs, tests))


def test_every_shared_window_shares_a_fingerprint():
    rng = random.Random(3)
    base = [f"v{rng.randint(0, 40)}" for _ in range(400)]
    texts = [" ".join([f"n{i}"] * rng.randint(0, 9) + base[a:a + 10] + ["end"] * rng.randint(0, 9))
             for i, a in enumerate(rng.sample(range(390), 80))]
    words = scan.Words(pa.array([" ".join(base), *texts]))
    place, grams = scan.winnowed(words, words.hashes(), 5, 10)
    row = words.row[place]
    known = set(grams[row == 0].tolist())
    assert all(known & set(grams[row == r].tolist()) for r in range(1, len(texts) + 1))
    assert len(place) < 0.5 * words.n


# ---------------------------------------------------------- periodic runs

def test_runs_equal_every_period_tried():
    rng = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 6)):
            words = [rng.choice("abcde"[:rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.5:
                a = rng.randrange(len(words))
                p = 1 + rng.randrange(max(1, (len(words) - a) // 3))
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        least, times = rng.choice([(6, 4), (6, 4), (2, 2), (5, 3), (9, 2), (3, 5)])
        batch = scan.Words(pa.array([" ".join(w) for w in texts]), ~_SPACE, lower=False)
        expected = sorted((s + int(batch.first[i]), n, q) for i, w in enumerate(texts) for s, n, q in runs_of(w, least, times))
        assert lcp_tree.word_runs(batch, least, times) == expected


def test_long_runs_take_no_square():
    one = scan.Words(pa.array(["x " * 100_000, "a b c d e f g " * 10_000]), ~_SPACE, lower=False)
    assert lcp_tree.word_runs(one, 6, 4) == [(0, 100_000, 1), (100_000, 70_000, 7)]


PERIODIC = [(100, "a b " * 3), (101, "a b " * 4), (102, "x " * 5), (103, "x " * 6), (104, "x x x x x x y y y y y y"),
            (105, "p " + "q r s " * 4 + "q r t"), (106, "a\nb a\tb a b a b"), (107, ("a b " * 5 + "c ") * 5)]


@pytest.mark.parametrize("rows", [*EDGES, PERIODIC])
def test_find_runs_edges(spark, rows):
    out = find_runs(documents(spark, rows))
    flat = out.select("doc_id", "n_words", F.transform("runs", lambda r: F.array(r["start"], r["length"], r["period"])).alias("r"),
                      "collapsed_sha256")
    expected = []
    for d, t in rows:
        words = WORD.findall(t or "")
        found = [(0, len(words), 1)] if len(set(words)) == 1 and len(words) > 100 else runs_of(words) if len(words) < 1000 else []
        expected.append((d, len(words), [list(r) for r in sorted(found, key=lambda r: (r[0], r[2]))], collapsed(words, found)))
    assert got(flat, "doc_id", "n_words", "r", "collapsed_sha256") == want(expected)


def test_greatest_run_is_exact(spark):
    runs = [(0, 12, 3), (20, 8, 2), (20, 16, 4), (40, 9, 2), (60, 18, 4)]
    df = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start: long, length: long, period: long>>")
    assert [r.t and tuple(r.t) for r in df.select(greatest_run(F.col("runs")).alias("t")).collect()] == [(40, 9, 2), None]


def test_periodic_tail_and_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    planted = {d: brute.with_tail(d, t) for d, t in rows}
    out = spark.createDataFrame(rows, "d long, t string").select("d", periodic_tail(F.col("d"), F.col("t")).alias("t"))
    assert all(WORD.findall(r.t or "") == planted[r.d] for r in out.collect())
    found = {d: runs_of(w) for d, w in planted.items() if len(w) < 400}
    expected = []
    for d, runs in found.items():
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        expected.append((d, len(runs), *top, 1000 * top[1] // top[2] if runs else None, brute.sha(lines), collapsed(planted[d], runs)))
    out = op12_periodic_runs(spark, SF).filter(F.col("doc_id").isin(list(found)))
    assert got(out, "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256") == want(expected)
    assert sum(len(r) for r in found.values()) > 5


# --------------------------------------------------------------- resample

def test_crcs_from_prefixes():
    words = scan.Words(pa.array(["Some words, é and 日本 x9 " * 7, None, "a", "", "b c" * 50]))
    crcs = scan.PrefixCrcs(words)
    for n in (1, 2, 3, 8, 20):
        at = np.flatnonzero(scan.within(words, n))
        assert crcs.grams(at, at + n - 1).tolist() == [zlib.crc32(words.text(i, n).encode()) for i in at.tolist()]


@pytest.mark.parametrize("rows", [DOCS[:10] + DOCS[11:12], [], [(1, "")], [(None, None)]])
@pytest.mark.parametrize("max_n", [1, 3])
def test_resample_edges(spark, rows, max_n):
    target = [t for _, t in ITEMS]
    out = resample(documents(spark, rows), items(spark, ITEMS), max_n=max_n, min_words=3, percent=50)
    assert got(out, "doc_id", "n_features", "weight", "score", "rank") == want(brute.resample(rows, target, max_n, least=3, percent=50))


def test_resample_repeats_and_ties(spark):
    rows = [(1, "a b c")] * 4 + [(2, "a b c")]
    out = resample(documents(spark, rows), items(spark, []), min_words=1, percent=100).collect()
    assert sorted(r["rank"] for r in out) == [1, 2, 3, 4, 5]
    assert len({(r.doc_id, r.score) for r in out}) == 2


def test_resample_equals_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = resample(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert got(out, "doc_id", "n_features", "weight", "score", "rank") == want(brute.resample(rows, target))
