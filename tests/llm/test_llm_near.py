"""The n-gram Jaccard join, held against all pairs."""

import random
from collections import Counter
from math import comb

import numpy as np
import pytest
from brute import near_components
from llm_helpers import DOCS, REPEATED, SF, documents, got, want

from twinrun.llm import ngram_join
from twinrun.llm.components import connected_components
from twinrun.llm.kernels import region_links, shingle_blobs, voronoi_links
from twinrun.llm.ngram_join import near_dedup_rows, ngram_components
from twinrun.llm.queries import op8_ngram_join

COLS = ("doc_id", "n_shingles", "component_id")


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(op8_ngram_join(spark, SF), *COLS) == want(near_components(docs))


def test_edges(spark):
    assert got(ngram_components(documents(spark, REPEATED)), *COLS) == want(near_components(REPEATED))
    assert ngram_components(documents(spark, [])).count() == 0


def test_rows_that_stay(spark):
    docs = documents(spark, REPEATED)
    out = near_dedup_rows(docs)
    assert out.columns == docs.columns
    best = {d: c for d, n, c in near_components(DOCS) if d is not None and n}
    blank = [d for d, t in REPEATED if not (t or "").split()]  # links with nothing: every such row stays
    assert sorted(r.doc_id for r in out.filter("doc_id is not null").collect()) == sorted(
        [d for d, c in best.items() if d == c] + blank)
    assert out.filter("doc_id is null").count() == 1  # the one that is no copy of document 4


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def hot_corpus(seed):
    """A large group of near copies, a passage in many texts, texts made
    mostly of shared passages, and texts of their own."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    stock = [[word() for _ in range(40)] for _ in range(6)]
    texts = variants(rng, base, 260, 14)
    texts += [" ".join([word() for _ in range(60)] + passage + [word() for _ in range(60)]) for _ in range(150)]
    texts += [" ".join(sum(rng.sample(stock, 4), []) + [word() for _ in range(10)]) for _ in range(150)]
    for _ in range(60):
        texts += variants(rng, [word() for _ in range(rng.randint(3, 150))], rng.randint(1, 4), 6)
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("limits", [{}, {"GROUP": 8, "REGION": 12}, {"GROUP": 8, "REGION": 12, "ROUNDS": 1, "BLOCK": 10},
                                    {"GROUP": 8, "REGION": 12, "ROUNDS": 0, "BLOCK": 16}])
def test_hot_groups_take_every_way(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(ngram_join, k, v)
    docs = hot_corpus(len(limits))
    assert got(ngram_components(documents(spark, docs)), *COLS) == want(near_components(docs))


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(5, i) for i in range(1000, 1300)]
    edges = spark.createDataFrame(path + hub + [(1299, 4), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(roots[i] == 100 for i in range(101, 161))
    assert all(roots[i] == 4 for i in [5, *range(1000, 1300)])
    assert 7 not in roots
    assert connected_components(edges.limit(0)).count() == 0


def test_groups_that_a_bridge_connects_stay_linked_over_rounds(spark):
    """A first round has silenced the smaller group; in the second the larger
    one is connected too, and only one pair links the groups."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    one, other, shared = [word() for _ in range(48)], [word() for _ in range(48)], [word() for _ in range(72)]
    step = lambda k: shared + other[:k] + one[k:]
    left = variants(rng, step(0), 20, 2) + [" ".join(step(8))]
    right = variants(rng, step(28), 40, 2) + [" ".join(step(20))]
    docs = list(enumerate(left + right))
    assert {c for _, _, c in near_components(docs)} == {0}
    assert len({c for _, _, c in near_components([d for d in docs if d[1] not in (left[-1], right[-1])])}) == 2
    blobs = spark.createDataFrame(docs, "rid long, text string").mapInArrow(
        lambda b: shingle_blobs(b, 5), "rid long, shingles binary")
    n = len(left)
    cells = spark.createDataFrame(
        [(1, i, 0 if i < n else i, i >= n, 0.0 if i in (n - 1, len(docs) - 1) else 1.0) for i, _ in docs],
        "cell long, rid long, root long, asks boolean, score double")
    links = spark.createDataFrame([(i, 0) for i in range(1, n)], "a long, b long")
    for turn in (1, 2):
        links, cells = ngram_join.voronoi_round(cells, blobs, links, 75, turn)
    rest = ngram_join.in_groups(cells.join(blobs, "rid").select("cell", "rid", "root", "asks", "shingles"), "cell").mapInArrow(
        lambda b: region_links(b, "cell", 75), "a long, b long")
    roots = {r.node: r.root for r in connected_components(links.unionByName(rest)).collect()}
    assert {roots.get(i, i) for i, _ in docs} == {0}


def test_shared_values_follow_the_percent():
    assert ngram_join.least_shared(75) == 40
    for percent in (30, 50, 60, 75, 90):
        share, least = percent / 100, ngram_join.least_shared(percent)
        fewer = sum(comb(96, i) * share**i * (1 - share)**(96 - i) for i in range(least))
        assert fewer <= 1e-12 or least == 1


def parts_of(n, links):
    parts = list(range(n))
    for a, b in links:
        parts = [parts[a] if p == parts[b] else p for p in parts]
    return {frozenset(i for i in range(n) if parts[i] == p) for p in parts}


@pytest.mark.parametrize("percent", [30, 60, 75, 90])
def test_cells_in_a_task_connect_as_all_links_do(percent):
    """Also where some rows ask nothing, be they of one component or of several."""
    rng, seen = random.Random(percent), Counter()
    for turn in range(120):
        sets = []
        for _ in range(rng.randint(1, 9)):
            base = rng.sample(range(400), rng.randint(1, 60))
            for _ in range(rng.choice([1, 2, 3, 20])):
                drop = rng.randint(0, len(base) // 3)
                sets.append(np.array(sorted({*rng.sample(base, len(base) - drop), *rng.sample(range(400), drop)}), np.uint64))
        n = len(sets)
        rng.shuffle(sets)
        asks = np.array([turn % 3 == 0 or rng.random() < 0.7 for _ in range(n)])
        roots = np.arange(n)
        if turn % 3 == 1:
            roots[~asks] = -1
        plain = [set(x.tolist()) for x in sets]
        every = {(a, b) for a in range(n) for b in range(n)
                 if 100 * len(plain[a] & plain[b]) >= percent * len(plain[a] | plain[b])}
        true = [(a, b) for a, b in every if asks[a] or asks[b]]
        same = [(a, b) for a in range(n) for b in range(a) if roots[a] == roots[b]]
        found, done = voronoi_links(sets, roots, asks, percent, block=7)
        assert parts_of(n, found + same) == parts_of(n, true + same)
        assert set(found) <= every
        seen += done
    assert seen["pivots"] and seen["visits"] and seen["cells"] and seen["matrices"]


def test_pivots_decide_the_given_table(spark, monkeypatch):
    """At sf0.01 every link comes from a pivot's distances; no region is left
    to a matrix of intersections."""
    seen, plain = [], ngram_join.in_groups

    def kept(rows, key):
        if "shingles" in rows.columns:
            seen.extend(rows.select(key, "rid", "root", "asks", "shingles").collect())
        return plain(rows, key)

    monkeypatch.setattr(ngram_join, "in_groups", kept)
    out = ngram_components(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    linked = out.groupBy("component_id").count().filter("count > 1").count()
    regions, done, links = {}, Counter(), 0
    for r in seen:
        regions.setdefault(r[0], []).append(r)
    for rows in regions.values():
        found, how = voronoi_links([np.frombuffer(r.shingles, np.uint64) for r in rows], np.array([r.root for r in rows]),
                                   np.array([r.asks for r in rows]), 75)
        links, done = links + len(found), done + how
    assert linked and links
    assert done["pivots"] >= done["cells"] >= len(regions) and not done["matrices"]
