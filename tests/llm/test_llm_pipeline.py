"""The pipeline: every stage against plain Python, and the whole."""

import pytest
from brute import WORD, base_rules, crc, exact_dedup, mix_copies, near_components, pieces
from llm_helpers import REPEATED, SF, documents, got, labels, tokenizer, want  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from twinrun.llm import quality as Q
from twinrun.llm.common import whole_row_key
from twinrun.llm.mixing import mix


def by_hand(docs):
    """docs: (id, source, text); the ids that stages 1 to 3 keep, as rows, where no rule is on."""
    docs = [r for r in docs if not base_rules(r[2])[5]]
    stay = {d for d, _, _, kept, _ in exact_dedup([(d, t) for d, _, t in docs]) if kept}
    docs = [r for r in docs if r[0] in stay]
    stay = {d for d, _, c in near_components([(d, t) for d, _, t in docs]) if d == c}
    return [r for r in docs if r[0] in stay]


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "n-gram Jaccard join", "mixing", "packing"]


def test_whole_pipeline(spark, tokenizer):  # noqa: F811
    table = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = Q.quality_rules(table, spark.read.parquet(f"{SF}/labels.parquet"))
    assert verdict.filter("kept = base_failed").count() == 0  # too few labels here for any rule
    docs = by_hand([(r.doc_id, r.source, r.text) for r in table.collect()])
    copies = mix_copies(docs)
    expected = [(d, *p) for d, _, t in docs for p in pieces(t, tokenizer) for _ in range(copies[d])]
    out = corpus_pipeline.run(spark, SF)
    assert got(out, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want(expected)
    rows = out.collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))


def test_mix_equals_a_queue_by_hand(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    copies = mix_copies([(r.doc_id, r.source, r.text) for r in rows.collect()])
    assert got(mix(rows), "doc_id", "copies") == want((r.doc_id, copies[r.doc_id]) for r in rows.collect())


@pytest.mark.parametrize("rows", [REPEATED, [], [(None, None)] * 3, [(1, None), (1, "a b"), (2, "")]])
def test_stages_on_edge_tables(spark, tmp_path, rows):
    docs = documents(spark, rows)
    labels(spark, [(1, 1, 0), (None, None, None), (1, 0, 1)]).write.parquet(str(tmp_path / "labels.parquet"))
    stages = [f for _, f in corpus_pipeline.STAGES]
    out = [f(spark, docs, str(tmp_path)) for f in stages]
    assert [o.columns for o in out[:4]] == [docs.columns] * 4
    given = docs.collect()
    assert got(out[0], *docs.columns) == want(r for r in given if not base_rules(r.text)[5])
    distinct = list(dict.fromkeys(rows))  # of rows equal in id and text one stays
    assert got(out[1], "doc_id", "text") == want(r for r, g in zip(distinct, exact_dedup(distinct)) if g[3])
    blank = [(r.doc_id, r.text) for r in given if not WORD.search(r.text or "")]
    near = [(r, g[2]) for r, g in zip(distinct, near_components(distinct)) if r not in blank]
    keep = [r for r, c in near if r[0] == c and (c is not None or r[1] == next(x[1] for x, y in near if y is None))]
    assert set(got(out[2], "doc_id", "text")) == set(want(blank + keep))
    assert got(out[2].filter("text is null or not text rlike '[^ \\t\\n]'"), "doc_id", "text") == want(blank)
    copies = mix(docs, key=whole_row_key(docs)).agg(F.sum("copies")).first()[0] or 0
    assert out[3].count() == copies and set(got(out[3], *docs.columns)) <= set(want(given))
    assert out[4].agg(F.sum("length")).first()[0] == (sum(
        r.doc_tokens for r in out[4].filter("start = 0").collect()) or None)
    assert crc([]) == 0
