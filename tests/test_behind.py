"""The rows behind a difference, a part of history with a bound, versions by
time and bucketed pins, each against brute force on planted cases."""

import io
import random
from collections import Counter
from contextlib import redirect_stdout
from decimal import Decimal
from math import comb

import pytest
from conftest import rows
from pyspark.sql import functions as F

from twinrun import (asof_join, bounded, compare_to_bucketed_pin, diff_rows, pin_bucketed, replay_pair, shared_path,
                     source_rows, split_diff)
from twinrun.functions.schema import SchemaMismatch
from twinrun.operators.bounded import answer, first_share, tail
from twinrun.plans import standin as S

LINES = "doc long, prod long, q int, note string"


def totals(agg, cond="true", having="true"):
    def fn(tables, params):
        return (tables["lines"].join(params, "doc").filter(cond).groupBy("doc", "prod")
                .agg(agg("q").cast("long").alias("total"), F.count("*").alias("n")).filter(having).select("doc", "prod", "total"))
    return fn


# ------------------------------------------------------------- source rows


def planted_lines(seed):
    rng = random.Random(seed)
    return [(rng.randint(1, 6), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 1, 2, 5]), rng.choice("ab")) for _ in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_source_rows_equal_brute_force(spark, seed):
    data = planted_lines(seed)
    t = {"lines": spark.createDataFrame([*data, (None, 1, 1, "x")], LINES)}
    params = t["lines"].select("doc").distinct()
    got = source_rows(totals(F.max), totals(F.sum, "q > 1 or q is null"), t, params, ["doc", "prod"], "lines", "doc")
    want = Counter()
    for key in {(d, p) for d, p, _, _ in data}:
        mine = [r for r in data if r[:2] == key]
        kept = [r for r in mine if r[2] is None or r[2] > 1]
        old = max((r[2] for r in mine if r[2] is not None), default=None)
        new = sum(r[2] for r in kept if r[2] is not None) if any(r[2] is not None for r in kept) else None
        if not kept or old != new:
            want.update((*key, r, True, r in kept, True) for r in mine)
    assert Counter((r.doc, r.prod, tuple(r.row), r.in_old, r.in_new, r.exact) for r in got.rows.collect()) == want
    summary = {(r.doc, r.prod): (r.rows_old, r.rows_new, r.exact) for r in got.summary.collect()}
    assert summary == {k: (sum(n for w, n in want.items() if w[:2] == k),
                           sum(n for w, n in want.items() if w[:2] == k and w[4]), True) for k in {w[:2] for w in want}}


def test_rows_that_decide_together_give_the_whole_document(spark):
    """``having n > 1``: no row alone makes a result, so the document's rows come all."""
    t = {"lines": spark.createDataFrame([(1, 1, 2, "a"), (1, 1, 3, "b"), (1, 2, 9, "c"), (2, 1, 4, "d")], LINES)}
    got = source_rows(totals(F.max, having="n > 1"), totals(F.sum, having="n > 1"), t, t["lines"].select("doc").distinct(),
                      ["doc", "prod"], "lines", "doc")
    assert rows(got.rows.select("doc", "prod", "row.note", "in_old", "exact")) == [
        (1, 1, n, None, False) for n in "abc"]
    assert rows(got.summary) == [(1, 1, "changed", 3, 3, False)]


def test_source_rows_without_differences_and_bad_calls(spark):
    t = {"lines": spark.createDataFrame([(1, 1, 2, "a")], LINES)}
    params = t["lines"].select("doc")
    got = source_rows(totals(F.max), totals(F.max), t, params, ["doc", "prod"], "lines", "doc")
    assert got.rows.count() == 0 and got.summary.count() == 0
    for keys, table in ((["prod"], "lines"), (["doc", "prod"], "missing")):
        with pytest.raises(SchemaMismatch):
            source_rows(totals(F.max), totals(F.sum), t, params, keys, table, "doc")


def test_removing_source_rows_removes_the_difference(spark, hist, params):
    got = source_rows(S.old_version(), S.broken_version(), hist, params, list(S.KEYS), "lineitem", "l_orderkey")
    assert got.summary.filter("not exact").count() == 0
    gone = got.rows.select("row.l_orderkey", "row.l_partkey").distinct()
    left = {**hist, "lineitem": hist["lineitem"].join(gone, ["l_orderkey", "l_partkey"], "left_anti")}
    assert diff_rows(*replay_pair(S.old_version(), S.broken_version(), left, params)).count() == 0


# ------------------------------------------------------------ bounded part


def test_tails_are_exact():
    for n, k, p in ((20, 1, 0.2), (300, 0, 0.01), (300, 9, 0.01), (50, 30, 0.5)):
        lower = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        upper = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1))
        if k <= n * p:
            assert tail(k, n, p, upper=False) == pytest.approx(lower, rel=1e-9)
        if k >= n * p:
            assert tail(k, n, p, upper=True) == pytest.approx(upper, rel=1e-9)


@pytest.mark.parametrize("rate", [0.05, 0.02, 0.01])
def test_planted_rates_are_covered(rate):
    """Whole sequences of looks on drawn histories: each kind of wrong answer
    comes at most as often as promised."""
    rng, size, most, error, wrong, runs = random.Random(5), 3000, 0.02, 0.1, 0, 400
    bad = int(size * rate)
    for _ in range(runs):
        docs = [1] * bad + [0] * (size - bad)
        rng.shuffle(docs)
        n, looks, got = first_share(size, most, error / 2) * size // (1 << 32), 0, None
        while got is None:
            got = answer(n, sum(docs[:n]), size, most, error / 2 ** (looks + 1))
            looks, n = looks + 1, min(size, 2 * n)
        wrong += got == ("exceeded" if rate <= most else "bounded")
    assert wrong <= error * runs


def test_bounded_counts_what_it_replayed(spark, hist, params, sit):
    strata = hist["orders"].select(F.col("o_orderkey").alias("doc"), F.col("o_orderstatus").alias("status"))
    got = bounded(S.old_version(), S.broken_version(), hist, params, sit, S.KEYS, strata, most=0.2, error=0.05)
    sizes = dict(rows(strata.groupBy("status").count()))
    assert {r.status: r.documents for r in got.collect()} == sizes
    assert all(r.answer == "bounded" and r.replayed < r.documents for r in got.collect())
    whole = bounded(S.old_version(), S.broken_version(), hist, params, sit, S.KEYS, strata, most=0.0001, error=0.0001)
    unwanted = split_diff(diff_rows(*replay_pair(S.old_version(), S.broken_version(), hist, params)), sit, list(S.KEYS))[1]
    bad = dict(rows(unwanted.select("doc").distinct().join(strata, "doc").groupBy("status").count()))
    assert {r.status: r.regressed for r in whole.collect() if r.answer == "counted"} == {
        r.status: bad.get(r.status, 0) for r in whole.collect() if r.answer == "counted"}
    assert bounded(S.old_version(), S.old_version(), hist, params.limit(0), sit, S.KEYS, strata).count() == 0


# ------------------------------------------------------- versions by time


def valid_at(left, versions, strict):
    out = []
    for key, t, name in left:
        fits = [v for v in versions if None not in (key, t, v[0], v[1]) and v[0] == key and (v[1] < t if strict else v[1] <= t)]
        best = max(fits, key=lambda v: (v[1], v[2] is not None, v[2] or ""), default=(None, None, None))
        out.append((key, t, name, best[1], best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_equals_brute_force_with_a_hot_key(spark, strict):
    rng = random.Random(3)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", None])
    time = lambda: rng.choice([None, *range(40)])
    left = [(key(), time(), f"r{i % 90}") for i in range(300)] + [("hot", 20, "same")] * 60
    versions = [(key(), time(), rng.choice([None, "u", "v", "w"])) for _ in range(50)]
    lf = spark.createDataFrame(left, "k string, t int, name string").repartition(5)
    vf = spark.createDataFrame(versions, "k string, since int, value string").repartition(3)
    for n in (1, 7, 16):
        got = asof_join(lf, vf, ["k"], "t", "since", strict=strict, partitions=n)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == valid_at(left, versions, strict)


def test_asof_edges(spark):
    lf = spark.createDataFrame([("a", 1, "x")], "k string, t int, name string")
    vf = spark.createDataFrame([("a", 1, "v")], "k string, since int, value string")
    assert rows(asof_join(lf, vf.limit(0), ["k"], "t", "since")) == [("a", 1, "x", None, None)]
    assert rows(asof_join(lf.limit(0), vf, ["k"], "t", "since")) == []
    with pytest.raises(SchemaMismatch):
        asof_join(lf, vf.withColumnRenamed("value", "name"), ["k"], "t", "since")
    with pytest.raises(SchemaMismatch):
        asof_join(lf, vf.withColumn("since", F.col("since").cast("long")), ["k"], "t", "since")


def test_a_hot_key_is_spread(spark):
    """Half of all rows have one key and time: no partition holds them all."""
    lf = spark.range(8000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), F.lit(5).alias("t"), "id")
    vf = spark.createDataFrame([(0, 1, "v")], "k long, since int, value string")
    got = asof_join(lf, vf, ["k"], "t", "since", partitions=8)
    sizes = [r[1] for r in rows(got.groupBy(F.spark_partition_id()).count())]
    assert got.filter("value = 'v'").count() == 4000 and max(sizes) <= 3000


# --------------------------------------------------------- bucketed pins

PINNED = "doc long, prod string, x double, qty decimal(18,2)"


def pinned_rows(seed):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(9)]), rng.choice([None, "a", "b"]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5]),
             rng.choice([None, Decimal("1.00")])) for _ in range(400)]


@pytest.mark.parametrize("by, fold", [(None, False), (["doc"], False), (["doc", "prod"], True)])
def test_bucketed_pin_equals_diff(spark, by, fold):
    old, new = (spark.createDataFrame(pinned_rows(s), PINNED).repartition(3) for s in (1, 2))
    path = pin_bucketed(old, shared_path(spark, "pins", "test"), 5, by)
    shown = lambda df: Counter(str(tuple(r)).replace("-0.0", "0.0") for r in df.collect())
    assert shown(compare_to_bucketed_pin(new, path, fold=fold)) == shown(diff_rows(old, new))
    assert compare_to_bucketed_pin(old, path, fold=fold).count() == 0
    assert compare_to_bucketed_pin(old.limit(0), path).agg(F.sum("net")).first()[0] == -400
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("twinrun_pin_")]


def test_no_exchange_on_the_pins_side(spark):
    old = spark.createDataFrame(pinned_rows(1), PINNED)
    path = pin_bucketed(old, shared_path(spark, "pins", "test"), 5, ["doc"])
    out = io.StringIO()
    with redirect_stdout(out):
        compare_to_bucketed_pin(old, path).explain()
    lines = out.getvalue().splitlines()
    assert sum("Exchange" in x for x in lines) == 1  # the new side's
    pin_side = next(i for i, x in enumerate(lines) if "FileScan" in x)
    exchange = next(i for i, x in enumerate(lines) if "Exchange" in x)
    union = next(i for i, x in enumerate(lines) if "Union" in x)
    assert union < exchange < pin_side and "Bucketed: true" in lines[pin_side]


def test_bucketed_pin_refuses(spark):
    df = spark.createDataFrame([(1, 1.0, {"a": 1})], "k long, x double, m map<string, int>")
    for bad, by in ((df, None), (df.drop("m"), ["x"]), (df.drop("m"), ["z"])):
        with pytest.raises(SchemaMismatch):
            pin_bucketed(bad, shared_path(spark, "pins", "test"), 2, by)
    path = pin_bucketed(df.drop("m"), shared_path(spark, "pins", "test"), 2)
    with pytest.raises(SchemaMismatch):
        compare_to_bucketed_pin(df.drop("m").withColumnRenamed("x", "y"), path)
