"""Finding the error behind a diff: rows without a key paired, the smallest
history that differs, conditions behind unwanted rows, widths of situations;
each against brute force."""

import random
from collections import Counter
from functools import cache
from itertools import combinations
from pathlib import Path

import pytest
from conftest import SF
from pyspark.sql import functions as F

from twinrun import (DependentRule, diff_by_digest, diff_rows, ensure_checkpoint_dir, explain, in_parts, match_rows,
                     materialize, replay_pair, shrink, situation_widths, situations)
from twinrun.functions.schema import SchemaMismatch
from twinrun.operators.matching import least_cost_flow
from twinrun.plans import standin as S

# ------------------------------------------------------- rows without a key


def least_pairing(removed, added, most):
    """(pairs, changed cells) of the best pairing of two lists of rows, by trying all."""
    cost = [[sum(x != y for x, y in zip(r, a)) for a in added] for r in removed]

    @cache
    def best(i, used):
        if i == len(removed):
            return 0, 0
        options = [best(i + 1, used)]
        for j, c in enumerate(cost[i]):
            if c <= most and not used >> j & 1:
                n, total = best(i + 1, used | 1 << j)
                options.append((n - 1, total + c))
        return min(options)

    n, total = best(0, 0)
    return -n, total


def copies_of(counter):
    return [r for r, n in sorted(counter.items(), key=repr) for _ in range(n)]


def test_flow_equals_all_pairings():
    rng = random.Random(7)
    for _ in range(400):
        supply = {i: rng.randint(1, 3) for i in range(rng.randint(1, 4))}
        demand = {10 + i: rng.randint(1, 3) for i in range(rng.randint(1, 4))}
        cost = {(r, a): rng.randint(1, 3) for r in supply for a in demand if rng.random() < 0.6}
        flow = least_cost_flow([(r, a, c) for (r, a), c in cost.items()], supply, demand)
        assert all(sum(n for (r, _), n in flow.items() if r == x) <= m for x, m in supply.items())
        assert all(sum(n for (_, a), n in flow.items() if a == x) <= m for x, m in demand.items())
        left = [r for r, n in supply.items() for _ in range(n)]
        right = [a for a, n in demand.items() for _ in range(n)]

        @cache
        def best(i, used, left=tuple(left), right=tuple(right), cost=cost):
            if i == len(left):
                return 0, 0
            options = [best(i + 1, used)]
            for j, a in enumerate(right):
                if (left[i], a) in cost and not used >> j & 1:
                    n, total = best(i + 1, used | 1 << j)
                    options.append((n - 1, total + cost[left[i], a]))
            return min(options)

        n, total = best(0, 0)
        assert (sum(flow.values()), sum(cost[p] * n for p, n in flow.items())) == (-n, total)


def tables(spark, seed, n, width=4):
    rng = random.Random(seed)
    row = lambda: tuple(rng.choice(["a", "b", "c", None]) for _ in range(width))
    old, new = [row() for _ in range(n)], [row() for _ in range(n - 1)]
    schema = ", ".join(f"x{i} string" for i in range(width))
    return old, new, spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


def whole(out, old, new):
    """Each side's rows are there once, as pairs or alone; (pairs, cells)."""
    rows, width = out.collect(), len(old[0])
    gone, came = Counter(), Counter()
    pairs = cells = 0
    for r in rows:
        o, n = tuple(r[f"x{i}_old"] for i in range(width)), tuple(r[f"x{i}_new"] for i in range(width))
        if r.match != "added":
            gone[o] += r.copies
        if r.match != "removed":
            came[n] += r.copies
        if r.match == "paired":
            assert sum(x != y for x, y in zip(o, n)) == r.cells_changed
            pairs, cells = pairs + r.copies, cells + r.copies * r.cells_changed
        else:
            assert r.cells_changed is None
    assert gone == Counter(old) - Counter(new) and came == Counter(new) - Counter(old)
    return pairs, cells


@pytest.mark.parametrize("seed, most", [(1, 2), (2, 1), (3, 3)])
def test_matching_equals_all_pairings(spark, seed, most):
    old, new, a, b = tables(spark, seed, 11)
    out = match_rows(a, b, max_changed=most)
    assert out.filter("not least").isEmpty()
    gone, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
    assert whole(out, old, new) == least_pairing(copies_of(gone), copies_of(came), most)


def test_matching_without_the_exact_search_keeps_all_rows(spark):
    old, new, a, b = tables(spark, 4, 60, 5)
    exact = whole(match_rows(a, b), old, new)
    for limits in ({"part_rows": 2}, {"block_pairs": 4}):
        out = match_rows(a, b, **limits)
        pairs, _ = whole(out, old, new)
        assert 0 < pairs <= exact[0] and not out.filter("not least").isEmpty()


def test_hot_blocks_are_split_and_planted_edits_found(spark):
    """All rows agree in two columns, so their blocks hold all pairs."""
    base = spark.range(300).select(F.lit("hot").alias("a"), F.lit(None).cast("string").alias("b"),
                                   *[F.pmod(F.xxhash64("id", F.lit(i)), 97).alias(f"c{i}") for i in range(5)])
    new = base.withColumn("c3", F.when(F.col("c0") % 2 == 0, F.col("c3") + 1000).otherwise(F.col("c3")))
    out = match_rows(base, new, max_changed=1, block_pairs=2000)
    n = base.filter("c0 % 2 = 0").count()
    assert n > 100 and out.agg(F.sum("copies")).first()[0] == n
    assert out.filter("match <> 'paired' or cells_changed <> 1 or c3_new <> c3_old + 1000 or not least").isEmpty()


def test_matching_edges(spark):
    kind = "x long, y string"
    empty, one = spark.createDataFrame([], kind), spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], kind)
    assert match_rows(one, one, max_changed=1).isEmpty() and match_rows(empty, empty, max_changed=1).isEmpty()
    out = match_rows(one, empty, max_changed=1)
    assert sorted((r.match, r.copies, r.x_old, r.x_new) for r in out.collect() if r.x_old) == [("removed", 2, 1, None)]
    two = spark.createDataFrame([(1, "b")] * 5 + [(None, None)], kind)
    assert sorted((r.match, r.copies, r.y_old, r.y_new) for r in match_rows(one, two, max_changed=1).collect()) == [
        ("added", 3, None, "b"), ("paired", 2, "a", "b")]
    with pytest.raises(SchemaMismatch):
        match_rows(one, two, max_changed=2)


# -------------------------------------------------------- smallest history

def needs(values):
    """Whether the planted defect shows on a document's values."""
    c = Counter(values)
    return bool(c[1] or (c[2] and c[3]) or (c[4] and c[5] and c[6]) or c[7] >= 3)


def planted(defect):
    def fn(t, params):
        has = lambda *v: F.array_contains("vs", v[0]) if len(v) == 1 else has(*v[:1]) & has(*v[1:])
        lines = t["lines"].join(params, t["lines"]["k"] == params["doc"]).join(t["head"], "k")
        docs = lines.groupBy("doc").agg(F.collect_list("v").alias("vs"))
        wrong = (has(1) | has(2, 3) | has(4, 5, 6) | (F.size(F.filter("vs", lambda v: v == 7)) >= 3)
                 ) if defect else F.lit(False)
        return docs.select("doc", wrong.alias("wrong"))
    return fn


@pytest.mark.parametrize("kind", ["string", "long"])
def test_smallest_history_is_minimal(spark, kind):
    rng = random.Random(11)
    docs = {}
    for i in range(24):
        other = [rng.randint(8, 60) for _ in range(rng.choice([0, 1, 3, 9, 40]))]
        docs[i] = other + [[1], [2, 3], [4, 5, 6], [7, 7, 7], [2, 2, 3, 4, 5], [4, 5], [], [7, 7]][i % 8]
        rng.shuffle(docs[i])
    lines = spark.createDataFrame([(d, v, "x") for d, vs in docs.items() for v in vs], "k long, v int, __p string")
    lines = lines.withColumn("k", F.col("k").cast(kind))
    head = lines.select("k").distinct().withColumn("h", F.lit(1))
    t = {"lines": lines, "head": head}
    params = head.select(F.col("k").alias("doc"))
    cut = shrink(planted(False), planted(True), t, params, {"lines": "k"}, along={"head": "k"})
    assert cut.rows["lines"].columns == lines.columns
    left = {}
    for r in cut.rows["lines"].collect():
        left.setdefault(int(r.k), []).append(r.v)
    assert set(left) == {d for d, vs in docs.items() if needs(vs)}
    for d, vs in left.items():
        assert needs(vs) and not Counter(vs) - Counter(docs[d])
        assert not any(needs(vs[:i] + vs[i + 1:]) for i in range(len(vs))), (docs[d], vs)
    summary = {int(r.doc): (r.rows_before, r.rows_left, r.minimal) for r in cut.summary.collect()}
    assert summary == {d: (len(docs[d]), len(vs), True) for d, vs in left.items()}


def test_smallest_history_edges(spark):
    lines = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, 9)], "k long, v int")
    t = {"lines": lines, "head": lines.select("k").distinct()}
    params = lines.select(F.col("k").alias("doc")).distinct()
    same = shrink(planted(False), planted(False), t, params, {"lines": "k"})
    assert same.summary.isEmpty() and same.rows["lines"].isEmpty()
    cut = shrink(planted(False), planted(True), t, params, {"lines": "k"}, along={"head": "k"}, max_rounds=5)
    assert [tuple(r) for r in cut.rows["lines"].collect()] == [(1, 1)]
    with pytest.raises(SchemaMismatch):
        shrink(planted(False), planted(True), t, params.withColumn("two", F.lit(1)), {"lines": "k"})


# --------------------------------------------------------------- conditions

def test_conditions_equal_all_conjunctions(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["p", "q", None]), rng.randint(1, 4), rng.choice([True, False]), rng.randint(1, 300)) for _ in range(300)]
    rows = [(*r, None if i % 50 == 0 else r[1] == 2 and r[2] or rng.random() < 0.05) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "a string, b int, c boolean, d int, bad boolean")
    names, share = ["a", "b", "c", "d"], 0.1
    text = lambda n, v: f"{n} is null" if v is None else f"{n} = {str(v).lower() if isinstance(v, bool) else v}"
    n_bad = sum(bool(r[4]) for r in rows)
    expected = {}
    for k in (1, 2, 3):
        for pick in combinations(range(4), k):
            groups = Counter()
            flagged = Counter()
            for r in rows:
                c = " and ".join(text(names[i], r[i]) for i in pick)
                groups[c] += 1
                flagged[c] += bool(r[4])
            for c, n in groups.items():
                if flagged[c] >= share * n_bad:
                    out_n, out_b = len(rows) - n, n_bad - flagged[c]
                    ratio = flagged[c] * out_n / (out_b * n) if out_b and out_n else None
                    expected[c] = (k, n, flagged[c], ratio, out_b == 0)
    got = explain(df, "bad", names, depth=3, share=share).orderBy("place").collect()
    assert {r.condition: tuple(r)[2:] for r in got} == expected
    assert [r.place for r in got] == list(range(1, len(got) + 1))
    finite = [r.risk_ratio for r in got if r.risk_ratio is not None]
    assert finite == sorted(finite, reverse=True)
    assert got[0].condition == "b = 2 and c = true"


def test_conditions_without_flagged_rows(spark):
    df = spark.createDataFrame([("x", False), (None, None)], "a string, bad boolean")
    assert explain(df, "bad", ["a"]).isEmpty()
    assert explain(df.limit(0), "bad", ["a"]).isEmpty()
    got = explain(df.withColumn("bad", F.lit(True)), "bad", ["a"], share=0.1).collect()
    assert sorted((r.condition, r.n_rows, r.risk_ratio) for r in got) == [("a = x", 1, 1.0), ("a is null", 1, 1.0)]


# ------------------------------------------------------------------- widths

def test_widths_equal_all_subsets(spark):
    rng = random.Random(5)
    keys = sorted({(rng.choice([1, 2, 3, None]), rng.randint(1, 5), rng.choice("xyz")) for _ in range(50)}, key=repr)
    old = [(*k, rng.randint(0, 1)) for k in keys]
    new = [(*k, rng.randint(0, 1)) for k in keys if rng.random() < 0.9]
    sit = rng.sample(keys, 6) + [(9, 9, "q")]
    schema = "a long, b long, c string, v long"
    make = lambda r, s=schema: spark.createDataFrame(r, s)
    got = situation_widths(make(old), make(new), make(sit, "a long, b long, c string"), ["a", "b", "c"]).collect()
    ov, nv = {r[:3]: r[3] for r in old}, {r[:3]: r[3] for r in new}
    expected = {}
    for n in (1, 2, 3):
        for pick in combinations(range(3), n):
            wide = {tuple(s[i] for i in pick) for s in sit}
            x = {k for k in keys if tuple(k[i] for i in pick) in wide}
            changed = {k for k in keys if ov[k] != nv.get(k)}
            expected[", ".join("abc"[i] for i in pick)] = (
                n, len(x), len(changed & set(sit)), len((changed & x) - set(sit)), len(changed - x))
    assert {r.width: tuple(r)[1:6] for r in got} == expected
    assert [r.width for r in got if r.narrowest] == [min(expected, key=lambda w: (expected[w][3], expected[w][1], expected[w][0], w))]


def test_widths_of_situations_wider_than_the_keys(spark):
    old = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (2, 1, 5)], "a long, b long, v long")
    new = spark.createDataFrame([(1, 1, 6), (1, 2, 6), (2, 1, 6)], "a long, b long, v long")
    got = situation_widths(old, new, spark.createDataFrame([(1,)], "a long"), ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [("a", 1, 2, 2, 0, 1, True)]
    none = situation_widths(old, new, spark.createDataFrame([], "a long"), ["a", "b"]).collect()
    assert [tuple(r) for r in none] == [("a", 1, 0, 0, 0, 3, True)]


# ------------------------------------------------------------------ digests

def shuffled_bytes(spark, run):
    """Bytes of shuffle written by the stages of ``run``."""
    def total():
        store = spark.sparkContext._jsc.sc().statusStore()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))
    before = total()
    run()
    return total() - before


def test_digests_give_the_rows_of_the_diff(spark):
    rng = random.Random(9)
    cell = lambda: rng.choice([None, 0, 1, 2])
    rows = [(rng.randint(1, 40), cell(), cell(), {"k": cell()}) for _ in range(200)]
    old = rows + rows[:30]
    new = rows[3:] + rows[:20] + [(None, 1, None, None), (None, None, 1, None)]
    schema = "p long, x int, y int, m map<string,int>"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    flat = lambda df: sorted((repr(tuple(r)) for r in df.collect()))
    for fanouts in ((2,), (4, 3, 2)):
        assert flat(diff_by_digest(a, b, ["p"], fanouts)) == flat(diff_rows(a, b)) != []
    assert diff_by_digest(a, a, ["p"]).isEmpty() and diff_by_digest(a.limit(0), a.limit(0), ["p"]).isEmpty()
    assert diff_by_digest(a.limit(0), b, ["p"], (4,)).agg(F.sum("net")).first()[0] == len(new)


def test_digests_compare_few_rows_whole_where_every_range_differs(spark, monkeypatch):
    """With differences in all ranges, rows whose digests cancel are still left out."""
    from twinrun.operators import digest
    a = spark.range(4000).select("id", (F.col("id") % 7).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") % 50 == 0, F.lit(-1)).otherwise(F.col("v"))).unionByName(a.limit(3))
    compared, whole = [], digest.diff_rows
    monkeypatch.setattr(digest, "diff_rows", lambda x, y, **k: compared.extend((x.count(), y.count())) or whole(x, y, **k))
    assert sorted(diff_by_digest(a, b, ["id"], (2, 2)).collect()) == sorted(diff_rows(a, b).collect()) != []
    assert max(compared) < 200


def test_digests_shuffle_a_tenth_of_a_wide_result(spark):
    wide = spark.range(20_000).select((F.col("id") % 4000).alias("p"), *[F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(99)])
    a = materialize(wide)
    b = materialize(wide.withColumn("c7", F.when(F.col("p") < 40, F.col("c7") + 1).otherwise(F.col("c7"))))  # 1 %
    found = []
    whole = shuffled_bytes(spark, lambda: found.append(diff_rows(a, b).count()))
    less = shuffled_bytes(spark, lambda: found.append(diff_by_digest(a, b, ["p"]).count()))
    assert found == [400, 400] and less < whole / 10


def saved_bytes(spark):
    """Bytes of what lies in the shared folder, and the folders of ``scratch``."""
    files = [f for f in Path(ensure_checkpoint_dir(spark).removeprefix("file:"), "twinrun").rglob("*") if f.is_file()]
    return sum(f.stat().st_size for f in files), [f for f in files if "/scratch-" in str(f)]


def test_wide_results_are_saved_and_compared_in_parts(spark, monkeypatch):
    """The same rows, and at no time more on disk than a part's results."""
    from twinrun.operators import digest
    from twinrun.plans import fixture_queries as Q
    def run(**limits):
        sizes, begun = [], saved_bytes(spark)[0]

        def watch(df, *a, **k):
            out = materialize(df, *a, **k)
            sizes.append(saved_bytes(spark)[0] - begun)
            return out

        monkeypatch.setattr(Q, "materialize", watch)
        monkeypatch.setattr(digest, "materialize", watch)
        monkeypatch.setattr(Q, "in_parts", lambda *a: in_parts(*a, **limits))
        out = Q.q_diff_by_digest(spark, SF["0.001"])
        left = saved_bytes(spark)
        return sorted(map(tuple, out.collect()), key=repr), max(sizes), left[0] - begun, left[1]

    whole, most, _, _ = run(most=1)
    parts, held, left, scratched = run(most=6, part_rows=1000)
    assert parts == whole != []
    assert held < most / 2 and left < most / 3 and not scratched


def test_parts_hold_every_value_once(spark):
    params = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, None), (2, None)] + [(i, "x") for i in range(40)], "p long, q string")
    sizes = []

    def run(part):
        saved = materialize(part)
        sizes.append(saved.count())
        return saved

    out = in_parts(params, 45, run, part_rows=10)
    assert len(sizes) == 5 and max(sizes) < 45 and sum(sizes) == 45
    assert sorted(map(repr, out.collect())) == sorted(map(repr, params.collect()))
    assert in_parts(params.limit(0), 0, run).isEmpty() and not saved_bytes(spark)[1]
    with pytest.raises(ZeroDivisionError):
        in_parts(params, 45, lambda part: 1 / (materialize(part).count() * 0))
    assert not saved_bytes(spark)[1]  # deleted after a failure as well


def test_saved_results_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}
    before, name = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    saved = materialize(spark.range(1000).groupBy((F.col("id") % 700).alias("k")).count())
    assert not files() - before and spark.conf.get(name, None) == setting
    assert saved.count() == 700


# -------------------------------------------------------------------- rules

def test_rules_over_results_are_refused(spark, hist, params):
    rule = lambda t: t["lineitem"].filter("l_quantity = 1").select(F.col("l_orderkey").alias("doc"))
    assert not situations(hist, rule).isEmpty()
    assert not situations(hist, "SELECT l_orderkey AS doc FROM {lineitem} WHERE l_orderkey IN (SELECT o_orderkey FROM {orders})").isEmpty()
    old, new = replay_pair(S.old_version(), S.broken_version(), hist, params)
    diff = diff_rows(old, new)
    saved = materialize(diff)
    by_hand = spark.createDataFrame([(1,), (2,)], "doc long")
    for bad in (diff, saved, old, materialize(new), diff.cache(), saved.filter("net > 0"), by_hand,
                hist["orders"].select(F.col("o_orderkey").alias("doc")).join(diff.select("doc"), "doc", "left_semi")):
        with pytest.raises(DependentRule):
            situations(hist, lambda t, bad=bad: bad.select("doc"))
    diff.unpersist()
    saved.createOrReplaceTempView("twinrun_saved_diff")
    with pytest.raises(DependentRule):
        situations(hist, "SELECT l_orderkey AS doc FROM {lineitem} WHERE l_orderkey IN (SELECT doc FROM twinrun_saved_diff)")
    assert situations(hist, lambda t: by_hand, also=[by_hand]).count() == 2
    derived = {**hist, "lineitem": materialize(hist["lineitem"].filter("l_quantity < 5"))}
    assert not situations(derived, rule).isEmpty()
