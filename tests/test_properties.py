"""Property tests: O7 and O13 against a brute-force count on small inputs."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from twinrun.operators.diff import diff_cells, diff_rows

SCHEMA = "k long, g string, v decimal(6,2)"
row = st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]),
                st.sampled_from([Decimal("1.00"), Decimal("2.50"), None]))
rows = st.lists(row, max_size=8)
SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(a=rows, b=rows)
def test_diff_rows_is_multiset_difference(spark, a, b):
    got = {tuple(r[:-1]): r[-1] for r in
           diff_rows(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()}
    ca, cb = Counter(a), Counter(b)
    want = {k: cb[k] - ca[k] for k in set(ca) | set(cb) if cb[k] != ca[k]}
    assert got == want


keyed = st.dictionaries(st.integers(0, 5), st.tuples(st.sampled_from(["a", "b", None]),
                        st.sampled_from([Decimal("1.00"), None])), max_size=6)


@SETTINGS
@given(a=keyed, b=keyed)
def test_diff_cells_statuses(spark, a, b):
    da = spark.createDataFrame([(k, *v) for k, v in a.items()], SCHEMA)
    db = spark.createDataFrame([(k, *v) for k, v in b.items()], SCHEMA)
    got = {r.k: r.status for r in diff_cells(da, db, ["k"], include_same=True).collect()}
    for r in diff_cells(da, db, ["k"]).collect():  # the same pass without unchanged keys
        assert got[r.k] == r.status != "same"
        assert ((r.g_old, r.v_old), (r.g_new, r.v_new)) == (a.get(r.k, (None, None)), b.get(r.k, (None, None)))
    want = {}
    for k in set(a) | set(b):
        want[k] = ("added" if k not in a else "removed" if k not in b
                   else "same" if a[k] == b[k] else "changed")
    assert got == want


sit_keys = st.sets(st.integers(0, 6), max_size=4)


@SETTINGS
@given(a=keyed, b=keyed, s=sit_keys)
def test_verdict_cells_match_brute_force(spark, a, b, s):
    from twinrun.operators.verdict import verdict
    da = spark.createDataFrame([(k, *v) for k, v in a.items()], SCHEMA)
    db = spark.createDataFrame([(k, *v) for k, v in b.items()], SCHEMA)
    ds = spark.createDataFrame([(k,) for k in s], "k long")
    got = tuple(verdict(da, db, ds, ["k"]).first())
    cells = [0, 0, 0, 0]
    for k in set(a) | set(b) | s:
        changed = a.get(k) != b.get(k)
        cells[(0 if k in s else 2) + (0 if changed else 1)] += 1
    assert got == tuple(cells)
