"""Small edge cases: keys only in situations, null keys, integer measures."""

from conftest import rows
from twinrun.operators.diff import column_changes, diff_cells, diff_rows
from twinrun.operators.reconcile import reconcile
from twinrun.operators.situations import split_diff, tag_diff
from twinrun.operators.verdict import verdict

S = "k long, v long"


def test_situation_key_absent_from_both_sides_is_unfixed(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], S)
    b = spark.createDataFrame([(1, 1), (2, 3)], S)
    sit = spark.createDataFrame([(2,), (99,)], "k long")
    assert tuple(verdict(a, b, sit, ["k"]).first()) == (1, 1, 0, 1)


def test_absent_situations_at_wider_width(spark):
    a = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 1)], "d long, k long, v long")
    b = spark.createDataFrame([(1, 1, 5), (1, 2, 1), (2, 1, 1)], "d long, k long, v long")
    sit = spark.createDataFrame([(1,), (7,), (7,), (None,)], "d long")
    assert tuple(verdict(a, b, sit, ["d", "k"], on=["d"]).first()) == (1, 3, 0, 1)


def test_column_names_with_dots_and_backticks(spark):
    names = ["unit.price", "a`b", "k.ey"]
    a = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], names)
    b = spark.createDataFrame([(1, 2, 3), (4, 7, 6)], names)
    assert diff_rows(a, b).count() == 2
    cells = diff_cells(a, b, ["k.ey"]).collect()
    assert [(r["k.ey"], r["a`b_old"], r["a`b_new"]) for r in cells] == [(6, 5, 7)]
    assert {tuple(r) for r in column_changes(a, b, ["k.ey"]).collect()} == {("unit.price", 0), ("a`b", 1)}
    sit = spark.createDataFrame([(6,)], ["k.ey"])
    assert tuple(verdict(a, b, sit, ["k.ey"]).first()) == (1, 0, 0, 1)
    assert split_diff(diff_rows(a, b), sit, ["k.ey"])[1].count() == 0
    assert reconcile(a, b, ["k.ey"], ["a`b"]).count() == 1


def test_map_rows_come_back_as_maps(spark):
    a = spark.sql("SELECT 1L AS k, map('a', 1) AS m")
    b = spark.sql("SELECT 1L AS k, map('a', 2) AS m")
    d = diff_rows(a, b)
    assert dict(d.dtypes)["m"] == "map<string,int>"
    assert {(r.m["a"], r.net) for r in d.collect()} == {(1, -1), (2, 1)}


def test_null_keys_split_and_verdict(spark):
    a = spark.createDataFrame([(None, 1), (1, 1)], S)
    b = spark.createDataFrame([(None, 2), (1, 1)], S)
    sit = spark.createDataFrame([(None,)], "k long")
    d = diff_rows(a, b)
    wanted, unwanted = split_diff(d, sit, ["k"])
    assert (wanted.count(), unwanted.count()) == (2, 0)
    assert tag_diff(d, sit, ["k"]).filter("wanted").count() == 2
    assert tuple(verdict(a, b, sit, ["k"]).first()) == (1, 0, 0, 1)


def test_reconcile_integer_measures_sum_to_bigint(spark):
    a = spark.createDataFrame([(1, 2), (1, 3), (2, 5)], "k long, n int")
    b = spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "k long, n int")
    r = reconcile(a, b, ["k"], ["n"])
    assert dict(r.dtypes)["n_old"] == "bigint"
    assert rows(r) == [(1, 2, 1, 5, 5), (3, 0, 1, None, 1)]
