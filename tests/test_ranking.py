"""top_n_per against a brute-force sort, with ties and a hot group."""

from pyspark.sql import functions as F

from twinrun.functions.ranking import top_n_per


def brute(rows, n):
    out = []
    for g in sorted({r[0] for r in rows}):
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        out += grp[:n]
    return sorted(out)


def test_top_n_with_ties_and_hot_group(spark):
    # group 0 holds most rows; values repeat, so ties are broken by "item"
    rows = [(0 if i % 3 else i % 7, i, (i * 7919) % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, item long, v long")
    for n in (1, 2, 5):
        got = sorted(tuple(r) for r in top_n_per(df, ["g"], [F.col("v").desc()], n=n).collect())
        assert got == brute(rows, n)


def test_top_n_keeps_columns_and_is_repeatable(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (2, 1, 3)], "g long, v long, item long")
    a = top_n_per(df, ["g"], [F.col("v").desc()])
    b = top_n_per(df.repartition(3), ["g"], [F.col("v").desc()])
    assert a.columns == df.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == [(1, 5, 1), (2, 1, 3)]


def test_groups_are_limited_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top_n_per(df, ["g"], [F.col("id").desc()], n=2).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_top_n_with_map_column(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 3, map('a', 1)), (1, 5, map('b', 2)), (2, 1, map('c', 3))
                      AS t(g, v, m)""")
    got = {r.g: (r.v, r.m) for r in top_n_per(df, ["g"], [F.col("v").desc()]).collect()}
    assert got == {1: (5, {"b": 2}), 2: (1, {"c": 3})}
