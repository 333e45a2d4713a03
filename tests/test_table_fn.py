"""Parameter set, one call, set-wise replay, procedure, pair."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from twinrun.functions.schema import SchemaMismatch
from twinrun.functions.table_fn import (LossyFunction, call_one, one_param, param_set, replay,
                                        sql_function_version, sql_version)
from twinrun.operators.diff import diff_rows
from twinrun.plans import standin as S
from twinrun.plans.fixture_queries import NEW_FUNCTION, NEW_SQL
from twinrun.plans.replay import replay_pair, run_procedure


def test_param_set_unique(hist):
    p = param_set(hist["orders"], {"o_orderkey": "doc"})
    assert p.columns == ["doc"]
    assert p.count() == p.distinct().count() == 1500


def test_param_set_where_reaches_scan(hist, capsys):
    p = param_set(hist["orders"], {"o_orderkey": "doc"}, where=F.col("o_orderstatus") == "F")
    p.explain()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in capsys.readouterr().out


def test_replay_rows(hist, params):
    assert replay(S.new_version(), hist, params).count() == 5942


def test_one_call_law(hist, params):
    """call_one(fn, k) == replay(fn, all).filter(param == k) for several k."""
    full = replay(S.new_version(), hist, params)
    for k in (1, 7, 5988):
        one = call_one(S.new_version(), hist, params, doc=k)
        assert diff_rows(one, full.filter(F.col("doc") == k)).count() == 0


def test_one_call_errors_and_nulls(spark, hist, params):
    with pytest.raises(SchemaMismatch, match="at least one"):
        call_one(S.new_version(), hist, params)
    with pytest.raises(SchemaMismatch, match="not parameter columns"):
        one_param(params, other=1)
    echo = lambda t, p: p
    some = spark.createDataFrame([(1,), (None,)], "doc long")
    assert rows(call_one(echo, hist, some, doc=None)) == [(None,)]


def test_one_param_needs_no_history(spark, hist, params, capsys):
    before = list(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    one = replay(S.new_version(), hist, one_param(params, doc=7))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    one.explain()
    assert "EqualTo(l_orderkey,7)" in capsys.readouterr().out
    assert rows(one) == rows(call_one(S.new_version(), hist, params, doc=7))


def test_one_call_literal_reaches_scan(hist, params, capsys):
    call_one(S.new_version(), hist, params, doc=7).explain()
    assert "EqualTo(l_orderkey,7)" in capsys.readouterr().out


def test_sql_text_version_equals_dataframe_version(hist, params):
    a = replay(S.new_version(), hist, params)
    b = replay(sql_version(NEW_SQL), hist, params)
    assert diff_rows(a, b).count() == 0


def test_sql_table_function_lateral(spark, hist, params):
    for n, df in hist.items():
        df.createOrReplaceTempView(f"twinrun_{n}")
    spark.sql(NEW_FUNCTION)
    a = replay(S.new_version(), hist, params)
    b = replay(sql_function_version("twinrun_menu_new", ["doc"]), hist, params)
    assert diff_rows(a, b).count() == 0
    one = spark.sql("SELECT * FROM twinrun_menu_new(:k)", args={"k": 7})
    assert rows(one) == rows(a.filter("doc = 7"))


def test_version_without_params_refused(hist, params):
    with pytest.raises(SchemaMismatch, match="parameter columns"):
        replay(lambda t, p: t["part"].select("p_partkey"), hist, params)


def test_procedure_differs_where_function_does(hist, params):
    a = run_procedure(S.old_version(), hist, params, S.procedure_cost)
    b = run_procedure(S.new_version(), hist, params, S.procedure_cost)
    d = diff_rows(a, b)
    assert d.select("doc").distinct().count() == 56
    assert d.count() == 112


def test_pair_schema_checked(hist, params):
    bad = lambda t, p: S.new_version()(t, p).withColumn("qty", F.col("qty").cast("double"))
    with pytest.raises(SchemaMismatch, match="qty"):
        replay_pair(S.old_version(), bad, hist, params)


def test_new_against_itself_is_empty(hist, params):
    a, b = replay_pair(S.new_version(), S.new_version(), hist, params)
    assert diff_rows(a, b).count() == 0


def test_repeatability_catches_a_nondeterministic_version(hist, params):
    from twinrun.plans.replay import repeatability
    steady = repeatability(S.new_version(), hist, params).first()
    assert (steady.rows, steady.rows_differing) == (5942, 0)

    def noisy(t, p):  # a version that depends on a random number
        return S.new_version()(t, p).withColumn("noise", F.rand())
    shaky = repeatability(noisy, hist, params).first()
    assert shaky.rows == 5942 and shaky.rows_differing == 2 * 5942 and not shaky.stable
    assert steady.stable


def test_repeatability_catches_ties(hist, params):
    """row_number over ties, and first() per document."""
    from twinrun.plans.replay import repeatability

    def first_line(t, p):
        li = t["lineitem"].withColumnRenamed("l_orderkey", "doc")
        return li.join(p, "doc").groupBy("doc").agg(F.first("l_partkey").alias("prod"))

    for version in (S.unstable_version, first_line):
        assert not repeatability(version, hist, params).first().stable


def test_limited_table_function_is_refused(spark, hist, params):
    hist["lineitem"].createOrReplaceTempView("twinrun_lineitem")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION twinrun_first_line(k BIGINT)
        RETURNS TABLE (doc BIGINT, prod BIGINT)
        RETURN SELECT l_orderkey, l_partkey FROM twinrun_lineitem WHERE l_orderkey = k
               ORDER BY l_quantity DESC, l_partkey LIMIT 1""")
    with pytest.raises(LossyFunction, match="top_n_per"):
        replay(sql_function_version("twinrun_first_line", ["doc"]), hist, params)


def _function(spark, name, body):
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(k BIGINT) RETURNS TABLE (doc BIGINT, x STRING) RETURN {body}")
    return sql_function_version(name, ["doc"])


@pytest.mark.parametrize("body", [
    "SELECT l_orderkey, 'x' FROM twinrun_li WHERE l_orderkey = k OFFSET 1",
    "SELECT a, b FROM (SELECT l_orderkey AS a, 'x' AS b FROM twinrun_li WHERE l_orderkey = k ORDER BY l_partkey LIMIT 2) q",
    "WITH c AS (SELECT l_orderkey AS a FROM twinrun_li WHERE l_orderkey = k LIMIT 1) SELECT a, 'x' FROM c",
    "SELECT l_orderkey, 'x' FROM twinrun_li WHERE l_orderkey = k AND l_partkey IN (SELECT p_partkey FROM twinrun_pt LIMIT 3)",
])
def test_limits_anywhere_are_refused(spark, hist, params, body):
    hist["lineitem"].createOrReplaceTempView("twinrun_li")
    hist["part"].createOrReplaceTempView("twinrun_pt")
    with pytest.raises(LossyFunction):
        replay(_function(spark, "twinrun_limited", body), hist, params)


def test_words_that_look_like_limits_are_not(spark, hist, params):
    """Literals, columns and tables named like plan nodes."""
    hist["lineitem"].withColumnRenamed("l_partkey", "Tail").withColumnRenamed("l_suppkey", "Offset").createOrReplaceTempView("GlobalLimit")
    fn = _function(spark, "twinrun_named", "SELECT l_orderkey, concat('Offset ', `Offset`, ' Tail ', `Tail`, ' LocalLimit') "
                                           "FROM GlobalLimit WHERE l_orderkey = k")
    out = replay(fn, hist, params)
    assert out.count() == hist["lineitem"].join(params, F.col("l_orderkey") == F.col("doc")).count() > 0
    spark.catalog.dropTempView("GlobalLimit")
