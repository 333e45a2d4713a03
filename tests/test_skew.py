"""One document holding a third of all lines: the answer is unchanged and
adaptive execution splits the hot partition of the version's join."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from twinrun.functions.table_fn import param_set
from twinrun.operators.situations import situations
from twinrun.plans import Comparison
from twinrun.plans import standin as S
from twinrun.plans.replay import run_procedure
from twinrun.sources.history import load_history

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    # small tables: else few map tasks are left, and a partition can only be
    # split along the map tasks that wrote it
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def hot_history(spark):
    t = load_history(spark, SF["0.01"], ["orders", "lineitem", "part"])
    # the test files are one row group each (one map task); spread them so
    # that a skewed reduce partition has map outputs to split along
    li = t["lineitem"].repartition(8)
    hot = F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0
    t["lineitem"] = li.withColumn("l_orderkey", F.when(hot, F.lit(1)).otherwise(F.col("l_orderkey")))
    return t


@pytest.fixture()
def conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    yield spark.conf
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _verdict(t):
    params = S.params_of(t)
    sit = situations(t, S.situation_rule)
    return Comparison(S.old_version(), S.broken_version(), t, params, S.KEYS, sit).verdict()


def test_hot_document_split_and_same_answer(spark, hot_history, conf):
    conf.set("spark.sql.adaptive.enabled", "false")
    plain = tuple(_verdict(hot_history).first())
    conf.set("spark.sql.adaptive.enabled", "true")
    for k, v in SKEW_CONF.items():
        conf.set(k, v)
    v = _verdict(hot_history)
    got = tuple(v.collect()[0])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        v.explain()
    final = buf.getvalue().split("Initial Plan")[0]
    assert got == plain
    assert sum(got) > 0
    assert "SortMergeJoin(skew=true)" in final


@pytest.mark.parametrize("where", [None, "o_orderkey < 20000"])
def test_hot_product_in_procedure(spark, conf, where):
    """A product on a third of all lines, or of a part of history: the
    procedure's price lookup, the second join on the product in a row, is
    split, with the same plan for any share, and no job runs while building."""
    t = load_history(spark, SF["0.01"], ["orders", "lineitem", "part"])
    hot = F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0
    if where:
        hot = hot & (F.col("l_orderkey") < 20000)
    t["lineitem"] = t["lineitem"].repartition(8).withColumn(
        "l_partkey", F.when(hot, F.lit(1)).otherwise(F.col("l_partkey")))
    params = param_set(t["orders"], {"o_orderkey": "doc"}, where=where, freeze=True)
    price = t["part"].select(F.col("p_partkey").alias("prod"),
                             F.col("p_retailprice").cast(S.QTY).alias("price"))
    plain = rows(S.new_version()(t, params).join(price, "prod").groupBy("doc")
                 .agg(F.sum(F.col("qty") * F.col("price")).cast(S.COST).alias("cost")))
    for k, v in SKEW_CONF.items():
        conf.set(k, "4k" if v == "64k" else v)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    cost = run_procedure(S.new_version(), t, params, S.procedure_cost)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == list(before)
    assert rows(cost) == plain
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        cost.explain()
    final = buf.getvalue().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true) [__key_big" in final
