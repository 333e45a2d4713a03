"""fresh_join equals the plain join and shuffles both sides on its own."""

import contextlib
import io

import pytest
from conftest import rows
from pyspark.sql import functions as F

from twinrun.functions.joins import fresh_join


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_the_plain_join(spark, how):
    big = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, None, 7), (None, "b", 8), (3, "c", 9)], "k long, g string, v long")
    small = spark.createDataFrame([(1, "a", 10), (3, "x", 11), (None, "b", 12), (2, None, 13)], "k long, g string, w long")
    assert rows(fresh_join(big, small, ["k", "g"], how)) == rows(big.join(small, ["k", "g"], how).select(
        *big.columns, *(["w"] if how in ("inner", "left") else [])))


def test_second_join_on_the_key_gets_its_own_exchanges(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(0, 30000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
        one = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
        two = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 7).alias("x"))
        assert _plan(big.join(one, "k").join(two, "k")).count("Exchange hashpartitioning") == 3
        assert _plan(fresh_join(big.join(one, "k"), two, ["k"])).count("Exchange hashpartitioning") == 4
        assert fresh_join(big.join(one, "k"), two, ["k"]).count() == 30000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
