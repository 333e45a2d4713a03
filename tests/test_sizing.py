"""Partitions of shuffles grow with history, so that a task's memory does not."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF
from twinrun.operators.diff import diff_cells
from twinrun.plans import fixture_queries as Q
from twinrun.session import INITIAL_PARTITIONS, configure, size_shuffles

NAMES = ("spark.sql.shuffle.partitions", INITIAL_PARTITIONS, "spark.sql.adaptive.advisoryPartitionSizeInBytes",
         "spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.files.maxPartitionBytes")


@pytest.fixture()
def settings(spark):
    old = {n: spark.conf.get(n, None) for n in NAMES}
    yield spark.conf
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_partitions_grow_with_the_rows(spark, settings):
    settings.set("spark.sql.shuffle.partitions", "2")
    small, large = spark.range(1_000), spark.range(20_000)
    assert size_shuffles(spark, [small], rows=1_000) == 2  # never fewer than the session's own
    assert size_shuffles(spark, [small, large], rows=1_000) == 21
    settings.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1b")
    settings.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    tasks = large.groupBy(F.pmod("id", F.lit(10_000)).alias("k")).count().groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert len(tasks) == 21 and max(t["n"] for t in tasks) < 2_000


def test_small_partitions_are_not_joined_to_large_ones(spark, settings):
    settings.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    configure(spark)
    assert settings.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "4m"
    assert settings.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_queries_size_their_shuffles(spark, settings, monkeypatch):
    """The queries give the session the size of their tables, and a pin as many buckets."""
    seen = []
    monkeypatch.setattr(Q, "size_shuffles", lambda s, tables: seen.append(size_shuffles(s, tables, rows=300)) or seen[-1])
    pinned = []
    whole = Q.pin_bucketed
    monkeypatch.setattr(Q, "pin_bucketed", lambda *a, buckets, **b: pinned.append(buckets) or whole(*a, buckets=buckets, **b))
    got = Q.q_pin_bucketed(spark, SF["0.001"]).count()
    assert pinned == seen and seen[0] > 16
    assert got == Q.q_diff_rows_broken(spark, SF["0.001"]).count() > 0


def test_compared_sides_come_by_shuffles_of_their_own(spark, capsys):
    """Both sides end in an aggregation on the key; their tasks hold neither the
    other side's tables nor those of the comparison."""
    a = spark.range(100).groupBy(F.pmod("id", F.lit(10)).alias("k")).agg(F.sum("id").alias("v"))
    b = spark.range(90).groupBy(F.pmod("id", F.lit(10)).alias("k")).agg(F.sum("id").alias("v"))
    got = diff_cells(a, b, ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [
        (k, "changed", 450 + 10 * k, 360 + 9 * k) for k in range(10)]
    got.explain("simple")
    plan = capsys.readouterr().out
    assert len(set(re.findall(r"hashpartitioning\((__key#\d+), \d+\), REPARTITION_BY_COL", plan))) == 2
