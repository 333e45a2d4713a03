"""Mixing sources to target weights by weighted fair queueing.

Every document (and each of its repeats) gets a virtual finish time: the
tokens its source has sent up to and including it, divided by the source's
target.  All are then put in one global order of finish time, by range
partitioning, and cut where the running total reaches the budget.  Sources
so advance together, each at the rate of its weight.

DataFrame functions only.  The order of documents within a source is the
md5 of their id, so reruns agree.

Cases: null text has size 0; a null source is a source of its own, last;
repeated rows are mixed one by one, each with its own source; very long texts
are only counted; documents without words are taken 0
times; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import columns
from .common import WORD, lookup_join, row_key, running_totals, saved, whole_row_key

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``source``, ``no_source``, its rank, size,
    ``first`` (sizes of the sources before it) and target.

    Targets share the whole by weight; a target stops at ``max_repeats``
    times its source's size and the excess is shared again until none is
    above.  That is target = min(cap, weight * level) for one level, found
    where caps sorted by cap / weight meet it.  Sums stay integers, so the
    targets do not depend on the order of additions."""
    dec = "decimal(38,0)"
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    s = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("rank", F.row_number().over(by_name))
         .withColumn("first", F.coalesce(F.sum("source_size").over(
             by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("w", w.cast(dec))
         .withColumn("cap", (F.col("source_size") * max_repeats).cast(dec)))
    by_level = Window.orderBy((F.col("cap").cast("double") / F.col("w").cast("double")), "rank")
    everything = Window.partitionBy()
    s = (s.withColumn("total", F.sum("source_size").over(everything).cast(dec))
         .withColumn("num", F.col("total") - F.coalesce(F.sum("cap").over(
             by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(dec))
         .withColumn("den", F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)).cast(dec))
         .withColumn("open", F.col("num").cast("double") * F.col("w").cast("double")
                     <= F.col("cap").cast("double") * F.col("den").cast("double"))
         .withColumn("pos", F.row_number().over(by_level)))
    level = F.min(F.when(F.col("open"), F.struct("pos", "num", "den"))).over(everything)
    s = s.withColumn("level", level)
    share = (F.col("w").cast("double") * F.col("level.num").cast("double")
             / F.col("level.den").cast("double"))
    return s.select("source", "rank", "source_size", "first",
                    F.least(F.col("cap").cast("double"),
                            F.coalesce(share, F.col("cap").cast("double"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[int] = WEIGHTS,
        max_repeats: int = MAX_REPEATS, seed: str = SEED, size: Column | None = None,
        key: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per input row: id, ``size``, ``source_size``, ``target`` (its
    source's), ``taken`` (size times repeats taken), ``copies``, and (k1, k2), the
    row's ``key`` (of id and text), which also breaks ties."""
    k1, k2 = key or row_key(F.col(id_col), F.col(text_col))
    if size is None:
        size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD))
    sized = saved(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), k1.alias("k1"), k2.alias("k2"),
        size.cast("long").alias("size")))
    plan = saved(source_targets(sized, weights, max_repeats))
    keyed = plan.withColumn("has", F.col("source").isNotNull()).withColumn(
        "source", F.coalesce("source", F.lit("")))
    rows = lookup_join(
        sized.withColumn("has", F.col("source").isNotNull())
        .withColumn("source", F.coalesce("source", F.lit("")))
        .withColumn("shuffle", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit("null"))))),
        keyed, ["source", "has"], "inner").drop("source", "has")
    order = ["rank", "shuffle", "size", "k1"]
    rows = running_totals(rows, [F.col(c) for c in order],
                          {"sent": F.col("size"), "row": F.lit(1)})
    copies = (rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
              .withColumn("finish", F.when(F.col("target") > 0, (
                  F.col("copy") * F.col("source_size") + F.col("sent") - F.col("first")
                  + F.col("size")).cast("double") / F.col("target"))))
    queue = running_totals(
        copies.drop("sent", "first"),
        [F.col(c) for c in ("finish", "shuffle", "size", "rank", "k1", "copy", "row")],
        {"before": F.col("size")})
    budget = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"))
    taken = F.col("finish").isNotNull() & (F.col("before") + F.col("size") <= F.col("budget"))
    return (queue.crossJoin(F.broadcast(budget))  # one row
            .groupBy("row", "id", "size", "source_size", "target", "k1", "k2")
            .agg(F.sum(F.when(taken, 1).otherwise(0)).alias("copies"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies", "k1", "k2"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The mix itself: each row as often as it is taken, own columns only.
    Only rows equal in all columns are counted together, and each of them is
    the same row, so every row's own source and columns go with its copies."""
    k1, k2 = whole_row_key(docs)
    took = (mix(docs, id_col, text_col, source_col, key=(k1, k2)).filter("copies > 0")
            .groupBy("k1", "k2").agg(F.sum("copies").alias("copies")))
    return (docs.select(F.struct(*columns(docs.columns)).alias("__row"), k1.alias("k1"), k2.alias("k2"))
            .groupBy("k1", "k2").agg(F.first("__row").alias("__row"))
            .join(took, ["k1", "k2"])
            .select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__c"))
            .select("__row.*"))
