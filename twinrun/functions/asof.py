"""The version valid at a time: an as-of join without a nested loop.

Whether the versions of a document are found by time is an inference from
the word "version"; the operator serves procedures that do so.  Joining on
``valid_from <= time`` and keeping the latest compares all versions of a key
with all its rows, and a window per key puts a hot key into one task.
Here both sides are united and range-partitioned by (key, time), so a hot key
spreads over as many partitions as its rows need.  The ranges are saved,
so a lost executor reads the same ones again.  Inside a partition the last
version before a row is a running ``last``; what a partition's first rows
lack is the last version of all partitions before it, one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .schema import SchemaMismatch, check_columns, check_keys, col, columns


def asof_join(left: DataFrame, versions: DataFrame, by: Sequence[str], time: str, valid_from: str,
              strict: bool = False, partitions: int | None = None) -> DataFrame:
    """``left`` with the columns of the version valid at ``time``: of the rows of
    ``versions`` equal on ``by`` the one with the latest ``valid_from`` not after it
    (``strict``: before it).

    Every left row comes once, repeats too; without a valid version, or with a
    null key or time, the version's columns are null.  Versions with a null
    key or ``valid_from`` are never valid.  Of versions with one ``valid_from`` the
    one with the greatest other columns, compared in their order (nulls
    lowest), is valid.  Keys and times of both sides have the same types.
    ``partitions`` defaults to the session's shuffle partitions."""
    from ..sources.pin import materialize
    by = list(by)
    check_columns(left, "left")
    check_columns(versions, "versions")
    check_keys(left, [*by, time], "left")
    check_keys(versions, [*by, valid_from], "versions")
    rest = [c for c in versions.columns if c not in by]
    if clash := [c for c in rest if c in left.columns]:
        raise SchemaMismatch(f"columns {clash} are on both sides; rename them")
    lt, vt = dict(left.dtypes), dict(versions.dtypes)
    for a, b in [*zip(by, by), (time, valid_from)]:
        if lt[a] != vt[b]:
            raise SchemaMismatch(f"{a} is {lt[a]} but {b} is {vt[b]}")
    partitions = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def present(names: Sequence[str]):
        out = F.lit(True)
        for c in columns(names):
            out = out & c.isNotNull()
        return out

    rows = left.select(F.when(present(by), F.struct(*columns(by))).alias("__key"), col(time).alias("__t"),
                       F.lit(0 if strict else 1).alias("__side"), F.struct(*columns(left.columns)).alias("__l"))
    valid = versions.filter(present([*by, valid_from])).select(
        F.struct(*columns(by)).alias("__key"), col(valid_from).alias("__t"), F.lit(1 if strict else 0).alias("__side"),
        F.struct(*columns([valid_from]), *columns([c for c in rest if c != valid_from])).alias("__v"))
    # equal (key, time) of many left rows spread by a number of their own
    united = (rows.withColumn("__n", F.monotonically_increasing_id())
              .unionByName(valid.withColumn("__n", F.lit(0).cast("long")), allowMissingColumns=True))
    order = [F.col(c) for c in ("__key", "__t", "__side", "__v", "__n")]
    ranged = materialize(united.repartitionByRange(partitions, *order).withColumn("__part", F.spark_partition_id()))

    here = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("__v").isNotNull(), F.struct("__key", "__v"))
    filled = ranged.withColumn("__seen", F.last(mark, ignorenulls=True).over(here)).filter(F.col("__l").isNotNull())
    # one row a partition: the last version in it, then the last of all before
    ends = ranged.groupBy("__part").agg(F.max(mark).alias("__end"))
    before = ends.select("__part", F.max("__end").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
    got = filled.join(F.broadcast(before), "__part", "left").withColumn("__best", F.coalesce("__seen", "__before"))
    version = F.when(F.col("__best.__key") == F.col("__key"), F.col("__best.__v"))
    return got.select(*[F.col("__l").getField(c).alias(c) for c in left.columns],
                      *[version.getField(c).alias(c) for c in rest])
