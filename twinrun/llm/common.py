"""Helpers shared by the operators: word pattern, row keys, saved tables,
and a global running total that never sorts in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schema import columns, comparable_columns
from ..sources.pin import materialize

# Fixed values of the query contracts: the white space set and the words it separates.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: a table of at most this many (narrow) rows may be broadcast; larger ones are shuffled
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, **options: str) -> DataFrame:
    """Written once to the shared folder and read back (cuts lineage; a lost
    executor costs no recomputation, and row ids given before are frozen).
    ``options`` are those of Spark's parquet writer."""
    return materialize(df, **options)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is.  ``lower`` is only
    used where all characters are ASCII, where it does the same, faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def row_key(*cols: Column) -> tuple[Column, Column]:
    """A 128-bit key of the given values, null-safe: two differently seeded
    64-bit hashes over each value and its null flag."""
    parts = [p for c in cols for p in (c.isNull(), c)]
    return F.xxhash64(F.lit("row"), *parts), F.xxhash64(F.lit("key"), *parts)


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join with a table that is unique on ``keys``: broadcast when its
    counted rows are at most BROADCAST_ROWS, otherwise shuffled (adaptive
    execution splits hot keys).  ``small`` should be a saved table."""
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, list(keys), how)


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column]) -> DataFrame:
    """``df`` plus, per entry of ``totals``, the sum of that expression over
    all rows before this one in ``order`` (0 for the first).

    Rows are range-partitioned, saved with their partition number, summed
    per partition, and the partitions' offsets (one row each, so bounded by
    the number of partitions) are broadcast back: no step sees all rows.
    ``order`` should be total up to identical rows.
    """
    spark = df.sparkSession
    base_cols = df.columns
    keyed = df.select("*", *[o.alias(f"__o{i}") for i, o in enumerate(order)],
                      *[v.cast("long").alias(f"__v{i}") for i, v in enumerate(totals.values())])
    keys = [F.col(f"__o{i}").asc_nulls_last() for i in range(len(order))]
    ranged = saved(keyed.repartitionByRange(partitions(spark), *keys)
                   .withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy("__part").agg(
        *[F.sum(f"__v{i}").alias(f"__s{i}") for i in range(len(totals))])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("__part", *[
        F.coalesce(F.sum(f"__s{i}").over(before), F.lit(0)).alias(f"__b{i}")
        for i in range(len(totals))])
    here = (Window.partitionBy("__part").orderBy(*keys)
            .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged
            .select(*base_cols, "__part", *[
                F.coalesce(F.sum(f"__v{i}").over(here), F.lit(0)).alias(f"__l{i}")
                for i in range(len(totals))])
            .join(F.broadcast(bases), "__part")
            .select(*base_cols, *[(F.col(f"__b{i}") + F.col(f"__l{i}")).alias(n)
                                  for i, n in enumerate(totals)]))


def whole_row_key(df: DataFrame) -> tuple[Column, Column]:
    """``row_key`` over all columns: rows of equal key are the same row."""
    return row_key(*comparable_columns(df))


def rows_of(rows: DataFrame, key_cols: Sequence[str], keys: DataFrame) -> DataFrame:
    """Every row of a table whose key over ``key_cols`` is in ``keys`` (columns k1,
    k2), repeats included, with the table's own columns."""
    k1, k2 = row_key(*columns(key_cols))
    return lookup_join(rows.select(F.struct(*columns(rows.columns)).alias("__row"), k1.alias("k1"), k2.alias("k2")),
                       saved(keys.select("k1", "k2").distinct()), ["k1", "k2"], "left_semi").select("__row.*")


def one_row_each(rows: DataFrame, key_cols: Sequence[str], keys: DataFrame) -> DataFrame:
    """One row for each key of ``keys`` (columns k1, k2), with the table's own
    columns: of rows of equal key that with the smallest hash of all columns,
    so the choice does not depend on their order."""
    k1, k2 = row_key(*columns(key_cols))
    w1, w2 = whole_row_key(rows)
    return (rows.select(F.struct(*columns(rows.columns)).alias("__row"), k1.alias("k1"), k2.alias("k2"),
                        F.struct(w1.alias("a"), w2.alias("b")).alias("__w"))
            .join(keys.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
            .groupBy("k1", "k2").agg(F.min_by("__row", "__w").alias("__row"))  # repeats meet before the shuffle
            .select("__row.*"))
