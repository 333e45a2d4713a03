"""O1: a frozen view of the historical tables.

``spark.read.parquet`` lists the files once, when the DataFrame is made, so
both versions replayed from the same ``tables`` mapping read exactly the
same files even if the live table grows meanwhile.  Column pruning and
filter pushdown reach the scan through Catalyst; nothing is read here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load_history(spark: SparkSession, root: str, names: Iterable[str] = TABLES,
                 fmt: str = "parquet",
                 schemas: Mapping[str, StructType] | None = None) -> dict[str, DataFrame]:
    """Map each table name to a DataFrame over ``{root}/{name}.{fmt}``
    (a file or a directory of part files).

    A known schema (``schemas[name]``) skips schema inference, which for
    parquet is a Spark job reading file footers; the file list itself is
    always taken fresh, once, here.
    """
    root = root.rstrip("/")
    schemas = schemas or {}
    out = {}
    for n in names:
        reader = spark.read.format(fmt)
        if n in schemas:
            reader = reader.schema(schemas[n])
        out[n] = reader.load(f"{root}/{n}.{fmt}")
    return out


def snapshot_history(tables: Mapping[str, DataFrame], path: str,
                     mode: str = "errorifexists") -> dict[str, DataFrame]:
    """Copy live tables to ``path`` (shared storage) and read the copy back,
    for sources that may change between the two replays (JDBC, tables that
    are appended to).  Returns the frozen mapping."""
    out = {}
    for n, df in tables.items():
        target = f"{path.rstrip('/')}/{n}"
        df.write.mode(mode).parquet(target)
        out[n] = df.sparkSession.read.parquet(target)
    return out


def history_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as (``table_name``, ``n_rows``): a record of what was
    replayed.  Parquet answers ``count`` from footers."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
