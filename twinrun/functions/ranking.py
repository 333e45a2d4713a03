"""Top rows per group: the safe replacement for ``ORDER BY ... LIMIT n``
inside a table function.

A SQL table function ending in ``LIMIT`` and called laterally limits the
whole join, not each call (see tests/test_traps.py).  Per-parameter "first
n rows" is a ranking per group instead.  Spark limits each group before the
shuffle (a partial ``WindowGroupLimit``, for n up to 1000), so of a hot group
at most n rows per task are shuffled.  Every column is appended to the
ordering as a final tie-break, so the result does not depend on the order
rows arrive in (a replay must be repeatable).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .schema import col, columns, comparable


def top_n_per(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each ``by`` group under ``order`` (ties broken
    by the remaining columns, ascending).  Keeps ``df``'s columns."""
    if n < 1:
        raise ValueError("n must be at least 1")
    by = list(by)
    named = {c for c in order if isinstance(c, str)}
    types = {f.name: f.dataType for f in df.schema.fields}
    tie = [comparable(col(c), types[c]).asc_nulls_first()
           for c in df.columns if c not in by and c not in named]
    ranked = Window.partitionBy(*columns(by)).orderBy(
        *[col(c) if isinstance(c, str) else c for c in order], *tie)
    return (df.withColumn("__rn", F.row_number().over(ranked))
            .filter(F.col("__rn") <= n).drop("__rn"))
