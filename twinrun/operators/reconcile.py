"""Per parameter value, row counts and sums of measures, old against new.

A cheap summary beside the row diff: equal sums do not prove equal rows,
but unequal ones locate the documents worth reading.  Written as one
aggregation over old ∪ new grouped by the parameter columns (conditional
counts and sums), so a document holding a third of all rows is folded by
the map-side partial aggregate before the shuffle.

Floating-point measures are refused: their sums depend on partitioning,
so equal versions would seem to differ.  Cast them to a decimal first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import SchemaMismatch, check_keys, col, columns

_SIDE = "__side"


def _sum_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.DecimalType):
        return T.DecimalType(38, dt.scale)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    raise SchemaMismatch(
        f"measure of type {dt.simpleString()} cannot be summed exactly; "
        "cast it to a decimal first")


def reconcile(old: DataFrame, new: DataFrame, param_cols: Sequence[str],
              measures: Sequence[str] = (), only_diff: bool = True) -> DataFrame:
    """Columns: params, ``rows_old``, ``rows_new``, then ``<m>_old``,
    ``<m>_new`` per measure (sums; decimals widened to precision 38)."""
    params = list(param_cols)
    check_keys(old, params, "old")
    check_keys(new, params, "new")
    types = {f.name: f.dataType for f in old.schema.fields}
    for m in measures:
        if m not in types or m not in new.columns:
            raise SchemaMismatch(f"measure {m!r} missing from a side")
    sum_t = {m: _sum_type(types[m]) for m in measures}

    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.select(*columns(params), *[col(m).cast(sum_t[m]).alias(m) for m in measures],
                         F.lit(tag).alias(_SIDE))

    u = side(old, 1).unionByName(side(new, 2))
    s = F.col(_SIDE)
    aggs = [F.count_if(s == 1).alias("rows_old"), F.count_if(s == 2).alias("rows_new")]
    for m in measures:
        aggs += [F.sum(F.when(s == 1, col(m))).cast(sum_t[m]).alias(f"{m}_old"),
                 F.sum(F.when(s == 2, col(m))).cast(sum_t[m]).alias(f"{m}_new")]
    g = u.groupBy(*columns(params)).agg(*aggs)
    if only_diff:
        cond = F.col("rows_old") != F.col("rows_new")
        for m in measures:
            cond = cond | ~col(f"{m}_old").eqNullSafe(col(f"{m}_new"))
        g = g.filter(cond)
    return g
