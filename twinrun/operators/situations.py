"""The rare situations in which a difference is wanted, and the split of a
diff into wanted and unwanted rows.

A situation rule reads the *source* tables, never the diff: a rule derived
from the diff would excuse every difference.  Keep the rule as narrow as
the situation it describes; exempting whole documents hides unrelated
errors inside them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import check_independent
from ..functions.schema import check_keys, col, columns

WANTED = "wanted"


def situations(tables: Mapping[str, DataFrame],
               rule: Callable[[Mapping[str, DataFrame]], DataFrame] | str,
               also: Sequence[DataFrame] = ()) -> DataFrame:
    """Distinct keys of the situations, from a rule over the history.

    ``rule`` is a callable ``rule(tables) -> DataFrame`` or SQL text with
    ``{<table>}`` placeholders.  A rule that reads a version's result or a diff,
    saved or not, is refused (``DependentRule``), as is any other source than
    ``tables`` and those named in ``also`` (a list of keys made by hand, say).
    """
    if isinstance(rule, str):
        spark = next(iter(tables.values())).sparkSession
        df = spark.sql(rule, **dict(tables))
    else:
        df = rule(tables)
    check_independent(df, [*tables.values(), *also])
    return df.distinct()


def repeated(df: DataFrame, cols: Mapping[str, str] | Sequence[str],
             min_count: int = 2) -> DataFrame:
    """Rule helper: key values that occur at least ``min_count`` times.

    Grouped with a map-side partial count, so a hot key costs one row per
    map task in the shuffle.
    """
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    return (df.groupBy(*[col(s).alias(t) for s, t in mapping.items()])
            .count().filter(F.col("count") >= min_count).drop("count"))


def _situation_flags(sit: DataFrame, on: Sequence[str]) -> DataFrame:
    return (sit.select(*[col(c).alias(f"__s_{i}") for i, c in enumerate(on)]).distinct()
            .withColumn("__hit", F.lit(True)))


def tag_diff(diff: DataFrame, sit: DataFrame, on: Sequence[str]) -> DataFrame:
    """The diff with a boolean ``wanted`` column, in one left join."""
    on = list(on)
    check_keys(diff, on, "diff")
    check_keys(sit, on, "situations")
    s = _situation_flags(sit, on)
    cond = [col(c, diff).eqNullSafe(s[f"__s_{i}"]) for i, c in enumerate(on)]
    return (diff.join(s, cond, "left")
            .withColumn(WANTED, F.coalesce(F.col("__hit"), F.lit(False)))
            .select(*columns(diff.columns), WANTED))


def split_diff(diff: DataFrame, sit: DataFrame,
               on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(wanted, unwanted) rows of a diff: inside and outside the
    situations, by null-safe left-semi and left-anti join on ``on``."""
    on = list(on)
    check_keys(diff, on, "diff")
    check_keys(sit, on, "situations")
    s = sit.select(*[col(c).alias(f"__s_{i}") for i, c in enumerate(on)])
    cond = [col(c, diff).eqNullSafe(s[f"__s_{i}"]) for i, c in enumerate(on)]
    return diff.join(s, cond, "left_semi"), diff.join(s, cond, "left_anti")
