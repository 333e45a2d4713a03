"""How wide an exemption may be: what each width of the situations hides.

Situations keyed as narrowly as the results excuse only their own keys.
Keyed by fewer columns (whole documents, say) they also excuse differences
that have nothing to do with them.  ``situation_widths`` measures this for
every set of the situation columns at once: the keys' statuses are
aggregated by all sets in one ``GROUPING SETS`` pass.  Partial aggregates fold
a hot document or product before the shuffle, and no versions are run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import SchemaMismatch, columns
from .verdict import per_situation

MAX_COLUMNS = 8


def situation_widths(old: DataFrame, new: DataFrame, sit: DataFrame, keys: Sequence[str],
                     on: Sequence[str] | None = None) -> DataFrame:
    """One row per non-empty set of the situation columns ``on``:

    ``width`` (the columns, comma-joined), ``n_columns``, ``keys_exempt`` (keys of
    old ∪ new that situations of that width excuse), ``intended`` (changed
    keys in a situation), ``hidden`` (changed keys that only the width
    excuses), ``regressed`` (changed keys still reported), and ``narrowest``: the
    one width that hides fewest changes, then excuses fewest keys, then has
    fewest columns.

    Keys must be unique per side, as for the verdict.  Nulls are values; a
    situation that no key meets excuses nothing."""
    on = list(on) if on is not None else list(sit.columns)
    if len(on) > MAX_COLUMNS:
        raise SchemaMismatch(f"{len(on)} situation columns have {2 ** len(on) - 1} widths; at most {MAX_COLUMNS} are searched")
    sets = [list(c) for n in range(1, len(on) + 1) for c in combinations(on, n)]
    changed = F.col("added") + F.col("removed") + F.col("changed")
    base = per_situation(old, new, list(keys), sit, on).select(
        *columns(on), "in_situation", changed.alias("__changed"), (changed + F.col("same")).alias("__keys"))
    excused = (base.groupingSets([columns(s) for s in sets], *columns(on))
               .agg(F.grouping_id().alias("__set"), F.max("in_situation").alias("__hit"),
                    F.sum("__keys").alias("__keys"), F.sum("__changed").alias("__changed"),
                    F.sum(F.when(F.col("in_situation"), F.col("__changed")).otherwise(0)).alias("__intended"))
               .groupBy("__set").agg(*[
                   F.coalesce(F.sum(F.when(F.col("__hit"), F.col(c))), F.lit(0)).cast("long").alias(c)
                   for c in ("__keys", "__changed", "__intended")],
                   F.sum("__changed").cast("long").alias("__all")))
    # grouping_id has a bit for each column that is left out, the first column's the highest
    names = {sum(1 << len(on) - 1 - i for i, c in enumerate(on) if c not in s): s for s in sets}
    of_set = lambda f: F.coalesce(*[F.when(F.col("__set") == k, F.lit(f(s))) for k, s in names.items()])
    out = excused.select(
        of_set(", ".join).alias("width"), of_set(len).cast("long").alias("n_columns"),
        F.col("__keys").alias("keys_exempt"), F.col("__intended").alias("intended"),
        (F.col("__changed") - F.col("__intended")).alias("hidden"),
        (F.col("__all") - F.col("__changed")).alias("regressed"))
    best = Window.orderBy("hidden", "keys_exempt", "n_columns", "width")  # at most 2 ** MAX_COLUMNS rows
    return out.withColumn("narrowest", F.row_number().over(best) == 1)
