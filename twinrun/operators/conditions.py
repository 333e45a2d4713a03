"""Which condition on the source's attributes explains the differences.

A list of unwanted rows does not say why they differ.  ``explain`` takes rows
with attributes and a flag (an unwanted difference or not) and searches the
conjunctions ``attribute = value and ...`` for those that gather the flagged
rows, ranked by the exact risk ratio: how much more often a row is flagged
inside the condition than outside.

Level by level, all attribute sets of a level are one ``GROUPING SETS``
aggregation (partial sums before the shuffle, so a frequent value costs one
row per task).  A conjunction holds at most as many flagged rows as each of
its parts, so values below ``share`` of them are dropped before the next
level, and sets without values left are not grouped.  Every condition kept
has at least ``share`` of the flagged rows, so a level keeps at most
(number of its attribute sets) / ``share`` conditions, whatever the data: only
those reach the driver, as codes for the next level's plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import SchemaMismatch, check_columns, col, columns
from ..sources.pin import materialize


def explain(rows: DataFrame, flag: str, attributes: Sequence[str], depth: int = 2,
            share: float = 0.05) -> DataFrame:
    """One row per condition of up to ``depth`` attributes that holds for at
    least ``share`` of the flagged rows:

    ``place`` (1 is the best), ``condition`` (text), ``n_attributes``, ``n_rows``
    (rows it holds for), ``n_flagged``, ``risk_ratio`` (null where no flagged row
    is left outside, which ranks first, or where no row at all is) and
    ``covers_all`` (no flagged row is left outside).

    Order: risk ratio, share of flagged rows inside, flagged rows, fewer
    attributes, condition.  A null value is a value (``x is null``); a null flag
    counts as not flagged.  Without flagged rows the result is empty."""
    attributes = list(attributes)
    check_columns(rows, "rows")
    if missing := [c for c in [flag, *attributes] if c not in rows.columns]:
        raise SchemaMismatch(f"rows lack columns {missing}")
    if not 0 < share <= 1 or depth < 1 or not attributes:
        raise ValueError("explain needs attributes, a depth of at least 1 and a share above 0")
    bad = F.coalesce(col(flag), F.lit(False)).cast("int")
    text = [F.when(col(a).isNotNull(), F.concat(F.lit(f"{a} = "), col(a).cast("string"))).otherwise(
        F.lit(f"{a} is null")).alias(f"__a{i}") for i, a in enumerate(attributes)]
    held = materialize(rows.select(*text, bad.alias("__bad")))
    total = held.agg(F.count("*").alias("n"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad")).first()
    least = max(1, -int(-(share * total["bad"]) // 1))
    names = [f"__a{i}" for i in range(len(attributes))]

    def level(df: DataFrame, sets: list[tuple[str, ...]], kept) -> DataFrame:
        """Conditions of the given attribute sets with enough flagged rows."""
        grouped = (df.groupingSets([columns(s) for s in sets], *columns(names))
                   .agg(F.grouping_id().alias("__set"), F.count("*").alias("n_rows"), F.sum("__bad").alias("n_flagged"))
                   .filter((F.col("n_flagged") >= least) & kept))
        return materialize(grouped.select(*names, "n_rows", "n_flagged"))

    found = [level(held, [(c,) for c in names], F.lit(True))]
    values = {c: sorted(r[0] for r in found[0].filter(col(c).isNotNull()).select(c).collect()) for c in names}
    useful = [c for c in names if values[c]]
    # from here on an attribute is the number of its value among those kept, 0 for all others
    code = {c: reduce(lambda w, kv: w.when(col(c) == kv[1], kv[0]), enumerate(values[c], 1), F.when(F.lit(False), 0)).otherwise(0)
            for c in useful}
    coded = held.select(*[(code[c] if c in code else F.lit(0)).alias(c) for c in names], "__bad")
    # the null check is needed: element_at of an array of literals takes a null index for a number
    decoded = [F.when(col(c).isNotNull(), F.element_at(F.array(*[F.lit(v) for v in values[c]]), col(c))).alias(c)
               if values[c] else F.lit(None).cast("string").alias(c) for c in names]
    sets = [(c,) for c in useful]
    for n in range(2, min(depth, len(useful)) + 1):
        held_sets = set(sets)
        sets = [s for s in combinations(useful, n) if all(tuple(x for x in s if x != c) in held_sets for c in s)]
        if not sets:
            break
        inside = reduce(lambda a, b: a & b, [F.coalesce(col(c) > 0, F.lit(True)) for c in names])
        next_level = level(coded, sets, inside)
        found.append(next_level.select(*decoded, "n_rows", "n_flagged"))
        shapes = next_level.select(*[col(c).isNotNull().alias(c) for c in names]).distinct().collect()
        sets = [tuple(c for c in names if r[c]) for r in shapes]

    out = reduce(DataFrame.unionByName, found)
    outside, flagged_outside = F.lit(total["n"]) - F.col("n_rows"), F.lit(total["bad"]) - F.col("n_flagged")
    exact = lambda c: c.cast("double")
    ratio = F.when((flagged_outside > 0) & (outside > 0),
                   exact(F.col("n_flagged")) * exact(outside) / (exact(flagged_outside) * exact(F.col("n_rows"))))
    out = out.select(
        F.concat_ws(" and ", *columns(names)).alias("condition"),
        reduce(lambda a, b: a + b, [col(c).isNotNull().cast("long") for c in names]).alias("n_attributes"),
        F.col("n_rows").cast("long"), F.col("n_flagged").cast("long"), ratio.alias("risk_ratio"),
        (flagged_outside == 0).alias("covers_all"))
    everywhere = F.col("n_rows") == total["n"]  # says nothing, so it comes last
    best = Window.orderBy(  # a bounded number of conditions, see above
        everywhere, F.col("covers_all").desc(), F.col("risk_ratio").desc_nulls_last(),
        (exact(F.col("n_flagged")) / exact(F.col("n_rows"))).desc(), F.col("n_flagged").desc(), "n_attributes", "condition")
    return out.withColumn("place", F.row_number().over(best).cast("long")).select("place", *out.columns)
