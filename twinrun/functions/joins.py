"""A join whose two sides are always shuffled on their own.

Adaptive execution splits a skewed sort-merge join only when both sides come
straight from a shuffle.  Two joins on the same key in a row (a version looks
up a name by product, then the procedure looks up the price by product) share
one shuffle, so a product that a third of all menus have would land in one
task.  ``fresh_join`` joins on the keys wrapped in a struct: the sides do not
count as partitioned on it, so each gets an exchange that can be split.  One
plan for every size, and nothing runs while it is built; a side that Spark
finds small enough is still broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import columns


def fresh_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``big.join(small, keys, how)`` (inner, left, left_semi or left_anti),
    with exchanges of its own on both sides."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("fresh_join supports inner, left, left_semi and left_anti joins")
    keys = list(keys)
    # null keys match nothing, as in the plain join: the struct is null then
    def wrapped():
        present = columns(keys)[0].isNotNull()
        for c in columns(keys[1:]):
            present = present & c.isNotNull()
        return F.when(present, F.struct(*columns(keys)))

    s = small.select(wrapped().alias("__key_small"), *columns([c for c in small.columns if c not in keys]))
    out = big.withColumn("__key_big", wrapped()).join(s, F.col("__key_big") == F.col("__key_small"), how)
    return out.drop("__key_big", "__key_small")
