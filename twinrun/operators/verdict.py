"""The verdict (O10) and the expected-value check.

Verdict cells, per key of old ∪ new ∪ situations:

=====================  ==============  ============
                       result changed  result same
=====================  ==============  ============
key in a situation     ``intended``    ``unfixed``
key elsewhere          ``regressed``   ``matched``
=====================  ==============  ============

"No new errors" holds when ``regressed == 0``.  "Error fixed" needs
:func:`check_expected` as well: a changed value can still be wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import SchemaMismatch, check_keys, col, columns
from .diff import ABSENT, STATUS, cells, key_compare

CELLS = ("intended", "unfixed", "regressed", "matched")


def in_replay(df: DataFrame, params: DataFrame) -> DataFrame:
    """``df`` (situations, expected values) limited to the replayed parameter
    values: a null-safe left-semi join on the parameter columns it has.  With
    none of them it is returned as it is."""
    shared = [c for c in params.columns if c in df.columns]
    if not shared:
        return df
    p = params.select(*[col(c).alias(f"__p_{i}") for i, c in enumerate(shared)])
    return df.join(p, [col(c, df).eqNullSafe(p[f"__p_{i}"]) for i, c in enumerate(shared)], "left_semi")


def verdict(old: DataFrame, new: DataFrame, sit: DataFrame, keys: Sequence[str],
            on: Sequence[str] | None = None) -> DataFrame:
    """One row ``intended, unfixed, regressed, matched`` (bigint).

    A situation key that neither result has counts as ``unfixed``: if the
    defect is a missing row, a fix that still does not make it shows here.
    When the situations are keyed like the results (``on`` equal to
    ``keys``), the whole verdict is one aggregation over
    old ∪ new ∪ situations grouped by key, then a one-row count; wider ones
    add one aggregation per ``on``, without a join.  Limit the
    situations to the replayed parameters first (``in_replay``).
    """
    counts = _status_counts(old, new, keys, sit, on)
    changed = F.col("added") + F.col("removed") + F.col("changed")
    same = F.col("same") + F.col(ABSENT)
    return _totals(counts, {
        "intended": (F.lit(True), changed), "unfixed": (F.lit(True), same),
        "regressed": (F.lit(False), changed), "matched": (F.lit(False), same)})


STATUSES = ("added", "removed", "changed", "same", ABSENT)


def per_situation(old: DataFrame, new: DataFrame, keys: Sequence[str], sit: DataFrame,
                  on: Sequence[str]) -> DataFrame:
    """Per value of ``on`` (in the results or the situations): ``in_situation`` and
    how many keys have each status.

    Situations as wide as the keys are part of ``key_compare``'s aggregation.
    Wider ones are aggregated together with the keys' statuses: a wide
    situation that no key meets counts as one ``absent``, both versions run
    once, and a hot document sends one row per task."""
    keys, on = list(keys), list(on)
    if set(on) == set(keys):
        kc = key_compare(old, new, keys, situations=sit, on=on)
        return kc.select(*columns(on), "in_situation", *[
            F.when(F.col(STATUS) == s, 1).otherwise(0).cast("long").alias(s) for s in STATUSES])
    check_keys(sit, on, "situations")
    if missing := [c for c in on if c not in keys]:
        raise SchemaMismatch(f"situation columns {missing} are not among the keys {keys}")
    kc = key_compare(old, new, keys).select(*columns(on), STATUS, F.lit(False).alias("in_situation"))
    wide = sit.select(*columns(on), F.lit(ABSENT).alias(STATUS), F.lit(True).alias("in_situation"))
    met = F.col("added") + F.col("removed") + F.col("changed") + F.col("same")
    per_on = kc.unionByName(wide).groupBy(*columns(on)).agg(
        *[F.count_if(F.col(STATUS) == s).alias(s) for s in STATUSES], F.max("in_situation").alias("in_situation"))
    return per_on.withColumn(ABSENT, F.when(met == 0, 1).otherwise(0).cast("long"))


def _status_counts(old: DataFrame, new: DataFrame, keys: Sequence[str], sit: DataFrame | None,
                   on: Sequence[str] | None) -> DataFrame:
    """``in_situation`` and counts of keys per status, in rows to be added up;
    without situations every key counts as in one."""
    if sit is None:
        return key_compare(old, new, list(keys)).agg(
            *[F.count_if(F.col(STATUS) == s).alias(s) for s in STATUSES]).withColumn("in_situation", F.lit(True))
    return per_situation(old, new, keys, sit, on if on is not None else sit.columns)


def _totals(counts: DataFrame, parts: dict) -> DataFrame:
    """One row: per name, the sum of a count over rows in or outside situations."""
    return counts.agg(*[
        F.coalesce(F.sum(F.when(F.col("in_situation") == inside, n)), F.lit(0)).cast("long").alias(name)
        for name, (inside, n) in parts.items()])


def _check_expected_columns(actual: DataFrame, expected: DataFrame, keys: Sequence[str]) -> None:
    check_keys(expected, keys, "expected")
    missing = [c for c in expected.columns if c not in actual.columns]
    if missing:
        raise SchemaMismatch(f"actual result lacks expected columns {missing}")


def _against_expected(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
                      sit: DataFrame | None, on: Sequence[str] | None,
                      values: str | None = None) -> DataFrame:
    """``key_compare`` of expected against actual values, within the situations."""
    _check_expected_columns(actual, expected, keys)
    kc = key_compare(expected, actual.select(*columns(expected.columns)), keys,
                     situations=sit, on=on, values=values)
    return kc if sit is None else kc.filter("in_situation")


def check_expected(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
                   sit: DataFrame | None = None,
                   on: Sequence[str] | None = None) -> DataFrame:
    """Keys whose actual value is not the expected one.

    ``expected`` holds the right answer for the keys it covers (e.g. derived
    from the source tables by an invariant).  Only ``expected``'s columns are
    compared, with ``sit`` only at situation keys.  A covered key missing
    from ``actual`` is wrong (``removed``).  Keys that ``expected`` does not
    cover are neither right nor wrong: see :func:`uncovered_keys`.
    """
    kc = _against_expected(actual, expected, keys, sit, on, values="differing")
    vals = [c for c in expected.columns if c not in list(keys)]
    return cells(kc.filter(F.col(STATUS).isin("changed", "removed")), keys, vals, ("expected", "actual"))


def uncovered_keys(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
                   sit: DataFrame | None = None,
                   on: Sequence[str] | None = None) -> DataFrame:
    """Keys without an expected value: those of ``actual`` (within the
    situations), and situation keys that neither has.  Key columns only."""
    kc = _against_expected(actual, expected, keys, sit, on)
    return kc.filter(F.col(STATUS).isin("added", ABSENT)).select(*columns(keys))


def expected_summary(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
                     sit: DataFrame | None = None,
                     on: Sequence[str] | None = None) -> DataFrame:
    """One row: ``keys_checked`` (keys with an expected value),
    ``keys_wrong`` (keys :func:`check_expected` would report) and
    ``keys_uncovered`` (keys :func:`uncovered_keys` would)."""
    _check_expected_columns(actual, expected, keys)
    counts = _status_counts(expected, actual.select(*columns(expected.columns)), keys, sit, on)
    inside = F.lit(True)
    return _totals(counts, {
        "keys_checked": (inside, F.col("same") + F.col("changed") + F.col("removed")),
        "keys_wrong": (inside, F.col("changed") + F.col("removed")),
        "keys_uncovered": (inside, F.col("added") + F.col(ABSENT))})
