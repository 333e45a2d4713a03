"""Replay paths: the production path (procedure over the table function)
and the test path (two versions over the same history, compared).

Every function here only builds DataFrames; nothing is collected except the
one-row verdict in :meth:`Comparison.report`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import check_same_schema, row_hash
from ..functions.table_fn import Tables, Version, as_version, replay
from ..operators.diff import column_changes, diff_cells, diff_rows
from ..operators.reconcile import reconcile
from ..operators.situations import split_diff, tag_diff
from ..operators.stages import diff_stages
from ..operators.verdict import (CELLS, check_expected, expected_summary, in_replay, uncovered_keys,
                                 verdict)
from ..session import shared_path
from ..sources.pin import discard, materialize

Finish = Callable[[DataFrame, Tables], DataFrame]


def run_procedure(fn: Version, tables: Tables, params: DataFrame, finish: Finish) -> DataFrame:
    """The procedure step that consumes the table function's rows for all
    parameter values and makes the final result (``DataFrame.transform``
    chain: replay, then the caller's ``finish``)."""
    return replay(as_version(fn), tables, params).transform(lambda r: finish(r, tables))


def replay_pair(old: Version, new: Version, tables: Tables,
                params: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both versions over the same frozen history and parameters, with
    the schema contract checked before any row is compared."""
    a = replay(as_version(old), tables, params)
    b = replay(as_version(new), tables, params)
    check_same_schema(a, b)
    return a, b


def _laid_out_anew(df: DataFrame, turn: int) -> DataFrame:
    """The same rows in other partitions and another order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + turn
    h = F.xxhash64(row_hash(df), F.lit(turn))
    return df.repartition(parts, h).sortWithinPartitions(h)


def repeatability(fn: Version, tables: Tables, params: DataFrame) -> DataFrame:
    """Run one version twice, in separate jobs and on inputs laid out anew,
    and count differing rows.

    A version with an unstable order (``row_number`` or ``first`` over
    ties, ``collect_list``) can give other rows whenever its input arrives in
    another order, and then every comparison against it is noise.  The first
    run is saved to the shared folder; the second reads every table and the
    parameters by other partitions, in another order.  One row: ``rows``,
    ``rows_differing``, ``stable``.
    """
    fn = as_version(fn)
    first = materialize(replay(fn, tables, params))
    again = replay(fn, {n: _laid_out_anew(t, 3) for n, t in tables.items()}, _laid_out_anew(params, 5))
    d = diff_rows(first, again)
    u = (first.select(F.lit(1).alias("r"), F.lit(0).alias("d"))
         .unionByName(d.select(F.lit(0).alias("r"), F.abs(F.col("net")).cast("int").alias("d"))))
    return u.agg(F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("rows"),
                 F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("rows_differing"),
                 (F.coalesce(F.sum("d"), F.lit(0)) == 0).alias("stable"))


class Comparison:
    """The test path over one pair of versions.

    ``keys`` identify a result row (unique per side) and ``situations`` are
    the keys where a difference is wanted, at width ``on`` (defaults to the
    situation columns).  ``finish(rows, tables)`` compares at the procedure:
    it is applied to both versions' rows, and keys, situations and expected
    values are then those of its result.  Situations and expected values are
    limited to the replayed parameters where they have parameter columns.

    Call :meth:`materialize` before running several actions: it saves both
    results once in the shared folder, until :meth:`close` (or the end of a
    ``with`` block) deletes them.
    """

    def __init__(self, old: Version, new: Version, tables: Tables, params: DataFrame,
                 keys: Sequence[str], situations: DataFrame | None = None,
                 on: Sequence[str] | None = None, finish: Finish | None = None):
        self.tables = tables
        self.params = params
        self.keys = list(keys)
        self.situations = None if situations is None else in_replay(situations, params)
        self.on = list(on) if on is not None else (
            list(situations.columns) if situations is not None else None)
        self.versions = (old, new)
        self.old, self.new = replay_pair(old, new, tables, params)
        if finish is not None:
            self.old, self.new = finish(self.old, tables), finish(self.new, tables)
            check_same_schema(self.old, self.new)
        self._saved: list[str] = []

    def __enter__(self) -> Comparison:
        return self

    def __exit__(self, *_exc) -> None:
        self.close()

    def materialize(self) -> Comparison:
        spark = self.params.sparkSession
        paths = [shared_path(spark, "materialized") for _ in range(2)]
        self.old = materialize(self.old, paths[0])
        self.new = materialize(self.new, paths[1])
        self._saved += paths
        return self

    def close(self) -> None:
        """Delete what :meth:`materialize` saved."""
        while self._saved:
            discard(self.params.sparkSession, self._saved.pop())

    def diff(self) -> DataFrame:
        return diff_rows(self.old, self.new)

    def tagged_diff(self) -> DataFrame:
        return tag_diff(self.diff(), self._sit(), self.on)

    def split(self) -> tuple[DataFrame, DataFrame]:
        return split_diff(self.diff(), self._sit(), self.on)

    def cells(self, include_same: bool = False) -> DataFrame:
        return diff_cells(self.old, self.new, self.keys, include_same=include_same)

    def column_changes(self) -> DataFrame:
        return column_changes(self.old, self.new, self.keys)

    def stage_parity(self, param_cols: Sequence[str] | None = None,
                     match: Mapping[str, str] | None = None) -> DataFrame:
        """First differing step per parameter value (see ``diff_stages``)."""
        return diff_stages(*self.versions, self.tables, self.params, param_cols, match)

    def verdict(self) -> DataFrame:
        return verdict(self.old, self.new, self._sit(), self.keys, self.on)

    def reconcile(self, param_cols: Sequence[str], measures: Sequence[str]) -> DataFrame:
        return reconcile(self.old, self.new, param_cols, measures)

    def check_expected(self, expected: DataFrame) -> DataFrame:
        return check_expected(self.new, in_replay(expected, self.params), self.keys, self.situations, self.on)

    def uncovered(self, expected: DataFrame) -> DataFrame:
        return uncovered_keys(self.new, in_replay(expected, self.params), self.keys, self.situations, self.on)

    def expected_summary(self, expected: DataFrame) -> DataFrame:
        return expected_summary(self.new, in_replay(expected, self.params), self.keys, self.situations, self.on)

    def repeatable(self) -> bool:
        """Whether both versions give the same rows on inputs laid out anew."""
        return all(repeatability(v, self.tables, self.params).first()["stable"] for v in self.versions)

    def report(self, expected: DataFrame | None = None, repeat: bool = False) -> dict:
        """Verdict cells, expected-value counts and one answer, as a dict; the
        only rows brought to the driver are the one-row summaries.

        ``fixed``: some key was checked, none is wrong, and every situation
        key of the replay has an expected value.  ``passed``: nothing
        regressed, nothing is unfixed, and what was asked for holds (``fixed``
        with ``expected``, ``repeatable`` with ``repeat``)."""
        row = self.verdict().first()
        out = {c: int(row[c]) for c in CELLS}
        out["no_new_errors"] = out["regressed"] == 0
        passed = out["no_new_errors"] and out["unfixed"] == 0
        if expected is not None:
            e = self.expected_summary(expected).first()
            out.update({c: int(e[c]) for c in ("keys_checked", "keys_wrong", "keys_uncovered")})
            out["fixed"] = out["keys_checked"] > 0 and out["keys_wrong"] == out["keys_uncovered"] == 0
            passed = passed and out["fixed"]
        if repeat:
            out["repeatable"] = self.repeatable()
            passed = passed and out["repeatable"]
        out["passed"] = passed
        return out

    def _sit(self) -> DataFrame:
        if self.situations is None:
            raise ValueError("this comparison has no situations")
        return self.situations

