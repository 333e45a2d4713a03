"""Versions of a table-valued query, and how to run them over history.

A *version* is any callable ``fn(tables, params) -> DataFrame``: ``tables``
maps names to the frozen history, ``params`` holds one row per parameter
value (e.g. per document version).  The result must carry the parameter
columns, so the results of all calls live in one DataFrame and one Spark
plan answers every parameter at once, instead of one job per parameter.

Three ways to write a version:

* a Python function building DataFrame code;
* :func:`sql_version`: SQL text with ``{params}`` and ``{<table>}``
  placeholders, bound through ``spark.sql(text, **dataframes)``;
* :class:`StagedVersion`: named steps, each fed the previous step's result,
  so that two versions can be compared step by step (see
  ``operators.stages``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .lineage import marked_result, plan_nodes
from .schema import SchemaMismatch, col, columns


class LossyFunction(ValueError):
    """A SQL table function whose body would lose rows when called laterally."""


Tables = Mapping[str, DataFrame]
Version = Callable[[Tables, DataFrame], DataFrame]


def param_set(source: DataFrame, cols: Sequence[str] | Mapping[str, str],
              where=None, freeze: bool = False) -> DataFrame:
    """O2: the parameter values to replay, unique on the parameter columns.

    ``cols`` is a list of source columns or a mapping ``source -> name``.
    ``where`` (Column or SQL text) limits history, e.g. to a date range; it
    is applied before the projection so it reaches the parquet scan.

    ``freeze`` saves the set once as a table in the shared folder named by
    ``spark.checkpoint.dir`` (``sources.pin.materialize``).  Every version
    then replays exactly the same values, and the joins on the parameter
    read a plain shuffle: with the ``distinct`` aggregate in between,
    adaptive execution cannot split the partition of a document that holds
    a large share of all rows.
    """
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    df = source if where is None else source.filter(where)
    out = df.select(*[col(s).alias(t) for s, t in mapping.items()]).distinct()
    if freeze:
        from ..sources.pin import materialize
        out = materialize(out)
    return out


def replay(fn: Version, tables: Tables, params: DataFrame) -> DataFrame:
    """Rows of ``fn`` for every parameter value in ``params`` at once."""
    out = fn(tables, params)
    missing = [c for c in params.columns if c not in out.columns]
    if missing:
        raise SchemaMismatch(
            f"a version must return its parameter columns; missing {missing}")
    return marked_result(out)


#: parts of the parameter set, at most, and rows of history for each of fewer
PARTS, PART_ROWS = 16, 2_000_000


def in_parts(params: DataFrame, rows: int, run: Callable[[DataFrame], DataFrame],
             most: int = PARTS, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows of ``run(params)``, one part of the parameter set after the other.

    For steps that save more than the disk should hold at once: a part's result
    is saved, and all else that ``run`` saves for it is deleted before the next.
    ``rows`` of history make a part for every ``part_rows``, at most ``most``, so
    the history is scanned a bounded number of times.  ``run`` must give each
    parameter value its rows whatever the others are, as ``replay`` does; a
    value lies in one part, by the hash of its columns, nulls included.
    """
    from ..sources.pin import materialize, scratch
    spark, parts = params.sparkSession, max(1, min(most, -(-rows // part_rows)))
    part = F.pmod(F.xxhash64(F.lit("part"), *columns(params.columns)), F.lit(parts))
    out = []
    for i in range(parts):
        path = shared_path(spark, "part")
        with scratch(spark):
            out.append(materialize(run(params if parts == 1 else params.filter(part == i)), path))
    return reduce(DataFrame.unionByName, out)


def one_param(source: DataFrame, **values) -> DataFrame:
    """A parameter frame of one row holding ``values``, with the types that
    the columns of those names have in ``source`` (a schema is all that is
    read of it)."""
    if not values:
        raise SchemaMismatch("a call needs at least one parameter value")
    types = {f.name: f.dataType for f in source.schema.fields}
    unknown = [k for k in values if k not in types]
    if unknown:
        raise SchemaMismatch(f"{unknown} are not parameter columns {source.columns}")
    return source.sparkSession.range(1).select(
        *[F.lit(v).cast(types[k]).alias(k) for k, v in values.items()])


def call_one(fn: Version, tables: Tables, params: DataFrame, **values) -> DataFrame:
    """O3: rows of ``fn`` for one parameter value.

    Written as the replay over the parameter set narrowed to ``values``, so
    the law ``call_one(fn, k) == replay(fn, all).filter(param == k)`` holds by
    construction, and Catalyst carries the literal down to the scans.  For a
    value that need not be looked up in history, replay over ``one_param``.
    A null value is the null parameter.
    """
    if not values:
        raise SchemaMismatch("a call needs at least one parameter value")
    unknown = [k for k in values if k not in params.columns]
    if unknown:
        raise SchemaMismatch(f"{unknown} are not parameter columns {params.columns}")
    cond = reduce(lambda a, b: a & b,
                  [col(k).isNull() if v is None else col(k) == F.lit(v) for k, v in values.items()])
    return replay(fn, tables, params.filter(cond))


def sql_version(text: str) -> Version:
    """A version written in SQL: ``{params}`` and ``{<table>}`` are bound to
    the parameter set and history DataFrames (``spark.sql`` formatting)."""

    def fn(tables: Tables, params: DataFrame) -> DataFrame:
        spark = params.sparkSession
        return spark.sql(text, params=params, **dict(tables))

    fn.__name__ = "sql_version"
    return fn


def sql_function_version(function_name: str, param_cols: Sequence[str]) -> Version:
    """A version that calls a registered SQL table function laterally.

    Register the function first, e.g. ``CREATE TEMPORARY FUNCTION f(k BIGINT)
    RETURNS TABLE (...) RETURN SELECT ...``; its output must include the
    parameter columns.  A function with a ``LIMIT`` in its body is refused
    (:class:`LossyFunction`): Spark plans that limit over the whole join, not
    per call, and rows would be lost (see tests/test_traps.py).  Rank with
    ``top_n_per`` instead.  Meant for small sets: Spark plans the call as one
    run over all of history joined back to the parameters, about twice the
    exchanges of a version written as a set.
    """
    args = ", ".join(f"p.`{c}`" for c in param_cols)

    def fn(tables: Tables, params: DataFrame) -> DataFrame:
        spark = params.sparkSession
        _refuse_limit(spark, function_name, params.select(*columns(list(param_cols))))
        return spark.sql(
            f"SELECT f.* FROM {{params}} p, LATERAL {function_name}({args}) f",
            params=params)

    fn.__name__ = f"sql_function_version[{function_name}]"
    return fn


def _refuse_limit(spark, function_name: str, params: DataFrame) -> None:
    """Analyse one call on a row of nulls, so that any limit in the plan is
    the function's own (nothing runs)."""
    nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in params.schema.fields)
    names = ", ".join(f"c{i}" for i in range(len(params.columns)))
    args = ", ".join(f"p.c{i}" for i in range(len(params.columns)))
    probe = spark.sql(f"SELECT f.* FROM VALUES ({nulls}) AS p({names}), LATERAL {function_name}({args}) f")
    # the lateral call itself is a subquery of the plan
    found = sorted(LIMITS & {node.getClass().getSimpleName() for node in plan_nodes(probe)})
    if found:
        raise LossyFunction(
            f"{function_name} holds a LIMIT or OFFSET ({', '.join(found)}); called laterally it would limit the "
            "whole join and lose rows. Rank per parameter with top_n_per instead")


#: classes of plan nodes that keep some rows of all
LIMITS = {"GlobalLimit", "LocalLimit", "Tail", "Offset"}


@dataclass(frozen=True)
class Stage:
    """One named step: ``fn(tables, params, previous) -> DataFrame``.

    Every stage's output must carry the parameter columns so that stages can
    be compared per parameter value.
    """
    name: str
    fn: Callable[[Tables, DataFrame, DataFrame | None], DataFrame]


def sql_stage(name: str, text: str) -> Stage:
    """A step written in SQL: ``{prev}`` is the previous step's result,
    ``{params}`` the parameter set and ``{<table>}`` a history table."""

    def step(tables: Tables, params: DataFrame, prev: DataFrame | None) -> DataFrame:
        frames = dict(tables, params=params)
        if prev is not None:
            frames["prev"] = prev
        return params.sparkSession.sql(text, **frames)

    return Stage(name, step)


class StagedVersion:
    """A version decomposed into named steps; calling it runs all steps."""

    def __init__(self, stages: Sequence[Stage], name: str = "staged"):
        if not stages:
            raise ValueError("a staged version needs at least one stage")
        self.stages = list(stages)
        self.__name__ = name

    def run_stages(self, tables: Tables, params: DataFrame) -> list[tuple[str, DataFrame]]:
        out, prev = [], None
        for st in self.stages:
            prev = st.fn(tables, params, prev)
            out.append((st.name, prev))
        return out

    def __call__(self, tables: Tables, params: DataFrame) -> DataFrame:
        return self.run_stages(tables, params)[-1][1]


def as_version(v) -> Version:
    """Accept a callable version or SQL text."""
    if isinstance(v, str):
        return sql_version(v)
    if callable(v):
        return v
    raise TypeError(f"not a version: {v!r}")
