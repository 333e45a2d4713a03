"""Removed and added rows of results without a key, paired as changed rows.

Where no column set is unique, a changed row shows in the diff as one row
removed and one added.  ``match_rows`` pairs them: as many copies as possible
are paired, and among all such pairings the one with the least number of
changed cells is taken (minimum-cost matching).  Pairs have at most
``max_changed`` changed cells.

*Candidates.*  The columns are dealt into ``max_changed`` + 1 groups; a pair with at
most ``max_changed`` changed cells agrees on all of some group, so rows meet only
in blocks of equal values of a group, and no candidate is missed.  A block of
more than ``block_pairs`` pairs is split: rows that agree on its group have their
changed cells among the other columns, which are dealt into groups again.
Columns with many values are spread over the groups first.

*Matching.*  Candidates fall into connected parts, mostly single pairs, which
need no search.  A part of up to ``part_rows`` rows is matched exactly by
shortest augmenting paths in one task, with copies as capacities.  Larger
parts are paired in rounds of mutually best pairs, set-wise; and where too few
columns are left to split a hot block, its rows are dealt into smaller blocks
by hash.  Both keep every row, but the result is not proven least there:
``least`` is false for these rows.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import SchemaMismatch, col, columns, comparable
from ..sources.pin import materialize
from .diff import NET, diff_rows

BLOCK_PAIRS = 100_000
PART_ROWS = 600


def _key(names: Sequence[str]) -> Column:
    """One number for the values of some columns, nulls included.  A chance
    equality only makes a candidate, whose cells are compared."""
    parts = [p for c in names for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def _deal(names: Sequence[str], n: int) -> list[list[str]]:
    """``n`` groups of columns, dealt in turn; none if there are too few."""
    return [list(names[i::n]) for i in range(n)] if len(names) >= n else []


def _pairs(removed: DataFrame, added: DataFrame, names: Sequence[str], max_changed: int, proven: bool) -> DataFrame:
    """Rows of equal ``__k`` with at most ``max_changed`` changed cells."""
    a = added.select("__k", F.col("__rid").alias("__a"), F.struct(*columns(names)).alias("__va"))
    changed = reduce(lambda x, y: x + y, [
        (~F.col(c).eqNullSafe(F.col("__va").getField(c))).cast("int") for c in names])
    return (removed.join(a, "__k").select(F.col("__rid").alias("__r"), "__a", changed.alias("__changed"),
                                          F.lit(proven).alias("__proven"))
            .filter(F.col("__changed") <= max_changed))


def candidates(removed: DataFrame, added: DataFrame, names: Sequence[str], max_changed: int,
               block_pairs: int, fixed: Sequence[str] = ()) -> list[DataFrame]:
    """Candidate pairs (``__r``, ``__a``, ``__changed``, ``__proven``) of rows that agree on
    ``fixed``, in one table per group of columns and level."""
    left = [c for c in names if c not in fixed]
    groups = _deal(left, max_changed + 1)
    if not groups:  # any pair here is near enough: smaller blocks by hash
        n = F.ceil(F.sqrt(F.col("__size") / F.lit(float(block_pairs)))).cast("int")
        part = lambda df: df.withColumn("__k", F.xxhash64(
            *([_key(fixed)] if fixed else []), F.pmod(_key([*left, "__rid"]), F.greatest(n, F.lit(1)))))
        return [_pairs(part(removed), part(added), names, max_changed, False)]
    out = []
    for group in groups:
        key = _key([*fixed, *group])
        r, a = (df.drop("__size").withColumn("__k", key) for df in (removed, added))
        sizes = (r.groupBy("__k").agg(F.count("*").alias("__nr"))
                 .join(a.groupBy("__k").agg(F.count("*").alias("__na")), "__k")
                 .select("__k", (F.col("__nr").cast("double") * F.col("__na")).alias("__size")))
        sizes = materialize(sizes)
        cold, hot = sizes.filter(F.col("__size") <= block_pairs), sizes.filter(F.col("__size") > block_pairs)
        out.append(_pairs(r.join(cold, "__k"), a.join(cold.select("__k"), "__k"), names, max_changed, True))
        if not hot.isEmpty():
            inner = [materialize(df.join(hot, "__k").drop("__k")) for df in (r, a)]
            out += candidates(*inner, names, max_changed, block_pairs, [*fixed, *group])
    return out


def connected_parts(edges: DataFrame) -> DataFrame:
    """(``__node``, ``__part``): the smallest node that each node is connected with,
    by rounds of taking the smallest label around and then that label's own."""
    both = materialize(edges.select(F.col("__r").alias("__node"), F.col("__a").alias("__other")).unionByName(
        edges.select(F.col("__a").alias("__node"), F.col("__r").alias("__other"))))
    labels = materialize(both.groupBy("__node").agg(F.least(F.col("__node"), F.min("__other")).alias("__part")))
    while True:
        around = (both.join(labels.withColumnRenamed("__node", "__other"), "__other")
                  .groupBy("__node").agg(F.min("__part").alias("__near")))
        near = labels.join(around, "__node").select("__node", "__part", F.least("__part", "__near").alias("__near"))
        jump = labels.select(F.col("__node").alias("__near"), F.col("__part").alias("__far"))
        moved = materialize(near.join(jump, "__near").select("__node", F.col("__part").alias("__was"),
                                                             F.least("__near", "__far").alias("__part")))
        labels = moved.select("__node", "__part")
        if moved.filter("__part <> __was").isEmpty():
            return labels


def least_cost_flow(edges: list[tuple[int, int, int]], supply: dict[int, int], demand: dict[int, int]) -> dict[tuple[int, int], int]:
    """Copies of each pair (r, a): as many as possible, then of least total cost.

    Successive shortest augmenting paths with potentials; a path carries as
    many copies as its narrowest place.  Ties go to smaller numbers, so
    reruns agree."""
    near: dict[int, list[tuple[int, int]]] = {r: [] for r in supply}
    back: dict[int, list[tuple[int, int]]] = {a: [] for a in demand}
    for r, a, cost in sorted(edges):
        near[r].append((a, cost))
        back[a].append((r, cost))
    supply, demand, flow = dict(supply), dict(demand), {}
    height = {("r", r): 0 for r in supply} | {("a", a): 0 for a in demand}
    while True:
        cost = {("r", r): 0 - height["r", r] for r, n in supply.items() if n}
        start = min(cost.values(), default=0)
        cost = {k: v - start for k, v in cost.items()}  # reduced costs from a common source, none below 0
        came: dict = {k: None for k in cost}
        queue = [(v, *k) for k, v in cost.items()]
        heapq.heapify(queue)
        settled = {}
        while queue:
            d, side, x = heapq.heappop(queue)
            if (side, x) in settled:
                continue
            settled[side, x] = d
            steps = ([("a", a, c) for a, c in near[x]] if side == "r" else
                     [("r", r, -c) for r, c in back[x] if flow.get((r, x), 0)])
            for to, y, c in steps:
                new = d + c + height[side, x] - height[to, y]
                if (to, y) not in settled and new < cost.get((to, y), new + 1):
                    cost[to, y], came[to, y] = new, (side, x)
                    heapq.heappush(queue, (new, to, y))
        ends = [(settled["a", a] + height["a", a], a) for a, n in demand.items() if n and ("a", a) in settled]
        if not ends:
            return {pair: n for pair, n in flow.items() if n}
        far = max(settled.values())
        for k in height:
            height[k] += settled.get(k, far)
        end = min(ends)[1]
        path, at = [], ("a", end)
        while came[at] is not None:
            path.append((came[at], at))
            at = came[at]
        n = min([supply[at[1]], demand[end], *[flow[y, x] for (s, x), (_, y) in path if s == "a"]])
        for (s, x), (_, y) in path:
            pair = (x, y) if s == "r" else (y, x)
            flow[pair] = flow.get(pair, 0) + (n if s == "r" else -n)
        supply[at[1]] -= n
        demand[end] -= n


def _solve(key, rows):
    """One part: its edges with both rows' copies, as copies of each pair."""
    import pandas as pd
    edges = list(zip(rows["__r"], rows["__a"], rows["__changed"]))
    flow = least_cost_flow([tuple(map(int, e)) for e in edges], dict(zip(rows["__r"].map(int), rows["__nr"].map(int))),
                           dict(zip(rows["__a"].map(int), rows["__na"].map(int))))
    cost = {(int(r), int(a)): int(c) for r, a, c in edges}
    return pd.DataFrame([(r, a, cost[r, a], n) for (r, a), n in sorted(flow.items())],
                        columns=["__r", "__a", "__changed", "__n"])


def _mutually_best(edges: DataFrame) -> Iterator[DataFrame]:
    """Rounds over edges with copies (``__nr``, ``__na``): pairs that are each
    other's best, until no pair is left.  Edges have one order, so the first
    of them is always such a pair."""
    order = F.struct("__changed", F.xxhash64("__r", "__a").alias("h"), "__r", "__a")
    edges = materialize(edges.withColumn("__o", order))
    while not edges.isEmpty():
        best_r = edges.groupBy("__r").agg(F.min("__o").alias("__o")).select("__o")
        best_a = edges.groupBy("__a").agg(F.min("__o").alias("__o")).select("__o")
        taken = materialize(edges.join(best_r, "__o", "left_semi").join(best_a, "__o", "left_semi")
                            .select("__r", "__a", "__changed", F.least("__nr", "__na").alias("__n")))
        yield taken
        left = (edges.join(taken.select("__r", F.col("__n").alias("__ur")), "__r", "left")
                .join(taken.select("__a", F.col("__n").alias("__ua")), "__a", "left"))
        edges = materialize(left.withColumn("__nr", F.col("__nr") - F.coalesce("__ur", F.lit(0)))
                            .withColumn("__na", F.col("__na") - F.coalesce("__ua", F.lit(0)))
                            .filter("__nr > 0 and __na > 0").select(*edges.columns))


def match_rows(old: DataFrame, new: DataFrame, max_changed: int = 2, block_pairs: int = BLOCK_PAIRS,
               part_rows: int = PART_ROWS) -> DataFrame:
    """The diff of two results with its rows paired.

    One row per pair or unpaired row: ``match`` (paired, removed or added),
    ``copies``, ``cells_changed`` (null where unpaired), ``least`` (proven, see the
    module), then ``<column>_old`` and ``<column>_new`` for each column (null on the
    side that is missing).

    Nulls equal nulls; repeated rows are copies of one row and are paired as
    often as both sides have them; equal results give no rows."""
    d = diff_rows(old, new)
    names, kinds = old.columns, {f.name: f.dataType for f in old.schema.fields}
    if not 1 <= max_changed < len(names):
        raise SchemaMismatch(f"max_changed must be at least 1 and below the {len(names)} columns")
    cells = [f"__c{i}" for i in range(len(names))]
    rows = materialize(d.select(
        F.monotonically_increasing_id().alias("__rid"), F.col(NET).alias("__net"),
        F.struct(*columns(names)).alias("__row"),
        *[comparable(col(n), kinds[n]).alias(c) for n, c in zip(names, cells)]))
    removed, added = rows.filter("__net < 0").drop("__row"), rows.filter("__net > 0").drop("__row")
    kinds_of = removed.agg(*[F.approx_count_distinct(F.xxhash64(c)).alias(c) for c in cells]).first()
    by_kinds = sorted(cells, key=lambda c: -kinds_of[c])
    found = candidates(removed.withColumn("__size", F.lit(0.0)), added.withColumn("__size", F.lit(0.0)),
                       by_kinds, max_changed, block_pairs)
    copies = materialize(rows.select("__rid", F.abs("__net").alias("__n")))
    edges = reduce(DataFrame.unionByName, found).groupBy("__r", "__a").agg(
        F.first("__changed").alias("__changed"), F.max("__proven").alias("__proven"))
    edges = materialize(
        edges.join(copies.select(F.col("__rid").alias("__r"), F.col("__n").alias("__nr")), "__r")
        .join(copies.select(F.col("__rid").alias("__a"), F.col("__n").alias("__na")), "__a"))

    # pairs that have no one else need no search
    degree = lambda c: edges.groupBy(c).agg(F.count("*").alias(f"{c}_n"))
    marked = materialize(edges.join(degree("__r"), "__r").join(degree("__a"), "__a")
                         .withColumn("__alone", (F.col("__r_n") == 1) & (F.col("__a_n") == 1)).drop("__r_n", "__a_n"))
    alone = marked.filter("__alone").select("__r", "__a", "__changed", F.least("__nr", "__na").alias("__n"), "__proven")
    tied = marked.filter("not __alone")
    parts = connected_parts(tied)
    inside = materialize(tied.join(parts.withColumnRenamed("__node", "__r"), "__r"))
    size = parts.groupBy("__part").agg(F.count("*").alias("__rows"))
    proven = inside.groupBy("__part").agg(F.min("__proven").alias("__sure"), F.count("*").alias("__edges"))
    judged = size.join(proven, "__part").withColumn(
        "__small", (F.col("__rows") <= part_rows) & (F.col("__edges") <= part_rows * 40))
    inside = materialize(inside.join(judged.select("__part", "__small", "__sure"), "__part"))
    small = inside.filter("__small")
    kind = "__r long, __a long, __changed int, __n long"
    flows = [alone, small.groupBy("__part").applyInPandas(_solve, kind)
             .join(small.select("__r", "__a", F.col("__sure").alias("__proven")), ["__r", "__a"])]
    flows += [f.withColumn("__proven", F.lit(False)) for f in _mutually_best(inside.filter("not __small"))]
    pairs = materialize(reduce(DataFrame.unionByName, [f.select("__r", "__a", "__changed", "__n", "__proven") for f in flows]))

    used = (pairs.select(F.col("__r").alias("__rid"), "__n").unionByName(pairs.select(F.col("__a").alias("__rid"), "__n"))
            .groupBy("__rid").agg(F.sum("__n").alias("__used")))
    unsure = (marked.filter("not __proven").select(F.explode(F.array("__r", "__a")).alias("__rid"))
              .unionByName(inside.filter("not (__small and __sure)").select(F.explode(F.array("__r", "__a")).alias("__rid")))
              .distinct().withColumn("__unsure", F.lit(True)))
    rest = (rows.join(used, "__rid", "left").join(unsure, "__rid", "left")
            .withColumn("__left", F.abs("__net") - F.coalesce("__used", F.lit(0))).filter("__left > 0"))
    side = lambda row, sign: [row.getField(n).alias(f"{n}_{sign}") for n in names]
    both = (pairs.join(rows.select(F.col("__rid").alias("__r"), F.col("__row").alias("__ro")), "__r")
            .join(rows.select(F.col("__rid").alias("__a"), F.col("__row").alias("__rn")), "__a")
            .select(F.lit("paired").alias("match"), F.col("__n").alias("copies"), F.col("__changed").alias("cells_changed"),
                    F.col("__proven").alias("least"), "__ro", "__rn"))
    gone = F.col("__net") < 0
    one = rest.select(F.when(gone, "removed").otherwise("added").alias("match"), F.col("__left").alias("copies"),
                      F.lit(None).cast("int").alias("cells_changed"), F.col("__unsure").isNull().alias("least"),
                      F.when(gone, F.col("__row")).alias("__ro"), F.when(~gone, F.col("__row")).alias("__rn"))
    out = both.unionByName(one)
    return out.select("match", F.col("copies").cast("long").alias("copies"), "cells_changed", "least", *[
        c for o, n in zip(side(F.col("__ro"), "old"), side(F.col("__rn"), "new")) for c in (o, n)])


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package
