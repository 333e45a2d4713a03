"""The smallest history on which two versions still differ.

A diff says *that* documents differ.  To pin down the error one wants the
least input that makes it happen: ``shrink`` cuts every differing document's
rows down to a set of which no row can be left out.

Group testing in rounds.  A document's rows are dealt into ``PARTS`` parts by hash,
and every part and every two parts together are tried; where the difference
needs one or two rows, some candidate of half the rows or less still differs,
so each round halves them.  Up to ``PARTS`` rows are tried in all their subsets at
once, which ends the search.  Where no candidate differs, more rows are
needed together: the number of parts doubles and one part at a time is left
out, down to single rows.  A difference that needs two rows of n is so found in
O(log n) rounds, all documents at the same time.

A round is one set-wise replay of both versions, however many candidates there
are: every candidate gets a parameter value of its own, its rows are copied
under that value, and the versions run unchanged on the copies.  What reaches
the driver is the count of documents still open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import fresh_join
from ..functions.schema import SchemaMismatch, col, columns
from ..functions.table_fn import Tables, Version, as_version, replay
from ..sources.pin import materialize
from .diff import diff_rows

#: parts of a document that are tried one by one and in pairs; so many rows are tried in all subsets
PARTS = 4


@dataclass(frozen=True)
class Shrunk:
    """``rows``: per cut table the rows that are left, as they were read.
    ``summary``: per parameter value ``rows_before``, ``rows_left`` and ``minimal`` (no
    row can be left out; false only if ``max_rounds`` ended the search)."""
    rows: Mapping[str, DataFrame]
    summary: DataFrame


def differing(old: Version, new: Version, tables: Tables, params: DataFrame) -> DataFrame:
    """The parameter values whose results differ."""
    a, b = (replay(as_version(v), tables, params) for v in (old, new))
    return diff_rows(a, b).select(*columns(params.columns)).distinct()


def _candidates() -> list[tuple[int, int, int]]:
    """(mode, candidate, part): mode 0 has each part and every two of ``PARTS``;
    mode n all proper subsets of n single rows."""
    out = []
    for mode in range(PARTS + 1):
        sizes = (1, 2) if mode == 0 else range(1, mode)
        subsets = [c for n in sizes for c in combinations(range(mode or PARTS), n)]
        out += [(mode, i, part) for i, subset in enumerate(subsets) for part in subset]
    return out


def shrink(old: Version, new: Version, tables: Tables, params: DataFrame, owned: Mapping[str, str],
           along: Mapping[str, str] | None = None, max_rounds: int = 200) -> Shrunk:
    """Cut the rows of each differing document.

    ``owned`` maps the tables to cut to their parameter column, ``along`` those
    whose rows of the document always stay.  Every table that the versions
    read by the parameter must be in one of them; the others are read whole.
    ``params`` has one column, a long or a string.

    Null parameter values are left alone (equality joins meet none).
    Repeated rows are rows of their own.  Without differences all results are
    empty."""
    along = dict(along or {})
    if len(params.columns) != 1:
        raise SchemaMismatch("shrink needs one parameter column")
    name, kind = params.columns[0], params.schema[0].dataType
    if not isinstance(kind, (T.LongType, T.StringType)):
        raise SchemaMismatch(f"parameter {name} must be a long or a string, not {kind.simpleString()}")
    if missing := [t for t in [*owned, *along] if t not in tables]:
        raise SchemaMismatch(f"unknown tables {missing}")
    spark = params.sparkSession
    failing = materialize(differing(old, new, tables, params).filter(col(name).isNotNull())
                          .select(col(name).alias("__p")))

    def own(table: str, column: str) -> DataFrame:
        """The failing documents' rows, each with a frozen number."""
        df = tables[table]
        held = df.select(col(column).alias("__p"), F.struct(*columns(df.columns)).alias("__row"))
        return materialize(fresh_join(held, failing, ["__p"], "left_semi")
                           .withColumn("__rid", F.monotonically_increasing_id()))

    held = {t: own(t, c) for t, c in owned.items()}
    beside = {t: own(t, c) for t, c in along.items()}
    parts = reduce(DataFrame.unionByName, [
        df.select("__p", F.lit(t).alias("__t"), "__rid") for t, df in held.items()])
    state = materialize(parts.withColumn("__k", F.lit(PARTS)))  # rows still kept of documents still open
    before = materialize(parts.groupBy("__p").agg(F.count("*").alias("rows_before")))
    known = spark.createDataFrame(_candidates(), "__mode int, __c int, __part int")
    done = [state.limit(0).select("__p", "__t", "__rid")]

    for turn in range(max_rounds):
        sizes = state.groupBy("__p").agg(F.count("*").cast("int").alias("__n"))
        rows = fresh_join(state, sizes, ["__p"]).withColumn("__mode", F.when(F.col("__n") <= PARTS, F.col("__n"))
                                                            .when(F.col("__k") == PARTS, 0).otherwise(-1))
        single = F.col("__n") <= F.col("__k")
        # single rows are numbered (there are at most __k of a document), others dealt by hash
        few = rows.filter(single).withColumn("__part", F.row_number().over(
            Window.partitionBy("__p").orderBy("__t", "__rid")) - 1)
        many = rows.filter(~single).withColumn(
            "__part", F.pmod(F.xxhash64("__t", "__rid", F.lit(turn)), F.col("__k")).cast("int"))
        dealt = few.unionByName(many)
        all_but_one = F.filter(F.sequence(F.lit(0), F.least("__n", "__k") - 1), lambda c: c != F.col("__part"))
        tried = (dealt.filter("__mode >= 0").join(F.broadcast(known), ["__mode", "__part"])  # a fixed table
                 .unionByName(dealt.filter("__mode < 0").withColumn("__c", F.explode(all_but_one))))
        member = materialize(tried.select("__p", "__t", "__rid", "__k", "__n", "__mode", "__c"))
        candidates = materialize(
            member.groupBy("__p", "__c").agg(F.count("*").alias("__m"), F.first("__n").alias("__n"))
            .filter("__m < __n").select(F.struct("__p", "__c").alias("__pc"), "__p", "__m",
                                        F.monotonically_increasing_id().cast(kind).alias("__q")))
        member = member.withColumn("__pc", F.struct("__p", "__c"))

        copies = dict(tables)
        for t, c in owned.items():
            mine = fresh_join(member.filter(F.col("__t") == t).select("__pc", "__rid"),
                              candidates.select("__pc", "__q"), ["__pc"]).drop("__pc")
            copies[t] = _copied(held[t].join(mine, "__rid"), tables[t].columns, c)
        for t, c in along.items():
            copies[t] = _copied(fresh_join(candidates.select("__p", "__q"), beside[t], ["__p"]), tables[t].columns, c)
        fails = differing(old, new, copies, candidates.select(col("__q").alias(name))).select(col(name).alias("__q"))
        chosen = materialize(candidates.join(fails, "__q").groupBy("__p")
                             .agg(F.min(F.struct("__m", "__pc")).alias("b")).select("__p", "b.__pc"))
        # in all subsets tried, the smallest that differs is the end; so is the whole if none of its parts does
        smaller = fresh_join(member, chosen.select("__pc"), ["__pc"], "left_semi").withColumn("__over", F.col("__mode") > 0)
        stuck = (fresh_join(dealt, chosen.select("__p"), ["__p"], "left_anti")
                 .withColumn("__over", single).withColumn("__k", F.when(single, F.col("__k")).otherwise(F.col("__k") * 2)))
        kept = ["__p", "__t", "__rid", "__k", "__over"]
        after = materialize(smaller.select(*kept).unionByName(stuck.select(*kept)))
        done.append(after.filter("__over").select("__p", "__t", "__rid"))
        state = after.filter("not __over").drop("__over")
        if state.isEmpty():
            break

    left = materialize(reduce(DataFrame.unionByName, done).withColumn("minimal", F.lit(True)).unionByName(
        state.select("__p", "__t", "__rid").withColumn("minimal", F.lit(False))))
    summary = (before.join(left.groupBy("__p").agg(F.count("*").alias("rows_left"), F.min("minimal").alias("minimal")), "__p")
               .select(F.col("__p").alias(name), "rows_before", "rows_left", "minimal"))
    rows = {t: held[t].join(left.filter(F.col("__t") == t).select("__rid"), "__rid").select("__row.*") for t in owned}
    return Shrunk(rows, summary)


def _copied(rows: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    """A table's rows (``__row``) under their candidate's parameter value ``__q``."""
    return rows.select(*[
        (F.col("__q") if c == column else F.col("__row").getField(c)).alias(c) for c in names])
