"""The source rows behind a differing row.

A cell diff shows two values; ``source_rows`` shows the rows of history that
either version made them from.  A version must return its parameter columns,
so whatever is given as a row's parameter value goes through all its joins
and aggregates.  Every source row of the differing documents is therefore
replayed as a document of its own, its row id being the parameter value: the
keys that come out under a row id are those the row goes into, per version.
That is one set-wise replay of each version over the differing documents'
rows, linear in their number.

What is found is then checked by replaying, again all keys at once:

* *enough*: a key's rows alone give both versions' rows of that key again;
* *needed*: without the rows of the differing keys no such key differs.

A version whose rows decide together (``having count(*) > 1``) fails the check
for the keys concerned.  These get all rows of their document, and
``exact`` is false: a set that is too large, never one that lacks a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import fresh_join
from ..functions.schema import SchemaMismatch, check_columns, col, columns
from ..functions.table_fn import Tables, Version, as_version, replay
from ..sources.pin import materialize
from .diff import STATUS, diff_rows, key_compare


@dataclass(frozen=True)
class Origins:
    """``rows``: per differing key and source row the keys, ``row`` (a struct, as
    it was read), ``in_old`` and ``in_new`` (the row goes into that version's
    result; both null where ``exact`` is false).  ``summary``: per differing key
    ``status``, ``rows_old``, ``rows_new`` and ``exact``."""
    rows: DataFrame
    summary: DataFrame


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A null-safe join on ``keys``; the right side's copies of them are dropped."""
    r = right.select(*[col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
                     *columns([c for c in right.columns if c not in keys]))
    cond = reduce(lambda a, b: a & b, [col(k, left).eqNullSafe(r[f"__r{i}"]) for i, k in enumerate(keys)])
    return left.join(r, cond, how).drop(*[f"__r{i}" for i in range(len(keys))])


def source_rows(old: Version, new: Version, tables: Tables, params: DataFrame, keys: Sequence[str],
                table: str, column: str, along: Mapping[str, str] | None = None) -> Origins:
    """The rows of ``table`` (whose parameter column is ``column``) behind every
    key that is not the same in both versions.

    ``along`` maps further tables that the versions read by the parameter to
    their parameter columns; each source row is replayed beside all their
    rows of its document, so name small ones only.  Other tables are read
    whole.  ``keys`` hold the one parameter column (a long or a string) and
    are unique on each side.

    Null parameter values are left out (equality joins meet none), other null
    keys are keys.  Repeated source rows are rows of their own.  Without
    differences both results are empty."""
    old, new, keys, along = as_version(old), as_version(new), list(keys), dict(along or {})
    if len(params.columns) != 1 or params.columns[0] not in keys:
        raise SchemaMismatch("source_rows needs one parameter column, and it among the keys")
    name, kind = params.columns[0], params.schema[0].dataType
    if not isinstance(kind, (T.LongType, T.StringType)):
        raise SchemaMismatch(f"parameter {name} must be a long or a string, not {kind.simpleString()}")
    if missing := [t for t in [table, *along] if t not in tables]:
        raise SchemaMismatch(f"unknown tables {missing}")
    check_columns(tables[table], table)
    sub = [k for k in keys if k != name]
    a, b = replay(old, tables, params), replay(new, tables, params)

    # the differing keys, each with a parameter value of its own, and their documents
    wanted = materialize(key_compare(a, b, keys).filter((F.col(STATUS) != "same") & col(name).isNotNull())
                         .withColumn("__k", F.monotonically_increasing_id().cast(kind)))
    docs = materialize(wanted.select(col(name).alias("__p")).distinct())

    def own(t: str, c: str) -> DataFrame:
        """The differing documents' rows of a table."""
        held = tables[t].select(col(c).alias("__p"), F.struct(*columns(tables[t].columns)).alias("__row"))
        return fresh_join(held, docs, ["__p"], "left_semi")

    held = materialize(own(table, column).withColumn("__q", F.monotonically_increasing_id().cast(kind)))
    beside = {t: materialize(own(t, c)) for t, c in along.items()}

    def replayed(version: Version, mine: DataFrame, at: DataFrame) -> DataFrame:
        """The version on rows ``mine`` (``__q`` is their parameter value);
        ``at`` maps those values to documents."""
        copies = dict(tables)
        copies[table] = _under(mine, tables[table].columns, column)
        for t, c in along.items():
            copies[t] = _under(fresh_join(beside[t], at, ["__p"]), tables[t].columns, c)
        return replay(version, copies, at.select(col("__q").alias(name)))

    # each row as a document of its own
    ids = held.select("__p", "__q")
    met = (replayed(old, held, ids).select(col(name).alias("__q"), *columns(sub), F.lit(True).alias("in_old"), F.lit(False).alias("in_new"))
           .unionByName(replayed(new, held, ids).select(
               col(name).alias("__q"), *columns(sub), F.lit(False).alias("in_old"), F.lit(True).alias("in_new")))
           .groupBy("__q", *columns(sub)).agg(F.max("in_old").alias("in_old"), F.max("in_new").alias("in_new")))
    found = fresh_join(met, ids, ["__q"]).withColumnRenamed("__p", name)
    links = materialize(_same_keys(found, wanted.select(*columns(keys), "__k"), keys, "inner")
                        .select("__k", "__q", "in_old", "in_new"))

    # enough: a key's rows alone give its rows of both versions again
    alone = fresh_join(links.select(F.col("__k").alias("__to"), "__q"), held.select("__q", "__row"), ["__q"])
    alone = materialize(alone.select(F.col("__to").alias("__q"), "__row"))
    at = wanted.select(col(name).alias("__p"), col("__k").alias("__q"))
    lacking = []
    for version in (old, new):
        whole = replay(version, tables, docs.select(col("__p").alias(name)))
        names = [c for c in whole.columns if c != name]
        before = _same_keys(whole, wanted.select(*columns(keys), "__k"), keys, "inner")
        before = before.select(col("__k").alias(name), *columns(names))
        again = _same_keys(replayed(version, alone, at), wanted.select(col("__k").alias(name), *columns(sub)),
                           [name, *sub], "left_semi").select(name, *columns(names))
        lacking.append(diff_rows(before, again).select(col(name).alias("__k")))

    # needed: without all these rows none of the keys differs
    rest = fresh_join(held, links.select("__q").distinct(), ["__q"], "left_anti").select(col("__p").alias("__q"), "__row")
    here = docs.select("__p", F.col("__p").alias("__q"))
    still = (key_compare(replayed(old, rest, here), replayed(new, rest, here), keys)
             .filter(F.col(STATUS) != "same").select(*columns(keys)))
    lacking.append(_same_keys(wanted.select(*columns(keys), "__k"), still, keys, "left_semi").select("__k"))

    unsure = materialize(reduce(DataFrame.unionByName, lacking).distinct())
    judged = materialize(wanted.join(unsure.withColumn("__u", F.lit(True)), "__k", "left")
                         .withColumn("exact", F.col("__u").isNull()).drop("__u"))
    known = fresh_join(links, judged.filter("exact").select("__k"), ["__k"], "left_semi")
    all_of = fresh_join(held, judged.filter("not exact").select(col(name).alias("__p"), "__k"), ["__p"])
    none = F.lit(None).cast("boolean")
    behind = materialize(known.unionByName(all_of.select("__k", "__q", none.alias("in_old"), none.alias("in_new"))))

    rows = fresh_join(fresh_join(behind, held.select("__q", F.col("__row").alias("row")), ["__q"]),
                      judged.select("__k", *columns(keys), "exact"), ["__k"])
    counts = behind.groupBy("__k").agg(F.count_if(F.coalesce("in_old", F.lit(True))).alias("rows_old"),
                                       F.count_if(F.coalesce("in_new", F.lit(True))).alias("rows_new"))
    zero = F.lit(0).cast("long")
    summary = judged.join(counts, "__k", "left").select(
        *columns(keys), F.col(STATUS), F.coalesce("rows_old", zero).alias("rows_old"),
        F.coalesce("rows_new", zero).alias("rows_new"), "exact")
    return Origins(rows.select(*columns(keys), "row", "in_old", "in_new", "exact"), summary)


def _under(rows: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    """A table's rows (``__row``) under the parameter value ``__q``."""
    return rows.select(*[(F.col("__q") if c == column else F.col("__row").getField(c)).alias(c) for c in names])
