"""A part of history that is enough: a sequential exact test per stratum.

The whole history stays the default (``verdict``).  Where even one replay of
it is dear, ``bounded`` answers a smaller question: is the rate of documents
with an unwanted difference at most ``most``, in every stratum?  Documents are
taken in the order of a hash of the parameter value (so no sort, and
reruns agree), each stratum by its own share, and only strata still open are
replayed further.  After each look the binomial tails at ``most`` are exact:

* ``bounded``: so few regressed documents have a chance of at most the look's
  error were the rate above ``most``;
* ``exceeded``: so many, were it at most ``most``;
* ``counted``: the stratum was replayed whole; the rate is then known.

Look j of a stratum may spend ``error / (strata * 2 ** (j + 1))`` on either side,
so over all looks and strata each kind of wrong answer has a chance of at
most ``error``.  Documents are drawn without replacement, for which binomial
tails are safe.  A look doubles the part; nearly all work is in the last.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import fresh_join
from ..functions.schema import SchemaMismatch, col, columns
from ..functions.table_fn import Tables, Version, as_version, replay
from ..sources.pin import materialize
from .diff import diff_rows
from .situations import split_diff

#: the hash has 32 bits
FULL = 1 << 32
#: strata are counted on the driver: more are refused
MAX_STRATA = 1000


def place(name: str, seed: int) -> Column:
    """The parameter value's place in the order, 0 to ``FULL`` - 1."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(col(name).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def tail(k: int, n: int, p: float, upper: bool) -> float:
    """P(X >= k) for k above the mean, P(X <= k) for k below it, of a binomial
    X: terms fall from k on, and the sum ends when they add nothing."""
    total, steps = 0.0, range(k, n + 1) if upper else range(k, -1, -1)
    for i in steps:
        term = math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                        + i * math.log(p) + (n - i) * math.log1p(-p))
        total += term
        if term <= total * 1e-17:
            break
    return total


def answer(n: int, regressed: int, size: int, most: float, error: float) -> str | None:
    """What ``n`` of ``size`` documents with ``regressed`` bad ones prove."""
    if n >= size:
        return "counted"
    mean = n * most  # on the far side of it a tail is at least a half
    if regressed < mean and tail(regressed, n, most, upper=False) <= error:
        return "bounded"
    if regressed > mean and tail(regressed, n, most, upper=True) <= error:
        return "exceeded"
    return None


def first_share(size: int, most: float, error: float) -> int:
    """The first look's part of the order: about a quarter more documents
    than prove the bound when none is bad."""
    enough = math.ceil(math.log(error) / math.log1p(-most))
    return min(FULL, enough * 5 * (FULL >> 2) // max(size, 1) + 1)


def bounded(old: Version, new: Version, tables: Tables, params: DataFrame, situations: DataFrame,
            on: Sequence[str], strata: DataFrame, most: float = 0.01, error: float = 0.05,
            seed: int = 0, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per stratum: the columns of ``strata`` other than the parameter's,
    ``documents`` (its size), ``looks``, ``replayed``, ``regressed`` (documents
    replayed with an unwanted difference) and ``answer``.

    ``strata`` gives the stratum of every parameter value (missing values form
    a stratum of nulls; a value in two strata counts in both).  ``situations`` at
    width ``on`` say which differences are wanted.  ``keep`` is applied to the
    unwanted differences before they are counted.  Null parameter values are
    documents like others.  An empty history has no strata."""
    names = params.columns
    groups = [c for c in strata.columns if c not in names]
    if len(names) != 1 or names[0] not in strata.columns or not groups:
        raise SchemaMismatch("bounded needs one parameter column and strata by it")
    if not (0 < most < 1 and 0 < error < 1):
        raise ValueError("most and error lie between 0 and 1")
    old, new, spark, name = as_version(old), as_version(new), params.sparkSession, names[0]
    held = materialize(fresh_join(params, strata.select(name, *columns(groups)).distinct(), [name], "left")
                       .withColumn("__at", place(name, seed)))
    sizes = held.groupBy(*columns(groups)).agg(F.count("*").alias("documents"))
    situations = materialize(situations)  # made from the whole history: once, not at every look
    rows = sizes.limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise SchemaMismatch(f"more than {MAX_STRATA} strata")
    state = [{"g": tuple(r[g] for g in groups), "documents": r["documents"], "looks": 0, "replayed": 0,
              "regressed": 0, "answer": None, "from": 0, "to": first_share(r["documents"], most, error / (2 * len(rows)))}
             for r in sorted(rows, key=lambda r: repr(tuple(r[g] for g in groups)))]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sizes.schema.fields if f.name in groups)

    while todo := [s for s in state if s["answer"] is None]:
        parts = spark.createDataFrame([(*s["g"], s["from"], s["to"]) for s in todo], f"{shape}, __from long, __to long")
        cond = (F.col("__at") >= F.col("__from")) & (F.col("__at") < F.col("__to"))
        for g in groups:
            cond = cond & col(g, held).eqNullSafe(col(g, parts))
        batch = materialize(held.join(F.broadcast(parts), cond, "left_semi"))  # at most MAX_STRATA rows
        now = batch.select(name).distinct()
        diff = diff_rows(replay(old, tables, now), replay(new, tables, now))
        unwanted = split_diff(diff, situations, list(on))[1]
        bad = (unwanted if keep is None else keep(unwanted)).select(name).distinct().withColumn("__bad", F.lit(1))
        flagged = batch.join(bad, col(name, batch).eqNullSafe(col(name, bad)), "left").drop(col(name, bad))
        counts = {tuple(r[g] for g in groups): r for r in flagged.groupBy(*columns(groups)).agg(
            F.count("*").alias("n"), F.count("__bad").alias("bad")).collect()}
        for s in todo:
            r = counts.get(s["g"])
            s["replayed"] += r["n"] if r else 0
            s["regressed"] += r["bad"] if r else 0
            s["answer"] = answer(s["replayed"], s["regressed"], s["documents"], most,
                                 error / (len(state) * 2 ** (s["looks"] + 1)))
            s["looks"] += 1
            s["from"], s["to"] = s["to"], min(FULL, 2 * s["to"])
    return spark.createDataFrame(
        [(*s["g"], s["documents"], s["looks"], s["replayed"], s["regressed"], s["answer"]) for s in state],
        f"{shape}, documents long, looks long, replayed long, regressed long, answer string")
