"""The stand-in problem used by the fixtures, tests and bench.

It imitates the shape of the task (a table function per document version,
with a defect that shows in rare cases), not any real system's data:

* document version: ``o_orderkey`` (parameter column ``doc``);
* menu row: one product of one order: ``doc, prod, p_name, qty``;
* ``M(agg, cond)``: lines of the order (``lineitem`` joined to the
  replayed document versions, which are taken from ``orders``), filtered by
  ``cond``, grouped per product with ``agg`` of the quantity as
  ``decimal(18,2)``, then named from ``part``;
* rare situation: a product listed more than once in an order.

Each version is a :class:`StagedVersion` of three named steps, so two
versions can also be compared step by step (O15).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import fresh_join
from ..functions.table_fn import Stage, StagedVersion, Tables, param_set
from ..operators.situations import repeated

PARAM = "doc"
KEYS = ("doc", "prod")
QTY = "decimal(18,2)"
COST = "decimal(28,4)"
MOST, ERROR = 0.01, 0.05  # rate of regressed documents to bound, chance of a wrong answer
SHIPPED_BEFORE = "1998-05-01"  # about the middle of history


def params_of(tables: Tables, freeze: bool = True) -> DataFrame:
    """Every document version in history: distinct ``o_orderkey`` as
    ``doc``, frozen by default (see ``param_set``)."""
    return param_set(tables["orders"], {"o_orderkey": PARAM}, freeze=freeze)


def _lines(cond: Column | None):
    def step(t: Tables, params: DataFrame, _prev) -> DataFrame:
        # params are document versions drawn from orders and unique on doc,
        # so this join is the join with orders.  One join with exactly two
        # shuffled inputs is what adaptive execution can split when one
        # document holds a large share of all lines; a literal parameter
        # (one call) reaches the lineitem scan from here.
        p = params.select(PARAM)
        li = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity")
        if cond is not None:
            li = li.filter(cond)
        return (li.join(p, li["l_orderkey"] == p[PARAM])
                .select(p[PARAM], F.col("l_partkey").alias("prod"),
                        F.col("l_quantity").cast(QTY).alias("q")))
    return step


def _per_product(agg):
    def step(_t: Tables, _params: DataFrame, lines: DataFrame) -> DataFrame:
        return lines.groupBy(PARAM, "prod").agg(agg(F.col("q")).cast(QTY).alias("qty"))
    return step


def _menu(t: Tables, _params: DataFrame, per_product: DataFrame) -> DataFrame:
    part = t["part"].select(F.col("p_partkey").alias("prod"), "p_name")
    return per_product.join(part, "prod").select(PARAM, "prod", "p_name", "qty")


def menu_version(agg, cond: Column | None = None, name: str = "menu") -> StagedVersion:
    return StagedVersion([
        Stage("lines", _lines(cond)),
        Stage("per_product", _per_product(agg)),
        Stage("menu", _menu),
    ], name=name)


def old_version() -> StagedVersion:
    """The defect: of repeated lines only the largest quantity counts."""
    return menu_version(F.max, name="old")


def new_version() -> StagedVersion:
    """The fix: repeated lines add up."""
    return menu_version(F.sum, name="new")


def broken_version() -> StagedVersion:
    """A fix that also loses every line of quantity 1."""
    return menu_version(F.sum, F.col("l_quantity") > 1, name="broken")


def wrong_version() -> StagedVersion:
    """Touches only the rare cases, but gives them wrong values."""
    return menu_version(F.min, name="wrong")


VERSIONS = {"old": old_version, "new": new_version,
            "broken": broken_version, "wrong": wrong_version}


def situation_rule(tables: Tables) -> DataFrame:
    """Products listed more than once in an order, keyed like the menu."""
    return repeated(tables["lineitem"], {"l_orderkey": PARAM, "l_partkey": "prod"})


def expected_quantities(tables: Tables) -> DataFrame:
    """The right answer per (doc, prod): the plain sum from ``lineitem``."""
    return (tables["lineitem"]
            .groupBy(F.col("l_orderkey").alias(PARAM), F.col("l_partkey").alias("prod"))
            .agg(F.sum(F.col("l_quantity").cast(QTY)).cast(QTY).alias("qty")))


def procedure_cost(menu: DataFrame, tables: Tables) -> DataFrame:
    """The procedure's final result: per doc, sum of qty * retail price.

    The price lookup is the second join on the product in a row (the version
    already joined ``part``), so it gets exchanges of its own, which adaptive
    execution can split when one product is in a large share of all menus.
    """
    price = tables["part"].select(F.col("p_partkey").alias("prod"),
                                  F.col("p_retailprice").cast(QTY).alias("price"))
    return (fresh_join(menu, price, ["prod"])
            .groupBy(PARAM).agg(F.sum(F.col("qty") * F.col("price")).cast(COST).alias("cost")))


def expected_costs(tables: Tables) -> DataFrame:
    """The right answer per doc: price of every line, straight from the tables."""
    price = tables["part"].select(F.col("p_partkey").alias("l_partkey"),
                                  F.col("p_retailprice").cast(QTY).alias("price"))
    return (tables["lineitem"].join(price, "l_partkey")
            .groupBy(F.col("l_orderkey").alias(PARAM))
            .agg(F.sum(F.col("l_quantity").cast(QTY) * F.col("price")).cast(COST).alias("cost")))


def unstable_version(tables: Tables, params: DataFrame) -> DataFrame:
    """A planted fault: the "first" line of a document, by an order in which
    all lines are equal.  Which line that is depends on the layout of the data."""
    p = params.select(PARAM)
    li = tables["lineitem"].select("l_orderkey", F.col("l_partkey").alias("prod"))
    any_order = Window.partitionBy(PARAM).orderBy(F.lit(1))
    return (li.join(p, li["l_orderkey"] == p[PARAM])
            .withColumn("rn", F.row_number().over(any_order)).filter("rn = 1").select(PARAM, "prod"))


def one_block(tables: Tables, params: DataFrame) -> DataFrame:
    """The new version as one block, without named steps."""
    t, p = tables["lineitem"], params.select(PARAM)
    part = tables["part"].select(F.col("p_partkey").alias("prod"), "p_name")
    return (t.join(p, t["l_orderkey"] == p[PARAM]).withColumnRenamed("l_partkey", "prod").join(part, "prod")
            .groupBy(PARAM, "prod", "p_name")
            .agg(F.sum(F.col("l_quantity").cast(QTY)).cast(QTY).alias("qty"))
            .select(PARAM, "prod", "p_name", "qty"))


def four_steps() -> StagedVersion:
    """The broken version with the filter as a step of its own."""
    def large(t: Tables, _params: DataFrame, lines: DataFrame) -> DataFrame:
        return lines.filter("q > 1")

    return StagedVersion([Stage("lines", _lines(None)), Stage("large_lines", large),
                          Stage("per_product", _per_product(F.sum)), Stage("menu", _menu)], name="four")


def with_nulls(tables: Tables) -> Tables:
    """History in which lines of quantity 1 have no quantity."""
    q = F.col("l_quantity")
    return {**tables, "lineitem": tables["lineitem"].withColumn("l_quantity", F.when(q != 1, q))}


def with_repeats(tables: Tables) -> Tables:
    """History in which documents whose key three divides hold each line twice."""
    times = F.when(F.col("l_orderkey") % 3 == 0, 2).otherwise(1)
    li = tables["lineitem"]
    return {**tables, "lineitem": li.withColumn("__i", F.explode(F.sequence(F.lit(1), times))).drop("__i")}


def listing(cond: Column | None = None):
    """A version without grouping: a document's lines as they are, so its
    result can hold nulls and whole rows more than once."""
    def fn(tables: Tables, params: DataFrame) -> DataFrame:
        return _lines(cond)(tables, params, None)
    return fn


#: attributes of a line and its order that an unwanted difference may depend on
ATTRIBUTES = ("quantity", "returnflag", "linestatus", "discount_pct", "tax_pct", "linenumber", "ship_year",
              "orderstatus", "orderpriority")


def line_attributes(tables: Tables, flagged: DataFrame, flag: str) -> DataFrame:
    """Every line with its attributes; ``flag`` says whether its menu row is
    among the keys ``flagged``."""
    o = tables["orders"].select(F.col("o_orderkey").alias(PARAM), F.col("o_orderstatus").alias("orderstatus"),
                                F.col("o_orderpriority").alias("orderpriority"))
    percent = lambda c: F.round(F.col(c) * 100).cast("int")
    lines = tables["lineitem"].select(
        F.col("l_orderkey").alias(PARAM), F.col("l_partkey").alias("prod"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_returnflag").alias("returnflag"), F.col("l_linestatus").alias("linestatus"),
        percent("l_discount").alias("discount_pct"), percent("l_tax").alias("tax_pct"),
        F.col("l_linenumber").alias("linenumber"), F.year("l_shipdate").alias("ship_year"))
    return (lines.join(o, PARAM).join(flagged.select(*KEYS).distinct().withColumn(flag, F.lit(True)), list(KEYS), "left")
            .select(*ATTRIBUTES, F.coalesce(F.col(flag), F.lit(False)).alias(flag)))


def details(edited: bool):
    """A version without a key: a document's lines with supplier and flags.
    ``edited`` plants changes: quantity 1 becomes 101; of quantity 2 supplier
    and flag change; returned lines of quantity 3 are lost; lines of quantity
    4 with flag N come twice."""
    def fn(tables: Tables, params: DataFrame) -> DataFrame:
        p, q = params.select(PARAM), F.col("l_quantity")
        li = tables["lineitem"]
        rows = li.join(p, li["l_orderkey"] == p[PARAM])
        supp, flag, amount = F.col("l_suppkey"), F.col("l_returnflag"), q
        if edited:
            times = F.when((q == 3) & (flag == "R"), 0).when((q == 4) & (flag == "N"), 2).otherwise(1)
            rows = rows.withColumn("__i", F.explode(F.array_repeat(F.lit(1), times)))
            amount = F.when(q == 1, 101.0).otherwise(q)
            supp, flag = F.when(q == 2, supp + 1_000_000).otherwise(supp), F.when(q == 2, "X").otherwise(flag)
        return rows.select(p[PARAM], F.col("l_partkey").alias("prod"), supp.alias("supp"), flag.alias("flag"),
                           F.col("l_linestatus").alias("status"), amount.cast(QTY).alias("qty"))
    return fn


WIDE = 96  # derived columns of a wide result


def wide_listing(edited: bool):
    """A version of 100 columns: a document's lines with values derived from
    them.  ``edited`` changes the quantity of lines of quantity 1."""
    def fn(tables: Tables, params: DataFrame) -> DataFrame:
        p, q = params.select(PARAM), F.col("l_quantity")
        li = tables["lineitem"]
        rows = li.join(p, li["l_orderkey"] == p[PARAM])
        derived = [F.expr(f"(l_partkey * {i + 1} + l_suppkey) % 997 AS c{i}") for i in range(WIDE)]
        amount = F.when(q == 1, 101.0).otherwise(q) if edited else q
        return rows.select(p[PARAM], F.col("l_partkey").alias("prod"), F.col("l_linenumber").alias("line"),
                           amount.cast(QTY).alias("qty"), *derived)
    return fn
