"""The registered queries over the stand-in problem, one or more per
operator O1..O15.  Each takes ``(spark, sf_dir)`` and returns a DataFrame
whose columns match the DuckDB oracle in ``fixture_sql``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.asof import asof_join
from ..functions.lineage import DependentRule
from ..functions.ranking import top_n_per
from ..functions.table_fn import (in_parts, one_param, param_set, replay, sql_function_version,
                                  sql_version)
from ..operators.bounded import bounded
from ..operators.diff import column_changes, diff_cells, diff_rows
from ..operators.conditions import explain
from ..operators.digest import diff_by_digest
from ..operators.matching import match_rows
from ..operators.origins import source_rows
from ..operators.reconcile import reconcile
from ..operators.smallest import shrink
from ..operators.situations import situations, split_diff, tag_diff
from ..operators.stages import diff_stages
from ..operators.verdict import check_expected, expected_summary, verdict
from ..operators.width import situation_widths
from ..session import configure, shared_path, size_shuffles
from ..sources.history import TABLES, history_counts, load_history
from ..sources.pin import compare_to_bucketed_pin, compare_to_pin, materialize, pin, pin_bucketed
from . import standin as S
from .replay import Comparison, repeatability, replay_pair, run_procedure

Query = Callable[[SparkSession, str], DataFrame]

# The new version written as SQL text; {name} binds a DataFrame.
NEW_SQL = """
SELECT pr.doc AS doc, l.l_partkey AS prod, p.p_name AS p_name,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS qty
FROM {lineitem} l
JOIN {params} pr ON pr.doc = l.l_orderkey
JOIN {part} p ON p.p_partkey = l.l_partkey
GROUP BY pr.doc, l.l_partkey, p.p_name
"""

# The new version as a SQL table function of one document version.
NEW_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION twinrun_menu_new(k BIGINT)
RETURNS TABLE (doc BIGINT, prod BIGINT, p_name STRING, qty DECIMAL(18,2))
RETURN SELECT o.o_orderkey, l.l_partkey, p.p_name,
              CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2))
       FROM twinrun_orders o
       JOIN twinrun_lineitem l ON l.l_orderkey = o.o_orderkey
       JOIN twinrun_part p ON p.p_partkey = l.l_partkey
       WHERE o.o_orderkey = k
       GROUP BY o.o_orderkey, l.l_partkey, p.p_name
"""


#: the document version that the one-call queries ask for
ONE_DOC = 1


def _tables(spark: SparkSession, sf_dir: str, names=("orders", "lineitem", "part")):
    return load_history(spark, sf_dir, names)


def _sized(spark: SparkSession, sf_dir: str):
    """The tables, in a session whose shuffles have partitions for their rows."""
    configure(spark)
    t = _tables(spark, sf_dir)
    return t, size_shuffles(spark, t.values())


def _setup(spark: SparkSession, sf_dir: str):
    t, _ = _sized(spark, sf_dir)
    return t, S.params_of(t)


def _pair(spark, sf_dir, a: str, b: str):
    t, params = _setup(spark, sf_dir)
    return replay_pair(S.VERSIONS[a](), S.VERSIONS[b](), t, params)


def _sit(t):
    return situations(t, S.situation_rule)


def q_history_counts(spark, sf_dir):
    return history_counts(_tables(spark, sf_dir, TABLES))


def q_param_set(spark, sf_dir):
    t = _tables(spark, sf_dir, ("orders",))
    return param_set(t["orders"], {"o_orderkey": S.PARAM})


def q_table_fn_one(spark, sf_dir):
    configure(spark)
    t = _tables(spark, sf_dir)
    keys = t["orders"].withColumnRenamed("o_orderkey", S.PARAM)
    return replay(S.new_version(), t, one_param(keys, doc=ONE_DOC))


def _register_function(t) -> None:
    """History as prefixed temp views (never clobbering the caller's own
    views), then the SQL table function over them."""
    for n, df in t.items():
        df.createOrReplaceTempView(f"twinrun_{n}")
    next(iter(t.values())).sparkSession.sql(NEW_FUNCTION)


def q_table_fn_sql_one(spark, sf_dir):
    configure(spark)
    _register_function(_tables(spark, sf_dir))
    return spark.sql("SELECT * FROM twinrun_menu_new(:k)", args={"k": ONE_DOC})


def q_table_fn_replay(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return replay(S.new_version(), t, params)


def q_table_fn_sql(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return replay(sql_version(NEW_SQL), t, params)


def q_table_fn_lateral(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    _register_function(t)
    return replay(sql_function_version("twinrun_menu_new", [S.PARAM]), t, params)


def q_table_fn_top_product(spark, sf_dir):
    """Per document, the product with the largest quantity (a top-1 per
    parameter, written as a ranking instead of a LIMIT)."""
    t, params = _setup(spark, sf_dir)
    menu = replay(S.new_version(), t, params)
    return top_n_per(menu, [S.PARAM], [F.col("qty").desc()], n=1)


def q_procedure_cost(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return run_procedure(S.new_version(), t, params, S.procedure_cost)


def q_procedure_diff(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    a = run_procedure(S.old_version(), t, params, S.procedure_cost)
    b = run_procedure(S.new_version(), t, params, S.procedure_cost)
    return diff_cells(a, b, [S.PARAM])


def q_repeatability(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return repeatability(S.old_version(), t, params)


def q_repeatability_unstable(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return repeatability(S.unstable_version, t, params).select("rows", "stable")


def q_diff_rows_fix(spark, sf_dir):
    return diff_rows(*_pair(spark, sf_dir, "old", "new"))


def q_diff_rows_broken(spark, sf_dir):
    return diff_rows(*_pair(spark, sf_dir, "old", "broken"))


def q_situations(spark, sf_dir):
    return _sit(_tables(spark, sf_dir, ("lineitem",)))


def _broken_split(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    a, b = replay_pair(S.old_version(), S.broken_version(), t, params)
    return split_diff(diff_rows(a, b), _sit(t), list(S.KEYS))


def q_diff_wanted(spark, sf_dir):
    return _broken_split(spark, sf_dir)[0]


def q_diff_unwanted(spark, sf_dir):
    return _broken_split(spark, sf_dir)[1]


def q_diff_tagged(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    a, b = replay_pair(S.old_version(), S.broken_version(), t, params)
    return tag_diff(diff_rows(a, b), _sit(t), list(S.KEYS))


def _verdict(a: str, b: str, wide: bool = False) -> Query:
    def q(spark, sf_dir):
        t, params = _setup(spark, sf_dir)
        x, y = replay_pair(S.VERSIONS[a](), S.VERSIONS[b](), t, params)
        sit = _sit(t)
        if wide:
            return verdict(x, y, sit.select(S.PARAM), list(S.KEYS), on=[S.PARAM])
        return verdict(x, y, sit, list(S.KEYS))
    return q


def q_verdict_sql_fix(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    x, y = replay_pair(S.old_version(), sql_version(NEW_SQL), t, params)
    return verdict(x, y, _sit(t), list(S.KEYS))


def q_pin_compare(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    path = pin(replay(S.old_version(), t, params), shared_path(spark, "pins", "old"))
    return compare_to_pin(replay(S.new_version(), t, params), path)


def q_pin_bucketed(spark, sf_dir):
    t, parts = _sized(spark, sf_dir)
    params = S.params_of(t)
    path = pin_bucketed(replay(S.old_version(), t, params), shared_path(spark, "pins", "bucketed"),
                        buckets=max(16, parts), by=S.KEYS)
    return compare_to_bucketed_pin(replay(S.broken_version(), t, params), path)


def q_expected_check(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    act = replay(S.broken_version(), t, params)
    return check_expected(act, S.expected_quantities(t), list(S.KEYS), _sit(t))


def q_expected_summary(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    sit, exp = _sit(t), S.expected_quantities(t)
    parts = [expected_summary(replay(mk(), t, params), exp, list(S.KEYS), sit)
             .select(F.lit(name).alias("version"), "keys_checked", "keys_wrong", "keys_uncovered")
             for name, mk in S.VERSIONS.items()]
    return reduce(DataFrame.unionByName, parts)


def q_diff_cells(spark, sf_dir):
    return diff_cells(*_pair(spark, sf_dir, "old", "broken"), list(S.KEYS))


def q_column_changes(spark, sf_dir):
    return column_changes(*_pair(spark, sf_dir, "old", "broken"), list(S.KEYS))


def q_reconcile(spark, sf_dir):
    return reconcile(*_pair(spark, sf_dir, "old", "new"), [S.PARAM], ["qty"])


def _stages(b: str) -> Query:
    def q(spark, sf_dir):
        t, params = _setup(spark, sf_dir)
        return diff_stages(S.old_version(), S.VERSIONS[b](), t, params, [S.PARAM])
    return q


def q_stage_parity_refactor(spark, sf_dir):
    """One block against three steps, and three steps against four."""
    t, params = _setup(spark, sf_dir)
    block = diff_stages(S.one_block, S.broken_version(), t, params, [S.PARAM])
    four = diff_stages(S.broken_version(), S.four_steps(), t, params, [S.PARAM],
                       match={"lines": "large_lines", "per_product": "per_product"})
    drift = diff_stages(S.new_version(), S.four_steps(), t, params, [S.PARAM])
    return reduce(DataFrame.unionByName, [
        d.withColumn("pair", F.lit(n)) for n, d in (("block", block), ("four", four), ("drift", drift))])


def _slice(spark, sf_dir):
    """The part of history whose orders are filled."""
    t, _ = _sized(spark, sf_dir)
    return t, param_set(t["orders"], {"o_orderkey": S.PARAM}, where="o_orderstatus = 'F'", freeze=True)


def q_verdict_slice(spark, sf_dir):
    t, params = _slice(spark, sf_dir)
    return Comparison(S.old_version(), S.broken_version(), t, params, list(S.KEYS), _sit(t)).verdict()


def q_expected_slice(spark, sf_dir):
    t, params = _slice(spark, sf_dir)
    return Comparison(S.old_version(), S.new_version(), t, params, list(S.KEYS), _sit(t)).expected_summary(
        S.expected_quantities(t))


def q_verdict_missing_row(spark, sf_dir):
    """The defect: lines of quantity 1 are lost, and the fix still loses them.
    Situations are the products listed with quantity 1."""
    t, params = _setup(spark, sf_dir)
    old = S.menu_version(F.max, F.col("l_quantity") > 1)
    x, y = replay_pair(old, S.broken_version(), t, params)
    sit = situations(t, lambda t: t["lineitem"].filter("l_quantity = 1").select(
        F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("prod")))
    return verdict(x, y, sit, list(S.KEYS))


def q_expected_partial(spark, sf_dir):
    """Expected values for what was shipped before 1997 only: a product with a
    later line has none."""
    t, params = _setup(spark, sf_dir)
    act = replay(S.new_version(), t, params)
    late = t["lineitem"].filter(f"l_shipdate >= '{S.SHIPPED_BEFORE}'").select(
        F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("prod"))
    known = S.expected_quantities(t).join(late, list(S.KEYS), "left_anti")
    return expected_summary(act, known, list(S.KEYS), _sit(t))


def _at_procedure(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return t, Comparison(S.old_version(), S.broken_version(), t, params, [S.PARAM],
                         _sit(t).select(S.PARAM).distinct(), finish=S.procedure_cost)


def q_procedure_verdict(spark, sf_dir):
    return _at_procedure(spark, sf_dir)[1].verdict()


def q_procedure_expected(spark, sf_dir):
    t, at = _at_procedure(spark, sf_dir)
    return at.check_expected(S.expected_costs(t))


def q_diff_rows_nulls(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    return diff_rows(replay(S.listing(), t, params), replay(S.listing(), S.with_nulls(t), params))


def q_diff_rows_repeats(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    t2 = S.with_repeats(t)
    return diff_rows(replay(S.listing(), t2, params), replay(S.listing(F.col("l_quantity") > 1), t2, params))


def q_row_matching(spark, sf_dir):
    """Planted edits of rows without a key, paired again."""
    t, params = _setup(spark, sf_dir)
    return match_rows(replay(S.details(False), t, params), replay(S.details(True), t, params))


def q_smallest_history(spark, sf_dir):
    """Per differing document, how few of its lines show the difference."""
    t, params = _setup(spark, sf_dir)
    cut = shrink(S.old_version(), S.new_version(), t, params, {"lineitem": "l_orderkey"})
    kinds = cut.rows["lineitem"].groupBy(F.col("l_orderkey").alias(S.PARAM)).agg(
        F.count_distinct("l_partkey").alias("products_left"))
    return cut.summary.join(kinds, S.PARAM)


def q_explain_unwanted(spark, sf_dir):
    unwanted = q_diff_unwanted(spark, sf_dir)
    return explain(S.line_attributes(_tables(spark, sf_dir), unwanted, "unwanted"), "unwanted", S.ATTRIBUTES)


def q_situation_widths(spark, sf_dir):
    t, params = _setup(spark, sf_dir)
    a, b = replay_pair(S.old_version(), S.broken_version(), t, params)
    return situation_widths(a, b, _sit(t), list(S.KEYS))


def q_diff_by_digest(spark, sf_dir):
    """A wide result, saved, of which few rows differ; in parts, as both results
    together are some twenty times the tables."""
    t, params = _setup(spark, sf_dir)

    def wide_diff(part):
        a, b = (materialize(replay(S.wide_listing(e), t, part)) for e in (False, True))
        return diff_by_digest(a, b, [S.PARAM])

    total = F.expr(" + ".join(f"c{i}" for i in range(S.WIDE)))
    diff = in_parts(params, sum(x.count() for x in t.values()), wide_diff)
    return diff.select("doc", "prod", "line", "qty", total.alias("total"), "net")


def q_rule_independence(spark, sf_dir):
    """Which rules may say where a difference is wanted: keys of those that
    read the history alone; the others are refused."""
    t, params = _setup(spark, sf_dir)
    a, b = replay_pair(S.old_version(), S.broken_version(), t, params)
    diff = diff_rows(a, b)
    saved = materialize(diff)
    rules = {
        "repeated products": S.situation_rule,
        "differing rows": lambda t: diff.select(*S.KEYS),
        "saved differing rows": lambda t: saved.select(*S.KEYS),
        "lines of differing documents": lambda t: t["lineitem"].select(
            F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("prod")).join(saved.select("doc"), "doc", "left_semi"),
        "rows of the new version": lambda t: b.select(*S.KEYS),
    }
    out = []
    for name, rule in rules.items():
        try:
            keys = situations(t, rule).agg(F.count("*").alias("keys"))
        except DependentRule:
            keys = spark.range(1).select(F.lit(None).cast("long").alias("keys"))
        out.append(keys.select(F.lit(name).alias("rule"), F.col("keys").isNotNull().alias("accepted"), "keys"))
    return reduce(DataFrame.unionByName, out)


def q_source_rows(spark, sf_dir):
    """The lines behind every differing menu row, and which version used them."""
    t, params = _setup(spark, sf_dir)
    got = source_rows(S.old_version(), S.broken_version(), t, params, list(S.KEYS), "lineitem", "l_orderkey")
    return got.rows.select(*S.KEYS, F.col("row.l_linenumber").alias("line"), F.col("row.l_suppkey").alias("supp"),
                           F.col("row.l_quantity").cast(S.QTY).alias("qty"), "in_old", "in_new", "exact")


def q_bounded_history(spark, sf_dir):
    """How much of history must be replayed to bound the regressions, by priority."""
    t, params = _setup(spark, sf_dir)
    strata = t["orders"].select(F.col("o_orderkey").alias(S.PARAM), F.col("o_orderpriority").alias("priority"))
    parts = [bounded(S.old_version(), S.VERSIONS[v](), t, params, _sit(t), S.KEYS, strata, S.MOST, S.ERROR)
             .withColumn("version", F.lit(v)) for v in ("new", "broken")]
    return reduce(DataFrame.unionByName, parts)


def q_valid_version(spark, sf_dir):
    """Per line, the customer's order that was the latest when it was shipped."""
    t = _tables(spark, sf_dir, ("orders", "lineitem"))
    o = t["orders"].select("o_orderkey", F.col("o_custkey").alias("cust"), F.col("o_orderdate").alias("valid_from"))
    lines = t["lineitem"].join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias(S.PARAM), F.col("l_linenumber").alias("line"), "cust", F.col("l_shipdate").alias("shipped"))
    got = asof_join(lines, o.withColumnRenamed("o_orderkey", "valid_doc"), ["cust"], "shipped", "valid_from")
    return got.select(S.PARAM, "line", "cust", F.col("shipped").cast("date").alias("shipped"), "valid_doc",
                      F.col("valid_from").cast("date").alias("valid_from"))


QUERIES: dict[str, Query] = {
    "history_counts": q_history_counts,          # O1
    "param_set": q_param_set,                    # O2
    "table_fn_one": q_table_fn_one,              # O3
    "table_fn_sql_one": q_table_fn_sql_one,      # O3, SQL table function
    "table_fn_replay": q_table_fn_replay,        # O4
    "table_fn_sql": q_table_fn_sql,              # O4, SQL text version
    "table_fn_lateral": q_table_fn_lateral,      # O4, lateral SQL table function
    "table_fn_top_product": q_table_fn_top_product,  # O4, top row per parameter
    "procedure_cost": q_procedure_cost,          # O5
    "procedure_diff": q_procedure_diff,          # O5 + O13
    "repeatability": q_repeatability,            # O6, a version against itself
    "diff_rows_fix": q_diff_rows_fix,            # O6 + O7
    "diff_rows_broken": q_diff_rows_broken,      # O6 + O7
    "situations": q_situations,                  # O8
    "diff_wanted": q_diff_wanted,                # O9
    "diff_unwanted": q_diff_unwanted,            # O9
    "diff_tagged": q_diff_tagged,                # O9, one pass
    "verdict_fix": _verdict("old", "new"),       # O10
    "verdict_none": _verdict("old", "old"),      # O10
    "verdict_broken": _verdict("old", "broken"),  # O10
    "verdict_wrong": _verdict("old", "wrong"),   # O10
    "verdict_broken_wide": _verdict("old", "broken", wide=True),  # O10 at document width
    "verdict_sql_fix": q_verdict_sql_fix,        # O10, DataFrame old against SQL new
    "pin_compare": q_pin_compare,                # O11
    "pin_bucketed": q_pin_bucketed,              # O11, a pin read without an exchange
    "expected_check": q_expected_check,          # O12
    "expected_summary": q_expected_summary,      # O12
    "diff_cells": q_diff_cells,                  # O13
    "column_changes": q_column_changes,          # O13, per column
    "reconcile": q_reconcile,                    # O14
    "stage_parity_fix": _stages("new"),          # O15
    "stage_parity_broken": _stages("broken"),    # O15
    "stage_parity_refactor": q_stage_parity_refactor,  # O15, unequal decompositions
    "repeatability_unstable": q_repeatability_unstable,  # O6, a version that is not stable
    "verdict_slice": q_verdict_slice,            # O10 over a part of history
    "verdict_missing_row": q_verdict_missing_row,  # O10, situations in neither result
    "expected_slice": q_expected_slice,          # O12 over a part of history
    "expected_partial": q_expected_partial,      # O12, some keys without expected value
    "procedure_verdict": q_procedure_verdict,    # O5 + O10
    "procedure_expected": q_procedure_expected,  # O5 + O12
    "diff_rows_nulls": q_diff_rows_nulls,        # O7 with nulls
    "diff_rows_repeats": q_diff_rows_repeats,    # O7 with repeated rows
    "row_matching": q_row_matching,              # O7, rows without a key paired
    "smallest_history": q_smallest_history,      # O11, least input that differs
    "explain_unwanted": q_explain_unwanted,      # O13, conditions behind unwanted rows
    "situation_widths": q_situation_widths,      # O9, what each width hides
    "rule_independence": q_rule_independence,    # O8, rules over results are refused
    "diff_by_digest": q_diff_by_digest,          # O7 on wide results, by a tree of digests
    "source_rows": q_source_rows,                # O7 + O13, the history rows behind a differing row
    "bounded_history": q_bounded_history,        # O10 on a part of history, with a bound
    "valid_version": q_valid_version,            # O4, versions found by time (inferred need)
}
