"""DuckDB oracle SQL for every registered query in ``fixture_queries``.

Written independently of the Spark code, in the plainest form: joins then
``GROUP BY``, full outer joins with ``IS DISTINCT FROM`` for comparisons,
``EXISTS`` for the situation split.  Every aggregate is cast to one type so
both engines agree (DuckDB sums integers to HUGEINT and decimals to
precision 38).
"""

from __future__ import annotations

import math

from ..sources.history import TABLES
from .standin import ERROR, MOST, SHIPPED_BEFORE

# Stand-in versions: (aggregate, extra line filter).
VERSIONS = {
    "old": ("max", ""),
    "new": ("sum", ""),
    "broken": ("sum", "WHERE l.l_quantity > 1"),
    "wrong": ("min", ""),
}


def menu(version: str) -> str:
    agg, where = VERSIONS[version]
    return f"""
SELECT o.o_orderkey AS doc, l.l_partkey AS prod, p.p_name AS p_name,
       CAST({agg}(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS qty
FROM orders o
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
{where}
GROUP BY o.o_orderkey, l.l_partkey, p.p_name"""


SITUATIONS = """
SELECT l_orderkey AS doc, l_partkey AS prod
FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"""

EXPECTED = """
SELECT l_orderkey AS doc, l_partkey AS prod,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS qty
FROM lineitem GROUP BY l_orderkey, l_partkey"""

def _diff(a: str, b: str) -> str:
    return f"""
SELECT doc, prod, p_name, qty, CAST(sum(w) AS BIGINT) AS net FROM (
  SELECT doc, prod, p_name, qty, -1 AS w FROM {a}
  UNION ALL
  SELECT doc, prod, p_name, qty, 1 AS w FROM {b}) u
GROUP BY doc, prod, p_name, qty
HAVING sum(w) <> 0"""


def diff_rows(a: str, b: str) -> str:
    return f"WITH va AS ({menu(a)}), vb AS ({menu(b)}) {_diff('va', 'vb')}"


def _changed_keys(a: str, b: str) -> str:
    return f"""
SELECT coalesce(va.doc, vb.doc) AS doc, coalesce(va.prod, vb.prod) AS prod,
       (va.doc IS NULL OR vb.doc IS NULL
        OR va.p_name IS DISTINCT FROM vb.p_name
        OR va.qty IS DISTINCT FROM vb.qty) AS changed
FROM va FULL OUTER JOIN vb ON va.doc = vb.doc AND va.prod = vb.prod"""


def verdict(a: str, b: str, wide: bool = False) -> str:
    if wide:
        sit = f"SELECT DISTINCT doc FROM ({SITUATIONS}) s0"
        cond = "k.doc = s.doc"
    else:
        sit = SITUATIONS
        cond = "k.doc = s.doc AND k.prod = s.prod"
    return f"""
WITH va AS ({menu(a)}), vb AS ({menu(b)}), s AS ({sit}),
k AS ({_changed_keys(a, b)}),
f AS (SELECT k.changed, s.doc IS NOT NULL AS ins FROM k LEFT JOIN s ON {cond})
SELECT count(*) FILTER (WHERE ins AND changed) AS intended,
       count(*) FILTER (WHERE ins AND NOT changed) AS unfixed,
       count(*) FILTER (WHERE NOT ins AND changed) AS regressed,
       count(*) FILTER (WHERE NOT ins AND NOT changed) AS matched
FROM f"""


def _split(exists: bool) -> str:
    neg = "" if exists else "NOT "
    return f"""
WITH va AS ({menu('old')}), vb AS ({menu('broken')}), s AS ({SITUATIONS}),
d AS ({_diff('va', 'vb')})
SELECT d.* FROM d
WHERE {neg}EXISTS (SELECT 1 FROM s WHERE s.doc = d.doc AND s.prod = d.prod)"""


DIFF_TAGGED = f"""
WITH va AS ({menu('old')}), vb AS ({menu('broken')}), s AS ({SITUATIONS}),
d AS ({_diff('va', 'vb')})
SELECT d.*, EXISTS (SELECT 1 FROM s WHERE s.doc = d.doc AND s.prod = d.prod) AS wanted
FROM d"""


def procedure(version: str) -> str:
    return f"""
SELECT m.doc,
       CAST(sum(m.qty * CAST(p.p_retailprice AS DECIMAL(18,2))) AS DECIMAL(28,4)) AS cost
FROM ({menu(version)}) m JOIN part p ON p.p_partkey = m.prod
GROUP BY m.doc"""


PROCEDURE_DIFF = f"""
WITH po AS ({procedure('old')}), pn AS ({procedure('new')})
SELECT coalesce(po.doc, pn.doc) AS doc,
       CASE WHEN po.doc IS NULL THEN 'added' WHEN pn.doc IS NULL THEN 'removed'
            ELSE 'changed' END AS status,
       po.cost AS cost_old, pn.cost AS cost_new
FROM po FULL OUTER JOIN pn ON po.doc = pn.doc
WHERE po.doc IS NULL OR pn.doc IS NULL OR po.cost IS DISTINCT FROM pn.cost"""

DIFF_CELLS = f"""
WITH va AS ({menu('old')}), vb AS ({menu('broken')})
SELECT coalesce(va.doc, vb.doc) AS doc, coalesce(va.prod, vb.prod) AS prod,
       CASE WHEN va.doc IS NULL THEN 'added' WHEN vb.doc IS NULL THEN 'removed'
            ELSE 'changed' END AS status,
       va.p_name AS p_name_old, vb.p_name AS p_name_new,
       va.qty AS qty_old, vb.qty AS qty_new
FROM va FULL OUTER JOIN vb ON va.doc = vb.doc AND va.prod = vb.prod
WHERE va.doc IS NULL OR vb.doc IS NULL
   OR va.p_name IS DISTINCT FROM vb.p_name OR va.qty IS DISTINCT FROM vb.qty"""

COLUMN_CHANGES = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name,
       count(*) FILTER (WHERE status = 'changed' AND {c}_old IS DISTINCT FROM {c}_new)
         AS keys_changed
FROM ({DIFF_CELLS}) c{i}""" for i, c in enumerate(("p_name", "qty")))

RECONCILE = f"""
WITH va AS ({menu('old')}), vb AS ({menu('new')}),
a AS (SELECT doc, count(*) AS n, sum(qty) AS s FROM va GROUP BY doc),
b AS (SELECT doc, count(*) AS n, sum(qty) AS s FROM vb GROUP BY doc)
SELECT coalesce(a.doc, b.doc) AS doc,
       CAST(coalesce(a.n, 0) AS BIGINT) AS rows_old,
       CAST(coalesce(b.n, 0) AS BIGINT) AS rows_new,
       CAST(a.s AS DECIMAL(38,2)) AS qty_old,
       CAST(b.s AS DECIMAL(38,2)) AS qty_new
FROM a FULL OUTER JOIN b ON a.doc = b.doc
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0) OR a.s IS DISTINCT FROM b.s"""


def _expected_pair(version: str) -> str:
    return f"""
e AS ({EXPECTED}), s AS ({SITUATIONS}), m AS ({menu(version)}),
es AS (SELECT e.* FROM e WHERE EXISTS (SELECT 1 FROM s WHERE s.doc = e.doc AND s.prod = e.prod)),
ms AS (SELECT m.doc, m.prod, m.qty FROM m
       WHERE EXISTS (SELECT 1 FROM s WHERE s.doc = m.doc AND s.prod = m.prod))"""


EXPECTED_CHECK = f"""
WITH {_expected_pair('broken')}
SELECT coalesce(es.doc, ms.doc) AS doc, coalesce(es.prod, ms.prod) AS prod,
       CASE WHEN ms.doc IS NULL THEN 'removed' ELSE 'changed' END AS status,
       es.qty AS qty_expected, ms.qty AS qty_actual
FROM es FULL OUTER JOIN ms ON es.doc = ms.doc AND es.prod = ms.prod
WHERE es.doc IS NOT NULL AND (ms.doc IS NULL OR es.qty IS DISTINCT FROM ms.qty)"""


def _expected_summary(version: str) -> str:
    return f"""
(WITH {_expected_pair(version)}
 SELECT '{version}' AS version,
        count(*) FILTER (WHERE es.doc IS NOT NULL) AS keys_checked,
        count(*) FILTER (WHERE es.doc IS NOT NULL AND ms.doc IS NULL
                         OR es.doc IS NOT NULL AND es.qty IS DISTINCT FROM ms.qty) AS keys_wrong,
        count(*) FILTER (WHERE es.doc IS NULL) AS keys_uncovered
 FROM es FULL OUTER JOIN ms ON es.doc = ms.doc AND es.prod = ms.prod)"""


EXPECTED_SUMMARY = "\nUNION ALL\n".join(_expected_summary(v) for v in VERSIONS)


def _stage_rows(version: str) -> tuple[str, str, str]:
    agg, where = VERSIONS[version]
    cond = "AND l.l_quantity > 1" if where else ""
    lines = f"""
SELECT l.l_orderkey AS doc, l.l_partkey AS prod, CAST(l.l_quantity AS DECIMAL(18,2)) AS q
FROM lineitem l
WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders) {cond}"""
    per = f"SELECT doc, prod, CAST({agg}(q) AS DECIMAL(18,2)) AS qty FROM l_{version} GROUP BY doc, prod"
    final = f"""SELECT x.doc, x.prod, p.p_name, x.qty FROM pp_{version} x
JOIN part p ON p.p_partkey = x.prod"""
    return lines, per, final


def _stage_diff(a: str, b: str, cols: str) -> str:
    return f"""
SELECT doc FROM (
  SELECT {cols}, -1 AS w FROM {a} UNION ALL SELECT {cols}, 1 AS w FROM {b}) u
GROUP BY {cols} HAVING sum(w) <> 0"""


def stage_parity(b: str) -> str:
    a = "old"
    la, pa, ma = _stage_rows(a)
    lb, pb, mb = _stage_rows(b)
    return f"""
WITH l_{a} AS ({la}), l_{b} AS ({lb}),
pp_{a} AS ({pa}), pp_{b} AS ({pb}),
m_{a} AS ({ma}), m_{b} AS ({mb}),
d AS (
  SELECT doc, 1 AS stage FROM ({_stage_diff(f'l_{a}', f'l_{b}', 'doc, prod, q')}) d1
  UNION ALL
  SELECT doc, 2 AS stage FROM ({_stage_diff(f'pp_{a}', f'pp_{b}', 'doc, prod, qty')}) d2
  UNION ALL
  SELECT doc, 3 AS stage FROM ({_stage_diff(f'm_{a}', f'm_{b}', 'doc, prod, p_name, qty')}) d3)
SELECT doc, CAST(min(stage) AS INTEGER) AS first_stage,
       CASE min(stage) WHEN 1 THEN 'lines' WHEN 2 THEN 'per_product' ELSE 'menu' END
         AS stage_name
FROM d GROUP BY doc"""


STAGE_PARITY_REFACTOR = f"""
WITH mn AS ({menu('new')}), mb AS ({menu('broken')}),
lines AS (SELECT l_orderkey AS doc, l_partkey AS prod, l_quantity AS q FROM lineitem
          WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
block AS (
  SELECT DISTINCT doc FROM (
    (SELECT * FROM mn EXCEPT SELECT * FROM mb) UNION ALL (SELECT * FROM mb EXCEPT SELECT * FROM mn)) x),
per AS (
  SELECT DISTINCT coalesce(a.doc, b.doc) AS doc
  FROM (SELECT doc, prod, sum(q) AS s FROM lines GROUP BY doc, prod) a
  FULL OUTER JOIN (SELECT doc, prod, sum(q) AS s FROM lines WHERE q > 1 GROUP BY doc, prod) b
    ON a.doc = b.doc AND a.prod = b.prod
  WHERE a.s IS DISTINCT FROM b.s)
SELECT doc, CAST(3 AS INTEGER) AS first_stage, 'menu' AS stage_name, 'block' AS pair FROM block
UNION ALL
SELECT doc, CAST(3 AS INTEGER), 'per_product', 'drift' FROM per"""

SLICE = "doc IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"

VERDICT_SLICE = f"""
WITH va AS (SELECT * FROM ({menu('old')}) m WHERE {SLICE}),
vb AS (SELECT * FROM ({menu('broken')}) m WHERE {SLICE}),
s AS (SELECT * FROM ({SITUATIONS}) x WHERE {SLICE}),
k AS ({_changed_keys('va', 'vb')}),
f AS (SELECT k.changed, s.doc IS NOT NULL AS ins FROM k LEFT JOIN s ON k.doc = s.doc AND k.prod = s.prod)
SELECT count(*) FILTER (WHERE ins AND changed) AS intended,
       count(*) FILTER (WHERE ins AND NOT changed)
         + (SELECT count(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc = s.doc AND k.prod = s.prod)) AS unfixed,
       count(*) FILTER (WHERE NOT ins AND changed) AS regressed,
       count(*) FILTER (WHERE NOT ins AND NOT changed) AS matched
FROM f"""

EXPECTED_SLICE = f"""
WITH e AS ({EXPECTED}), s AS ({SITUATIONS}), m AS ({menu('new')})
SELECT count(e.doc) AS keys_checked,
       count(*) FILTER (WHERE e.doc IS NOT NULL AND e.qty IS DISTINCT FROM m.qty) AS keys_wrong,
       count(*) FILTER (WHERE e.doc IS NULL) AS keys_uncovered
FROM s LEFT JOIN e ON e.doc = s.doc AND e.prod = s.prod
       LEFT JOIN m ON m.doc = s.doc AND m.prod = s.prod
WHERE s.{SLICE}"""

EXPECTED_PARTIAL = EXPECTED_SLICE.replace(f"s.{SLICE}", "true").replace(
    EXPECTED, EXPECTED + f" HAVING max(l_shipdate) < TIMESTAMP '{SHIPPED_BEFORE}'")

VERDICT_MISSING_ROW = f"""
WITH lost AS (SELECT DISTINCT l_orderkey AS doc, l_partkey AS prod FROM lineitem WHERE l_quantity = 1),
a AS (SELECT l_orderkey AS doc, l_partkey AS prod, max(l_quantity) AS hi, sum(l_quantity) AS total
      FROM lineitem WHERE l_quantity > 1 GROUP BY ALL),
k AS (SELECT doc, prod, a.doc IS NOT NULL AND hi <> total AS changed, lost.doc IS NOT NULL AS ins
      FROM a FULL OUTER JOIN lost USING (doc, prod))
SELECT count(*) FILTER (WHERE ins AND changed) AS intended,
       count(*) FILTER (WHERE ins AND NOT changed) AS unfixed,
       count(*) FILTER (WHERE NOT ins AND changed) AS regressed,
       count(*) FILTER (WHERE NOT ins AND NOT changed) AS matched
FROM k"""

PROCEDURE_VERDICT = f"""
WITH po AS ({procedure('old')}), pn AS ({procedure('broken')}),
s AS (SELECT DISTINCT doc FROM ({SITUATIONS}) x),
k AS (SELECT coalesce(po.doc, pn.doc, s.doc) AS doc,
             (po.doc IS NULL) <> (pn.doc IS NULL) OR po.cost IS DISTINCT FROM pn.cost AS changed,
             s.doc IS NOT NULL AS ins
      FROM po FULL OUTER JOIN pn ON po.doc = pn.doc FULL OUTER JOIN s ON s.doc = coalesce(po.doc, pn.doc))
SELECT count(*) FILTER (WHERE ins AND changed) AS intended,
       count(*) FILTER (WHERE ins AND NOT changed) AS unfixed,
       count(*) FILTER (WHERE NOT ins AND changed) AS regressed,
       count(*) FILTER (WHERE NOT ins AND NOT changed) AS matched
FROM k"""

PROCEDURE_EXPECTED = f"""
WITH pn AS ({procedure('broken')}),
e AS (SELECT l_orderkey AS doc, CAST(sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)))
             AS DECIMAL(28,4)) AS cost
      FROM lineitem, part WHERE p_partkey = l_partkey GROUP BY l_orderkey)
SELECT e.doc, CASE WHEN pn.doc IS NULL THEN 'removed' ELSE 'changed' END AS status,
       e.cost AS cost_expected, pn.cost AS cost_actual
FROM e LEFT JOIN pn ON pn.doc = e.doc
WHERE e.doc IN (SELECT doc FROM ({SITUATIONS}) x) AND e.cost IS DISTINCT FROM pn.cost"""

_LISTING = """
SELECT l_orderkey AS doc, l_partkey AS prod, CAST({q} AS DECIMAL(18,2)) AS q
FROM lineitem {more} WHERE l_orderkey IN (SELECT o_orderkey FROM orders) {where}"""


def _bag_diff(a: str, b: str) -> str:
    return f"""
SELECT doc, prod, q, count(*) FILTER (WHERE side = 1) - count(*) FILTER (WHERE side = 0) AS net
FROM (SELECT *, 0 AS side FROM ({a}) x UNION ALL SELECT *, 1 AS side FROM ({b}) y) u
GROUP BY doc, prod, q HAVING net <> 0"""


DIFF_ROWS_NULLS = _bag_diff(
    _LISTING.format(q="l_quantity", more="", where=""),
    _LISTING.format(q="CASE WHEN l_quantity <> 1 THEN l_quantity END", more="", where=""))
_TWICE = "CROSS JOIN (VALUES (1), (2)) t(i)"
DIFF_ROWS_REPEATS = _bag_diff(
    _LISTING.format(q="l_quantity", more=_TWICE, where="AND (i = 1 OR l_orderkey % 3 = 0)"),
    _LISTING.format(q="l_quantity", more=_TWICE, where="AND (i = 1 OR l_orderkey % 3 = 0) AND l_quantity > 1"))

HISTORY_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {n}" for n in TABLES)

TABLE_FN_ONE = f"SELECT * FROM ({menu('new')}) m WHERE m.doc = 1"

_LINES = "FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"
_DETAIL = ("o_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "CAST(l_quantity AS DECIMAL(18,2))")
_EDITED = ("o_orderkey", "l_partkey", "CASE WHEN l_quantity = 2 THEN l_suppkey + 1000000 ELSE l_suppkey END",
           "CASE WHEN l_quantity = 2 THEN 'X' ELSE l_returnflag END", "l_linestatus",
           "CAST(CASE WHEN l_quantity = 1 THEN 101 ELSE l_quantity END AS DECIMAL(18,2))")
_DETAIL_NAMES = ("doc", "prod", "supp", "flag", "status", "qty")


def _matched(match: str, cells: str, old, new, where: str) -> str:
    null = [f"NULL::{t}" for t in ("BIGINT", "BIGINT", "BIGINT", "VARCHAR", "VARCHAR", "DECIMAL(18,2)")]
    cols = ", ".join(f"{a} AS {n}_old, {b} AS {n}_new" for a, b, n in zip(old or null, new or null, _DETAIL_NAMES))
    return (f"SELECT '{match}' AS match, count(*) AS copies, {cells}::INTEGER AS cells_changed, true AS least, {cols} "
            f"{_LINES} WHERE {where} GROUP BY ALL")


# What was planted is known by line: the pairs need no search here.
ROW_MATCHING = " UNION ALL ".join([
    _matched("paired", "CASE WHEN l_quantity = 1 THEN 1 ELSE 2 END", _DETAIL, _EDITED, "l_quantity IN (1, 2)"),
    _matched("removed", "NULL", _DETAIL, None, "l_quantity = 3 AND l_returnflag = 'R'"),
    _matched("added", "NULL", None, _DETAIL, "l_quantity = 4 AND l_returnflag = 'N'")])

# max and sum differ as soon as two lines of a document list one product
SMALLEST_HISTORY = f"""
SELECT o_orderkey AS doc, count(*) AS rows_before, 2::BIGINT AS rows_left, true AS minimal, 1::BIGINT AS products_left
{_LINES} WHERE o_orderkey IN (SELECT doc FROM ({SITUATIONS}) s) GROUP BY o_orderkey"""


def explain_unwanted(share: float = 0.05) -> str:
    attributes = {
        "quantity": "CAST(l_quantity AS INTEGER)", "returnflag": "l_returnflag", "linestatus": "l_linestatus",
        "discount_pct": "CAST(round(l_discount * 100) AS INTEGER)", "tax_pct": "CAST(round(l_tax * 100) AS INTEGER)",
        "linenumber": "l_linenumber", "ship_year": "year(l_shipdate)", "orderstatus": "o_orderstatus",
        "orderpriority": "o_orderpriority"}
    conditions = ", ".join(f"coalesce('{n} = ' || ({e}), '{n} is null')" for n, e in attributes.items())
    unwanted = _split(False)
    return f"""
WITH u AS (SELECT DISTINCT doc, prod FROM ({unwanted}) x),
l AS MATERIALIZED (SELECT [{conditions}] AS c, u.doc IS NOT NULL AS bad
                   {_LINES} LEFT JOIN u ON u.doc = l.l_orderkey AND u.prod = l.l_partkey),
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE bad) AS b FROM l),
f AS (
  SELECT c[i] AS condition, 1::BIGINT AS n_attributes, count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_flagged
  FROM l, range(1, {len(attributes) + 1}) t(i) GROUP BY ALL
  UNION ALL
  SELECT c[i] || ' and ' || c[j], 2, count(*), count(*) FILTER (WHERE bad)
  FROM l, range(1, {len(attributes) + 1}) t(i), range(1, {len(attributes) + 1}) s(j) WHERE i < j GROUP BY ALL),
r AS (
  SELECT f.*, CASE WHEN b > n_flagged AND n.n > n_rows
                   THEN n_flagged::DOUBLE * (n.n - n_rows)::DOUBLE / ((b - n_flagged)::DOUBLE * n_rows::DOUBLE) END AS risk_ratio,
         b = n_flagged AS covers_all, n_rows = n.n AS everywhere
  FROM f, n WHERE n_flagged >= ceil({share}::DOUBLE * b) AND n_flagged > 0)
SELECT row_number() OVER (ORDER BY everywhere, covers_all DESC, risk_ratio DESC NULLS LAST,
                          n_flagged::DOUBLE / n_rows::DOUBLE DESC, n_flagged DESC, n_attributes, condition) AS place,
       condition, n_attributes, n_rows, n_flagged, risk_ratio, covers_all
FROM r"""


def situation_widths() -> str:
    parts = []
    for width in (("doc",), ("prod",), ("doc", "prod")):
        cond = " AND ".join(f"s.{c} = k.{c}" for c in width)
        parts.append(f"""
SELECT '{", ".join(width)}' AS width, {len(width)}::BIGINT AS n_columns, count(*) FILTER (WHERE x) AS keys_exempt,
       count(*) FILTER (WHERE changed AND ins) AS intended, count(*) FILTER (WHERE changed AND x AND NOT ins) AS hidden,
       count(*) FILTER (WHERE changed AND NOT x) AS regressed
FROM (SELECT changed, EXISTS (SELECT 1 FROM s WHERE {cond}) AS x,
             EXISTS (SELECT 1 FROM s WHERE s.doc = k.doc AND s.prod = k.prod) AS ins FROM k) q""")
    return f"""
WITH va AS ({menu('old')}), vb AS ({menu('broken')}), s AS ({SITUATIONS}), k AS ({_changed_keys('va', 'vb')}),
w AS ({" UNION ALL ".join(parts)})
SELECT *, row_number() OVER (ORDER BY hidden, keys_exempt, n_columns, width) = 1 AS narrowest FROM w"""


def diff_by_digest(wide: int = 96) -> str:
    total = " + ".join(f"(l_partkey * {i + 1} + l_suppkey) % 997" for i in range(wide))
    side = lambda q, n: (f"SELECT o_orderkey AS doc, l_partkey AS prod, l_linenumber AS line, CAST({q} AS DECIMAL(18,2)) AS qty, "  # noqa: E731
                         f"{total} AS total, {n} AS net {_LINES}")
    return f"""
SELECT doc, prod, line, qty, total, CAST(sum(net) AS BIGINT) AS net
FROM ({side("l_quantity", -1)} UNION ALL {side("CASE WHEN l_quantity = 1 THEN 101 ELSE l_quantity END", 1)}) u
GROUP BY ALL HAVING sum(net) <> 0"""


RULE_INDEPENDENCE = f"""
SELECT 'repeated products' AS rule, true AS accepted, count(*) AS keys FROM ({SITUATIONS}) s
UNION ALL
SELECT name, false, NULL FROM (VALUES ('differing rows'), ('saved differing rows'), ('lines of differing documents'),
                                      ('rows of the new version')) v(name)"""


def source_rows() -> str:
    return f"""
WITH va AS ({menu('old')}), vb AS ({menu('broken')}), k AS ({_changed_keys('va', 'vb')})
SELECT k.doc, k.prod, l_linenumber AS line, l_suppkey AS supp, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
       true AS in_old, l_quantity > 1 AS in_new, true AS exact
FROM k JOIN lineitem l ON l.l_orderkey = k.doc AND l.l_partkey = k.prod WHERE changed"""


def _bounded(version: str, strata: int = 5) -> str:
    """All looks of every stratum at once, then the first that decides."""
    enough = math.ceil(math.log(ERROR / (2 * strata)) / math.log(1 - MOST))
    term = ("exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) "
            f"+ i * ln({MOST}::DOUBLE) + (n - i) * ln(1 - {MOST}::DOUBLE))")
    return f"""
SELECT '{version}' AS version, priority, any_value(documents) AS documents, min(j) + 1 AS looks, arg_min(n, j) AS replayed,
       arg_min(b, j) AS regressed, arg_min(answer, j) AS answer
FROM (
  SELECT *, CASE WHEN n >= documents THEN 'counted'
                 WHEN b < n * {MOST}::DOUBLE AND list_sum([{term} for i in range(0, b + 1)]) <= e THEN 'bounded'
                 WHEN b > n * {MOST}::DOUBLE AND list_sum([{term} for i in range(b, n + 1)]) <= e THEN 'exceeded' END AS answer
  FROM (
    SELECT priority, documents, j, {ERROR}::DOUBLE / ({strata} * pow(2, j + 1)) AS e,
           count(*) FILTER (WHERE place < upto) AS n, count(*) FILTER (WHERE place < upto AND bad) AS b
    FROM (SELECT *, least(4294967296, first * pow(2, j)) AS upto
          FROM (SELECT o_orderpriority AS priority, count(*) AS documents,
                       {enough}::BIGINT * 5 * 1073741824 // count(*) + 1 AS first FROM orders GROUP BY ALL) g, range(0, 33) r(j)) looks
    JOIN (SELECT o_orderpriority AS priority, ('0x' || substr(md5('0:' || o_orderkey), 1, 8))::BIGINT AS place,
                 o_orderkey IN (SELECT doc FROM k WHERE changed
                                AND NOT EXISTS (SELECT 1 FROM s WHERE s.doc = k.doc AND s.prod = k.prod)) AS bad
          FROM orders) d USING (priority)
    GROUP BY ALL) c) a
WHERE answer IS NOT NULL GROUP BY priority"""


def bounded_history() -> str:
    return " UNION ALL ".join(f"""
SELECT * FROM (
  WITH va AS ({menu('old')}), vb AS ({menu(v)}), s AS ({SITUATIONS}), k AS MATERIALIZED ({_changed_keys('va', 'vb')})
  {_bounded(v)})""" for v in ("new", "broken"))


VALID_VERSION = f"""
SELECT l.doc, line, l.cust, shipped::DATE AS shipped, valid_doc, valid_from::DATE AS valid_from
FROM (SELECT l_orderkey AS doc, l_linenumber AS line, o_custkey AS cust, l_shipdate AS shipped {_LINES}) l
ASOF LEFT JOIN (SELECT o_custkey AS cust, o_orderdate AS valid_from, max(o_orderkey) AS valid_doc
                FROM orders GROUP BY ALL) v ON l.cust = v.cust AND l.shipped >= v.valid_from"""


ORACLE: dict[str, str] = {
    "source_rows": source_rows(),
    "bounded_history": bounded_history(),
    "valid_version": VALID_VERSION,
    "rule_independence": RULE_INDEPENDENCE,
    "diff_by_digest": diff_by_digest(),
    "row_matching": ROW_MATCHING,
    "smallest_history": SMALLEST_HISTORY,
    "explain_unwanted": explain_unwanted(),
    "situation_widths": situation_widths(),
    "history_counts": HISTORY_COUNTS,
    "param_set": "SELECT DISTINCT o_orderkey AS doc FROM orders",
    "table_fn_one": TABLE_FN_ONE,
    "table_fn_sql_one": TABLE_FN_ONE,
    "table_fn_replay": menu("new"),
    "table_fn_sql": menu("new"),
    "table_fn_lateral": menu("new"),
    "table_fn_top_product": f"""
SELECT doc, prod, p_name, qty FROM (
  SELECT m.*, row_number() OVER (PARTITION BY doc ORDER BY qty DESC, prod, p_name) AS rn
  FROM ({menu('new')}) m) r
WHERE rn = 1""",
    "procedure_cost": procedure("new"),
    "procedure_diff": PROCEDURE_DIFF,
    "repeatability": f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS rows_differing, TRUE AS stable
FROM ({menu('old')}) m""",
    "diff_rows_fix": diff_rows("old", "new"),
    "diff_rows_broken": diff_rows("old", "broken"),
    "situations": SITUATIONS,
    "diff_wanted": _split(True),
    "diff_unwanted": _split(False),
    "diff_tagged": DIFF_TAGGED,
    "verdict_fix": verdict("old", "new"),
    "verdict_none": verdict("old", "old"),
    "verdict_broken": verdict("old", "broken"),
    "verdict_wrong": verdict("old", "wrong"),
    "verdict_broken_wide": verdict("old", "broken", wide=True),
    "verdict_sql_fix": verdict("old", "new"),
    "pin_compare": diff_rows("old", "new"),
    "pin_bucketed": diff_rows("old", "broken"),
    "expected_check": EXPECTED_CHECK,
    "expected_summary": EXPECTED_SUMMARY,
    "diff_cells": DIFF_CELLS,
    "column_changes": COLUMN_CHANGES,
    "reconcile": RECONCILE,
    "stage_parity_fix": stage_parity("new"),
    "stage_parity_broken": stage_parity("broken"),
    "stage_parity_refactor": STAGE_PARITY_REFACTOR,
    "repeatability_unstable": "SELECT count(DISTINCT l_orderkey) AS rows, FALSE AS stable FROM lineitem",
    "verdict_slice": VERDICT_SLICE,
    "verdict_missing_row": VERDICT_MISSING_ROW,
    "expected_slice": EXPECTED_SLICE,
    "expected_partial": EXPECTED_PARTIAL,
    "procedure_verdict": PROCEDURE_VERDICT,
    "procedure_expected": PROCEDURE_EXPECTED,
    "diff_rows_nulls": DIFF_ROWS_NULLS,
    "diff_rows_repeats": DIFF_ROWS_REPEATS,
}
