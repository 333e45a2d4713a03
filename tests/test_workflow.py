"""The whole workflow on the stand-in: pin the error, fix it, refactor the
fix into SQL steps, and check each stage of the way."""

from twinrun.functions.table_fn import StagedVersion, replay, sql_stage
from twinrun.operators.diff import diff_rows
from twinrun.operators.situations import split_diff
from twinrun.operators.stages import diff_stages
from twinrun.operators.verdict import check_expected
from twinrun.plans import Comparison
from twinrun.plans import standin as S
from twinrun.session import shared_path
from twinrun.sources.pin import compare_to_pin, pin


REFACTORED = StagedVersion([
    sql_stage("lines", """
        SELECT p.doc, l.l_partkey AS prod, CAST(l.l_quantity AS DECIMAL(18,2)) AS q
        FROM {lineitem} l JOIN {params} p ON p.doc = l.l_orderkey"""),
    sql_stage("per_product", """
        SELECT doc, prod, CAST(sum(q) AS DECIMAL(18,2)) AS qty FROM {prev} GROUP BY doc, prod"""),
    sql_stage("menu", """
        SELECT x.doc, x.prod, p.p_name, x.qty
        FROM {prev} x JOIN {part} p ON p.p_partkey = x.prod"""),
], name="refactored")


def test_pin_fix_refactor(spark, hist, params, sit):
    keys = list(S.KEYS)
    expected = S.expected_quantities(hist)

    # 1. pin the current behaviour and confirm the defect in the rare cases
    path = pin(replay(S.old_version(), hist, params), shared_path(spark, "pins", "wf"))
    assert check_expected(replay(S.old_version(), hist, params), expected, keys, sit).count() == 57

    # 2. the fix changes only the rare cases, and makes them right
    report = Comparison(S.old_version(), S.new_version(), hist, params, keys, sit) \
        .materialize().report(expected)
    assert report["regressed"] == 0 and report["keys_wrong"] == 0 and report["intended"] == 57

    # 3. a refactoring of the fix: against the pin, all differences are wanted ...
    wanted, unwanted = split_diff(compare_to_pin(replay(REFACTORED, hist, params), path), sit, keys)
    assert unwanted.count() == 0 and wanted.count() == 114
    # ... and it equals the fix step by step
    assert diff_stages(S.new_version(), REFACTORED, hist, params, ["doc"]).count() == 0
    assert diff_rows(replay(S.new_version(), hist, params),
                     replay(REFACTORED, hist, params)).count() == 0
