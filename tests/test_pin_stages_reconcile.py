"""O1, O11, O14, O15."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from twinrun.functions.schema import SchemaMismatch
from twinrun.functions.table_fn import Stage, StagedVersion, replay
from twinrun.operators.reconcile import reconcile
from twinrun.operators.stages import diff_stages
from twinrun.plans import standin as S
from twinrun.plans.replay import replay_pair
from twinrun.session import shared_path
from twinrun.sources.history import history_counts, load_history, snapshot_history
from twinrun.sources.pin import compare_to_pin, pin


def test_history_counts(spark):
    got = {r.table_name: r.n_rows for r in
           history_counts(load_history(spark, SF["0.001"], ["orders", "lineitem", "part"])).collect()}
    assert got == {"orders": 1500, "lineitem": 6000, "part": 200}


def test_snapshot_history_reads_copy(spark, hist):
    frozen = snapshot_history({"part": hist["part"]}, shared_path(spark, "snap"))
    assert frozen["part"].count() == 200
    assert "twinrun/snap" in frozen["part"].inputFiles()[0]


def test_pin_roundtrip_new_session(spark, hist, params):
    path = pin(replay(S.old_version(), hist, params), shared_path(spark, "pins", "t"))
    other = spark.newSession()  # separate SQL state, as a later run would have
    t2 = load_history(other, SF["0.001"], ["orders", "lineitem", "part"])
    p2 = S.params_of(t2)
    assert compare_to_pin(replay(S.old_version(), t2, p2), path).count() == 0
    assert compare_to_pin(replay(S.new_version(), t2, p2), path).count() == 114


def test_reconcile_old_new(hist, params):
    a, b = replay_pair(S.old_version(), S.new_version(), hist, params)
    r = reconcile(a, b, ["doc"], ["qty"])
    assert r.count() == 56
    row = r.first()
    assert row.rows_old == row.rows_new and row.qty_new > row.qty_old


def test_reconcile_refuses_float_measures(spark):
    a = spark.createDataFrame([(1, 0.1)], "k long, x double")
    with pytest.raises(SchemaMismatch, match="decimal"):
        reconcile(a, a, ["k"], ["x"])


def test_stage_parity_finds_planted_stage(hist, params):
    got = {r.stage_name for r in diff_stages(S.old_version(), S.new_version(), hist, params)
           .collect()}
    assert got == {"per_product"}
    broken = diff_stages(S.old_version(), S.broken_version(), hist, params)
    names = {r.stage_name for r in broken.collect()}
    assert names == {"lines", "per_product"}


def test_stage_parity_planted_in_last_stage(hist, params):
    old = S.new_version()
    tweak = StagedVersion(old.stages[:2] + [Stage("menu", lambda t, p, prev: old.stages[2].fn(t, p, prev)
                                                   .withColumn("p_name", F.upper("p_name")))])
    r = diff_stages(old, tweak, hist, params)
    assert {x.first_stage for x in r.collect()} == {3}
    assert r.count() == params.join(replay(old, hist, params), "doc", "left_semi").count()


def test_stage_parity_of_unequal_decompositions(hist, params):
    assert diff_stages(S.one_block, S.new_version(), hist, params).count() == 0
    block = diff_stages(S.one_block, S.broken_version(), hist, params)
    assert {(r.first_stage, r.stage_name) for r in block.collect()} == {(3, "menu")}
    named = {"lines": "large_lines", "per_product": "per_product"}
    assert diff_stages(S.broken_version(), S.four_steps(), hist, params, match=named).count() == 0
    by_name = diff_stages(S.broken_version(), S.four_steps(), hist, params)
    assert {r.stage_name for r in by_name.collect()} == {"lines"}
    with pytest.raises(SchemaMismatch, match="no steps"):
        diff_stages(S.new_version(), S.four_steps(), hist, params, match={"lines": "none"})


def test_results_are_compared_whatever_the_names(hist, params):
    old = S.new_version()
    renamed = StagedVersion([Stage(f"x{i}", s.fn) for i, s in enumerate(S.broken_version().stages[:2])]
                            + [Stage("other", lambda t, p, prev: old.stages[2].fn(t, p, prev)),
                               Stage("end", lambda t, p, prev: prev)])
    assert {r.stage_name for r in diff_stages(old, renamed, hist, params).collect()} == {"end"}


def test_discard_only_under_the_shared_folder(spark, params):
    path = shared_path(spark, "pins", "gone")
    pin(params, path)
    from twinrun.sources.pin import discard
    assert discard(spark, path)
    with pytest.raises(ValueError):
        discard(spark, "/tmp")
