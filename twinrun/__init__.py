"""twinrun: replay two versions of a table-valued query over history on
Spark, and separate the differences that were wanted from those that were
not.

Typical use::

    tables = load_history(spark, "/data/history")
    params = param_set(tables["orders"], {"o_orderkey": "doc"})
    cmp = Comparison(old, new, tables, params, keys=["doc", "prod"],
                     situations=situations(tables, rule))
    cmp.report(expected)   # intended / unfixed / regressed / matched
"""

from .functions import (DependentRule, LossyFunction, SchemaMismatch, Stage, StagedVersion, asof_join, call_one,
                        check_independent, check_same_schema, fresh_join, in_parts, param_set, replay, sql_stage,
                        sql_version, top_n_per)
from .operators import (Origins, Shrunk, bounded, check_expected, column_changes, diff_by_digest, diff_cells, diff_rows,
                        diff_stages, differing, expected_summary, explain, in_replay, match_rows, reconcile,
                        repeated, repeated_keys, shrink, situation_widths, situations, source_rows, split_diff,
                        tag_diff, uncovered_keys, verdict)
from .plans import Comparison, repeatability, replay_pair, run_procedure
from .session import configure, ensure_checkpoint_dir, get_session, shared_path
from .sources import (compare_to_bucketed_pin, compare_to_pin, discard, history_counts, load_history,
                      materialize, pin, pin_bucketed, read_pin, scratch, snapshot_history)

__all__ = [
    "LossyFunction", "SchemaMismatch", "Stage", "StagedVersion", "call_one", "check_same_schema",
    "fresh_join", "in_parts", "param_set", "replay", "sql_stage", "sql_version", "top_n_per",
    "check_expected", "column_changes", "diff_cells", "diff_rows", "diff_stages", "expected_summary",
    "in_replay", "reconcile", "repeated", "repeated_keys", "situations", "split_diff", "tag_diff",
    "uncovered_keys", "verdict",
    "DependentRule", "Shrunk", "check_independent", "diff_by_digest", "differing", "explain", "match_rows", "shrink", "situation_widths",
    "Origins", "asof_join", "bounded", "compare_to_bucketed_pin", "pin_bucketed", "source_rows",
    "Comparison", "repeatability", "replay_pair", "run_procedure",
    "configure", "ensure_checkpoint_dir", "get_session", "shared_path",
    "compare_to_pin", "discard", "history_counts", "load_history", "materialize", "pin",
    "read_pin", "scratch", "snapshot_history",
]
