"""Comparison operators: diffs, situations, verdict, reconciliation, stages."""

from .bounded import bounded
from .conditions import explain
from .diff import (ABSENT, NET, STATUS, column_changes, diff_cells, diff_rows, key_compare,
                   repeated_keys)
from .digest import diff_by_digest
from .matching import match_rows
from .origins import Origins, source_rows
from .reconcile import reconcile
from .situations import WANTED, repeated, situations, split_diff, tag_diff
from .smallest import Shrunk, differing, shrink
from .stages import FIRST_STAGE, STAGE_NAME, diff_stages
from .verdict import (CELLS, check_expected, expected_summary, in_replay, uncovered_keys,
                      verdict)
from .width import situation_widths

__all__ = [
    "ABSENT", "NET", "STATUS", "WANTED", "CELLS", "FIRST_STAGE", "STAGE_NAME",
    "column_changes", "diff_cells", "diff_rows", "key_compare", "repeated_keys",
    "reconcile", "repeated", "situations", "split_diff", "tag_diff",
    "Origins", "Shrunk", "bounded", "diff_by_digest", "differing", "explain", "match_rows", "shrink", "situation_widths",
    "source_rows", "diff_stages", "check_expected", "expected_summary", "in_replay", "uncovered_keys", "verdict",
]
