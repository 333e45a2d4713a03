"""Contracts and column helpers: schema checks, table-function versions."""

from .asof import asof_join
from .joins import fresh_join
from .lineage import DependentRule, check_independent
from .ranking import top_n_per
from .schema import (SchemaMismatch, check_columns, check_keys,
                     check_same_schema, comparable, comparable_columns)
from .table_fn import (LossyFunction, Stage, StagedVersion, Version, as_version, call_one,
                       in_parts, param_set, replay, sql_stage, sql_version)

__all__ = [
    "DependentRule", "check_independent",
    "SchemaMismatch", "check_columns", "check_keys", "check_same_schema",
    "comparable", "comparable_columns",
    "Stage", "StagedVersion", "Version", "as_version", "call_one", "in_parts",
    "param_set", "replay", "sql_stage", "sql_version", "top_n_per", "fresh_join", "asof_join",
    "LossyFunction",
]
