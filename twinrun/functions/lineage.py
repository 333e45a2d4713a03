"""What a DataFrame reads: the check that a rule does not depend on the
results that it is to judge.

A situation rule derived from a diff would excuse every difference.  So a
rule's analysed plan is walked, subqueries included: it may read the history
tables and nothing else, and it may not hold a version's result.  Results
that were saved in between show as files that are no history table; results
that were not show by the name under which ``replay`` returns them.  Nothing
runs for the check.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from .schema import SchemaMismatch

#: the alias of every version's result; it leaves names and rows as they are
RESULT = "twinrun_version_result"
#: leaves that hold no data of their own
EMPTY_LEAVES = {"OneRowRelation", "Range"}


class DependentRule(SchemaMismatch):
    """A rule that reads something else than the history."""


def marked_result(df: DataFrame) -> DataFrame:
    """``df`` with the mark of a version's result in its plan."""
    return df.alias(RESULT)


def plan_nodes(df: DataFrame) -> Iterator:
    """All nodes of the analysed plan and of the subqueries in it."""
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        yield node
        for below in (node.children(), node.subqueries()):
            todo += [below.apply(i) for i in range(below.size())]
        if node.getClass().getSimpleName() == "InMemoryRelation":  # cached: what it was made from counts
            todo.append(node.cacheBuilder().logicalPlan())


def _source(leaf) -> tuple[str, str]:
    """What a leaf reads: its files, its RDD, or its own rows."""
    kind = leaf.getClass().getSimpleName()
    if kind == "LogicalRelation":
        relation = leaf.relation()
        if hasattr(relation, "location") and relation.getClass().getSimpleName() == "HadoopFsRelation":
            paths = relation.location().rootPaths()
            return "files", " ".join(sorted(paths.apply(i).toString() for i in range(paths.size())))
        return "relation", str(relation.hashCode())
    if kind == "LogicalRDD":
        return "rdd", str(leaf.rdd().id())
    return kind, leaf.canonicalized().toString() if kind != "LocalRelation" else str(leaf.data().hashCode())


def sources(df: DataFrame) -> set[tuple[str, str]]:
    """What a DataFrame reads, leaf by leaf."""
    return {_source(n) for n in plan_nodes(df)
            if n.children().isEmpty() and n.getClass().getSimpleName() not in EMPTY_LEAVES | {"InMemoryRelation"}}


def check_independent(df: DataFrame, history: Iterable[DataFrame], what: str = "rule") -> None:
    """Refuse a DataFrame that reads anything but the given ones' sources or
    holds a version's result."""
    for node in plan_nodes(df):
        if node.getClass().getSimpleName() == "SubqueryAlias" and node.identifier().name() == RESULT:
            raise DependentRule(f"the {what} reads a version's result; derive it from the history tables alone")
    known = set().union(*[sources(h) for h in history])
    if strange := sorted(sources(df) - known):
        raise DependentRule(f"the {what} reads what is no history table: "
                            + "; ".join(f"{kind} {text[:200]}" for kind, text in strange))
