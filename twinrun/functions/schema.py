"""Schema contract for comparing two results.

Two results are comparable only when their columns agree in name, order and
type.  Nullability is ignored: parquet marks every column nullable on read,
so a pinned result would otherwise never match a fresh one.  Spark's own set
operators are lenient here (``exceptAll`` matches by position and widens
``int`` to ``long`` or even to ``string``), which is why the check runs
before any row is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """Raised when two results cannot be compared row by row."""


def col(name: str, df: DataFrame | None = None) -> Column:
    """The column of that exact name, also when it holds dots or backticks."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(quoted) if df is None else df[quoted]


def columns(names: Sequence[str], df: DataFrame | None = None) -> list[Column]:
    return [col(n, df) for n in names]


def type_shape(dt: T.DataType) -> str:
    """Type text without nullability (``simpleString`` leaves it out)."""
    return dt.simpleString()


def _has_variant(dt: T.DataType) -> bool:
    if isinstance(dt, T.VariantType):
        return True
    if isinstance(dt, T.StructType):
        return any(_has_variant(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _has_variant(dt.elementType)
    if isinstance(dt, T.MapType):
        return _has_variant(dt.keyType) or _has_variant(dt.valueType)
    return False


def check_columns(df: DataFrame, what: str = "result") -> None:
    """Refuse duplicate names and variant columns (variants cannot be grouped)."""
    names = df.columns
    dups = sorted({n for n in names if names.count(n) > 1})
    if dups:
        raise SchemaMismatch(f"{what} has repeated column names: {dups}")
    bad = [f.name for f in df.schema.fields if _has_variant(f.dataType)]
    if bad:
        raise SchemaMismatch(
            f"{what} has variant columns {bad}; convert them (e.g. to_json) "
            "before comparing")


def check_same_schema(old: DataFrame, new: DataFrame,
                      names: tuple[str, str] = ("old", "new")) -> None:
    """Fail with a readable message unless names, order and types agree."""
    a, b = names
    check_columns(old, a)
    check_columns(new, b)
    sa = [(f.name, type_shape(f.dataType)) for f in old.schema.fields]
    sb = [(f.name, type_shape(f.dataType)) for f in new.schema.fields]
    if sa == sb:
        return
    na, nb = [n for n, _ in sa], [n for n, _ in sb]
    if set(na) != set(nb):
        only_a = [n for n in na if n not in nb]
        only_b = [n for n in nb if n not in na]
        raise SchemaMismatch(
            f"column names differ: only in {a}: {only_a}; only in {b}: {only_b}")
    if na != nb:
        raise SchemaMismatch(f"column order differs: {a}={na} {b}={nb}")
    diffs = [(n, ta, tb) for (n, ta), (_, tb) in zip(sa, sb) if ta != tb]
    raise SchemaMismatch(
        "column types differ: " +
        ", ".join(f"{n}: {a}={ta} {b}={tb}" for n, ta, tb in diffs))


def check_keys(df: DataFrame, keys: Sequence[str], what: str = "result") -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise SchemaMismatch(f"{what} lacks key columns {missing}")
    if not keys:
        raise SchemaMismatch("at least one key column is needed")


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def comparable(col: Column, dt: T.DataType) -> Column:
    """Rewrite a value so that equal values compare and group as equal.

    Maps have no order, so ``{a:1, b:2}`` and ``{b:2, a:1}`` are the same
    value; they become arrays of entries sorted by key.  Everything else is
    left alone (Spark already treats NaN as NaN and -0.0 as 0.0 in grouping
    and in ``<=>``).  Runs JVM-side through higher-order functions.
    """
    if _orderable(dt):
        return col
    if isinstance(dt, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                comparable(e["key"], dt.keyType).alias("key"),
                comparable(e["value"], dt.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(dt, T.ArrayType):
        return F.transform(col, lambda x: comparable(x, dt.elementType))
    if isinstance(dt, T.StructType):
        return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*[
            comparable(col[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    return col


def comparable_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[Column]:
    """``comparable`` for each named column, keeping the column names."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols) if cols is not None else df.columns
    return [comparable(col(c), fields[c]).alias(c) for c in cols]


def needs_normalising(df: DataFrame) -> bool:
    return not all(_orderable(f.dataType) for f in df.schema.fields)


def row_hash(df: DataFrame) -> Column:
    """A deterministic 64-bit hash of the whole row, for spreading rows over
    buckets (never for deciding equality).  Maps are hashed in their
    key-sorted form, which ``xxhash64`` accepts."""
    return F.xxhash64(*comparable_columns(df))
