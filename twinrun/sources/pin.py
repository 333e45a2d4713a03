"""Pin a result as the recorded baseline, compare later results to it.

Where no tests existed, the previous version's output on history is the
only specification.  Writing it once as parquet to shared storage makes it
a fixed reference that a later Spark application (after the fix, after a
refactoring) can diff against without re-running the old version.  The
pin also cuts lineage: reading it back needs no recomputation after the
loss of an executor.

A pin that is compared again and again can be laid out for it:
``pin_bucketed`` saves every distinct row once with its number of copies, in
buckets of a hash of its columns.  The comparison then brings the new
result to those buckets and reads the pin where it lies: no exchange on
the pin's side, however large it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import SchemaMismatch, check_columns, check_keys, check_same_schema, col, columns
from ..operators.diff import NET, diff_rows
from ..session import FOLDER, ensure_checkpoint_dir, shared_path


def pin(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write ``df`` to ``path`` as parquet and return the path."""
    df.write.mode(mode).parquet(path)
    return path


def read_pin(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def compare_to_pin(df: DataFrame, path: str) -> DataFrame:
    """O7 between the pinned result (old) and ``df`` (new).  The schema
    check ignores nullability, which parquet drops on writing."""
    return diff_rows(read_pin(df.sparkSession, path), df)


#: types whose equal values always have equal hashes
BUCKET_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.BooleanType,
                T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
COPIES = "__copies"


def _bucketed_table(rows: DataFrame, path: str, by: Sequence[str], buckets: int) -> None:
    """Write ``rows`` as one sorted file a bucket.  The catalog entry is only
    a means of writing buckets and goes again; the files stay."""
    name = f"twinrun_pin_{uuid.uuid4().hex}"
    (rows.repartition(buckets, *columns(by)).write.format("parquet").option("path", path)
     .bucketBy(buckets, list(by)).sortBy(list(by)).saveAsTable(name))
    rows.sparkSession.sql(f"DROP TABLE {name}")


def _read_buckets(spark: SparkSession, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    quoted = lambda names: ", ".join("`" + n.replace("`", "``") + "`" for n in names)
    schema = spark.read.parquet(path).schema
    fields = ", ".join(f"{quoted([f.name])} {f.dataType.simpleString()}" for f in schema.fields)
    name = f"twinrun_pin_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({quoted(by)}) "
              f"SORTED BY ({quoted(by)}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    df = spark.table(name)
    df.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {name}")
    return df


def pin_bucketed(df: DataFrame, path: str, buckets: int, by: Sequence[str] | None = None) -> str:
    """Write ``df`` to the new folder ``path`` as distinct rows with their copies,
    in ``buckets`` buckets by the columns ``by``; return the path.

    ``by`` defaults to all columns of a type whose equal values hash equally
    (no floating point or nested ones).  Rows equal on ``by`` share a bucket, so
    name columns that spread the rows.  Take as many buckets as the result has
    times 128 MB.  Nulls share their bucket with their like; an empty result makes
    an empty pin."""
    check_columns(df)
    names = df.columns
    if COPIES in names:
        raise SchemaMismatch(f"result already has a column named {COPIES!r}")
    if bad := [f.name for f in df.schema.fields if not _parquet_can_store(f.dataType) or _holds_map(f.dataType)]:
        raise SchemaMismatch(f"columns {bad} cannot be pinned in buckets; use pin")
    fits = [f.name for f in df.schema.fields if isinstance(f.dataType, BUCKET_TYPES)]
    by = fits if by is None else list(by)
    check_keys(df, by)
    if unfit := [c for c in by if c not in fits]:
        raise SchemaMismatch(f"columns {unfit} have a type that cannot make buckets")
    spark, path = df.sparkSession, path.rstrip("/")
    if buckets < 1:
        raise ValueError("a pin needs at least one bucket")
    rows = df.groupBy(*columns(names)).agg(F.count("*").alias(COPIES))
    _bucketed_table(rows, f"{path}/rows", by, buckets)
    layout = spark.createDataFrame([(by, buckets)], "columns array<string>, buckets int")
    layout.coalesce(1).write.mode("errorifexists").parquet(f"{path}/layout")
    return path


def compare_to_bucketed_pin(df: DataFrame, path: str, net_col: str = NET, fold: bool = False) -> DataFrame:
    """``compare_to_pin`` for a pin of ``pin_bucketed``: the same rows, without an
    exchange on the pin's side.

    ``fold`` counts ``df``'s repeated rows before they go to their buckets, at the
    price of a second exchange of ``df``; for results in which one whole row may
    hold a large share of all."""
    spark, path, names = df.sparkSession, path.rstrip("/"), df.columns
    layout = spark.read.schema("columns array<string>, buckets int").parquet(f"{path}/layout").first()
    pinned = _read_buckets(spark, f"{path}/rows", layout["columns"], layout["buckets"])
    check_same_schema(pinned.drop(COPIES), df)
    if net_col in names:
        raise SchemaMismatch(f"result already has a column named {net_col!r}")
    one = F.lit(1).cast("long").alias(net_col)
    new = df.groupBy(*columns(names)).agg(F.count("*").alias(net_col)) if fold else df.select(*columns(names), one)
    # the new side comes first: Spark takes a union's partitioning from it
    u = (new.repartition(layout["buckets"], *columns(layout["columns"]))
         .unionByName(pinned.select(*columns(names), (-F.col(COPIES)).alias(net_col))))
    return u.groupBy(*columns(names)).agg(F.sum(col(net_col)).alias(net_col)).filter(col(net_col) != 0)


def _holds_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return any(_holds_map(f.dataType) for f in dt.fields)
    return isinstance(dt, T.MapType) or isinstance(dt, T.ArrayType) and _holds_map(dt.elementType)


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a saved table through Spark's own file system layer.  Only
    paths under the shared folder's ``twinrun`` folder are accepted."""
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/twinrun/"
    if not path.startswith(root) or ".." in path:
        raise ValueError(f"{path} is not under {root}")
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is saved within goes to a folder of its own, deleted at the end.  Save
    what is to stay under a path from before, and within: plans that read the
    folder cannot run later.  A ``checkpoint()`` is not in the folder."""
    path = shared_path(spark, "scratch")
    token = FOLDER.set(path.rsplit("/twinrun/", 1)[1] + "/")
    try:
        yield
    finally:
        FOLDER.reset(token)
        discard(spark, path)


def _parquet_can_store(dt: T.DataType) -> bool:
    if isinstance(dt, (T.NullType, T.DayTimeIntervalType, T.YearMonthIntervalType,
                       T.CalendarIntervalType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_parquet_can_store(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _parquet_can_store(dt.elementType)
    if isinstance(dt, T.MapType):
        return _parquet_can_store(dt.keyType) and _parquet_can_store(dt.valueType)
    return True


#: whether a query's shuffle files go when it ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run within go as each ends, not when the
    driver's memory is next collected: what is saved never needs them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, path: str | None = None, **options: str) -> DataFrame:
    """Save ``df`` once in the shared folder named by ``spark.checkpoint.dir``
    and return a DataFrame reading the saved copy.

    Later actions read the saved rows instead of replaying history again,
    and a lost executor costs no recomputation of what was saved.  The copy
    is a parquet table (columnar, compressed, and sized for the planner's
    broadcast check); types parquet cannot hold fall back to a reliable
    ``checkpoint()`` in the same folder.  Never a local checkpoint.
    Shuffle files of the replay are removed once it is saved.
    ``options`` are those of the parquet writer.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not all(_parquet_can_store(f.dataType) for f in df.schema.fields):
        return df.checkpoint(eager=True)
    path = path or shared_path(spark, "materialized")
    with _without_shuffles(spark):
        df.write.mode("errorifexists").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no inference job
