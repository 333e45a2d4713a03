import pytest
from pyspark.sql import functions as F

from twinrun.functions.schema import SchemaMismatch, check_same_schema
from twinrun.operators.diff import diff_rows


@pytest.fixture()
def base(spark):
    return spark.createDataFrame([(1, 2, "x"), (3, 4, "y")], "a long, b long, c string")


def test_equal_schemas_pass(base):
    check_same_schema(base, base.select("*"))


def test_renamed_column_refused(base):
    with pytest.raises(SchemaMismatch, match="names differ"):
        check_same_schema(base, base.withColumnRenamed("c", "d"))


def test_reordered_columns_refused(base):
    # exceptAll would match these by position and see no difference
    with pytest.raises(SchemaMismatch, match="order differs"):
        check_same_schema(base, base.select("b", "a", "c"))


@pytest.mark.parametrize("to", ["int", "string", "double", "decimal(20,0)"])
def test_changed_type_refused(base, to):
    with pytest.raises(SchemaMismatch, match="types differ"):
        diff_rows(base, base.withColumn("a", F.col("a").cast(to)))


def test_nullability_ignored(spark, base):
    strict = spark.createDataFrame(base.rdd, base.schema.fromJson({
        "type": "struct", "fields": [
            {"name": "a", "type": "long", "nullable": False, "metadata": {}},
            {"name": "b", "type": "long", "nullable": True, "metadata": {}},
            {"name": "c", "type": "string", "nullable": False, "metadata": {}}]}))
    assert strict.schema != base.schema
    check_same_schema(strict, base)
    assert diff_rows(strict, base).count() == 0


def test_nested_type_change_refused(spark):
    a = spark.createDataFrame([(1, [1, 2])], "k long, v array<int>")
    b = spark.createDataFrame([(1, [1, 2])], "k long, v array<long>")
    with pytest.raises(SchemaMismatch, match="v: old=array<int> new=array<bigint>"):
        check_same_schema(a, b)


def test_repeated_names_refused(base):
    twice = base.select("a", "b", F.col("c").alias("a"))
    with pytest.raises(SchemaMismatch, match="repeated column names"):
        check_same_schema(twice, twice)


def test_variant_refused(spark):
    v = spark.sql("SELECT 1L AS k, parse_json('{\"a\": 1}') AS v")
    with pytest.raises(SchemaMismatch, match="variant"):
        diff_rows(v, v)
