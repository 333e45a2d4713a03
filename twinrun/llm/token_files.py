"""Token ids in Parquet files that can be read selectively.

Documents are put in id order by range partitioning and written as one file
per range: ``doc_id``, ``part``, ``pos``, ``n_tokens`` and the ids as a list
column.  Ids are dictionary-coded, the numbers beside them delta-coded
(data pages of version 2); row groups and pages are small enough that the
page index skips to a few documents, and metadata is read without the ids.

Cases: null or empty text has only the end id; a very long text is a step of
its own and one list; rows of equal id come in the
order of their text's hash, repeated rows one after the other; a null id
comes first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import partitions
from .kernels import crc_rows, encode_rows

END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000
#: bytes of text that are encoded at once: each step looks its chunks up in a table of earlier
#: ones that is hashed anew, so larger steps do that less often
STEP_BYTES = 6 << 20


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, path: str | None = None) -> str:
    """Write the token files and return their path."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("tie"))
    ordered = (rows.repartitionByRange(partitions(spark), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").drop("tie"))
    (ordered.mapInArrow(lambda b: encode_rows(b, tokenizer, end_id, STEP_BYTES),
                        "doc_id long, part int, pos long, tokens array<int>, n_tokens long")
     .write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1")
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", str(ROW_GROUP_BYTES)).option("parquet.page.size", str(PAGE_BYTES))
     .option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#pos", "false")
     .option("parquet.enable.dictionary#n_tokens", "false")
     .parquet(path))
    return path


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, part, pos, n_tokens, tokens); filters on doc_id skip row
    groups and pages, and columns not asked for are not read."""
    return spark.read.parquet(path)


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (with part, pos, n_tokens) plus ``start``, the ids of all
    documents before.  Only the files' counts are read; the offset of each
    part (one row a part) is broadcast."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
            .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    here = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("local", F.coalesce(F.sum("n_tokens").over(here), F.lit(0)))
            .join(F.broadcast(base), "part")
            .withColumn("start", F.col("base") + F.col("local")).drop("base", "local"))


def token_index(spark, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = read_tokens(spark, path)
    digests = files.select("doc_id", "part", "pos", "n_tokens", "tokens").mapInArrow(
        crc_rows, "doc_id long, part int, pos long, n_tokens long, ids_crc32 long")
    return with_starts(digests, files).select("doc_id", "start", "n_tokens", "ids_crc32")
