"""The corpus pipeline: five operators of ``twinrun.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinrun.llm.common import saved, table
from twinrun.llm.exact_dedup import dedup_rows
from twinrun.llm.mixing import mixed_rows
from twinrun.llm.ngram_join import near_dedup_rows
from twinrun.llm.packing import pack
from twinrun.llm.quality import quality_kept
from twinrun.llm.tokenizer import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules: every such row, with its own columns.

    Null, empty and short texts fail; repeated rows share their verdict and stay
    as often as they are there; an empty table stays empty; without labels
    only the base rules reject; very long texts are judged whole."""
    return quality_kept(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the most code
    points, then the smallest id.

    Null counts as empty; a null id loses ties; of repeated rows one stays, by
    content and not by order; an empty table stays empty; of very long texts
    only digests are compared."""
    return dedup_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id.

    Rows without words are copies of nothing and all stay; a null id loses ties;
    of repeated rows one stays; an empty table stays empty; very long texts
    are compared whole, as sets of hashes."""
    return near_dedup_rows(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken, with its own columns.

    Null and empty texts have no words and are not taken; a null source is a
    source; repeated rows are taken one by one; ties follow a hash of the id;
    an empty table stays empty; very long texts are only counted."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix's documents, by power of two.

    Null and empty texts are the end id alone; repeats and rows of a null id
    are documents of their own; an empty table has no pieces; a very long text
    is cut into as many pieces as it needs."""
    return pack(docs, tokenizer_path(), digest=True)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("mixing", mixing), ("packing", packing)]

#: SQL cannot tokenize, so the whole is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
