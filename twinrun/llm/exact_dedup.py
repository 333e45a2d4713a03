"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary of each input partition names the digests that may be
frequent.  Their groups are counted and their winners found exactly, in one
map-side combined aggregation over at most ``counters`` keys, and are
broadcast (at most ``counters`` rows), so the rows of hot groups are settled
where they are read and never shuffled.  All other digests go through an
ordinary shuffle: none of them can hold many rows.  The summaries only
decide which way a digest takes, never the result.

Cases: null text counts as empty; of very long texts only the digest goes on; rows with a null id lose ties to rows
with one; of repeated rows (same id, same text) exactly one is kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, one_row_each, row_key, saved
from .kernels import misra_gries

COUNTERS = 4096


def text_digest(text):
    """SHA-256 (binary) of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(text, SPACE + "+", "").cast("binary"), 256))


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them every one with more than
    2/``counters`` of all rows; duplicates only."""
    found = digests.select("digest").mapInArrow(
        lambda batches: misra_gries(batches, counters), "digest binary, n long")
    return (found.groupBy("digest").agg(F.sum("n").alias("n"))
            .filter("n > 1").orderBy(F.desc("n"), "digest").limit(counters)
            .select("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, and (k1, k2), the key of its id and text.

    The row with most code points stays, then the smallest id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    digests = saved(docs.select(
        F.col(id_col).alias("id"), text_digest(text).alias("digest"),
        F.length(text).cast("long").alias("n_cp"), k1.alias("k1"), k2.alias("k2"),
        F.monotonically_increasing_id().alias("rid")))
    order = F.struct((-F.col("n_cp")).alias("a"), F.col("id").isNull().alias("b"),
                     F.col("id").alias("id"), F.col("k1").alias("k1"), F.col("rid").alias("rid"))
    heavy = saved(heavy_digests(digests, counters))
    winners = saved(digests.join(F.broadcast(heavy), "digest", "left_semi")
                    .groupBy("digest").agg(F.min(order).alias("w"),
                                           F.count("*").alias("group_size")))
    split = digests.join(F.broadcast(winners), "digest", "left")
    hot = split.filter("group_size is not null")
    group = Window.partitionBy("digest")
    cold = (digests.join(F.broadcast(heavy), "digest", "left_anti")
            .select("*", F.min(order).over(group).alias("w"),
                    F.count("*").over(group).alias("group_size")))
    return hot.unionByName(cold.select(*hot.columns)).select(
        F.col("id").alias(id_col), F.col("w.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("w.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "k1", "k2")


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the table's own columns; of rows equal in id
    and text one stays, whatever their other columns hold."""
    return one_row_each(docs, [id_col, text_col], exact_dedup(docs, id_col, text_col).filter("kept"))
