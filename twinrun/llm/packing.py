"""Packing by powers of two.

A document of n tokens is cut into floor(n / 2048) pieces of 2048 and one
piece for each binary digit of the rest: 1024, 512, ... 1.  Pieces of equal
length share a bucket, and each piece is a sequence of its own, so no
sequence crosses documents and none needs padding (all lengths are powers
of two).  Sequences are numbered bucket by bucket, longest first, without
gaps; a batch of a bucket has sequences of one length.

Tokens are written once.  The numbers need only counts: each task's pieces
per length (12 per task, broadcast) and each document's rank in its task.

Cases: null or empty text has only the end id; a very long text is a step of
its own and is cut into as many pieces as it needs; repeated rows are packed one
by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .kernels import piece_counts, piece_rows

MAX_LENGTH = 2048
END_ID = 1


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         max_length: int = MAX_LENGTH, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """One row per piece: id, ``start`` (its document's ids before it),
    ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, and ``tokens``, or
    with ``digest`` their CRC-32 as ``ids_crc32``."""
    top = max_length.bit_length() - 1
    if max_length != 1 << top:
        raise ValueError("max_length must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    coded = saved(rows.mapInArrow(
        lambda b: piece_counts(b, tokenizer, end_id, top),
        f"id {kind}, part int, pos long, tokens array<int>, n_tokens long, ranks array<long>"))

    n = F.col("n_tokens")
    per_length = [F.sum(F.shiftrightunsigned(n, k).bitwiseAND(1) if k < top else F.shiftright(n, top)).alias(f"k{k}")
                  for k in range(top + 1)]
    counts = coded.groupBy("part").agg(*per_length).select("part", F.posexplode(
        F.array(*[f"k{k}" for k in range(top + 1)])).alias("k", "n"))
    in_order = Window.orderBy(F.desc("k"), "part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (counts.select("part", "k", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("first"))
              .groupBy("part").agg(F.transform(
                  F.sort_array(F.collect_list(F.struct("k", "first"))), lambda x: x["first"]).alias("firsts")))
    last = "ids_crc32 long" if digest else "tokens array<int>"
    return (coded.join(F.broadcast(firsts), "part")  # one row per task that wrote tokens
            .select("id", "tokens", "n_tokens", "ranks", "firsts")
            .mapInArrow(lambda b: piece_rows(b, top, digest),
                        f"id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, {last}")
            .withColumnRenamed("id", id_col))
