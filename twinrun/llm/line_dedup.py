"""Line deduplication with levelled sorted runs.

A store holds runs: tables of (line hash, number of documents), sorted by
hash.  A batch of documents adds one run at level 0; when a level has
``fanout`` runs they are merged into one run of the next level, so a store
of b batches holds O(log b) runs and each hash is rewritten O(log b) times.
Each batch is merge-anti-joined with the runs when it arrives: lines whose
hash the runs already show in ``min_docs`` documents go at once and are not
counted any more; the others are added as the batch's own run.  Since a line
may become frequent only later, those that had arrived before are
merge-anti-joined once more after the last batch.

Line texts are never shuffled: the runs and the join see a 128-bit hash of
the key, the document's row key and the line's number.

Cases: a document is a distinct (id, text) row: repeated rows count once
and all get the same result; null or empty text is one empty line; lines
with an empty key always stay; of a very long text only hashes and line
numbers are shuffled, and its numbers meet in one row; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import SPACE_CHARS, ascii_lower, row_key, saved

MIN_DOCS = 10
MIN_KEY_CHARS = 1
BATCHES = 6
FANOUT = 3


class RunStore:
    """Levelled runs of (h1, h2, n_docs), each a saved table sorted by hash."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    @staticmethod
    def _run(df: DataFrame) -> DataFrame:
        return saved(df.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
                     .sortWithinPartitions("h1", "h2"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch: ``lines`` has (k1, k2, h1, h2); a document must lie
        in one batch as a whole."""
        one = lines.select("h1", "h2", "k1", "k2").distinct()
        self._push(0, self._run(one.select("h1", "h2", F.lit(1).cast("long").alias("n_docs"))))

    def arrive(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """A batch meets the runs: the lines that they do not show in ``min_docs``
        documents are added as a run, and returned as a saved table."""
        fresh = saved(self.anti_join(lines, min_docs))
        self.add(fresh)
        return fresh

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self._union(self.levels[level]), []
            self._push(level + 1, self._run(merged))

    def _union(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    def runs(self) -> DataFrame | None:
        found = [r for level in self.levels for r in level]
        return self._union(found) if found else None

    def frequent(self, min_docs: int) -> DataFrame | None:
        """Hashes that the runs show in at least ``min_docs`` documents, as a
        saved table, so that joins with it can be split where a key is hot."""
        runs = self.runs()
        if runs is None:
            return None
        return saved(runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
                     .filter(F.col("n_docs") >= min_docs).select("h1", "h2"))

    def anti_join(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """The lines whose hash the runs do not show ``min_docs`` times."""
        known = self.frequent(min_docs)
        return lines if known is None else lines.join(known.hint("merge"), ["h1", "h2"], "left_anti")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """One row per line: row key (k1, k2), line number, ``counted`` (its key
    is long enough to be dropped), and the hash of its key."""
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    lines = docs.select(k1.alias("k1"), k2.alias("k2"), F.posexplode(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("line_no", "line"))
    keyed = lines.select("k1", "k2", "line_no", line_key(F.col("line")).alias("key"))
    return keyed.select("k1", "k2", "line_no", (F.length("key") >= min_chars).alias("counted"),
                        F.xxhash64(F.lit("a"), "key").alias("h1"), F.xxhash64(F.lit("b"), "key").alias("h2"))


def in_batches(lines: DataFrame, batches: int) -> DataFrame:
    """The lines as a table with a folder for each batch, so that a batch reads
    its own lines only; a document lies in one batch as a whole."""
    spark, path = lines.sparkSession, shared_path(lines.sparkSession, "lines")
    dealt = lines.withColumn("batch", F.pmod(F.col("k1"), F.lit(batches)).cast("int"))
    dealt.write.partitionBy("batch").parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = MIN_DOCS, min_chars: int = MIN_KEY_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Lines whose key occurs in at least ``min_docs`` documents leave every
    document.  One row per input row: id, ``text`` (what stays), ``n_lines``,
    ``n_dropped``."""
    lines = in_batches(line_hashes(docs, id_col, text_col, min_chars), batches)
    store = RunStore(docs.sparkSession, fanout)
    fresh = [store.arrive(lines.filter((F.col("batch") == b) & F.col("counted")).drop("batch"), min_docs)
             for b in range(batches)]
    stays = (store.anti_join(reduce(DataFrame.unionByName, fresh), min_docs).select("k1", "k2", "line_no")
             .unionByName(lines.filter("not counted").select("k1", "k2", "line_no"))
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("line_no")).alias("stays")))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       k1.alias("k1"), k2.alias("k2"))
    out = (rows.join(stays, ["k1", "k2"], "left")
           .select("id", F.split("text", "\n", -1).alias("lines"),
                   F.coalesce("stays", F.array().cast("array<int>")).alias("stays")))
    return out.select(
        F.col("id").alias(id_col),
        F.array_join(F.transform("stays", lambda i: F.get(F.col("lines"), i)), "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stays")).cast("long").alias("n_dropped"))
