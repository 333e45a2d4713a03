"""Detection of periodic runs: stretches of words that repeat a period.

A run is a stretch of smallest period q (words q apart are identical) and
length at least max(``LEAST``, ``TIMES`` * q) that no neighbouring word extends.
Per text, the suffixes of its words are sorted, and the tree of their LCP
intervals is walked bottom-up with lists of places and their left words.  A
maximal pair (two places whose stretches agree and go no further to either
side) at distance q with q + depth >= max(LEAST, TIMES * q) is exactly a run,
so nothing is extended.  Only pairs that near count, so only nearest places
are compared and no pairs are listed.

A place takes part only if its first words stand a second time in the text
near enough for its longest common prefix, which leaves next to nothing of
ordinary texts; the rest is exact on numbers of words, not hashes.

Words are ``[^\\x20\\x09-\\x0D]+``, as they are.  Each row stands alone, so nothing
is shuffled.

Cases: null, empty or blank text has no words, no runs and the digest of the
empty string; very long texts are one step of their task, with memory in
proportion to their words; of equal length/period the smallest start, then
period is the greatest run; repeated rows each give a row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD
from .lcp_tree import run_rows

LEAST = 6
TIMES = 4


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text",
              least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per row: id, ``n_words``, ``runs`` (array of start, length, period, by
    start, then period) and ``collapsed_sha256`` of the words without those
    that lie in a run after its first period."""
    if least < 2 or times < 2:
        raise ValueError("a run repeats its period at least once")
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(
        lambda b: run_rows(b, least, times),
        f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "collapsed_sha256 string").withColumnRenamed("id", id_col)


def greatest_run(runs: Column) -> Column:
    """The run of greatest exact length/period (null without one), ties to the
    smallest start, then period."""
    def better(a, b):  # a is first by start, then period
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    kind = "struct<start: long, length: long, period: long>"
    return F.aggregate(runs, F.lit(None).cast(kind), better)


def periodic_tail(id_col: Column, text: Column) -> Column:
    """The contract's planted text: with h = crc32 of the decimal id and g =
    floor(h / 10), where 10 divides h each word from a = g % n on is that of
    place a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)); words are then
    joined by one space.  Other texts (and those of a null id) stay."""
    h = F.crc32(id_col.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1)).cast("long")
    g = F.floor(h / 10)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    one, start, period = F.lit(1), a.cast("int"), p.cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, start + 1, period), (F.floor((n - a) / p) + 1).cast("int")))
    planted = F.slice(F.concat(F.slice(words, one, start), again), one, n.cast("int"))
    return F.when((h % 10 == 0) & text.rlike(WORD), F.array_join(planted, " ")).otherwise(text)
