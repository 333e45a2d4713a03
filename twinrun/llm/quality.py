"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose score reaches a cutoff.  Cutoffs come
from the labelled documents, per stratum (language) and rule: of a fixed
ladder, from lenient to strict, the strictest cutoff is taken at which the
exact binomial test still shows, that the rule rejects less than ``risk`` /
(number of rules) of the good documents of that stratum.

* Exact bound: with k of n good labelled documents rejected, a cutoff
  passes when P(Binomial(n, risk per rule) <= k) <= level.  This is the
  Clopper-Pearson upper bound being below the risk.
* Multiple tests: the ladder is tested in order and stops at the first
  failure (fixed-sequence testing needs no further correction); over rules
  and strata the level is ``delta`` divided by their number (Bonferroni).
  So with probability 1 - ``delta`` no stratum loses more than ``risk`` of
  its good documents to all rules together.
* The rules and the ladder are fixed beforehand, so every labelled document
  is holdout data.  A stratum with too few labels gets no cutoff: all its
  documents that pass the base rules stay.

DataFrame functions only.  Scores are whole numbers, so nothing depends on
the order of floating point additions.

Cases: null or empty text has no words and fails the base rules; a null
stratum is a stratum of its own; repeated rows are judged one by one; a
document labelled twice counts as good if any label says so; very long texts
are judged whole, with their words as one array of a row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, lookup_join, row_key, rows_of, saved

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
RISK = 0.05
DELTA = 0.05

# Per rule its ladder of cutoffs, lenient first.  Shares are
# per thousand; word length is in hundredths of a character.
SHARES = (1000, 900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 150, 100, 75, 50, 40, 30, 20, 10, 5)
LADDERS = {
    "symbols": SHARES,
    "dup_lines": SHARES,
    "repeats": SHARES,
    "long_words": (2000, 1500, 1200, 1100, 1000, 950, 900, 850, 800, 775, 750, 725, 700, 680, 660, 640, 620, 600),
    "short_words": (1000, 900, 800, 700, 600, 500, 450, 400, 350, 320, 300, 290, 280, 270, 260, 250, 240, 230),
}


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window of ``width`` words that the array has
    at least twice.  Windows are compared by 64-bit hash: sorted with their
    positions, equal neighbours mark repeated windows, whose union is then
    measured.  Linear in the text but for the two sorts."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - (width - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(n >= width, hashes)


def base_features(docs: DataFrame, id_col: str, text_col: str, stratum_col: str,
                  key: tuple[Column, Column] | None = None) -> DataFrame:
    """id, stratum, row key, word and line counts, and ``base_failed``."""
    k1, k2 = key or row_key(F.col(id_col), F.col(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    step = docs.select(
        F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"),
        k1.alias("k1"), k2.alias("k2"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        lines.alias("lines"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    step = step.select(
        "id", "stratum", "k1", "k2", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("windows"))
    # only documents with a repeated window are sorted
    step = step.withColumn("ranked", F.when(
        F.size("windows") > F.size(F.array_distinct("windows")),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    ranked = F.col("ranked")
    same = lambda j, k: F.get(ranked, j)["h"] == F.get(ranked, k)["h"]
    step = step.withColumn("at", F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("ranked") - 1),
                 lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False))),
        lambda j: F.get(ranked, j)["i"])))
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    step = step.withColumn("n_repeat_words", F.when(F.col("ranked").isNotNull(), covered).otherwise(F.lit(0).cast("long")))
    return step.select(
        "id", "stratum", "k1", "k2", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("base_failed"))


def scores() -> dict[str, Column]:
    """Score of each rule; a document is worse the higher it is."""
    per = lambda a, b, m: F.expr(f"coalesce({m} * {a} div nullif({b}, 0), 0)")
    return {
        "symbols": per("n_symbols", "word_chars", 1000),
        "dup_lines": per("n_dup_lines", "n_lines", 1000),
        "repeats": per("n_repeat_words", "n_words", 1000),
        "long_words": per("word_chars", "n_words", 100),
        "short_words": per("n_words", "word_chars", 1000),
    }


def binomial_below(k: Column, n: Column, p: float, level: Column) -> Column:
    """P(Binomial(n, p) <= k) <= level, exactly (to double precision).

    The sum is taken relative to its last term, T(i) = 1 + ratio(i) T(i-1),
    beside the logarithm of that term, so it neither under- nor overflows.
    Only needed for k below the mean; above it the answer is no."""
    step = lambda acc, i: F.struct(
        (acc["lp"] + F.log((n - i + 1) / i * (p / (1 - p)))).alias("lp"),
        (1 + acc["t"] * (i * (1 - p)) / ((n - i + 1) * p)).alias("t"))
    start = F.struct((n * F.log1p(F.lit(-p))).alias("lp"), F.lit(1.0).alias("t"))
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    log_cdf = F.aggregate(steps, start, step, lambda acc: acc["lp"] + F.log(acc["t"]))
    return F.when(k >= n * p, F.lit(False)).otherwise(log_cdf <= F.log(level))


def cutoffs(features: DataFrame, labels: DataFrame, id_col: str = "doc_id",
            label_col: str = "quality", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff column per rule (null: the rule is
    off), from the labelled documents that pass the base rules."""
    good = (labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("q"))
            .filter("q = 1 and id is not null").select("id"))
    held = features.filter(~F.col("base_failed")).join(good, "id", "left_semi")
    s = scores()
    held = held.select(F.coalesce("stratum", F.lit("")).alias("stratum"), F.col("stratum").isNotNull().alias("has"),
                       *[s[r].alias(r) for r in LADDERS])
    counts = held.groupBy("stratum", "has").agg(
        F.count("*").alias("n"),
        *[F.sum(F.when(F.col(r) >= c, 1).otherwise(0)).alias(f"{r}_{c}")
          for r, ladder in LADDERS.items() for c in ladder])
    strata = counts.agg(F.count("*").alias("strata"))
    counts = counts.crossJoin(F.broadcast(strata))  # one row
    level = F.lit(delta) / (F.col("strata") * len(LADDERS))
    passed = lambda r, c: binomial_below(F.col(f"{r}_{c}").cast("long"), F.col("n").cast("long"), risk / len(LADDERS), level)
    # k only grows along the ladder, so the strictest passing cutoff is where
    # the test in order stops
    return counts.select("stratum", "has", "n", *[
        F.least(*[F.when(passed(r, c), F.lit(c)) for c in ladder]).alias(f"cut_{r}")
        for r, ladder in LADDERS.items()])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", label_col: str = "quality",
                  risk: float = RISK, delta: float = DELTA,
                  key: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per input row: id, the base features, ``base_failed``,
    ``kept``, ``failed_rules`` and (k1, k2), the row's ``key`` (of id and text)."""
    features = saved(base_features(docs, id_col, text_col, stratum_col, key))
    cuts = saved(cutoffs(features, labels, id_col, label_col, risk, delta))
    s = scores()
    judged = lookup_join(
        features.withColumn("has", F.col("stratum").isNotNull())
        .withColumn("stratum", F.coalesce("stratum", F.lit(""))),
        cuts.drop("n"), ["stratum", "has"])
    failed = F.array_compact(F.array(*[F.when(s[r] >= F.col(f"cut_{r}"), F.lit(r)) for r in LADDERS]))
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
        failed.alias("failed_rules"), "k1", "k2")


def quality_kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 stratum_col: str = "lang") -> DataFrame:
    """The rows that pass, each as often as it is there, with the table's own
    columns.  The verdict depends on id, text and stratum alone, so rows equal
    in these share it, whatever their other columns hold."""
    read = [id_col, text_col, stratum_col]
    verdict = quality_rules(docs, labels, *read, key=row_key(*[F.col(c) for c in read]))
    return rows_of(docs, read, verdict.filter("kept"))


__all__: Sequence[str] = ("quality_rules", "quality_kept", "cutoffs", "base_features", "binomial_below")
