"""Importance resampling towards a target distribution, on hashed n-grams
whose CRCs come from prefix CRCs.

Each text is normalised (words joined by one space) and scanned once for the
running CRC-32 after every word.  The CRC of any n-gram follows from two of
these prefixes: the one before it, carried over the n-gram's length by
linear maps over GF(2), cancels out of the one after it.  A feature's
bucket is that CRC modulo ``BUCKETS``.

Counts per bucket over all documents and all target texts give every
bucket's gain, 1000 times the log ratio of the smoothed frequencies; a
document's weight is the mean gain of its features; with Gumbel noise from a
hash of its id, the highest scores are a sample without replacement, drawn
in proportion to the weights.  The noise and the order are functions of the
id, so reruns agree.

What the driver and the tasks share is one array of ``BUCKETS`` gains.  Ranks
come from a range partition's running count, never from one task.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.

Cases: null or empty text has no words, no features and weight 0; very long
texts are scanned whole, one step each; ties in score go to the smaller id,
rows without an id last, then to the row read first; repeated rows are drawn
one by one; a null id takes its noise from "null"; an empty table of documents
gives an empty result, an empty target only the smoothed gains; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, running_totals, saved
from .scan import bucket_counts, bucket_means, feature_buckets

MAX_N = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"


def features(docs: DataFrame, text_col: str, max_n: int, buckets: int, id_col: str | None = None) -> DataFrame:
    """``rid``, ``id``, ``n_words`` and the ``buckets`` of all features of every row."""
    kind = docs.schema[id_col].dataType.simpleString() if id_col else "string"
    rows = docs.select(F.monotonically_increasing_id().alias("rid"),
                       (F.col(id_col) if id_col else F.lit(None).cast("string")).alias("id"),
                       F.col(text_col).alias("text"))
    return saved(rows.mapInArrow(lambda b: feature_buckets(b, max_n, buckets),
                                 f"rid long, id {kind}, n_words long, buckets array<int>"))


def counted(rows: DataFrame, buckets: int) -> DataFrame:
    """(``bucket``, ``n``) over all rows: each task sends its counts, at most one
    row per bucket."""
    return (rows.select("buckets").mapInArrow(lambda b: bucket_counts(b, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, as an array of ``buckets`` numbers."""
    s, t = counted(docs, buckets), counted(target, buckets)
    both = (docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
            .join(s.withColumnRenamed("n", "s"), "bucket", "left")
            .join(t.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"]))
    total = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    d = lambda c, k: F.col(c).cast("double") + F.lit(float(k))
    gain = F.floor(F.lit(1000.0) * F.log(d("t", 1) * d("all_s", buckets) / (d("s", 1) * d("all_t", buckets))))
    rows = both.crossJoin(F.broadcast(total)).select("bucket", gain.alias("gain")).toPandas()  # one-row total
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["gain"].to_numpy(np.int64)
    return out


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """One row per document: id, ``n_features``, ``weight``, ``score`` and ``rank``
    among the drawn (null: not drawn)."""
    held = features(docs, text_col, max_n, buckets, id_col)
    gains = bucket_gains(held, features(target, target_col, max_n, buckets), buckets)
    kind = held.schema["id"].dataType.simpleString()
    weighed = held.mapInArrow(lambda b: bucket_means(b, gains),
                              f"rid long, id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(u)))
    scored = saved(weighed.withColumn("score", (F.col("weight") + noise).cast("long")))
    able = scored.filter(F.col("n_words") >= min_words)
    draws = able.agg(F.floor(F.count("*") * percent / 100).cast("long").alias("n")).first()["n"]
    ranked = running_totals(able.select((-F.col("score")).alias("low"), "id", "rid"),
                            [F.col("low"), F.col("id"), F.col("rid")], {"before": F.lit(1)})
    drawn = saved(ranked.filter(F.col("before") < draws).select("rid", (F.col("before") + 1).alias("rank")))
    return lookup_join(scored, drawn, ["rid"]).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
