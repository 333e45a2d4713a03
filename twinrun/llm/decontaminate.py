"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` words in a row the ``K``-gram of smallest hash is kept as a
fingerprint.  The choice depends on those words alone, so a window that a
document shares with a benchmark text has the same fingerprint in both:
every shared span of ``WINDOW`` words is found.  Fingerprints of documents
and benchmark are joined; each hit is extended over the windows that hold
it, and these are joined with the benchmark's windows as text, so a chance
equality of hashes never counts.

The documents' fingerprints are first looked up in a bitmap of the
benchmark's, of ``FILTER_BITS`` bits whatever the benchmark's size, which only
spares the shuffle what cannot join.  Both joins have the benchmark's distinct
values on one side, so a frequent passage makes no pairs.  Documents with the
same set of windows share one list of items.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.  An item of
fewer words than a window, but not none, is one window.

Cases: null or empty text has no words, so no window and no hit; very long
texts are scanned whole, one step each, and only their hits go on; ties
between equal hashes go to the last of the window in documents and
benchmark alike; repeated document rows are judged one by one; repeated item
rows (equal id) are one item, whose windows are those of all its rows, and a
null item id is the item "null"; an empty table of documents gives an empty
result, an empty benchmark no hit; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, saved
from .scan import item_prints, text_hits

WINDOW = 10
K = 5
FILTER_BITS = 24


def print_filter(prints: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A bitmap of 2**bits bits with those of the prints' leading bits set;
    what reaches the driver is the bitmap's words, never the prints."""
    bit = F.shiftrightunsigned("print", 64 - bits)
    words = (prints.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
             .toPandas())
    table = np.zeros(1 << bits - 6, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table.tobytes()


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, k: int, window: int) -> DataFrame:
    """``item``, ``width``, ``prints`` and ``windows`` of every benchmark row."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                            F.col(text_col).alias("text"))
    return saved(rows.mapInArrow(lambda b: item_prints(b, k, window),
                                 "item string, width long, prints array<long>, windows array<string>"))


def scanned(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, k: int, window: int) -> DataFrame:
    """``rid``, ``id``, ``n_words`` and candidate ``hits`` of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    prints = items.select(F.explode("prints").alias("print"))
    widths = sorted(r.width for r in items.filter("width > 0").select("width").distinct().collect())  # at most WINDOW
    bits = docs.sparkSession.sparkContext.broadcast(print_filter(prints))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("text"))
    return saved(rows.mapInArrow(
        lambda b: text_hits(b, k, window, widths, bits, 64 - FILTER_BITS),
        f"rid long, id {kind}, n_words long, "
        "hits array<struct<print: long, start: long, width: long, window: string>>"))


def occurrences(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(``rid``, ``start``, ``width``, ``class``): every place of a document where a
    window of the benchmark stands, ``class`` naming the set of items with it."""
    prints = saved(items.select(F.explode("prints").alias("print")).distinct())
    hits = lookup_join(texts.select("rid", F.explode("hits").alias("h")).select("rid", "h.*"),
                       prints, ["print"], "left_semi")
    places = hits.select("rid", "start", "width", "window").distinct()  # windows hold several prints
    owned = (items.select("item", F.explode("windows").alias("window")).distinct()
             .groupBy("window").agg(F.sort_array(F.collect_list("item")).alias("items")))
    windows = saved(owned.select("window", F.sha2(F.to_json("items"), 256).alias("class"), "items"))
    return (lookup_join(places, windows.select("window", "class"), ["window"], "inner")
            .select("rid", "start", "width", "class"), windows.select("class", "items"))


def covered(places: DataFrame) -> DataFrame:
    """(``rid``, ``n_hit``): how many words lie in some place."""
    before = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("width")
    spans = places.groupBy("rid", "start").agg(F.max(end).alias("end"))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("past", "start")))
    return (spans.withColumn("past", F.max("end").over(before))
            .groupBy("rid").agg(F.sum(fresh).cast("long").alias("n_hit")))


def found_items(places: DataFrame, classes: DataFrame) -> DataFrame:
    """(``rid``, ``item_ids``): the items of each document's windows, sorted as
    strings; lists are made once per distinct set of classes."""
    sets = saved(places.select("rid", "class").distinct().groupBy("rid")
                 .agg(F.sort_array(F.collect_list("class")).alias("classes"))
                 .select("rid", "classes", F.sha2(F.array_join("classes", ","), 256).alias("set")))
    members = classes.groupBy("class").agg(F.first("items").alias("items"))  # equal in all rows of a class
    lists = (sets.groupBy("set").agg(F.first("classes").alias("classes"))
             .select("set", F.explode("classes").alias("class"))
             .join(members, "class").select("set", F.explode("items").alias("item")).distinct()
             .groupBy("set").agg(F.sort_array(F.collect_list("item")).alias("item_ids")))
    return lookup_join(sets.select("rid", "set"), saved(lists), ["set"]).select("rid", "item_ids")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = K,
                  window: int = WINDOW) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit`` (words inside windows of
    the benchmark), ``item_ids`` (array, sorted as strings), ``contaminated``."""
    if not 1 <= k <= window:
        raise ValueError("a fingerprint has at least one word and at most a window")
    items = item_windows(benchmark, item_col, item_text_col, k, window)
    texts = scanned(docs, items, id_col, text_col, k, window)
    places, classes = occurrences(texts, items)
    places = saved(places)
    found = saved(covered(places).join(found_items(places, classes), "rid"))
    none = F.array().cast("array<string>")
    return lookup_join(texts.select("rid", "id", "n_words"), found, ["rid"]).select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
