"""Jaccard join of documents as sets of word shingles, as a metric-space join.

Jaccard distance is a metric, so a pivot's region and the triangle
inequality say which documents can be linked.  Only documents that share
shingles are nearer than 1 to each other, so regions start from shared ones:

1. Equal sets are one class; one row per class goes on.
2. A class is sketched by its ``SKETCH`` smallest shingle hashes.  Of two
   linked sets at least ``LEAST`` of the union's smallest hashes are shared:
   always, for sets up to the sketch's size; else but for a chance below 1e-12
   per pair at a similarity of just 0.75, and far less above it.  So linked
   classes also share one of their rarest SKETCH - LEAST + 1 values, by
   exact counts over the corpus.
3. The classes that have such a value form a group, and its class of
   smallest hash is the group's pivot.  A pivot's region is all its groups.
   Regions of small groups are cut into the connected parts of what sizes
   and sketches leave possible, then each joined exactly in one task, by
   step 4's pivots, cells and windows in memory (``kernels.voronoi_links``).
4. Larger groups are cells, split in rounds.  Each round takes ``PIVOTS``
   pivots per cell and the exact distance of every member to them.  Members
   within reach of a pivot are linked to it, and the links' components tell
   what is connected already.  Members outside the cell's largest component
   still ask for links; only they are copied.  Where some members have
   stopped asking in an earlier round, it is their component that counts.
   Every member lies in the Voronoi cell of its nearest pivot if that is
   within 1/2, else in an outer cell.  With r = 1/4, a member x that asks also visits
   - each cell q with d(x, q) <= d(x, home) + 2r, if its home is within 1/2;
   - each cell q with d(x, q) <= 3r, if it is an outer one, which holds for
     all that a member of that cell can be linked with;
   - the outer cell, if d(x, home) > r.
   Members farther than r from the distances of all that ask in their cell
   stay behind, as do pivots, which are settled, and cells where none asks.
   A cell that its windows do not divide (its parts would have more pairs to
   compare) stays whole, with fewer that ask.
   Cells of at most ``REGION`` rows are joined in one task, which goes on
   with pivots and cells of its own.  In what is larger
   after ``ROUNDS`` rounds, or once a round does not halve what is left to
   compare, those that ask are held against all, in blocks.
5. Links are gathered as spanning links only, and their connected components
   give the component of each class.

Words are what ASCII white space separates, A-Z lower-cased.  Two documents
link when 100 * intersection >= 75 * union.

Cases: a very long text is a set of hashes, read whole and compared whole;
null, empty or blank text has an empty set and links with nothing,
not even with other such rows; fewer words than a shingle make one shingle;
repeated rows share class and result; a component's id is the smallest
non-null id in it, null if all are null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, one_row_each, row_key, saved
from .components import connected_components
from .kernels import (candidate_regions, pivot_distances, region_links, shingle_blobs,
                      shingle_sketches)

WIDTH = 5
PERCENT = 75
SKETCH = 96
ERROR = 1e-12
GROUP = 64
REGION = 1024
PIVOTS = 8
ROUNDS = 3
BLOCK = 512
EPS = 1e-9


def least_shared(percent: int) -> int:
    """LEAST: so many of a union's SKETCH smallest hashes are shared, but for
    a chance of at most ERROR, by a pair whose similarity is just ``percent``."""
    p, least, below = percent / 100, 0, (1 - percent / 100) ** SKETCH
    while below <= ERROR and least < SKETCH:  # the chance of sharing at most ``least``
        least += 1
        below += comb(SKETCH, least) * p ** least * (1 - p) ** (SKETCH - least)
    return max(least, 1)


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """id, row key, set size ``n``, class ``c`` and ``sketch`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    return saved(rows.mapInArrow(
        lambda b: shingle_sketches(b, width, SKETCH),
        f"id {kind}, k1 long, k2 long, n long, c binary, sketch array<long>"))


def shared_values(classes: DataFrame, percent: int) -> DataFrame:
    """(m, rid, n, score): each class under those of its rarest SKETCH - LEAST
    + 1 sketch values that another class has too.  ``score`` is how many
    classes have a value of it on average: high in the middle of a group of
    copies."""
    size = F.least(F.col("n"), F.lit(SKETCH))
    items = classes.select("rid", "n", F.explode("sketch").alias("m"))
    counts = saved(items.groupBy("m").agg(F.count("*").alias("count")).filter("count > 1"))
    ranked = (items.join(counts, "m").groupBy("rid", "n")
              .agg(F.sort_array(F.collect_list(F.struct("count", "m"))).alias("ms"),  # at most SKETCH
                   (F.sum("count") / F.first(size)).alias("score")))
    least = F.least(F.lit(least_shared(percent)), F.ceil(F.col("n") * percent / 100))
    alone = size - F.size("ms")  # values of no other class are the rarest
    take = F.greatest(F.lit(0), size - least + 1 - alone).cast("int")
    return saved(ranked.select("rid", "n", "score", F.explode(F.slice("ms", F.lit(1), take)).alias("v"))
                 .select("rid", "n", "score", F.col("v.m").alias("m")))


def in_groups(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key)


def voronoi_round(cells: DataFrame, blobs: DataFrame, links: DataFrame | None, percent: int,
                  turn: int) -> tuple[DataFrame, DataFrame]:
    """One round over ``cells`` (cell, rid, root, asks, score): (all links of
    large cells so far, smaller cells).  The pivots are the rows of highest
    score: the text that others are copies of links with most of them."""
    reach = 1 - percent / 100
    home_reach = 2 * reach
    best = Window.partitionBy("cell").orderBy(F.desc("asks"), F.desc("score"), F.xxhash64("rid"), "rid")
    chosen = cells.withColumn("i", F.row_number().over(best)).filter(F.col("i") <= PIVOTS).select("cell", "rid")
    pivots = saved(chosen.join(blobs, "rid").groupBy("cell").agg(
        F.collect_list(F.struct(F.col("rid").alias("pivot"), "shingles")).alias("pivots")))  # PIVOTS at most
    far = saved(cells.select("cell", "rid").join(blobs, "rid").join(pivots, "cell")
                .select("cell", "rid", "shingles", "pivots").mapInArrow(
        pivot_distances, "cell long, rid long, near array<struct<pivot:long,shared:long,either:long>>"))
    new = (far.select("rid", F.explode("near").alias("x"))
           .filter((100 * F.col("x.shared") >= percent * F.col("x.either")) & (F.col("x.pivot") != F.col("rid")))
           .select(F.col("rid").alias("a"), F.col("x.pivot").alias("b")))
    links = saved(new if links is None else links.unionByName(new).distinct())
    roots = connected_components(links).withColumnRenamed("node", "rid")

    rows = saved(far.select("cell", "rid", F.transform("near", lambda x: F.struct(
        (1 - x["shared"] / x["either"]).alias("d"), x["pivot"].alias("q"))).alias("near"))
        .join(roots, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
        .withColumn("home", F.array_min("near"))
        .join(cells.select("cell", "rid", F.col("asks").alias("asked"), "score"), ["cell", "rid"]))
    # rows that no longer ask are of one component: no other may join them, or
    # pairs of the two would have no side that asks
    silent = (F.count_if(~F.col("asked")) > 0).alias("silent")
    largest = (rows.groupBy("cell", "root").agg(silent, F.count("*").alias("count")).groupBy("cell")
               .agg(F.max(F.struct("silent", "count", "root"))["root"].alias("largest")))
    rows = (rows.join(largest, "cell")
            .withColumn("asks", F.col("asked") & (F.col("root") != F.col("largest")))
            .filter("home.q <> rid"))  # pivots are settled
    inner = F.col("home.d") <= home_reach + EPS
    outer = F.xxhash64("cell", F.lit("outer"))
    spot = lambda cell, d, visit: F.struct(cell.alias("cell"), d.alias("d"), visit.alias("visit"))
    none = F.lit(None).cast("double")
    at_home = spot(F.when(inner, F.xxhash64("cell", "home.q")).otherwise(outer),
                   F.when(inner, F.col("home.d")), F.lit(False))
    window = F.when(inner, F.col("home.d") + home_reach).otherwise(home_reach + reach) + EPS
    visits = F.transform(
        F.filter("near", lambda x: (x["d"] <= window) & (~inner | (x["q"] != F.col("home.q")))),
        lambda x: spot(F.xxhash64("cell", x["q"]), x["d"], F.lit(True)))
    to_outer = F.when(inner & (F.col("home.d") > reach - EPS), F.array(spot(outer, none, F.lit(True))))
    empty = F.array().cast("array<struct<cell:bigint,d:double,visit:boolean>>")
    spots = F.concat(F.array(at_home), F.when(F.col("asks"), F.concat(visits, F.coalesce(to_outer, empty))).otherwise(empty))
    rows = saved(rows.select("cell", "rid", "root", "asks", "score", spots.alias("spots")))
    placed = rows.select(F.col("cell").alias("whole"), "rid", "root", "asks", "score", F.explode("spots").alias("s")).select("s.*", "whole", "rid", "root", "asks", "score")
    asked = F.when(F.col("asks"), F.col("d"))
    used = (placed.groupBy("cell").agg(F.max("asks").alias("any"), F.min(asked).alias("low"), F.max(asked).alias("high"),
                                       F.count_if(~F.col("visit")).alias("own"))
            .filter("any and own > 0"))
    near_enough = F.coalesce(F.col("d").between(F.col("low") - reach - EPS, F.col("high") + reach + EPS), F.lit(True))
    split = saved(placed.join(used, "cell").filter(F.col("asks") | near_enough)
                  .select("whole", "cell", "rid", "root", "asks", "score"))

    # a cell whose parts would leave more to compare than itself stays whole
    effort = (F.count("*") * F.count_if("asks")).cast("decimal(38,0)").alias("effort")
    by_parts = split.groupBy("whole", "cell").agg(effort).groupBy("whole").agg(F.sum("effort").alias("parts"))
    choice = saved(rows.groupBy("cell").agg(effort).join(by_parts, F.col("cell") == F.col("whole"), "left")
                   .filter("effort > 0").select("cell", (F.coalesce("parts", F.lit(0)) < F.col("effort")).alias("parted")))
    parted = choice.filter("parted").select(F.col("cell").alias("whole"))
    kept = rows.join(choice.filter("not parted").select("cell"), "cell", "left_semi")
    return links, saved(split.join(parted, "whole", "left_semi").select("cell", "rid", "root", "asks", "score")
                        .unionByName(kept.select("cell", "rid", "root", "asks", "score")))


def block_pairs(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """(task, rid, root, asks): in each cell, every block of rows that ask
    beside every block of all rows.  Rows that ask are sent once per block of
    all, and any row once per block of those that ask."""
    of_all, of_asking = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("rows", "asking"))
    spread = F.xxhash64(F.lit("block"), "rid")
    rows = cells.join(sizes, "cell").select("cell", "rid", "root", "asks", F.pmod(spread, of_all).alias("c"),
                                            F.pmod(spread, of_asking).alias("r"), of_all.alias("cs"), of_asking.alias("rs"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    asking = rows.filter("asks").select("cell", "rid", "root", "asks", "r", each(F.col("cs")).alias("c"))
    any_row = rows.select("cell", "rid", "root", F.lit(False).alias("asks"), each(F.col("rs")).alias("r"), "c")
    both = (asking.unionByName(any_row).groupBy("cell", "r", "c", "rid")
            .agg(F.max("asks").alias("asks"), F.first("root").alias("root")))
    return both.select(F.xxhash64("cell", "r", "c").alias("task"), "rid", "root", "asks")


def class_links(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes that connect them as all links would."""
    posts = shared_values(classes, percent)
    groups = saved(posts.groupBy("m").agg(
        F.count("*").alias("rows"),
        F.min(F.struct(F.xxhash64("rid").alias("h"), F.col("rid").alias("rid")))["rid"].alias("pivot")).filter("rows > 1"))
    regions = saved(posts.join(groups, "m").select(
        "pivot", "rid", "n", "score", (F.col("rows") > GROUP).alias("large")).distinct())
    small = (regions.filter("not large").select("pivot", "rid", "n")
             .join(classes.select("rid", "sketch"), "rid").select("pivot", "rid", "n", "sketch"))
    least = least_shared(percent)
    parts = saved(in_groups(small, "pivot").mapInArrow(
        lambda b: candidate_regions(b, least, percent), "part long, rid long").distinct())
    cells = saved(regions.filter("large").select(
        F.col("pivot").alias("cell"), "rid", F.col("rid").alias("root"), F.lit(True).alias("asks"), "score"))

    wanted = parts.select("rid").unionByName(cells.select("rid")).distinct().join(
        classes.select("rid", "k1", "k2"), "rid")
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    texts = (docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
             .groupBy("k1", "k2").agg(F.first("text").alias("text")))
    blobs = saved(texts.join(wanted, ["k1", "k2"]).select("rid", "text").mapInArrow(
        lambda b: shingle_blobs(b, width), "rid long, shingles binary"))

    def joined(rows: DataFrame, key: str) -> DataFrame:
        return saved(in_groups(rows.join(blobs, "rid").select(key, "rid", "root", "asks", "shingles"), key).mapInArrow(
            lambda b: region_links(b, key, percent), "a long, b long"))

    found, large, effort = [], None, None
    for turn in range(ROUNDS + 1):
        sizes = saved(cells.groupBy("cell").agg(F.count("*").alias("rows"), F.count_if("asks").alias("asking")))
        todo = sizes.agg(F.sum((F.col("rows") * F.col("asking")).cast("decimal(38,0)")), F.max("rows")).first()
        direct = cells.join(sizes.filter(F.col("rows") <= REGION), "cell").select("cell", "rid", "root", "asks")
        if turn == 0:
            direct = direct.unionByName(parts.select(F.col("part").alias("cell"), "rid", F.col("rid").alias("root"),
                                                     F.lit(True).alias("asks")))
        if turn == 0 or todo[0] is not None:
            found.append(joined(direct, "cell"))
        if todo[0] is None or todo[1] <= REGION:
            break
        sizes = saved(sizes.filter(F.col("rows") > REGION))
        cells = saved(cells.join(sizes.select("cell"), "cell", "left_semi"))
        if turn == 0:  # later joins read the sets of large cells only
            blobs = saved(blobs.join(cells.select("rid").distinct(), "rid", "left_semi"))
        if turn == ROUNDS or effort is not None and 2 * todo[0] > effort:
            found.append(joined(block_pairs(cells, sizes), "task"))
            break
        effort = todo[0]
        large, cells = voronoi_round(cells, blobs, large, percent, turn)
    if large is not None:
        found.append(large)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, and the
    component's key ``root`` (null for an empty set), and (k1, k2)."""
    rows = sketched(docs, id_col, text_col, width)
    classes = saved(rows.filter("n > 0").groupBy("c").agg(
        F.min("id").alias("low"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.min(F.struct("k1", "k2")).alias("k")).select(
            "c", "low", "n", "sketch", F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2"),
            F.monotonically_increasing_id().alias("rid")))
    links = class_links(classes, docs, id_col, text_col, width, percent)
    roots = connected_components(links)
    member = classes.select("c", "low", "rid").join(roots.withColumnRenamed("node", "rid"), "rid", "left").select(
        "c", "low", F.coalesce("root", "rid").alias("root"))
    named = saved(member.join(member.groupBy("root").agg(F.min("low").alias("component_id")), "root")
                  .select("c", "root", "component_id"))
    return rows.join(named, "c", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        "root", "k1", "k2")


def near_dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component (the smallest id), with the table's own
    columns.  Rows without words are copies of nothing: all stay."""
    found = saved(ngram_components(docs, id_col, text_col).select(F.col(id_col).alias("id"), "root", "k1", "k2"))
    first = F.min(F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("id"),
                           F.col("k1").alias("k1"), F.col("k2").alias("k2"))).alias("w")
    keys = found.filter("root is not null").groupBy("root").agg(first).select("w.k1", "w.k2")
    blank = ~F.coalesce(F.col(text_col), F.lit("")).rlike(WORD)
    return one_row_each(docs, [id_col, text_col], keys).unionByName(docs.filter(blank))
