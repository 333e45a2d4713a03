"""Quality rules, exact dedup, line dedup, mixing, chat, WARC: edge tables
against plain Python, and whole tables against the SQL."""

import math

import duckdb
import pytest
from brute import base_rules, conversation, exact_dedup, line_dedup, mix_targets, payload, sha
from llm_helpers import DOCS, REPEATED, SF, documents, got, labels, want
from pyspark.sql import functions as F

from twinrun.llm import exact_dedup as E
from twinrun.llm import quality as Q
from twinrun.llm.chat import format_conversations, read_conversations
from twinrun.llm.common import row_key, whole_row_key
from twinrun.llm.line_dedup import RunStore, dedup_lines, line_hashes
from twinrun.llm.mixing import mix, mixed_rows, source_targets
from twinrun.llm.ngram_join import near_dedup_rows
from twinrun.llm.quality import binomial_below, cutoffs, quality_kept, quality_rules
from twinrun.llm.queries import QUERIES
from twinrun.llm.sql import ORACLE
from twinrun.llm.warc import read_index, read_records, write_archive

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(ORACLE))
def test_whole_table_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    canon = lambda v: round(v, 6) if isinstance(v, float) else v
    assert want([canon(v) for v in r] for r in got(df, *cols)) == want(
        [canon(v) for v in r] for r in rel.project(", ".join(cols)).fetchall())


# ------------------------------------------------------------ quality rules

def test_base_rules(spark):
    repeats = [(20, "a b c d e f g h i a b c d e f g h i x y z"), (21, "k " * 9 + "tail of text"),
               (22, " ".join(f"u{i}" for i in range(40)) + "\n# $\n# $\n\n")]
    docs = REPEATED + repeats
    out = quality_rules(documents(spark, docs), labels(spark, []))
    assert got(out, *BASE) == want((d, *base_rules(t)) for d, t in docs)
    assert out.filter("kept = base_failed").count() == 0  # without labels no rule is on
    assert quality_rules(documents(spark, []), labels(spark, [(1, 1, 0)])).count() == 0


def test_exact_binomial(spark):
    cases = [(0, 100, .02, .05), (3, 400, .02, .05), (4, 400, .02, .1), (0, 10, .5, .001), (0, 1000, .01, 5e-5), (90, 10000, .01, .2), (950, 100000, .01, .06)]
    rows = spark.createDataFrame(cases, "k long, n long, p double, a double")
    for k, n, p, a in cases:
        tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
        told = rows.filter((F.col("k") == k) & (F.col("n") == n)).select(binomial_below(F.col("k"), F.col("n"), p, F.lit(a))).first()[0]
        assert told == (tail <= a), (k, n, p, a, tail)


def test_cutoffs_hold_their_risk_and_reject_junk(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(0, 3000)]
    some = [(i, t + (" ## $$ %%" if i % 400 == 0 else "")) for i, t in good]
    junk = [(5000 + i, " ".join(f"w{i}x{j}###" for j in range(30))) for i in range(200)]
    rows = spark.createDataFrame([(d, t, "en") for d, t in some + junk], "doc_id long, text string, lang string")
    given = labels(spark, [(d, int(d < 5000), 0) for d, _ in some + junk if d % 2 == 0] + [(0, 0, 0), (None, 1, 0)])
    out = quality_rules(rows, given)
    assert out.filter("doc_id >= 5000 and kept").count() == 0
    assert out.filter("doc_id < 5000 and not kept").count() <= Q.RISK * 3000
    # a stratum with few labels gets no cutoff
    few = given.filter("doc_id < 60")
    cuts = cutoffs(Q.base_features(rows, "doc_id", "text", "lang"), few).first()
    assert all(cuts[f"cut_{r}"] is None for r in Q.LADDERS)


def test_quality_stage_keeps_columns(spark):
    docs = documents(spark, REPEATED)
    out = quality_kept(docs, labels(spark, []))
    assert out.columns == docs.columns
    ok = [r for r in docs.collect() if not base_rules(r.text)[5]]
    assert got(out, *docs.columns) == want(ok)


def twins(spark):
    """30 rows that pass; some are equal in id and text, but not in what else they hold."""
    text = lambda i: " ".join(f"t{i}w{j}" for j in range(25))
    rows = [(i, text(i), "en", "a", 0, "p") for i in range(20)]
    rows += [(1, text(1), "de", "b", 0, "p"), (1, text(1), "en", "a", 0, "q"), (1, text(1), None, None, 1, None)]
    rows += [(2, text(2), "en", "a", 0, "p")] * 3 + [(None, text(3), "en", "b", 0, "p")] * 2 + [(7, text(7), "en", "c", 0, "p")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k1 string")


def test_quality_stage_keeps_every_row(spark):
    docs = twins(spark)
    for parts in (1, 7):
        assert got(quality_kept(docs.repartition(parts), labels(spark, [])), *docs.columns) == want(docs.collect())


def test_quality_stage_judges_twins_by_their_own_stratum(spark):
    """Equal id and text in two languages, of which only one has a cutoff that it fails."""
    plain = " ".join(f"word{i}" for i in range(30))
    marked = plain + " " + "#" * 80
    rows = [(i, plain, lang, "s", 0) for lang in ("en", "de") for i in range(3000)] + [(9000, marked, "en", "s", 0), (9000, marked, "de", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    given = docs.filter("lang = 'en' and doc_id < 3000").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    held = docs.filter("lang = 'en' or doc_id = 9000")
    out = quality_kept(held, given)
    assert out.filter("doc_id = 9000").select("lang").collect() == [("de",)]
    assert out.count() == 3001


def test_mix_keeps_sources_of_twins(spark):
    docs = twins(spark)
    copies = mix(docs, key=whole_row_key(docs))
    k1, k2 = whole_row_key(docs)
    expected = (docs.select("*", F.struct(k1, k2).alias("__k")).distinct()
                .join(copies.groupBy(F.struct("k1", "k2").alias("__k")).agg(F.sum("copies").alias("__n")), "__k"))
    by_hand = [tuple(r[c] for c in docs.columns) for r in expected.collect() for _ in range(r["__n"])]
    for parts in (1, 5):
        out = mixed_rows(docs.repartition(parts))
        assert got(out, *docs.columns) == want(by_hand)
    by_source = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    targets = {r.source: r.target for r in source_targets(docs.select("source", F.lit(25).cast("long").alias("size"))).collect()}
    assert set(by_source) == {"a", "b", "c", None} and all(abs(by_source[s] - t) <= 75 for s, t in targets.items())


def test_dedup_stages_keep_one_of_twins_whatever_the_order(spark):
    docs = twins(spark)
    first = [got(f(docs.repartition(1).sortWithinPartitions("source")), *docs.columns) for f in (E.dedup_rows, near_dedup_rows)]
    for f, rows in zip((E.dedup_rows, near_dedup_rows), first):
        assert got(f(docs.repartition(5).sortWithinPartitions(F.desc("lang"))), *docs.columns) == rows
        assert len(rows) == 20


def test_later_batches_lose_lines_on_arrival(spark):
    """A line that the runs show often enough goes when its batch arrives, and
    is not counted again; one that becomes frequent later goes at the end."""
    docs = [(i, f"common line\nlate line\nown {i}" if i >= 12 else f"common line\nown {i}") for i in range(24)]
    lines = line_hashes(documents(spark, docs))
    ids = documents(spark, docs).select("doc_id", *[k.alias(n) for k, n in zip(row_key(F.col("doc_id"), F.col("text")), ("k1", "k2"))])
    lines = lines.join(ids, ["k1", "k2"])
    store, arrived = RunStore(spark), []
    for low, high in ((0, 12), (12, 18), (18, 24)):
        batch = lines.filter((F.col("doc_id") >= low) & (F.col("doc_id") < high) & F.col("counted")).drop("doc_id")
        arrived.append((batch.count(), store.arrive(batch, 10).count()))
    assert arrived == [(24, 24), (18, 12), (18, 12)]  # batches 2 and 3 lose the common line on arrival
    assert store.runs().agg(F.max("n_docs")).first()[0] == 12
    out = dedup_lines(documents(spark, docs), batches=4)
    assert got(out, "doc_id", "n_dropped") == want((i, 2 if i >= 12 else 1) for i, _ in docs)


# ------------------------------------------------------------ exact dedup

def test_exact_dedup_edges(spark):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    for counters in (1, 2, 4096):
        out = E.exact_dedup(documents(spark, DOCS), counters=counters)
        assert got(out, *cols) == want(exact_dedup(DOCS))
    assert E.exact_dedup(documents(spark, [])).count() == 0


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    docs = documents(spark, REPEATED * 3)
    out = E.exact_dedup(docs)
    n = len({sha("".join((t or "").split())) for _, t in [(d, (t or "").translate({0x3000: "I", 0x85: "N", 0x1c: "F"})) for d, t in DOCS]})
    assert out.filter("kept").count() == n
    assert E.dedup_rows(docs).count() == n
    assert E.dedup_rows(docs).columns == docs.columns


def test_heavy_digests_are_found(spark):
    rows = [(i, f"only {i}") for i in range(3000)] + [(10_000 + i, "hot one") for i in range(1500)] + [(20_000 + i, "hot two") for i in range(700)]
    df = documents(spark, rows).repartition(7, "doc_id").select("doc_id", E.text_digest(F.col("text")).alias("digest"))
    hot = {bytes(r.digest) for r in E.heavy_digests(df, 8).collect()}
    assert {bytes.fromhex(sha("hotone")), bytes.fromhex(sha("hottwo"))} <= hot and len(hot) <= 8


# ------------------------------------------------------------ line dedup

def test_line_dedup_edges(spark):
    cols = ("doc_id", "n_lines", "n_dropped", "sha")
    many = DOCS + [(100 + i, f"  Shared LINE\t\nown {i}\n\nSHARED line\n É{i % 2}") for i in range(12)] + [(200 + i, "nine only") for i in range(9)]
    for fanout, batches in ((2, 5), (3, 1), (3, 9)):
        out = dedup_lines(documents(spark, many), fanout=fanout, batches=batches).withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
        assert got(out, *cols) == want(line_dedup(many))
    twice = many + [(200, "nine only")] * 3  # repeated rows count once
    out = dedup_lines(documents(spark, twice)).withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    assert got(out, *cols) == want(line_dedup(twice))
    assert dedup_lines(documents(spark, [])).count() == 0


def test_runs_are_levelled(spark):
    store = RunStore(spark, fanout=2)
    for b in range(5):
        store.add(line_hashes(documents(spark, [(b, "again\nand again"), (10 + b, f"own {b}")])))
    assert [len(level) for level in store.levels] == [1, 0, 1]
    counts = {r.n_docs for r in store.runs().groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs")).collect()}
    assert counts == {1, 5}
    new = line_hashes(documents(spark, [(99, "again\nnew")]))
    assert [r.line_no for r in store.anti_join(new, 1).collect()] == [1]


# ------------------------------------------------------------ mixing

def test_targets_share_the_excess(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 0}, {"x": 7},
                  {f"s{i:02}": (i * 37) % 101 for i in range(30)}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        told = {r.source: r.target for r in source_targets(df).collect()}
        assert told == pytest.approx(mix_targets(sizes))


def test_mix_comes_near_its_targets(spark):
    rows = [(i, f"s{i % 7}" if i % 3 else "s0", " ".join(["w"] * (1 + i * 13 % 90))) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mix(df).join(df.select("doc_id", "source"), "doc_id")
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("times")).collect():
        assert abs(r.taken - r.target) <= 90 * 3 and r.times <= 3
    assert got(mix(df.repartition(5)), "doc_id", "taken") == got(mix(df), "doc_id", "taken")
    assert mixed_rows(df).count() == out.agg(F.sum("copies")).first()[0]


def test_mixing_edges(spark):
    out = mix(documents(spark, REPEATED))
    assert out.count() == len(REPEATED)
    assert out.filter("size = 0 and taken > 0").count() == 0
    assert out.filter("taken > 3 * size").count() == 0
    assert mix(documents(spark, [])).count() == 0
    docs = documents(spark, REPEATED)
    assert mixed_rows(docs).columns == docs.columns
    assert mixed_rows(docs).count() == out.agg(F.sum("copies")).first()[0]
    assert mix(documents(spark, [(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0


# ------------------------------------------------------------ chat

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "assistant", "<|im_end|>\n<|im_start|>user\nhe"), (1, 3, "user", "<\\|im_sep|> <\\\\| <| \\ <"),
    (2, 0, None, "no role"), (2, 0, None, "a tie"), (2, None, "system", ""), (3, 5, "assistant", "x"), (3, 5, "assistant", "x"),
    (None, 0, "assistant", "no conversation"), (4, 0, "ro\\le\nwith <|im_end|>\\n", "t<"), (5, 0, "assistant", "long " * 50_000),
    (6, 0, "assistant", "<|im_sep|>"), (6, 1, "assistant", "b"), (6, 2, "user", ""), (6, 3, "user", ""),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string")
    out = read_conversations(format_conversations(rows)).collect()
    assert len(out) == 7
    for r in out:
        mine = sorted(((t, ro or "", x or "") for c, t, ro, x in TURNS if c == r.conv_id), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in mine]
        assert r.loss_text == "".join(x for _, ro, x in mine if ro == "assistant")
        assert (len(mine), sha("".join(f"{a}\n{b}\n" for _, a, b in mine))) == conversation(mine)[:2]
    assert read_conversations(format_conversations(rows.limit(0))).count() == 0


def test_chat_merges_adjacent_turns_and_masks(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    one = format_conversations(rows.filter("conv_id = 1")).first()
    assert one.formatted.count("<|im_start|>") == 3  # user, two assistant turns, user
    assert sum(r.n_chars for r in one.loss_runs) == len(one.formatted)
    at, masked = 0, ""
    for r in one.loss_runs:
        masked += one.formatted[at:at + r.n_chars] if r.loss else ""
        at += r.n_chars
    assert masked == "<\\|im_end\\|>\n<\\|im_start|>user\nhe".replace("\\|>", "|>")
    wrong = format_conversations(rows).withColumn("loss_runs", F.slice("loss_runs", 1, 1))
    with pytest.raises(Exception, match="mask"):
        read_conversations(wrong).collect()


# ------------------------------------------------------------ WARC

PAGES = [(5, "http://a/", "<p>x</p>"), (3, "http://b/", "<p>x</p>"), (9, None, None), (8, "http://c/\r\nX: y", ""), (None, "u", "<p>x</p>"),
         (7, "http://d/", "é" * 70_000), (11, "http://e/", "one"), (11, "http://e/", "one"), (12, "\r\n\r\n", "WARC/1.1\r\n\r\n")]


def test_warc_edges(spark):
    pages = spark.createDataFrame([(*p, b"z", "r") for p in PAGES], "page_id long, url string, html string, payload binary, header string")
    archive = write_archive(pages)
    out = read_index(spark, archive).collect()
    assert sorted((r.payload_bytes, r.payload_digest) for r in out) == sorted(payload(h) for _, _, h in PAGES)
    kinds = {(r.page, r.record_type, r.refers_to) for r in out}
    assert {("3", "response", None), ("5", "revisit", "3"), (None, "revisit", "3"), ("8", "response", None), ("9", "revisit", "8"),
            ("11", "response", None), ("11", "revisit", "11")} <= kinds
    assert spark.read.parquet(archive.payloads).count() == len({h or "" for _, _, h in PAGES})
    records = [bytes(r.record) for r in read_records(spark, archive).collect()]
    assert len(records) == len(PAGES)
    assert all(r.startswith(b"WARC/1.1\r\nWARC-Type: ") and r.endswith(b"\r\n\r\n") for r in records)
    assert sum(r.partition(b"\r\n\r\n")[2] == ("é" * 70_000).encode() + b"\r\n\r\n" for r in records) == 1
    assert read_index(spark, write_archive(pages.limit(0))).count() == 0


def test_warc_small_payloads_are_no_revisits(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert read_index(spark, write_archive(pages, min_bytes=8)).filter("record_type = 'revisit'").count() == 2


def test_warc_finds_damage(spark):
    archive = write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    bad = spark.read.parquet(archive.payloads).withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    bad.write.parquet(archive.payloads + "-bad")
    with pytest.raises(Exception, match="does not match"):
        read_index(spark, type(archive)(archive.payloads + "-bad", archive.headers)).collect()
