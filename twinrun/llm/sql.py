"""The same results in DuckDB SQL, written in another shape than the Spark code."""

from __future__ import annotations

from . import decontaminate as D
from . import mixing as M
from . import periodic_runs as P
from . import quality as Q
from . import resample as R

W = r"[^\x20\x09-\x0D]+"
S = r"[\x20\x09-\x0D]"


def quality_sql() -> str:
    score = {
        "symbols": "coalesce(1000 * n_symbols // nullif(word_chars, 0), 0)",
        "dup_lines": "coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0)",
        "repeats": "coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0)",
        "long_words": "coalesce(100 * word_chars // nullif(n_words, 0), 0)",
        "short_words": "coalesce(1000 * n_words // nullif(word_chars, 0), 0)",
    }
    ladder = " UNION ALL ".join(f"SELECT '{r}' AS rule, unnest([{', '.join(map(str, c))}]) AS cut" for r, c in Q.LADDERS.items())
    long_form = " UNION ALL ".join(f"SELECT rid, doc_id, lang, base_failed, '{r}' AS rule, {e} AS score FROM f" for r, e in score.items())
    p = repr(Q.RISK / len(Q.LADDERS))
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{W}') AS ws FROM documents),
words AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS i, ws FROM d),
wins AS (SELECT rid, i, array_to_string(ws[i:i + {Q.WINDOW - 1}], ' ') AS g FROM words WHERE i + {Q.WINDOW - 1} <= len(ws)),
dup AS (SELECT rid, i FROM wins QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cover AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM dup, range(0, {Q.WINDOW}) x(o) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
line_counts AS (SELECT rid, count(*) AS n_lines, count(DISTINCT line) AS n_kinds FROM lines
                WHERE regexp_matches(line, '{W}') GROUP BY rid),
f AS MATERIALIZED (
  SELECT rid, doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_lines - n_kinds, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (len(ws) < {Q.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {Q.MAX_REPEAT_PCT} * len(ws)) AS base_failed
  FROM d LEFT JOIN cover USING (rid) LEFT JOIN line_counts USING (rid)),
scored AS MATERIALIZED ({long_form}),
held AS (SELECT * FROM scored WHERE NOT base_failed AND doc_id IN (
           SELECT doc_id FROM labels WHERE quality = 1)),
tested AS (
  SELECT lang, rule, cut, count(*) AS n, count(*) FILTER (WHERE score >= cut) AS k
  FROM held JOIN ({ladder}) USING (rule) GROUP BY ALL),
level AS (SELECT {Q.DELTA!r} / (count(*) * {len(Q.LADDERS)}) AS a FROM (SELECT DISTINCT coalesce(lang, ''), lang IS NULL FROM held)),
cuts AS (
  SELECT lang, rule, min(cut) AS cut FROM tested, level
  WHERE k < n * {p} AND list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) <= a
  GROUP BY lang, rule),
bad AS (SELECT DISTINCT rid FROM scored s JOIN cuts c ON s.rule = c.rule AND s.lang IS NOT DISTINCT FROM c.lang WHERE score >= cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND rid NOT IN (SELECT rid FROM bad)) AS kept
FROM f"""


LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, hash(coalesce(text, '')) AS th, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, th, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT (doc_id, th)) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
       (count(*) FILTER (WHERE c.key IS NOT NULL))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common c USING (key) GROUP BY rid"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
digits AS (SELECT page_id, h, x, list_transform(range(0, 32), lambda j:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || x[5 * (j // 4) + 1 : 5 * (j // 4) + 5])::INTEGER >> (5 * (3 - j % 4))) & 31)::INTEGER]) AS b FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM digits)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, array_to_string(b, '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM r"""

EXACT_DEDUP = rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '{S}+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER g = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)"""

CHAT = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
s AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
         length(text) + len(regexp_extract_all(text, '<\\\\*[|]')) AS escaped
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
p AS (
  SELECT *, (CASE WHEN before IS DISTINCT FROM role THEN 12 + length(role) + 1 ELSE 10 END) + escaped
            + (CASE WHEN after IS DISTINCT FROM role THEN 11 ELSE 0 END) AS n FROM s)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id"""


def mixing_sql() -> str:
    weights = ", ".join(map(str, M.WEIGHTS))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{W}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, ([{weights}])[((rank - 1) % {len(M.WEIGHTS)} + 1)::INTEGER] AS w, {M.MAX_REPEATS} * source_size AS cap FROM s),
open AS (
  SELECT *, ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS num,
         (sum(w) OVER (ORDER BY cap::DOUBLE / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS den FROM w),
level AS (SELECT num, den FROM open WHERE num * w <= cap::DOUBLE * den ORDER BY cap::DOUBLE / w, rank LIMIT 1),
t AS (SELECT o.source, source_size, rank, least(cap::DOUBLE, w::DOUBLE * l.num / l.den) AS target FROM open o, level l),
q AS (
  SELECT d.*, source_size, target, rank, md5('{M.SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS h,
         sum(size) OVER (PARTITION BY rank ORDER BY md5('{M.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), size ROWS UNBOUNDED PRECEDING) AS sent
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CASE WHEN target > 0 THEN (copy * source_size + sent)::DOUBLE / target END AS finish
      FROM q, range(0, {M.MAX_REPEATS}) x(copy)),
o AS (SELECT *, sum(size) OVER (ORDER BY finish NULLS LAST, h, size, rank, copy ROWS UNBOUNDED PRECEDING) AS upto FROM c)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       (any_value(size) * count(*) FILTER (WHERE finish IS NOT NULL AND upto <= (SELECT sum(size) FROM d)))::BIGINT AS taken
FROM o GROUP BY rid"""


#: words of digits, letters and all beyond ASCII, A-Z lower-cased
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ALNUM}')"

#: CRC-32 bit by bit: ``step`` holds that of every byte
CRC_STEP = """
bits(b, c, k) AS (
  SELECT b::BIGINT, b::BIGINT, 0 FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS step FROM bits WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, beside the table ``crc``."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::INTEGER, 2))::BIGINT"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({text}))), "
            f"lambda i: {byte})), lambda c, b: xor(crc.step[(xor(c, b) & 255) + 1], c >> 8)))")


DECONTAMINATE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {LOWERED} AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {LOWERED} AS ws FROM benchmark),
bw AS (SELECT item, ws, least(len(ws), {D.WINDOW}) AS w FROM b WHERE len(ws) > 0),
item_windows AS (SELECT DISTINCT item, w, array_to_string(ws[i:i + w - 1], ' ') AS g
                 FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS i FROM bw)),
doc_windows AS (SELECT rid, i, w, array_to_string(ws[i:i + w - 1], ' ') AS g
                FROM (SELECT rid, ws, w, unnest(range(1, len(ws) - w + 2)) AS i
                      FROM d, (SELECT DISTINCT w FROM item_windows) WHERE len(ws) >= w)),
hits AS MATERIALIZED (SELECT rid, i, w, item FROM doc_windows JOIN item_windows USING (w, g)),
words AS (SELECT rid, count(DISTINCT i + o) AS n_hit
          FROM (SELECT DISTINCT rid, i, w FROM hits), range(0, {D.WINDOW}) x(o) WHERE o < w GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""

# Periods by pairs of equal five words at each distance, and their stretches by
# position less row number: quadratic where a text repeats itself often.
PERIODIC_RUNS = f"""
WITH RECURSIVE {CRC_STEP},
d0 AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{W}') AS ws,
              {crc32_sql("doc_id::VARCHAR")} AS h FROM documents, crc),
d1 AS (SELECT *, (h // 10) % greatest(len(ws), 1) AS a, (h // 10) % 8 AS m FROM d0),
d2 AS (SELECT *, 1 + (len(ws) - a) // (3 + m) AS p FROM d1),
d AS MATERIALIZED (
  SELECT rid, doc_id, CASE WHEN h % 10 = 0 THEN list_transform(range(0, len(ws)), lambda i:
           ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws FROM d2),
grams AS MATERIALIZED (
  SELECT rid, n, i, array_to_string(ws[i + 1:i + 5], ' ') AS g
  FROM (SELECT rid, ws, len(ws) AS n, unnest(range(0, len(ws) - 4)) AS i FROM d)),
pairs AS (SELECT x.rid, x.i, y.i - x.i AS q FROM grams x JOIN grams y
          ON x.rid = y.rid AND x.g = y.g AND y.i > x.i AND {P.TIMES} * (y.i - x.i) <= x.n),
marked AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT rid, q, min(i) AS s, max(i) - min(i) + 5 + q AS n FROM marked GROUP BY rid, q, island),
runs AS MATERIALIZED (
  SELECT rid, s, n, min(q) AS q FROM stretches WHERE n >= {P.LEAST} AND n >= {P.TIMES} * q GROUP BY rid, s, n),
dropped AS (SELECT DISTINCT rid, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS t
         FROM (SELECT rid, unnest(range(0, len(ws))) AS i, unnest(ws) AS w FROM d) ANTI JOIN dropped USING (rid, i) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY rid),
top AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY n::DOUBLE / q DESC, s, q) = 1)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, n::BIGINT AS length, q::BIGINT AS period,
       (1000 * n // q)::BIGINT AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256,
       sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN top USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)"""

RESAMPLE = f"""
WITH RECURSIVE {CRC_STEP},
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {LOWERED} AS ws FROM documents),
f AS MATERIALIZED (
  SELECT rid, 'd' AS side, unnest(ws) AS w FROM d
  UNION ALL SELECT NULL, 'b', unnest(ws) FROM (SELECT {LOWERED} AS ws FROM benchmark)),
kinds AS (SELECT DISTINCT w FROM f),
k AS MATERIALIZED (SELECT w, {crc32_sql("w")} % {R.BUCKETS} AS bucket FROM kinds, crc),
c AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t
      FROM f JOIN k USING (w) GROUP BY bucket),
n AS (SELECT sum(s) AS ns, sum(t) AS nt FROM c),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ns + {R.BUCKETS})::DOUBLE
                                         / ((s + 1)::DOUBLE * (nt + {R.BUCKETS})::DOUBLE))) AS gain FROM c, n),
weights AS (SELECT rid, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM f JOIN k USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('{R.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (rid)),
ranked AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank,
                  {R.PERCENT} * count(*) OVER () // 100 AS draws FROM scored WHERE n_features >= {R.MIN_WORDS})
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN (SELECT * FROM ranked WHERE rank <= draws) USING (rid)"""


ORACLE = {
    "op1_quality_rules": quality_sql(),
    "op2_line_dedup": LINE_DEDUP,
    "op6_warc_archive": WARC,
    "op7_exact_dedup": EXACT_DEDUP,
    "op9_chat_format": CHAT,
    "op10_mixing": mixing_sql(),
    "op11_decontamination": DECONTAMINATE,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_importance_resampling": RESAMPLE,
}
