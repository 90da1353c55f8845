"""The registered queries of the corpus operators, and the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import bpe, chat, collocations, decontaminate, factorisation, fim, neighbours, ngram_lm, repeats, secrets, simhash, toxicity, warc
from seriesforge.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digest(warc.archive_and_index(table(spark, folder, "pages")))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, folder, "documents")))


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.sql(
        r"""SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text
            FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"""
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_chats(turns))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(table(spark, folder, "documents"), RANKS)


def op6_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, folder, "documents")))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, folder, "documents")))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.digest(
        decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    )


def op9_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Scores are rounded to six digits, so that the order of sums does not show."""
    scored = ngram_lm.score(table(spark, folder, "documents"))
    return scored.select(
        "doc_id", "n_tokens", F.round("log_score", 6).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score")
    )


def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digest(fim.transform(table(spark, folder, "documents").select("doc_id", "text")))


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    return factorisation.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


OP1_SQL = r"""
WITH h AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41),
              lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits FROM h),
d AS (
  SELECT page_id, n, array_to_string(list_transform(range(0, 32), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(list_sum(list_transform(range(1, 6), lambda k:
             CASE WHEN substr(bits, 5 * j + k, 1) = '1' THEN CAST(2 ** (5 - k) AS INTEGER) ELSE 0 END)) AS INTEGER), 1)), '') AS digest
  FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest, n) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t),
sizes AS (
  SELECT *, length(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '[', chr(92) || '['), '<', chr(92) || '<'))
    + CASE WHEN before IS NOT DISTINCT FROM role THEN 8
           WHEN role = 'user' THEN 10 + 8 WHEN role = 'assistant' THEN 11 + 5 WHEN role = 'system' THEN 9 + 7
           ELSE 11 + 8 + 2 * octet_length(encode(role)) END AS n
  FROM l)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""

OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, octet_length(encode(coalesce(text, ''))) AS n, lower(hex(encode(coalesce(text, '')))) AS h
  FROM documents),
w AS (
  SELECT row_id, doc_id, i, substr(h, 2 * i + 1, 100) AS piece
  FROM (SELECT row_id, doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
m AS (SELECT piece, min(doc_id) AS least FROM w GROUP BY piece HAVING min(doc_id) < max(doc_id)),
s AS (SELECT row_id, i FROM w JOIN m USING (piece) WHERE least < doc_id),
e AS (SELECT row_id, i, lag(i) OVER (PARTITION BY row_id ORDER BY i) AS before FROM s),
g AS (SELECT row_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY i) AS run FROM e),
r AS (SELECT row_id, run, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY row_id, run),
p AS (SELECT row_id, run, a, b, lag(b, 1, 0) OVER (PARTITION BY row_id ORDER BY a) AS from_byte FROM r),
k AS (
  SELECT row_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last_byte,
         string_agg(substr(h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a) AS kept
  FROM p JOIN d USING (row_id) GROUP BY row_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_byte, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (row_id)
"""

OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS pattern
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT row_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS pattern
  FROM (SELECT row_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT row_id, i, s.n, item_id FROM starts s JOIN windows p ON s.pattern = p.pattern AND s.n = p.n),
hits AS (
  SELECT row_id, count(DISTINCT k) AS n_hit
  FROM (SELECT row_id, unnest(generate_series(i, i + n - 1)) AS k FROM found) GROUP BY row_id),
items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (row_id) LEFT JOIN items USING (row_id)
"""

OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
t AS (SELECT row_id, i, w[i] AS b, w[i - 1] AS a FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n AS (SELECT count(*) AS tokens FROM t),
one AS (SELECT b, count(*) AS c FROM t GROUP BY b),
one_own AS (SELECT row_id, b, count(*) AS c FROM t GROUP BY row_id, b),
two AS (SELECT a, b, count(*) AS c FROM t WHERE i > 1 GROUP BY a, b),
two_own AS (SELECT row_id, a, b, count(*) AS c FROM t WHERE i > 1 GROUP BY row_id, a, b),
s AS (
  SELECT t.row_id,
         CASE WHEN i > 1 AND two.c - two_own.c > 0 THEN ln(two.c - two_own.c) - ln(ctx.c - ctx_own.c)
              ELSE ln(0.4) + ln(greatest(one.c - one_own.c, 0.5)) - ln(greatest(tokens - len(w), 1)) END AS v
  FROM t JOIN d USING (row_id) CROSS JOIN n
  JOIN one ON one.b = t.b JOIN one_own ON one_own.row_id = t.row_id AND one_own.b = t.b
  LEFT JOIN two ON i > 1 AND two.a = t.a AND two.b = t.b
  LEFT JOIN two_own ON i > 1 AND two_own.row_id = t.row_id AND two_own.a = t.a AND two_own.b = t.b
  LEFT JOIN one ctx ON i > 1 AND ctx.b = t.a
  LEFT JOIN one_own ctx_own ON i > 1 AND ctx_own.row_id = t.row_id AND ctx_own.b = t.a),
r AS (SELECT row_id, sum(v) AS v FROM s GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, round(coalesce(v, 0), 6) AS log_score,
       CASE WHEN len(w) > 0 THEN round(v / len(w), 6) END AS mean_log_score
FROM d LEFT JOIN r USING (row_id)
"""

OP10_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
one AS (SELECT lang, a, count(*) AS f FROM t GROUP BY ALL),
two AS (SELECT lang, a, b, count(*) AS f FROM t WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, a, b, c, count(*) AS f FROM t WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM three UNION ALL SELECT lang, b, c, f FROM three) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.a || ' ' || t.b AS phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM two t JOIN one x ON x.lang = t.lang AND x.a = t.a JOIN one y ON y.lang = t.lang AND y.a = t.b
  LEFT JOIN longer g ON g.lang = t.lang AND g.a = t.a AND g.b = t.b WHERE g.f IS NULL OR 100 * g.f < 50 * t.f
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, x.f, y.f, 1
  FROM three t JOIN one x ON x.lang = t.lang AND x.a = t.a JOIN two y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, x.f, y.f, 2
  FROM three t JOIN two x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b JOIN one y ON y.lang = t.lang AND y.a = t.c),
s AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank, phrase, a, l, r.r AS r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

OP12_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id) AS hex
  FROM documents),
h AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4
  FROM u),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, array_to_string(u[1 : i], '') AS prefix, array_to_string(u[i + 1 : j], '') AS middle, array_to_string(u[j + 1 : n], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

QUERIES = {
    "op1_warc_index": op1_warc_index,
    "op2_simhash": op2_simhash,
    "op3_chat_format": op3_chat_format,
    "op4_toxicity": op4_toxicity,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_suffix_repeats": op6_suffix_repeats,
    "op7_secrets": op7_secrets,
    "op8_decontaminate": op8_decontaminate,
    "op9_ngram_lm": op9_ngram_lm,
    "op10_nearest": op10_nearest,
    "op11_collocations": op11_collocations,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_quality": op13_quality,
}

SQL = {
    "op1_warc_index": OP1_SQL,
    "op3_chat_format": OP3_SQL,
    "op6_suffix_repeats": OP6_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_ngram_lm": OP9_SQL,
    "op10_nearest": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
