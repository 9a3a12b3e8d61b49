"""Registered queries of this subpackage: name -> builder, and name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.llm import bpe, decontam, host_rules, langid, merkle, passages, pieces, pii, repair, simhash, suffix, tokenfile, warc
from civicstat.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


#: Key of the registered queries; a real corpus has a secret one.
PII_KEY = "surrogates"


@query("op1_pii_surrogates")
def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.replace(docs, PII_KEY, count_col="n_entities")


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(bpe.id_text("token_ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_langid_ppm")
def op3_langid_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs, "doc_id", "text", "lang", langid.fold("doc_id") != 2)
    found = langid.predict(docs, model, "doc_id", "text")
    return found.select("doc_id", F.coalesce(langid.fold("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query("op4_decontaminate_cgk")
def op4_decontaminate_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@query("op5_compact_windows")
def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find(documents(spark, sf_dir))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", suffix.removed("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_simhash_bktree")
def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = tokenfile.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return back.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
l AS (SELECT d, max(page_id) AS last FROM h GROUP BY d),
g AS (SELECT d, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v, 1), '' ORDER BY i) AS digest
      FROM (SELECT d, i, CAST(('0x' || substr(d, 10 * (i // 8) + 1, 10)) AS BIGINT) // CAST(pow(32, 7 - i % 8) AS BIGINT) % 32 AS v
            FROM l CROSS JOIN range(32) r(i)) GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM h JOIN l USING (d) JOIN g USING (d)
"""


@query("op9_warc_revisits", WARC_SQL)
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive(documents(spark, sf_dir, "pages"))
    return back.select(F.col("id").alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

HOST_RULES_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS c
  FROM (SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, array_to_string(w[p:p + 4], ' ') AS gram FROM d WHERE len(w) >= 5)),
r AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM g WHERE c > 1) GROUP BY doc_id),
b AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f GROUP BY source),
m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM h),
a AS (SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1e6 END, 1.0), 1e6) AS s FROM m),
j AS (SELECT source, (k + m * s) / (n + s) > 0.5 AS host_failed FROM h CROSS JOIN a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_failed
FROM f JOIN j ON f.source IS NOT DISTINCT FROM j.source
"""


@query("op10_host_rules", HOST_RULES_SQL)
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(documents(spark, sf_dir))


def _crc32_sql(x: str) -> str:
    """crc32 of an ASCII text."""
    return f"""xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, strlen({x}) + 1), lambda k: CAST(ord(substr({x}, k, 1)) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


_SPACES = r"[\x20\x09-\x0D]"


def _repair_sql() -> str:
    key = "(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))"
    return rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32_sql(key)} % 20 AS k FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT * FROM c UNION ALL SELECT * FROM c WHERE k = 3) WHERE k <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         substr(role, 1, 1) AS r,
         right(regexp_replace(text, '{_SPACES}', '', 'g'), 1) AS z FROM d),
f AS (
  SELECT *, CASE WHEN z = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN z NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM o),
m AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS dup, count(*) FILTER (fault = 't') AS cut, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
ins(q, q2, names) AS (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'), (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')),
nx(q, r, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ed AS (
  SELECT conv_id, i, 'D' AS name, 4 AS cost, q.q, q.q AS q2 FROM f, (VALUES (0), (1), (2), (3)) q(q)
  UNION ALL
  SELECT conv_id, i, 'K', CASE fault WHEN 't' THEN 3 ELSE 0 END, nx.q, nx.q2 FROM f JOIN nx USING (r) WHERE fault IN ('', 't')
  UNION ALL
  SELECT conv_id, i, 'R', CASE fault WHEN 't' THEN 6 ELSE 3 END, nx.q, nx.q2 FROM f, nx WHERE nx.r <> 's' AND fault IN ('', 't')),
w(conv_id, i, q, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), q2, printf('%08d', 3 * length(names)) || names FROM (SELECT DISTINCT conv_id FROM c), ins WHERE q = 0
  UNION ALL
  SELECT w.conv_id, w.i + 1, ins.q2, min(printf('%08d', CAST(substr(best, 1, 8) AS INTEGER) + ed.cost + 3 * length(names)) || substr(best, 9) || ed.name || names)
  FROM w JOIN ed ON w.conv_id IS NOT DISTINCT FROM ed.conv_id AND ed.i = w.i + 1 AND ed.q = w.q JOIN ins ON ins.q = ed.q2
  GROUP BY w.conv_id, w.i, ins.q2),
a AS (
  SELECT w.conv_id, min(best) AS best FROM w LEFT JOIN m ON w.conv_id IS NOT DISTINCT FROM m.conv_id
  WHERE w.i = coalesce(m.n, 0) AND w.q IN (0, 3) GROUP BY w.conv_id),
e AS (SELECT conv_id, unnest(string_split(substr(best, 9), '')) AS name, generate_subscripts(string_split(substr(best, 9), ''), 1) AS p FROM a WHERE length(best) > 8),
g AS (
  SELECT *, count(*) FILTER (name <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i, count(*) FILTER (name <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS pos,
         count(*) FILTER (name <> 'D') OVER (PARTITION BY conv_id) AS total FROM e),
t AS (
  SELECT g.conv_id, string_agg(CASE WHEN name = 'K' THEN role WHEN (pos - total) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE name WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS s
  FROM g LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM g.conv_id AND f.i = g.i WHERE name <> 'D' GROUP BY g.conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(dup, 0) AS duplicate, coalesce(cut, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(substr(best, 1, 8) AS BIGINT) AS cost, substr(best, 9) AS audit, sha256(coalesce(t.s, '')) AS repaired_sha256
FROM a LEFT JOIN m ON a.conv_id IS NOT DISTINCT FROM m.conv_id LEFT JOIN t ON a.conv_id IS NOT DISTINCT FROM t.conv_id
"""


@query("op11_conversation_repair", _repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(documents(spark, sf_dir, "conversations")).drop("rows")


def _field_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR) END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars", text))) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS later
  FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
t(source, lvl, i, h, n) AS (
  SELECT source, 0, i, leaf, n FROM r
  UNION ALL
  SELECT source, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY source, lvl, i // 3, n),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, i, h, n) AS (
  SELECT 0, i, subroot, n FROM s
  UNION ALL
  SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, i // 3, n),
steps AS (
  SELECT r.source, r.i, t.lvl, coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < r.i // CAST(pow(3, t.lvl) AS BIGINT)), '') AS b,
         coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > r.i // CAST(pow(3, t.lvl) AS BIGINT)), '') AS a
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.i // 3 = r.i // CAST(pow(3, t.lvl + 1) AS BIGINT)
  GROUP BY r.source, r.i, t.lvl
  UNION ALL
  SELECT s.source, r.i, 1000 + u.lvl, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < s.i // CAST(pow(3, u.lvl) AS BIGINT)), ''),
         coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > s.i // CAST(pow(3, u.lvl) AS BIGINT)), '')
  FROM s JOIN u ON u.n > 1 AND u.i // 3 = s.i // CAST(pow(3, u.lvl + 1) AS BIGINT) JOIN r ON r.source IS NOT DISTINCT FROM s.source
  GROUP BY s.source, r.i, u.lvl),
p AS (SELECT source, i, list({{'b': b, 'a': a}} ORDER BY lvl) AS path FROM steps GROUP BY source, i),
f AS (
  SELECT r.doc_id, r.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(p.path, []) AS path, r.later
  FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source LEFT JOIN p ON p.source IS NOT DISTINCT FROM r.source AND p.i = r.i)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.b || x.a), '')) AS proof_sha256,
       list_reduce(list_prepend({{'b': '', 'a': later}}, path), lambda acc, x: {{'b': '', 'a': sha256(x.b || acc.a || x.a)}}).a AS folded_root,
       list_reduce(list_prepend({{'b': '', 'a': later}}, path), lambda acc, x: {{'b': '', 'a': sha256(x.b || acc.a || x.a)}}).a = root AS verified
FROM f
"""


@query("op12_merkle_manifest", MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.verify(documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], {"text": tampered})
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(merkle.proof_text("path"), 256).alias("proof_sha256"), "folded_root", "verified")


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(pieces.id_text("token_ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
