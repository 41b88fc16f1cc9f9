"""The operators' registered queries and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billmodel.llm.byte_bpe import byte_bpe
from billmodel.llm.common import table
from billmodel.llm.conversation_repair import repair_conversations
from billmodel.llm.decontamination import decontamination
from billmodel.llm.html_extraction import html_extraction
from billmodel.llm.language_id import documents_language, pages_language
from billmodel.llm.lm_score import lm_score
from billmodel.llm.merkle_manifest import merkle_manifest
from billmodel.llm.pii import pii
from billmodel.llm.quality_rules import quality_rules
from billmodel.llm.simhash_dedup import simhash_dedup
from billmodel.llm.substring_dedup import substring_dedup
from billmodel.llm.suffix_dedup import suffix_dedup
from billmodel.llm.url_filter import url_filter

#: The rules that the query judges by (host, path, verdict): fixed values.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules, default="allow")


OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
judged AS (
  SELECT row_number() OVER () AS r, * FROM cut)
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(rule_verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM judged LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY r, page_id, host, path
"""


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans counted and digested, and all
    spans with those that the trained model adds."""
    out = pii(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a 20-word window with an earlier copy covers."""
    out = substring_dedup(table(spark, sf_dir, "documents"), length=20)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of every document and its group's least doc_id."""
    out = simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that a benchmark item leaks into, with the item."""
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


OP5_SQL = r"""
WITH doc_words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
item_words AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM benchmark),
lengths AS (SELECT DISTINCT least(len(ws), 5) AS k FROM item_words WHERE len(ws) > 0),
doc_shingles AS (
  SELECT DISTINCT r, k, array_to_string(ws[i:i+k-1], ' ') AS g
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM doc_words, lengths WHERE len(ws) >= k)),
item_shingles AS (
  SELECT DISTINCT q, k, array_to_string(ws[i:i+k-1], ' ') AS g
  FROM (SELECT q, ws, least(len(ws), 5) AS k, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS i FROM item_words WHERE len(ws) > 0)),
sizes AS (SELECT q, count(*) AS n FROM item_shingles GROUP BY q),
shared AS (SELECT r, q, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (k, g) GROUP BY r, q)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, CAST(n_shared AS BIGINT) AS n_shared, CAST(n_shared AS DOUBLE) / n AS containment
FROM shared JOIN sizes USING (q) JOIN doc_words USING (r) JOIN item_words USING (q)
WHERE n_shared >= 0.8 * n
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, and whether it is kept."""
    return documents_language(table(spark, sf_dir, "documents")).select("doc_id", "language", "confidence", "kept")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every raw page, from text, markup, address and host."""
    return pages_language(table(spark, sf_dir, "pages")).select("page_id", "language", "confidence", "kept")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram stupid-backoff score of every document under all the others."""
    return lm_score(table(spark, sf_dir, "documents"), order=3)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the cascade's verdict."""
    out = quality_rules(table(spark, sf_dir, "documents"), with_measures=True)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


OP8_SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM texts),
places AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM cut WHERE len(ws) >= 8),
grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i+7], ' ')) AS n FROM places),
cover AS (SELECT r, count(DISTINCT i + k) AS n FROM grams, range(8) AS t(k) WHERE grams.n > 1 GROUP BY r),
measures AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN cover USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT n_symbols > n_words AND NOT word_chars > 15 * n_words AND NOT word_chars < 2 * n_words
       AND NOT 100 * n_dup_lines > 50 * n_lines AS kept
FROM judged
"""


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 200-byte string found twice or more covers."""
    out = suffix_dedup(table(spark, sf_dir, "documents"), length=200, keep="none")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = byte_bpe(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; one in seven (by its id)
    is found with another n_chars, and its proof is folded from that."""
    docs = table(spark, sf_dir, "documents")
    n_chars, tampered = F.col("n_chars"), F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = (n_chars.cast("decimal(20,0)") + 1).cast("string")
    out = merkle_manifest(docs, found={"n_chars": F.when(tampered, more).otherwise(n_chars.cast("string"))})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP11_SQL = r"""
WITH RECURSIVE
rows_ AS (
  SELECT row_number() OVER () AS r, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '+' || lang END AS tree, n_chars,
         list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                     lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                                lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc_,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS front,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS back
  FROM documents),
leaves AS (
  SELECT r, doc_id, tree, sha256(front || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || back) AS leaf,
         CASE WHEN n_chars IS NOT NULL AND xor(crc_, 4294967295) % 7 = 0
              THEN sha256(front || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || back) END AS tampered
  FROM rows_),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2),
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, lvl AS depth FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2),
roots AS (SELECT h AS root, lvl AS depth FROM tops WHERE n = 1),
steps AS (
  SELECT r, l AS step, placed.pos >> l AS place, s.h AS h
  FROM placed JOIN subroots USING (tree), LATERAL (SELECT unnest(range(depth)) AS l)
  LEFT JOIN nodes s ON s.tree = placed.tree AND s.lvl = l AND s.pos = xor(placed.pos >> l, 1)
  UNION ALL
  SELECT r, 1000 + l, subroots.pos >> l, s.h
  FROM placed JOIN subroots USING (tree), (SELECT unnest(range(depth)) AS l FROM roots)
  LEFT JOIN tops s ON s.lvl = l AND s.pos = xor(subroots.pos >> l, 1)),
proofs AS (
  SELECT r, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof_sha256,
         list(CASE WHEN h IS NULL THEN 'N' WHEN place % 2 = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY step) AS path
  FROM steps GROUP BY r),
folded AS (
  SELECT doc_id, leaf, subroots.h AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(path, [])),
                     lambda h, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || h) WHEN 'R' THEN sha256(h || s[2:]) ELSE sha256(h) END) AS folded_root
  FROM placed JOIN subroots USING (tree) LEFT JOIN proofs USING (r), roots)
SELECT *, folded_root = root AS verified FROM folded
"""


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every raw page."""
    return html_extraction(table(spark, sf_dir, "pages"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with damage by a hash of their id and turn: rows dropped
    (``present`` is false), emptied, without sentence ends, doubled, or ``user``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       (F.col("kind") != 0).alias("present"), copies.alias("copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    out = repair_conversations(damaged(table(spark, sf_dir, "conversations")), present=F.col("present"))
    return out.drop("repaired")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document pipeline from raw documents to token ids."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_pii, op3_substring_dedup, op4_simhash_dedup,
                                    op5_decontamination, op6_language_id, language_id_pages, op7_lm_score,
                                    op8_quality_rules, op9_suffix_dedup, op10_byte_bpe, op11_merkle_manifest,
                                    op12_html_extraction, op13_conversation_repair, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op5_decontamination": OP5_SQL, "op8_quality_rules": OP8_SQL,
            "op11_merkle_manifest": OP11_SQL}
