"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, line_dedup, merkle, mixing, packing, periodic_runs, sharding, simhash_dedup,
               token_counts, toxicity, url_filter, whitening)
from .common import table

#: (host, path, verdict) of the registered URL query.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SHARDS = 24


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and benchmark item that a window of it resembles, with the best window."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's host, path, the longest rule that fits it and the verdict, by rule or by model."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "p_block")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and the smallest id among its near-duplicates."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the words that the mix takes of it, and the size and target of its source."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike they and the next one are."""
    return merkle.edit_report(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that are no prefix of a longer one, rendered with a chat template."""
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pre-tokens and unigram tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_pretokens", "n_tokens")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's toxicity score, learned from labels that are not held out."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shard and slot, and its shard with one shard more."""
    return sharding.shard_report(table(spark, sf_dir, "documents"), SHARDS)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, how many of them repeat elsewhere and go, and the digest of what stays."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's whitened coordinates along the leading eight components, a row per component."""
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces and their places in sequences of at most 2,048 tokens."""
    import public_tokenizers
    return packing.pack_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's periodic runs of words and the text without their repeats, one in ten given a periodic tail."""
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontamination, op2_url_filter, op3_simhash_dedup, op4_source_mix, op5_merkle_fingerprints,
        op6_chat_formatting, op7_token_counts, op8_toxicity, op9_rendezvous_sharding, op10_line_dedup,
        op11_embedding_whitening, op12_packing, op13_periodic_runs)}

_LINES = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keep AS dropped
  FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_CHAT = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER w - 1 AS i,
         string_agg(coalesce('r' || role, '-') || chr(31) || coalesce('t' || text, '-'), chr(30)) OVER (w ROWS UNBOUNDED PRECEDING) AS prefix
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
hashed AS (SELECT conv_id, role, text, i, md5(prefix) AS h, max(i) OVER (PARTITION BY conv_id) AS last FROM turns),
one AS (SELECT i, h, min(conv_id) AS conv_id FROM hashed WHERE i = last GROUP BY i, h),
kept AS (SELECT conv_id, i + 1 AS n_turns FROM one
         WHERE NOT EXISTS (SELECT 1 FROM hashed b WHERE b.i = one.i AND b.h = one.h AND b.i < b.last))
SELECT conv_id, CAST(i // 256 AS BIGINT) AS part, n_turns, CAST(min(i) AS BIGINT) AS first_turn,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY i) AS rendered
FROM hashed JOIN kept USING (conv_id) GROUP BY conv_id, i // 256, n_turns
"""

_TREE = """
  list_transform(string_split({t}, chr(10)), lambda p: list_transform(
    string_split(regexp_replace(p, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: sha256(s)[:32]))"""

_MERKLE = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
around AS (
  SELECT doc_id, text, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
         coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM docs WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edits AS (
  SELECT doc_id, next_id, text, substr(text, 1, length(text) - length(text) // 2)
         || substr(next_text, 1, length(text) // 2) AS edited FROM around),
nested AS (SELECT *, {_TREE.format(t="text")} AS a, {_TREE.format(t="edited")} AS b FROM edits),
leaves AS (
  SELECT *, flatten(a) AS asent, flatten(b) AS bsent,
    list_transform(a, lambda q: sha256(array_to_string(q, ''))[:32]) AS apar,
    list_transform(b, lambda q: sha256(array_to_string(q, ''))[:32]) AS bpar FROM nested),
cut AS (
  SELECT *, list_transform(list_filter(string_split(array_to_string(list_transform(apar,
      lambda d: CASE WHEN d[1] IN ('0', '1') THEN d || '/' ELSE d END), ''), '/'), lambda r: r <> ''), lambda r: sha256(r)[:32]) AS asec,
    list_transform(list_filter(string_split(array_to_string(list_transform(bpar,
      lambda d: CASE WHEN d[1] IN ('0', '1') THEN d || '/' ELSE d END), ''), '/'), lambda r: r <> ''), lambda r: sha256(r)[:32]) AS bsec
  FROM leaves),
roots AS (
  SELECT *, sha256(array_to_string(asec, '')) AS aroot, sha256(array_to_string(bsec, '')) AS broot FROM cut),
sets AS (
  SELECT *, list_distinct(list_concat([aroot], asec, apar, asent)) AS anodes,
    list_distinct(list_concat([broot], bsec, bpar, bsent)) AS bnodes FROM roots)
SELECT s.doc_id, length(s.text) AS n_chars, sha256(s.edited) AS edited_sha256,
  s.aroot AS fingerprint, s.broot AS edited_fingerprint,
  len(list_intersect(s.anodes, s.bnodes)) / (len(s.anodes) + len(s.bnodes) - len(list_intersect(s.anodes, s.bnodes)))::DOUBLE AS near_edited,
  len(list_intersect(s.anodes, n.anodes)) / (len(s.anodes) + len(n.anodes) - len(list_intersect(s.anodes, n.anodes)))::DOUBLE AS near_next,
  CASE WHEN s.aroot <> s.broot THEN list_position(list_transform(
    range(greatest(len(s.apar), len(s.bpar))), lambda j: s.apar[j + 1] IS DISTINCT FROM s.bpar[j + 1]), true) - 1 END::BIGINT AS first_change
FROM sets s JOIN sets n ON n.doc_id = s.next_id
"""

SQL: dict[str, str] = {
    "op5_merkle_fingerprints": _MERKLE,
    "op6_chat_formatting": _CHAT,
    "op10_line_dedup": _LINES,
}
