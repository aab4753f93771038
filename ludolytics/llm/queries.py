"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.llm import alignment, bpe, chat, lm, lzhash, manifest, mixing, neighbours, pii, quality, simhash, tokencount, toxicity
from ludolytics.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    """Registers a query; texts travel to Python in batches of a thousand rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


@query
def op3_simhash_near_duplicates(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"), jaccard=False)


@query
def op4_token_counts(spark, sf):
    return tokencount.token_counts(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_bpe_round_trip(spark, sf):
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf, "documents"), vocabulary, public_tokenizers.PATTERN)


@query
def op9_lz_fingerprints(spark, sf):
    return lzhash.compare_next(table(spark, sf, "documents"))


@query
def op1_pii_spans(spark, sf):
    return pii.digests(pii.spans(table(spark, sf, "documents")))


@query
def op2_toxicity_nnpu(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, sf, "labels")))


@query
def op6_mix_sources(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@query
def op7_masked_pseudo_likelihood(spark, sf):
    return lm.token_scores(table(spark, sf, "documents"))


@query
def op8_chat_format(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    marks = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), marks.alias("text"))
    both = rows.unionByName(probe).withColumn("parts", chat.attached(F.col("role"), F.col("turn"), F.col("text")))
    return chat.digests(chat.read_back(chat.format_conversations(both)))


@query
def op10_quality_rules(spark, sf):
    return quality.apply_rules(table(spark, sf, "documents"))


@query
def op11_multiprobe_search(spark, sf):
    return neighbours.search(table(spark, sf, "embeddings"))


@query
def op12_merkle_manifest(spark, sf):
    return manifest.with_tampered_lengths(table(spark, sf, "documents"))


@query
def op13_token_alignment(spark, sf):
    return alignment.align(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


# ---- the same in SQL for DuckDB ---------------------------------------------------

ORACLE["op6_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), sized AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
         greatest(0.1, len(regexp_extract_all(t, '[\p{L} ]')) / greatest(length(t), 1)) AS weight,
         (CAST('0x' || substr(md5(concat_ws(':', '0', doc_id, md5(t))), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM d
), keyed AS (
  SELECT *, -ln(u) / weight AS key FROM sized
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w,
         3 * source_size AS cap FROM sums
), level AS (  -- the one level at which all targets add up to the total
  SELECT min(x) AS x FROM (
    SELECT r.cap / r.w AS bound,
           ((SELECT sum(source_size) FROM sums) - (SELECT coalesce(sum(b.cap), 0) FROM ranked b WHERE b.cap / b.w < r.cap / r.w))
           / (SELECT sum(b.w) FROM ranked b WHERE b.cap / b.w >= r.cap / r.w) AS x FROM ranked r)
  WHERE x <= bound AND bound = (
    SELECT min(r.cap / r.w) FROM ranked r WHERE
           ((SELECT sum(source_size) FROM sums) - (SELECT coalesce(sum(b.cap), 0) FROM ranked b WHERE b.cap / b.w < r.cap / r.w))
           / (SELECT sum(b.w) FROM ranked b WHERE b.cap / b.w >= r.cap / r.w) <= r.cap / r.w)
), goals AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), w * (SELECT x FROM level)) AS target, cap FROM ranked
), budgets AS (
  SELECT source, source_size, target, least(cap, CAST(round(target) AS BIGINT)) AS budget FROM goals
)
SELECT k.doc_id, CAST(k.size AS BIGINT) AS size, b.source_size, b.target,
       CAST(CASE WHEN b.source_size = 0 THEN 0 ELSE (b.budget // b.source_size) * k.size
         + greatest(0, least(k.size, b.budget % b.source_size
             - (sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) - k.size))) END AS BIGINT) AS taken
FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
"""

ORACLE["op8_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), kinds AS (
  SELECT *, CASE WHEN role = 'user' THEN (['image', 'audio', 'document'])[(turn // 2) % 3 + 1] END AS kind,
         length(text) - length(replace(text, chr(10), '')) + 1 AS lines FROM rows
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length(role) + length(text) + 8 + 8 + 7 + 1 + coalesce(length('<|part:0:' || kind || '|>'), 0)
             + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\])'))) AS chars,
         count(kind) AS n_attachments,
         sum(CASE kind WHEN 'document' THEN 512 * lines + 1 WHEN 'image' THEN lines + 2 WHEN 'audio' THEN lines + 2 ELSE 0 END) AS tokens
  FROM kinds GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(chars AS BIGINT) AS formatted_chars, n_attachments, CAST(tokens AS BIGINT) AS placeholder_tokens FROM whole
"""

ORACLE["op10_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM windows), (SELECT unnest(range(0, 5)) AS k)
  WHERE c > 1 GROUP BY doc_id
), counted AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         len([x FOR x IN w IF lower(x) IN (
           'a','an','and','are','as','at','be','by','for','from','in','is','it','of','on','or','that','the','this','to','was','with',
           'als','auf','das','dem','den','der','des','die','ein','eine','für','im','ist','mit','nicht','sich','und','von','zu',
           'au','aux','avec','ce','dans','de','du','elle','en','est','et','il','la','le','les','par','pas','pour','que','qui','sur','un','une',
           'al','como','con','del','el','es','las','lo','los','no','para','por','se','su','una','y')]) AS n_stop
  FROM split s LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words AS r1, 100 * word_chars < 200 * n_words OR 100 * word_chars > 1500 * n_words AS r2,
         100 * n_stop < 2 * n_words AS r3, 100 * n_dup_lines > 30 * n_lines AS r4 FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR r1 OR r2 OR r3 OR r4) AS kept,
       concat_ws(', ', CASE WHEN n_words < 10 THEN 'enough words' END,
         CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 'repeated windows' END,
         CASE WHEN r1 THEN 'symbols for each word' END, CASE WHEN r2 THEN 'characters for each word' END,
         CASE WHEN r3 THEN 'stop words' END, CASE WHEN r4 THEN 'repeated lines' END) AS broken
FROM judged
"""

ORACLE["op12_merkle_manifest"] = r"""
WITH RECURSIVE d AS (
  SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS before, coalesce(strlen(text) || ':' || text, '-') AS after,
         list_reduce(flatten([[4294967295]] || [[ord(x), 256, 256, 256, 256, 256, 256, 256, 256] FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda c, x: CASE WHEN x < 256 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree,
         sha256(before || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || after) AS leaf,
         sha256(before || coalesce(strlen(CAST(n_chars + hit AS VARCHAR)) || ':' || (n_chars + hit), '-') || after) AS seen
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS hit FROM d)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed
), nodes AS (
  SELECT tree, 0 AS height, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, height + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, height, pos // 2, n
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), over_all AS (
  SELECT 0 AS height, pos, digest, n FROM subroots
  UNION ALL
  SELECT height + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM over_all WHERE n > 1 GROUP BY height, pos // 2, n
), climb AS (
  SELECT doc_id, leaf, tree, pos, 0 AS height, seen AS folded, '' AS proof, n FROM leaves
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.pos // 2, c.height + 1,
         sha256(CASE WHEN c.pos % 2 = 0 THEN c.folded || coalesce(s.digest, '') ELSE s.digest || c.folded END),
         c.proof || coalesce(s.digest, ''), (c.n + 1) // 2
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.height = c.height AND s.pos = xor(c.pos, 1) WHERE c.n > 1
), higher AS (
  SELECT c.doc_id, c.leaf, r.digest AS subroot, r.pos, 0 AS height, c.folded, c.proof, r.n FROM climb c JOIN subroots r ON c.tree = r.tree WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.pos // 2, c.height + 1,
         sha256(CASE WHEN c.pos % 2 = 0 THEN c.folded || coalesce(s.digest, '') ELSE s.digest || c.folded END),
         c.proof || coalesce(s.digest, ''), (c.n + 1) // 2
  FROM higher c LEFT JOIN over_all s ON s.height = c.height AND s.pos = xor(c.pos, 1) WHERE c.n > 1
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM over_all WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = (SELECT digest FROM over_all WHERE n = 1) AS verified
FROM higher WHERE n = 1
"""
