"""Registered queries of this subpackage: each applies its operator to the whole
of its table with production parameters and returns the full result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.arc_warc import convert, http_field
from fieldloom.llm.best_fit import best_fit, token_pieces
from fieldloom.llm.common import stored
from fieldloom.llm.epsilon_grid import near_copies
from fieldloom.llm.kd_shards import kd_shards
from fieldloom.llm.pair_bpe import decode, encode
from fieldloom.llm.phrase_mining import collocations
from fieldloom.llm.secret_scan import scan
from fieldloom.llm.seek_frames import archive, digests, infill
from fieldloom.llm.sentence_spans import remove_spans, repeated_spans
from fieldloom.llm.spaced_seeds import contaminated
from fieldloom.llm.token_groups import jaccard_classes
from fieldloom.llm.toxicity import toxicity
from fieldloom.llm.trie_counts import token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(_table(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_sentences",
                      F.size("offending").cast("long").alias("n_offending"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges that are removed, each with what is left of its text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    spans = stored(repeated_spans(docs), "spans")
    left = (remove_spans(docs, spans, only_cut=True)
            .select("doc_id", "text_hash", F.length("text").cast("long").alias("chars_left"), F.sha2("text", 256).alias("text_sha256")).distinct())
    return spans.join(left, ["doc_id", "text_hash"], "left").drop("text_hash")


def op5_sentence_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    spans = stored(repeated_spans(docs, open_ends=True, min_words=25, min_stretch=0), "spans")
    ranges = (spans.groupBy("doc_id", "text_hash")
              .agg(F.array_sort(F.collect_list(F.struct("first_sentence", "last_sentence", "start", "stop", "kept_in"))).alias("ranges")))
    left = (remove_spans(docs, spans)
            .select("doc_id", "text_hash", F.length("text").cast("long").alias("chars_left"), F.sha2("text", 256).alias("text_sha256")))
    return left.join(ranges, ["doc_id", "text_hash"], "left").select("doc_id", "ranges", "chars_left", "text_sha256")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_arc_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = convert(_table(spark, sf_dir, "pages"), version=None)
    whole = F.when(F.col("type") == "revisit", http_field(F.col("head"), "Content-Length").cast("long")).otherwise(F.octet_length("body"))
    digest = F.when(F.col("type") == "revisit", F.col("payload_digest")).otherwise(F.sha2("body", 256))
    return back.select(F.col("key").alias("page_id"), whole.cast("long").alias("payload_bytes"), digest.alias("payload_digest"),
                       F.col("type").alias("record_type"), F.col("refers_key").alias("refers_to"))


def op9_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (scan(_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = decode(encode(_table(spark, sf_dir, "documents"), path, keep=["doc_id"]), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return best_fit(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op12_seek_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = stored(archive(_table(spark, sf_dir, "documents").select("doc_id", "text")), "archive")
    return digests(infill(frames))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_kd_shards": op1_kd_shards,
    "op2_epsilon_grid": op2_epsilon_grid,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_toxicity": op4_toxicity,
    "op5_sentence_spans": op5_sentence_spans,
    "op5_sentence_removal": op5_sentence_removal,
    "op6_token_counts": op6_token_counts,
    "op7_benchmark_overlap": op7_benchmark_overlap,
    "op8_arc_warc": op8_arc_warc,
    "op9_secret_links": op9_secret_links,
    "op10_bpe": op10_bpe,
    "op11_best_fit": op11_best_fit,
    "op12_seek_frames": op12_seek_frames,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op8_arc_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 AND page_id IS NOT NULL GROUP BY digest)
SELECT d.page_id, CAST(n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
""",
    "op12_seek_frames": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(concat('42:', doc_id)) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
d AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM t),
c AS (
  SELECT doc_id, text, n, units, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
parts AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS cover
  FROM (SELECT lang, a, w, m, unnest(generate_series(1, k - m + 1)) AS i FROM parts, (VALUES (2), (3)) AS s(m) WHERE m < k) GROUP BY ALL),
kept AS (
  SELECT p.* FROM parts p LEFT JOIN inner_ c ON p.lang = c.lang AND p.phrase = c.phrase
  WHERE c.cover IS NULL OR CAST(100 AS HUGEINT) * c.cover < CAST(80 AS HUGEINT) * p.a),
cuts AS (
  SELECT p.lang, p.phrase, p.a, c, l.a AS l, r.a AS r, CAST((CAST(2000000 AS HUGEINT) * p.a) // (l.a + r.a) AS BIGINT) AS score
  FROM kept p, (VALUES (1), (2), (3)) AS s(c), f l, f r
  WHERE c < p.k AND l.lang = p.lang AND r.lang = p.lang AND l.phrase = array_to_string(p.w[1:c], ' ') AND r.phrase = array_to_string(p.w[c + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= 2000
""",
}
