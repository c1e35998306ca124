"""The corpus pipeline over ``documents``: toxic documents go, one document of
each near-duplicate group stays, documents that hold benchmark passages go,
secrets are blotted out, and what is left is encoded and decoded.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept; each result is written as Parquet and read again as the next one's
input.  All stages but the last return the columns of ``documents``.

Rows with a null doc_id are never labelled, linked or matched; they pass the first
three stages unless their text is toxic.  Rows that repeat a doc_id stay or go
together as far as links and benchmark passages decide.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.common import free_names, stored
from fieldloom.llm.pair_bpe import decode, encode
from fieldloom.llm.secret_scan import redact
from fieldloom.llm.spaced_seeds import decontaminate
from fieldloom.llm.token_groups import jaccard_classes
from fieldloom.llm.toxicity import score, train

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (4): rows whose noisy-or score reaches ``TOXIC`` go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # the row travels as one struct, so no column of it can clash with the score's
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), "text")
    return score(rows, model, keep=["__row"]).where(F.col("score") < TOXIC).select("__row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (3): of each group the document with the smallest doc_id stays."""
    later = jaccard_classes(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (7): documents that hold a benchmark passage go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans (9): reported spans are replaced; ``n_chars`` follows the text."""
    before, = free_names(docs, "__before")
    out = redact(docs.withColumn(before, F.length("text")))
    changed = F.length("text") != F.col(before)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding (10): token counts, and digests of the ids and of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = decode(encode(docs, path, keep=["doc_id", "lang", "source"]), path)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_benchmark),
          ("secrets", blot_secrets), ("bpe", encode_decode)]

ORACLE_SQL = None  # learned scores and components of links are no SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
