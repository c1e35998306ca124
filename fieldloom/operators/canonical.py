"""Vocabulary canonicalisation by hybrid Jaccard with Jaro partial matching.

Our definition (the matcher itself is not part of the source): a value and a
reference entry are split into whitespace tokens; pairs of tokens whose Jaro
similarity reaches the threshold are matched greedily, highest first and one to
one; the score is the sum of matched similarities divided by
``|A| + |B| - matched``.  A value maps to the
canonical name of its best-scoring entry (ties: reference order) when the
score reaches the threshold; single-token values reduce to plain Jaro.

Scale: the work runs once per *distinct* value (the source's memo).  Pairs are
pruned exactly by length: Jaro >= t needs ``min/max length >= 3t - 2``, so each
value token is expanded to its admissible lengths and meets reference tokens
by an equi join on length; the reference table is a size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions.text import jaro
from fieldloom.operators.plumbing import bounded_broadcast


def parse_references(references, field: str | None = None):
    """``"canonical: syn, syn"`` strings -> rows ``(field, canonical,
    synonym, ref_ix, syn_ix)``; the canonical name is its own synonym 0."""
    rows = []
    for ref_ix, ref in enumerate(references):
        canonical, _, rest = ref.partition(":")
        canonical = canonical.strip().lower()
        syns = [canonical] + [s.strip().lower() for s in rest.split(",") if s.strip()]
        for syn_ix, syn in enumerate(syns):
            rows.append((field, canonical, syn, ref_ix, syn_ix))
    return rows


def reference_table(spark, references_by_field: dict) -> DataFrame:
    rows = []
    for field, refs in references_by_field.items():
        rows.extend(parse_references(refs, field))
    return spark.createDataFrame(rows, "field string, canonical string, synonym string, ref_ix int, syn_ix int")


def _tokens(c):
    return F.filter(F.split(F.trim(F.lower(c)), r"[ \t\n\x0B\f\r]+"), lambda t: t != "")


def _one_to_one(pairs):
    """Sum and count of a greedy one-to-one token match: pairs of (-sim, a, b) in
    order, each token of either side used once."""
    start = F.struct(F.array().cast("array<int>").alias("a"), F.array().cast("array<int>").alias("b"), F.lit(0.0).alias("s"))

    def take(acc, p):
        free = ~F.array_contains(acc["a"], p["a_ix"]) & ~F.array_contains(acc["b"], p["b_ix"])
        return F.when(free, F.struct(F.concat(acc["a"], F.array(p["a_ix"])).alias("a"), F.concat(acc["b"], F.array(p["b_ix"])).alias("b"),
                                     (acc["s"] - p["neg"]).alias("s"))).otherwise(acc)
    return F.aggregate(F.array_sort(pairs), start, take, lambda acc: F.struct(acc["s"].alias("s"), F.size(acc["a"]).alias("m")))


def best_matches(values: DataFrame, refs: DataFrame, threshold: float | str = config.HYBRID_JACCARD_THRESHOLD,
                 max_broadcast_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """``values(field, value)`` (distinct) x ``refs(field, canonical, synonym,
    ref_ix, syn_ix[, threshold])`` -> ``(field, value, canonical, score)`` for
    values whose best entry reaches the threshold (the entry's own, if the
    references have one).

    A value that is an entry's text is that entry (first in reference order);
    only the others are compared.  Tokens meet by length where the lowest
    threshold allows to prune, else by field."""
    low = float(threshold)
    refs = refs.withColumn("threshold", F.coalesce(F.col("threshold").cast("double"), F.lit(low)) if "threshold" in refs.columns
                           else F.lit(low))
    refs = refs.select("field", "canonical", "synonym", "ref_ix", "syn_ix", "threshold")
    if refs.schema["threshold"].nullable:
        low = refs.agg(F.min("threshold")).first()[0] or low
    order = F.min(F.struct(F.lit(-1.0).alias("neg_score"), "ref_ix", "syn_ix", "canonical")).alias("b")
    exact = (values.join(bounded_broadcast(refs.withColumn("value", F.lower(F.trim("synonym"))), max_broadcast_rows), ["field", "value"])
             .groupBy("field", "value").agg(order))
    rest = values.join(exact, ["field", "value"], "left_anti")
    ratio = 3 * low - 2
    vt = (rest.select("field", "value", F.posexplode(_tokens(F.col("value"))).alias("a_ix", "a"))
          .withColumn("n_a", F.size(_tokens(F.col("value")))))
    rt = (refs.select("*", F.posexplode(_tokens(F.col("synonym"))).alias("b_ix", "b"))
          .withColumn("n_b", F.size(_tokens(F.col("synonym")))))
    on = ["field"]
    if ratio > 0:  # Jaro >= t needs min/max length >= 3t - 2
        lo = F.greatest(F.floor(F.length("a") * ratio).cast("int") - 1, F.lit(1))
        hi = F.ceil(F.length("a") / ratio).cast("int") + 1
        vt = vt.withColumn("lb", F.explode(F.sequence(lo, F.greatest(lo, hi))))
        rt = rt.withColumn("lb", F.length("b"))
        on = ["field", "lb"]
    pairs = vt.join(bounded_broadcast(rt, max_broadcast_rows), on, "inner")
    sims = pairs.withColumn("sim", jaro("a", "b")).where(F.col("sim") >= F.col("threshold"))
    entry = ["field", "value", "canonical", "synonym", "ref_ix", "syn_ix", "threshold", "n_a", "n_b"]
    per_entry = (sims.groupBy(*entry).agg(F.collect_list(F.struct((-F.col("sim")).alias("neg"), "a_ix", "b_ix")).alias("pairs"))
                 .withColumn("r", _one_to_one(F.col("pairs")))
                 .withColumn("score", F.col("r.s") / (F.col("n_a") + F.col("n_b") - F.col("r.m")))
                 .where(F.col("score") >= F.col("threshold")))
    near = (per_entry.groupBy("field", "value")
            .agg(F.min(F.struct((-F.col("score")).alias("neg_score"), "ref_ix", "syn_ix", "canonical")).alias("b")))
    return exact.union(near).select("field", "value", F.col("b.canonical").alias("canonical"), (-F.col("b.neg_score")).alias("score"))


def canonicalize(df: DataFrame, value_col: str, refs: DataFrame, *, field_col: str | None = None,
                 out_col: str = "canonical", score_col: str | None = None,
                 threshold: float | str = config.HYBRID_JACCARD_THRESHOLD,
                 max_broadcast_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Add ``out_col`` (and optionally ``score_col``): the canonical vocabulary
    name of ``value_col``, or null.  With ``field_col`` each row is matched
    only against its own field's references; rows of fields without
    references get null.  Values are matched case-insensitively."""
    all_fields = "\u0000all"
    fld = F.col(field_col) if field_col else F.lit(all_fields)
    r = refs if field_col else refs.withColumn("field", F.lit(all_fields))
    # rows of fields without references get a short key of no value, so their texts are never joined by value
    # and they spread over the join's partitions
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(value_col), F.lit(4099)).cast("string"))
    named = bounded_broadcast(r.select(F.col("field").alias("__f")).distinct().withColumn("__has", F.lit(True)), max_broadcast_rows)
    keyed = (df.withColumn("__f", fld).join(named, "__f", "left")
             .withColumn("__v", F.when(F.col("__has"), F.lower(F.trim(F.col(value_col)))).otherwise(spread)).drop("__has"))
    distinct_vals = (keyed.select("__f", "__v").where(F.col("__v").isNotNull() & ~F.col("__v").startswith("\u0000")).distinct()
                     .select(F.col("__f").alias("field"), F.col("__v").alias("value")))
    best = best_matches(distinct_vals, r, threshold, max_broadcast_rows).select(
        F.col("field").alias("__f"), F.col("value").alias("__v"),
        F.col("canonical").alias(out_col), F.col("score").alias("__score"))
    out = keyed.join(best, ["__f", "__v"], "left").drop("__f", "__v")
    return out.withColumnRenamed("__score", score_col) if score_col else out.drop("__score")


def default_references(spark) -> DataFrame:
    """Eye and hair colour references of the configuration.  No ethnicity
    vocabulary is shipped: users supply their own table."""
    return reference_table(spark, {"eye_color": config.EYE_COLOR_REFERENCES,
                                   "hair_color": config.HAIR_COLOR_REFERENCES})
