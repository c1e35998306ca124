"""Configuration sources (A3, A4): vocabularies, site rules, normaliser and
synonym configurations as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.canonical import parse_references


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A3: a JSON array of strings -> ``vocab(entry)`` lower-cased, distinct.
    The file is read whole by Spark (``wholetext``) and exploded there."""
    raw = spark.read.text(path, wholetext=True)
    return (raw.select(F.explode(F.from_json("value", "array<string>")).alias("entry"))
            .select(F.lower("entry").alias("entry")).where(F.col("entry").isNotNull()).distinct())


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """A4: site rules as JSON lines ``{"site", "field", "begin", "end"}``."""
    return spark.read.schema("site string, field string, begin string, end string").json(path)


def _json_file(spark: SparkSession, path: str):
    """One small JSON file, read by Spark wherever it lies."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def load_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """Synonym configuration ``{name: {references: ["canonical: a, b"], parameters: {threshold}}}``
    -> ``(field, canonical, synonym, ref_ix, syn_ix, threshold)``."""
    conf = _json_file(spark, path)
    rows = []
    for name, spec in conf.items():
        thr = float(spec.get("parameters", {}).get("threshold", "0.9"))
        for r in parse_references(spec.get("references", []), name):
            rows.append((*r, thr))
    return spark.createDataFrame(rows, "field string, canonical string, synonym string, ref_ix int, syn_ix int, "
                                       "threshold double")


def load_normalize_config(spark: SparkSession, path: str) -> dict:
    """Normaliser configuration ``{field: {data_type, range?, function}}`` in
    the shape of ``config.NORMALIZE_CONFIG``."""
    conf = _json_file(spark, path)
    out = {}
    for field, spec in conf.items():
        entry = {"data_type": spec.get("data_type"), "function": spec["function"]}
        if "range" in spec:
            entry["range"] = (spec["range"]["lower_bound"], spec["range"]["upper_bound"])
        out[field] = entry
    return out
