"""Crawled-page sources and document sinks.

Pages are read with an explicit schema (never inferred: header maps make the
inferred schema unbounded); the bulky crawl columns are not read at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom import config

SITE_VALUE = T.ArrayType(T.StructType([T.StructField("result", T.StructType([T.StructField("value", T.StringType())]))]))

# Crawled page (one JSON object per line).
PAGE_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("cleaned_url", T.StringType()),
    T.StructField("raw_content", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("tld", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    *[T.StructField(src, SITE_VALUE) for srcs in config.SITE_FIELD_SOURCES.values() for src in srcs],
    T.StructField("inferlink_title", SITE_VALUE),
    T.StructField("inferlink_description", SITE_VALUE),
])


def read_pages(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = PAGE_SCHEMA,
               glob: str | None = "*.jl") -> DataFrame:
    """A1/A2: JSON-lines pages (a file, or a directory filtered by ``glob``)
    or Parquet.  ``_id`` becomes ``cdr_id``; epoch-millisecond ``timestamp``
    becomes ``crawl_ts``; site fields become arrays of their values."""
    reader = spark.read.schema(schema)
    if fmt == "json":
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        df = reader.json(path)
    else:
        df = reader.format(fmt).load(path)
    return normalize_page_columns(df)


def normalize_page_columns(df: DataFrame) -> DataFrame:
    out = df
    if "_id" in out.columns:
        out = out.withColumnRenamed("_id", "cdr_id")
    if "timestamp" in out.columns:
        out = out.withColumn("crawl_ts", F.timestamp_millis("timestamp"))
    for c, t in out.dtypes:
        if c.startswith("inferlink_") and t.startswith("array<struct<result"):
            out = out.withColumn(c, F.transform(F.col(f"`{c}`"), lambda x: x["result"]["value"]))
    return out


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def index_documents(documents: DataFrame, id_col: str = "cdr_id") -> DataFrame:
    """The search-index document shape ``(id, url, tld, fields)``; field
    names are already renamed to the index spelling by ``assemble``."""
    cols = [c for c in (id_col, "url", "tld", "fields") if c in documents.columns]
    return documents.select(*cols)


def write_index_documents(documents: DataFrame, path: str, id_col: str = "cdr_id", mode: str = "overwrite") -> None:
    """Write index-shaped documents as JSON lines (bulk-load ready)."""
    index_documents(documents, id_col).write.mode(mode).json(path)


# --- the typed index shape (A7) ---------------------------------------------------

def _typed(value, kind: str):
    """A value as the index wants it: a whole number, or an ISO date or time (the index's
    ``strict_date_optional_time``, or milliseconds since 1970); null where it does not fit."""
    if kind == "long":
        return F.when(F.trim(value).rlike(r"^[+-]?[0-9]+(\.0+)?$"), F.regexp_replace(F.trim(value), r"\.0+$", "").try_cast("bigint"))
    if kind == "date":
        iso = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2}(T[0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?)?)?$"
        hours = F.regexp_replace(value, r"(T[0-9]{2})(Z|[+-][0-9]{2}:?[0-9]{2})?$", "$1:00$2")
        zoned = F.regexp_replace(hours, r"(T[0-9]{2}:[0-9]{2})(Z|[+-][0-9]{2}:?[0-9]{2})?$", "$1:00$2")
        day = F.try_to_timestamp(zoned)
        millis = F.timestamp_millis(F.when(value.rlike(r"^-?[0-9]{5,18}$"), value.cast("bigint")))
        return F.coalesce(F.when(value.rlike(iso), day), millis)
    return value


def index_rows(fields: DataFrame, renames=None, schema=None, types=None) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of consolidated field values (long table): names spelled as in the
    index, members typed.  A value whose field or tier the index does not have, or whose
    typed member does not fit, goes to the quarantine, ``(doc_id, field, tier, key, name, reason)``; the
    rest of its document is untouched.  A fallback's empty key is no misfit of its own: the key
    is then null."""
    renames = config.INDEX_FIELD_RENAMES if renames is None else renames
    schema = config.INDEX_FIELDS if schema is None else schema
    types = config.INDEX_TYPES if types is None else types
    spelled = F.col("field")
    for old, new in renames.items():
        spelled = F.when(F.col("field") == old, new).otherwise(spelled)
    known, misfit = F.lit(False), F.lit(False)
    number, moment = F.lit(None).cast("bigint"), F.lit(None).cast("timestamp")
    for field, (tiers, _) in schema.items():
        known = known | ((F.col("field") == field) & F.col("tier").isin(*tiers))
    for field, kind in types.items():
        hit = F.col("field") == field
        number = F.when(hit, _typed(F.col("name"), kind)).otherwise(number) if kind == "long" else number
        moment = F.when(hit, _typed(F.col("name"), kind)).otherwise(moment) if kind == "date" else moment
        misfit = misfit | (hit & _typed(F.col("name"), kind).isNull())
    rows = fields.withColumn("field", spelled).withColumn("__long", number).withColumn("__date", moment)
    reason = (F.when(~F.coalesce(known, F.lit(False)), "not in the index").when(F.coalesce(misfit, F.lit(False)), "wrong type"))
    rows = rows.withColumn("__reason", reason)
    good = rows.where(F.col("__reason").isNull()).drop("__reason")
    bad = rows.where(F.col("__reason").isNotNull()).select("doc_id", "field", "tier", "key", "name", F.col("__reason").alias("reason"))
    return good, bad


def index_rows_to_documents(good: DataFrame, docs: DataFrame, schema=None, types=None) -> DataFrame:
    """Documents of the index: ``docs`` (with ``doc_id``) and a ``fields`` struct with one member per index field, each a
    struct of its tiers, each a list of ``key`` / ``name`` / ``search`` members of the index's types.  A
    document without values has empty lists.  One aggregation per document; a list holds one document's values
    of one field."""
    schema = config.INDEX_FIELDS if schema is None else schema
    types = config.INDEX_TYPES if types is None else types
    seq = [c for c in ("pass_no", "rank", "pos", "ix") if c in good.columns]

    def member(field, m):
        kind = types.get(field) if m in ("key", "name") else None
        col = {"long": F.col("__long"), "date": F.col("__date")}.get(kind, F.col(m))
        return (F.when(F.col("key") != "", col) if m == "key" and kind else col).alias(m)
    aggs, shape = [], []
    for i, (field, (tiers, members)) in enumerate(schema.items()):
        parts = []
        for tier in tiers:
            name = f"c{i}_{tier}"
            row = F.struct(*seq, F.struct(*(member(field, m) for m in members)).alias("v"))
            aggs.append(F.array_sort(F.collect_list(F.when((F.col("field") == field) & (F.col("tier") == tier), row))).alias(name))
            empty = F.array().cast("array<struct<" + ",".join(
                f"{m}:{({'long': 'bigint', 'date': 'timestamp'}.get(types.get(field), 'string') if m != 'search' else 'string')}" for m in members) + ">>")
            parts.append(F.coalesce(F.transform(name, lambda x: x["v"]), empty).alias(tier))
        shape.append(F.struct(*parts).alias(field))
    per_doc = good.groupBy(F.col("doc_id").alias("__doc")).agg(*aggs)
    return (docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
            .select(*(F.col(f"`{c}`") for c in docs.columns), F.struct(*shape).alias("fields")))
