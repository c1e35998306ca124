"""Consolidation of mentions into ranked, normalised, deduplicated fields
(G1-G13).

Input is a ``candidates`` table, one row per candidate value::

    doc_id, field, tier ('strict'|'relaxed'), pass_no, rank, pos, value,
    probability, selected, [centimeter, kilogram, state, country, longitude,
    latitude, canonical]

A candidate may hold a list instead of one value: ``values`` (array of strings, or
of arrays of strings) has one value per element, in order (G9).  Columns that say
where a candidate comes from (``PROVENANCE``, B11) are carried to the result.

Arrival order within a field is ``seq = (pass_no, rank, pos, ix)``: token spans use
``rank = -probability`` (highest first, stable on position), other passes
``rank = 0``; ``ix`` is the place in a list.  Pass numbers follow the source's order: 1 strict spans,
2 strict extractor values, 3 title strict, 4 title relaxed, 5 description
strict, 6 relaxed spans, 7 relaxed extractor values, 8 description relaxed.

Order-dependent rules are expressed as grouped minima over ``seq`` (partial
aggregation), and what a minimum says is joined back on the group and the whole
``seq``, so the rows of a hot document or field are dealt out over all tasks:

* routing (G4): a strict-tier candidate stays strict when ``selected`` is
  present, or ``probability >= 0.5``, or it is the field's first strict-tier
  candidate; otherwise it is demoted to relaxed;
* normalisation (G6/G7): the field's configured normaliser, a failed one
  falling back to ``key='', name=raw``; unconfigured fields pass through;
* dedupe (G8): per (doc, field, routed tier) the first value of each name is
  kept; fallbacks and unconfigured fields are never deduplicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions import normalize as N

SEQ = ["pass_no", "rank", "pos", "ix"]

# Where a candidate comes from: extractor name, "text" or "tokens", source column, segment, table cell.
PROVENANCE = ["extractor", "input_type", "source", "segment", "cell"]

OPTIONAL = {"probability": "double", "selected": "boolean", "centimeter": "array<int>",
            "kilogram": "array<double>", "state": "string", "country": "string",
            "longitude": "double", "latitude": "double", "canonical": "string"}


def with_optional_columns(cands: DataFrame) -> DataFrame:
    for c, t in OPTIONAL.items():
        if c not in cands.columns:
            cands = cands.withColumn(c, F.lit(None).cast(t))
    if "rank" not in cands.columns:
        cands = cands.withColumn("rank", F.lit(0.0))
    return explode_lists(cands)


def explode_lists(cands: DataFrame) -> DataFrame:
    """One candidate per element of a ``values`` list, nested lists flattened, null
    elements and empty lists giving none; a null list leaves ``value`` as it is.  ``ix``
    is the element's place.  Row-local: a list is one row's own."""
    if "values" not in cands.columns:
        return cands if "ix" in cands.columns else cands.withColumn("ix", F.lit(0))
    lists = F.col("values")
    if cands.schema["values"].dataType.simpleString().startswith("array<array<"):
        lists = F.flatten(F.filter(lists, lambda v: v.isNotNull()))
    one = F.when(lists.isNull(), F.array(F.col("value"))).otherwise(F.filter(lists, lambda v: v.isNotNull()))
    kept = [F.col(f"`{c}`") for c in cands.columns if c not in ("value", "values", "ix")]
    return cands.select(*kept, F.posexplode(one).alias("ix", "value"))


def span_rank(probability) -> "F.Column":
    """Rank key of token spans: highest probability first."""
    return -F.coalesce(probability, F.lit(0.0))


def rebuild_spans(spans: DataFrame, threshold: float = config.SPAN_PROBABILITY) -> DataFrame:
    """G1: a span becomes a value when it carries a length and its probability
    is strictly above ``threshold``; the value is its tokens joined by one
    space, stripped."""
    return (spans.where(F.col("end").isNotNull() & (F.col("probability") > threshold))
            .withColumn("value", F.trim(F.col("text"))))


def route(cands: DataFrame) -> DataFrame:
    """Add ``routed_tier``.  One grouped minimum finds each field's
    first strict-tier candidate.  It is joined back on (doc, field) and the
    whole ``seq``: only the first candidate itself meets it, and a hot (doc, field)
    is spread by ``seq`` over all tasks whatever follows in the plan (AQE cannot
    split a skewed join whose partitioning an aggregation above it relies on)."""
    cands = explode_lists(cands)
    first = (cands.where(F.col("tier") == "strict").groupBy("doc_id", "field")
             .agg(F.min(F.struct(*SEQ)).alias("__first"))
             .select(F.col("doc_id").alias("__doc"), F.col("field").alias("__field"),
                     *(F.col(f"__first.{c}").alias(f"__{c}") for c in SEQ), F.lit(True).alias("__met")))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("field").eqNullSafe(F.col("__field"))
    for c in SEQ:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    j = cands.join(first, same, "left")
    keep = (F.col("selected").isNotNull() | (F.col("probability") >= config.STRICT_PROBABILITY) | F.col("__met"))
    strict = (F.col("tier") == "strict") & F.coalesce(keep, F.lit(False))
    return (j.withColumn("routed_tier", F.when(strict, "strict").otherwise("relaxed"))
            .drop("__doc", "__field", "__met", *(f"__{c}" for c in SEQ)))


def normalize_values(cands: DataFrame, normalize_config=None) -> DataFrame:
    """Add ``key, name, num, search`` and ``dedupe`` (whether the row
    takes part in name deduplication)."""
    conf = normalize_config or config.NORMALIZE_CONFIG
    out = N.normalize_frame(cands, "field", "__fv", normalize_config=conf, value="value", canonical="canonical",
                            centimeter="centimeter", kilogram="kilogram", state="state", country="country",
                            longitude="longitude", latitude="latitude")
    out = (out.withColumn("__cfg", N.is_configured("field", conf))
           .withColumn("dedupe", F.col("__cfg") & F.col("__fv").isNotNull()))
    raw = F.col("value")
    return (out.withColumn("key", F.when(F.col("dedupe"), F.col("__fv.key"))
                           .when(F.col("__cfg"), F.lit("")).otherwise(raw))
            .withColumn("name", F.when(F.col("dedupe"), F.col("__fv.name")).otherwise(raw))
            .withColumn("num", F.when(F.col("dedupe"), F.col("__fv.num")))
            .withColumn("search", F.when(F.col("dedupe"), F.col("__fv.search")))
            .drop("__fv", "__cfg"))


def dedupe(values: DataFrame) -> DataFrame:
    """First value per (doc, field, routed tier, name); numeric names are
    compared by number (55 equals 55.0).

    One grouped minimum over ``seq`` does it (partial aggregation, no window
    over a possibly hot group; the name is part of the key, so a hot (doc, field) is
    spread by its names).  Rows that are not deduplicated (fallbacks,
    unconfigured fields) get a row id as key, so they pass through unmerged
    even where all their columns are equal.  No filter
    follows the normaliser projections: a pushed-down filter would inline
    every normaliser step into its condition.
    """
    name_key = (F.when(F.col("num").isNotNull(), F.concat(F.lit("#"), F.col("num").cast("string")))
                .otherwise(F.concat(F.lit("$"), F.coalesce(F.col("name"), F.lit("\u0000null")))))
    own_key = F.concat(F.lit("~"), F.col("__row").cast("string"))
    payload = [c for c in values.columns if c not in ("doc_id", "field", "routed_tier") and c not in SEQ]
    kept = (values.withColumn("__row", F.monotonically_increasing_id()).withColumn("__dk", F.when(F.col("dedupe"), name_key).otherwise(own_key))
            .groupBy("doc_id", "field", "routed_tier", "__dk")
            .agg(F.min(F.struct(*SEQ, *payload)).alias("__m"))
            .select("doc_id", "field", "routed_tier", "__m.*"))
    return kept.select(*values.columns)


def consolidate(cands: DataFrame, normalize_config=None) -> DataFrame:
    """Candidates -> ``fields(doc_id, field, tier, pass_no, rank, pos, key,
    name, num, search)``, with ``ix`` where candidates hold lists and with the
    ``PROVENANCE`` columns that they carry; list order within (doc, field, tier)
    is ``(pass_no, rank, pos, ix)``."""
    c = with_optional_columns(cands)
    routed = route(c)
    values = normalize_values(routed, normalize_config)
    kept = dedupe(values)
    return kept.select("doc_id", "field", F.col("routed_tier").alias("tier"), "pass_no", "rank", "pos",
                       *(["ix"] if {"values", "ix"} & set(cands.columns) else []), "key", "name", "num", "search",
                       *(p for p in PROVENANCE if p in cands.columns))


def title_description_candidates(docs: DataFrame) -> DataFrame:
    """G10/G11 candidates from per-document columns ``doc_id, title,
    strict_text, relaxed_text`` and optional ``inferlink_title``,
    ``inferlink_description``.  ``strict_text`` null means the document has no
    strict segment: then no strict description (and no site-title fallback)
    is produced."""
    for c in ("title", "strict_text", "relaxed_text", "inferlink_title", "inferlink_description"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("string"))
    has_strict = F.col("strict_text").isNotNull()
    # The page title is always visible (deliberate deviation); the site title
    # is the fallback only when a strict segment exists.
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.when(has_strict, F.col("inferlink_title")))
    desc_strict = F.when(has_strict, F.coalesce(F.col("inferlink_description"), F.col("strict_text")))
    def row(field, tier, pass_no, value):
        return F.struct(F.lit(field).alias("field"), F.lit(tier).alias("tier"), F.lit(pass_no).alias("pass_no"),
                        value.alias("value"))
    rows = F.array(row("title", "strict", 3, title), row("title", "relaxed", 4, title),
                   row("description", "strict", 5, desc_strict), row("description", "relaxed", 8, F.col("relaxed_text")))
    out = docs.select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.*")
    return (out.where(F.col("value").isNotNull() & (F.col("value") != ""))
            .withColumn("rank", F.lit(0.0)).withColumn("pos", F.lit(0).cast("bigint")))


def assemble(fields: DataFrame, docs: DataFrame, renames=None) -> DataFrame:
    """G12/G13 + A7: nested ``fields`` map per document:
    ``MAP<field, STRUCT<strict: ARRAY<FV>, relaxed: ARRAY<FV>>>``; both tiers
    are present (possibly empty) once a field is seen, documents without
    fields get an empty map.  Field names are renamed for the index.

    Each array holds one document's values of one field, so a collection is
    bounded by that document's own mentions."""
    renames = renames if renames is not None else config.INDEX_FIELD_RENAMES
    fname = F.col("field")
    for a, b in renames.items():
        fname = F.when(F.col("field") == a, F.lit(b)).otherwise(fname)
    seq = [c for c in SEQ if c in fields.columns]
    fv = F.struct(*seq, F.struct("key", "name", "num", "search").alias("v"))
    per_field = (fields.withColumn("field", fname)
                 .groupBy("doc_id", "field")
                 .agg(F.array_sort(F.collect_list(F.when(F.col("tier") == "strict", fv))).alias("s"),
                      F.array_sort(F.collect_list(F.when(F.col("tier") == "relaxed", fv))).alias("r"))
                 .select("doc_id", "field", F.struct(F.transform("s", lambda x: x["v"]).alias("strict"),
                                                     F.transform("r", lambda x: x["v"]).alias("relaxed")).alias("tiers")))
    per_doc = per_field.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "tiers"))).alias("fields"))
    empty = F.create_map().cast("map<string,struct<strict:array<struct<key:string,name:string,num:double,search:string>>,"
                                "relaxed:array<struct<key:string,name:string,num:double,search:string>>>>")
    return docs.join(per_doc, "doc_id", "left").withColumn("fields", F.coalesce(F.col("fields"), empty))
