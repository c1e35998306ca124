"""End-to-end composition: crawled pages -> nested field documents.

``extract`` (stage 1) and ``consolidate_documents`` (stage 2) are plain
``DataFrame -> DataFrame`` functions, so the same plan runs in batch and, per
micro-batch, in Structured Streaming (see ``fieldloom.streaming``).

Shuffles: strict-content boilerplate counting (site, block), the page-text
regroup (page), routing / dedupe minima and document assembly (page, field).
Vocabulary, rule and model tables are size-checked broadcasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.operators import consolidate as G
from fieldloom.operators import content, mentions, tokens
from fieldloom.session import cut_lineage

TEXT_SEGMENTS = ("content_strict", "content_relaxed")

# Tier and pass numbers (token spans, extractor values) of each kind of text.
PASSES = {"content_strict": ("strict", 1, 2), "content_relaxed": ("relaxed", 6, 7), "table": ("relaxed", 9, 10), "url": ("relaxed", 11, 12)}


def texts_of(pages: DataFrame, segs: DataFrame, id_col: str, html_col: str, url_col: str, cells: bool, url_tokens: bool) -> DataFrame:
    """Everything that extractors read, ``(id, segment, cell, cell_no, source, text)``: main text,
    table cells (``cell`` is ``table/row/cell``, ``cell_no`` their order) and URL words."""
    none = [F.lit(None).cast("string").alias("cell"), F.lit(0).cast("bigint").alias("cell_no")]
    out = segs.where(F.col("segment").isin(*TEXT_SEGMENTS)).select(id_col, "segment", *none, "source", "text")
    if cells:
        c = content.extract_tables(pages, id_col, html_col)
        no = (F.col("table_ix").cast("bigint") * (1 << 26)) + (F.col("row_ix").cast("bigint") * (1 << 10)) + F.col("cell_ix")
        out = out.unionByName(c.select(id_col, F.lit("table").alias("segment"), F.concat_ws("/", "table_ix", "row_ix", "cell_ix").alias("cell"),
                                       no.alias("cell_no"), F.lit(html_col).alias("source"), "text"))
    if url_tokens:
        out = out.unionByName(pages.select(id_col, F.lit("url").alias("segment"), *none, F.lit(url_col).alias("source"),
                                           content.url_text(url_col).alias("text")))
    return out.where(F.col("text") != "")


def extract(pages: DataFrame, vocab: DataFrame, *, id_col: str = "page_id", html_col: str = "html",
            url_col: str = "url", field: str = "phrase", n: int = 3, regexes=None, segments: DataFrame | None = None,
            cells: bool = False, url_tokens: bool = False, height_weight: bool = False, hooks=None) -> dict:
    """Stage 1: segments, token spans and extractor values.

    ``vocab(entry, weight)`` is the dictionary; ``weight`` becomes the span
    probability.  A vocabulary with ``field`` (and ``n``) columns, as ``mentions.vocabularies``
    makes it, serves several fields in one pass.  ``regexes`` maps a field to a pattern or a
    ``(pattern, group)`` pair (default: email).  ``cells`` and ``url_tokens`` let every extractor
    read table cells and URL words too; ``height_weight`` adds X11/X12.  ``hooks`` maps a field to a
    Python function text -> values; what it raises is kept in ``errors``.  ``segments`` gives
    content that was parsed before.
    Returns DataFrames keyed by ``(id, segment, cell)``: ``{"segments", "spans", "regex",
    "measures", "hooks", "errors", "site_text"}``.
    """
    regexes = regexes if regexes is not None else {"email": mentions.EMAIL_PATTERN}
    # Segments feed three consumers; materialise them once (reliably, in the
    # shared checkpoint folder) instead of re-parsing the HTML per consumer.
    segs = cut_lineage(segments if segments is not None else content.segments(pages, id_col, html_col, url_col))
    texts = texts_of(pages, segs, id_col, html_col, url_col, cells, url_tokens)
    keys = [id_col, "segment", "cell", "cell_no", "source"]
    toks = texts.select(*keys, tokens.tokenize(F.col("text")).alias("tokens"))
    spans = mentions.dictionary_mentions(toks, keys, "tokens", vocab, field=field, n=n)
    if "weight" in spans.columns:
        spans = spans.withColumnRenamed("weight", "probability")
    found = None
    for fld, spec in regexes.items():
        pattern, group = (spec, 0) if isinstance(spec, str) else spec
        m = mentions.regex_mentions(texts, keys, "text", pattern, field=fld, group=group)
        found = m if found is None else found.unionByName(m)
    measures = None
    if height_weight:
        records = texts.select(*keys, mentions.height_weight("text").alias("hw"))
        measures = mentions.split_height_weight(records, keys)
    hooked, errors = None, None
    for fld, function in (hooks or {}).items():
        m, e = mentions.hook_mentions(texts, keys, "text", function, field=fld)
        hooked = m if hooked is None else hooked.unionByName(m)
        errors = e if errors is None else errors.unionByName(e)
    return {"segments": segs, "spans": spans, "regex": found, "measures": measures, "hooks": hooked, "errors": errors,
            "site_text": site_text(pages, id_col)}


def site_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame | None:
    """``(id, inferlink_title, inferlink_description)`` of the pages that have
    either: the column's text, or the first non-empty element of an array."""
    present = [c for c in ("inferlink_title", "inferlink_description") if c in pages.columns]
    if not present:
        return None

    def first(c):
        v = F.col(f"`{c}`")
        if pages.schema[c].dataType.simpleString().startswith("array"):
            v = F.get(F.filter(F.transform(v, lambda e: e.cast("string")), lambda e: e.isNotNull() & (e != "")), 0)
        return F.nullif(v.cast("string"), F.lit("")).alias(c)
    texts = pages.select(id_col, *map(first, present))
    return texts.groupBy(id_col).agg(*(F.max(c).alias(c) for c in present))


def candidates(extracted: dict, id_col: str = "page_id") -> DataFrame:
    """Stage-2 input: spans (passes 1, 6, 9, 11), extractor values (2, 7, 10, 12) and title /
    description (3, 4, 5, 8) as one candidates table with their provenance.  Within a
    pass, order is by cell and place in the text."""
    def tier_and_pass(kind):
        tier, number = F.lit("relaxed"), F.lit(None).cast("int")
        for segment, spec in PASSES.items():
            hit = F.col("segment") == segment
            tier, number = F.when(hit, spec[0]).otherwise(tier), F.when(hit, spec[kind]).otherwise(number)
        return tier.alias("tier"), number.alias("pass_no")

    def rows(df, kind, place, **own):
        """Candidates of one kind of mention; what a kind does not have is null."""
        def of(name, ddl, default=None):
            return own.get(name, F.col(name) if name in df.columns else F.lit(default)).cast(ddl).alias(name)
        pos = F.col("cell_no") * (1 << 24) + F.coalesce(place, F.lit(0)).cast("bigint")
        return df.select(F.col(id_col).alias("doc_id"), "field", *tier_and_pass(kind), of("rank", "double", 0.0), pos.alias("pos"),
                         of("value", "string"), of("probability", "double"), of("centimeter", "array<int>"), of("kilogram", "array<double>"),
                         of("extractor", "string"), of("input_type", "string"), of("source", "string"), of("segment", "string"), of("cell", "string"))
    spans = G.rebuild_spans(extracted["spans"])
    parts = [rows(spans, 1, F.col("start"), rank=G.span_rank(F.col("probability")))]
    if extracted.get("regex") is not None:
        parts.append(rows(extracted["regex"], 2, F.col("start")))
    if extracted.get("hooks") is not None:
        parts.append(rows(extracted["hooks"], 2, F.col("match_ix")))
    if extracted.get("measures") is not None:
        lists = F.coalesce(F.col("centimeter").cast("array<string>"), F.col("kilogram").cast("array<string>"))
        parts.append(rows(extracted["measures"], 2, F.lit(0), value=F.array_join(lists, ","), extractor=F.lit("height_weight"), input_type=F.lit("text")))
    segs = extracted["segments"]
    per_doc = (segs.groupBy(id_col)
               .agg(F.max(F.when(F.col("segment") == "title", F.col("text"))).alias("title"),
                    F.max(F.when(F.col("segment") == "content_strict", F.col("text"))).alias("strict_text"),
                    F.max(F.when(F.col("segment") == "content_relaxed", F.col("text"))).alias("relaxed_text"))
               .withColumnRenamed(id_col, "doc_id"))
    if extracted.get("site_text") is not None:
        site = extracted["site_text"].withColumnRenamed(id_col, "doc_id")
        per_doc = per_doc.join(site, "doc_id", "left")
    parts.append(G.title_description_candidates(per_doc))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def site_order(source) -> "F.Column":
    """The place of a site source in the site-field configuration."""
    out = F.lit(0).cast("bigint")
    for i, src in enumerate(s for srcs in config.SITE_FIELD_SOURCES.values() for s in srcs):
        out = F.when(source == src, F.lit(i).cast("bigint")).otherwise(out)
    return out


def site_rows(mapped: DataFrame, id_col: str, extractor: str) -> DataFrame:
    """Mapped site values ``(id, field, source, ix, value)`` as strict extractor values (pass 2), in
    the order of the site-field configuration."""
    pos = site_order(F.col("source")) * (1 << 32) + F.col("ix")
    return mapped.select(F.col(id_col).alias("doc_id"), "field", F.lit("strict").alias("tier"), F.lit(2).alias("pass_no"),
                         F.lit(0.0).alias("rank"), pos.alias("pos"), "value", F.lit(None).cast("double").alias("probability"),
                         F.lit(extractor).alias("extractor"), F.lit("text").alias("input_type"), "source")


def landmark_candidates(pages: DataFrame, rules: DataFrame, suffixes: DataFrame, id_col: str = "page_id", url_col: str = "url",
                        html_col: str = "html") -> DataFrame:
    """C5 -> X13: what a site's rules find, its rule field being a site source, as site values."""
    found = content.landmark_values(pages, rules, id_col, suffixes, url_col, html_col)
    values = found.select(id_col, F.col("field").alias("source"), F.col("rule_ix").alias("ix"), "value")
    return site_rows(mentions.map_sources(values, [id_col]), id_col, "landmark")


def site_candidates(pages: DataFrame, id_col: str = "page_id") -> DataFrame | None:
    """Wrapper (site) fields of the pages as strict extractor values
    (pass 2), in the order of the site-field configuration."""
    known = {s for srcs in config.SITE_FIELD_SOURCES.values() for s in srcs}
    present = [c for c in pages.columns if c in known]
    if not present:
        return None
    m = mentions.site_field_mentions(pages.select(id_col, *[F.col(f"`{c}`") for c in present]), [id_col],
                                     with_index=True)
    return site_rows(m, id_col, "site")


def consolidate_fields(pages: DataFrame, vocab: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url",
                       references: DataFrame | None = None, rules: DataFrame | None = None, suffixes: DataFrame | None = None,
                       normalize_config=None, errors_path: str | None = None, **kw) -> DataFrame:
    """Pages -> consolidated field values with provenance (long table).
    Wrapper fields present on the pages (``inferlink_*`` columns, strings or
    arrays of strings) and values of landmark ``rules`` (with ``suffixes``, C5) join the candidates as strict
    extractor values.  With ``references(field, canonical, synonym, ref_ix, syn_ix)`` the vocabulary
    fields (eye/hair colour, ethnicity) are canonicalised (J1) first.  ``errors_path`` gets what
    user extractors (``hooks``) raised, one row per extractor and text, as Parquet (B8)."""
    ex = extract(pages, vocab, id_col=id_col, html_col=html_col, url_col=url_col, **kw)
    if ex["errors"] is not None and errors_path:
        ex["errors"].write.mode("overwrite").parquet(errors_path)
    cands = candidates(ex, id_col)
    more = [site_candidates(pages, id_col)]
    if rules is not None:
        more.append(landmark_candidates(pages, rules, suffixes, id_col, url_col, html_col))
    for part in more:
        if part is not None:
            cands = cands.unionByName(part, allowMissingColumns=True)
    if references is not None:
        from fieldloom.operators.canonical import canonicalize
        cands = canonicalize(cands, "value", references, field_col="field")
    return G.consolidate(cut_lineage(cands), normalize_config)


def consolidate_documents(pages: DataFrame, vocab: DataFrame, id_col: str = "page_id",
                          html_col: str = "html", url_col: str = "url", **kw) -> DataFrame:
    """Pages -> ``(id, url, fields)`` documents shaped for the search index; arguments as of
    ``consolidate_fields``."""
    fields = consolidate_fields(pages, vocab, id_col, html_col, url_col, **kw)
    docs = pages.select(F.col(id_col).alias("doc_id"), url_col)
    return G.assemble(fields, docs).withColumnRenamed("doc_id", id_col)


def field_summary(documents: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Flat per-document projection of the nested result (for checks)."""
    f = F.col("fields")
    return documents.select(
        id_col,
        F.size(f).cast("bigint").alias("n_fields"),
        F.get(f["title"]["strict"], 0)["name"].alias("title"),
        F.coalesce(F.size(f["description"]["strict"]), F.lit(0)).cast("bigint").alias("n_desc_strict"),
        F.coalesce(F.size(f["description"]["relaxed"]), F.lit(0)).cast("bigint").alias("n_desc_relaxed"),
        F.coalesce(F.size(f["phrase"]["strict"]), F.lit(0)).cast("bigint").alias("n_phrase_strict"),
        F.coalesce(F.size(f["phrase"]["relaxed"]), F.lit(0)).cast("bigint").alias("n_phrase_relaxed"),
        F.get(f["phrase"]["strict"], 0)["name"].alias("top_phrase"),
        F.coalesce(F.size(f["email"]["relaxed"]), F.lit(0)).cast("bigint").alias("n_email_relaxed"))


# --- extractor selection (B9) and table cells (X14, D3, F2) -----------------------

REGEX_EXTRACTORS = {
    "email": (mentions.EMAIL_PATTERN, 0),
    "phone": (mentions.PHONE_PATTERN, 0),
    "age": (mentions.AGE_PATTERN, 0),
    "name": (config.MY_NAME_IS_PATTERN, 1),
    "url": (mentions.URL_PATTERN, 0),
    "price": (mentions.PRICE_PATTERN, 0),
    "review-id": (mentions.REVIEW_ID_PATTERN, 1),
    "social-id": (mentions.SOCIAL_ID_PATTERN, 0),
    "address": (mentions.ADDRESS_PATTERN, 0),
    "posting-date": (mentions.POSTING_DATE_PATTERN, 0),
}


def select_regexes(names, available=None, log=print) -> dict:
    """The requested regex extractors as ``{name: (pattern, group)}``; an
    unknown name is reported and skipped, never fatal."""
    available = available or REGEX_EXTRACTORS
    out = {}
    for n in names:
        if n in available:
            out[n] = available[n]
        else:
            log(f"{n} - Not found")
    return out


def cell_mentions(pages: DataFrame, vocab: DataFrame, *, id_col: str = "page_id", html_col: str = "html",
                  field: str = "phrase", n: int = 3) -> DataFrame:
    """Vocabulary mentions inside table cells: the segment plan keyed by
    ``(id, table_ix, row_ix, cell_ix)``."""
    keys = [id_col, "table_ix", "row_ix", "cell_ix"]
    cells = content.extract_tables(pages, id_col, html_col)
    toks = cells.select(*keys, tokens.tokenize(F.col("text")).alias("tokens"))
    return mentions.dictionary_mentions(toks, keys, "tokens", vocab, field=field, n=n)
