"""Mention extraction.

* ``dictionary_mentions``  X1-X6, X14, X16  token n-grams joined to a vocabulary
* ``regex_mentions``       X7-X10           all matches of a pattern with offsets
* ``height_weight``        X11              height/weight record from text
* ``split_height_weight``  X12              record -> height and weight mentions
* ``site_field_mentions``  X13              wrapper fields unpivoted to semantic fields

Every extractor returns rows of the same shape,
``(*keys, field, extractor, input_type, value, text, start, end)``, so the
plan unions whichever extractors are selected (B9/B10/X15): an extractor with
no result simply contributes no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions.text import col_of, memo_column
from fieldloom.operators.plumbing import bounded_broadcast

MARK = "\u0001"
PIECES = 256  # pieces of a text whose offsets are summed at a time; even, so that matches stay the odd ones


# --- X1: dictionary ---------------------------------------------------------

@memo_column
def ngrams(tokens, n: int) -> "F.Column":
    """``array<struct<start, k, text>>`` of every token n-gram up to ``n``
    tokens (joined with one space), computed inside the row.

    The k-gram array is the (k-1)-gram array zipped with the tokens shifted by
    k-1 (one linear pass per k), so no per-position slicing is needed."""
    t = col_of(tokens)
    size = F.size(t)
    arrays, g = [t], t
    for k in range(2, n + 1):
        g = F.zip_with(g, F.slice(t, k, F.greatest(size - k + 1, F.lit(1))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
        arrays.append(g)

    def tag(k):
        return lambda x, i: F.struct(i.alias("start"), F.lit(k).alias("k"), x.alias("text"))
    parts = [F.transform(a, tag(k)) for k, a in enumerate(arrays, start=1)]
    return F.filter(F.concat(*parts), lambda s: s["text"].isNotNull())


def token_places(df: DataFrame, key_cols, tokens_col: str, n: int, context: int = 0) -> DataFrame:
    """``(*keys, start, t0 .. t<n+context-1>, b1 .. b<context>)``: a row per token, with those that
    follow it and the ``context`` ones before it (null beyond the ends).  Shifted arrays are
    zipped, so there is one linear pass."""
    t = F.col(tokens_col)
    after = [t.alias("t0")] + [F.slice(t, k + 1, F.greatest(F.size(t) - k, F.lit(0))).alias(f"t{k}") for k in range(1, n + context)]
    before = [F.concat(F.array_repeat(F.lit(None).cast("string"), k), F.slice(t, 1, F.greatest(F.size(t) - k, F.lit(0)))).alias(f"b{k}") for k in range(1, context + 1)]
    names = [f"t{k}" for k in range(n + context)] + [f"b{k}" for k in range(1, context + 1)]
    zipped = F.arrays_zip(*after, *before)
    return (df.select(*key_cols, F.posexplode(zipped).alias("start", "__p"))
            .select(*key_cols, "start", *(F.col(f"__p.{c}").alias(c) for c in names)).where(F.col("t0").isNotNull()))


def vocabularies(tables: dict) -> DataFrame:
    """One vocabulary ``(field, entry, n, ...)`` from ``{field: (table with entry, n)}``; columns
    that only some of the tables have are null in the others."""
    out = None
    for field, (table, n) in tables.items():
        part = table.withColumn("field", F.lit(field)).withColumn("n", F.lit(n))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def vocabulary(spark, entries) -> DataFrame:
    """Vocabulary table ``(entry)`` from a Python list (lower-cased)."""
    rows = [(e.lower(),) for e in entries]
    return spark.createDataFrame(rows, "entry string").distinct()


def dictionary_mentions(df: DataFrame, key_cols, tokens_col: str, vocab: DataFrame, *, field: str,
                        n: int = 1, extractor: str | None = None, prefilter: str | None = config.DICTIONARY_PREFILTER,
                        context: int = 0, max_broadcast_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Exact vocabulary lookup of token n-grams.

    Each n-gram (1..n tokens, joined by one space) is lower-cased, must pass
    ``prefilter`` (anchored at the start, applied after lower-casing), and is
    kept when it equals a vocabulary ``entry``.  The context is the token span
    ``[start, end)``.  The vocabulary is broadcast when within
    ``max_broadcast_rows`` rows; otherwise a shuffled join is used.  Extra
    vocabulary columns (e.g. ``canonical``, ``weight``) are carried along.

    A vocabulary with a ``field`` column holds the entries of several fields, looked
    up in one pass over the tokens; with an ``n`` column (at most the given ``n``) an entry is found among
    n-grams of up to that many tokens only.

    With ``context`` > 0 each mention gets ``context``: the lower-cased tokens up to
    that many places before and after it, itself included.  Every place carries just the
    tokens that it may need, never its row's token array.

    An n-gram is put together only where a token's first word is that of an entry.
    """
    key_cols = list(key_cols)
    vocab = vocab.withColumnRenamed("entry", "value")
    if prefilter:
        vocab = vocab.where(F.col("value").rlike(prefilter))  # an n-gram found equals its entry
    places = token_places(df, key_cols, tokens_col, n, context)
    word = lambda c: F.substring_index(c, " ", 1)
    if n > 1:  # only a place whose first word begins an entry can begin a mention
        firsts = bounded_broadcast(vocab.select(word(F.col("value")).alias("__w")), max_broadcast_rows)
        places = places.withColumn("__w", word(F.lower("t0"))).join(firsts, "__w", "left_semi").drop("__w")
    around = [f"b{i}" for i in range(context, 0, -1)] + [f"t{i}" for i in range(n + context)] if context else []
    grams, gram = [], F.col("t0")
    for k in range(1, n + 1):
        gram = gram if k == 1 else F.concat(gram, F.lit(" "), F.col(f"t{k - 1}"))
        grams.append(F.struct(F.lit(k).alias("k"), gram.alias("text")))
    g = (places.select(*key_cols, *around, "start", F.explode(F.array(*grams)).alias("g"))
         .select(*key_cols, *around, "start", (F.col("start") + F.col("g.k")).alias("end"),
                 F.col("g.k").alias("__k"), F.col("g.text").alias("text"), F.lower(F.col("g.text")).alias("value")))
    v = bounded_broadcast(vocab, max_broadcast_rows)
    own_field = "field" in v.columns
    v = v.withColumnRenamed("field", "__field").withColumnRenamed("n", "__n")
    out = g.join(v, "value", "inner")
    if "__n" in v.columns:
        out = out.where(F.col("__k") <= F.col("__n"))
    extra = [c for c in v.columns if c not in ("value", "__field", "__n")]
    name = F.col("__field") if own_field else F.lit(field)
    if context:
        cells = F.array(*(F.lower(c) for c in around))
        out = out.withColumn("context", F.array_compact(F.slice(cells, 1, 2 * context + F.col("__k"))))
        extra.append("context")
    return out.select(*key_cols, name.alias("field"),
                      (F.lit(extractor) if extractor else F.concat(name, F.lit("_dictionary"))).alias("extractor"),
                      F.lit("tokens").alias("input_type"), "value", "text",
                      F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), *extra)


# --- X7: regex ---------------------------------------------------------------

def regex_mentions(df: DataFrame, key_cols, text_col: str, pattern: str, *, field: str, group: int = 0,
                   extractor: str | None = None) -> DataFrame:
    """Regex extractor over text with context (X7): every non-empty match with
    character offsets.  ``value`` is the match, or its capture ``group`` when
    ``group > 0`` (taken where it matched, so anchors and lookaround hold).

    Matches are marked with a control character and the text is split on it: odd pieces
    are the matches.  Offsets are running sums of piece lengths, first within blocks of
    ``PIECES`` pieces, then over the blocks, so the cost is linear in the matches of a text;
    the blocks are rows of their own, so no large array is copied per match.
    Offsets refer to the text with any pre-existing marker characters removed."""
    keys = [F.col(f"`{c}`") for c in key_cols]

    def running(values):
        return F.aggregate(values, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
    marked = (df.select(*keys, F.regexp_replace(F.col(text_col), MARK, "").alias("__t"))
              .withColumn("__p", F.split(F.regexp_replace("__t", pattern, MARK + "$0" + MARK), MARK, -1))
              .where(F.size("__p") > 1))
    groups = F.regexp_extract_all("__t", F.lit(pattern), F.lit(group)) if group else F.lit(None).cast("array<string>")
    marked = marked.withColumn("__v", groups)
    last = F.floor((F.size("__p") - 1) / PIECES).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(
        F.slice("__p", b * PIECES + 1, F.lit(PIECES)).alias("p"), F.slice("__v", b * (PIECES // 2) + 1, F.lit(PIECES // 2)).alias("v")))
    rows = marked.select(*keys, blocks.alias("__blocks")).withColumn(
        "__o", running(F.transform("__blocks", lambda b: F.aggregate(b["p"], F.lit(0), lambda acc, p: acc + F.length(p)))))
    rows = (rows.select(*keys, F.posexplode(F.arrays_zip(F.col("__blocks").alias("b"), F.slice("__o", 1, F.size("__blocks")).alias("o"))).alias("__b", "__z"))
            .select(*keys, "__b", F.col("__z.b.p").alias("__p"), F.col("__z.b.v").alias("__v"), F.col("__z.o").alias("__base"))
            .withColumn("__i", running(F.transform("__p", lambda p: F.length(p)))))
    found = F.filter(F.transform("__p", lambda p, i: F.struct(
        p.alias("match"), (F.get("__i", i) + F.col("__base")).alias("start"), ((i - 1) / 2).cast("int").alias("j"), i.alias("i"))),
        lambda z: (z["i"] % 2 == 1) & (F.length(z["match"]) > 0))
    value = (lambda z: F.get("__v", z["j"])) if group else (lambda z: z["match"])
    found = F.transform(found, lambda z: F.struct(z["match"].alias("match"), z["start"].alias("start"), z["j"].alias("j"), value(z).alias("value")))
    m = rows.select(*keys, "__b", F.explode(found).alias("m"))
    return m.select(*keys, F.lit(field).alias("field"), F.lit(extractor or f"{field}_regex").alias("extractor"),
                    F.lit("text").alias("input_type"), F.col("m.value").alias("value"), F.col("m.match").alias("text"),
                    F.col("m.start").alias("start"), (F.col("m.start") + F.length("m.match")).alias("end"),
                    (F.col("__b") * (PIECES // 2) + F.col("m.j")).alias("match_ix"))


# Extractor patterns (our definitions; the originals live outside the source).
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"(?:\+?1[ .-]?)?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}"
AGE_PATTERN = r"(?i)\b(?:age|aged)[ :]+[1-9][0-9]\b|\b[1-9][0-9] ?(?:yo|y/o|yrs|years old)\b"

URL_PATTERN = r"(?i)\bhttps?://[^\s<>\"']+[^\s<>\"'.,;:!?)]"
PRICE_PATTERN = r"[$€£] ?[0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{2})?|\b[0-9]+(?:\.[0-9]{2})? ?(?:USD|EUR|GBP)\b"
REVIEW_ID_PATTERN = r"(?i)\breview(?: id| no\.?| #|#)[ :]*([A-Z0-9-]*[0-9][A-Z0-9-]*)"
SOCIAL_ID_PATTERN = r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{2,30}\b(?!@)"
ADDRESS_PATTERN = r"(?i)\b[0-9]{1,5} (?:[A-Za-z]+ ){1,3}(?:street|st|avenue|ave|road|rd|lane|ln|drive|dr|boulevard|blvd)\b"
POSTING_DATE_PATTERN = (r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b|\b[0-9]{2}/[0-9]{2}/[0-9]{4}\b|"
                        r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2}, [0-9]{4}\b")


def phone_digits(value) -> "F.Column":
    """Canonical phone: digits only."""
    return F.regexp_replace(col_of(value), "[^0-9]", "")


# --- X11, X12: height / weight ----------------------------------------------

FOOT_PATTERN = r"\b([3-7])'[ ]?([0-9]{1,2})?\"?"
CM_PATTERN = r"(?i)\b([12][0-9]{2}) ?cm\b"
LB_PATTERN = r"(?i)\b([0-9]{2,3}) ?(?:lbs|lb|pounds|pound)\b"
KG_PATTERN = r"(?i)\b([0-9]{2,3}) ?(?:kgs|kg|kilograms|kilogram|kilos|kilo)\b"

HW_TYPE = ("struct<height:struct<foot:array<string>,raw:array<struct<foot:int,inch:int>>,centimeter:array<int>>,"
           "weight:struct<pound:array<int>,kilogram:array<int>>>")


@memo_column
def height_weight(text) -> "F.Column":
    """Height/weight record of a text: feet-inch marks and ``N cm`` give
    ``height.centimeter`` (rounded), ``N lb`` and ``N kg`` give
    ``weight.kilogram`` (pounds / 2.20462, rounded).  Empty parts are null."""
    t = col_of(text)
    feet = F.regexp_extract_all(t, F.lit(FOOT_PATTERN), 0)
    raw = F.transform(feet, lambda m: F.struct(
        F.regexp_extract(m, FOOT_PATTERN, 1).cast("int").alias("foot"),
        F.coalesce(F.regexp_extract(m, FOOT_PATTERN, 2).try_cast("int"), F.lit(0)).alias("inch")))
    cm_from_feet = F.transform(raw, lambda r: F.round(r["foot"] * config.CM_PER_FT + r["inch"] * config.CM_PER_IN)
                               .cast("int"))
    cm_plain = F.transform(F.regexp_extract_all(t, F.lit(CM_PATTERN), 1), lambda x: x.cast("int"))
    centimeter = F.concat(cm_from_feet, cm_plain)
    pounds = F.transform(F.regexp_extract_all(t, F.lit(LB_PATTERN), 1), lambda x: x.cast("int"))
    kg_plain = F.transform(F.regexp_extract_all(t, F.lit(KG_PATTERN), 1), lambda x: x.cast("int"))
    kilogram = F.concat(F.transform(pounds, lambda p: F.round(p / config.KG_PER_LB).cast("int")), kg_plain)
    height = F.when(F.size(centimeter) > 0, F.struct(feet.alias("foot"), raw.alias("raw"),
                                                     centimeter.alias("centimeter")))
    weight = F.when(F.size(kilogram) > 0, F.struct(pounds.alias("pound"), kilogram.alias("kilogram")))
    return F.struct(height.alias("height"), weight.alias("weight"))


def split_height_weight(df: DataFrame, key_cols, record_col: str = "hw") -> DataFrame:
    """One ``height`` mention and one ``weight`` mention per record part that
    is present; a record with neither part is skipped (later records are
    still processed).  Values are lists: ``centimeter`` / ``kilogram``."""
    key_cols = list(key_cols)
    h = df.where(F.col(f"{record_col}.height").isNotNull()).select(
        *key_cols, F.lit("height").alias("field"), F.col(f"{record_col}.height.centimeter").alias("centimeter"),
        F.lit(None).cast("array<int>").alias("kilogram"))
    w = df.where(F.col(f"{record_col}.weight").isNotNull()).select(
        *key_cols, F.lit("weight").alias("field"), F.lit(None).cast("array<int>").alias("centimeter"),
        F.col(f"{record_col}.weight.kilogram").alias("kilogram"))
    return h.unionByName(w)


# --- X13: site fields --------------------------------------------------------

def site_field_map(spark, mapping=None) -> DataFrame:
    """``(source, field)`` from the site-field configuration."""
    mapping = mapping or config.SITE_FIELD_SOURCES
    rows = [(src, field) for field, sources in mapping.items() for src in sources]
    return spark.createDataFrame(rows, "source string, field string")


def site_field_mentions(df: DataFrame, key_cols, mapping=None, with_index: bool = False,
                        max_broadcast_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Unpivot the wrapper (site) columns present in ``df`` and map them to
    semantic fields: ``(*keys, field, source, value)``.  ``mapping`` is
    ``{field: [source column, ...]}`` (default: the site-field configuration).
    Array-valued site columns contribute one row per element; nulls and empty
    strings none.  One source may feed several fields and one field may have
    several sources.  ``with_index`` adds ``ix``, the element's position in
    its source array."""
    key_cols = list(key_cols)
    mapping = mapping or config.SITE_FIELD_SOURCES
    fm = site_field_map(df.sparkSession, mapping)
    sources = {src for srcs in mapping.values() for src in srcs}
    present = [c for c in df.columns if c in sources]
    if not present:
        schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in key_cols] +
                           ["field string", "source string", "value string"])
        return df.sparkSession.createDataFrame([], schema)
    pairs = []
    for c in present:
        ref = F.col(f"`{c}`")
        values = (F.transform(ref, lambda e: e.cast("string"))
                  if df.schema[c].dataType.simpleString().startswith("array") else F.array(ref.cast("string")))
        pairs.append(F.struct(F.lit(c).alias("s"), values.alias("v")))
    unp = df.select(*key_cols, F.explode(F.array(*pairs)).alias("z"))
    long = (unp.select(*key_cols, F.col("z.s").alias("source"), F.posexplode("z.v").alias("ix", "value"))
            .where(F.col("value").isNotNull() & (F.col("value") != "")))
    return long.join(bounded_broadcast(fm, max_broadcast_rows), "source", "inner").select(
        *key_cols, "field", "source", "value", *(["ix"] if with_index else []))


def map_sources(values: DataFrame, key_cols, mapping=None, max_broadcast_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Values that are rows already, ``(*keys, source, ix, value)`` (such as what landmark
    rules find), mapped to semantic fields like site columns; nulls and empty strings give none."""
    fm = bounded_broadcast(site_field_map(values.sparkSession, mapping), max_broadcast_rows)
    return (values.where(F.col("value").isNotNull() & (F.col("value") != "")).join(fm, "source", "inner")
            .select(*key_cols, "field", "source", "value", "ix"))


# --- U1, B8: user extractors ---------------------------------------------------

def hook_mentions(df: DataFrame, key_cols, text_col: str, function, *, field: str, extractor: str | None = None):
    """A user's extractor ``function(text) -> list of strings`` (or None, or one string):
    ``(mentions, errors)``.

    Failures are isolated by row: a text for which the function raises gives no mention and one
    row ``(*keys, extractor, error)``; every other text is untouched.  A null text is not
    passed on.  The function runs in Python over Arrow batches, once: its result is
    checkpointed for the two readers."""
    from fieldloom.session import cut_lineage
    extractor = extractor or f"{field}_hook"
    keys = [F.col(f"`{c}`") for c in key_cols]
    rows = df.select(*keys, F.col(text_col).cast("string").alias("__text"))
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1]) + "__r struct<found: array<string>, error: string>"

    def run(batches):
        import pyarrow as pa
        kind = pa.struct([("found", pa.list_(pa.string())), ("error", pa.string())])
        for batch in batches:
            results = []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                got, error = None, None
                if t is not None:
                    try:
                        got = function(t)
                        got = [got] if isinstance(got, str) else None if got is None else [None if x is None else str(x) for x in got]
                    except Exception as e:  # noqa: BLE001 - isolated by design
                        got, error = None, f"{type(e).__name__}: {e}"
                results.append({"found": got, "error": error})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(results, kind)], names=[*batch.schema.names[:-1], "__r"])

    done = cut_lineage(rows.mapInArrow(run, ddl))
    out = (done.select(*keys, F.posexplode("__r.found").alias("match_ix", "value")).where(F.col("value").isNotNull() & (F.col("value") != ""))
           .select(*keys, F.lit(field).alias("field"), F.lit(extractor).alias("extractor"), F.lit("text").alias("input_type"), "value",
                   F.col("value").alias("text"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), "match_ix"))
    errors = done.where(F.col("__r.error").isNotNull()).select(*keys, F.lit(extractor).alias("extractor"), F.col("__r.error").alias("error"))
    return out, errors
