"""Secret scan with multipart credential linking (operator 9, DataFrame functions only).

Strong patterns (``assign``, ``access``, ``hex``) are reported wherever they
match.  Weak ones (an account name, a long mixed token, an endpoint) are common
in clean text and are reported only as parts of one credential: a weak
identifier needs a secret in its scope, a weak secret an identifier, an
endpoint both.  The scope of a part is ``scope`` characters before and after it
in the same text.

The parts of a text are joined as intervals in one sorted pass: for every part,
running extremes give the nearest end before and the nearest start after it of
each role, so no pairs within a text are formed.

Offsets are code points, end exclusive.  They are sums of the lengths of the
pieces between matches, taken over exploded rows.  Texts without any pattern
(nearly all) are filtered first and only carry their id on.

Edge cases: null text is empty; rows that repeat an id and text have equal
spans; a null id is kept; several matches may begin at one place (ordered by
kind); other columns pass by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldloom.llm.common import free_names

# The three base patterns; kind -> (pattern, value group, least characters of the value).
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 20),
    "hex": (r"([0-9a-f]{24,})", 1, 24),
}
# Weak parts.  A token counts only if digits and letters of both cases mix in it.
WEAK = {
    "account": (r"""(?i:client_?id|access_?key_?id|user_?name|account|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""", 1, 3),
    "mixed": (r"((?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2})", 1, 32),
    "endpoint": (r"(?i:https?|jdbc:[a-z]+|redis|amqp|mongodb|postgres|mysql)(://[A-Za-z0-9._@:-]+)", 1, 4),
}
KINDS = [*BASE, *WEAK]
ROLE = {"assign": "secret", "hex": "secret", "mixed": "secret", "access": "id", "account": "id", "endpoint": "place"}
SCOPE = 200


def _matches(text: Column, kind: str) -> Column:
    """(kind, gap before, length, kept) of each leftmost non-overlapping match."""
    pattern, group, least = (BASE | WEAK)[kind]
    p = F.lit(pattern)
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, p, F.lit(group)).alias("value"))

    def row(m):
        ok = F.length(m["value"]) >= least
        if kind == "mixed":
            ok &= m["value"].rlike("[0-9]") & m["value"].rlike("[a-z]") & m["value"].rlike("[A-Z]")
        return F.struct(F.lit(kind).alias("kind"), F.length(m["gap"]).alias("gap"), F.length(m["all"]).alias("len"), ok.alias("ok"))
    return F.transform(F.filter(found, lambda m: m["all"].isNotNull()), row)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per reported span: ``doc_id``, ``text_hash`` (of the text it is in),
    ``kind``, ``start``, ``end``, ``base`` (a strong match)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    patterns = {k: p for k, (p, _, _) in (BASE | WEAK).items()}
    any_hit = F.lit(False)
    for p in patterns.values():
        any_hit = any_hit | F.col("text").rlike(p)
    hits = rows.where(any_hit).withColumn("text_hash", F.xxhash64("text"))
    arrays = [F.when(F.col("text").rlike(p), _matches(F.col("text"), k)).otherwise(_matches(F.lit(""), k)) for k, p in patterns.items()]
    # one generator per kind: positions count within a kind
    per_kind = hits.select("doc_id", "text_hash", F.explode(F.array(*arrays)).alias("m"))
    m = (per_kind.select("doc_id", "text_hash", F.posexplode("m").alias("at", "m")).select("doc_id", "text_hash", "at", "m.*").distinct())
    key = ["doc_id", "text_hash"]
    upto = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy(*key, "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    spans = (m.withColumn("end", upto.cast("long")).withColumn("start", F.col("end") - F.col("len")).where("ok")
             .withColumn("base", F.col("kind").isin(*BASE)).select(*key, "kind", "start", "end", "base"))
    return _linked(spans, key, scope)


def _linked(spans: DataFrame, key: list[str], scope: int) -> DataFrame:
    """Base spans, and weak ones whose complementary parts lie in scope."""
    order = F.lit(len(KINDS))
    role = F.lit(None)
    for i, k in enumerate(KINDS):
        order = F.when(F.col("kind") == k, i).otherwise(order)
        role = F.when(F.col("kind") == k, ROLE[k]).otherwise(role)
    spans = spans.withColumn("rank", order).withColumn("role", role)
    w = Window.partitionBy(*key).orderBy("start", "rank")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)

    def near(is_part: Column) -> Column:
        last = F.max(F.when(is_part, F.col("end"))).over(before)
        first = F.min(F.when(is_part, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= scope, F.lit(False)) | F.coalesce(first - F.col("end") <= scope, F.lit(False))
    strong = F.col("base")
    covered = (F.coalesce(F.max(F.when(strong, F.col("end"))).over(before) > F.col("start"), F.lit(False))
               | F.coalesce(F.min(F.when(strong, F.col("start"))).over(after) < F.col("end"), F.lit(False)))
    spans = spans.select("*", near(F.col("role") == "id").alias("by_id"), near(F.col("role") == "secret").alias("by_secret"),
                         covered.alias("covered"))
    linked = (F.when(F.col("role") == "id", F.col("by_secret")).when(F.col("role") == "secret", F.col("by_id"))
              .otherwise(F.col("by_id") & F.col("by_secret")))
    return spans.where(strong | (linked & ~F.col("covered"))).select(*key, "kind", "rank", "start", "end", "base")


def span_lists(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``(doc_id, text_hash, spans)``: per text with secrets, its spans ordered by
    start and kind, as an array of structs (bounded by the text)."""
    found = find_spans(docs, id_col, text_col, scope)
    return (found.groupBy("doc_id", "text_hash")
            .agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end", "base"))).alias("spans")))


def _with_lists(docs: DataFrame, columns: list[Column], id_col: str, text_col: str, scope: int) -> tuple[DataFrame, str]:
    """``columns`` of ``docs`` with the span list of each row, and the name of that column."""
    key, digest, spans, own_key, own_digest = free_names(docs, "__id", "__hash", "__spans", "__own", "__text")
    lists = span_lists(docs, id_col, text_col, scope).toDF(key, digest, spans)
    own = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return (docs.select(*columns, F.col(f"`{id_col}`").alias(own_key), own.alias(own_digest))
            .join(lists, F.col(own_key).eqNullSafe(F.col(key)) & (F.col(own_digest) == F.col(digest)), "left")), spans


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: ``doc_id``, the count of each base kind, and the base
    and all spans as ``kind:start:end`` lists."""
    out, name = _with_lists(docs, [F.col(f"`{id_col}`").alias("doc_id")], id_col, text_col, scope)
    spans = F.coalesce(F.col(name), F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean>>"))
    out = out.select("doc_id", spans.alias("s"))

    def count(kind: str) -> Column:
        return F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, BASE), _text(F.filter("s", lambda x: x["base"])).alias("base_spans"), _text(F.col("s")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mark``; spans
    that overlap or touch are replaced as one.  Other texts are unchanged."""
    text = F.col(f"`{text_col}`")
    out, spans = _with_lists(docs, [F.col(f"`{c}`") for c in docs.columns], id_col, text_col, scope)
    state_col, = free_names(out, "__state")
    begin = F.struct(F.array().cast("array<struct<a:bigint,z:bigint>>").alias("gaps"), F.lit(0).cast("long").alias("to"))
    # stretches of text between spans, in one pass over the ordered spans
    state = F.aggregate(spans, begin, lambda s, x: F.struct(
        F.when(x["start"] > s["to"], F.concat(s["gaps"], F.array(F.struct(s["to"].alias("a"), x["start"].alias("z")))))
        .when(F.size(s["gaps"]) == 0, F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("z"))))
        .otherwise(s["gaps"]).alias("gaps"),
        F.greatest(s["to"], x["end"]).alias("to")))
    out = out.withColumn(state_col, state)
    kept = F.transform(F.col(f"{state_col}.gaps"), lambda g: text.substr((g["a"] + 1).cast("int"), (g["z"] - g["a"]).cast("int")))
    rest = text.substr((F.col(f"{state_col}.to") + 1).cast("int"), F.length(text))
    new = F.concat(F.array_join(kept, mark), F.lit(mark), rest)
    return out.withColumn(text_col, F.when(F.col(spans).isNull(), text).otherwise(new)).select(*(F.col(f"`{c}`") for c in docs.columns))
