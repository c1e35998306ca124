"""Registered queries: each reproduces one operator family of the source on
the driver tables.  Every callable takes ``(spark, sf_dir)`` and returns a
DataFrame whose columns are aliased exactly as in the matching SQL oracle
(``fieldloom.plans.oracle``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import content, mentions, tokens
from fieldloom.operators.plumbing import add_registered_domain, host_of
from fieldloom.plans import tables as T

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- pages: content (C1-C5, B3) ---------------------------------------------

@query
def title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = T.load(spark, sf_dir, "pages")
    return (pages.select("page_id", content.extract_title(F.col("html")).alias("title"))
            .where(F.col("title") != ""))


@query
def registered_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = T.load(spark, sf_dir, "pages").select("page_id", "url")
    return add_registered_domain(pages, T.suffixes(spark)).select("page_id", host_of(F.col("url")).alias("host"), "tld")


def _blocks(spark, sf_dir) -> DataFrame:
    pages = T.load(spark, sf_dir, "pages")
    with_blocks = pages.select("page_id", host_of(F.col("url")).alias("host"),
                               content.html_blocks("html").alias("blocks"))
    return content.explode_blocks(with_blocks, "page_id", keep=("host",))


@query
def content_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocks(spark, sf_dir).select("page_id", "block_ix", "text", "n_chars", "link_chars")


@query
def content_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.strict_blocks(_blocks(spark, sf_dir), "page_id", "host").select("page_id", "block_ix", "text")


@query
def list_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.extract_lists(T.load(spark, sf_dir, "pages"), "page_id", "html")


def order_tables_html(orders: DataFrame) -> DataFrame:
    """One small HTML table per order (header row + two value rows)."""
    html = F.concat(
        F.lit('<table class="order"><tr><th>Key</th><th>Customer</th><th>Status &amp; Priority</th></tr><tr><td>'),
        F.col("o_orderkey").cast("string"), F.lit("</td><td>"), F.col("o_custkey").cast("string"),
        F.lit("</td><td>"), F.col("o_orderstatus"), F.lit(" &amp; "), F.col("o_orderpriority"),
        F.lit("</td></tr>\n<tr><td colspan=2>"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("</td><th>date</th></tr></table>"))
    return orders.select("o_orderkey", html.alias("html"))


@query
def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.extract_tables(order_tables_html(T.dealt(T.load(spark, sf_dir, "orders"))), "o_orderkey", "html")


@query
def nested_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table inside a cell, and rows and cells without closing tags."""
    html = F.concat(F.lit("<table><tr><td>K"), F.col("o_orderkey").cast("string"), F.lit("<TABLE class=x><tr><td>in "), F.col("o_orderstatus"),
                    F.lit("<tr><td>second</table></td><th>after<tr><td>last "), F.col("o_orderpriority"), F.lit("</table>"))
    return content.extract_tables(T.dealt(T.load(spark, sf_dir, "orders")).select("o_orderkey", html.alias("html")), "o_orderkey")


@query
def landmark_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = T.load(spark, sf_dir, "pages")
    return content.landmark_values(pages, T.landmark_rules(spark), "page_id", T.suffixes(spark)).drop("rule_ix")


# --- documents: tokens and mentions (D1-D3, X1-X10) ---------------------------

def _doc_tokens(spark, sf_dir) -> DataFrame:
    return T.load(spark, sf_dir, "documents").select("doc_id", tokens.tokenize(F.col("text")).alias("tokens"))


@query
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _doc_tokens(spark, sf_dir).select("doc_id", tokens.token_stats("tokens").alias("s"))
    return s.select("doc_id", "s.n_tokens", "s.n_breaks", "s.token_chars")


@query
def dictionary_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mentions.dictionary_mentions(_doc_tokens(spark, sf_dir), ["doc_id"], "tokens", T.word_vocab(spark),
                                     field="word", n=1)
    return m.select("doc_id", "start", "end", "value")


@query
def dictionary_ngrams3(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mentions.dictionary_mentions(_doc_tokens(spark, sf_dir), ["doc_id"], "tokens",
                                     T.phrase_vocab(spark).select("entry"), field="phrase", n=3)
    return m.select("doc_id", "start", "end", "value")


@query
def regex_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.load(spark, sf_dir, "documents")
    m = mentions.regex_mentions(docs, ["doc_id"], "text", mentions.EMAIL_PATTERN, field="email")
    return m.select("doc_id", F.col("match_ix").cast("bigint").alias("match_ix"),
                    F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "value")


@query
def regex_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.load(spark, sf_dir, "documents")
    m = mentions.regex_mentions(docs, ["doc_id"], "text", mentions.PHONE_PATTERN, field="phone")
    return m.select("doc_id", F.col("match_ix").cast("bigint").alias("match_ix"),
                    F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "value",
                    mentions.phone_digits("value").alias("digits"))


@query
def name_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured group of every match."""
    from fieldloom.plans.pipeline import select_regexes
    text = F.concat(F.lit("Hello. My  name IS "), F.col("c_mktsegment"), F.lit("-"), F.col("c_custkey").cast("string"),
                    F.lit(" and my name is x"), F.col("c_nationkey").cast("string"), F.lit("!"))
    rows = T.load(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    pattern, group = select_regexes(["name"])["name"]
    m = mentions.regex_mentions(rows, ["c_custkey"], "text", pattern, field="name", group=group)
    return m.select("c_custkey", F.col("match_ix").cast("bigint").alias("match_ix"), "value")


@query
def odd_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of URLs with underscores, users, ports, spaces and bars."""
    k = F.col("page_id") % 5
    rest = F.regexp_replace("url", "^[a-z]+://", "")
    url = (F.when(k == 0, F.concat(F.lit("http://my_site."), rest)).when(k == 1, F.concat(F.lit("HTTPS://User:pw@"), rest, F.lit(" x|y")))
           .when(k == 2, F.concat(F.lit("http://"), F.regexp_extract(rest, "^[^/]+", 0), F.lit(":8080/a b"))).when(k == 3, F.col("url"))
           .otherwise(rest))
    return T.load(spark, sf_dir, "pages").select("page_id", host_of(url).alias("host"))


@query
def regex_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey") % 120
    text = F.concat(F.lit("Aged: "), n.cast("string"), F.lit(" or "), (n + 3).cast("string"),
                    F.when(n % 2 == 0, " yo, page 44 years old").otherwise("yrs and age 77x"))
    rows = T.load(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    m = mentions.regex_mentions(rows, ["c_custkey"], "text", mentions.AGE_PATTERN, field="age")
    return m.select("c_custkey", F.col("match_ix").cast("bigint").alias("match_ix"), "value")


@query
def blank_and_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import plumbing as B
    c = T.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("_id"), F.col("c_name").alias("crawl_data"))
    return B.rename_if_present(B.blank_columns(c, keep_placeholder=True))


@query
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text is no JSON go to the quarantine side."""
    from fieldloom.operators import plumbing as B
    props = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), F.col("props"))).otherwise(F.col("props"))
    ev = T.load(spark, sf_dir, "events").select("event_id", props.alias("props"))
    good, bad = B.parse_json_column(ev, "props", "k int", "parsed", quarantine=True)
    return (good.select("event_id", F.col("parsed.k").alias("k"), F.lit("good").alias("side"))
            .union(bad.select("event_id", F.lit(None).cast("int"), F.lit("bad"))))


# --- site fields (X13) -------------------------------------------------------

def site_pages(spark, sf_dir) -> DataFrame:
    """Customers and suppliers shaped as wrapper-extracted pages."""
    c = T.load(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("doc_id"),
        F.col("c_name").alias("inferlink_name"),
        F.format_string("%.2f", "c_acctbal").alias("inferlink_price"),
        F.col("c_nationkey").cast("string").alias("inferlink_country"),
        F.concat(F.lit("+1 (555) 01"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")).alias("inferlink_phone"),
        (F.col("c_custkey") % 50 + 10).cast("string").alias("inferlink_age-1"),
        F.lit(None).cast("string").alias("inferlink_state"))
    s = T.load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("doc_id"),
        F.col("s_name").alias("inferlink_name"),
        F.format_string("%.2f", "s_acctbal").alias("inferlink_price"),
        F.lit(None).cast("string").alias("inferlink_country"),
        F.lit(None).cast("string").alias("inferlink_phone"),
        F.lit(None).cast("string").alias("inferlink_age-1"),
        F.col("s_nationkey").cast("string").alias("inferlink_state"))
    return c.unionByName(s)


@query
def merge_site_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.site_field_mentions(site_pages(spark, sf_dir), ["doc_id"])


# --- consolidation on events as candidates (G2-G13) ---------------------------

def event_candidates(spark, sf_dir) -> DataFrame:
    """Events shaped as candidates: ``user_id`` is the document, the event type
    picks the field, ``props.k`` picks tier and pass, ``value / 500`` is the
    span probability and ``event_id`` the arrival position."""
    ev = T.load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    field = (F.when(F.col("event_type") == "view", "age").when(F.col("event_type") == "click", "weight")
             .when(F.col("event_type") == "purchase", "name").when(F.col("event_type") == "signup", "title")
             .otherwise("price"))
    c = ev.select(F.col("user_id").alias("doc_id"), field.alias("field"), k.alias("k"),
                  F.col("event_id").alias("pos"), F.col("value").alias("amount"))
    tier = F.when(F.col("k") % 3 == 0, "relaxed").otherwise("strict")
    span = F.col("k") % 2 == 0
    pass_no = (F.when(tier == "strict", F.when(span, 1).otherwise(2))
               .otherwise(F.when(span, 6).otherwise(7)))
    probability = F.when(span, F.col("amount") / 500.0)
    kk = F.col("k")
    value = (F.when(F.col("field") == "age",
                    F.when(kk % 5 == 0, F.concat(kk.cast("string"), F.lit("-"), (kk + 5).cast("string")))
                    .otherwise(kk.cast("string")))
             .when(F.col("field") == "weight",
                   F.concat(F.floor("amount").cast("string"),
                            F.when(kk % 4 == 0, " lbs").when(kk % 4 == 1, "kg").when(kk % 4 == 2, "").otherwise(" kilos")))
             .when(F.col("field") == "name",
                   F.concat(F.when(kk % 3 == 0, "mary-jane").when(kk % 3 == 1, "o'neil").otherwise("ann  lee"),
                            F.lit(" "), (kk % 4).cast("string")))
             .when(F.col("field") == "title", F.concat(F.lit("Title "), (kk % 5).cast("string")))
             .otherwise(kk.cast("string")))
    return c.select("doc_id", "field", tier.alias("tier"), pass_no.alias("pass_no"), "pos",
                    probability.alias("probability"),
                    F.when(span, -F.col("amount") / 500.0).otherwise(F.lit(0.0)).alias("rank"),
                    F.when(kk >= 95, F.lit(True)).alias("selected"), value.alias("value"))


@query
def route_strict_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import consolidate as G
    routed = G.route(G.with_optional_columns(event_candidates(spark, sf_dir)))
    return routed.select(F.col("pos").alias("event_id"), "doc_id", "field", "routed_tier")


@query
def dedupe_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import consolidate as G
    fields = G.consolidate(event_candidates(spark, sf_dir))
    return (fields.groupBy("doc_id", "field", "tier")
            .agg(F.count("*").alias("n_values"), F.count_distinct("name").alias("n_names")))


@query
def consolidate_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import consolidate as G
    return G.consolidate(event_candidates(spark, sf_dir))


@query
def equal_seq_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an unconfigured field are never merged, even where all they have is equal."""
    from fieldloom.operators import consolidate as G
    rows = T.load(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), F.lit("price").alias("field"), F.lit("strict").alias("tier"), F.lit(2).alias("pass_no"),
        F.lit(0.0).alias("rank"), F.lit(0).cast("bigint").alias("pos"), F.lit("9").alias("value"))
    return G.consolidate(rows).groupBy("doc_id", "tier").agg(F.count("*").alias("n_values"))


# --- normalisers on strings built from lineitem / part / customer (H1-H19) ---

def _li(spark, sf_dir) -> DataFrame:
    li = T.load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.floor("l_quantity").cast("int").alias("q"))


def _with_fv(df: DataFrame, function: str, keep, **inputs) -> DataFrame:
    """Run a normaliser in frame mode and unpack the FV struct."""
    from fieldloom.functions import normalize as N
    out = N.apply(df, function, "fv", **inputs)
    return out.select(*keep, "fv.key", "fv.name", "fv.num", "fv.search")


def age_text(q, ln) -> "F.Column":
    return (F.when(ln % 4 == 0, (q + 10).cast("string"))
            .when(ln % 4 == 1, F.concat((q + 10).cast("string"), F.lit("-"), (q + 15).cast("string")))
            .when(ln % 4 == 2, F.concat(F.lit(" "), (q + 5).cast("string"), F.lit(" yo")))
            .otherwise(F.concat(q.cast("string"), F.lit(".5"))))


def height_text(q, ln) -> "F.Column":
    f = (F.lit(4) + q % 4).cast("string")
    i = (ln + q % 5).cast("string")
    i2 = (ln + q % 5 + 1).cast("string")
    return (F.when(ln % 5 == 0, F.concat(f, F.lit("'"), i, F.lit('"')))
            .when(ln % 5 == 1, F.concat(f, F.lit("'"), i, F.lit('" - '), f, F.lit("'"), i2, F.lit('"')))
            .when(ln % 5 == 2, F.concat(f, F.lit("'")))
            .when(ln % 5 == 3, F.concat((q + 120).cast("string"), F.lit(" cm")))
            .otherwise(F.concat(f, F.lit("' "), i)))


def weight_text(q, ln) -> "F.Column":
    return (F.when(ln % 7 == 0, F.concat((q * 4).cast("string"), F.lit(" lbs")))
            .when(ln % 7 == 1, F.concat((q + 30).cast("string"), F.lit("kg")))
            .when(ln % 7 == 2, F.concat((q + 30).cast("string"), F.lit(" kilos")))
            .when(ln % 7 == 3, (q * 4).cast("string"))
            .when(ln % 7 == 4, F.concat((q + 40).cast("string"), F.lit("."), ln.cast("string")))
            .when(ln % 7 == 5, F.concat((q % 12).cast("string"), F.lit(" stone")))
            .otherwise(F.concat((q * 3).cast("string"), F.lit(" pounds"))))


@query
def normalize_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _li(spark, sf_dir).withColumn("raw", age_text(F.col("q"), F.col("l_linenumber")))
    return _with_fv(li, "clean_age", ["l_orderkey", "l_linenumber", "raw"], value="raw")


@query
def normalize_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _li(spark, sf_dir).withColumn("raw", height_text(F.col("q"), F.col("l_linenumber")))
    return _with_fv(li, "clean_height", ["l_orderkey", "l_linenumber", "raw"], value="raw")


@query
def normalize_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _li(spark, sf_dir).withColumn("raw", weight_text(F.col("q"), F.col("l_linenumber")))
    return _with_fv(li, "clean_weight", ["l_orderkey", "l_linenumber", "raw"], value="raw")


@query
def letters_and_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.functions import normalize as N
    text = F.concat("p_brand", F.lit(" / "), "p_type", F.lit(" é "), F.col("p_size").cast("string"))
    return T.load(spark, sf_dir, "part").select("p_partkey", N.alpha_only(text).alias("letters"), N.numeric_only(text).alias("digits"))


@query
def measure_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first element in range of a list."""
    from fieldloom.functions import normalize as N
    q = F.col("q")
    li = _li(spark, sf_dir).select("l_orderkey", "l_linenumber", F.array(q * 10, q * 7, q * 3).alias("cm"),
                                   F.array(*((q * k).cast("double") for k in (5, 3, 1))).alias("kg"))
    out = N.apply(li, "clean_height", "h", centimeter="cm")
    out = N.apply(out, "clean_weight", "w", kilogram="kg")
    return out.select("l_orderkey", "l_linenumber", F.col("h.num").alias("cm"), F.col("w.num").alias("kg"))


@query
def normalize_custom_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's configuration: own ranges, a data type that does not fit, a user function."""
    from fieldloom.functions import normalize as N
    conf = {"age": {"data_type": "int", "range": (1, 30), "function": "clean_age"},
            "years": {"data_type": "int", "range": (10, 99), "function": "clean_age"},
            "label": {"data_type": "string", "range": (1, 99), "function": "clean_age"},
            "code": {"data_type": "string", "function": lambda v: F.when(v != "7", F.concat(F.lit("q"), v))}}
    field = F.element_at(F.array(*map(F.lit, conf)), (F.col("l_linenumber") % 4 + 1).cast("int"))
    li = _li(spark, sf_dir).select("l_orderkey", "l_linenumber", field.alias("field"), F.col("q").cast("string").alias("value"))
    out = N.normalize_frame(li, "field", "fv", normalize_config=conf, value="value")
    return out.select("l_orderkey", "l_linenumber", "field", F.col("fv.name").alias("name"))


@query
def normalize_weight_stone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stones read as 14 pounds, by the opt-in flag."""
    from fieldloom.functions import normalize as N
    q, ln = F.col("q") % 15, F.col("l_linenumber")
    text = F.concat(q.cast("string"), F.when(ln % 2 == 0, " stone ").otherwise("st "), ln.cast("string"), F.when(ln % 3 == 0, "lbs").otherwise("lb"))
    li = _li(spark, sf_dir).select("l_orderkey", "l_linenumber", text.alias("value"))
    out = N.apply(li, "clean_weight", "fv", conf={"data_type": "number", "range": (40, 150), "fix_stone": True}, value="value")
    return out.select("l_orderkey", "l_linenumber", "value", F.round("fv.num", 6).alias("kg"))


@query
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.load(spark, sf_dir, "part")
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_name"), F.lit("  "), F.lower("p_type")))
    raw = raw.otherwise(F.concat(F.lit("o'"), F.col("p_name"), F.lit("-"), F.lower("p_brand"), F.lit("\t3cd")))
    out = _with_fv(p.select("p_partkey", raw.alias("raw")), "clean_name", ["p_partkey", "raw"], value="raw")
    return out.select("p_partkey", "raw", "key", "name")


@query
def normalize_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators.plumbing import bounded_broadcast
    c = T.load(spark, sf_dir, "customer")
    geo = (T.load(spark, sf_dir, "nation")
           .join(T.load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    j = c.join(bounded_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    city = j.select("c_custkey", F.lower("n_name").alias("v"),
                    F.when(F.col("c_custkey") % 4 != 0, F.col("r_name")).alias("st"), F.col("c_mktsegment").alias("co"),
                    (F.col("c_acctbal") / 100).alias("lon"), ((F.col("c_custkey") % 180) - 90.5).alias("lat"))
    out = _with_fv(city, "clean_city", ["c_custkey"], value="v", state="st", country="co", longitude="lon",
                   latitude="lat")
    return out.select("c_custkey", "key", "name")


UNIT_PAIRS = [("kg", "lb"), ("lb", "kg"), ("ft", "in"), ("ft", "cm"), ("in", "ft"), ("in", "cm"), ("cm", "ft"),
              ("cm", "in"), ("kg", "kg"), ("ft", "lb")]


@query
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.functions import normalize as N
    li = T.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    idx = (F.col("l_orderkey") + F.col("l_linenumber")) % len(UNIT_PAIRS)
    fu, tu = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (a, b) in enumerate(UNIT_PAIRS):
        fu = F.when(idx == i, F.lit(a)).otherwise(fu)
        tu = F.when(idx == i, F.lit(b)).otherwise(tu)
    li = li.withColumn("from_unit", fu).withColumn("to_unit", tu)
    return li.select("l_orderkey", "l_linenumber", "from_unit", "to_unit",
                     F.round(N.unit_conversion(F.col("l_quantity"), F.col("from_unit"), F.col("to_unit")), 6)
                     .alias("converted"))


def measurement_text(q, ln) -> "F.Column":
    f = (F.lit(4) + q % 4).cast("string")
    i = (ln + q % 5).cast("string")
    return (F.when(ln % 4 == 0, F.concat(F.lit("she is "), f, F.lit("'"), i, F.lit('" and '), (q * 4).cast("string"),
                                         F.lit(" lbs")))
            .when(ln % 4 == 1, F.concat(F.lit("height "), (q + 150).cast("string"), F.lit(" cm")))
            .when(ln % 4 == 2, F.concat(F.lit("weight "), (q + 40).cast("string"), F.lit(" kg, or "),
                                        (q * 3).cast("string"), F.lit(" Pounds")))
            .otherwise(F.lit("no measurements here")))


@query
def height_weight_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _li(spark, sf_dir).withColumn("text", measurement_text(F.col("q"), F.col("l_linenumber")))
    rec = li.select("l_orderkey", "l_linenumber", mentions.height_weight("text").alias("hw"))
    split = mentions.split_height_weight(rec, ["l_orderkey", "l_linenumber"])
    vals = F.coalesce(F.col("centimeter"), F.col("kilogram"))
    return split.select("l_orderkey", "l_linenumber", "field", F.size(vals).cast("bigint").alias("n_values"),
                        F.get(vals, 0).alias("first_value"))


# --- dates (H13) --------------------------------------------------------------

DATE_SHAPES = ["yyyy-MM-dd", "MM/dd/yyyy", "MMMM d, yyyy"]


@query
def posting_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shape = F.col("o_orderkey") % len(DATE_SHAPES)
    raw = F.lit(None).cast("string")
    for i, fmt in enumerate(DATE_SHAPES):
        raw = F.when(shape == i, F.date_format("o_orderdate", fmt)).otherwise(raw)
    o = o.select("o_orderkey", raw.alias("raw"))
    return _with_fv(o, "clean_posting_date", ["o_orderkey", "raw"], value="raw").select(
        "o_orderkey", "raw", F.col("name").alias("iso"))


# --- canonicalisation (J1) ----------------------------------------------------

def misspelled_part_words(spark, sf_dir) -> DataFrame:
    """Each part-name word with one letter dropped (position by part key)."""
    p = T.load(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("word_ix", "w"))
    pos = F.col("p_partkey") % F.length("w")
    raw = F.concat(F.substring("w", 1, pos), F.substring(F.col("w"), pos + 2, 1 << 20))
    return p.select("p_partkey", F.col("word_ix").cast("int").alias("word_ix"), raw.alias("raw"))


@query
def canonicalize_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import canonical as J
    refs = J.reference_table(spark, {None: T.PART_WORDS})
    out = J.canonicalize(misspelled_part_words(spark, sf_dir), "raw", refs, score_col="score")
    return out.select("p_partkey", "word_ix", "raw", "canonical", F.round("score", 6).alias("score"))


@query
def color_vocabularies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eye and hair colours by their own reference lists; other fields stay null."""
    from fieldloom.operators import canonical as J
    words = ["blu", "sapphire", "grey", "blond", "flaxen", "ginger", "platnum", "hazel", "Raven ", "brwn", "none"]
    word = F.element_at(F.array(*map(F.lit, words)), (F.col("p_partkey") % len(words) + 1).cast("int"))
    field = F.element_at(F.array(*map(F.lit, ("eye_color", "hair_color", "price"))), (F.col("p_size") % 3 + 1).cast("int"))
    p = T.load(spark, sf_dir, "part").select("p_partkey", field.alias("field"), word.alias("value"))
    out = J.canonicalize(p, "value", J.default_references(spark), field_col="field")
    return out.select("p_partkey", "field", "value", "canonical")


PHRASE_REFERENCES = ["red ring", "blue bolt", "old gear", "new rod", "hot plate", "cold anvil", "large gizmo", "small widget"]


@query
def canonicalize_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word values: the first word lacks a letter, or is repeated."""
    from fieldloom.operators import canonical as J
    w = F.split("p_name", " ")
    one, two = F.get(w, 0), F.get(w, 1)
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat_ws(" ", one, one)).otherwise(
        F.concat_ws(" ", F.concat(F.substring(one, 1, 1), F.substring(one, 3, 99)), two))
    p = T.load(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    out = J.canonicalize(p, "raw", J.reference_table(spark, {None: PHRASE_REFERENCES}), score_col="score", threshold=0.8)
    return out.select("p_partkey", "raw", "canonical", F.round("score", 6).alias("score"))


# --- spans (F1, G1) -------------------------------------------------------------

def phrase_spans(spark, sf_dir) -> DataFrame:
    return mentions.dictionary_mentions(_doc_tokens(spark, sf_dir), ["doc_id"], "tokens", T.phrase_vocab(spark),
                                        field="phrase", n=3)


@query
def annotate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import spans
    a = spans.token_annotations(phrase_spans(spark, sf_dir), ["doc_id"])
    return a.select("doc_id", "pos", "type", "offset", "length", "start")


@query
def rebuild_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import consolidate as G
    s = G.rebuild_spans(phrase_spans(spark, sf_dir).withColumnRenamed("weight", "probability"))
    return s.select("doc_id", "start", "end", "value", "probability")


# --- scoring (F3, F4) -------------------------------------------------------------

@query
def score_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import scoring
    e = T.load(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("field"),
                                                    F.col("embedding").alias("vec"))
    models = scoring.prototype_models(e)
    s = scoring.score(e, models)
    return s.select("vec_id", F.col("field").cast("int").alias("label"), F.round("probability", 6).alias("score"))


def location_mentions(spark, sf_dir) -> DataFrame:
    """Per customer: its nation (title, 0.6), a decoy nation (text, 0.8) and its
    region (text, 0.5) as state/country mentions."""
    c = T.load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = T.load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = T.load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    from fieldloom.operators.plumbing import bounded_broadcast
    geo = bounded_broadcast(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    own = c.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    decoy = c.withColumn("dk", (F.col("c_nationkey") + 7) % 25).join(
        bounded_broadcast(n.select(F.col("n_nationkey").alias("dk"), F.col("n_name").alias("decoy"))), "dk")
    m1 = own.select(F.col("c_custkey").alias("doc_id"), F.lit("state").alias("type"), F.col("n_name").alias("value"),
                    F.lit("title").alias("source"), F.lit(0.6).alias("probability"))
    m2 = decoy.select(F.col("c_custkey").alias("doc_id"), F.lit("state").alias("type"), F.col("decoy").alias("value"),
                      F.lit("text").alias("source"), F.lit(0.8).alias("probability"))
    m3 = own.select(F.col("c_custkey").alias("doc_id"), F.lit("country").alias("type"), F.col("r_name").alias("value"),
                    F.lit("text").alias("source"), F.lit(0.5).alias("probability"))
    return m1.unionByName(m2).unionByName(m3)


def state_country_gazetteer(spark, sf_dir) -> DataFrame:
    n = T.load(spark, sf_dir, "nation")
    r = T.load(spark, sf_dir, "region")
    pairs = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    a = pairs.select(F.lit("state").alias("type_a"), F.col("n_name").alias("value_a"),
                     F.lit("country").alias("type_b"), F.col("r_name").alias("value_b"))
    b = pairs.select(F.lit("country").alias("type_a"), F.col("r_name").alias("value_a"),
                     F.lit("state").alias("type_b"), F.col("n_name").alias("value_b"))
    return a.unionByName(b)


@query
def consistent_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import scoring
    best = scoring.choose_locations(location_mentions(spark, sf_dir), state_country_gazetteer(spark, sf_dir))
    return best.select(F.col("doc_id").alias("c_custkey"), "type", "value", F.round("score", 6).alias("score"))


EMBEDDING_ROWS = 500


def hashed_token(token) -> "F.Column":
    """The embedding row of a token: its MD5 modulo the number of rows (a hashed vocabulary)."""
    return (F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("long") % EMBEDDING_ROWS).cast("string")


@query
def score_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """phrase spans scored from the embeddings of the tokens around them, by models
    fitted on the labelled documents of four fifths of the ids; the others are scored."""
    from fieldloom.operators import scoring
    spans = mentions.dictionary_mentions(_doc_tokens(spark, sf_dir), ["doc_id"], "tokens", T.phrase_vocab(spark).select("entry"),
                                         field="phrase", n=3, context=2)
    hashed = spans.select("doc_id", "start", "end", F.col("value").alias("field"), F.transform("context", hashed_token).alias("context"))
    e = T.load(spark, sf_dir, "embeddings").where(F.col("vec_id") < EMBEDDING_ROWS)
    table = e.select(F.col("vec_id").cast("string").alias("token"), F.col("embedding").alias("vec"))
    vectors = lambda rows, *more: scoring.context_vectors(rows, table, ["doc_id", "start", "end", "field", *more], max_context=2 * 2 + 3)
    labels = T.load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    models = scoring.centroid_models(vectors(hashed.where("doc_id % 5 <> 0").join(labels, "doc_id"), "label"))
    scored = scoring.score(vectors(hashed.where("doc_id % 5 = 0")), models)
    return scored.select("doc_id", "start", "end", "field", F.round("probability", 6).alias("probability"))


@query
def random_index_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.operators import scoring
    lower = _doc_tokens(spark, sf_dir).select(F.transform("tokens", F.lower).alias("tokens"))
    return scoring.random_index(lower).withColumn("vec", F.array_join("vec", ","))


def place_mentions(spark, sf_dir) -> DataFrame:
    """Per customer: a city (title), another city and its own state (text), the country of the
    first city (text); one city in three goes by another name."""
    s = T.load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = T.load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = T.load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    c = T.load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    named = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("old "), F.col("s_name"))).otherwise(F.col("s_name"))
    place = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
             .select("s_suppkey", named.alias("city"), "r_name"))
    count = 10  # suppliers there are at every scale
    def at(key):
        return c.select("c_custkey", (key % count + 1).alias("s_suppkey")).join(place, "s_suppkey")
    def row(df, kind, value, source, p):
        return df.select(F.col("c_custkey").alias("doc_id"), F.lit(kind).alias("type"), F.col(value).alias("value"),
                         F.lit(source).alias("source"), F.lit(p).alias("probability"))
    first, other = at(F.col("c_custkey")), at(F.col("c_custkey") * 7 + 3)
    own = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return (row(first, "city", "city", "title", 0.4).unionByName(row(other, "city", "city", "text", 0.9))
            .unionByName(row(own, "state", "n_name", "text", 0.5)).unionByName(row(first, "country", "r_name", "text", 0.7)))


@query
def joint_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 with cities, states and countries, and other names of cities."""
    from fieldloom.operators import scoring
    s = T.load(spark, sf_dir, "supplier")
    n, r = T.load(spark, sf_dir, "nation"), T.load(spark, sf_dir, "region")
    places = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("s_name").alias("city"), F.col("n_name").alias("state"), F.col("r_name").alias("country")))
    aliases = s.select(F.lit("city").alias("type"), F.concat(F.lit("old "), F.col("s_name")).alias("alias"), F.col("s_name").alias("value"))
    best = scoring.choose_locations(place_mentions(spark, sf_dir), scoring.place_pairs(places), aliases=aliases)
    return best.select("doc_id", "type", "value", F.round("score", 6).alias("score"))


# --- pipeline parts: suffix rules, URL words, landmark fields, cells, lists, the index ------------

SUFFIX_RULES = ["com", "net", "org", "ck", "*.ck", "!www.ck", "uk", "co.uk", "jp", "*.kobe.jp", "!city.kobe.jp", "net.example.org"]


@query
def suffix_rule_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 with wildcard and exception rules: hosts of the pages under other suffixes."""
    from fieldloom.operators.plumbing import suffix_rules
    label = F.regexp_extract("url", "^[a-z]+://([a-z0-9]+)", 1)
    ends = [".ck", ".shop.ck", ".a.shop.ck", ".www.ck", ".b.co.uk", ".kobe.jp", ".x.kobe.jp", ".city.kobe.jp", ".y.net.example.org", ".unlisted"]
    end = F.element_at(F.array(*map(F.lit, ends)), (F.col("page_id") % len(ends) + 1).cast("int"))
    pages = T.load(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("http://"), label, end, F.lit("/p")).alias("url"))
    out = add_registered_domain(pages, suffix_rules(spark, SUFFIX_RULES))
    return out.select("page_id", host_of(F.col("url")).alias("host"), "tld")


@query
def url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary mentions in the words of a URL's host and path."""
    pages = T.load(spark, sf_dir, "pages").select("page_id", content.url_text("url").alias("text"))
    toks = pages.select("page_id", tokens.tokenize("text").alias("tokens"))
    vocab = spark.createDataFrame([("example com",), ("example net",), ("www",), ("fr",), ("es",), ("org es",)], "entry string")
    m = mentions.dictionary_mentions(toks, ["page_id"], "tokens", vocab, field="place", n=2)
    return m.select("page_id", "start", "end", "value")


SITE_RULES = [("example.com", "inferlink_name", "<h1>", "</h1>"), ("example.com", "inferlink_price-1", '<div class="ad">', "</div>"),
              ("example.com", "inferlink_price", "<!-- ad ", " -->"), ("example.net", "inferlink_name", "<h1>", "</h1>"),
              ("example.net", "no_such_source", "<h1>", "</h1>"), ("com", "inferlink_name", "<h1>", "</h1>")]


@query
def landmark_site_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 -> X13: what landmark rules find, as values of semantic fields."""
    from fieldloom.plans import pipeline
    rules = spark.createDataFrame(SITE_RULES, "site string, field string, begin string, end string")
    c = pipeline.landmark_candidates(T.load(spark, sf_dir, "pages"), rules, T.suffixes(spark))
    return c.select(F.col("doc_id").alias("page_id"), "field", "source", "tier", "pos", "value")


@query
def cell_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates from table cells, by two vocabularies in one pass and by a pattern, with their provenance."""
    from fieldloom.plans import pipeline
    pages = order_tables_html(T.dealt(T.load(spark, sf_dir, "orders"))).select(F.col("o_orderkey").alias("page_id"), F.lit("http://x.example.com/").alias("url"), "html")
    words = spark.createDataFrame([("urgent", 0.9), ("high", 0.8), ("low", 0.7), ("not specified", 0.6), ("medium", 0.1)], "entry string, weight double")
    labels = spark.createDataFrame([("key", 0.5), ("date", 0.4), ("not specified", 0.3)], "entry string, weight double")
    no_segments = spark.createDataFrame([], "page_id long, segment string, source string, text string")
    ex = pipeline.extract(pages, mentions.vocabularies({"priority": (words, 2), "label": (labels, 1)}), n=2, segments=no_segments, cells=True,
                          regexes={"posting-date": pipeline.REGEX_EXTRACTORS["posting-date"]})
    c = pipeline.candidates(ex)
    return c.select("doc_id", "field", "tier", "pass_no", "rank", "pos", "value", "extractor", "input_type", "source", "segment", "cell")


@query
def height_weight_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11/X12 records and list-valued site strings in one run of consolidation."""
    from fieldloom.operators import consolidate as G
    size = F.col("p_size")
    text = F.concat((size + 110).cast("string"), F.lit(" cm, or "), (size * 5).cast("string"), F.lit(" CM; "), (size * 6 + 10).cast("string"),
                    F.lit(" lbs and "), (size + 30).cast("string"), F.lit(" kg"))
    parts = T.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), "p_size", text.alias("text"))
    measures = mentions.split_height_weight(parts.select("doc_id", mentions.height_weight("text").alias("hw")), ["doc_id"])
    lists = F.coalesce(F.col("centimeter").cast("array<string>"), F.col("kilogram").cast("array<string>"))
    first = measures.select("doc_id", "field", F.lit(0).cast("bigint").alias("pos"), F.array_join(lists, ",").alias("value"),
                            F.lit(None).cast("array<string>").alias("values"), "centimeter", F.col("kilogram").cast("array<double>").alias("kilogram"))
    site = parts.select("doc_id", F.lit("weight").alias("field"), F.lit(1).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("value"),
                        F.array(F.concat((size + 35).cast("string"), F.lit("kg")), F.lit(None).cast("string"), F.lit("heavy"),
                                F.concat((size + 30).cast("string"), F.lit(" kilos"))).alias("values"),
                        F.lit(None).cast("array<int>").alias("centimeter"), F.lit(None).cast("array<double>").alias("kilogram"))
    cands = first.unionByName(site).withColumn("tier", F.lit("strict")).withColumn("pass_no", F.lit(2)).withColumn("rank", F.lit(0.0))
    out = G.consolidate(cands)
    return out.select("doc_id", "field", "tier", "pos", "ix", F.round("num", 6).alias("num"), F.when(F.col("num").isNull(), F.col("name")).alias("raw"))


@query
def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed index documents, one row per document, with the values that the index has no place for."""
    from fieldloom.operators import consolidate as G
    from fieldloom.sources import pages as P
    from fieldloom.session import cut_lineage
    fields = cut_lineage(G.consolidate(event_candidates(spark, sf_dir)))
    good, bad = P.index_rows(fields)
    docs = P.index_rows_to_documents(good, fields.select("doc_id").distinct())
    odd = bad.groupBy("doc_id").agg(F.count(F.when(F.col("reason") == "wrong type", 1)).alias("n_wrong_type"),
                                    F.count(F.when(F.col("reason") == "not in the index", 1)).alias("n_no_place"))
    f = lambda path, m: F.array_join(F.transform(f"fields.{path}", lambda v: v[m].cast("string")), "|")
    return docs.join(odd, "doc_id", "left").select(
        "doc_id", f("age.strict", "name").alias("ages_strict"), F.aggregate("fields.age.relaxed", F.lit(0).cast("bigint"), lambda a, v: a + v["name"]).alias("age_sum_relaxed"),
        f("name.strict", "name").alias("names_strict"), f("title.strict", "name").alias("titles"), F.size("fields.weight.relaxed").alias("n_weights"),
        F.coalesce("n_wrong_type", F.lit(0)).alias("n_wrong_type"), F.coalesce("n_no_place", F.lit(0)).alias("n_no_place"))


@query
def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price, URL, review, account, address and date patterns, and gender, nationality and service
    vocabularies in one pass, over texts built from customers."""
    from fieldloom.plans import pipeline
    k = F.col("c_custkey")
    text = F.concat(F.lit("Price $"), (k % 900).cast("string"), F.lit(".50 or "), k.cast("string"), F.lit(" EUR, see https://a.example.com/x?id="), k.cast("string"),
                    F.lit(". Review #R-"), k.cast("string"), F.lit(" by @user_"), k.cast("string"), F.lit(" at "), k.cast("string"),
                    F.lit(" Old Mill Road on 2017-03-1"), (k % 10).cast("string"), F.lit(", mail me@x.example.com. "),
                    F.element_at(F.array(*map(F.lit, ("Female", "male", "A  woman"))), (k % 3 + 1).cast("int")), F.lit(" from "),
                    F.element_at(F.array(*map(F.lit, ("New Zealand", "France"))), (k % 2 + 1).cast("int")), F.lit(" offers deep tissue massage"))
    rows = T.load(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    out = None
    for name in ("price", "url", "review-id", "social-id", "address", "posting-date"):
        pattern, group = pipeline.REGEX_EXTRACTORS[name]
        m = mentions.regex_mentions(rows, ["c_custkey"], "text", pattern, field=name, group=group).select("c_custkey", "field", "value")
        out = m if out is None else out.unionByName(m)
    table = lambda words: spark.createDataFrame([(w,) for w in words], "entry string")
    vocab = mentions.vocabularies({"gender": (table(["female", "male", "woman", "man"]), 1), "nationality": (table(["france", "new zealand"]), 2),
                                   "service": (table(["deep tissue massage", "massage"]), 3)})
    toks = rows.select("c_custkey", tokens.tokenize("text").alias("tokens"))
    return out.unionByName(mentions.dictionary_mentions(toks, ["c_custkey"], "tokens", vocab, field="", n=3).select("c_custkey", "field", "value"))


# --- flagship: full pipeline (C1-C6, D1, X1, X7, G1-G13, A7) ---------------------

@query
def assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.plans import pipeline
    pages = T.load(spark, sf_dir, "pages")
    docs = pipeline.consolidate_documents(pages, T.phrase_vocab(spark))
    return pipeline.field_summary(docs)
