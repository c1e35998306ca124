"""HTML -> segments.

* ``extract_title``      C3  first ``<title>`` text (no entity decoding)
* ``html_blocks``        C1  per-page array of text blocks (no shuffle)
* ``relaxed_content``    C1  all non-empty blocks, joined by newlines
* ``strict_blocks``      C2  long, link-poor blocks not repeated across a site
* ``extract_tables``     C4  ``cells(id, table_ix, row_ix, cell_ix, text)``
* ``extract_lists``      C4  ``<ul>/<ol>`` items as one-column tables
* ``landmark_values``    C5  per-site begin/end rules, joined on the site key
* ``segments``           C6  union of the above as ``(id, segment, source, text)``

Block splitting is our own definition of "main text": scripts, styles,
comments and the head are removed, the page is cut at block-level tags, inline
tags are dropped, entities decoded and whitespace collapsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions.text import col_of, html_to_text, let, memo_column, running
from fieldloom.operators.plumbing import bounded_broadcast, host_of, registered_domains
from fieldloom.session import cut_lineage

# Patterns (shared with the SQL oracles in plans/).
REMOVE_PATTERN = (r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|"
                  r"<noscript\b.*?</noscript>|<head\b.*?</head>")
BLOCK_SPLIT_PATTERN = r"(?i)</?(?:" + config.BLOCK_TAGS + r")\b[^>]*>"
LINK_PATTERN = r"(?is)<a\b[^>]*>(.*?)</a>"

def extract_title(html) -> "F.Column":
    """Text of the first ``<title>`` element, case-insensitive; ``.`` does not
    cross newlines.  Empty string when absent."""
    return F.regexp_extract(col_of(html), config.TITLE_PATTERN, 1)


@memo_column
def html_blocks(html) -> "F.Column":
    """Array of ``(ix, text, n_chars, link_chars)`` for every block of a page,
    computed inside the row (no explode, no shuffle).  ``ix`` is the block's
    position in the split; empty blocks are dropped."""
    cleaned = F.regexp_replace(col_of(html), REMOVE_PATTERN, " ")
    raw = F.split(cleaned, BLOCK_SPLIT_PATTERN, -1)

    def block(frag, i):
        text = html_to_text(frag)
        links = html_to_text(F.array_join(F.regexp_extract_all(frag, F.lit(LINK_PATTERN), 1), " "))
        return F.struct(i.alias("ix"), text.alias("text"), F.length(text).alias("n_chars"),
                        F.length(links).alias("link_chars"))

    return F.filter(F.transform(raw, block), lambda b: b["n_chars"] > 0)


def relaxed_content(blocks) -> "F.Column":
    """High-recall main text: every block, one per line."""
    return F.array_join(F.transform(col_of(blocks), lambda b: b["text"]), "\n")


def explode_blocks(df: DataFrame, id_col: str, blocks_col: str = "blocks", keep=()) -> DataFrame:
    """Long table ``(id, *keep, block_ix, text, n_chars, link_chars)``."""
    return (df.select(id_col, *keep, F.explode(blocks_col).alias("b"))
            .select(id_col, *keep, F.col("b.ix").alias("block_ix"), F.col("b.text").alias("text"),
                    F.col("b.n_chars").alias("n_chars"), F.col("b.link_chars").alias("link_chars")))


BLOCK_KEY = ["__h", "__h2", "n_chars"]


def keyed_blocks(blocks: DataFrame, min_chars: int = config.STRICT_MIN_CHARS,
                 max_link_density: float = config.STRICT_MAX_LINK_DENSITY) -> DataFrame:
    """Blocks that are long and link-poor enough, with ``BLOCK_KEY``: a 128-bit hash
    and the length of the text."""
    return (blocks.where((F.col("n_chars") >= min_chars) & (F.col("link_chars") <= F.col("n_chars") * max_link_density))
            .withColumn("__h", F.xxhash64("text")).withColumn("__h2", F.xxhash64(F.lit(1), "text")))


def page_counts(keyed: DataFrame, id_col: str, site_col: str) -> DataFrame:
    """``(site, *BLOCK_KEY, pages)``: on how many distinct pages of a site a block occurs."""
    return keyed.groupBy(site_col, *BLOCK_KEY).agg(F.count_distinct(id_col).alias("pages"))


def same_block(left: DataFrame, right: DataFrame, site_col: str) -> "F.Column":
    """Join condition on site and block; a null site is one site."""
    on = left[site_col].eqNullSafe(right[site_col])
    for c in BLOCK_KEY:
        on = on & (left[c] == right[c])
    return on


def strict_blocks(blocks: DataFrame, id_col: str, site_col: str,
                  min_chars: int = config.STRICT_MIN_CHARS,
                  max_link_density: float = config.STRICT_MAX_LINK_DENSITY,
                  max_site_repeats: int = config.STRICT_MAX_SITE_REPEATS,
                  counts: DataFrame | None = None) -> DataFrame:
    """High-precision blocks: long enough, link-poor, and not boilerplate.

    A block is boilerplate when the same text occurs on more than
    ``max_site_repeats`` distinct pages of one site.  Repeats are counted on
    ``(site, 128-bit hash, length)``, a null site being one site, with a distinct-count aggregation (partial
    aggregation; a hot site or block never lands whole in one task), and the
    boilerplate keys are removed with an anti join.  ``counts`` (as of ``page_counts``)
    gives them from elsewhere, such as the state of a stream.  The key set is derived
    from the data, so its size is measured at run time: AQE broadcasts it when
    the measured size is small and keeps a shuffled join (with skew splitting)
    otherwise; a separate counting pass would recompute the whole block job.
    """
    keyed = keyed_blocks(blocks, min_chars, max_link_density)
    counts = counts if counts is not None else page_counts(keyed, id_col, site_col)
    repeated = counts.where(F.col("pages") > max_site_repeats)
    return keyed.join(repeated, same_block(keyed, repeated, site_col), "left_anti").drop("__h", "__h2")


def join_blocks(blocks: DataFrame, id_col: str, out_col: str = "text") -> DataFrame:
    """Reassemble ``(id, text)`` from block rows in block order.  The blocks of
    one page come from one row, so the partial aggregation completes each page
    before the shuffle."""
    return (blocks.groupBy(id_col)
            .agg(F.array_sort(F.collect_list(F.struct("block_ix", "text"))).alias("__b"))
            .select(id_col, F.array_join(F.transform("__b", lambda b: b["text"]), "\n").alias(out_col)))


def own_contents(html, tags: str) -> "F.Column":
    """Per element of ``tags`` (in the order of their opening tags), its content
    without that of elements of these tags inside it.  An element that is never
    closed runs to the end of the page; a closing tag without an opening one is
    ignored."""
    rx = rf"(?is)</?(?:{tags})\b[^>]*>"
    html = col_of(html)
    big = 1 << 31
    opens = F.transform(F.regexp_extract_all(html, F.lit(rx), 0), lambda t: ~t.startswith("</"))

    def add(a, b):
        return a + b

    def owners(opens):
        """Per tag ``(owner, i)``: the element that is open behind the i-th tag, -1 for none.
        It is the last one that opened at the depth there: a running maximum over the
        tags in order of depth finds it."""
        level = running(F.transform(opens, lambda o: F.when(o, 1).otherwise(-1)), add, (0, "int"))
        depth = let(level, lambda s: F.zip_with(s, running(s, F.least, (0, "int")), lambda x, low: x - low))
        number = running(F.transform(opens, lambda o: o.cast("int")), add, (0, "int"))
        tags_ = F.zip_with(depth, F.zip_with(opens, number, lambda o, n: F.when(o, n).otherwise(0)), lambda d, n: F.struct(d.alias("d"), n.alias("n")))
        ordered = F.array_sort(F.transform(tags_, lambda t, i: F.struct(t["d"].alias("d"), i.alias("i"), t["n"].alias("n"))))
        last = lambda o: running(F.transform(o, lambda t: t["d"].cast("long") * big + t["n"]), F.greatest, (0, "bigint"))
        return let(ordered, lambda o: F.zip_with(o, last(o), lambda t, m: F.struct(
            F.when(t["d"] > 0, (m % big).cast("int") - 1).otherwise(-1).alias("owner"), t["i"].alias("i"))))

    def nested(part, owned):
        """Each element's pieces lie side by side once sorted by owner."""
        ranked = F.array_sort(F.filter(owned, lambda x: x["owner"] >= 0))

        def joined(x):
            begin = F.filter(F.transform(x, lambda e, j: F.when((j == 0) | (F.get(x, j - 1)["owner"] != e["owner"]), j)), lambda j: j.isNotNull())
            return let(begin, lambda g: F.transform(g, lambda j, k: F.array_join(F.transform(
                F.slice(x, j + 1, F.coalesce(F.get(g, k + 1), F.size(x)) - j), lambda e: F.get(part, e["i"] + 1)), " ")))
        return let(ranked, joined)

    def contents(f):
        """Where opening and closing tags take turns (most pages), every second piece is an element."""
        turns = (F.size(f["opens"]) % 2 == 0) & (F.size(F.filter(f["opens"], lambda o, i: o != (i % 2 == 0))) == 0)
        return F.when(turns, F.filter(f["part"], lambda p, i: i % 2 == 1)).otherwise(
            let(let(f["opens"], owners), lambda s: nested(f["part"], s)))
    return let(F.struct(F.split(html, rx, -1).alias("part"), opens.alias("opens")), contents)


def _items(html, tag: str) -> "F.Column":
    """Contents of the elements ``tag`` of a piece of HTML; each ends at its closing
    tag or where the next one begins."""
    pieces = F.split(col_of(html), rf"(?i)<(?:{tag})\b[^>]*>", -1)
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
                       lambda p: F.get(F.split(p, rf"(?i)</(?:{tag})\s*>", 2), 0))


def extract_tables(df: DataFrame, id_col: str, html_col: str = "html") -> DataFrame:
    """``cells(id, table_ix, row_ix, cell_ix, text)`` from ``<table>/<tr>/<td|th>``;
    nested tables are tables of their own, and rows and cells may lack closing tags."""
    t = df.select(id_col, F.posexplode(own_contents(html_col, "table")).alias("table_ix", "table_html"))
    r = t.select(id_col, "table_ix", F.posexplode(_items("table_html", "tr")).alias("row_ix", "row_html"))
    c = r.select(id_col, "table_ix", "row_ix", F.posexplode(_items("row_html", "t[dh]")).alias("cell_ix", "cell_html"))
    return c.select(id_col, "table_ix", "row_ix", "cell_ix", html_to_text(F.col("cell_html")).alias("text"))


def extract_lists(df: DataFrame, id_col: str, html_col: str = "html") -> DataFrame:
    """``items(id, list_ix, item_ix, text)`` from ``<ul>/<ol>`` and ``<li>``; nested
    lists are lists of their own, and items may lack closing tags."""
    lists = df.select(id_col, F.posexplode(own_contents(html_col, "ul|ol")).alias("list_ix", "list_html"))
    items = lists.select(id_col, "list_ix", F.posexplode(_items("list_html", "li")).alias("item_ix", "item_html"))
    return items.select(id_col, "list_ix", "item_ix", html_to_text(F.col("item_html")).alias("text"))


def landmark_values(pages: DataFrame, rules: DataFrame, id_col: str, suffixes: DataFrame,
                    url_col: str = "url", html_col: str = "html", max_broadcast_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Apply per-site begin/end rules, ``rules(site, field, begin, end)``, a site being a
    registered domain: ``(id, field, value, rule_ix)``.

    Which hosts belong to a site with rules is found out from the URLs alone.  These few hosts,
    with their rules, are then broadcast to the pages, whose HTML is read where it
    is: no exchange carries HTML (beyond the broadcast's bounds the host join is
    shuffled).  The value is the trimmed text between the first ``begin`` and the next
    ``end`` after it; rules whose literals are not found give no row.  ``rule_ix`` numbers
    the rules of a site by field and literals.
    """
    from pyspark.sql import Window
    order = Window.partitionBy("site").orderBy("field", "begin", "end")  # a site's rules: a few configuration rows
    ruled = rules.select("site", "field", "begin", "end").withColumn("rule_ix", F.row_number().over(order) - 1)
    hosts = pages.select(host_of(F.col(url_col)).alias("host")).where(F.col("host").isNotNull()).distinct()
    sites = registered_domains(hosts, suffixes).withColumnRenamed("registered_domain", "site")
    by_host = bounded_broadcast(cut_lineage(sites.join(ruled, "site").drop("site").withColumnRenamed("host", "__host")), max_broadcast_rows)
    j = (pages.select(id_col, host_of(F.col(url_col)).alias("__host"), html_col).join(by_host, "__host", "inner")
         .withColumn("__b", F.expr(f"locate(`begin`, `{html_col}`)"))
         .withColumn("__vs", F.col("__b") + F.length("begin"))
         .withColumn("__e", F.expr(f"locate(`end`, `{html_col}`, __vs)")))
    value = F.trim(F.substring(F.col(html_col), F.col("__vs"), F.col("__e") - F.col("__vs")))
    return (j.where((F.col("__b") > 0) & (F.col("__e") > 0))
            .select(id_col, "field", value.alias("value"), "rule_ix"))


def url_text(url) -> "F.Column":
    """Host and path of a URL as words: the query and fragment are left out, and every run
    of characters other than letters and digits becomes one space."""
    place = F.regexp_replace(F.regexp_replace(col_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?", ""), r"[?#].*$", "")
    return F.trim(F.regexp_replace(place, r"[^\p{L}\p{N}]+", " "))


def page_rows(pages: DataFrame, id_col: str, html_col: str = "html", url_col: str | None = "url", site_col: str = "host") -> DataFrame:
    """The HTML parsed once: ``(id, site, title, blocks)`` per page."""
    site = host_of(F.col(url_col)) if url_col else F.lit("")
    return pages.select(id_col, site.alias(site_col), extract_title(F.col(html_col)).alias("title"), html_blocks(html_col).alias("blocks"))


def segments_of_rows(rows: DataFrame, id_col: str, source: str = "html", strict: bool = True, site_col: str = "host",
                     counts: DataFrame | None = None) -> DataFrame:
    """``(id, segment, source, text)`` of parsed page rows; see ``segments``."""
    src = F.lit(source).alias("source")
    title = rows.select(id_col, F.lit("title").alias("segment"), src, F.col("title").alias("text"))
    relaxed = rows.select(id_col, F.lit("content_relaxed").alias("segment"), src, relaxed_content("blocks").alias("text"))
    out = title.unionByName(relaxed)
    if strict:
        exploded = explode_blocks(rows, id_col, keep=(site_col,))
        strict_df = join_blocks(strict_blocks(exploded, id_col, site_col, counts=counts), id_col)
        out = out.unionByName(strict_df.select(id_col, F.lit("content_strict").alias("segment"), src, "text"))
    return out.where(F.col("text") != "")


def segments(pages: DataFrame, id_col: str, html_col: str = "html", url_col: str | None = "url",
             strict: bool = True, site_col: str = "host", materialize: bool = True) -> DataFrame:
    """All content segments of the pages as ``(id, segment, source, text)``:
    ``title``, ``content_relaxed`` and (optionally) ``content_strict``; empty
    segments are dropped (C6).

    The HTML is parsed once into per-page rows ``(id, site, title, blocks)``;
    with ``materialize`` those rows are checkpointed so the relaxed/title
    branch and the strict branch (explode, site repeat count, anti join,
    regroup) both read them instead of re-parsing the HTML."""
    rows = page_rows(pages, id_col, html_col, url_col, site_col)
    if materialize:
        rows = cut_lineage(rows)
    return segments_of_rows(rows, id_col, html_col, strict, site_col)
