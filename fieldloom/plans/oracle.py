"""DuckDB oracle SQL for the registered queries.

Each statement recomputes a query from the raw tables with plain SQL (no
shared code with the Spark side beyond the fixed patterns and vocabularies),
so agreement is evidence that the Spark plan is right.  Column names match the
Spark results exactly.
"""

from __future__ import annotations

from fieldloom import config
from fieldloom.operators import content as C
from fieldloom.operators import mentions as M
from fieldloom.plans import tables as T

ORACLE: dict = {}


# Patterns of flat, well-formed tables and lists: what the given pages and built tables hold.
TABLE_PATTERN = r"(?is)<table\b[^>]*>(.*?)</table>"
ROW_PATTERN = r"(?is)<tr\b[^>]*>(.*?)</tr>"
CELL_PATTERN = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"
LIST_PATTERN = r"(?is)<(?:ul|ol)\b[^>]*>(.*?)</(?:ul|ol)>"
ITEM_PATTERN = r"(?is)<li\b[^>]*>(.*?)</li>"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def values_list(items) -> str:
    return ", ".join("(" + q(i) + ")" for i in items)


def html_to_text(expr: str) -> str:
    """SQL twin of ``functions.text.html_to_text``."""
    e = f"regexp_replace({expr}, '<[^>]*>', ' ', 'g')"
    for ent, ch in config.HTML_ENTITIES:
        if ent != "&amp;":
            e = f"replace({e}, {q(ent)}, {q(ch)})"
    e = f"replace({e}, '&amp;', '&')"
    return f"trim(regexp_replace({e}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"


HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1))"

SUFFIXES = values_list(config.DEFAULT_PUBLIC_SUFFIXES)

REGISTERED_DOMAIN_CTE = f"""
rd_h AS (SELECT page_id, url, {HOST} AS host FROM pages),
rd_l AS (SELECT page_id, host, string_split(host, '.') AS labels FROM rd_h WHERE host IS NOT NULL),
rd_c AS (SELECT page_id, host, labels, unnest(range(2, len(labels) + 1)) AS k FROM rd_l WHERE len(labels) >= 2),
rd_s AS (SELECT page_id, host, array_to_string(list_slice(labels, k, len(labels)), '.') AS suffix,
                labels[k - 1] AS label, len(labels) - k + 1 AS n FROM rd_c),
rd_m AS (SELECT page_id, arg_max(label || '.' || rd_s.suffix, n) AS tld
         FROM rd_s JOIN (VALUES {SUFFIXES}) v(suffix) ON rd_s.suffix = v.suffix GROUP BY page_id),
rd AS (SELECT rd_h.page_id, rd_h.host, rd_m.tld FROM rd_h LEFT JOIN rd_m USING (page_id))
"""

ORACLE["title_extract"] = f"""
SELECT page_id, title FROM (
  SELECT page_id, regexp_extract(html, {q(config.TITLE_PATTERN)}, 1) AS title FROM pages) WHERE title <> ''
"""

ORACLE["registered_domain"] = f"WITH {REGISTERED_DOMAIN_CTE} SELECT page_id, host, tld FROM rd"

BLOCKS_CTE = f"""
b_c AS (SELECT page_id, {HOST} AS host,
               regexp_split_to_array(regexp_replace(html, {q(C.REMOVE_PATTERN)}, ' ', 'g'), {q(C.BLOCK_SPLIT_PATTERN)}) AS parts
        FROM pages),
b_u AS (SELECT page_id, host, unnest(parts) AS frag, generate_subscripts(parts, 1) - 1 AS block_ix FROM b_c),
b_t AS (SELECT page_id, host, block_ix, {html_to_text('frag')} AS text,
               length({html_to_text("array_to_string(regexp_extract_all(frag, " + q(C.LINK_PATTERN) + ", 1), ' ')")}) AS link_chars
        FROM b_u),
blocks AS (SELECT page_id, host, CAST(block_ix AS INTEGER) AS block_ix, text,
                  CAST(length(text) AS INTEGER) AS n_chars, CAST(link_chars AS INTEGER) AS link_chars
           FROM b_t WHERE length(text) > 0)
"""

ORACLE["content_blocks"] = f"WITH {BLOCKS_CTE} SELECT page_id, block_ix, text, n_chars, link_chars FROM blocks"

ORACLE["content_strict"] = f"""
WITH {BLOCKS_CTE},
f AS (SELECT * FROM blocks WHERE n_chars >= {config.STRICT_MIN_CHARS}
      AND link_chars <= n_chars * {config.STRICT_MAX_LINK_DENSITY}),
r AS (SELECT host, text FROM f GROUP BY host, text HAVING count(DISTINCT page_id) > {config.STRICT_MAX_SITE_REPEATS})
SELECT page_id, block_ix, text FROM f WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.host = f.host AND r.text = f.text)
"""

ORACLE["list_cells"] = f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, {q(LIST_PATTERN)}, 1) AS ls FROM pages),
l1 AS (SELECT page_id, unnest(ls) AS list_html, generate_subscripts(ls, 1) - 1 AS list_ix FROM l),
l2 AS (SELECT page_id, list_ix, regexp_extract_all(list_html, {q(ITEM_PATTERN)}, 1) AS items FROM l1),
l3 AS (SELECT page_id, list_ix, unnest(items) AS item_html, generate_subscripts(items, 1) - 1 AS item_ix FROM l2)
SELECT page_id, CAST(list_ix AS INTEGER) AS list_ix, CAST(item_ix AS INTEGER) AS item_ix,
       {html_to_text('item_html')} AS text FROM l3
"""

ORDER_HTML = """'<table class="order"><tr><th>Key</th><th>Customer</th><th>Status &amp; Priority</th></tr><tr><td>'
  || CAST(o_orderkey AS VARCHAR) || '</td><td>' || CAST(o_custkey AS VARCHAR) || '</td><td>' || o_orderstatus
  || ' &amp; ' || o_orderpriority || '</td></tr>' || chr(10) || '<tr><td colspan=2>' || strftime(o_orderdate, '%Y-%m-%d')
  || '</td><th>date</th></tr></table>'"""

ORACLE["table_cells"] = f"""
WITH h AS (SELECT o_orderkey, {ORDER_HTML} AS html FROM orders),
t AS (SELECT o_orderkey, regexp_extract_all(html, {q(TABLE_PATTERN)}, 1) AS ts FROM h),
t1 AS (SELECT o_orderkey, unnest(ts) AS th, generate_subscripts(ts, 1) - 1 AS table_ix FROM t),
r AS (SELECT o_orderkey, table_ix, regexp_extract_all(th, {q(ROW_PATTERN)}, 1) AS rs FROM t1),
r1 AS (SELECT o_orderkey, table_ix, unnest(rs) AS rh, generate_subscripts(rs, 1) - 1 AS row_ix FROM r),
c AS (SELECT o_orderkey, table_ix, row_ix, regexp_extract_all(rh, {q(CELL_PATTERN)}, 1) AS cs FROM r1),
c1 AS (SELECT o_orderkey, table_ix, row_ix, unnest(cs) AS ch, generate_subscripts(cs, 1) - 1 AS cell_ix FROM c)
SELECT o_orderkey, CAST(table_ix AS INTEGER) AS table_ix, CAST(row_ix AS INTEGER) AS row_ix,
       CAST(cell_ix AS INTEGER) AS cell_ix, {html_to_text('ch')} AS text FROM c1
"""

RULES = ", ".join("(" + ", ".join(q(x) for x in r) + ")" for r in T.LANDMARK_RULES)

ORACLE["landmark_fields"] = f"""
WITH {REGISTERED_DOMAIN_CTE},
j AS (SELECT p.page_id, p.html, r.field, r.b, r.e FROM pages p JOIN rd ON p.page_id = rd.page_id
      JOIN (VALUES {RULES}) r(site, field, b, e) ON rd.tld = r.site),
k AS (SELECT page_id, field, html, strpos(html, b) AS bpos, strpos(html, b) + length(b) AS vs, e FROM j),
m AS (SELECT page_id, field, html, bpos, vs, strpos(substr(html, vs), e) AS erel FROM k)
SELECT page_id, field, trim(substr(html, vs, erel - 1)) AS value FROM m WHERE bpos > 0 AND erel > 0
"""

TOKENS = f"regexp_extract_all(text, {q(config.TOKEN_PATTERN)}, 1)"

ORACLE["tokenize"] = f"""
WITH t AS (SELECT doc_id, {TOKENS} AS toks FROM documents)
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(toks, lambda x: x = chr(10))) AS BIGINT) AS n_breaks,
       CAST(coalesce(list_sum(list_transform(toks, lambda x: length(x))), 0) AS BIGINT) AS token_chars
FROM t
"""


def ngram_sql(vocab, n: int) -> str:
    return f"""
WITH t AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
p AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM t),
g AS (SELECT doc_id, toks, i, unnest(range(1, least({n}, len(toks) - i + 1) + 1)) AS k FROM p),
v AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS start, CAST(i - 1 + k AS INTEGER) AS "end",
             lower(array_to_string(list_slice(toks, i, i + k - 1), ' ')) AS value FROM g)
SELECT doc_id, start, "end", value FROM v
WHERE regexp_matches(value, {q(config.DICTIONARY_PREFILTER)}) AND value IN (SELECT * FROM (VALUES {values_list(vocab)}))
"""


ORACLE["dictionary_mentions"] = ngram_sql(T.WORD_VOCAB, 1)
ORACLE["dictionary_ngrams3"] = ngram_sql(T.PHRASE_VOCAB, 3)


def regex_sql(pattern: str, digits: bool = False) -> str:
    extra = ", regexp_replace(value, '[^0-9]', '', 'g') AS digits" if digits else ""
    return f"""
WITH t AS (SELECT doc_id, string_split(regexp_replace(replace(text, chr(1), ''), {q(pattern)},
                  chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts FROM documents),
u AS (SELECT doc_id, parts, unnest(range(2, len(parts), 2)) AS i FROM t),
v AS (SELECT doc_id, CAST(i // 2 - 1 AS BIGINT) AS match_ix,
             CAST(length(array_to_string(list_slice(parts, 1, i - 1), '')) AS BIGINT) AS start,
             parts[i] AS value FROM u)
SELECT doc_id, match_ix, start, start + length(value) AS "end", value{extra} FROM v WHERE length(value) > 0
"""


ORACLE["regex_email"] = regex_sql(M.EMAIL_PATTERN)
ORACLE["regex_phone"] = regex_sql(M.PHONE_PATTERN, digits=True)

ORACLE["merge_site_fields"] = """
WITH c AS (SELECT 'c' || CAST(c_custkey AS VARCHAR) AS doc_id, c_name AS n, printf('%.2f', c_acctbal) AS pr,
                  CAST(c_nationkey AS VARCHAR) AS co, '+1 (555) 01' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS ph,
                  CAST(c_custkey % 50 + 10 AS VARCHAR) AS ag FROM customer),
s AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS doc_id, s_name AS n, printf('%.2f', s_acctbal) AS pr,
             CAST(s_nationkey AS VARCHAR) AS st FROM supplier),
u AS (SELECT doc_id, 'name' AS field, 'inferlink_name' AS source, n AS value FROM c
      UNION ALL SELECT doc_id, 'price', 'inferlink_price', pr FROM c
      UNION ALL SELECT doc_id, 'country', 'inferlink_country', co FROM c
      UNION ALL SELECT doc_id, 'phone', 'inferlink_phone', ph FROM c
      UNION ALL SELECT doc_id, 'age', 'inferlink_age-1', ag FROM c
      UNION ALL SELECT doc_id, 'name', 'inferlink_name', n FROM s
      UNION ALL SELECT doc_id, 'price', 'inferlink_price', pr FROM s
      UNION ALL SELECT doc_id, 'state', 'inferlink_state', st FROM s)
SELECT doc_id, field, source, value FROM u WHERE value IS NOT NULL AND value <> ''
"""


# --- consolidation ------------------------------------------------------------

WS = "[ \\t\\n\\x0B\\f\\r]"


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def py_float_sql(e: str) -> str:
    from fieldloom.functions.text import _PY_FLOAT
    return f"(CASE WHEN regexp_matches({e}, {q(_PY_FLOAT)}) THEN TRY_CAST(trim({e}) AS DOUBLE) END)"


def trunc_sql(e: str) -> str:
    return f"(CASE WHEN NOT isnan({e}) AND abs({e}) < 9.2e18 THEN CAST(trunc({e}) AS BIGINT) END)"


def py2_sql(e: str) -> str:
    s = f"printf('%.12g', {e})"
    return (f"(CASE WHEN isnan({e}) THEN 'nan' WHEN {e} = 'inf'::DOUBLE THEN 'inf' WHEN {e} = '-inf'::DOUBLE THEN '-inf' "
            f"WHEN contains({s}, '.') OR contains({s}, 'e') THEN {s} ELSE {s} || '.0' END)")


def title_case_sql(e: str) -> str:
    parts = f"regexp_extract_all(lower({e}), '([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)', 1)"
    return f"array_to_string(list_transform({parts}, lambda s: upper(substring(s, 1, 1)) || substring(s, 2)), '')"


EVENT_CANDIDATES = """
ev AS (SELECT user_id AS doc_id,
              CASE event_type WHEN 'view' THEN 'age' WHEN 'click' THEN 'weight' WHEN 'purchase' THEN 'name'
                              WHEN 'signup' THEN 'title' ELSE 'price' END AS field,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id AS pos, value AS amount FROM events),
cand AS (SELECT doc_id, field,
                CASE WHEN k % 3 = 0 THEN 'relaxed' ELSE 'strict' END AS tier,
                CASE WHEN k % 3 <> 0 THEN (CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END)
                     ELSE (CASE WHEN k % 2 = 0 THEN 6 ELSE 7 END) END AS pass_no,
                pos,
                CASE WHEN k % 2 = 0 THEN amount / 500.0 END AS probability,
                CASE WHEN k % 2 = 0 THEN -amount / 500.0 ELSE 0.0 END AS rank,
                CASE WHEN k >= 95 THEN TRUE END AS selected,
                CASE field
                  WHEN 'age' THEN (CASE WHEN k % 5 = 0 THEN CAST(k AS VARCHAR) || '-' || CAST(k + 5 AS VARCHAR)
                                        ELSE CAST(k AS VARCHAR) END)
                  WHEN 'weight' THEN CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR)
                       || (CASE k % 4 WHEN 0 THEN ' lbs' WHEN 1 THEN 'kg' WHEN 2 THEN '' ELSE ' kilos' END)
                  WHEN 'name' THEN (CASE k % 3 WHEN 0 THEN 'mary-jane' WHEN 1 THEN 'o''neil' ELSE 'ann  lee' END)
                       || ' ' || CAST(k % 4 AS VARCHAR)
                  WHEN 'title' THEN 'Title ' || CAST(k % 5 AS VARCHAR)
                  ELSE CAST(k AS VARCHAR) END AS value
         FROM ev)
"""

ROUTED = """
rs AS (SELECT *, row_number() OVER (PARTITION BY doc_id, field ORDER BY pass_no, rank, pos) AS rn
       FROM cand WHERE tier = 'strict'),
routed AS (SELECT doc_id, field, tier, pass_no, pos, probability, rank, selected, value,
                  CASE WHEN selected IS NOT NULL OR probability >= 0.5 OR rn = 1 THEN 'strict' ELSE 'relaxed' END AS routed_tier
           FROM rs
           UNION ALL
           SELECT doc_id, field, tier, pass_no, pos, probability, rank, selected, value, 'relaxed' FROM cand WHERE tier <> 'strict')
"""

ORACLE["route_strict_relaxed"] = f"WITH {EVENT_CANDIDATES}, {ROUTED} SELECT pos AS event_id, doc_id, field, routed_tier FROM routed"


def _weight_sql() -> str:
    x = f"lower({strip_sql('value')})"
    lb = f"trim({x}, 's')"

    def after(chars):
        return trunc_sql(py_float_sql(f"trim({lb}, {q(chars)})"))
    bare = trunc_sql(py_float_sql(x))
    return f"""
w1 AS (SELECT *, {x} AS wx, {lb} AS wlb FROM routed WHERE field = 'weight'),
w2 AS (SELECT *, CASE WHEN wx LIKE '%st%' OR regexp_matches(value, '[^\\x00-\\x7F]') THEN NULL
                      WHEN ends_with(wlb, 'lb') THEN {after('lb')} / 2.2
                      WHEN ends_with(wlb, 'pound') THEN {after('pound')} / 2.2
                      WHEN ends_with(wlb, 'kg') THEN CAST({after('kg')} AS DOUBLE)
                      WHEN ends_with(wlb, 'kilo') THEN CAST({after('kilo')} AS DOUBLE)
                      WHEN ends_with(wlb, 'kilogram') THEN CAST({after('kilogram')} AS DOUBLE)
                      WHEN {bare} < 90 THEN CAST({bare} AS DOUBLE) ELSE {bare} / 2.2 END AS kg,
                 NOT ends_with(wlb, 'lb') AND NOT ends_with(wlb, 'pound')
                   AND (ends_with(wlb, 'kg') OR ends_with(wlb, 'kilo') OR ends_with(wlb, 'kilogram')) AS is_int
          FROM w1),
w3 AS (SELECT *, kg IS NOT NULL AND (kg = 0 OR {trunc_sql('kg')} BETWEEN 40 AND 150) AS ok,
              CASE WHEN is_int THEN CAST(CAST(kg AS BIGINT) AS VARCHAR) ELSE {py2_sql('kg')} END AS wtext FROM w2),
nw AS (SELECT doc_id, field, routed_tier, pass_no, rank, pos, ok,
              CASE WHEN ok THEN wtext ELSE '' END AS key, CASE WHEN ok THEN wtext ELSE value END AS name,
              CASE WHEN ok THEN kg END AS num,
              CASE WHEN ok THEN wtext || ' ' || {py2_sql('kg * 2.20462')} END AS search FROM w3)
"""


def _age_sql() -> str:
    head = strip_sql(f"split_part(lower({strip_sql('value')}), '-', 1)")
    n = f"TRY_CAST(regexp_replace({head}, '[^0-9]+', '', 'g') AS BIGINT)"
    return f"""
a1 AS (SELECT *, {n} AS an FROM routed WHERE field = 'age'),
na AS (SELECT doc_id, field, routed_tier, pass_no, rank, pos, (an IS NOT NULL AND an <> 0 AND an BETWEEN 18 AND 60) AS ok,
              CASE WHEN an BETWEEN 18 AND 60 THEN CAST(an AS VARCHAR) ELSE '' END AS key,
              CASE WHEN an BETWEEN 18 AND 60 THEN CAST(an AS VARCHAR) ELSE value END AS name,
              CASE WHEN an BETWEEN 18 AND 60 THEN CAST(an AS DOUBLE) END AS num, CAST(NULL AS VARCHAR) AS search FROM a1)
"""


NORMALIZED = f"""
{_weight_sql()},
{_age_sql()},
nn AS (SELECT doc_id, field, routed_tier, pass_no, rank, pos, TRUE AS ok,
              {title_case_sql(f"regexp_replace(value, '{WS}+', ' ', 'g')")} AS key,
              {title_case_sql(f"regexp_replace(value, '{WS}+', ' ', 'g')")} AS name,
              CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS search FROM routed WHERE field = 'name'),
nt AS (SELECT doc_id, field, routed_tier, pass_no, rank, pos, TRUE AS ok, CAST(NULL AS VARCHAR) AS key, value AS name,
              CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS search FROM routed WHERE field = 'title'),
np AS (SELECT doc_id, field, routed_tier, pass_no, rank, pos, FALSE AS ok, value AS key, value AS name,
              CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS search FROM routed WHERE field = 'price'),
norm AS (SELECT * FROM nw UNION ALL SELECT * FROM na UNION ALL SELECT * FROM nn UNION ALL SELECT * FROM nt
         UNION ALL SELECT * FROM np),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, field, routed_tier, num IS NULL, num,
                                                      CASE WHEN num IS NULL THEN name END
                                        ORDER BY pass_no, rank, pos) AS dn FROM norm),
fields AS (SELECT doc_id, field, routed_tier AS tier, pass_no, rank, pos, key, name, num, search
           FROM ranked WHERE NOT ok OR dn = 1)
"""

ORACLE["consolidate_fields"] = f"""WITH {EVENT_CANDIDATES}, {ROUTED}, {NORMALIZED}
SELECT doc_id, field, tier, pass_no, rank, pos, key, name, num, search FROM fields"""

ORACLE["dedupe_fields"] = f"""WITH {EVENT_CANDIDATES}, {ROUTED}, {NORMALIZED}
SELECT doc_id, field, tier, count(*) AS n_values, count(DISTINCT name) AS n_names FROM fields GROUP BY doc_id, field, tier"""


# --- normalisers ------------------------------------------------------------------

LI = "li AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS q FROM lineitem)"

AGE_TEXT = """CASE WHEN l_linenumber % 4 = 0 THEN CAST(q + 10 AS VARCHAR)
     WHEN l_linenumber % 4 = 1 THEN CAST(q + 10 AS VARCHAR) || '-' || CAST(q + 15 AS VARCHAR)
     WHEN l_linenumber % 4 = 2 THEN ' ' || CAST(q + 5 AS VARCHAR) || ' yo'
     ELSE CAST(q AS VARCHAR) || '.5' END"""

ORACLE["normalize_age"] = f"""
WITH {LI}, r AS (SELECT l_orderkey, l_linenumber, {AGE_TEXT} AS raw FROM li),
a AS (SELECT *, TRY_CAST(regexp_replace({strip_sql(f"split_part(lower({strip_sql('raw')}), '-', 1)")}, '[^0-9]+', '', 'g')
                         AS BIGINT) AS n FROM r)
SELECT l_orderkey, l_linenumber, raw,
       CASE WHEN n BETWEEN 18 AND 60 THEN CAST(n AS VARCHAR) END AS key,
       CASE WHEN n BETWEEN 18 AND 60 THEN CAST(n AS VARCHAR) END AS name,
       CASE WHEN n BETWEEN 18 AND 60 THEN CAST(n AS DOUBLE) END AS num, CAST(NULL AS VARCHAR) AS search FROM a
"""

HEIGHT_TEXT = """CASE WHEN l_linenumber % 5 = 0 THEN CAST(4 + q % 4 AS VARCHAR) || '''' || CAST(l_linenumber + q % 5 AS VARCHAR) || '"'
     WHEN l_linenumber % 5 = 1 THEN CAST(4 + q % 4 AS VARCHAR) || '''' || CAST(l_linenumber + q % 5 AS VARCHAR) || '" - '
          || CAST(4 + q % 4 AS VARCHAR) || '''' || CAST(l_linenumber + q % 5 + 1 AS VARCHAR) || '"'
     WHEN l_linenumber % 5 = 2 THEN CAST(4 + q % 4 AS VARCHAR) || ''''
     WHEN l_linenumber % 5 = 3 THEN CAST(q + 120 AS VARCHAR) || ' cm'
     ELSE CAST(4 + q % 4 AS VARCHAR) || ''' ' || CAST(l_linenumber + q % 5 AS VARCHAR) END"""

ORACLE["normalize_height"] = f"""
WITH {LI}, r AS (SELECT l_orderkey, l_linenumber, {HEIGHT_TEXT} AS raw FROM li),
h AS (SELECT *, string_split({strip_sql(f"split_part({strip_sql('lower(' + strip_sql('raw') + ')')}, '-', 1)")}, '''') AS dims,
             regexp_replace(raw, '[^0-9]+', '', 'g') AS digits FROM r),
c AS (SELECT *, {py_float_sql('dims[1]')} * 30.48 + coalesce({py_float_sql("trim(dims[2], '\"')")}, 0.0) * 2.54 AS cm FROM h),
o AS (SELECT *, len(dims) >= 2 AS foot, cm IS NOT NULL AND (cm = 0 OR {trunc_sql('cm')} BETWEEN 121 AND 214) AS ok FROM c)
SELECT l_orderkey, l_linenumber, raw,
       CASE WHEN foot AND ok THEN {py2_sql('cm')} WHEN NOT foot AND digits = '' THEN '' END AS key,
       CASE WHEN foot AND ok THEN {py2_sql('cm')} WHEN NOT foot AND digits = '' THEN '' END AS name,
       CASE WHEN foot AND ok THEN cm END AS num,
       CASE WHEN foot AND ok THEN {py2_sql('cm')} || ' ' || {py2_sql('cm / 30.48')} || ' ' || {py2_sql('cm / 2.54')}
            WHEN NOT foot AND digits = '' THEN ' None None' END AS search
FROM o
"""

WEIGHT_TEXT = """CASE WHEN l_linenumber % 7 = 0 THEN CAST(q * 4 AS VARCHAR) || ' lbs'
     WHEN l_linenumber % 7 = 1 THEN CAST(q + 30 AS VARCHAR) || 'kg'
     WHEN l_linenumber % 7 = 2 THEN CAST(q + 30 AS VARCHAR) || ' kilos'
     WHEN l_linenumber % 7 = 3 THEN CAST(q * 4 AS VARCHAR)
     WHEN l_linenumber % 7 = 4 THEN CAST(q + 40 AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR)
     WHEN l_linenumber % 7 = 5 THEN CAST(q % 12 AS VARCHAR) || ' stone'
     ELSE CAST(q * 3 AS VARCHAR) || ' pounds' END"""


def weight_fv_sql(src: str, raw: str, keep: str) -> str:
    """CTEs ``w1..w3`` computing weight kg / text / ok over ``src``."""
    x = f"lower({strip_sql(raw)})"
    lb = f"trim({x}, 's')"

    def after(chars):
        return trunc_sql(py_float_sql(f"trim(wlb, {q(chars)})"))
    bare = trunc_sql(py_float_sql("wx"))
    return f"""
w1 AS (SELECT {keep}, {raw} AS wraw, {x} AS wx, {lb} AS wlb FROM {src}),
w2 AS (SELECT *, CASE WHEN wx LIKE '%st%' OR regexp_matches(wraw, '[^\\x00-\\x7F]') THEN NULL
                      WHEN ends_with(wlb, 'lb') THEN {after('lb')} / 2.2
                      WHEN ends_with(wlb, 'pound') THEN {after('pound')} / 2.2
                      WHEN ends_with(wlb, 'kg') THEN CAST({after('kg')} AS DOUBLE)
                      WHEN ends_with(wlb, 'kilo') THEN CAST({after('kilo')} AS DOUBLE)
                      WHEN ends_with(wlb, 'kilogram') THEN CAST({after('kilogram')} AS DOUBLE)
                      WHEN {bare} < 90 THEN CAST({bare} AS DOUBLE) ELSE {bare} / 2.2 END AS kg,
                 NOT ends_with(wlb, 'lb') AND NOT ends_with(wlb, 'pound')
                   AND (ends_with(wlb, 'kg') OR ends_with(wlb, 'kilo') OR ends_with(wlb, 'kilogram')) AS is_int
          FROM w1),
w3 AS (SELECT *, kg IS NOT NULL AND (kg = 0 OR {trunc_sql('kg')} BETWEEN 40 AND 150) AS ok,
              CASE WHEN is_int THEN CAST(CAST(kg AS BIGINT) AS VARCHAR) ELSE {py2_sql('kg')} END AS wtext FROM w2)
"""


ORACLE["normalize_weight"] = f"""
WITH {LI}, r AS (SELECT l_orderkey, l_linenumber, {WEIGHT_TEXT} AS raw FROM li),
{weight_fv_sql('r', 'raw', 'l_orderkey, l_linenumber, raw')}
SELECT l_orderkey, l_linenumber, raw, CASE WHEN ok THEN wtext END AS key, CASE WHEN ok THEN wtext END AS name,
       CASE WHEN ok THEN kg END AS num, CASE WHEN ok THEN wtext || ' ' || {py2_sql('kg * 2.20462')} END AS search
FROM w3
"""

ORACLE["normalize_name"] = f"""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name || '  ' || lower(p_type)
                                  ELSE 'o''' || p_name || '-' || lower(p_brand) || chr(9) || '3cd' END AS raw FROM part)
SELECT p_partkey, raw, {title_case_sql(f"regexp_replace(raw, '{WS}+', ' ', 'g')")} AS key,
       {title_case_sql(f"regexp_replace(raw, '{WS}+', ' ', 'g')")} AS name FROM r
"""

ORACLE["normalize_city"] = f"""
WITH g AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
j AS (SELECT c_custkey, lower(n_name) AS v, CASE WHEN c_custkey % 4 <> 0 THEN r_name END AS st, c_mktsegment AS co,
             c_acctbal / 100 AS lon, CAST(c_custkey % 180 AS DOUBLE) - 90.5 AS lat
      FROM customer JOIN g ON c_nationkey = n_nationkey)
SELECT c_custkey,
       CASE WHEN st IS NOT NULL AND co IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL
            THEN v || ':' || st || ':' || co || ':' || {py2_sql('lon')} || ':' || {py2_sql('lat')} ELSE v END AS key,
       v AS name FROM j
"""

_PAIRS = ["('kg','lb')", "('lb','kg')", "('ft','in')", "('ft','cm')", "('in','ft')", "('in','cm')", "('cm','ft')",
          "('cm','in')", "('kg','kg')", "('ft','lb')"]

ORACLE["unit_convert"] = f"""
WITH p AS (SELECT * FROM (VALUES {", ".join(f"({i}, {p[1:-1]})" for i, p in enumerate(_PAIRS))}) v(ix, from_unit, to_unit)),
l AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, (l_orderkey + l_linenumber) % 10 AS ix FROM lineitem)
SELECT l_orderkey, l_linenumber, from_unit, to_unit,
       round(CASE WHEN from_unit = to_unit THEN v
                  WHEN from_unit = 'kg' AND to_unit = 'lb' THEN v * 2.20462
                  WHEN from_unit = 'lb' AND to_unit = 'kg' THEN v / 2.20462
                  WHEN from_unit = 'ft' AND to_unit = 'in' THEN v * 12
                  WHEN from_unit = 'ft' AND to_unit = 'cm' THEN v * 30.48
                  WHEN from_unit = 'in' AND to_unit = 'ft' THEN v / 12
                  WHEN from_unit = 'in' AND to_unit = 'cm' THEN v * 2.54
                  WHEN from_unit = 'cm' AND to_unit = 'ft' THEN v / 30.48
                  WHEN from_unit = 'cm' AND to_unit = 'in' THEN v / 2.54 END, 6) AS converted
FROM l JOIN p USING (ix)
"""

MEASURE_TEXT = """CASE WHEN l_linenumber % 4 = 0 THEN 'she is ' || CAST(4 + q % 4 AS VARCHAR) || '''' || CAST(l_linenumber + q % 5 AS VARCHAR)
                                           || '" and ' || CAST(q * 4 AS VARCHAR) || ' lbs'
     WHEN l_linenumber % 4 = 1 THEN 'height ' || CAST(q + 150 AS VARCHAR) || ' cm'
     WHEN l_linenumber % 4 = 2 THEN 'weight ' || CAST(q + 40 AS VARCHAR) || ' kg, or ' || CAST(q * 3 AS VARCHAR) || ' Pounds'
     ELSE 'no measurements here' END"""

ORACLE["height_weight_split"] = f"""
WITH {LI}, t AS (SELECT l_orderkey, l_linenumber, {MEASURE_TEXT} AS text FROM li),
f AS (SELECT l_orderkey, l_linenumber, text, regexp_extract_all(text, {q(M.FOOT_PATTERN)}, 0) AS feet FROM t),
c AS (SELECT l_orderkey, l_linenumber,
             list_concat(list_transform(feet, lambda m: CAST(round(CAST(regexp_extract(m, {q(M.FOOT_PATTERN)}, 1) AS INTEGER) * 30.48
                                          + coalesce(TRY_CAST(regexp_extract(m, {q(M.FOOT_PATTERN)}, 2) AS INTEGER), 0) * 2.54) AS INTEGER)),
                         list_transform(regexp_extract_all(text, {q(M.CM_PATTERN)}, 1), lambda x: CAST(x AS INTEGER))) AS cm,
             list_concat(list_transform(regexp_extract_all(text, {q(M.LB_PATTERN)}, 1), lambda x: CAST(round(CAST(x AS INTEGER) / 2.20462) AS INTEGER)),
                         list_transform(regexp_extract_all(text, {q(M.KG_PATTERN)}, 1), lambda x: CAST(x AS INTEGER))) AS kg
      FROM f)
SELECT l_orderkey, l_linenumber, 'height' AS field, CAST(len(cm) AS BIGINT) AS n_values, cm[1] AS first_value FROM c WHERE len(cm) > 0
UNION ALL
SELECT l_orderkey, l_linenumber, 'weight', CAST(len(kg) AS BIGINT), kg[1] FROM c WHERE len(kg) > 0
"""

_DATE_PARSE = ["%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%m/%d/%Y", "%B %d, %Y", "%d %B %Y", "%b %d, %Y"]

ORACLE["posting_date"] = f"""
WITH o AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                                  WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
                                                  ELSE strftime(o_orderdate, '%B %-d, %Y') END AS raw FROM orders)
SELECT o_orderkey, raw,
       strftime(coalesce({", ".join(f"try_strptime({strip_sql('raw')}, {q(f)})" for f in _DATE_PARSE)}), '%Y-%m-%dT%H:%M:%S') AS iso
FROM o
"""

ORACLE["canonicalize_vocab"] = f"""
WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS ws FROM part),
u AS (SELECT p_partkey, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS word_ix FROM p),
m AS (SELECT p_partkey, CAST(word_ix AS INTEGER) AS word_ix,
             substr(w, 1, CAST(p_partkey % length(w) AS INTEGER)) || substr(w, CAST(p_partkey % length(w) AS INTEGER) + 2) AS raw FROM u),
v AS (SELECT * FROM (VALUES {", ".join(f"({q(w)}, {i})" for i, w in enumerate(T.PART_WORDS))}) v(entry, ref_ix)),
s AS (SELECT DISTINCT raw FROM m),
sc AS (SELECT raw, entry, ref_ix, jaro_similarity(lower(trim(raw)), entry) AS score FROM s CROSS JOIN v),
b AS (SELECT raw, entry, score, row_number() OVER (PARTITION BY raw ORDER BY score DESC, ref_ix) AS rn
      FROM sc WHERE score >= 0.9)
SELECT m.p_partkey, m.word_ix, m.raw, b.entry AS canonical, round(b.score, 6) AS score
FROM m LEFT JOIN (SELECT * FROM b WHERE rn = 1) b ON m.raw = b.raw
"""

PHRASE_WEIGHTS = ", ".join(f"({q(p)}, CAST({T.PHRASE_WEIGHTS[p]} AS DOUBLE))" for p in T.PHRASE_VOCAB)

PHRASE_SPANS = f"""
t AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
p AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM t),
g AS (SELECT doc_id, toks, i, unnest(range(1, least(3, len(toks) - i + 1) + 1)) AS k FROM p),
v AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS start, CAST(i - 1 + k AS INTEGER) AS "end",
             array_to_string(list_slice(toks, i, i + k - 1), ' ') AS txt FROM g),
spans AS (SELECT v.doc_id, v.start, v."end", v.txt, w.weight FROM v JOIN (VALUES {PHRASE_WEIGHTS}) w(entry, weight)
          ON lower(v.txt) = w.entry WHERE regexp_matches(lower(v.txt), {q(config.DICTIONARY_PREFILTER)}))
"""

ORACLE["annotate_tokens"] = f"""
WITH {PHRASE_SPANS},
a AS (SELECT doc_id, start, "end", unnest(range(start, "end")) AS pos FROM spans)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, 'phrase' AS type, CAST(pos - start AS INTEGER) AS "offset",
       CASE WHEN pos = start THEN CAST("end" - start AS INTEGER) END AS length, start FROM a
"""

ORACLE["rebuild_spans"] = f"""
WITH {PHRASE_SPANS}
SELECT s.doc_id, s.start, s."end", trim(array_to_string(list_slice(t.toks, s.start + 1, s."end"), ' ')) AS value,
       s.weight AS probability
FROM spans s JOIN t ON s.doc_id = t.doc_id WHERE s.weight > 0.2
"""

ORACLE["score_mentions"] = """
WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM u GROUP BY label, i),
w AS (SELECT label, list(x ORDER BY i) AS w FROM c GROUP BY label),
s AS (SELECT e.vec_id, e.label, list_dot_product(CAST(e.embedding AS DOUBLE[]), w.w) AS d
      FROM embeddings e JOIN w ON e.label = w.label)
SELECT vec_id, label, round(1.0 / (1.0 + exp(-d)), 6) AS score FROM s
"""

ORACLE["consistent_locations"] = """
WITH g AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT c_custkey AS doc_id, 'state' AS type, n_name AS value, 'title' AS source, CAST(0.6 AS DOUBLE) AS probability
      FROM customer JOIN g ON c_nationkey = n_nationkey
      UNION ALL SELECT c_custkey, 'state', n2.n_name, 'text', CAST(0.8 AS DOUBLE)
      FROM customer JOIN nation n2 ON n2.n_nationkey = (c_nationkey + 7) % 25
      UNION ALL SELECT c_custkey, 'country', r_name, 'text', CAST(0.5 AS DOUBLE) FROM customer JOIN g ON c_nationkey = n_nationkey),
gz AS (SELECT 'state' AS type_a, n_name AS value_a, 'country' AS type_b, r_name AS value_b FROM g
       UNION ALL SELECT 'country', r_name, 'state', n_name FROM g),
pres AS (SELECT DISTINCT doc_id, type, value FROM m),
p AS (SELECT a.doc_id, a.type, a.value, count(*) AS n FROM pres a
      JOIN gz ON gz.type_a = a.type AND gz.value_a = a.value
      JOIN pres b ON b.doc_id = a.doc_id AND b.type = gz.type_b AND b.value = gz.value_b
      GROUP BY a.doc_id, a.type, a.value),
s AS (SELECT m.doc_id, m.type, m.value,
             (CASE m.source WHEN 'title' THEN CAST(1.0 AS DOUBLE) WHEN 'text' THEN CAST(0.5 AS DOUBLE) ELSE 0.0 END) * m.probability
             + coalesce(p.n, 0) AS score
      FROM m LEFT JOIN p ON m.doc_id = p.doc_id AND m.type = p.type AND m.value = p.value),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, type ORDER BY score DESC, value) AS rn FROM s)
SELECT doc_id AS c_custkey, type, value, round(score, 6) AS score FROM b WHERE rn = 1
"""


# --- flagship ----------------------------------------------------------------------

ORACLE["assemble_documents"] = f"""
WITH {BLOCKS_CTE},
f AS (SELECT * FROM blocks WHERE n_chars >= {config.STRICT_MIN_CHARS}
      AND link_chars <= n_chars * {config.STRICT_MAX_LINK_DENSITY}),
r AS (SELECT host, text FROM f GROUP BY host, text HAVING count(DISTINCT page_id) > {config.STRICT_MAX_SITE_REPEATS}),
sb AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.host = f.host AND r.text = f.text)),
st AS (SELECT page_id, string_agg(text, chr(10) ORDER BY block_ix) AS text FROM sb GROUP BY page_id),
rt AS (SELECT page_id, string_agg(text, chr(10) ORDER BY block_ix) AS text FROM blocks GROUP BY page_id),
segs AS (SELECT page_id, 'content_strict' AS segment, text FROM st WHERE text <> ''
         UNION ALL SELECT page_id, 'content_relaxed', text FROM rt WHERE text <> ''),
ttl AS (SELECT page_id, nullif(regexp_extract(html, {q(config.TITLE_PATTERN)}, 1), '') AS title FROM pages),
tk AS (SELECT page_id, segment, text, {TOKENS} AS toks FROM segs),
p1 AS (SELECT page_id, segment, toks, unnest(range(1, len(toks) + 1)) AS i FROM tk),
p2 AS (SELECT page_id, segment, toks, i, unnest(range(1, least(3, len(toks) - i + 1) + 1)) AS k FROM p1),
p3 AS (SELECT page_id, segment, i - 1 AS start, array_to_string(list_slice(toks, i, i + k - 1), ' ') AS txt FROM p2),
spans AS (SELECT p3.page_id, p3.segment, p3.start, trim(p3.txt) AS value, w.weight AS probability
          FROM p3 JOIN (VALUES {PHRASE_WEIGHTS}) w(entry, weight) ON lower(p3.txt) = w.entry
          WHERE regexp_matches(lower(p3.txt), {q(config.DICTIONARY_PREFILTER)}) AND w.weight > {config.SPAN_PROBABILITY}),
em1 AS (SELECT page_id, segment, string_split(regexp_replace(replace(text, chr(1), ''), {q(M.EMAIL_PATTERN)},
               chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts FROM segs),
em2 AS (SELECT page_id, segment, parts, unnest(range(2, len(parts), 2)) AS i FROM em1),
emails AS (SELECT page_id, segment, length(array_to_string(list_slice(parts, 1, i - 1), '')) AS start, parts[i] AS value
           FROM em2 WHERE length(parts[i]) > 0),
cand AS (
  SELECT page_id AS doc_id, 'phrase' AS field, CASE WHEN segment = 'content_strict' THEN 'strict' ELSE 'relaxed' END AS tier,
         CASE WHEN segment = 'content_strict' THEN 1 ELSE 6 END AS pass_no, -probability AS rank, start AS pos,
         value, probability FROM spans
  UNION ALL
  SELECT page_id, 'email', CASE WHEN segment = 'content_strict' THEN 'strict' ELSE 'relaxed' END,
         CASE WHEN segment = 'content_strict' THEN 2 ELSE 7 END, 0.0, start, value, NULL FROM emails
  UNION ALL SELECT page_id, 'title', 'strict', 3, 0.0, 0, title, NULL FROM ttl WHERE title IS NOT NULL
  UNION ALL SELECT page_id, 'title', 'relaxed', 4, 0.0, 0, title, NULL FROM ttl WHERE title IS NOT NULL
  UNION ALL SELECT page_id, 'description', 'strict', 5, 0.0, 0, text, NULL FROM segs WHERE segment = 'content_strict'
  UNION ALL SELECT page_id, 'description', 'relaxed', 8, 0.0, 0, text, NULL FROM segs WHERE segment = 'content_relaxed'),
rs AS (SELECT *, row_number() OVER (PARTITION BY doc_id, field ORDER BY pass_no, rank, pos) AS rn FROM cand WHERE tier = 'strict'),
routed AS (SELECT doc_id, field, pass_no, rank, pos, value,
                  CASE WHEN probability >= 0.5 OR rn = 1 THEN 'strict' ELSE 'relaxed' END AS rtier FROM rs
           UNION ALL SELECT doc_id, field, pass_no, rank, pos, value, 'relaxed' FROM cand WHERE tier <> 'strict'),
dd AS (SELECT *, CASE WHEN field IN ('title', 'description')
                      THEN row_number() OVER (PARTITION BY doc_id, field, rtier, value ORDER BY pass_no, rank, pos)
                      ELSE 1 END AS dn FROM routed),
fields AS (SELECT * FROM dd WHERE dn = 1),
agg AS (SELECT doc_id, count(DISTINCT field) AS n_fields,
               arg_min(CASE WHEN field = 'title' AND rtier = 'strict' THEN value END, (pass_no, rank, pos))
                 FILTER (WHERE field = 'title' AND rtier = 'strict') AS title,
               count(*) FILTER (WHERE field = 'description' AND rtier = 'strict') AS n_desc_strict,
               count(*) FILTER (WHERE field = 'description' AND rtier = 'relaxed') AS n_desc_relaxed,
               count(*) FILTER (WHERE field = 'phrase' AND rtier = 'strict') AS n_phrase_strict,
               count(*) FILTER (WHERE field = 'phrase' AND rtier = 'relaxed') AS n_phrase_relaxed,
               arg_min(value, (pass_no, rank, pos)) FILTER (WHERE field = 'phrase' AND rtier = 'strict') AS top_phrase,
               count(*) FILTER (WHERE field = 'email' AND rtier = 'relaxed') AS n_email_relaxed
        FROM fields GROUP BY doc_id)
SELECT p.page_id, CAST(coalesce(a.n_fields, 0) AS BIGINT) AS n_fields, a.title,
       CAST(coalesce(a.n_desc_strict, 0) AS BIGINT) AS n_desc_strict, CAST(coalesce(a.n_desc_relaxed, 0) AS BIGINT) AS n_desc_relaxed,
       CAST(coalesce(a.n_phrase_strict, 0) AS BIGINT) AS n_phrase_strict,
       CAST(coalesce(a.n_phrase_relaxed, 0) AS BIGINT) AS n_phrase_relaxed, a.top_phrase,
       CAST(coalesce(a.n_email_relaxed, 0) AS BIGINT) AS n_email_relaxed
FROM pages p LEFT JOIN agg a ON p.page_id = a.doc_id
"""

# --- queries with constants written out -----------------------------------------

ORACLE["name_regex"] = r"""
WITH t AS (SELECT c_custkey, 'Hello. My  name IS ' || c_mktsegment || '-' || CAST(c_custkey AS VARCHAR) || ' and my name is x'
                  || CAST(c_nationkey AS VARCHAR) || '!' AS text FROM customer),
m AS (SELECT c_custkey, regexp_extract_all(text, '(?i)my[ \t\n]+name[ \t\n]+is[ \t\n]+([-a-z0-9@$!]+)', 1) AS v FROM t)
SELECT c_custkey, CAST(unnest(range(len(v))) AS BIGINT) AS match_ix, unnest(v) AS value FROM m
"""

ORACLE["odd_hosts"] = r"""
WITH r AS (SELECT page_id, url, regexp_replace(url, '^[a-z]+://', '') AS rest FROM pages),
u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'http://my_site.' || rest WHEN 1 THEN 'HTTPS://User:pw@' || rest || ' x|y'
        WHEN 2 THEN 'http://' || regexp_extract(rest, '^[^/]+') || ':8080/a b' WHEN 3 THEN url ELSE rest END AS url FROM r)
SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host FROM u
"""

ORACLE["equal_seq_rows"] = """
SELECT user_id AS doc_id, 'strict' AS tier, count(*) AS n_values FROM events GROUP BY user_id
"""

ORACLE["normalize_custom_ranges"] = """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'age' WHEN 1 THEN 'years' WHEN 2 THEN 'label' ELSE 'code' END AS field,
       CASE WHEN l_linenumber % 4 = 0 AND q BETWEEN 1 AND 30 THEN CAST(q AS VARCHAR)
            WHEN l_linenumber % 4 = 1 AND q BETWEEN 10 AND 99 THEN CAST(q AS VARCHAR)
            WHEN l_linenumber % 4 = 3 AND q <> 7 THEN 'q' || CAST(q AS VARCHAR) END AS name
FROM li
"""

ORACLE["normalize_weight_stone"] = """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) % 15 AS q FROM lineitem),
k AS (SELECT *, CAST(14 * q + l_linenumber AS BIGINT) / CAST(2.2 AS DOUBLE) AS kg FROM li)
SELECT l_orderkey, l_linenumber,
       CAST(q AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN ' stone ' ELSE 'st ' END || CAST(l_linenumber AS VARCHAR)
         || CASE WHEN l_linenumber % 3 = 0 THEN 'lbs' ELSE 'lb' END AS value,
       CASE WHEN trunc(kg) BETWEEN 40 AND 150 THEN round(kg, 6) END AS kg
FROM k
"""

ORACLE["canonicalize_phrases"] = """
WITH p AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part),
m AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN w1 ELSE substr(w1, 1, 1) || substr(w1, 3) END AS a1,
             CASE WHEN p_partkey % 3 = 0 THEN w1 ELSE w2 END AS a2 FROM p),
v AS (SELECT * FROM (VALUES ('red', 'ring', 0), ('blue', 'bolt', 1), ('old', 'gear', 2), ('new', 'rod', 3), ('hot', 'plate', 4),
                            ('cold', 'anvil', 5), ('large', 'gizmo', 6), ('small', 'widget', 7)) v(b1, b2, ref_ix)),
j AS (SELECT DISTINCT a1, a2, b1, b2, ref_ix, jaro_similarity(a1, b1) AS x11, jaro_similarity(a1, b2) AS x12,
             jaro_similarity(a2, b1) AS x21, jaro_similarity(a2, b2) AS x22 FROM m CROSS JOIN v),
t AS (SELECT a1, a2, b1, b2, ref_ix, CASE WHEN x11 >= 0.8 THEN x11 ELSE 0 END AS s11, CASE WHEN x12 >= 0.8 THEN x12 ELSE 0 END AS s12,
             CASE WHEN x21 >= 0.8 THEN x21 ELSE 0 END AS s21, CASE WHEN x22 >= 0.8 THEN x22 ELSE 0 END AS s22 FROM j),
g AS (SELECT *, greatest(s11, s12, s21, s22) AS top FROM t),
d AS (SELECT *, s11 = top OR (s12 < top AND s21 < top) AS straight FROM g),
c AS (SELECT a1, a2, b1, b2, ref_ix, CASE WHEN straight THEN s11 + s22 ELSE s12 + s21 END AS s,
             CASE WHEN straight THEN CAST(s11 > 0 AS INTEGER) + CAST(s22 > 0 AS INTEGER)
                  ELSE CAST(s12 > 0 AS INTEGER) + CAST(s21 > 0 AS INTEGER) END AS n FROM d),
e AS (SELECT a1, a2, b1 || ' ' || b2 AS canonical, s / (4 - n) AS score,
             row_number() OVER (PARTITION BY a1, a2 ORDER BY s / (4 - n) DESC, ref_ix) AS rn FROM c WHERE s / (4 - n) >= 0.8)
SELECT m.p_partkey, m.a1 || ' ' || m.a2 AS raw, e.canonical, round(e.score, 6) AS score
FROM m LEFT JOIN (SELECT * FROM e WHERE rn = 1) e ON m.a1 = e.a1 AND m.a2 = e.a2
"""

ORACLE["regex_age"] = r"""
WITH n AS (SELECT c_custkey, c_custkey % 120 AS n FROM customer),
t AS (SELECT c_custkey, 'Aged: ' || CAST(n AS VARCHAR) || ' or ' || CAST(n + 3 AS VARCHAR)
             || CASE WHEN n % 2 = 0 THEN ' yo, page 44 years old' ELSE 'yrs and age 77x' END AS text FROM n),
m AS (SELECT c_custkey, regexp_extract_all(text,
             '(?i)\b(?:age|aged)[ :]+[1-9][0-9]\b|\b[1-9][0-9] ?(?:yo|y/o|yrs|years old)\b') AS v FROM t)
SELECT c_custkey, CAST(unnest(range(len(v))) AS BIGINT) AS match_ix, unnest(v) AS value FROM m
"""

ORACLE["blank_and_rename"] = "SELECT c_custkey AS cdr_id, '...' AS crawl_data, '...' AS extracted_metadata FROM customer"

ORACLE["parse_props"] = """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE 'good' END AS side FROM events
"""

ORACLE["letters_and_digits"] = """
WITH t AS (SELECT p_partkey, p_brand || ' / ' || p_type || ' é ' || CAST(p_size AS VARCHAR) AS text FROM part)
SELECT p_partkey, regexp_replace(text, '[^A-Za-z]+', '', 'g') AS letters, regexp_replace(text, '[^0-9]+', '', 'g') AS digits FROM t
"""

ORACLE["measure_lists"] = """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN q * 10 BETWEEN 121 AND 214 THEN q * 10 WHEN q * 7 BETWEEN 121 AND 214 THEN q * 7
                 WHEN q * 3 BETWEEN 121 AND 214 THEN q * 3 END AS DOUBLE) AS cm,
       CAST(CASE WHEN q * 5 BETWEEN 40 AND 150 THEN q * 5 WHEN q * 3 BETWEEN 40 AND 150 THEN q * 3
                 WHEN q BETWEEN 40 AND 150 THEN q END AS DOUBLE) AS kg
FROM li
"""

ORACLE["color_vocabularies"] = """
WITH w AS (SELECT ['blu', 'sapphire', 'grey', 'blond', 'flaxen', 'ginger', 'platnum', 'hazel', 'Raven ', 'brwn', 'none'] AS words,
                  ['eye_color', 'hair_color', 'price'] AS fields),
p AS (SELECT p_partkey, fields[p_size % 3 + 1] AS field, words[p_partkey % 11 + 1] AS value FROM part, w),
r AS (SELECT * FROM (VALUES ('eye_color', 'amber', 'amber', 0), ('eye_color', 'blue', 'blue', 1), ('eye_color', 'blue', 'azure', 1),
  ('eye_color', 'blue', 'sapphire', 1), ('eye_color', 'brown', 'brown', 2), ('eye_color', 'gray', 'gray', 3), ('eye_color', 'gray', 'grey', 3),
  ('eye_color', 'green', 'green', 4), ('eye_color', 'hazel', 'hazel', 5), ('eye_color', 'violet', 'violet', 6),
  ('hair_color', 'blonde', 'blonde', 0), ('hair_color', 'blonde', 'blond', 0), ('hair_color', 'blonde', 'flaxen', 0),
  ('hair_color', 'blonde', 'fair', 0), ('hair_color', 'brown', 'brown', 1), ('hair_color', 'brown', 'brunette', 1),
  ('hair_color', 'chestnut', 'chestnut', 2), ('hair_color', 'black', 'black', 3), ('hair_color', 'black', 'raven', 3),
  ('hair_color', 'auburn', 'auburn', 4), ('hair_color', 'red', 'red', 5), ('hair_color', 'red', 'redhead', 5),
  ('hair_color', 'red', 'ginger', 5), ('hair_color', 'gray', 'gray', 6), ('hair_color', 'gray', 'platinum', 6),
  ('hair_color', 'gray', 'silver', 6), ('hair_color', 'white', 'white', 7)) r(field, canonical, synonym, ix)),
s AS (SELECT DISTINCT p.field, p.value, r.canonical, r.ix, jaro_similarity(lower(trim(p.value)), r.synonym) AS score
      FROM p JOIN r ON p.field = r.field),
b AS (SELECT *, row_number() OVER (PARTITION BY field, value ORDER BY score DESC, ix) AS rn FROM s WHERE score >= 0.9)
SELECT p.p_partkey, p.field, p.value, b.canonical FROM p LEFT JOIN (SELECT * FROM b WHERE rn = 1) b ON p.field = b.field AND p.value = b.value
"""

ORACLE["nested_tables"] = """
SELECT o_orderkey, c.table_ix, c.row_ix, c.cell_ix,
       CASE c.what WHEN 'k' THEN 'K' || CAST(o_orderkey AS VARCHAR) WHEN 's' THEN 'in ' || o_orderstatus
                   WHEN 'p' THEN 'last ' || o_orderpriority ELSE c.what END AS text
FROM orders CROSS JOIN (VALUES (0, 0, 0, 'k'), (0, 0, 1, 'after'), (0, 1, 0, 'p'), (1, 0, 0, 's'), (1, 1, 0, 'second'))
     c(table_ix, row_ix, cell_ix, what)
"""


# --- context scores, token vectors, joint places -------------------------------------

# The vocabulary of score_context, written out: three-token phrases and their parts.
ORACLE["score_context"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '(\n|[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r])', 1) AS toks FROM documents),
p AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM t),
g AS (SELECT doc_id, toks, i, unnest(range(1, least(3, len(toks) - i + 1) + 1)) AS k FROM p),
s AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS start, CAST(i - 1 + k AS INTEGER) AS "end", lower(array_to_string(toks[i:i + k - 1], ' ')) AS field,
             toks[greatest(i - 2, 1):i + k + 1] AS ctx FROM g
      WHERE lower(array_to_string(toks[i:i + k - 1], ' ')) IN ('mit license', 'apache license', 'general public license', 'gnu general public',
            'released under the', 'of the', 'de la', 'in the', 'und der')),
c AS (SELECT doc_id, start, "end", field, unnest(ctx) AS tok FROM s),
v AS (SELECT c.*, e.embedding FROM c JOIN embeddings e
      ON e.vec_id < 500 AND e.vec_id = CAST('0x' || substr(md5(lower(tok)), 1, 7) AS BIGINT) % 500),
u AS (SELECT doc_id, start, "end", field, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM v),
m AS (SELECT doc_id, start, "end", field, d, avg(CAST(x AS DOUBLE)) AS x FROM u GROUP BY ALL),
tr AS (SELECT m.field, l.quality AS y, d, avg(m.x) AS x FROM m JOIN labels l ON m.doc_id = l.doc_id
       WHERE m.doc_id % 5 <> 0 AND l.quality IN (0, 1) GROUP BY ALL),
w AS (SELECT a.field, a.d, a.x - b.x AS w, (b.x * b.x - a.x * a.x) / 2 AS b FROM tr a JOIN tr b ON a.field = b.field AND a.d = b.d AND a.y = 1 AND b.y = 0)
SELECT doc_id, start, "end", m.field, round(1.0 / (1.0 + exp(-(sum(m.x * w.w) + sum(w.b)))), 6) AS probability
FROM m JOIN w ON m.field = w.field AND m.d = w.d WHERE m.doc_id % 5 = 0 GROUP BY doc_id, start, "end", m.field
"""

ORACLE["random_index_vectors"] = r"""
WITH t AS (SELECT row_number() OVER () AS r, regexp_extract_all(text, '(\n|[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r])', 1) AS toks FROM documents),
p AS (SELECT r, lower(unnest(toks)) AS token, generate_subscripts(toks, 1) AS i FROM t),
pr AS (SELECT a.token, b.token AS other FROM p a JOIN (VALUES (-2), (-1), (1), (2)) o(k) ON true JOIN p b ON b.r = a.r AND b.i = a.i + o.k),
co AS (SELECT token, other, count(*) AS c FROM pr GROUP BY ALL),
ix AS (SELECT DISTINCT other, md5(other) AS h FROM co),
nz AS (SELECT other, CAST('0x' || substr(h, 1 + 3 * j, 3) AS INT) % 32 AS d, 1 - 2 * (CAST('0x' || substr(h, 25 + j, 1) AS INT) % 2) AS s
       FROM ix, (VALUES (0), (1)) v(j)),
x AS (SELECT token, d, sum(c * s) AS x FROM co JOIN nz ON co.other = nz.other GROUP BY ALL),
n AS (SELECT token, sum(c) AS n FROM co GROUP BY token),
f AS (SELECT n.token, n.n, dd.d, coalesce(x.x, 0) AS x FROM n CROSS JOIN (SELECT unnest(range(32)) AS d) dd LEFT JOIN x ON x.token = n.token AND x.d = dd.d)
SELECT token, CAST(any_value(n) AS BIGINT) AS n, string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d) AS vec FROM f GROUP BY token
"""

ORACLE["joint_locations"] = """
WITH pl AS (SELECT s_suppkey, s_name AS city, n_name AS state, r_name AS country FROM supplier
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
nm AS (SELECT *, CASE WHEN s_suppkey % 3 = 0 THEN 'old ' || city ELSE city END AS said FROM pl),
m AS (SELECT c_custkey AS doc_id, 'city' AS type, said AS value, 1.0 * 0.4 AS w FROM customer JOIN nm ON s_suppkey = c_custkey % 10 + 1
      UNION ALL SELECT c_custkey, 'city', said, 0.5 * 0.9 FROM customer JOIN nm ON s_suppkey = (c_custkey * 7 + 3) % 10 + 1
      UNION ALL SELECT c_custkey, 'state', n_name, 0.5 * 0.5 FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL SELECT c_custkey, 'country', country, 0.5 * 0.7 FROM customer JOIN nm ON s_suppkey = c_custkey % 10 + 1),
f AS (SELECT DISTINCT doc_id, type, value, value AS form FROM m
      UNION SELECT DISTINCT doc_id, type, value, substr(value, 5) FROM m WHERE type = 'city' AND value LIKE 'old %'),
g AS (SELECT 'city' AS ta, city AS va, 'state' AS tb, state AS vb FROM pl UNION SELECT 'city', city, 'country', country FROM pl
      UNION SELECT 'state', state, 'country', country FROM pl),
pr AS (SELECT DISTINCT a.doc_id, a.type AS ta, a.value AS va, b.type AS tb, b.value AS vb FROM f a JOIN g ON g.ta = a.type AND g.va = a.form
       JOIN f b ON b.doc_id = a.doc_id AND b.type = g.tb AND b.form = g.vb),
ends AS (SELECT doc_id, ta AS type, va AS value FROM pr UNION ALL SELECT doc_id, tb, vb FROM pr),
k AS (SELECT doc_id, type, value, count(*) AS n FROM ends GROUP BY ALL),
s AS (SELECT m.doc_id, m.type, m.value, CAST(m.w AS DOUBLE) + coalesce(k.n, 0) AS score FROM m
      LEFT JOIN k ON m.doc_id = k.doc_id AND m.type = k.type AND m.value = k.value)
SELECT doc_id, type, value, round(score, 6) AS score FROM s
QUALIFY row_number() OVER (PARTITION BY doc_id, type ORDER BY score DESC, value) = 1
"""


# --- pipeline parts ---------------------------------------------------------------

ORACLE["suffix_rule_domains"] = """
WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([a-z0-9]+)', 1) ||
             ['.ck', '.shop.ck', '.a.shop.ck', '.www.ck', '.b.co.uk', '.kobe.jp', '.x.kobe.jp', '.city.kobe.jp', '.y.net.example.org', '.unlisted'][page_id % 10 + 1] AS host
           FROM pages),
r AS (SELECT * FROM (VALUES ('com', 0, FALSE), ('net', 0, FALSE), ('org', 0, FALSE), ('ck', 0, FALSE), ('ck', 1, FALSE), ('www.ck', -1, TRUE), ('uk', 0, FALSE),
        ('co.uk', 0, FALSE), ('jp', 0, FALSE), ('kobe.jp', 1, FALSE), ('city.kobe.jp', -1, TRUE), ('net.example.org', 0, FALSE)) v(tail, more, exc)),
l AS (SELECT page_id, host, string_split(host, '.') AS lb FROM h),
c AS (SELECT page_id, host, lb, array_to_string(lb[k:], '.') AS tail, len(lb) - k + 1 AS n FROM (SELECT *, unnest(generate_series(1, len(lb))) AS k FROM l)),
m AS (SELECT c.page_id, c.host, c.lb, c.n + r.more AS n, r.exc FROM c JOIN r ON c.tail = r.tail
      UNION ALL SELECT page_id, host, lb, 1, FALSE FROM c WHERE n = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY exc DESC, n DESC) AS rn FROM m WHERE n BETWEEN 1 AND len(lb) - 1)
SELECT h.page_id, h.host, array_to_string(b.lb[len(b.lb) - b.n:], '.') AS tld FROM h LEFT JOIN b ON h.page_id = b.page_id AND rn = 1
"""

ORACLE["url_words"] = r"""
WITH t AS (SELECT page_id, regexp_extract_all(trim(regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', ''),
             '[^\p{L}\p{N}]+', ' ', 'g')), '[\p{L}\p{N}_]+') AS toks FROM pages),
g AS (SELECT page_id, toks, i, unnest(range(1, least(2, len(toks) - i + 1) + 1)) AS k FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM t))
SELECT page_id, CAST(i - 1 AS INTEGER) AS start, CAST(i - 1 + k AS INTEGER) AS "end", lower(array_to_string(toks[i:i + k - 1], ' ')) AS value FROM g
WHERE lower(array_to_string(toks[i:i + k - 1], ' ')) IN ('example com', 'example net', 'www', 'fr', 'es', 'org es')
"""

ORACLE["landmark_site_fields"] = f"""
WITH {REGISTERED_DOMAIN_CTE},
r AS (SELECT * FROM (VALUES ('example.com', 'name', 'inferlink_name', 0, '<h1>', '</h1>', 0), ('example.com', 'price', 'inferlink_price', 1, '<!-- ad ', ' -->', 18),
        ('example.com', 'price', 'inferlink_price-1', 2, '<div class="ad">', '</div>', 19), ('example.net', 'name', 'inferlink_name', 0, '<h1>', '</h1>', 0))
      v(site, field, source, ix, b, e, o)),
j AS (SELECT p.page_id, p.html, r.* FROM pages p JOIN rd ON p.page_id = rd.page_id JOIN r ON rd.tld = r.site),
k AS (SELECT *, strpos(html, b) AS bpos, strpos(html, b) + length(b) AS vs FROM j),
m AS (SELECT *, strpos(substr(html, vs), e) AS erel FROM k WHERE bpos > 0)
SELECT page_id, field, source, 'strict' AS tier, CAST(o AS BIGINT) * 4294967296 + ix AS pos, trim(substr(html, vs, erel - 1)) AS value
FROM m WHERE erel > 0 AND trim(substr(html, vs, erel - 1)) <> ''
"""

ORACLE["cell_candidates"] = r"""
WITH c AS (
  SELECT o_orderkey AS page_id, 0 AS r, 0 AS c, 'Key' AS text FROM orders UNION ALL SELECT o_orderkey, 0, 1, 'Customer' FROM orders
  UNION ALL SELECT o_orderkey, 0, 2, 'Status & Priority' FROM orders UNION ALL SELECT o_orderkey, 1, 0, CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderkey, 1, 1, CAST(o_custkey AS VARCHAR) FROM orders UNION ALL SELECT o_orderkey, 1, 2, o_orderstatus || ' & ' || o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, 2, 0, strftime(o_orderdate, '%Y-%m-%d') FROM orders UNION ALL SELECT o_orderkey, 2, 1, 'date' FROM orders),
t AS (SELECT *, regexp_extract_all(text, '(\n|[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r])', 1) AS toks FROM c),
g AS (SELECT *, unnest(range(1, least(2, len(toks) - i + 1) + 1)) AS k FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM t)),
v AS (SELECT * FROM (VALUES ('priority', 'urgent', 0.9, 2), ('priority', 'high', 0.8, 2), ('priority', 'low', 0.7, 2), ('priority', 'not specified', 0.6, 2),
        ('priority', 'medium', 0.1, 2), ('label', 'key', 0.5, 1), ('label', 'date', 0.4, 1), ('label', 'not specified', 0.3, 1)) v(field, entry, w, n)),
d AS (SELECT page_id, v.field, 9 AS pass_no, -CAST(w AS DOUBLE) AS rank, r, c, i - 1 AS start, array_to_string(toks[i:i + k - 1], ' ') AS value,
             v.field || '_dictionary' AS extractor, 'tokens' AS input_type
      FROM g JOIN v ON lower(array_to_string(toks[i:i + k - 1], ' ')) = v.entry AND k <= v.n WHERE w > 0.2),
x AS (SELECT page_id, 'posting-date', 10, 0.0, r, c, 0, text, 'posting-date_regex', 'text' FROM c WHERE r = 2 AND c = 0)
SELECT page_id AS doc_id, field, 'relaxed' AS tier, CAST(pass_no AS INTEGER) AS pass_no, rank, (CAST(r AS BIGINT) * 1024 + c) * 16777216 + start AS pos, value,
       extractor, input_type, 'html' AS source, 'table' AS segment, '0/' || r || '/' || c AS cell
FROM (SELECT * FROM d UNION ALL SELECT * FROM x)
"""

ORACLE["height_weight_candidates"] = """
WITH p AS (SELECT p_partkey AS doc_id, p_size AS s FROM part),
h AS (SELECT doc_id, s, [s + 110] || CASE WHEN s * 5 BETWEEN 100 AND 299 THEN [s * 5] ELSE [] END AS cm FROM p),
hh AS (SELECT doc_id, cm, list_filter(cm, lambda x: x BETWEEN 121 AND 214)[1] AS num FROM h),
kg AS (SELECT doc_id, s, (CASE WHEN s * 6 + 10 BETWEEN 10 AND 999 THEN [CAST(round((s * 6 + 10) / CAST(2.20462 AS DOUBLE)) AS INTEGER)] ELSE [] END) || [s + 30] AS kgs FROM p),
wk AS (SELECT doc_id, s, kgs, list_filter(kgs, lambda x: x BETWEEN 40 AND 150)[1] AS num FROM kg),
c AS (SELECT doc_id, 'height' AS field, 'strict' AS tier, 0 AS pos, 0 AS ix, CAST(num AS DOUBLE) AS num, CASE WHEN num IS NULL THEN array_to_string(cm, ',') END AS raw FROM hh
      UNION ALL SELECT doc_id, 'weight', 'strict', 0, 0, CAST(num AS DOUBLE), CASE WHEN num IS NULL THEN array_to_string(kgs, ',') END FROM wk
      UNION ALL SELECT doc_id, 'weight', 'relaxed', 1, 0, CASE WHEN s + 35 BETWEEN 40 AND 150 THEN CAST(s + 35 AS DOUBLE) END, CASE WHEN s + 35 < 40 THEN (s + 35) || 'kg' END FROM p
      UNION ALL SELECT doc_id, 'weight', 'relaxed', 1, 1, NULL, 'heavy' FROM p
      UNION ALL SELECT doc_id, 'weight', 'relaxed', 1, 2, CASE WHEN s + 30 BETWEEN 40 AND 150 THEN CAST(s + 30 AS DOUBLE) END, CASE WHEN s + 30 < 40 THEN (s + 30) || ' kilos' END FROM p)
SELECT doc_id, field, tier, CAST(pos AS BIGINT) AS pos, ix, num, raw FROM c
"""

ORACLE["index_documents"] = f"""
WITH {EVENT_CANDIDATES}, {ROUTED}, {NORMALIZED},
t AS (SELECT *, CASE WHEN field = 'title' AND tier = 'relaxed' THEN 'place'
                     WHEN field = 'age' AND NOT regexp_matches(name, '^[0-9]+$') THEN 'type' END AS odd FROM fields)
SELECT doc_id,
       coalesce(string_agg(name, '|' ORDER BY pass_no, rank, pos) FILTER (WHERE field = 'age' AND tier = 'strict' AND odd IS NULL), '') AS ages_strict,
       CAST(coalesce(sum(TRY_CAST(name AS BIGINT)) FILTER (WHERE field = 'age' AND tier = 'relaxed' AND odd IS NULL), 0) AS BIGINT) AS age_sum_relaxed,
       coalesce(string_agg(name, '|' ORDER BY pass_no, rank, pos) FILTER (WHERE field = 'name' AND tier = 'strict'), '') AS names_strict,
       coalesce(string_agg(name, '|' ORDER BY pass_no, rank, pos) FILTER (WHERE field = 'title' AND tier = 'strict'), '') AS titles,
       CAST(count(*) FILTER (WHERE field = 'weight' AND tier = 'relaxed') AS INTEGER) AS n_weights,
       count(*) FILTER (WHERE odd = 'type') AS n_wrong_type, count(*) FILTER (WHERE odd = 'place') AS n_no_place
FROM t GROUP BY doc_id
"""

ORACLE["entity_rows"] = """
SELECT c_custkey, 'price' AS field, '$' || (c_custkey % 900) || '.50' AS value FROM customer
UNION ALL SELECT c_custkey, 'price', c_custkey || ' EUR' FROM customer
UNION ALL SELECT c_custkey, 'url', 'https://a.example.com/x?id=' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 'review-id', 'R-' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 'social-id', '@user_' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 'address', c_custkey || ' Old Mill Road' FROM customer
UNION ALL SELECT c_custkey, 'posting-date', '2017-03-1' || (c_custkey % 10) FROM customer
UNION ALL SELECT c_custkey, 'gender', ['female', 'male', 'woman'][c_custkey % 3 + 1] FROM customer
UNION ALL SELECT c_custkey, 'nationality', ['new zealand', 'france'][c_custkey % 2 + 1] FROM customer
UNION ALL SELECT c_custkey, 'service', unnest(['deep tissue massage', 'massage']) FROM customer
"""
