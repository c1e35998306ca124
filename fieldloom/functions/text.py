"""Column-level text helpers shared by the operators.

All helpers return Spark ``Column`` expressions built from SQL built-ins, so
they run inside the JVM (no Python worker) and compose into any plan.
"""

from __future__ import annotations

import functools
import weakref

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fieldloom import config

# ASCII whitespace as matched by a non-Unicode ``\s``; spelled out because Java
# and RE2 disagree on the vertical tab.
ASCII_WS = r" \t\n\x0B\f\r"

# Grammar of Python's float(): optional sign, decimal or exponent form, or the
# special names; surrounding ASCII whitespace allowed.
_PY_FLOAT = (r"^[" + ASCII_WS + r"]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
             r"|(?i:inf|infinity|nan))[" + ASCII_WS + r"]*$")


_MEMO: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def memo_column(fn):
    """Memoise a Column builder called with plain names and numbers, per session.

    Large expressions (Jaro, HTML blocks, n-grams) take longer to assemble node
    by node from Python than to evaluate.  An expression over column *names* is
    unresolved, so one build serves every DataFrame of its session; a call with
    a Column (which may belong to one DataFrame) is always built anew."""
    @functools.wraps(fn)
    def wrapper(*args):
        session = SparkSession.getActiveSession()
        if session is None or not all(isinstance(a, (str, int)) for a in args):
            return fn(*args)
        built = _MEMO.setdefault(session, {})
        key = (fn.__module__, fn.__qualname__, args)
        if key not in built:
            built[key] = fn(*args)
        return built[key]
    return wrapper


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """Bind ``value`` once and evaluate ``body(bound)``.

    Column expressions are trees: a sub-expression used twice is evaluated
    twice and copied into the generated code twice.  Binding it through a
    one-element ``transform`` evaluates it once.
    """
    return F.get(F.transform(F.array(col_of(value)), body), 0)


def running(values, step, zero, block: int = 256) -> Column:
    """The results of an associative ``step`` over every prefix of an array (the first
    element alone first).  Blocks are summed up first, then the elements of each from
    what stands before it, so that no array grows step by step over the whole length."""
    def grow(first, arr):
        return F.aggregate(arr, F.array(first), lambda acc, v: F.concat(acc, F.array(step(F.element_at(acc, -1), v))))

    def cut(v):
        last = F.floor((F.size(v) - 1) / block).cast("int")
        return F.when(F.size(v) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(v, b * block + 1, F.lit(block)))).otherwise(
            F.array().cast(f"array<array<{zero[1]}>>"))

    start = F.lit(zero[0]).cast(zero[1])

    def whole(blocks):
        before = grow(start, F.transform(blocks, lambda b: F.aggregate(b, start, lambda acc, v: step(acc, v))))
        return F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), lambda b, o: F.slice(grow(o, b), 2, F.size(b))))
    return let(let(values, cut), whole)



def py_float(c) -> Column:
    """Parse a string the way Python's ``float()`` does; null where it raises."""
    c = col_of(c)
    return F.when(c.rlike(_PY_FLOAT), F.trim(c).try_cast("double"))


def py_int_of_float(c) -> Column:
    """``int(x)`` of a double: truncation toward zero, null for inf/nan."""
    c = col_of(c)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(9.2e18)), c.cast("bigint"))


def py2_str(c) -> Column:
    """Text of ``str(float)`` in Python 2: 12 significant digits (``%.12g``),
    trailing fraction zeros dropped (one kept after the point), ``.0``
    appended to bare integers; null for null.  Pass a column or a cheap expression: ``c`` is
    referenced more than once.  From 1 to below 1000 the number rounded to 12 digits prints as
    that text already; the formatter and regular expressions, which cost ten times
    as much, are left to the rest."""
    c = col_of(c).cast("double")
    size = F.abs(c)
    near = F.when(size < 10, F.round(c, 11)).when(size < 100, F.round(c, 10)).otherwise(F.round(c, 9))
    # no zeros at the end of the fraction, no bare point; ".0" after an integer
    text = F.regexp_replace(F.format_string("%.12g", c), r"(?:\.0+|(\.[0-9]*?)0+)(e.*)?$", "$1$2")
    text = F.regexp_replace(text, r"^(-?[0-9]+)$", "$1.0")
    return (F.when((size >= 1) & (size < 1000), near.cast("string"))
            .when(F.isnan(c), F.lit("nan"))
            .when(size == F.lit(float("inf")), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(c.isNotNull(), text))


def collapse_ws(c, keep_edges: bool = True) -> Column:
    """Replace runs of ASCII whitespace by one space (no trim by default)."""
    out = F.regexp_replace(col_of(c), "[" + ASCII_WS + "]+", " ")
    return out if keep_edges else F.trim(out)


def unescape_entities(c) -> Column:
    """Decode the named entities of ``config.HTML_ENTITIES``; ``&amp;`` is
    decoded last so that ``&amp;lt;`` becomes ``&lt;``."""
    def decode(t):
        out = t
        for ent, ch in config.HTML_ENTITIES:
            if ent != "&amp;":
                out = F.replace(out, F.lit(ent), F.lit(ch))
        return F.when(t.contains("&"), F.replace(let(out, _numeric_entities), F.lit("&amp;"), F.lit("&"))).otherwise(t)
    return let(c, decode)


def _numeric_entities(c) -> Column:
    """Decode ``&#8217;`` and ``&#x2019;``; code points that are no character stay as they are."""
    rx = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

    def decode(e):
        n = F.when(e.rlike("^&#[xX]"), F.conv(F.regexp_extract(e, "[0-9a-fA-F]+(?=;)", 0), 16, 10)).otherwise(
            F.regexp_extract(e, "[0-9]+", 0)).cast("bigint")
        ok = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(e)
    found = F.transform(F.regexp_extract_all(c, F.lit(rx), 0), decode)
    whole = F.array_join(F.zip_with(F.split(c, rx, -1), found, lambda p, d: F.concat(p, F.coalesce(d, F.lit("")))), "")
    return F.when(c.contains("&#"), whole).otherwise(c)


def strip_tags(c) -> Column:
    return F.regexp_replace(col_of(c), r"<[^>]*>", " ")


def html_to_text(c) -> Column:
    """Tags removed, entities decoded, whitespace collapsed and trimmed."""
    return F.trim(collapse_ws(unescape_entities(strip_tags(c))))


def title_case(c) -> Column:
    """Python ``str.title()``: a cased letter is upper-cased when it follows an
    uncased character and lower-cased otherwise.  Runs of cased letters are
    split out and their first letter upper-cased."""
    parts = F.regexp_extract_all(F.lower(col_of(c)), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), 1)
    return F.array_join(
        F.transform(parts, lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))),
        "")


def chars(c) -> Column:
    """Array of the characters of a string (empty array for '')."""
    c = col_of(c)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, i, 1)))


@memo_column
def jaro(a, b) -> Column:
    """Jaro similarity of two strings, evaluated with higher-order functions.

    Window ``max(len)/2 - 1``; each character of ``a`` takes the first unused
    equal character of ``b`` inside the window; transpositions are half the
    mismatches between the two matched sequences (integer division).  Two
    empty strings score 0.  Every intermediate is bound once, so the cost is
    that of the character comparisons."""
    none = F.array().cast("array<int>")

    def upto(n):  # 0..n-1
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)

    def matched(s):
        ca, cb = s["ca"], s["cb"]
        la, lb = F.size(ca), F.size(cb)
        window = F.greatest(F.floor(F.greatest(la, lb) / 2).cast("int") - 1, F.lit(0))

        def step(acc, i):
            lo, hi = F.greatest(i - window, F.lit(0)), F.least(i + window, lb - 1)
            free = F.filter(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none),
                            lambda j: ~F.array_contains(acc, j) & (F.get(cb, j) == F.get(ca, i)))
            return F.concat(acc, F.array(F.coalesce(F.get(free, 0), F.lit(-1))))
        # per character of a: the position it takes in b, or -1
        return F.struct(s["ca"].alias("ca"), s["cb"].alias("cb"), F.aggregate(upto(la), none, step).alias("to"))

    def score(s):
        ca, cb = s["ca"], s["cb"]
        in_a = F.filter(F.transform(s["to"], lambda j, i: F.when(j >= 0, F.get(ca, i))), lambda x: x.isNotNull())
        in_b = F.transform(F.array_sort(F.filter(s["to"], lambda j: j >= 0)), lambda j: F.get(cb, j))
        off = F.size(F.filter(F.zip_with(in_a, in_b, lambda x, y: x != y), lambda d: d))
        return F.struct(F.size(ca).alias("la"), F.size(cb).alias("lb"), F.size(in_a).alias("m"), F.floor(off / 2).alias("t"))

    start = F.struct(chars(a).alias("ca"), chars(b).alias("cb"))
    return let(let(let(start, matched), score), lambda r: F.when(r["m"] == 0, F.lit(0.0)).otherwise(
        (r["m"] / r["la"] + r["m"] / r["lb"] + (r["m"] - r["t"]) / r["m"]) / 3.0))
