"""Scalar field normalisers.

Each normaliser yields a field-value struct ``FV = (key, name, num, search)``
or null when the value is rejected; a null later becomes the raw fallback
``(key='', name=raw)`` in consolidation.  ``name`` holds the text the value
prints as (integers bare, floats as Python-2 ``str``); ``num`` holds numeric
values so that ``55`` and ``55.0`` compare equal when deduplicating.

A normaliser is written once as a list of named steps plus a final FV
expression.  It runs in two modes:

* frame mode (``apply``/``normalize_frame``): every step becomes an
  intermediate column, so each is computed once inside whole-stage codegen;
  this is what the pipeline and the registered queries use;
* column mode (``clean_*``): the steps are bound with ``let`` into a single
  Column, convenient for ad-hoc use in any ``select``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions.text import ASCII_WS, col_of, let, py2_str, py_float, py_int_of_float, title_case

FV_TYPE = "struct<key:string,name:string,num:double,search:string>"


def fv(key, name, num=None, search=None) -> Column:
    """Build a field-value struct."""
    def lit_or(c, t):
        return F.lit(None).cast(t) if c is None else col_of(c).cast(t)
    return F.struct(lit_or(key, "string").alias("key"), lit_or(name, "string").alias("name"),
                    lit_or(num, "double").alias("num"), lit_or(search, "string").alias("search"))


def null_fv() -> Column:
    return F.lit(None).cast(FV_TYPE)


# --- H1-H3 -----------------------------------------------------------------

def numeric_only(c) -> Column:
    """Keep the characters 0-9."""
    return F.regexp_replace(col_of(c), "[^0-9]+", "")


def alpha_only(c) -> Column:
    """Keep the characters A-Z and a-z."""
    return F.regexp_replace(col_of(c), "[^A-Za-z]+", "")


def replace_multiple_spaces_with_one(c) -> Column:
    """Runs of whitespace become one space; no trimming."""
    return F.regexp_replace(col_of(c), "[" + ASCII_WS + "]+", " ")


def py_strip(c, chars: str | None = None) -> Column:
    """Python ``str.strip``: ASCII whitespace by default, else the given
    character set, from both ends."""
    c = col_of(c)
    return F.btrim(c, F.lit(" \t\n\x0b\f\r" if chars is None else chars))


# --- H6, H9, H10 -----------------------------------------------------------

_FACTORS = {
    ("kg", "lb"): ("*", config.KG_PER_LB), ("lb", "kg"): ("/", config.KG_PER_LB),
    ("ft", "in"): ("*", config.IN_PER_FT), ("ft", "cm"): ("*", config.CM_PER_FT),
    ("in", "ft"): ("/", config.IN_PER_FT), ("in", "cm"): ("*", config.CM_PER_IN),
    ("cm", "ft"): ("/", config.CM_PER_FT), ("cm", "in"): ("/", config.CM_PER_IN),
}


def unit_conversion(val, from_unit, to_unit) -> Column:
    """Convert between kg/lb and ft/in/cm.  Same unit returns the value
    unchanged; an unknown pair gives null.  Units may be literals or columns."""
    v = col_of(val).cast("double")
    if isinstance(from_unit, str) and isinstance(to_unit, str):
        if from_unit == to_unit:
            return v
        if (from_unit, to_unit) not in _FACTORS:
            return F.lit(None).cast("double")
        op, k = _FACTORS[(from_unit, to_unit)]
        return v * k if op == "*" else v / k
    fu = F.lit(from_unit) if isinstance(from_unit, str) else from_unit
    tu = F.lit(to_unit) if isinstance(to_unit, str) else to_unit
    out = F.when(fu == tu, v)
    for (a, b), (op, k) in _FACTORS.items():
        out = out.when((fu == a) & (tu == b), v * k if op == "*" else v / k)
    return out


def convert_height_all_units(cm, cm_text=None) -> Column:
    """``"<cm> <ft> <in>"`` with Python-2 float text."""
    cm = col_of(cm).cast("double")
    head = py2_str(cm) if cm_text is None else col_of(cm_text)
    return F.concat_ws(" ", head, py2_str(unit_conversion(cm, "cm", "ft")), py2_str(unit_conversion(cm, "cm", "in")))


def convert_weight_all_units(kg, kg_text=None) -> Column:
    """``"<kg> <lb>"`` with Python-2 float text."""
    kg = col_of(kg).cast("double")
    head = py2_str(kg) if kg_text is None else col_of(kg_text)
    return F.concat_ws(" ", head, py2_str(unit_conversion(kg, "kg", "lb")))


# Data types whose values a normaliser yields as numbers.
_WHOLE, _NUMERIC = {"int", "long"}, {"int", "long", "float", "number"}


def _in_range(num, conf: dict) -> Column:
    """Range check of a field's configuration on ``int(num)``; a zero passes
    (falsy values are not checked), and so does any value of a field without a
    range."""
    if not conf.get("range"):
        return col_of(num).isNotNull()
    lo, hi = conf["range"]
    i = py_int_of_float(col_of(num).cast("double"))
    return (col_of(num) == 0) | i.between(lo, hi)


def _of_type(conf: dict, whole: bool) -> bool:
    """Whether a numeric value (``whole``: an integer) has the configured data type."""
    kind = conf.get("data_type")
    return kind is None or kind == "number" or (kind in _WHOLE if whole else kind == "float")


def sanity_check_values(num, field) -> Column:
    """Range check on ``int(x)`` with falsy values passing through.
    ``field`` is a configured field's name or a configuration entry."""
    conf = field if isinstance(field, dict) else config.NORMALIZE_CONFIG[field]
    return F.when(col_of(num) == 0, col_of(num)).when(_in_range(num, conf), col_of(num))


# --- normalisers as steps ------------------------------------------------------
# A spec is (steps, final): steps is a list of (name, fn(env) -> Column) and
# final is fn(env) -> FV Column; ``env`` maps input and step names to Columns.

def _age_spec(conf: dict):
    """H4: first number of a range, digits only, kept in the configured range
    (18..60 by default) if an integer is the configured type."""
    fits = F.lit(_of_type(conf, True))
    steps = [("n", lambda e: numeric_only(py_strip(F.split(F.lower(py_strip(e["value"])), "-", -1).getItem(0)))
              .try_cast("bigint"))]

    def final(e):
        n = e["n"]
        return F.when(n.isNotNull() & (n != 0) & _in_range(n, conf) & fits, fv(n.cast("string"), n.cast("string"), n))
    return steps, final


def _name_spec(conf: dict):
    """H5: whitespace runs to one space, then title case after every non-letter."""
    steps = [("t", lambda e: title_case(replace_multiple_spaces_with_one(e["value"])))]
    return steps, lambda e: F.when(e["value"].isNotNull(), fv(e["t"], e["t"]))


def _height_spec(conf: dict, bare_height_cm: bool = False):
    """H7/H8: height text (``5'9"`` -> feet * 30.48 + inches * 2.54, bad
    inches count 0; text without a foot mark yields digits as text, which the
    number check rejects, or ``''`` when it has none, which passes) or a list
    of integer centimetres (first in range)."""
    def first_list(e):
        return F.get(F.filter(e["centimeter"], lambda x: (x == 0) | _in_range(x, conf)), 0)

    def foot(e):
        return F.size(e["dims"]) >= 2

    def kept(e):
        cm, lst = e["cm"], e["lst"]
        list_ok = (lst == 0) | F.lit(_of_type(conf, True))
        foot_ok = (cm == 0) | (_in_range(cm, conf) & F.lit(_of_type(conf, False)))
        out = F.when(e["centimeter"].isNotNull(), F.when(list_ok, lst.cast("double"))).when(foot(e), F.when(foot_ok, cm))
        if bare_height_cm:
            b = e["bare"].try_cast("bigint")
            out = out.otherwise(F.when((b != 0) & _in_range(b, conf), b.cast("double")))
        return out

    def head(e):
        whole = F.coalesce(e["lst"].cast("string"), e["bare"].try_cast("bigint").cast("string"))
        return F.when(e["centimeter"].isNull() & foot(e), py2_str(e["kept"])).when(e["kept"].isNotNull(), whole)

    steps = [
        ("dims", lambda e: F.split(py_strip(F.split(py_strip(F.lower(py_strip(e["value"]))), "-", -1).getItem(0)),
                                   "'", -1)),
        ("feet", lambda e: F.when(foot(e), py_float(e["dims"].getItem(0)))),
        ("inches", lambda e: F.when(foot(e), py_float(F.btrim(F.get(e["dims"], 1), F.lit('"'))))),
        ("cm", lambda e: e["feet"] * config.CM_PER_FT + F.coalesce(e["inches"], F.lit(0.0)) * config.CM_PER_IN),
        ("lst", first_list),
        ("bare", lambda e: F.when(~foot(e), numeric_only(e["value"]))),
        ("kept", kept),
        ("head", head),
        ("ft_txt", lambda e: py2_str(unit_conversion(e["kept"], "cm", "ft"))),
        ("in_txt", lambda e: py2_str(unit_conversion(e["kept"], "cm", "in"))),
    ]

    def final(e):
        out = F.when(e["kept"].isNotNull(), fv(e["head"], e["head"], e["kept"], F.concat_ws(" ", e["head"], e["ft_txt"], e["in_txt"])))
        if not bare_height_cm:
            out = out.when(e["centimeter"].isNull() & (e["bare"] == ""), fv(F.lit(""), F.lit(""), None, F.lit(" None None")))
        return out
    return steps, final


def _weight_spec(conf: dict, fix_stone: bool = False):
    """Weight text to kilograms, or a kilogram list (first in range).

    In order: text containing ``st`` (stone) is rejected; leading/trailing
    ``s`` stripped; ``lb``/``pound`` suffix -> int(n)/2.2; ``kg``/``kilo``/
    ``kilogram`` suffix -> int(n) (an integer); a bare number is truncated and
    read as kg below 90, else as lb/2.2.  Kept in the configured range
    (40..150 by default) or when zero.  Non-ASCII text is rejected.  With
    ``fix_stone`` stones are read: ``int(14 * stones + pounds) / 2.2``, where
    text after the mark that is no number counts as no pounds.
    """
    per_lb = config.LB_PER_KG_WEIGHT

    def unit(e):
        out = F.when(e["lb"].endswith("lb"), "lb")
        for u in ("pound", "kg", "kilo", "kilogram"):
            out = out.when(e["lb"].endswith(u), u)
        return out

    def rejected(e):
        return (F.lit(not fix_stone) & e["x"].contains("st")) | e["value"].rlike(r"[^\x00-\x7F]")

    def kg(e):
        n, u = e["int"], e["unit"]
        pounds = u.isin("lb", "pound") | (u.isNull() & (n >= config.BARE_WEIGHT_KG_BELOW))
        if fix_stone:
            pounds = pounds | e["x"].contains("st")
        return F.when(e["kilogram"].isNotNull(),
                      F.get(F.filter(e["kilogram"], lambda v: (v == 0) | _in_range(v, conf)), 0).cast("double")
                      ).when(~rejected(e), F.when(pounds, n / per_lb).otherwise(n.cast("double")))

    def kept(e):
        k = e["kg"]
        typed = F.when(e["whole"], F.lit(_of_type(conf, True))).otherwise(F.lit(_of_type(conf, False)))
        return F.when((k == 0) | (_in_range(k, conf) & typed), k)

    number = [("float", lambda e: py_float(F.when(e["unit"].isNull(), e["x"]).otherwise(F.btrim(e["lb"], e["unit"]))))]
    if fix_stone:  # text before the mark, and between it and a second one
        def half(e, i):
            mark = lambda m: F.substring_index(e["x"], m, 1) if i == 0 else F.substring_index(F.substring_index(e["x"], m, 2), m, -1)
            return F.when(e["x"].contains("stone"), mark("stone")).when(e["x"].contains("st"), mark("st"))
        number = [
            ("stones", lambda e: half(e, 0)),
            ("pounds", lambda e: F.btrim(F.btrim(F.btrim(half(e, 1), F.lit("s")), F.lit("lb")), F.lit("pound"))),
            ("more", lambda e: py_float(e["pounds"])),
            ("first", lambda e: py_float(F.when(e["stones"].isNotNull(), e["stones"]).when(e["unit"].isNull(), e["x"])
                                         .otherwise(F.btrim(e["lb"], e["unit"])))),
            ("float", lambda e: F.when(e["stones"].isNull(), e["first"]).otherwise(e["first"] * 14 + F.coalesce(e["more"], F.lit(0.0)))),
        ]
    steps = [
        ("x", lambda e: F.lower(py_strip(e["value"]))),
        ("lb", lambda e: F.btrim(e["x"], F.lit("s"))),
        ("unit", unit),
        *number,
        ("int", lambda e: py_int_of_float(e["float"])),
        ("kg", kg),
        ("whole", lambda e: e["kilogram"].isNull() & e["unit"].isin("kg", "kilo", "kilogram")),
        ("kept", kept),
        ("txt", lambda e: F.when(e["whole"], e["kept"].cast("bigint").cast("string")).otherwise(py2_str(e["kept"]))),
        ("lb_txt", lambda e: py2_str(unit_conversion(e["kept"], "kg", "lb"))),
    ]

    def final(e):
        return F.when(e["kept"].isNotNull(), fv(e["txt"], e["txt"], e["kept"], F.concat_ws(" ", e["txt"], e["lb_txt"])))
    return steps, final


def parse_date(value, formats=None) -> Column:
    """First format of the list that parses, as a timestamp; null if none."""
    formats = formats or config.DATE_FORMATS
    v = py_strip(value)
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in formats])


def _date_spec(conf: dict, formats=None):
    """Free-form date to ISO ``yyyy-MM-ddTHH:mm:ss`` over a format list."""
    steps = [("iso", lambda e: F.date_format(parse_date(e["value"], formats), config.ISO_FORMAT))]
    return steps, lambda e: F.when(e["iso"].isNotNull(), fv(e["iso"], e["iso"]))


def _city_spec(conf: dict):
    """key = value:state:country:lon:lat when all four are present, else
    the value itself; name is always the value."""
    def key(e):
        v = e["value"]
        full = (e["state"].isNotNull() & e["country"].isNotNull() & e["longitude"].isNotNull()
                & e["latitude"].isNotNull())
        return F.when(full, F.concat_ws(":", v, e["state"], e["country"], py2_str(e["longitude"]),
                                        py2_str(e["latitude"]))).otherwise(v)
    steps = [("key", key)]
    return steps, lambda e: F.when(e["value"].isNotNull(), fv(e["key"], e["value"]))


def _identity_spec(conf: dict):
    """Name only, no key."""
    return [], lambda e: fv(None, e["value"])


def _vocab_spec(conf: dict):
    """The vocabulary match (resolved by a join, see canonical.py)."""
    return [], lambda e: F.when(e["canonical"].isNotNull(), fv(e["canonical"], e["canonical"]))


SPECS = {
    "clean_age": _age_spec, "clean_name": _name_spec, "clean_height": _height_spec, "clean_weight": _weight_spec,
    "clean_posting_date": _date_spec, "clean_city": _city_spec, "identity": _identity_spec,
    "clean_ethnicity": _vocab_spec, "clean_eye_color": _vocab_spec, "clean_hair_color": _vocab_spec,
}

INPUTS = ("value", "canonical", "centimeter", "kilogram", "state", "country", "longitude", "latitude")
INPUT_TYPES = {"value": "string", "canonical": "string", "centimeter": "array<int>", "kilogram": "array<double>",
               "state": "string", "country": "string", "longitude": "double", "latitude": "double"}


def _env(inputs: dict) -> dict:
    env = {}
    for k in INPUTS:
        c = inputs.get(k)
        env[k] = col_of(c) if c is not None else F.lit(None).cast(INPUT_TYPES[k])
    return env


def _column_mode(spec, inputs) -> Column:
    steps, final = spec

    def go(i, env):
        if i == len(steps):
            return final(env)
        name, fn = steps[i]
        return let(fn(env), lambda b: go(i + 1, {**env, name: b}))
    return go(0, _env(inputs))


def _default(field: str) -> dict:
    return config.NORMALIZE_CONFIG[field]


def clean_age(value, conf: dict | None = None) -> Column:
    return _column_mode(_age_spec(conf or _default("age")), {"value": value})


def clean_name(value) -> Column:
    return _column_mode(_name_spec({}), {"value": value})


def clean_height(value, bare_height_cm: bool = False, conf: dict | None = None) -> Column:
    return _column_mode(_height_spec(conf or _default("height"), bare_height_cm), {"value": value})


def clean_height_list(centimeters, conf: dict | None = None) -> Column:
    return _column_mode(_height_spec(conf or _default("height")), {"centimeter": centimeters})


def clean_weight(value, fix_stone: bool = False, conf: dict | None = None) -> Column:
    return _column_mode(_weight_spec(conf or _default("weight"), fix_stone), {"value": value})


def clean_weight_list(kilograms, conf: dict | None = None) -> Column:
    return _column_mode(_weight_spec(conf or _default("weight")), {"kilogram": kilograms})


def clean_posting_date(value, formats=None) -> Column:
    return _column_mode(_date_spec({}, formats), {"value": value})


def clean_city(value, state=None, country=None, longitude=None, latitude=None) -> Column:
    return _column_mode(_city_spec({}), {"value": value, "state": state, "country": country,
                                         "longitude": longitude, "latitude": latitude})


def identity(value) -> Column:
    return _column_mode(_identity_spec({}), {"value": value})


# --- frame mode -----------------------------------------------------------------

def apply(df: DataFrame, function: str, out_col: str = "fv", conf: dict | None = None, **inputs) -> DataFrame:
    """Run one normaliser in frame mode: ``inputs`` name the input columns
    (``value=``, ``centimeter=``, ...); adds ``out_col`` (FV struct).  ``conf`` is
    the configuration entry (default: that of the first field with the function)."""
    if conf is None:
        conf = next((c for c in config.NORMALIZE_CONFIG.values() if c["function"] == function), {})
    return normalize_frame(df, None, out_col, normalize_config={"_": {**conf, "function": function}}, **inputs)


def normalize_frame(df: DataFrame, field_col: str | None, out_col: str = "fv", *, normalize_config=None, **inputs) -> DataFrame:
    """Dispatch on the field through the normaliser configuration, in
    frame mode.  Each configured normaliser's steps are added as columns
    gated on the row's field (rows of other fields carry nulls), then one
    ``CASE`` picks the FV.  Unconfigured fields get null (see
    ``is_configured``).  Ranges, data types and the options ``fix_stone``,
    ``bare_height_cm`` and ``formats`` are those of each field's own entry; a
    ``function`` may be a name of ``SPECS`` or a user's ``Column -> Column``."""
    steps, out = _frame_plan(field_col, normalize_config or config.NORMALIZE_CONFIG, inputs)
    for col, expr in steps:
        df = df.withColumn(col, expr)
    return df.withColumn(out_col, out).drop(*[c for c, _ in steps])


def _spec_of(conf: dict):
    fn = conf["function"]
    if callable(fn):  # U1: a user function; its text is key and name, null is a rejection
        return [("u", lambda e: fn(e["value"]).cast("string"))], lambda e: F.when(e["u"].isNotNull(), fv(e["u"], e["u"]))
    if fn not in SPECS:
        raise ValueError(f"unknown normaliser {fn!r}")
    options = {k: conf[k] for k in ("fix_stone", "bare_height_cm", "formats") if k in conf}
    return SPECS[fn](conf, **options)


def _frame_plan(field_col, conf: dict, inputs: dict):
    """The step columns and the final FV expression; fields with equal entries share their steps."""
    shared: dict = {}
    for field, entry in conf.items():
        shared.setdefault(repr(sorted(entry.items(), key=lambda kv: kv[0])), (entry, []))[1].append(field)
    base = _env({k: F.col(v) if isinstance(v, str) else v for k, v in inputs.items()})
    steps, out = [], None
    for i, (entry, fields) in enumerate(shared.values()):
        spec_steps, final = _spec_of(entry)
        gate = F.lit(True) if field_col is None else F.col(field_col).isin(*fields)
        env = dict(base)
        for name, step in spec_steps:
            col = f"__n{i}_{name}"
            steps.append((col, F.when(gate, step(env))))
            env[name] = F.col(col)
        out = F.when(gate, final(env)) if out is None else out.when(gate, final(env))
    return steps, null_fv() if out is None else out.otherwise(null_fv())


def is_configured(field, normalize_config=None) -> Column:
    conf = normalize_config or config.NORMALIZE_CONFIG
    return col_of(field).isin(list(conf))
