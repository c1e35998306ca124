"""Configuration tables of the engine.

Everything in the block marked FIXED VALUES must equal the behaviour being
reproduced (thresholds, ranges, source names, patterns).  Everything else is a
default of this engine and may be replaced by user tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour; keep as written)
# ---------------------------------------------------------------------------

# Normaliser configuration: field -> data type, optional inclusive range on
# int(value), normaliser name.
NORMALIZE_CONFIG = {
    "age": {"data_type": "int", "range": (18, 60), "function": "clean_age"},
    "height": {"data_type": "number", "range": (121, 214), "function": "clean_height"},
    "weight": {"data_type": "number", "range": (40, 150), "function": "clean_weight"},
    "name": {"data_type": "string", "function": "clean_name"},
    "posting-date": {"data_type": "string", "function": "clean_posting_date"},
    "ethnicity": {"data_type": "string", "function": "clean_ethnicity"},
    "eye_color": {"data_type": "string", "function": "clean_eye_color"},
    "hair_color": {"data_type": "string", "function": "clean_hair_color"},
    "city": {"data_type": "string", "function": "clean_city"},
    "title": {"data_type": "string", "function": "identity"},
    "description": {"data_type": "string", "function": "identity"},
}

# Strict routing threshold and span-rebuild threshold.
STRICT_PROBABILITY = 0.5
SPAN_PROBABILITY = 0.2

# Unit factors.
KG_PER_LB = 2.20462          # kg <-> lb in unit conversion and search text
LB_PER_KG_WEIGHT = 2.2       # pounds -> kg inside weight cleaning
CM_PER_FT = 30.48
CM_PER_IN = 2.54
IN_PER_FT = 12
BARE_WEIGHT_KG_BELOW = 90    # bare weight number below this is kg, else lb

# Title pattern (case-insensitive, '.' does not cross newlines).
TITLE_PATTERN = r"(?i)<title>(.*?)</title>"
# "my name is X" pattern (case-insensitive, group 1).
MY_NAME_IS_PATTERN = r"(?i)(?:my[\s]+name[\s]+is[\s]+([-a-z0-9@$!]+))"
# Dictionary pre-filter, applied after lower-casing, anchored at the start.
DICTIONARY_PREFILTER = r"^[a-z].*[a-z]"
# N-gram sizes of the dictionaries (others: 1).
DICTIONARY_NGRAMS = {"city": 3}

# Site (wrapper) source fields -> semantic field.
SITE_FIELD_SOURCES = {
    "name": ["inferlink_name"],
    "posting-date": ["inferlink_posting-date", "inferlink_posting-date-2", "inferlink_posting-date-1"],
    "location": ["inferlink_location", "inferlink_location-1", "inferlink_location-2", "inferlink_location-3"],
    "city": ["inferlink_city"],
    "state": ["inferlink_state"],
    "country": ["inferlink_country"],
    "phone": ["inferlink_phone"],
    "age": ["inferlink_age", "inferlink_age-1", "inferlink_age-2"],
    "ethnicity": ["inferlink_ethnicity"],
    "hair_color": ["inferlink_hair-color"],
    "weight": ["inferlink_weight"],
    "price": ["inferlink_price", "inferlink_price-1", "inferlink_price-2", "inferlink_price-3"],
    "height": ["inferlink_height"],
    "eye_color": ["inferlink_eye-color"],
    "gender": ["inferlink_gender"],
}

# Bulky crawl columns that are blanked before processing.
BLANKED_COLUMNS = ["crawl_data", "extracted_metadata"]

# Field names that the search index spells with a hyphen.
INDEX_FIELD_RENAMES = {"eye_color": "eye-color", "hair_color": "hair-color"}

# Search-index fields: the tiers and the members a value has there, and members whose
# type is not string.
INDEX_FIELDS = {
    "age": (("strict", "relaxed"), ("key", "name")),
    "city": (("strict", "relaxed"), ("key", "name")),
    "country": (("strict", "relaxed"), ("key", "name")),
    "description": (("strict", "relaxed"), ("name",)),
    "email": (("strict", "relaxed"), ("key", "name")),
    "ethnicity": (("strict", "relaxed"), ("key", "name")),
    "eye-color": (("strict", "relaxed"), ("key", "name")),
    "hair-color": (("strict", "relaxed"), ("key", "name")),
    "height": (("strict", "relaxed"), ("key", "name", "search")),
    "name": (("strict", "relaxed"), ("key", "name")),
    "phone": (("strict", "relaxed"), ("key", "name")),
    "posting-date": (("strict", "relaxed"), ("key", "name")),
    "price": (("strict", "relaxed"), ("key", "name")),
    "state": (("strict", "relaxed"), ("key", "name")),
    "title": (("strict",), ("name",)),
    "weight": (("strict", "relaxed"), ("key", "name", "search")),
}
INDEX_TYPES = {"age": "long", "posting-date": "date"}

# Hybrid-Jaccard matching threshold (stored as a string in the source config).
HYBRID_JACCARD_THRESHOLD = "0.90"

# Colour references in "canonical: synonym, synonym" form.
EYE_COLOR_REFERENCES = [
    "amber",
    "blue: azure, sapphire",
    "brown",
    "gray:grey",
    "green",
    "hazel",
    "violet",
]
HAIR_COLOR_REFERENCES = [
    "blonde: blond, flaxen, fair",
    "brown: brunette",
    "chestnut",
    "black: raven",
    "auburn",
    "red: redhead, ginger",
    "gray: platinum, silver",
    "white",
]

# Source weights of the location choice.
TITLE_WEIGHT = 1.0
TEXT_WEIGHT = 0.5

# ---------------------------------------------------------------------------
# Engine defaults (our own definitions; override freely)
# ---------------------------------------------------------------------------

# Named HTML entities decoded in block text (numeric entities are decoded by rule).
HTML_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&amp;", "&"),
]

# Tags that end a text block.
BLOCK_TAGS = ("p|div|h[1-6]|li|ul|ol|nav|article|section|header|footer|aside|main|"
              "table|tr|td|th|br|hr|blockquote|pre|body|html|form|dl|dt|dd|figure|figcaption")

# Strict-content block filter.
STRICT_MIN_CHARS = 40
STRICT_MAX_LINK_DENSITY = 0.3
STRICT_MAX_SITE_REPEATS = 2

# Token pattern: line breaks, word runs (letters, digits, underscore), or any
# other single non-space character.
TOKEN_PATTERN = r"(\n|[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r])"

# Posting-date formats tried in order.
DATE_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "MMMM d, yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
]
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# A sample of public suffixes, for tests and for the registered queries; users pass the
# whole list as a table (the last label stands in for a suffix that is not listed).
DEFAULT_PUBLIC_SUFFIXES = [
    "com", "net", "org", "edu", "gov", "io", "info", "biz",
    "co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "de", "fr", "es", "it", "nl", "uk", "us",
]

# Bounds under which a configuration table is broadcast.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20
