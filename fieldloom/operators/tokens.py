"""Tokenisation.

Tokens are line breaks, runs of letters/digits/underscore, or any other single
non-space character.  The same expressions serve segments and table cells
(the cell key is just another id column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions.text import col_of


def tokenize(text) -> "F.Column":
    """Simple tokens: ``array<string>``."""
    return F.regexp_extract_all(col_of(text), F.lit(config.TOKEN_PATTERN), 1)


def structured_tokens(text) -> "F.Column":
    """Structured tokens ``array<struct<value, is_break>>`` with line-break
    tokens flagged (D1)."""
    return F.transform(tokenize(text), lambda t: F.struct(t.alias("value"), (t == "\n").alias("is_break")))


def simple_from_structured(tokens) -> "F.Column":
    """``value`` of each structured token."""
    return F.transform(col_of(tokens), lambda t: t["value"])


def add_tokens(df: DataFrame, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    return df.withColumn(out_col, tokenize(F.col(text_col)))


def explode_tokens(df: DataFrame, key_cols, tokens_col: str = "tokens") -> DataFrame:
    """Long table ``(*keys, pos, value)``.  Only the keys travel with each
    token, never the whole token array."""
    key_cols = list(key_cols)
    return df.select(*key_cols, F.posexplode(tokens_col).alias("pos", "value"))


def token_stats(tokens) -> "F.Column":
    """``(n_tokens, n_breaks, token_chars)`` of a token array."""
    t = col_of(tokens)
    return F.struct(F.size(t).cast("bigint").alias("n_tokens"),
                    F.size(F.filter(t, lambda x: x == "\n")).cast("bigint").alias("n_breaks"),
                    F.aggregate(t, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x)).alias("token_chars"))
