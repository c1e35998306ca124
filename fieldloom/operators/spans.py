"""Token annotation from mention spans (F1, F2).

A mention over tokens ``[start, end)`` annotates each covered token with
``(type, offset)``, and the first token also with ``length = end - start``.
Phone mentions and mentions not built on tokens are not annotated.  The same
code serves segments and table cells (the cell key is one more key column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKIP_TYPES = ("phone",)


def token_annotations(spans: DataFrame, key_cols) -> DataFrame:
    """``(*keys, pos, type, offset, length, start)`` for every token covered by
    a token-based span."""
    key_cols = list(key_cols)
    s = spans.where((F.col("input_type") == "tokens") & ~F.col("field").isin(*SKIP_TYPES))
    return (s.select(*key_cols, "field", "start", "end", F.explode(F.sequence("start", F.col("end") - 1)).alias("pos"))
            .select(*key_cols, "pos", F.col("field").alias("type"), (F.col("pos") - F.col("start")).alias("offset"),
                    F.when(F.col("pos") == F.col("start"), F.col("end") - F.col("start")).alias("length"), "start"))


def annotated_tokens(tokens: DataFrame, annotations: DataFrame, key_cols, tokens_col: str = "tokens") -> DataFrame:
    """Structured tokens with their annotations attached:
    ``(*keys, tokens array<struct<value, semantic_type array<struct<type, offset, length>>>>)``.

    Annotations are grouped per token and then per segment; both groups are
    bounded by the segment's own token count."""
    key_cols = list(key_cols)
    per_token = (annotations.groupBy(*key_cols, "pos")
                 .agg(F.array_sort(F.collect_list(F.struct("start", "type", "offset", "length"))).alias("ann")))
    per_seg = (per_token.groupBy(*key_cols)
               .agg(F.map_from_entries(F.collect_list(F.struct("pos", "ann"))).alias("__ann")))
    joined = tokens.join(per_seg, key_cols, "left")
    return joined.select(*key_cols, F.transform(
        F.col(tokens_col),
        lambda t, i: F.struct(t.alias("value"),
                              F.transform(F.coalesce(F.element_at(F.col("__ann"), i),
                                                     F.array().cast("array<struct<start:int,type:string,offset:int,length:int>>")),
                                          lambda a: F.struct(a["type"].alias("type"), a["offset"].alias("offset"),
                                                             a["length"].alias("length"))).alias("semantic_type"))
    ).alias(tokens_col))
