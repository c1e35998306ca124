"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import stored


def _cut(df: DataFrame) -> DataFrame:
    """``df`` stored and read back.  Spark knows the size of such a table, so a small one is
    broadcast and its files are read together, where a checkpoint keeps all its partitions."""
    return stored(df, "edges")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(vertex, component)`` for every vertex of ``edges``; ``component`` is
    the smallest vertex reachable.  Null ends and loops are ignored.

    Each round joins every edge to the smallest lower neighbour of one end
    (large star), then of the other (small star), until only stars are left; the
    rounds grow with the logarithm of the longest chain.  A vertex with very
    many edges sits on the plain side of a join of two stored tables, which
    adaptive execution can split; only grouped minima are aggregated."""
    a, b = F.col(a), F.col(b)
    e = _cut(edges.where(a.isNotNull() & b.isNotNull() & (a != b))
             .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    while not _settled(e):
        low = _cut(e.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("low")))
        large = _cut(e.join(low, F.col("a") == F.col("v"), "left")
                     .select(F.coalesce("low", "a").alias("a"), "b").distinct())
        low = _cut(large.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("low")))
        e = _cut(large.join(low, F.col("b") == F.col("v"))
                 .select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("a").alias("b")),
                                           F.struct(F.col("low").alias("a"), F.col("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
    return (e.select(F.col("b").alias("vertex"), F.col("a").alias("component"))
            .union(e.select(F.col("a"), F.col("a")).distinct()))


def _settled(e: DataFrame) -> bool:
    """Whether every vertex is either the lower end of its edges or the upper end of one
    edge: then each component is a star around its smallest vertex, and a further
    round would change nothing."""
    ends = e.select(F.col("a").alias("v"), F.lit(0).alias("up")).union(e.select("b", F.lit(1)))
    more = (ends.groupBy("v").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
            .where("up > 1 or up = 1 and n > 1"))
    return more.agg(F.count(F.lit(1))).first()[0] == 0
