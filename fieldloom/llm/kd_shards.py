"""Sharding by a k-d tree over metadata (operator 1, DataFrame functions only).

All rows start in one node that is to become ``shards`` leaves.  A node of n
leaves is split along its widest metadata dimension (its range relative to the
range of the whole table) at the weighted median, the point that gives
floor(n / 2) / n of the node's bytes to the left, until every node is a leaf.
Leaves so reach the target bytes, total / shards, and hold rows of alike
metadata.

A median is found by distributed refinement: each round sums the bytes of all
open nodes in ``CELLS`` equal key cells, keeps the cell that the median falls in
and refines it, until the cell's bytes are below ``TOLERANCE`` of a leaf.  Only
one row per node (at most one per shard) reaches the driver.  Keys are 63 bits:
20 of the dimension, 20 of the text's CRC-32 and 23 of the id's hash.  A hot
source or a group of equal texts is therefore split like any other range, while
copies with equal metadata stay side by side.

Slots number the rows of a shard from 0 without gaps.  Rows are numbered within
sub-shards of about ``SLOT_ROWS`` rows and shifted by the counts before them, so
no task orders a whole shard.

Edge cases: null text has no bytes and CRC-32 0; null metadata sorts lowest, a
null id has a fixed hash; repeated rows are rows of their own and get slots of
their own; fewer rows than shards leave shards empty; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType
from pyspark.sql.window import Window

from fieldloom.llm.common import stored

CELLS, TOLERANCE, SLOT_ROWS = 256, 1 / 1000, 20_000
DIM_BITS, CRC_BITS, ID_BITS = 20, 20, 23
OVERHEAD = 8  # bytes of a row besides its text


def _number(df: DataFrame, name: str) -> Column:
    """A dimension as a double that keeps its order; null is lowest."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, NumericType):
        c = c.cast("double")
        return F.when(c.isNull() | F.isnan(c), -1e300).otherwise(c)
    if isinstance(kind, StringType):  # the first seven bytes as a number
        start = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0")
        return F.coalesce(F.conv(start, 16, 10).cast("double"), F.lit(-1.0))
    raise TypeError(f"{name}: a number or a string is needed")


def _rows(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + OVERHEAD
    numbers = [(F.log2(F.octet_length(text) + 1.0) if d == text_col else _number(docs, d)).alias(f"__d{i}") for i, d in enumerate(dims)]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"), *numbers)


def _values(spark, names: str, rows: list[tuple]) -> DataFrame:
    """A small table of the driver's numbers (one row per open node)."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join("(" + ", ".join(f"{v}L" for v in r) + ")" for r in rows) + f" AS t({names})")


def kd_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
              dims: tuple[str, ...] = ("lang", "source", "text")) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` per row.  ``dims`` are metadata
    columns; the text column there stands for the logarithm of its size."""
    spark = docs.sparkSession
    dims = list(dims)
    base = stored(_rows(docs, id_col, text_col, dims), "rows")
    every = [f"__d{i}" for i in range(len(dims))]
    whole = base.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"),
                     *(F.min(d).alias(f"lo{i}") for i, d in enumerate(every)), *(F.max(d).alias(f"hi{i}") for i, d in enumerate(every))).first()
    total = whole["bytes"] or 0
    tail = (F.shiftright(F.col("text_crc32"), 32 - CRC_BITS) * (1 << ID_BITS)
            + F.coalesce(F.xxhash64("doc_id"), F.lit(0)).bitwiseAND(F.lit((1 << ID_BITS) - 1)))
    keys = []
    for i, d in enumerate(every):
        lo, hi = whole[f"lo{i}"] or 0.0, whole[f"hi{i}"] or 0.0
        place = F.floor((F.col(d) / 2 - lo / 2) / (hi / 2 - lo / 2) * ((1 << DIM_BITS) - 1)) if hi > lo else F.lit(0)
        keys.append((place.cast("long") * (1 << CRC_BITS + ID_BITS) + tail).alias(f"__k{i}"))
    base = base.select("doc_id", "size", "text_crc32", *keys)
    if total:
        base = stored(base, "keys")

    rows = base.withColumn("__node", F.lit(0).cast("long"))
    nodes = {0: (0, shards)}  # node -> first shard, number of shards
    while total and any(n > 1 for _, n in nodes.values()):
        splits = _split(spark, rows, nodes, len(dims), total / shards * TOLERANCE)
        table = _values(spark, "__node, dim, cut, left, right", [(k, d, c, 2 * k + 1, 2 * k + 2) for k, (d, c) in splits.items()])
        key = F.element_at(F.array(*(f"__k{i}" for i in range(len(dims)))), F.col("dim").cast("int") + 1)
        rows = (rows.join(F.broadcast(table), "__node", "left")  # at most one row per shard
                .withColumn("__node", F.when(F.col("dim").isNull(), F.col("__node")).when(key < F.col("cut"), F.col("left")).otherwise(F.col("right")))
                .drop("dim", "cut", "left", "right"))
        rows = stored(rows, "level")  # each round of the next level reads one short table
        grown = {}
        for k, (s, n) in nodes.items():
            grown |= {2 * k + 1: (s, n // 2), 2 * k + 2: (s + n // 2, n - n // 2)} if n > 1 else {k: (s, n)}
        nodes = grown
    table = _values(spark, "__node, shard", [(k, s) for k, (s, _) in nodes.items()])
    leaves = rows.join(F.broadcast(table), "__node").select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"))
    return with_slots(leaves, whole["n"], shards)


def _split(spark, rows: DataFrame, nodes: dict, dims: int, tolerance: float) -> dict[int, tuple[int, int]]:
    """(dimension, cut) of every node with more than one leaf."""
    ends = [f(f"__k{i}").alias(f"{name}{i}") for i in range(dims) for name, f in (("lo", F.min), ("hi", F.max))]
    state, done = {}, {}
    for r in rows.groupBy("__node").agg(F.sum("size").alias("bytes"), *ends).collect():  # a row per node
        k = r["__node"]
        n = nodes[k][1]
        if n > 1:
            shift = CRC_BITS + ID_BITS
            dim = max(range(dims), key=lambda i: ((r[f"hi{i}"] >> shift) - (r[f"lo{i}"] >> shift), -i))
            state[k] = [dim, r[f"lo{dim}"], r[f"hi{dim}"], 0, r["bytes"] * (n // 2) / n]
    for k, (_, n) in nodes.items():
        if n > 1 and k not in state:  # a node without rows
            done[k] = (0, 0)
    while state:
        steps = {k: -(-(hi - lo + 1) // CELLS) for k, (_, lo, hi, _, _) in state.items()}
        table = _values(spark, "__node, dim, lo, hi, step, below, goal",
                        [(k, d, lo, hi, steps[k], b, math.ceil(g)) for k, (d, lo, hi, b, g) in state.items()])
        key = F.element_at(F.array(*(f"__k{i}" for i in range(dims))), F.col("dim").cast("int") + 1)
        cells = (rows.join(F.broadcast(table), "__node").withColumn("key", key).where("key between lo and hi")
                 .groupBy("__node", F.expr("(key - lo) div step").alias("cell"))
                 .agg(F.sum("size").alias("w"), F.first("below").alias("below"), F.first("goal").alias("goal")))
        upto = F.sum("w").over(Window.partitionBy("__node").orderBy("cell")) + F.col("below")  # CELLS rows per node
        hit = (cells.withColumn("upto", upto).where("upto >= goal and upto - w < goal")
               .select("__node", "cell", "w", "upto").collect())  # a row per node
        for r in hit:
            k, cell, w = r["__node"], r["cell"], r["w"]
            dim, lo, hi, _, goal = state[k]
            before, step = r["upto"] - w, steps[k]
            lo = lo + cell * step
            if w <= tolerance or step == 1:
                nearer = r["upto"] - goal < goal - before
                done[k] = (dim, lo + step if nearer else lo)
                del state[k]
            else:
                state[k] = [dim, lo, min(hi, lo + step - 1), before, goal]
        if not hit:
            raise RuntimeError("a weighted median was not found")
    return done


def with_slots(rows: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each shard, in the order of a hash."""
    subs = max(1, -(-n_rows // (shards * SLOT_ROWS)))
    rows = rows.withColumn("__sub", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(subs)))
    count = rows.groupBy("shard", "__sub").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("__sub")) - F.col("n")
    count = count.select("shard", "__sub", before.alias("__before"))
    order = Window.partitionBy("shard", "__sub").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("__ix", F.row_number().over(order)).join(count, ["shard", "__sub"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("__before") + F.col("__ix") - 1).cast("long").alias("slot")))
