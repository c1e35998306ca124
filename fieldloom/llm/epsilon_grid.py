"""Embedding near-dedup by an epsilon grid order join (operator 2).

Two vectors of one label and one dimension link when their cosine is at least
``cosine``; for unit vectors that is a distance of at most
eps = sqrt(2 - 2 * cosine).  Unit vectors are rotated to their principal axes,
sorted by the eps-cells of the leading axes and cut into intervals (blocks).
Intervals of intervals form a tree per label; pairs of intervals are joined
recursively from the roots down, and a pair is skipped when the boxes around the
two intervals are provably further apart than eps.  Only pairs of blocks that
are left compare vectors, in double precision on the original values.

Equal vectors are one class, represented by the smallest vec_id, so copies cost
nothing.  A block pair returns each class's number of links and a spanning
forest of the links, never all pairs; the counts and components are exact.

The axes come from the second moments of all vectors, summed over all tasks;
the driver holds one d x d matrix per dimension.  A block has ``BLOCK`` vectors.

Edge cases: a null vec_id or label, a null, empty or zero vector, and null or
non-finite components link with nothing; such rows keep n_links 0 and are their
own component; rows that repeat a vec_id and its vector are copies of one
vector, and each copy is a link; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldloom.llm.common import batch, on_executors, runs, stored
from fieldloom.llm.graph import components

AXES = 16  # leading axes kept for the grid order and the boxes
FAN = 8  # intervals joined into one at the next level of the tree
BLOCK = 512


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(b: pa.RecordBatch):
    """(rows, matrix) of each dimension in a batch with columns (dim, vec, ...)."""
    dim = b.column(b.schema.get_field_index("dim")).to_numpy(zero_copy_only=False)
    vec = b.column(b.schema.get_field_index("vec"))
    for d in np.unique(dim):
        rows = np.flatnonzero(dim == d)
        yield int(d), rows, _matrix(vec.take(pa.array(rows)))


def _moments(batches):
    schema = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("moment", pa.float64())])
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for d, _, x in _by_dim(b):
            u = _unit(x)
            total[d] = total.get(d, 0) + u.T @ u
    for d, m in total.items():
        yield batch(schema, np.full(m.size, d, dtype=np.int32), np.arange(m.size, dtype=np.int32), m.ravel())


def _axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes (columns) per dimension."""
    m = classes.select("dim", "vec").mapInArrow(_moments, "dim int, at int, moment double").groupBy("dim", "at").agg(F.sum("moment"))
    found: dict[int, dict[int, float]] = {}
    for d, at, v in m.toLocalIterator():
        found.setdefault(d, {})[at] = v
    return {d: np.linalg.eigh(np.array([v[i] for i in range(d * d)]).reshape(d, d))[1][:, ::-1][:, :AXES] for d, v in found.items()}


PLACED = "rep long, copies long, label long, dim int, vec array<double>, cell array<int>, place array<double>"


def _place(axes, eps: float):
    """Grid cell and coordinates of each vector: its leading axes, and the length left over."""
    schema = pa.schema([("rep", pa.int64()), ("copies", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()),
                        ("vec", pa.list_(pa.float64())), ("cell", pa.list_(pa.int32())), ("place", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            for d, rows, x in _by_dim(b):
                u = _unit(x)
                p = u @ axes.value[d]
                rest = np.sqrt(np.maximum(0, 1 - (p * p).sum(axis=1)))
                place = np.column_stack([p, rest])
                cell = np.floor(p / eps).astype(np.int32)
                t = b.take(pa.array(rows))
                yield batch(schema, *(t.column(i) for i in range(4)), t.column(4).cast(pa.list_(pa.float64())),
                            pa.array(list(cell), pa.list_(pa.int32())), pa.array(list(place), pa.list_(pa.float64())))
    return run


BLOCK_ROW = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("reps", pa.binary()), ("copies", pa.binary()),
                       ("vecs", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
BLOCK_DDL = ("block long, label long, dim int, reps binary, copies binary, vecs binary, low array<double>, high array<double>")


def _blocks(batches):
    for t in runs(batches, "block"):
        x, place = _matrix(t.column("vec")), _matrix(t.column("place"))
        yield batch(BLOCK_ROW, [t.column("block")[0].as_py()], [t.column("label")[0].as_py()], [t.column("dim")[0].as_py()],
                    [t.column("rep").to_numpy().tobytes()], [t.column("copies").to_numpy().tobytes()], [x.tobytes()],
                    [place.min(axis=0).tolist()], [place.max(axis=0).tolist()])


LINK = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
LINK_DDL = "rep long, links long, root long"


def _scale(x: np.ndarray) -> np.ndarray:
    return x / np.abs(x).max(axis=1, keepdims=True)


def _compare(cosine: float):
    """Links of each pair of blocks: per vector the copies it links with, and the
    smallest vector of its connected part of the pair."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                same = r["block"] == r["block2"]
                x = _scale(np.frombuffer(r["vecs"], np.float64).reshape(-1, r["dim"]))
                ids, n = np.frombuffer(r["reps"], np.int64), np.frombuffer(r["copies"], np.int64)
                if same:
                    y, ids2, n2 = x, ids, n
                else:
                    y = _scale(np.frombuffer(r["vecs2"], np.float64).reshape(-1, r["dim"]))
                    ids2, n2 = np.frombuffer(r["reps2"], np.int64), np.frombuffer(r["copies2"], np.int64)
                link = (x @ y.T) / (np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt((y * y).sum(axis=1))[None, :]) >= cosine
                if same:
                    np.fill_diagonal(link, False)
                if not link.any():
                    continue
                rows, cols = link.any(axis=1), link.any(axis=0)
                root, root2 = _roots(ids, ids2, link)
                yield batch(LINK, ids[rows], link[rows] @ n2, root[rows])
                if not same:
                    yield batch(LINK, ids2[cols], n @ link[:, cols], root2[cols])
    return run


def _roots(ids, ids2, link):
    """Smallest id connected to each row and column of ``link``."""
    root, root2 = ids.copy(), ids2.copy()
    big = np.iinfo(np.int64).max
    while True:
        new2 = np.minimum(root2, np.where(link, root[:, None], big).min(axis=0))
        new = np.minimum(root, np.where(link, new2[None, :], big).min(axis=1))
        if (new == root).all() and (new2 == root2).all():
            return root, root2
        root, root2 = new, new2


def _apart(eps: float) -> str:
    """SQL: the boxes [low, high] and [low2, high2] are further apart than eps."""
    gap = "greatest(0D, low2[i] - high[i], low[i] - high2[i])"
    gap = f"transform(sequence(0, size(low) - 1), i -> {gap})"
    return f"aggregate({gap}, 0D, (s, g) -> s + g * g) > {(eps + 1e-9) ** 2!r}D"


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                cosine: float = 0.98, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row."""
    spark = vectors.sparkSession
    on_executors(spark)
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"),
                          F.col(label_col).cast("long").alias("label"))
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0)
           & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are one value
    rows = rows.withColumn("ok", F.coalesce(fit, F.lit(False))).withColumn("vec", F.transform(v, lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("h1", F.xxhash64("label", "vec")).withColumn("h2", F.xxhash64(F.lit(7), "vec", "label"))
    key = ["h1", "h2"]
    classes = stored(rows.where("ok").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                        F.first("label").alias("label"), F.first("vec").alias("vec"))
                     .withColumn("dim", F.size("vec")).select("rep", "copies", "label", "dim", "vec", *key), "classes")
    axes = spark.sparkContext.broadcast(_axes(classes))

    # the epsilon grid order, cut into intervals within a label and dimension
    placed = stored(classes.drop(*key).select("rep", "copies", "label", "dim", "vec").mapInArrow(_place(axes, eps), PLACED)
                    .repartitionByRange("label", "dim", "cell", "rep").sortWithinPartitions("label", "dim", "cell", "rep")
                    .withColumn("part", F.spark_partition_id()).withColumn("ix", F.monotonically_increasing_id()), "placed")
    # an interval: consecutive vectors of one sorted part; only intervals, not vectors, are numbered
    base = placed.groupBy("part", "label", "dim").agg(F.min("ix").alias("first"))
    cut = placed.join(base, ["part", "label", "dim"]).withColumn("at", F.expr(f"(ix - first) div {block}"))
    starts = cut.select("part", "label", "dim", "at").distinct()
    numbered = starts.withColumn("block", F.row_number().over(Window.partitionBy("label", "dim").orderBy("part", "at")).cast("long") - 1)
    numbered = stored(numbered.select("part", "label", "dim", "at", F.col("block").alias("seq"),
                                      F.xxhash64("label", "dim", "block").alias("block")), "intervals")
    blocks = (cut.join(numbered, ["part", "label", "dim", "at"])
              .select("block", "label", "dim", "rep", "copies", "vec", "place")
              .repartition("block").sortWithinPartitions("block").mapInArrow(_blocks, BLOCK_DDL))
    blocks = stored(blocks.join(numbered.select("block", "seq"), "block"), "blocks")

    pairs = _join_intervals(blocks.select("label", "dim", "seq", "block", "low", "high"), eps)
    data = blocks.select("block", "dim", "reps", "copies", "vecs")
    other = data.drop("dim").toDF("block2", "reps2", "copies2", "vecs2")
    links = stored(pairs.join(data, "block").join(other, "block2").mapInArrow(_compare(cosine), LINK_DDL), "links")
    count = links.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(links.select(F.col("rep").alias("b"), F.col("root").alias("a")))
    known = stored(classes.join(count, "rep", "left").join(comp, F.col("rep") == F.col("vertex"), "left")
                   .where("copies > 1 or links > 0")
                   .select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("component_id")), "known")
    out = rows.select("vec_id", "ok", *key).join(known, key, "left")
    component = F.when(F.col("ok"), F.coalesce("component_id", "vec_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("ok"), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _join_intervals(leaves: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks (block, block2) whose boxes are not provably apart, found
    from the widest intervals down to single blocks."""
    def up(level: DataFrame) -> DataFrame:
        box = [F.array(*[f(F.get(c, F.lit(i))) for i in range(AXES + 1)]).alias(c) for c, f in (("low", F.min), ("high", F.max))]
        return (level.groupBy("label", "dim", F.expr(f"seq div {FAN}").alias("seq")).agg(*box)
                .withColumn("low", F.filter("low", lambda x: x.isNotNull())).withColumn("high", F.filter("high", lambda x: x.isNotNull())))
    top = leaves.agg(F.max("seq")).first()[0]
    levels = [leaves]
    while top and top > 0:
        levels.append(stored(up(levels[-1]), "intervals"))
        top //= FAN
    pairs = levels[-1].select("label", "dim", F.col("seq").alias("a"), F.col("seq").alias("b"))
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        box = level.select("label", "dim", F.col("seq").alias("a"), "low", "high")
        box2 = level.select("label", "dim", F.col("seq").alias("b"), F.col("low").alias("low2"), F.col("high").alias("high2"))
        # two blocks of one interval are always near: only pairs of different ones are tested
        near = (pairs.join(box, ["label", "dim", "a"]).join(box2, ["label", "dim", "b"])
                .where(F.expr(f"a = b or not ({_apart(eps)})")).select("label", "dim", "a", "b"))
        if depth:
            child = F.expr(f"explode(sequence(0, {FAN - 1}))")
            near = (near.withColumn("i", child).withColumn("j", child)
                    .select("label", "dim", (F.col("a") * FAN + F.col("i")).alias("a"), (F.col("b") * FAN + F.col("j")).alias("b"))
                    .where("a <= b"))
            near = stored(near, "near")
        pairs = near
    names = leaves.select("label", "dim", F.col("seq").alias("a"), "block")
    names2 = leaves.select("label", "dim", F.col("seq").alias("b"), F.col("block").alias("block2"))
    return stored(pairs.join(names, ["label", "dim", "a"]).join(names2, ["label", "dim", "b"]).select("block", "block2"), "pairs")
