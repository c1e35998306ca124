"""N-gram Jaccard join by a token-group matrix (operator 3).

Documents whose sets have the same smallest shingle hash form a group (large
groups are cut into chunks).  A group's matrix row is the union of its
members' shingles.  A query set can be similar to a member only if the part
of it that the union covers reaches the threshold; only then is the group
opened and its members compared exactly.

Steps:
1. One scan hashes each text's distinct k-word shingles and keeps per document
   the set's size, a 128-bit digest and the smallest hash, and per task a table
   of shingle counts in ``buckets`` cells (a fixed size, summed over all tasks;
   more cells order the shingles of a larger corpus better, results are equal).
2. Equal digests are one class, represented by its smallest doc_id.
3. A second scan orders each set by (bucket count, hash), rare shingles first,
   and emits the prefix that any similar set must share a shingle with, under
   the group's key.  Groups that share such a shingle, whose sizes fit and whose
   orders have enough left from it on, are
   the candidate cells of the matrix.
4. Texts of candidate groups alone are read again and stored as group rows:
   the union and a bit per member and token.
5. Each candidate pair of groups bounds the overlap of every member with the
   other union, opens what qualifies, and counts exact intersections.  Only a
   spanning forest of the links found leaves the task, so a group of near
   copies costs a row per member and not a row per pair.  Each group is opened
   by itself and with one candidate first; pairs of groups that lie whole in one
   component by then are settled, the others are opened next.

No link is lost: the prefix and the bound are necessary conditions, and no
partner, candidate or group is capped.

Edge cases: null text and text without words have an empty set and link with
nothing; fewer than k words are one shingle; rows that repeat a doc_id are one
vertex, which has the links of all its texts (a row without words keeps its own id as
its component); a null doc_id links with nothing and its component is null; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import (batch, mix64, on_executors, runs, shingle_sets, signed, split_words, stored, text_pieces)
from fieldloom.llm.graph import components

SCAN = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("grp", pa.int64()),
                  ("slice", pa.int64()), ("task", pa.int64()), ("counts", pa.binary())])
SCAN_DDL = "doc_id long, n long, d1 long, d2 long, grp long, slice long, task long, counts binary"
SLICE, FAN = 1 << 20, 64  # count cells per stored slice; tasks whose tables are summed at a time
GROUP_DOCS, GROUP_SHINGLES = 128, 2_000_000  # a larger group is cut into chunks; chunks meet pairwise


def _need(n, percent):
    """Smallest overlap that a set of n can have with a similar set."""
    return (percent * n + 99) // 100


def _digest(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits of a shingle set."""
    m = mix64(s)
    return m.sum(dtype=np.uint64), mix64(m + np.uint64(77)).sum(dtype=np.uint64)


def _scan(k: int, buckets: int):
    shift = np.uint64(64 - buckets.bit_length() + 1)

    def run(batches):
        counts = np.zeros(buckets, dtype=np.int32)
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            rows: list = []
            for i, data, bounds in text_pieces(texts):
                for j, s in enumerate(shingle_sets(split_words(data, bounds), k)):
                    if len(s):
                        np.add.at(counts, (s >> shift).astype(np.int64), 1)
                        rows.append((i + j, len(s), *_digest(s), s[0]))
                    else:
                        rows.append((i + j, 0, 0, 0, 0))
            ix, n, d1, d2, g = (list(x) for x in zip(*rows, strict=True)) if rows else ([],) * 5
            none = pa.nulls(len(ix), pa.int64())
            yield batch(SCAN, b.column(0), n, *(signed(np.array(x, dtype=np.uint64)) for x in (d1, d2, g)), none, none,
                        pa.nulls(len(ix), pa.binary()))
        task = TaskContext.get().partitionId()
        full = [s for s in range(0, buckets, SLICE) if counts[s:s + SLICE].any()]
        if full:
            none = pa.nulls(len(full), pa.int64())
            yield batch(SCAN, *(none,) * 5, [s // SLICE for s in full], [task] * len(full),
                        [_pack(counts[s:s + SLICE]) for s in full])
    return run


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(x.astype(np.int32).tobytes(), 1)


def _unpack(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), dtype=np.int32)


def _levels(scan: DataFrame, buckets: int) -> np.ndarray:
    """Per cell, a byte that grows with the logarithm of its count.  The tasks'
    tables are summed ``FAN`` at a time, level by level; the result has ``buckets``
    bytes whatever the size of the corpus."""
    def add(key, pdf):
        import pandas as pd
        out = sum(map(_unpack, pdf["counts"]))
        return pd.DataFrame({"slice": [key[0]], "task": [key[1]], "counts": [_pack(out)]})
    part = scan.where("slice is not null").select("slice", "task", "counts")
    last = part.agg(F.max("task")).first()[0] or 0
    while last > 0:
        last //= FAN
        part = (part.withColumn("task", F.expr(f"task div {FAN}")).groupBy("slice", "task")
                .applyInPandas(add, "slice long, task long, counts binary"))
    out = np.zeros(buckets, dtype=np.uint8)
    # one job, whatever the number of partitions: a row per slice, ``buckets`` bytes in all
    for r in part.select("slice", "counts").mapInArrow(_logs, "slice long, level binary").collect():
        level = np.frombuffer(zstandard.decompress(bytes(r["level"])), dtype=np.uint8)
        out[r["slice"] * SLICE:r["slice"] * SLICE + len(level)] = level
    return out


def _logs(batches):
    schema = pa.schema([("slice", pa.int64()), ("level", pa.binary())])
    for b in batches:
        level = (np.minimum(255, np.round(8 * np.log2(1.0 + _unpack(x)))).astype(np.uint8) for x in b.column(1).to_pylist())
        yield batch(schema, b.column(0), [zstandard.compress(x.tobytes(), 1) for x in level])


POSTING = pa.schema([("token", pa.int64()), ("grp", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("rest", pa.int32())])
POSTING_DDL = "token long, grp long, lo int, hi int, rest int"


def _postings(k: int, percent: int, levels):
    def run(batches):
        level = levels.value
        shift = np.uint64(64 - len(level).bit_length() + 1)
        seen: set = set()
        for b in batches:
            ids = b.column(0)
            tok, grp, size, rest = [], [], [], []
            for i, data, bounds in text_pieces(b.column(1)):
                for j, s in enumerate(shingle_sets(split_words(data, bounds), k)):
                    n = len(s)
                    if not n or not ids[i + j].is_valid:
                        continue
                    d = (n, int(s.sum(dtype=np.uint64)), int(s[-1]))
                    if d in seen:  # a copy that this task has met posts nothing new
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(d)
                    rare = np.argsort(level[(s >> shift).astype(np.int64)], kind="stable")[:n - _need(n, percent) + 1]
                    tok.append(s[rare])
                    grp.append(np.full(len(rare), s[0]))
                    size.append(np.full(len(rare), n, dtype=np.int32))
                    rest.append(np.arange(n, n - len(rare), -1, dtype=np.int32))  # shingles from here on in the order
            if tok:
                n = pa.array(np.concatenate(size), pa.int32())
                yield batch(POSTING, signed(np.concatenate(tok)), signed(np.concatenate(grp)), n, n, np.concatenate(rest))
    return run


PAIR = pa.schema([("g", pa.int64()), ("h", pa.int64())])


def _meet(percent: int):
    """Pairs of groups in each token's run, where some sizes can reach the threshold."""
    def run(batches):
        held = None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            held = [x[cut:] for x in cols]
            yield from _pairs([x[:cut] for x in cols], percent)
            if len(held[0]) > 4096:  # a long run: fold rows of one group
                held = _fold(held)
        if held is not None:
            yield from _pairs(held, percent)
    return run


def _fold(cols):
    """One row per token and group, tokens and groups in order."""
    tok, grp = cols[:2]
    if not len(tok):
        return cols
    order = np.lexsort((grp, tok))
    tok, grp, lo, hi, rest = (x[order] for x in cols)
    new = np.flatnonzero(np.r_[True, (tok[1:] != tok[:-1]) | (grp[1:] != grp[:-1])])
    return [tok[new], grp[new], np.minimum.reduceat(lo, new), np.maximum.reduceat(hi, new), np.maximum.reduceat(rest, new)]


def _pairs(cols, percent):
    tok, grp, lo, hi, rest = (x.astype(np.int64) for x in _fold(cols))
    i = np.arange(len(tok))
    d = 0
    found, rows = [], 0
    while True:
        d += 1
        i = i[i + d < len(tok)]
        i = i[tok[i] == tok[i + d]]
        if not len(i):
            break
        j = i + d
        # sizes must fit, and what follows the shared shingle in both orders must reach the smallest overlap of such sizes
        ok = ((100 * hi[i] >= percent * lo[j]) & (100 * hi[j] >= percent * lo[i])
              & ((100 + percent) * np.minimum(rest[i], rest[j]) >= percent * (lo[i] + lo[j])))
        if ok.any():
            found.append(np.stack([np.minimum(grp[i], grp[j])[ok], np.maximum(grp[i], grp[j])[ok]]))
            rows += found[-1].shape[1]
        if rows > 200_000:
            yield _unique_pairs(found)
            found, rows = [], 0
    if found:
        yield _unique_pairs(found)


def _unique_pairs(found):
    p = np.concatenate(found, axis=1)
    p = p[:, np.lexsort(p[::-1])]
    keep = np.r_[True, (p[:, 1:] != p[:, :-1]).any(axis=0)]
    return batch(PAIR, p[0][keep], p[1][keep])


GROUP = pa.schema([("gid", pa.int64()), ("ids", pa.binary()), ("tokens", pa.binary()), ("bits", pa.binary()),
                   ("a", pa.binary()), ("b", pa.binary())])
GROUP_DDL = "gid long, ids binary, tokens binary, bits binary, a binary, b binary"
WIDTH = 6  # bytes kept of a shingle's hash in a matrix row


def _narrow(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH]).tobytes()


def _wide(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // WIDTH, 8), dtype=np.uint8)
    out[:, :WIDTH] = np.frombuffer(x, np.uint8).reshape(-1, WIDTH)
    return out.reshape(-1).view("<u8")


def _group_rows(k: int, percent: int):
    """One matrix row per group: the token union, a bit per member and token
    (both only if the group meets others), and the links within the group."""
    def run(batches):
        low = np.uint64((1 << 8 * WIDTH) - 1)
        for t in runs(batches, "gid"):
            ids, full = t.column("doc_id").to_numpy(), []
            for _, data, bounds in text_pieces(t.column("text")):
                full += shingle_sets(split_words(data, bounds), k)
            at = np.arange(len(ids))
            if len(np.unique(ids)) < len(ids):  # an id came with several texts: the class's own text stays, once
                d1, d2 = (t.column(c).to_numpy().view(np.uint64) for c in ("d1", "d2"))
                own = [i for i in at if len(full[i]) and _digest(full[i]) == (d1[i], d2[i])]
                at = np.array(sorted({(ids[i], d1[i], d2[i]): i for i in reversed(own)}.values()), dtype=np.int64)
            ids, sets = ids[at], [np.unique(full[i] & low) for i in at]
            union = np.unique(np.concatenate(sets))
            bits = b"".join(np.packbits(np.isin(union, s, assume_unique=True)).tobytes() for s in sets)
            ids, tokens = ids.astype(np.int64).tobytes(), _narrow(union)
            x = _Group(ids, tokens, bits)
            ox, oy, link = _linked(x, x, percent) if len(sets) > 1 else (x.ids[:0], x.ids[:0], np.zeros((0, 0), dtype=bool))
            a, b = _stars(_forest(x.ids[ox], x.ids[oy], link))
            meets = t.column("meets")[0].as_py()
            yield batch(GROUP, [t.column("gid")[0].as_py()], [ids], [tokens if meets else None], [bits if meets else None],
                        [a.tobytes()], [b.tobytes()])
    return run


EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
BLOCK = 1 << 16


class _Group:
    def __init__(self, ids, tokens, bits):
        self.ids, self.union = np.frombuffer(ids, np.int64), _wide(tokens)
        self.packed = np.frombuffer(bits, np.uint8).reshape(len(self.ids), -1)
        self.sizes = np.bitwise_count(self.packed).sum(axis=1, dtype=np.int64)

    def bits(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Which of the union's ``columns`` the members ``rows`` hold."""
        return self.packed[np.ix_(rows, columns >> 3)] >> (7 - (columns & 7)).astype(np.uint8) & 1


def _linked(x: _Group, y: _Group, percent: int) -> tuple:
    """Members of x and of y that open the other group, and which of them link."""
    _, in_x, in_y = np.intersect1d(x.union, y.union, assume_unique=True, return_indices=True)
    sides = []
    for g, place in ((x, in_x), (y, in_y)):
        everyone = np.arange(len(g.ids))
        covered = np.zeros(len(g.ids), dtype=np.int64)  # the bound: how much the other union covers
        for s in range(0, len(place), BLOCK):
            covered += g.bits(everyone, place[s:s + BLOCK]).sum(axis=1, dtype=np.int64)
        sides.append(np.flatnonzero(100 * covered >= percent * g.sizes))
    open_x, open_y = sides
    inter = np.zeros((len(open_x), len(open_y)), dtype=np.int64)
    if inter.size:
        for s in range(0, len(in_x), BLOCK):
            a, b = x.bits(open_x, in_x[s:s + BLOCK]), y.bits(open_y, in_y[s:s + BLOCK])
            inter += np.rint(a.astype(np.float32) @ b.T.astype(np.float32)).astype(np.int64)
    both = x.sizes[open_x][:, None] + y.sizes[open_y][None, :] - inter
    return open_x, open_y, 100 * inter >= percent * both


def _forest(ix: np.ndarray, iy: np.ndarray, link: np.ndarray):
    """Star edges that connect what ``link`` connects."""
    todo = link.any(axis=1)
    while todo.any():
        rows = np.zeros(len(ix), dtype=bool)
        rows[np.argmax(todo)] = True
        cols = np.zeros(len(iy), dtype=bool)
        while True:
            c = link[rows].any(axis=0)
            r = link[:, c].any(axis=1) | rows
            if (c == cols).all() and (r == rows).all():
                break
            rows, cols = r, c
        ids = np.unique(np.r_[ix[rows], iy[cols]])
        yield np.full(len(ids) - 1, ids[0]), ids[1:]
        todo &= ~rows


def _stars(parts) -> tuple[np.ndarray, np.ndarray]:
    parts = list(parts) or [(np.zeros(0, dtype=np.int64),) * 2]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _open(percent: int):
    """Links between the two groups of each row."""
    def run(batches):
        for b in batches:
            found = []
            for r in b.to_pylist():
                x, y = _Group(r["ids"], r["tokens"], r["bits"]), _Group(r["ids2"], r["tokens2"], r["bits2"])
                ox, oy, link = _linked(x, y, percent)
                found += _forest(x.ids[ox], y.ids[oy], link)
            if found:
                yield batch(EDGE, *_stars(found))
    return run


def _inner_links(batches):
    for b in batches:
        yield batch(EDGE, *(np.frombuffer(b"".join(b.column(i).to_pylist()), np.int64) for i in (0, 1)))


def _edges(pairs: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """Links found by opening the two groups of each pair.  The first group's row is
    sent once for each of its pairs and the second's once at all, so the group
    with more pairs goes second."""
    ends = pairs.select(F.col("gid").alias("x")).union(pairs.select("gid2"))
    many = ends.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    swap = F.col("n") > F.col("n2")
    pairs = stored(pairs.join(many.toDF("gid", "n"), "gid").join(many.toDF("gid2", "n2"), "gid2")
                   .select(F.when(swap, F.col("gid2")).otherwise(F.col("gid")).alias("gid"),
                           F.when(swap, F.col("gid")).otherwise(F.col("gid2")).alias("gid2")), "oriented-pairs")
    rows = matrix.select("gid", "ids", "tokens", "bits").where("tokens is not null")
    other = rows.toDF("gid2", "ids2", "tokens2", "bits2").join(pairs.select("gid2").distinct(), "gid2", "left_semi")
    both = pairs.join(rows, "gid").join(other, "gid2").select(*rows.columns, *other.columns)
    return both.mapInArrow(_open(percent), "a long, b long")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    buckets: int = 1 << 24) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per input row: documents
    link when 100 * |intersection| >= percent * |union| of their shingle sets,
    and ``component_id`` is the smallest doc_id that links reach."""
    spark = docs.sparkSession
    on_executors(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scan = stored(docs.mapInArrow(_scan(k, buckets), SCAN_DDL), "scan")
    rows = scan.where("slice is null").select("doc_id", "n", "d1", "d2", "grp")
    levels = spark.sparkContext.broadcast(_levels(scan, buckets))

    usable = rows.where("doc_id is not null and n > 0")
    classes = stored(usable.groupBy("d1", "d2", "n", "grp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    chunks = F.greatest(F.expr(f"ceil(count(1) / {GROUP_DOCS})"), F.expr(f"ceil(sum(n) / {GROUP_SHINGLES})"))
    groups = stored(classes.groupBy("grp").agg(chunks.cast("long").alias("chunks"), F.count(F.lit(1)).alias("members")),
                    "groups")

    posted = (docs.mapInArrow(_postings(k, percent, levels), POSTING_DDL)
              .repartition("token").sortWithinPartitions("token"))
    cells = posted.mapInArrow(_meet(percent), "g long, h long").distinct()
    own = groups.where("members > 1").select(F.col("grp").alias("g"), F.col("grp").alias("h"))
    size = groups.select("grp", "chunks")
    pairs = stored(
        cells.union(own).join(size.toDF("g", "cg"), "g").join(size.toDF("h", "ch"), "h")
        .select("g", "h", "ch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cg") - 1)).alias("i"))
        .select("g", "h", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ch") - 1)).alias("j"))
        .where("g <> h or i <= j")
        .select(F.xxhash64("g", "i").alias("x"), F.xxhash64("h", "j").alias("y"))
        .select(F.least("x", "y").alias("gid"), F.greatest("x", "y").alias("gid2")).distinct(), "pairs")

    ends = pairs.where("gid <> gid2").select(F.col("gid").alias("x"), F.col("gid2").alias("y"))
    both = ends.union(ends.select("y", "x"))
    needed = (both.select(F.col("x").alias("gid"), F.lit(True).alias("meets")).union(pairs.where("gid = gid2").select("gid", F.lit(False)))
              .groupBy("gid").agg(F.max("meets").alias("meets")))
    members = stored(classes.join(groups, "grp").select("rep", "d1", "d2", F.expr("xxhash64(grp, pmod(xxhash64(rep), chunks))").alias("gid"))
                     .join(needed, "gid"), "members")
    # the members grow with the corpus, so they are not broadcast at any size
    opened = (docs.join(members.hint("merge"), F.col("doc_id") == F.col("rep")).select("gid", "doc_id", "text", "meets", "d1", "d2")
              .repartition("gid").sortWithinPartitions("gid"))
    matrix = stored(opened.mapInArrow(_group_rows(k, percent), GROUP_DDL), "matrix")

    # links within groups and with one other candidate each; what that connects needs no further comparison
    nearest = both.groupBy("x").agg(F.min("y").alias("y")).select(F.least("x", "y").alias("gid"), F.greatest("x", "y").alias("gid2"))
    first = stored(nearest.distinct(), "first-pairs")
    inner = matrix.where("length(a) > 0").select("a", "b").mapInArrow(_inner_links, "a long, b long")
    # an id with several texts is one vertex: it links the classes of all its texts
    several = (usable.groupBy("doc_id").agg(F.min("d1").alias("low"), F.max("d1").alias("high"), F.min("d2").alias("low2"), F.max("d2").alias("high2"))
               .where("low <> high or low2 <> high2").select("doc_id"))
    same_id = (usable.join(several, "doc_id", "left_semi").join(classes, ["d1", "d2", "n"])
               .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = stored(inner.union(_edges(first, matrix, percent)).union(same_id), "links")
    comp = stored(components(found), "parts")
    whole = (members.join(comp, F.col("rep") == F.col("vertex"), "left").groupBy("gid")
             .agg(F.min(F.coalesce("component", "rep")).alias("part"), F.max(F.coalesce("component", "rep")).alias("high"))
             .where("part = high").select("gid", "part"))
    rest = (pairs.where("gid <> gid2").join(first, ["gid", "gid2"], "left_anti").join(whole, "gid", "left")
            .join(whole.toDF("gid2", "part2"), "gid2", "left").where("not coalesce(part = part2, false)").select("gid", "gid2"))
    more = _edges(stored(rest, "rest-pairs"), matrix, percent)
    comp = components(comp.select(F.col("component").alias("a"), F.col("vertex").alias("b")).union(more))

    known = stored(classes.join(comp, F.col("rep") == F.col("vertex"), "left").where("copies > 1 or component is not null")
                   .select("d1", "d2", "n", F.coalesce("component", "rep").alias("component")), "known")
    return (rows.join(known, ["d1", "d2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("component", "doc_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))
