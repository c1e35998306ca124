"""Benchmark decontamination by spaced-seed hashing (operator 7).

Fixed masks pick some positions of a run of words and ignore the others, so a
substituted word at an ignored position leaves the hash unchanged.  Masked
hashes of the test items meet those of the training texts; around each hit the
two word sequences are aligned without gaps and the best segment that tolerates
substitutions (a match counts 1, a mismatch -``MISS``) is kept, among those that
have ``min_words`` matching words.

The items are the small, stated side.  They are hashed on the executors and sent
to the tasks in blocks of about ``block_words`` words, a fixed size; further
blocks mean further passes, never a larger broadcast.  The texts are not
shuffled.  Words are runs of letters, digits and non-ASCII characters, A-Z as
a-z, so spacing, case and punctuation do not hide a passage.

Edge cases: null or empty texts and items match nothing; an item shorter than
``min_words`` must match as a whole; repeated rows give repeated hits, merged per
(doc_id, item_id); null ids never match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import WORD_BYTES, batch, mix64, on_executors, split_words, text_pieces

# Fixed masks, 1: the word counts; six words each.
MASKS = ("11101101", "110100111", "1011100101", "11001010011")
MISS = 3
FILTER_BITS = 20


def _masked(h: np.ndarray, mask: str) -> np.ndarray:
    m = len(h) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(m, int(mask, 2) + (len(mask) << 20), dtype=np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m]
    return mix64(out)


def _item_words(batches):
    schema = pa.schema([("item_id", pa.int64()), ("n", pa.int64()), ("words", pa.binary())])
    for b in batches:
        ids, n, words = [], [], []
        for i, data, bounds in text_pieces(b.column(1)):
            w = split_words(data, bounds, WORD_BYTES)
            for j, (s, e) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                if e > s:
                    ids.append(b.column(0)[i + j].as_py())
                    n.append(e - s)
                    words.append(w.hash[s:e].tobytes())
        yield batch(schema, ids, n, words)


class Seeds:
    """Sorted masked hashes of a block of items and where each stands."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        self.words = [np.frombuffer(w, np.uint64) for _, w in items]
        # an item that no mask fits into is a mask of its own length
        short = sorted({len(w) for w in self.words if len(w) < max(map(len, MASKS))})
        self.masks = [*MASKS, *("1" * n for n in short)]
        h, item, at = [], [], []
        for k, w in enumerate(self.words):
            for m in self.masks:
                if m in MASKS or len(m) == len(w):
                    x = _masked(w, m)
                    h.append(x)
                    item.append(np.full(len(x), k))
                    at.append(np.arange(len(x)))
        h = np.concatenate(h) if h else np.zeros(0, dtype=np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.item, self.at = (np.concatenate(x)[order] if len(h) else np.zeros(0, dtype=np.int64) for x in (item, at))
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[h >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, h: np.ndarray):
        """(text position, item, item position) of equal masked hashes."""
        for m in self.masks:
            x = _masked(h, m)
            at = np.flatnonzero(self.maybe[x >> np.uint64(64 - FILTER_BITS)])
            if len(at):
                lo, hi = np.searchsorted(self.hash, x[at], "left"), np.searchsorted(self.hash, x[at], "right")
                n = hi - lo
                ends = np.cumsum(n)
                if ends[-1]:
                    pick = np.arange(ends[-1]) + np.repeat(lo - (ends - n), n)
                    yield np.repeat(at, n), self.item[pick], self.at[pick]


def best_segment(equal: np.ndarray, least: int = 0) -> tuple[int, int]:
    """The segment [s, e) of highest matches - MISS * mismatches, first of equals.
    If it has fewer than ``least`` matches, the best of the others that have as
    many, one from each point where the running score falls to 0 to the next."""
    c = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISS))])
    low = np.minimum.accumulate(c)
    e = int(np.argmax(c - low))
    best = (int(np.argmin(c[:e + 1])), e) if e else (0, 0)
    if equal[best[0]:best[1]].sum() >= least or equal.sum() < least:
        return best
    score, out = 0, best
    zero = np.flatnonzero(c == low)
    for s, z in zip(zero, np.append(zero[1:], len(c)), strict=True):
        e = int(s + np.argmax(c[s:z]))
        if c[e] - c[s] > score and equal[s:e].sum() >= least:
            score, out = c[e] - c[s], (int(s), e)
    return out


HIT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int64()), ("aligned", pa.int64()),
                 ("doc_word", pa.int64()), ("item_word", pa.int64())])
HIT_DDL = "doc_id long, item_id long, matched long, aligned long, doc_word long, item_word long"


def _search(seeds, min_words: int):
    def run(batches):
        s = _seeds(seeds)
        for b in batches:
            ids = b.column(0)
            rows = []
            for i, data, bounds in text_pieces(b.column(1)):
                w = split_words(data, bounds, WORD_BYTES)
                cells = set()
                for at, item, pos in s.hits(w.hash):
                    doc = np.searchsorted(w.first, at, "right") - 1
                    cells.update(zip(doc.tolist(), item.tolist(), (at - pos).tolist(), strict=True))
                for doc, item, shift in cells:  # shift: word of the text under the item's first word
                    if not ids[i + doc].is_valid:
                        continue
                    a, z = int(w.first[doc]), int(w.first[doc + 1])
                    q = s.words[item]
                    lo, hi = max(0, a - shift), min(len(q), z - shift)
                    if hi <= lo:
                        continue
                    equal = q[lo:hi] == w.hash[shift + lo:shift + hi]
                    x, y = best_segment(equal, min(min_words, len(q)))
                    n = int(equal[x:y].sum())
                    if n >= min(min_words, len(q)):
                        rows.append((ids[i + doc].as_py(), s.ids[item], n, y - x, shift + lo + x - a, lo + x))
            if rows:
                yield batch(HIT, *zip(*rows, strict=True))
    return run


_made: dict = {}


def _seeds(shared) -> Seeds:
    items = shared.value
    key = (len(items), hash(tuple(i for i, _ in items)), hash(b"".join(w for _, w in items)))
    if key not in _made:
        _made.clear()
        _made[key] = Seeds(items)
    return _made[key]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", min_words: int = 13, block_words: int = 250_000) -> DataFrame:
    """One row per document and test item that overlap: ``matched`` words within an
    ``aligned`` segment that begins at ``doc_word`` of the text and ``item_word`` of
    the item (the best segment, the first of equals)."""
    spark = docs.sparkSession
    on_executors(spark)
    words = (items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
             .where("item_id is not null and text is not null")
             .mapInArrow(_item_words, "item_id long, n long, words binary"))
    total = words.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words)
    words = words.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(max(1, blocks))))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], HIT_DDL)
    for k in range(blocks):
        block = sorted((r["item_id"], bytes(r["words"])) for r in words.where(F.col("block") == k).toLocalIterator())
        if block:
            found = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), min_words), HIT_DDL)
            out = found if k == 0 else out.union(found)
    rank = F.struct((-F.col("matched")).alias("m"), "aligned", "doc_word", "item_word")
    return (out.groupBy("doc_id", "item_id").agg(F.min(rank).alias("b"))
            .select("doc_id", "item_id", (-F.col("b.m")).alias("matched"), "b.aligned", "b.doc_word", "b.item_word"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` without the rows whose text overlaps a test item."""
    bad = contaminated(docs, items, id_col, **kw).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
