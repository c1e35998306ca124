"""Substring dedup by sliding sentence spans (operator 5).

From every sentence on, the shortest run of at least ``k`` consecutive sentences
that has ``min_words`` words is hashed (128 bits, A-Z as a-z, words separated by any
white space).  Runs of
all texts meet by hash.  The occurrence in the smallest doc_id, and there the
first, stays; the sentences of every other occurrence are covered.  Covered sentences
that touch make one range, and a range of ``min_stretch`` words or more is removed: short
runs find a passage wherever it begins, the length of what they cover together tells
it from a repeated line.

With ``open_ends`` (where ``k`` has no part: one sentence of ``min_words`` words is a run)
a run may begin or end inside a sentence: every sentence is
hashed with what follows it, and again with what stands before it, up to
``min_words`` words (a longer sentence alone), and the whole sentences within are
its range.  A repeated passage of 2 * ``min_words`` words holds one of the two for
each sentence that is whole in both places, so all of these are found, and the
sentences of complete runs as well.  A passage without a whole sentence is left.

One scan emits a narrow row per run; no text is shuffled.  Repeated hashes are
found by a grouped minimum, which combines before the shuffle, and stored; the
join back to the runs has stored tables on both sides, so adaptive execution can
split a hash that a third of all documents share.

Edge cases: null or empty texts have no sentences; a text of fewer than ``k``
sentences has no runs; rows that repeat a doc_id count as the same document,
none of them a later copy of the other, and ranges are cut from the text they were
found in alone; a null doc_id is left alone; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldloom.llm.common import (_power_table, batch, char_offsets, mix64, on_executors, sentence_starts, signed, split_words, stored,
                                  text_pieces)

MIN_WORDS, MIN_STRETCH = 8, 25

RUN = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("ix", pa.int32()), ("last", pa.int32()),
                 ("start", pa.int32()), ("stop", pa.int32()), ("words", pa.int32()), ("upto", pa.int32()),
                 ("again", pa.bool_()), ("text_hash", pa.int64())])
RUN_DDL = "h1 long, h2 long, doc_id long, ix int, last int, start int, stop int, words int, upto int, again boolean, text_hash long"


def _runs(k: int, min_words: int, open_ends: bool = False):
    def run(batches):
        for b in batches:
            ids = b.column(0)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            texts = b.column(2).to_numpy(zero_copy_only=False)
            for i, data, bounds in text_pieces(b.column(1)):
                w = split_words(data, bounds)
                first = sentence_starts(w)
                stop = np.r_[first[1:], len(w.hash)]
                doc = np.searchsorted(w.first, first, "right") - 1
                at = np.arange(len(first))
                if open_ends:
                    at = at[valid[i + doc]]
                    more = np.maximum(min_words - (stop - first)[at], 0)
                    s, e = np.r_[first[at], first[at] - more], np.r_[stop[at] + more, stop[at]]
                    d = np.r_[doc[at], doc[at]]
                    fits = (s >= w.first[d]) & (e <= w.first[d + 1])
                    # a run back to a sentence's first word is that sentence's run onwards
                    fits[len(at):] &= ~np.isin(s[len(at):], first)
                    s, e = s[fits], e[fits]
                    at, last = np.searchsorted(first, s), np.searchsorted(stop, e, "right") - 1
                else:
                    last = np.maximum(at + k - 1, np.searchsorted(stop, first + min_words))  # the run's last sentence
                    at = at[last < len(first)]
                    at = at[(doc[at] == doc[last[at]]) & valid[i + doc[at]]]
                    last = last[at]
                    s, e = first[at], stop[last]
                if not len(at):
                    continue
                p, q = _power_table(len(w.hash))
                h = []
                for salt in (0, 0x51ED270B):
                    c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(w.hash + np.uint64(salt)) * p[:len(w.hash)])])
                    h.append(mix64((c[e] - c[s]) * q[s] + (e - s).astype(np.uint64)))
                d = doc[at]
                order = np.lexsort((s, h[1], h[0], d))  # within a text, later copies of a run come after the first
                same = np.zeros(len(at), dtype=bool)
                o = order
                same[o[1:]] = (d[o[1:]] == d[o[:-1]]) & (h[0][o[1:]] == h[0][o[:-1]]) & (h[1][o[1:]] == h[1][o[:-1]])
                chars = char_offsets(data)
                base = chars[bounds[d]]
                begin = np.searchsorted(first, w.first[d])  # the text's first sentence
                yield batch(RUN, signed(h[0]), signed(h[1]), ids[i + d], (at - begin).astype(np.int32),
                            (last - begin).astype(np.int32), (chars[w.start[first[at]]] - base).astype(np.int32),
                            (chars[w.end[stop[last] - 1]] - base).astype(np.int32), (first[at] - w.first[d]).astype(np.int32),
                            (stop[last] - w.first[d]).astype(np.int32), same, texts[i + d])
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, min_words: int = MIN_WORDS,
                   open_ends: bool = False, min_stretch: int = MIN_STRETCH) -> DataFrame:
    """One row per maximal range of sentences to remove: ``doc_id``, its first and
    last sentence (from 0), its character range ``[start, stop)``, the smallest
    ``kept_in`` document of the spans that cover it, and ``text_hash``, which tells
    the texts of rows with one doc_id apart.  A range of fewer than ``min_stretch`` words stays."""
    on_executors(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    spans = rows.mapInArrow(_runs(k, min_words, open_ends), RUN_DDL)
    key = ["h1", "h2"]
    seen = (spans.groupBy(*key).agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("top"),
                                    F.max(F.col("again").cast("int")).alias("twice"))
            .where("top > kept_in or twice = 1").select(*key, "kept_in"))
    seen = stored(seen, "repeated")
    later = (spans.join(seen, key).where("doc_id > kept_in or again")
             .select("doc_id", "text_hash", "ix", "last", "start", "stop", "words", "upto", "kept_in"))
    # islands of covered sentences per text
    order = Window.partitionBy("doc_id", "text_hash").orderBy("ix", "kept_in")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)) + 1
    island = F.sum((F.coalesce(reach, F.lit(-1)) < F.col("ix")).cast("int")).over(order)
    return (later.withColumn("island", island).groupBy("doc_id", "text_hash", "island")
            .agg(F.min("ix").alias("first_sentence"), F.max("last").alias("last_sentence"),
                 F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("kept_in").alias("kept_in"),
                 (F.max("upto") - F.min("words")).alias("n_words"))
            .where(F.col("n_words") >= min_stretch).drop("island", "n_words"))


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", only_cut: bool = False) -> DataFrame:
    """``docs`` with the ranges of ``spans`` cut out of the text; rows without a range are
    unchanged, also those that share a doc_id with a row that has one (``only_cut``: left out)."""
    own = [f"__cut{i}" for i in range(3)]
    while set(own) & set(docs.columns):
        own = [c + "_" for c in own]
    key, digest, ranges = own
    cut = (spans.groupBy(F.col("doc_id").alias(key), F.col("text_hash").alias(digest))
           .agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(ranges)))
    text = F.col(f"`{text_col}`")
    begins = F.concat(F.array(F.lit(0)), F.col(f"{ranges}.stop"))
    ends = F.concat(F.col(f"{ranges}.start"), F.array(F.length(text)))
    kept = F.array_join(F.transform(F.arrays_zip(begins.alias("a"), ends.alias("z")),
                                    lambda g: text.substr(g["a"] + 1, g["z"] - g["a"])), "")
    same = (F.col(f"`{id_col}`") == F.col(key)) & (F.xxhash64(text) == F.col(digest))
    # the ranges grow with the corpus, so they are not broadcast at any size
    return (docs.join(cut.hint("merge"), same, "inner" if only_cut else "left").withColumn(text_col, F.when(F.col(ranges).isNull(), text).otherwise(kept))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
