"""Phrase collocations by Toivonen's sampled mining (operator 13).

1. A sample of the text's pieces is mined level by level with a lowered least count.
   It proposes phrases of 1 to ``max_words`` words; nothing else depends on it.
2. One pass over all texts counts exactly every proposed phrase and its negative
   border: the phrases that are not proposed while both their parts of one word less
   are.  All single words are counted.
3. A border phrase that turns out frequent is a failure: phrases that hold it were not
   counted.  While there are failures, an expansion pass counts the closure of the
   border over what is frequent: every phrase not counted so far, none of whose parts
   is known to be infrequent.  Every frequent phrase is then counted, whatever the
   sample was (an empty sample only makes the expansion larger), so the loop ends.

A task cuts a block of texts into words, numbers words and phrases exactly (by
dictionary, no hashes) and counts within the block; Spark adds the counts up by
(lang, phrase) with partial aggregation, so a frequent phrase is no hot key.

The proposed phrases and the frequent ones reach the tasks as bit tables of
``2**FILTER_BITS`` bits, broadcast (8 MB each at 26 bits, whatever the input).
A phrase that is taken for a member by a false positive is counted needlessly, and
dropped by its exact count; none is ever missed.  Tables that fill up cost time, not
results; ``filter_bits`` is a parameter.

Edge cases: null text is empty; null lang is ``und``; a piece shorter than a phrase
holds none; repeated rows count each; an empty table gives no rows; words may be of
any length; other columns are ignored, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import Words, byte_set, mix64, on_executors, split_words, stored, text_pieces

BLOCK_BYTES = 1 << 20
FILTER_BITS = 26
SAMPLE = 0.15

# Bytes that end a piece, and the lang of a null.
PIECE_ENDS = byte_set(b".,;:!?\n\x0b\x0c\r")
IN_WORD = ~(PIECE_ENDS | byte_set(b" \t"))
NO_LANG = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNTS = "lang string, phrase string, f long"


# --- membership ---------------------------------------------------------------------

def _bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """A table of ``2**bits`` bits in which the places of all ``h`` are set.  Spark builds
    it in rows of 4 KB; the driver gets at most ``2**bits / 8`` bytes."""
    place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    rows = (hashes.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect())
    table = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r.m), dtype=np.uint8)
        at = (r.b - 1) * len(part)
        table[at:at + len(part)] = part[:len(table) - at]
    return table


def _member(table: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if table is None:
        return np.zeros(len(h), dtype=bool)
    place = (h & np.uint64(len(table) * 8 - 1)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs] or [0], dtype=np.uint64)


def _longer(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the phrases of one word more: ``h[i]`` and the word at the phrase's end."""
    return mix64(h * np.uint64(0x9E3779B97F4A7C15) + first)


# --- a block of texts ---------------------------------------------------------------

class Block:
    """Words of a block of texts with the levels of phrases above them.  Level k has, for
    each word place, whether a phrase of k words begins there, its hash, and for wanted
    places an exact number."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lang_of_text: np.ndarray, lang_hash: np.ndarray):
        w = self.words = split_words(data, bounds, IN_WORD)
        self.lang = np.repeat(lang_of_text, np.diff(w.first))
        n = self.n = len(w.hash)
        size = (w.end - w.start).astype(np.int64)
        # lower-cased words, each with a blank behind it: phrases are stretches of this
        self.offset = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
        self.buffer = np.full(int(self.offset[-1]), 32, dtype=np.uint8)
        at = np.arange(int(size.sum())) + np.repeat(np.arange(n), size)
        self.buffer[at] = _LOWER[data[IN_WORD[data]]]
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(w.first))
        piece = np.concatenate([[0], np.cumsum(PIECE_ENDS[data])])[w.start]
        self.joined = np.zeros(n, dtype=bool)  # the next word is in the same piece
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.first_hash = mix64(w.hash + lang_hash[self.lang]) if n else np.zeros(0, dtype=np.uint64)

    def word_numbers(self) -> np.ndarray:
        keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(self.offset), pa.py_buffer(self.buffer)])
        number = keys.dictionary_encode().indices.to_numpy().astype(np.int64)
        return np.unique(self.lang.astype(np.int64) << 40 | number, return_inverse=True)[1] if self.n else number

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        """The texts of the phrases of k words that begin at the places ``at``."""
        begin, stop = self.offset[at], self.offset[at + k] - 1
        size = stop - begin
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.buffer[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)]
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def levels(block: Block, max_words: int, proposed, frequent, expand: bool):
    """Per level k: the places whose phrase is to be counted, their exact numbers and all hashes.

    Main pass (``expand`` false): phrases both of whose parts are proposed.  Expansion:
    phrases that the main pass left out while no part of theirs is known to be
    infrequent."""
    h = block.first_hash
    begins = np.ones(block.n, dtype=bool)
    counted, number = begins, block.word_numbers()
    was_proposed = _member(proposed, h)
    alive = _member(frequent, h) if expand else was_proposed
    yield 1, (np.zeros(0, dtype=np.int64) if expand else np.arange(block.n)), number, h
    for k in range(2, max_words + 1):
        if block.n < 2:
            return
        begins = np.append(begins[1:], False) & block.joined
        both = lambda x: begins & x & np.append(x[1:], False)
        h = _longer(h, np.append(block.first_hash[k - 1:], np.zeros(k - 1, dtype=np.uint64)))
        counted, candidate = both(was_proposed), both(alive)
        was_proposed = counted & _member(proposed, h)
        wanted = np.flatnonzero(candidate)
        next_number = np.zeros(block.n, dtype=np.int64)
        next_number[wanted] = np.unique(number[wanted] << 32 | number[wanted + 1], return_inverse=True)[1]
        number = next_number
        if expand:
            alive = candidate & (~counted | _member(frequent, h))
            yield k, np.flatnonzero(candidate & ~counted), number, h
        else:
            alive = was_proposed
            yield k, wanted, number, h


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    langs = batch.column(1).fill_null(NO_LANG).dictionary_encode()
    names = langs.dictionary.to_pylist()
    hashes, of_row = _lang_hashes(names), langs.indices.to_numpy()
    for i, data, bounds in text_pieces(batch.column(0), BLOCK_BYTES):
        block = Block(data, bounds, of_row[i:i + len(bounds) - 1], hashes)
        block.langs = names
        yield block


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))


def _distinct(number: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct number among the places ``at``, and how many places it has."""
    _, first, count = np.unique(number[at], return_index=True, return_counts=True)
    return at[first], count


def _count_pass(texts: DataFrame, max_words: int, proposed, frequent=None) -> DataFrame:
    """Exact counts ``(lang, phrase, f)`` of the phrases of one pass; the main pass also
    gives each lang's number of words under the empty phrase."""
    expand = frequent is not None
    share = texts.sparkSession.sparkContext.broadcast((proposed, frequent))

    def run(batches: Iterator[pa.RecordBatch]):
        proposed, frequent = share.value
        for batch in batches:
            for block in _blocks(batch):
                names = pa.array(block.langs, pa.string())
                if not expand and block.n:
                    count = np.bincount(block.lang, minlength=len(names))
                    yield pa.RecordBatch.from_arrays([names, pa.array([""] * len(names)), pa.array(count, pa.int64())], names=["lang", "phrase", "f"])
                for k, wanted, number, _ in levels(block, max_words, proposed, frequent, expand):
                    at, count = _distinct(number, wanted)
                    for s in range(0, len(at), 1 << 16):
                        part = at[s:s + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(block.lang[part])), block.phrases(part, k).cast(pa.string()),
                                                          pa.array(count[s:s + (1 << 16)], pa.int64())], names=["lang", "phrase", "f"])
    return texts.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _sampled(texts: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The texts with only a sample of their pieces left, drawn piece by piece."""
    def run(batches: Iterator[pa.RecordBatch]):
        base = np.uint64(mix64(np.array([TaskContext.get().partitionId() + (seed << 32)], dtype=np.uint64))[0])
        seen = 0
        for batch in batches:
            for i, data, bounds in text_pieces(batch.column(0), BLOCK_BYTES):
                piece = np.concatenate([[0], np.cumsum(PIECE_ENDS[data])])[:len(data)]
                piece += np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                draw = mix64(np.arange(seen, seen + (int(piece[-1]) + 1 if len(piece) else 0), dtype=np.uint64) + base)
                seen += len(draw)
                kept = PIECE_ENDS[data] | ((draw >> np.uint64(11)) * 2.0 ** -53 < fraction)[piece] if len(data) else np.zeros(0, dtype=bool)
                cuts = np.concatenate([[0], np.cumsum(kept)])[bounds]
                text = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data[kept])])
                yield pa.RecordBatch.from_arrays([text.cast(pa.string()), batch.column(1).slice(i, len(bounds) - 1)], names=["text", "lang"])
    return texts.mapInArrow(run, "text string, lang string")


def propose(texts: DataFrame, max_words: int, least: int, fraction: float, seed: int, bits: int) -> np.ndarray:
    """The bit table of the phrases that a sample finds ``least`` times, mined level by level."""
    spark = texts.sparkSession
    sample = stored(_sampled(texts, fraction, seed), "sample")
    table = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for level in range(1, max_words + 1):
        share = spark.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], level=level, share=share):
            for batch in batches:
                for block in _blocks(batch):
                    for k, wanted, number, h in levels(block, level, share.value, None, False):
                        if k == level:
                            at, count = _distinct(number, wanted)
                            yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(count, pa.int64())], names=["h", "c"])
        found = sample.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
        table = table | _bit_table(found, bits)
    return table


def _hashed(phrases: DataFrame, proposed) -> DataFrame:
    """``h`` of each phrase, and whether it is proposed."""
    share = phrases.sparkSession.sparkContext.broadcast(proposed)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in _blocks(batch):
                w: Words = block.words
                first, size = w.first[:-1], np.diff(w.first)
                h = block.first_hash[first]
                for k in range(1, int(size.max(initial=1))):
                    more = size > k
                    h[more] = _longer(h[more], block.first_hash[first[more] + k])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(_member(share.value, h))], names=["h", "proposed"])
    return phrases.select(F.col("phrase").alias("text"), "lang").mapInArrow(run, "h long, proposed boolean")


def frequent_phrases(df: DataFrame, min_count: int = 30, max_words: int = 4, text_col: str = "text", lang_col: str = "lang",
                     fraction: float = SAMPLE, sample_least: int | None = None, seed: int = 42, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(phrases, totals)``: ``(lang, phrase, f)`` of all phrases of 1 to ``max_words``
    words that occur ``min_count`` times or more, and ``(lang, n)``."""
    if min_count < 1 or max_words < 1 or not 0 <= fraction <= 1 or not 15 <= filter_bits <= 31:
        raise ValueError("min_count, max_words, fraction or filter_bits out of range")
    on_executors(df.sparkSession)
    texts = _texts(df, text_col, lang_col)
    least = sample_least if sample_least is not None else max(2, int(min_count * fraction / 2))
    proposed = propose(texts, max_words, least, fraction, seed, filter_bits)
    main = stored(_count_pass(texts, max_words, proposed).where((F.col("f") >= min_count) | (F.col("phrase") == "")), "counted")
    totals = main.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    found = main.where(F.col("phrase") != "")
    hashed = stored(_hashed(found, proposed), "frequent")
    if max_words > 1 and not hashed.where(~F.col("proposed")).isEmpty():  # border failures
        # the closure of the border: nothing that may be frequent is left uncounted by this pass
        frequent = _bit_table(hashed.select("h"), filter_bits)
        more = _count_pass(texts, max_words, proposed, frequent).where(F.col("f") >= min_count)
        found = found.unionByName(stored(more, "expanded"))
    return found, totals


def collocations(df: DataFrame, min_count: int = 30, max_words: int = 4, top: int = 2000, scale: int = 2_000_000, cover_percent: int = 80,
                 **mining) -> DataFrame:
    """Each lang's first ``top`` phrases of 2 to ``max_words`` words: ``lang, rank, phrase,
    a, l, r, n, score``.

    A phrase found ``a`` times, cut after its first k words, scores
    ``floor(scale * a / (l + r))`` (l, r: counts of the two parts); its lowest-scoring
    cut counts, ties to the smallest k.  A phrase that lies inside a longer candidate
    found at least ``cover_percent`` percent as often is dropped.  Order: score and a
    descending, phrase ascending by bytes.  All arithmetic is exact (decimals of 38
    digits)."""
    found, totals = frequent_phrases(df, min_count, max_words, **mining)
    words = F.split("phrase", " ", -1)
    sized = found.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.size(words).alias("k"))
    long = sized.where("k >= 2")

    # inside longer ones: one row per contiguous part of 2 words or more, the largest count wins
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda s: F.array_join(F.slice("w", s, m), " ")))))
    cover = (long.where("k >= 3").select("lang", inner.alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("cover")))
    big = "decimal(38,0)"
    kept = (long.join(cover, ["lang", "phrase"], "left")
            .where(F.coalesce(F.lit(100).cast("decimal(3,0)") * F.col("cover").cast("decimal(20,0)")
                              < F.lit(cover_percent).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)"), F.lit(True))))

    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.struct(
        c.alias("c"), F.array_join(F.slice("w", 1, c), " ").alias("left"), F.array_join(F.slice("w", c + 1, F.col("k") - c), " ").alias("right"))))
    part = lambda side, count: found.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
    cuts = (kept.select("lang", "phrase", "a", cut.alias("cut")).select("lang", "phrase", "a", "cut.*")
            .join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]))
    score = F.expr(f"cast({scale} * cast(a as {big}) as {big}) div cast(cast(l as {big}) + cast(r as {big}) as {big})").cast("long")
    best = (cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "c", "l", "r").alias("s"))
            .groupBy("lang", "phrase", "a").agg(F.min("s").alias("s"))
            .select("lang", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), F.col("s.score").alias("score")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (first.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
