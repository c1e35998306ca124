"""Best-fit packing of tokenised documents (operator 11).

``token_pieces`` cuts every text's token ids into pieces of at most ``capacity``
ids; only a text with more ids than that is cut.  ``best_fit`` packs rows with a
length into sequences by bounded-space online best fit: a partition keeps at most
``open_bins`` open sequences, filed under their free space, and a bitset says which
free spaces occur.  A piece goes to the open sequence with the least space that
holds it; where none does, a new one opens, and if too many are open the fullest
closes first.  A full sequence closes at once.  Pieces arrive in the order of the
rows, but each buffer of ``LOOK`` rows is offered longest first, which leaves
fewer gaps.

Both steps are narrow: no shuffle, no state beyond a partition, and the packing of
a partition follows from its rows alone, so a task that runs again gives the same
sequences.  Memory: a block of ``BLOCK_BYTES`` of text (or one longer text),
remembered words of at most ``KNOWN_BYTES``, one buffer and the open bins.  A
partition wastes about its last open sequence.

Edge cases: null or empty text is the end id alone (one piece); texts of any
length are cut whole; repeated rows are packed each; a null length counts as 0; a
length over ``capacity`` is an error of the caller; an empty table gives no rows.
Other columns pass through; one with an output's name is replaced.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Memo, binary_slices, byte_set, on_executors, text_pieces

BLOCK_BYTES = 2 << 20
KNOWN_BYTES = 8 << 20
LOOK = 4096
OPEN_BINS = 4096

# Fixed value: the word pattern of the tokenizer kind whose words can be looked up one by one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKENIZERS = ["Split", "ByteLevel"]

# Classes of bytes: 0 white space, 1 ASCII letter, 2 other ASCII sign that is no
# apostrophe, 3 the rest.  No token of the pattern reaches across white space or
# from class 1 to 2 or back, and no normalisation does, so a cut there is safe.
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[byte_set(b" \t\n\x0b\x0c\r")] = 0
_CLASS[byte_set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_CLASS[byte_set(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def cut_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, offsets, first)``: the A-Z lowered bytes of all words joined, where
    each word begins (plus the end), and the index of each text's first word."""
    n = len(data)
    kind = _CLASS[data]
    before = np.zeros(n, dtype=np.uint8)
    before[1:] = kind[:-1]
    before[bounds[bounds < n]] = 0
    begins = (kind != 0) & ((before == 0) | (before + kind == 3) & (before != 0) & (kind < 3))
    inside = kind != 0
    place = np.cumsum(inside) - 1
    start = np.flatnonzero(begins)
    offsets = np.append(place[start], inside.sum())
    return _LOWER[data[inside]], offsets, np.searchsorted(start, bounds)


class WordCoder:
    """Token ids of texts.  Where the tokenizer splits words as ``WORD_PATTERN`` does,
    distinct words are encoded once and looked up; else whole texts are encoded."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parsed = json.loads(spec)
        kinds = lambda part, items: [x["type"] for x in (parsed.get(part) or {}).get(items, ())]
        split = ((parsed.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        suffix = parsed["model"].get("end_of_word_suffix")
        self.by_words = bool(kinds("normalizer", "normalizers") == NORMALIZERS and kinds("pre_tokenizer", "pretokenizers") == PRE_TOKENIZERS
                             and (split.get("pattern") or {}).get("Regex") == WORD_PATTERN and suffix)
        self.added = [t["content"].encode() for t in parsed.get("added_tokens", ())]
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocab.values(), default=0), dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.memo = Memo(self._learn, KNOWN_BYTES, np.uint32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words; runs of plain ASCII letters, one token word each, go to the
        tokenizer joined and are told apart by the end-of-word tokens."""
        plain = [i for i, w in enumerate(words) if w.isalpha()]
        lists: list = [None] * len(words)
        joined = [b" ".join(words[i] for i in plain[s:s + 256]).decode() for s in range(0, len(plain), 256)]
        ids = np.array([i for part in self._whole(joined) for i in part], dtype=np.uint32)
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) == len(plain):
            for i, part in zip(plain, np.split(ids, stop[:-1]), strict=False):
                lists[i] = part
        other = [i for i, part in enumerate(lists) if part is None]
        for i, part in zip(other, self._whole([words[i].decode("utf-8", "replace") for i in other]), strict=True):
            lists[i] = part
        return np.concatenate(lists), np.array([len(part) for part in lists], dtype=np.int64)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, and how many each text has."""
        raw = data.tobytes()
        whole = [not self.by_words] * (len(bounds) - 1)
        if self.by_words and any(t in raw for t in self.added):
            whole = [any(raw.find(t, s, e) >= 0 for t in self.added) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        ids, size = np.zeros(0, dtype=np.uint32), np.zeros(len(whole), dtype=np.int64)
        if self.by_words:
            buffer, offsets, first = cut_words(data, bounds)
            ids, length = self.memo.look(binary_slices(buffer, offsets))
            size = np.diff(np.concatenate([[0], np.cumsum(length)])[first])
        if any(whole):
            parts = np.split(ids, np.cumsum(size)[:-1]) if len(size) else []
            for i in np.flatnonzero(whole).tolist():
                text = raw[bounds[i]:bounds[i + 1]].decode("utf-8", "replace")
                parts[i] = np.array(self._whole([text])[0], dtype=np.uint32)
            ids, size = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, size


@functools.lru_cache(maxsize=2)
def _coder(spec: str) -> WordCoder:
    """Kept by the worker process, so that later tasks find the words of earlier ones."""
    return WordCoder(spec)


def _rows(df: DataFrame, first: str, keep: list[str]) -> tuple[DataFrame, str]:
    """``df`` with column ``first`` under a name of its own in front of the kept columns."""
    inner = "__first"
    while inner in df.columns:
        inner += "_"
    return df.select(F.col(f"`{first}`").alias(inner), *(F.col(f"`{c}`") for c in keep)), inner


def _ddl(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields[1:])


def token_pieces(df: DataFrame, vocabulary_path: str, capacity: int = 2048, text_col: str = "text", end_id: int = 0,
                 keep: list[str] | None = None) -> DataFrame:
    """One row per piece of each row of ``df``: ``keep`` (default: all columns but the
    text), ``piece`` int from 0, ``start`` long (ids of the text before it), ``length``
    long and ``ids`` binary (little-endian unsigned 32-bit).  Each text's ids are
    followed by ``end_id``."""
    spark = df.sparkSession
    on_executors(spark)
    made = {"piece", "start", "length", "ids"}
    keep = [c for c in (keep if keep is not None else df.columns) if c not in made and (keep is not None or c != text_col)]
    with open(vocabulary_path, encoding="utf-8") as f:  # a local parameter file of the driver, sent to the tasks
        spec = spark.sparkContext.broadcast(f.read())
    rows, _ = _rows(df, text_col, keep)
    schema = _ddl(rows) + "piece int, start long, length long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]):
        coder = _coder(spec.value)
        for b in batches:
            for i, data, bounds in text_pieces(b.column(0), BLOCK_BYTES):
                ids, size = coder.encode(data, bounds)
                count = len(size)
                ids = np.insert(ids, np.cumsum(size), end_id)
                size = size + 1
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(count), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                cuts = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype("<u4"))])
                part = b.slice(i, count).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                                  pa.array(length, pa.int64()), packed],
                                                 names=[*part.schema.names[1:], "piece", "start", "length", "ids"])
    return rows.mapInArrow(run, schema)


class OpenBins:
    """The open sequences of a partition, filed by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.made, self.open = capacity, most, 0, 0
        self.spaces = 0  # bit f is set where a sequence with f free places is open
        self.filed: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        group = self.filed[free]
        number = group.pop()
        if not group:
            self.spaces ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes a piece of ``length``, and the offset in it."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:  # the fullest closes: the lowest set bit
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if not self.filed[left]:
                self.spaces |= 1 << left
            self.filed[left].append(number)
            self.open += 1
        return number, self.capacity - free


def best_fit(df: DataFrame, length_col: str = "length", capacity: int = 2048, open_bins: int = OPEN_BINS, look: int = LOOK) -> DataFrame:
    """``df`` with ``sequence_id`` long (unique over all partitions) and ``offset`` long:
    the sequence of each row and its place there, gapless from 0."""
    if capacity < 1 or open_bins < 1 or look < 1:
        raise ValueError("capacity, open_bins and look must be positive")
    on_executors(df.sparkSession)
    keep = [c for c in df.columns if c not in ("sequence_id", "offset")]
    rows, _ = _rows(df, length_col, keep)
    schema = _ddl(rows) + "sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]):
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            for s in range(0, batch.num_rows, look):
                part = batch.slice(s, look)
                size = part.column(0).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                if len(size) and (size.max() > capacity or size.min() < 0):
                    raise ValueError(f"a piece is longer than {capacity} or negative")
                number, offset = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
                for i in np.argsort(-size, kind="stable").tolist():
                    number[i], offset[i] = bins.place(int(size[i]))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(base + number), pa.array(offset)],
                                                 names=[*part.schema.names[1:], "sequence_id", "offset"])
    return rows.mapInArrow(run, schema)
