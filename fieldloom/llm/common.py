"""Helpers shared by the operators: shared-folder tables, Arrow text pieces,
vectorised word hashes, streaming over sorted runs."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fieldloom.session import ensure_checkpoint_dir

PIECE_BYTES = 1 << 20
_M64 = (1 << 64) - 1


# --- tables in the shared folder ----------------------------------------------------

def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``, which the
    driver and every executor can reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fieldloom-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is
    cut, a lost executor loses nothing, and later reads see only their columns."""
    path = shared_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while taken & {n.lower() for n in names}:
        names = tuple(n + "_" for n in names)
    return list(names)


_shipped: set[str] = set()


def on_executors(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that a
    task can import it wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/fieldloom", "zip", root, "fieldloom")
        sc.addPyFile(archive)  # the driver serves it; executors fetch it
        _shipped.add(sc.applicationId)


# --- 64-bit mixing ------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (SplitMix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(fold_case: bool) -> np.ndarray:
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


CODES = _byte_codes(True)
CASED_CODES = _byte_codes(False)
_BASE = 0xD6E8FEB86659FD93 | 1
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..n."""
    if len(_powers.get("p", ())) <= n:
        size = max(n + 1, PIECE_BYTES + 1)
        for key, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            _powers[key] = np.multiply.accumulate(t)
    return _powers["p"], _powers["q"]


# --- word tables --------------------------------------------------------------------

def byte_set(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


# Bytes of [^\x20\x09-\x0D]: what the shingle contract counts as part of a word.
NOT_SPACE = ~byte_set(b" \t\n\x0b\x0c\r")
# Letters, digits and every byte of a non-ASCII character.
WORD_BYTES = byte_set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)))


class Words:
    """The words of a run of texts: ``hash``, ``start`` and ``end`` (byte
    offsets into ``data``) per word, ``first`` (word index) per text plus one."""

    __slots__ = ("data", "bounds", "hash", "start", "end", "first")

    def __init__(self, data, bounds, hash_, start, end, first):
        self.data, self.bounds, self.hash, self.start, self.end, self.first = data, bounds, hash_, start, end, first


def split_words(data: np.ndarray, bounds: np.ndarray, part: np.ndarray = NOT_SPACE, codes: np.ndarray = CODES,
                stem: int | None = None) -> Words:
    """Split ``data`` (UTF-8 bytes of several texts, cut at ``bounds``) into
    maximal runs of ``part`` bytes and hash each run (A-Z as a-z by default), or
    its first ``stem`` bytes."""
    n = len(data)
    inside = part[data]
    prev = np.zeros(n + 1, dtype=bool)
    prev[1:] = inside
    prev[bounds] = False  # a text begins: nothing stands before it
    start = np.flatnonzero(inside & ~prev[:n])
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = inside
    after[bounds] = False
    end = np.flatnonzero(inside & ~after[1:]) + 1
    p, q = _power_table(n)
    c = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(np.where(inside, codes[data], np.uint64(0)) * p[:n], out=c[1:])
    to = end if stem is None else np.minimum(end, start + stem)
    h = mix64((c[to] - c[start]) * q[start])
    return Words(data, bounds, h, start, end, np.searchsorted(start, bounds))


SENTENCE_END = byte_set(b".!?\n")


def sentence_starts(w: Words) -> np.ndarray:
    """Index of each sentence's first word: a sentence ends where . ! ? or a line
    break stands between a word's last letter or digit and the next word."""
    if not len(w.hash):
        return np.zeros(0, dtype=np.int64)
    c = np.concatenate([[0], np.cumsum(SENTENCE_END[w.data])])
    new = np.ones(len(w.hash), dtype=bool)
    letter = np.maximum.accumulate(np.where(WORD_BYTES[w.data], np.arange(len(w.data)), -1))
    tail = np.maximum(letter[w.end[:-1] - 1] + 1, w.start[:-1])
    new[1:] = c[w.start[1:]] > c[tail]
    new[w.first[w.first < len(new)]] = True
    return np.flatnonzero(new)


def char_offsets(data: np.ndarray) -> np.ndarray:
    """Characters (code points) that begin before each byte offset."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def text_pieces(column, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first_row, bytes, bounds)`` for runs of whole texts of about ``limit``
    bytes (one longer text alone); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m]
    return mix64(out)


def shingle_sets(w: Words, k: int = 5) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct k-word shingles; a shorter non-empty text is
    one shingle; a text without words is an empty set."""
    run = windows(w.hash, k)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= k:
            yield np.unique(run[a:b - k + 1])
        elif b > a:
            # a salt by length keeps short sequences apart from k-word shingles
            yield windows(w.hash[a:b], int(b - a)) ^ np.uint64(0xA5A5A5A5 + int(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


class Memo:
    """Integer lists of byte strings, each worked out once by ``learn(strings) ->
    (joined lists, their lengths)``.  About ``most`` bytes of strings are remembered;
    beyond that it starts anew, which repeats work and changes no result."""

    def __init__(self, learn, most: int, dtype):
        self.learn, self.most, self.dtype = learn, most, dtype
        self.reset()

    def reset(self):
        self.code: dict[bytes, int] = {}
        self.held = 0
        self.values, self.cuts = np.zeros(0, dtype=self.dtype), np.zeros(1, dtype=np.int64)

    def look(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The lists of all ``strings`` (a binary array) joined, and their lengths."""
        if self.held > self.most:
            self.reset()
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        code = self.code
        new = [w for w in distinct if w not in code]
        if new:
            values, size = self.learn(new)
            code.update(zip(new, range(len(self.cuts) - 1, len(self.cuts) - 1 + len(new)), strict=True))
            self.values = np.concatenate([self.values, values.astype(self.dtype)])
            self.cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(size)])
            self.held += sum(map(len, new))
        at = np.fromiter(map(code.__getitem__, distinct), dtype=np.int64, count=len(distinct))[coded.indices.to_numpy()]
        return gather(self.values, self.cuts, at)


def gather(values: np.ndarray, cuts: np.ndarray, ix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``values[cuts[i]:cuts[i + 1]]`` for i in ix, joined, and their lengths."""
    size = cuts[ix + 1] - cuts[ix]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(cuts[ix] - (ends - size), size)], size


def binary_slices(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The stretches of ``data`` between consecutive ``offsets`` as a binary array, not copied."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


# --- Arrow batches ------------------------------------------------------------------

def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def runs(batches, key: str) -> Iterator[pa.Table]:
    """Tables of rows with equal ``key`` from batches sorted by it.  Only one
    run is held at a time; callers bound the size of a run."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for s, e in zip(cut, cut[1:], strict=False):
            if held and last != k[s]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = k[s]
    if held:
        yield pa.Table.from_batches(held)
