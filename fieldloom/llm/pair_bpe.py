"""Byte-level BPE encoding and decoding by a pair occurrence index (operator 10).

The distinct pre-tokens of a block of a partition are laid out as one symbol
sequence.  An index maps every mergeable pair to all its positions.  Active
ranks are taken from a heap in ascending order; a rank's pair is merged at all
its positions, left to right, and only the lists of the pairs that appear
beside a merge are updated.  Texts are cut into chunks of whole pre-tokens; those
that the partition met before are looked up.  The vocabulary is a parameter (a tokenizer file of the ``tokenizers`` library); it
is fixed in size and broadcast.

Whole texts are encoded.  Memory is bounded by a block of ``BLOCK_BYTES`` of
text (or one longer text) and ``KNOWN_BYTES`` of remembered chunks.

Edge cases: null text is empty and has no tokens; an added token's string in a
text becomes that token, as the library does; a null id array decodes to null;
all other columns pass through, and a column with an output's name is replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Memo, binary_slices, byte_set, gather, on_executors, text_pieces

# Fixed value: the split pattern of byte-level pre-tokenisation.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_BYTES = 1 << 20
KNOWN_BYTES = 4 << 20


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others for U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary: ``merges`` maps a pair of ids to (rank, id)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE tokenizer without a normalizer is needed")
        vocab, letters = model["vocab"], byte_letters()
        self.first = np.zeros(256, dtype=np.int64)
        for c, b in letters.items():
            self.first[b] = vocab[c]
        self.left, self.right, self.made, self.rank = [], [], [], {}
        last: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if max(last.get(x, -1), last.get(y, -1)) >= r:
                raise ValueError("a merge uses a token that a later merge makes")
            last[z] = r
            self.left.append(x)
            self.right.append(y)
            self.made.append(z)
            self.rank.setdefault(x << 20 | y, r)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = 1 + max([*vocab.values(), *self.added.values()])
        parts = [b""] * size
        for t, i in vocab.items():
            parts[i] = bytes(letters[c] for c in t)
        for t, i in self.added.items():
            parts[i] = t.encode()
        self.bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def merge_all(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``words`` joined, and how many each word has."""
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    size = np.array([len(w) for w in words], dtype=np.int64)
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), size
    ends = np.cumsum(size)
    starts = v.first[data]
    after = np.arange(1, n + 1)
    after[ends[size > 0] - 1] = -1
    before = np.arange(-1, n - 1)
    before[(ends - size)[size > 0]] = -1
    # the index: rank of a pair -> positions of its left symbol
    at = np.flatnonzero(after >= 0)
    pairs, of = np.unique(starts[at] << 20 | starts[at + 1], return_inverse=True)
    known = np.array([v.rank.get(p, -1) for p in pairs.tolist()], dtype=np.int64)[of] if len(at) else np.zeros(0, dtype=np.int64)
    at, known = at[known >= 0], known[known >= 0]
    order = np.argsort(known, kind="stable")
    at, known = at[order], known[order]
    cut = np.flatnonzero(np.r_[True, known[1:] != known[:-1]]) if len(known) else np.zeros(0, dtype=np.int64)
    index = {int(known[s]): at[s:e].tolist() for s, e in zip(cut, [*cut[1:], len(known)], strict=False)}
    active = sorted(index)
    sym, nxt, prv, rank = starts.tolist(), after.tolist(), before.tolist(), v.rank.get
    while active:
        r = heapq.heappop(active)
        places = index.pop(r)
        a, b, z = v.left[r], v.right[r], v.made[r]
        places.sort()
        for i in places:
            if sym[i] != a:
                continue
            j = nxt[i]
            if j < 0 or sym[j] != b:
                continue
            sym[i] = z
            sym[j] = -1
            k = nxt[j]
            nxt[i] = k
            if k >= 0:
                prv[k] = i
                s = rank(z << 20 | sym[k])
                if s is not None:
                    if s in index:
                        index[s].append(i)
                    else:
                        index[s] = [i]
                        heapq.heappush(active, s)
            p = prv[i]
            if p >= 0:
                s = rank(sym[p] << 20 | z)
                if s is not None:
                    if s in index:
                        index[s].append(p)
                    else:
                        index[s] = [p]
                        heapq.heappush(active, s)
    out = np.array(sym, dtype=np.int64)
    live = np.concatenate([[0], np.cumsum(out >= 0)])
    return out[out >= 0], live[ends] - live[ends - size]


# Classes of bytes: 0 white space, 1 ASCII letter, 2 other ASCII sign that is no
# apostrophe, 3 the rest.  No pre-token of SPLIT reaches from class 1 to 2 or back, nor
# from a visible ASCII character to white space, so texts may be cut there.
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[byte_set(b" \t\n\x0b\x0c\r")] = 0
_CLASS[byte_set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_CLASS[byte_set(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = 2
_VISIBLE = byte_set(bytes(range(33, 127)))


def cut_chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the chunks of all texts (the end included), and the index of each text's
    first chunk.  A chunk holds whole pre-tokens, in most cases one."""
    kind = _CLASS[data]
    begins = np.zeros(len(data), dtype=bool)
    a, b = kind[:-1], kind[1:]
    begins[1:] = (b == 0) & _VISIBLE[data[:-1]] | (a + b == 3) & (a != 0) & (b != 0)
    begins[bounds[bounds < len(data)]] = True
    start = np.flatnonzero(begins)
    return np.append(start, len(data)), np.searchsorted(start, bounds)


class Encoder:
    def __init__(self, v: Vocabulary):
        self.v, self.find = v, regex.compile(SPLIT).findall
        added = sorted(v.added, key=len, reverse=True)
        self.cut = regex.compile(b"(" + b"|".join(regex.escape(t.encode()) for t in added) + b")") if added else None
        self.memo = Memo(self._learn, KNOWN_BYTES, np.int32)

    def _learn(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks; each distinct pre-token in them is encoded once."""
        lists = [[c] if c.isalpha() or c[:1] == b" " and c[1:].isalpha() else [w.encode() for w in self.find(c.decode("utf-8", "replace"))]
                 for c in chunks]
        number = {w: i for i, w in enumerate(dict.fromkeys(w for ws in lists for w in ws))}
        ids, size = merge_all(list(number), self.v)
        flat = np.array([number[w] for ws in lists for w in ws], dtype=np.int64)
        joined, length = gather(ids, np.concatenate([[0], np.cumsum(size)]), flat)
        ends = np.concatenate([[0], np.cumsum(length)])
        return joined, np.diff(ends[np.cumsum([0, *map(len, lists)])])

    def _plain(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        offsets, first = cut_chunks(data, bounds)
        ids, length = self.memo.look(binary_slices(data, offsets))
        return ids, np.diff(np.concatenate([[0], np.cumsum(length)])[first])

    def _with_added(self, text: bytes) -> np.ndarray:
        out = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append(np.array([self.v.added[part.decode()]], dtype=np.int32))
            elif part:
                out.append(self._plain(np.frombuffer(part, dtype=np.uint8), np.array([0, len(part)]))[0])
        return np.concatenate(out)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, and how many each text has."""
        ids, size = self._plain(data, bounds)
        raw = data.tobytes()
        if self.cut is not None and self.cut.search(raw):  # a hit may also lie across two texts
            parts = np.split(ids, np.cumsum(size)[:-1])
            for i, (s, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                if self.cut.search(raw, s, e):
                    parts[i] = self._with_added(raw[s:e])
            ids, size = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, size


def _lists(values: pa.Array, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), values)


@functools.lru_cache(maxsize=2)
def _vocabulary(text: str) -> Vocabulary:
    """Parsed once per worker process."""
    return Vocabulary(text)


def _with_column(df: DataFrame, source: str, target: str, ddl: str, fill, keep: list[str] | None) -> DataFrame:
    """Add ``target`` made from column ``source``, block by block, to the columns ``keep`` (default: all)."""
    on_executors(df.sparkSession)
    keep = [c for c in (df.columns if keep is None else keep) if c != target]
    inner = "__source"
    while inner in df.columns:
        inner += "_"
    df = df.select(F.col(f"`{source}`").alias(inner), *(F.col(f"`{c}`") for c in keep))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[1:]) + f", `{target}` {ddl}"

    def run(batches: Iterator[pa.RecordBatch]):
        make = fill()
        for b in batches:
            for s, e, column in make(b.column(0)):
                part = b.slice(s, e - s)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], column], names=[*part.schema.names[1:], target])
    return df.mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``ids_col`` (array<int>): the token ids of each whole text."""
    with open(vocabulary_path, encoding="utf-8") as f:  # a local parameter file of the driver, sent to the tasks
        text = df.sparkSession.sparkContext.broadcast(f.read())

    def fill():
        enc = Encoder(_vocabulary(text.value))  # of this task alone: a kept one would weigh on later stages

        def make(column):
            for i, data, bounds in text_pieces(column, BLOCK_BYTES):
                ids, size = enc.encode(data, bounds)
                yield i, i + len(size), _lists(pa.array(ids, pa.int32()), size)
        return make
    return _with_column(df, text_col, ids_col, "array<int>", fill, keep)


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``text_col``: the text that the ids stand for, special tokens
    included; bytes that are not UTF-8 become U+FFFD."""
    with open(vocabulary_path, encoding="utf-8") as f:
        text = df.sparkSession.sparkContext.broadcast(f.read())

    def fill():
        v = _vocabulary(text.value)

        def make(column):
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            step = 256
            for s in range(0, len(column), step):
                part = column.slice(s, step)
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if len(flat) and (flat.min() < 0 or flat.max() >= len(v.cuts) - 1):
                    raise ValueError("an id is not in the vocabulary")
                data, size = gather(v.bytes, v.cuts, flat)
                ends = np.concatenate([[0], np.cumsum(size)])
                count = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                cuts = ends[np.concatenate([[0], np.cumsum(count)])]
                raw = data.tobytes()
                out = [raw[a:b].decode("utf-8", "replace") if ok else None
                       for a, b, ok in zip(cuts[:-1], cuts[1:], part.is_valid().to_pylist(), strict=True)]
                yield s, s + len(part), pa.array(out, pa.string())
        return make
    return _with_column(df, ids_col, text_col, "string", fill, keep)
