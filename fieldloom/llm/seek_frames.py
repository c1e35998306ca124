"""Fill-in-middle transformation over seekable compressed texts (operator 12).

``archive`` stores every text as independent zstandard frames of about
``FRAME_BYTES`` bytes of text, each with the cumulative counts of bytes, code
points and units up to its end.  ``infill`` finds the frames of the two cuts by
these counts, decompresses only them to select the exact places, and writes the
output as a sequence of frames again: frames that lie whole in one part are passed
on as they are.  The frames of an output, joined, are one zstandard stream.
``digest`` and ``restored_digest`` decompress ordered frames one at a time.

Units are runs ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: a
unit begins at the text's start and wherever white space follows a word.

All steps are narrow: a row's work follows from the row alone.  Beside the row a
task holds a block of ``BLOCK_BYTES`` of text (or one longer text) while it writes
frames, and one decompressed frame while it reads them.

Edge cases: null text is empty (no frames, form plain, n 0); a text that holds a
marker is plain; a text of white space is one unit; a null id is hashed as an empty
string; rows that repeat an id get the same draw; an empty table gives no rows.
Other columns pass through; one with an output's name is replaced.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import NOT_SPACE, on_executors, text_pieces

FRAME_BYTES = 64 << 10
BLOCK_BYTES = 4 << 20
LEVEL = 3

# The markers of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

FRAMES = "array<struct<data: binary, bytes: long, chars: long, units: long, word: boolean>>"
_FRAME = pa.struct([("data", pa.binary()), ("bytes", pa.int64()), ("chars", pa.int64()), ("units", pa.int64()), ("word", pa.bool_())])


def unit_starts(data: np.ndarray, after_word: bool, at_start: bool) -> np.ndarray:
    """Where units begin in ``data``, a stretch of one text: white space after a word
    byte, and the first byte of the text."""
    word = NOT_SPACE[data]
    before = np.empty(len(data), dtype=bool)
    before[:1] = after_word
    before[1:] = word[:-1]
    begins = ~word & before
    if at_start:
        begins[:1] = True
    return np.flatnonzero(begins)


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def frames_of(data: np.ndarray, pack) -> list[dict]:
    """The frames of one text; each ends between code points."""
    out, at, chars, units, word = [], 0, 0, 0, False
    while at < len(data):
        stop = min(len(data), at + FRAME_BYTES)
        while stop < len(data) and data[stop] & 0xC0 == 0x80 and stop < at + FRAME_BYTES + 4:
            stop += 1
        part = data[at:stop]
        chars += code_points(part)
        units += len(unit_starts(part, word, at == 0))
        word = bool(NOT_SPACE[part[-1]])
        out.append({"data": pack(part.tobytes()), "bytes": stop, "chars": chars, "units": units, "word": word})
        at = stop
    return out


def _split(df: DataFrame, first: list[str], keep: list[str]) -> tuple[DataFrame, str]:
    """The columns ``first`` under names of their own in front of the kept ones, and the DDL of the kept ones."""
    names = [f"__in{i}" for i in range(len(first))]
    while set(names) & set(df.columns):
        names = [n + "_" for n in names]
    rows = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(first, names, strict=True)), *(F.col(f"`{c}`") for c in keep))
    return rows, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[len(first):])


def archive(df: DataFrame, text_col: str = "text", frames_col: str = "frames",
            markers: tuple[bytes, ...] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """``df`` with ``frames_col`` in place of the text, and ``marked`` boolean: the text
    holds one of ``markers``."""
    on_executors(df.sparkSession)
    keep = [c for c in df.columns if c not in (text_col, frames_col, "marked")]
    rows, ddl = _split(df, [text_col], keep)

    def run(batches: Iterator[pa.RecordBatch]):
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            for i, data, bounds in text_pieces(b.column(0), BLOCK_BYTES):
                raw = data.tobytes()
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                frames = [frames_of(data[s:e], pack) for s, e in cuts]
                marked = np.zeros(len(cuts), dtype=bool)
                for m in markers:
                    if m in raw:
                        marked |= [raw.find(m, s, e) >= 0 for s, e in cuts]
                part = b.slice(i, len(cuts))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(frames, pa.list_(_FRAME)), pa.array(marked)],
                                                 names=[*part.schema.names[1:], frames_col, "marked"])
    return rows.mapInArrow(run, f"{ddl}`{frames_col}` {FRAMES}, marked boolean")


class Reader:
    """One text's frames: places by units, stretches by bytes, one frame open at a time."""

    def __init__(self, frames: list[dict], unpack):
        self.frames, self.unpack = frames, unpack
        self.units = [f["units"] for f in frames]
        self.bytes = [f["bytes"] for f in frames]
        self.n = self.units[-1] if frames else 0
        self._open = (-1, b"")

    def open(self, i: int) -> bytes:
        if self._open[0] != i:
            self._open = (i, self.unpack(self.frames[i]["data"]))
        return self._open[1]

    def start(self, i: int, field: str) -> int:
        return self.frames[i - 1][field] if i else 0

    def place(self, unit: int) -> tuple[int, int]:
        """Byte and code point where a unit begins (``n``: the text's end)."""
        if unit >= self.n:
            return (self.bytes[-1], self.frames[-1]["chars"]) if self.frames else (0, 0)
        i = bisect.bisect_right(self.units, unit)
        data = np.frombuffer(self.open(i), dtype=np.uint8)
        at = int(unit_starts(data, bool(i and self.frames[i - 1]["word"]), i == 0)[unit - self.start(i, "units")])
        return self.start(i, "bytes") + at, self.start(i, "chars") + code_points(data[:at])

    def stretch(self, a: int, b: int, pack) -> list[bytes]:
        """Frames of the bytes ``a`` to ``b``; a frame that lies whole in them is passed on unopened."""
        out = []
        i = bisect.bisect_right(self.bytes, a)
        while a < b:
            first, last = self.start(i, "bytes"), self.bytes[i]
            if a == first and b >= last:
                out.append(self.frames[i]["data"])
            else:
                out.append(pack(self.open(i)[a - first:min(b, last) - first]))
            a, i = last, i + 1
        return out


def draws(seed: int, key) -> list[int]:
    """h1 to h4: the first four 8-digit groups of the hex SHA-256 of ``seed:key``."""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def infill(df: DataFrame, id_col: str = "doc_id", frames_col: str = "frames", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``df`` (an archive) with ``n`` long, ``form`` string (plain, psm or spm),
    ``prefix_chars`` and ``middle_chars`` long (null if plain) and ``output``
    array<binary>, the frames of the transformed text, in place of ``frames_col``."""
    on_executors(df.sparkSession)
    made = ["n", "form", "prefix_chars", "middle_chars", "output"]
    keep = [c for c in df.columns if c not in (frames_col, "marked", *made)]
    rows, ddl = _split(df, [id_col, frames_col, "marked"], keep)

    def run(batches: Iterator[pa.RecordBatch]):
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        unpack = zstandard.ZstdDecompressor().decompress
        p_mark, s_mark, m_mark = map(pack, (PREFIX, SUFFIX, MIDDLE))

        def one(key, frames, marked):
            text = Reader(frames or [], unpack)
            h1, h2, h3, h4 = draws(seed, key)
            if not text.frames or marked or h3 % 100 >= rate:
                return text.n, "plain", None, None, [f["data"] for f in text.frames]
            cuts = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
            (a, a_chars), (b, b_chars) = map(text.place, cuts)
            end = text.bytes[-1]
            prefix, middle, suffix = text.stretch(0, a, pack), text.stretch(a, b, pack), text.stretch(b, end, pack)
            if h4 % 100 < spm_rate:
                return text.n, "spm", a_chars, b_chars - a_chars, [s_mark, *suffix, p_mark, *prefix, m_mark, *middle]
            return text.n, "psm", a_chars, b_chars - a_chars, [p_mark, *prefix, s_mark, *suffix, m_mark, *middle]

        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                got = [one(*(v.as_py() for v in row)) for row in zip(*part.columns[:3], strict=True)]
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[3:], *(pa.array([g[k] for g in got], t) for k, t in enumerate(types))],
                                                 names=[*part.schema.names[3:], *made])
    return rows.mapInArrow(run, ddl + "n long, form string, prefix_chars long, middle_chars long, output array<binary>")


class Output:
    """The frames of a transformed text, read one at a time."""

    def __init__(self, frames: list[bytes], unpack):
        self.frames, self.unpack, self._open = frames, unpack, (-1, b"")

    def open(self, i: int) -> bytes:
        if self._open[0] != i:
            self._open = (i, self.unpack(self.frames[i]))
        return self._open[1]

    def parts(self, a: tuple[int, int], b: tuple[int, int]) -> Iterator[bytes]:
        """The bytes from one (frame, byte) to another."""
        for i in range(a[0], min(b[0] + 1, len(self.frames))):
            data = self.open(i)
            yield data[a[1] if i == a[0] else 0:b[1] if i == b[0] else len(data)]

    def find(self, mark: bytes, frm: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        """Where ``mark`` begins and ends at or after ``frm``; it may lie across frames."""
        tail: list[tuple[int, int]] = []  # places of the last bytes seen, fewer than the mark has
        held = b""
        for i in range(frm[0], len(self.frames)):
            skip = frm[1] if i == frm[0] else 0
            data = self.open(i)[skip:]
            at = (held + data).find(mark)
            if at >= 0:
                begin = tail[at] if at < len(held) else (i, skip + at - len(held))
                return begin, (i, skip + at + len(mark) - len(held))
            keep = len(mark) - 1
            places = tail + [(i, skip + k) for k in range(max(0, len(data) - keep), len(data))]
            held, tail = (held + data)[-keep:], places[-keep:]
        raise ValueError("a marker is missing in an output")

    def restored(self, form: str) -> Iterator[bytes]:
        """The original text, part after part, from the output and its form alone."""
        begin, end = (0, 0), (len(self.frames), 0)
        if form == "plain":
            yield from self.parts(begin, end)
            return
        marks = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}[form]
        at, found = begin, []
        for m in marks:
            found.append(self.find(m, at))
            at = found[-1][1]
        stretch = {m: (found[k][1], found[k + 1][0] if k < 2 else end) for k, m in enumerate(marks)}
        for m in (PREFIX, MIDDLE, SUFFIX):
            yield from self.parts(*stretch[m])


def _by_row(df: DataFrame, first: list[str], target: str, kind: pa.DataType, ddl_type: str, make) -> DataFrame:
    on_executors(df.sparkSession)
    keep = [c for c in df.columns if c != target]
    rows, ddl = _split(df, first, keep)

    def run(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                got = [make(unpack, *(v.as_py() for v in row)) for row in zip(*part.columns[:len(first)], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[len(first):], pa.array(got, kind)],
                                                 names=[*part.schema.names[len(first):], target])
    return rows.mapInArrow(run, f"{ddl}`{target}` {ddl_type}")


def _sha256(parts: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def digests(df: DataFrame, frames_col: str = "output", form_col: str = "form") -> DataFrame:
    """``df`` with ``output_sha256`` and ``restored_sha256`` in place of the frames:
    SHA-256 (hex) of the output's text, and of the original text rebuilt from the
    output and its form.  Null frames count as none."""
    def both(unpack, frames, form):
        out = Output(frames or [], unpack)
        return {"output_sha256": _sha256(out.parts((0, 0), (len(out.frames), 0))), "restored_sha256": _sha256(out.restored(form or "plain"))}
    target = "sha"
    while target in df.columns:
        target += "_"
    kind = pa.struct([("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    made = ("output_sha256", "restored_sha256")
    keep = [c for c in df.columns if c not in (frames_col, *made)]
    out = _by_row(df.select(*(F.col(f"`{c}`") for c in [*keep, frames_col])), [frames_col, form_col], target, kind,
                  "struct<output_sha256: string, restored_sha256: string>", both)
    return out.select(*(F.col(f"`{c}`") for c in keep), *(F.col(f"`{target}`.{m}").alias(m) for m in made))


def output_text(df: DataFrame, frames_col: str = "output", text_col: str = "output_text") -> DataFrame:
    """``df`` with ``text_col``: the text that a row's frames hold."""
    def whole(unpack, frames):
        return b"".join(map(unpack, frames or [])).decode("utf-8", "replace")
    return _by_row(df, [frames_col], text_col, pa.string(), "string", whole)


def restored_text(df: DataFrame, frames_col: str = "output", form_col: str = "form", text_col: str = "restored_text") -> DataFrame:
    """``df`` with ``text_col``: the original text, rebuilt from output and form."""
    def whole(unpack, frames, form):
        return b"".join(Output(frames or [], unpack).restored(form or "plain")).decode("utf-8", "replace")
    return _by_row(df, [frames_col, form_col], text_col, pa.string(), "string", whole)
