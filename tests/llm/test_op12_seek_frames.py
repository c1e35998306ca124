import hashlib
import random
import re

import duckdb
import pytest
import zstandard
from helpers import docs_frame, sample_docs
from pyspark.sql import functions as F

from fieldloom.llm import queries as Q
from fieldloom.llm import seek_frames as S

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def plain_model(key, text, seed=42):
    """(n, form, prefix_chars, middle_chars, output) by the rules, without frames."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = sha(f"{seed}:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def awkward():
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\x0b", "\x1c", " ", "a", "漢字", "\U0001f600", "word", "<", "<S", "<M", "S>", ">", "P"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["a <P> b", "<S>", "x<M>", "   ", "\t a", "a \t", "ä" * 500, " ".join(["漢"] * 400), " " * 400, "w " * 300]
    return sample_docs() + [(1000 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("frame", [7, 64 << 10])
def test_same_as_the_plain_model(spark, monkeypatch, frame):
    rows = awkward()
    if frame == 7:  # many frames a text; frames end inside units and never inside code points
        rows = [(i, t) for i, t in rows if len(t or "") < 3000]
    data = docs_frame(spark, rows)
    # the module's constant does not reach the workers: frames are cut here as the task does
    monkeypatch.setattr(S, "FRAME_BYTES", frame)
    pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    import numpy as np
    for i, t in rows:
        raw = (t or "").encode()
        frames = S.frames_of(np.frombuffer(raw, dtype=np.uint8), pack)
        assert b"".join(unpack(f["data"]) for f in frames) == raw
        text = S.Reader(frames, unpack)
        units = UNIT.findall(t or "")
        assert text.n == len(units)
        for u in {0, 1, len(units) // 2, len(units)} & set(range(len(units) + 1)):
            before = "".join(units[:u])
            assert text.place(u) == (len(before.encode()), len(before))
        (a, _), (b, _) = text.place(len(units) // 3), text.place(len(units) // 2)
        assert b"".join(map(unpack, text.stretch(a, b, pack))) == raw[a:b]
        for form, marks in (("psm", (S.PREFIX, S.SUFFIX, S.MIDDLE)), ("spm", (S.SUFFIX, S.PREFIX, S.MIDDLE))):
            if any(m in raw for m in marks):
                continue
            part = {S.PREFIX: raw[:a], S.MIDDLE: raw[a:b], S.SUFFIX: raw[b:]}
            whole = b"".join(m + part[m] for m in marks)
            cut = [pack(whole[k:k + 5]) for k in range(0, len(whole), 5)]  # markers lie across frames
            assert b"".join(S.Output(cut, unpack).restored(form)) == raw
    if frame == 7:
        return
    out = S.infill(S.archive(data)).cache()  # clashing columns pass through or are replaced
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_text, r.restored_text)
                  for r in S.restored_text(S.output_text(out)).collect()), key=repr)
    assert got == sorted(((i, *plain_model(i, t), t or "") for i, t in rows), key=repr)
    sums = sorted(((r.doc_id, r.output_sha256, r.restored_sha256) for r in S.digests(out).collect()), key=repr)
    assert sums == sorted(((i, sha(plain_model(i, t)[4]), sha(t or "")) for i, t in rows), key=repr)
    assert {"spm", "psm", "plain"} == {g[2] for g in got}
    assert out.select("score", "lang", "h1").distinct().count() == 1


def test_outputs_are_one_zstandard_stream(spark):
    rows = [(i, f"word{i} " * 40_000) for i in range(8)]
    out = S.infill(S.archive(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert any(r.form != "plain" for r in out)
    for r in out:
        stream = b"".join(r.output)
        whole = zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True).read().decode()
        assert whole == plain_model(r.doc_id, rows[r.doc_id][1])[4]


def test_whole_frames_are_passed_on():
    pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    import numpy as np
    raw = (b"abc " * 100_000)
    opened = []
    frames = S.frames_of(np.frombuffer(raw, dtype=np.uint8), pack)
    text = S.Reader(frames, lambda d: opened.append(d) or unpack(d))
    (a, _), (b, _) = text.place(30_000), text.place(70_000)
    parts = text.stretch(0, a, pack) + text.stretch(a, b, pack) + text.stretch(b, len(raw), pack)
    assert b"".join(map(unpack, parts)) == raw and len(frames) > 5
    assert len(set(opened)) <= 2  # only the frames of the two cuts


def test_rates_and_seed(spark):
    df = S.archive(spark.createDataFrame([(i, "a b c") for i in range(400)], "doc_id long, text string"))
    forms = lambda **kw: {r.form: r.c for r in S.infill(df, **kw).groupBy("form").agg(F.count("*").alias("c")).collect()}
    assert forms(rate=0) == {"plain": 400} and forms(rate=100, spm_rate=100) == {"spm": 400} and forms(rate=100, spm_rate=0) == {"psm": 400}
    assert forms(seed=1) != forms(seed=2)


def test_empty_table(spark):
    assert S.digests(S.infill(S.archive(docs_frame(spark, [])))).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(spark, sf):
    sf = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.execute(Q.ORACLE["op12_seek_frames"])
    out = Q.op12_seek_frames(spark, sf)
    assert out.columns == [d[0] for d in rel.description]
    assert sorted(map(tuple, out.collect())) == sorted(rel.fetchall())


def test_oracle_on_awkward_texts():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    rows = [(i, t) for i, t in awkward() if i is not None and len(t or "") < 3000]
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted((i, *plain_model(i, t)[:4], sha(plain_model(i, t)[4]), sha(t or "")) for i, t in rows)
    assert sorted(con.execute(Q.ORACLE["op12_seek_frames"]).fetchall(), key=repr) == sorted(want, key=repr)
