import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import docs_frame, sample_docs
from tokenizers import Tokenizer

from fieldloom.llm import pair_bpe
from fieldloom.llm import queries as Q
from fieldloom.llm.pair_bpe import decode, encode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def odd_texts(n=400, seed=1):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "​", "a", "b", "'s", "'ll", "1", "२", "é", "漢", "😀",
             "<|endoftext|>", "<|", "|>", "ab", "the", "\x00", "　", "_", "ǅ", "Ⅷ", "²"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_same_as_library(spark, tok):
    rows = sample_docs() + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    df = docs_frame(spark, rows)  # has a column named ids
    out = decode(encode(df, PATH), PATH)
    assert set(out.columns) == {*df.columns, "decoded"}
    got = sorted(((r.doc_id, r.text, list(r.ids), r.decoded) for r in out.collect()), key=repr)
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, t, ids, tok.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])


def test_known_chunks_start_anew(spark, tok, monkeypatch):
    monkeypatch.setattr(pair_bpe, "KNOWN_BYTES", 50)
    enc = pair_bpe.Encoder(pair_bpe.Vocabulary(open(PATH, encoding="utf-8").read()))
    for t in odd_texts(60, 2):
        ids, size = enc.encode(*flat([t, t]))
        want = tok.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and size.tolist() == [len(want)] * 2


def test_chunks_cut_no_pre_token(spark, tok):
    rng = random.Random(11)
    parts = [" ", "  ", "\n", "\t", "\xa0", "\u2003", "\x1c", "a", "Bc", "'", "'s", "'S", "''", ",", ".", "-", "1", "é", "e\u0301", "漢", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    ids, size = pair_bpe.Encoder(pair_bpe.Vocabulary(open(PATH, encoding="utf-8").read())).encode(*flat(texts))
    got = [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])]
    assert got == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_added_token_across_two_texts(spark, tok):
    ids, size = pair_bpe.Encoder(pair_bpe.Vocabulary(open(PATH, encoding="utf-8").read())).encode(*flat(["a <|endof", "text|> b"]))
    assert ids.tolist() == [i for t in ("a <|endof", "text|> b") for i in tok.encode(t, add_special_tokens=False).ids]


def test_decode_of_broken_bytes(spark, tok):
    ids = tok.encode("漢字", add_special_tokens=False).ids
    rows = [(1, ids[:1]), (2, ids[1:]), (3, []), (4, None)]
    out = {r.doc_id: r.decoded for r in decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    assert out == {1: tok.decode(ids[:1], skip_special_tokens=False), 2: tok.decode(ids[1:], skip_special_tokens=False), 3: "", 4: None}


def test_empty_table(spark):
    assert decode(encode(docs_frame(spark, []), PATH), PATH).count() == 0


def test_query(spark, tok):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in Q.op10_bpe(spark, sf).collect()} == want
