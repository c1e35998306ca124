import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import docs_frame, sample_docs
from tokenizers import Tokenizer

from fieldloom.llm import best_fit as B
from fieldloom.llm import queries as Q

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "a", "B", "'s", "'LL", "''s", "1", "२", "é", "́", "漢", "\U0001f600",
       "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "ab", "the", "\x00", "　", "_", "ǅ", "Ⅷ", "²", ",", ".", "-", "x'", "İ",
       "Σ", "ΑΣ", ";", "ſ", "K", "﻿", "'", "d'", "don't", "ª"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def check_sequences(rows, capacity):
    """(sequence, offset, length): gapless from 0, none over the capacity."""
    by = defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def best_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(capacity - n)
    return len(free)


def test_words_encode_as_the_library(tok):
    c = B.WordCoder(open(PATH, encoding="utf-8").read())
    assert c.by_words
    texts = odd_texts(1500, 3)
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    for _ in range(2):  # new words, then known ones
        ids, size = c.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), bounds)
        got = [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])]
        assert got == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_another_tokenizer_encodes_whole_texts(tok):
    path = public_tokenizers.path("byte_bpe_50k.json")
    c = B.WordCoder(open(path, encoding="utf-8").read())
    assert not c.by_words
    raw = "Whole texts, not words.".encode()
    ids, size = c.encode(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == Tokenizer.from_file(path).encode(raw.decode(), add_special_tokens=False).ids and size.tolist() == [len(ids)]


def test_known_words_start_anew(tok, monkeypatch):
    monkeypatch.setattr(B, "KNOWN_BYTES", 20)
    c = B.WordCoder(open(PATH, encoding="utf-8").read())
    for t in odd_texts(40, 5):
        raw = t.encode()
        ids, _ = c.encode(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids


def test_pieces_and_packing(spark, tok):
    rows = sample_docs() + [(1000 + i, t) for i, t in enumerate(odd_texts(60, 9))]
    cap = 64
    df = docs_frame(spark, rows)  # has columns named start and ids: the outputs replace them
    out = B.best_fit(B.token_pieces(df, PATH, capacity=cap), capacity=cap).collect()
    got = defaultdict(list)
    for r in out:
        got[r.doc_id, r.piece, r.start].append(np.frombuffer(r.ids, dtype="<u4").tolist())
        assert r.length == len(r.ids) // 4 and r.score == 2.0 and r.lang == "en"
    want = defaultdict(list)
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), cap)):
            want[i, k, s].append(ids[s:s + cap])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out], cap)


def test_fullest_closes_first():
    bins = B.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # 1 (3 free) closes for 2, as the fuller of 0 and 1
    assert bins.place(3) == (0, 6)  # 0 was open still
    assert bins.place(2) == (2, 8)  # an exact fit closes at once
    assert bins.open == 1 and bins.place(10) == (3, 0)


def test_matches_the_plain_rule():
    rng = random.Random(4)
    bins, free, closed = B.OpenBins(50, 7), {}, set()
    for _ in range(3000):
        n = rng.randint(0, 50)
        fits = [i for i, f in free.items() if f >= n]
        number, offset = bins.place(n)
        if fits:
            assert free[number] == min(free[i] for i in fits)
        else:
            assert number not in free and number not in closed and offset == 0
            if len(free) == 7:
                least = min(free.values())
                gone = [i for i in free if free[i] == least]
                # any of the fullest: the one that the bins no longer hold
                held = {i for group in bins.filed for i in group} | {number}
                gone = [i for i in gone if i not in held]
                assert len(gone) == 1
                closed.add(gone[0])
                del free[gone[0]]
            free[number] = 50
        assert offset == 50 - free[number]
        free[number] -= n
        if not free[number]:
            del free[number]
            closed.add(number)


def test_lengths_of_any_kind(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([5, 0, None, 5, 9, 1, 10])], "sequence_id long, n int").coalesce(1)
    out = B.best_fit(df.withColumnRenamed("sequence_id", "i"), "n", capacity=10).collect()
    assert check_sequences([(r.sequence_id, r.offset, r.n or 0) for r in out], 10) == 4 and len(out) == 7  # the last holds the empty ones
    with pytest.raises(Exception, match="longer than 9"):
        B.best_fit(df, "n", capacity=9).collect()


def test_empty_table(spark):
    assert B.best_fit(B.token_pieces(docs_frame(spark, []), PATH)).count() == 0


def test_query(spark, tok):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r, e in zip(docs, tok.encode_batch([r.text or "" for r in docs], add_special_tokens=False), strict=True):
        ids = e.ids + [0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s:s + 2048]
            want.add((r.doc_id, k, s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    out = Q.op11_best_fit(spark, sf).collect()
    assert len(out) == len(want) and {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out} == want
    n = check_sequences([(r.sequence_id, r.offset, r.length) for r in out], 2048)
    assert n <= 1.01 * best_fit_decreasing([r.length for r in out], 2048) + 1
