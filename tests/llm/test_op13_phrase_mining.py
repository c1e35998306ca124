import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import CLASH, CLASH_ROW

from fieldloom.llm import phrase_mining as M
from fieldloom.llm import queries as Q

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, most=4):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, " ".join(w[i:i + k])] += 1
    return f, n


def plain_model(rows, least, top=2000):
    f, n = counts(rows)
    cands = {p: a for p, a in f.items() if a >= least and " " in p[1]}
    out = []
    for (lang, p), a in cands.items():
        w = p.split(" ")
        if any(g == lang and 100 * b >= 80 * a and len(q.split(" ")) > len(w) and f" {p} " in f" {q} " for (g, q), b in cands.items()):
            continue
        s, _, lf, r = min((2_000_000 * a // (f[lang, " ".join(w[:k])] + f[lang, " ".join(w[k:])]), k, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])])
                          for k in range(1, len(w)))
        out.append((lang, -s, -a, p.encode(), lf, r))
    ranked = []
    for lang in {o[0] for o in out}:
        for rank, (_, s, a, p, lf, r) in enumerate(sorted(o for o in out if o[0] == lang)[:top], 1):
            ranked.append((lang, rank, p.decode(), -a, lf, r, n[lang], -s))
    return sorted(ranked)


def frame(spark, rows):
    full = [(i, t, lang, *CLASH_ROW) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, " + CLASH)


def texts(seed=1, n=160):
    rng = random.Random(seed)
    vocab = ["a", "B", "c", "Ä", "ä", "x y", "漢", "don't", "\U0001f600"] + [f"w{i}" for i in range(25)]
    seps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!? ", " ; "]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(vocab[:6] if rng.random() < .5 else vocab) + rng.choice(seps) for _ in range(rng.randint(0, 60)))
        if rng.random() < .4:
            t += " alpha beta gamma delta epsilon"
        rows.append((t, rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \n.", "de"), ("rep " * 3000, "en"), ("one two three four five, " * 40, "fr"), rows[0], rows[0]]


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("mining", [{}, {"fraction": 0.0}, {"fraction": 1.0, "sample_least": 1}, {"filter_bits": 15, "seed": 3}])
def test_any_sample_gives_the_exact_result(spark, mining):
    rows = texts()
    assert rows_of(M.collocations(frame(spark, rows), min_count=8, **mining)) == plain_model(rows, 8)


def test_top_and_ties(spark):
    rows = texts(5)
    assert rows_of(M.collocations(frame(spark, rows), min_count=5, top=3)) == plain_model(rows, 5, 3)


def test_a_failure_expands_to_its_closure(spark):
    # rare words in one place only: the sample (none) proposes nothing, the expansion finds the four-word phrase
    rows = [("up down left right. " * 9 + "up down. " * 3, "en")]
    found, totals = M.frequent_phrases(frame(spark, rows), min_count=9, fraction=0.0)
    f, n = counts(rows)
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == {p: c for p, c in f.items() if c >= 9}
    assert [(r.lang, r.n) for r in totals.collect()] == list(n.items())


def test_border_is_counted_and_nothing_else(spark):
    rows = [("a b c d", "en")] * 20
    df = M._texts(frame(spark, rows), "text", "lang")
    words = spark.createDataFrame([("a", "en"), ("b", "en"), ("c", "en")], "phrase string, lang string")
    bits = M._bit_table(M._hashed(words, np.zeros(1 << 12, dtype=np.uint8)).select("h"), 15)
    got = {r.phrase: r.f for r in M._count_pass(df, 4, bits).collect()}
    assert got == {"": 80, "a": 20, "b": 20, "c": 20, "d": 20, "a b": 20, "b c": 20}  # c d: d is not proposed; a b c: a b is not


def test_bit_table_matches_hashes(spark):
    h = [0, 1, 2, 32767, 32768, -1, 12345678901234567, -(1 << 63)]
    table = M._bit_table(spark.createDataFrame([(x,) for x in h], "h long"), 16)
    assert M._member(table, np.array(h, dtype=np.int64).view(np.uint64)).all()
    assert int(np.unpackbits(table).sum()) == len({x & 0xFFFF for x in h})


def test_counts_past_64_bits(spark):
    from pyspark.sql import functions as F
    big = 1 << 62
    found = spark.createDataFrame([("en", "a", big), ("en", "b", big), ("en", "a b", big - 1)], "lang string, phrase string, f long")
    real = M.frequent_phrases
    try:
        M.frequent_phrases = lambda *a, **k: (found, found.select("lang", F.lit(5).cast("long").alias("n")).distinct())
        assert rows_of(M.collocations(found)) == [("en", 1, "a b", big - 1, big, big, 5, 2_000_000 * (big - 1) // (2 * big))]
    finally:
        M.frequent_phrases = real


def test_empty_table(spark):
    assert M.collocations(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(spark, sf):
    sf = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.execute(Q.ORACLE["op13_collocations"])
    out = Q.op13_collocations(spark, sf)
    assert out.columns == [d[0] for d in rel.description]
    assert sorted(map(tuple, out.collect())) == sorted(rel.fetchall())


def test_oracle_on_awkward_texts():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    rows = texts(7, 400)
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(Q.ORACLE["op13_collocations"]).fetchall()) == plain_model(rows, 30)
