import hashlib
import random

from helpers import docs_frame, words
from test_op05_sentence_spans import brute, passages, run, sentences

from fieldloom.llm import queries as Q

L = 51


def windows(rows):
    """Per document, the sentences that lie whole in a 51-word stretch of an earlier document (whole there, too)."""
    where, seen = {}, []
    for i, t in rows:
        s = sentences(t)
        flat = [x for q in s for x in q[2]]
        a = 0
        for j, (_, _, q) in enumerate(s):
            z = a + len(q)
            for x in range(max(0, min(a, z - L)), min(a, max(len(flat) - L, a if len(q) >= L else 0)) + 1):
                v = (tuple(flat[x:max(x + L, z)]), a - x, len(q))
                seen.append((i, j, v))
                where[v] = min(where.get(v, i), i)
            a = z
    return {(i, j) for i, j, v in seen if where[v] < i}


def corpus(seed=5):
    rng = random.Random(seed)
    tail = lambda n: words(rng, n, 9000)
    rows = []
    for n in range(12):  # 20 words, a whole sentence of 18, 16 words: 54 that begin and end inside a sentence
        p = tail(20) + ". " + tail(18) + ". " + tail(16)
        for c in range(2):
            rows.append((100 * c + n, tail(5) + " " + p + " " + tail(5) + ". " + tail(8)))
    one = tail(60)
    return rows + [(300, one), (301, one.upper())]


def test_passages_that_begin_and_end_inside_a_sentence(spark):
    rows = corpus()
    assert run(spark, rows) == []  # whole runs alone find none of them
    got = run(spark, rows, open_ends=True)
    assert {(r[0], j) for r in got for j in range(r[1], r[2] + 1)} == windows(rows)
    assert {r[0] for r in got} == {*range(100, 112), 301}
    assert {r[5] for r in got} == {*range(12), 300}
    texts = dict(rows)
    for i, ix, last, a, z, _ in got:
        s = sentences(texts[i])
        assert (a, z) == (s[ix][0], s[last][1])


def test_short_stretches_are_left(spark):
    rng = random.Random(6)
    p = words(rng, 8, 9000) + ". " + words(rng, 9, 9000) + ". " + words(rng, 8, 9000)  # 25 words
    rows = [(i, words(rng, 9, 9000) + " " + p + " " + words(rng, 9, 9000)) for i in range(5)]
    assert run(spark, rows, open_ends=True) == []


def test_sentences_of_complete_runs_are_found_too(spark):
    rows = passages()
    cut = lambda r: {(x[0], j) for x in r for j in range(x[1], x[2] + 1)}
    got = cut(run(spark, rows, open_ends=True))
    assert got >= cut(brute(rows)) and got >= windows(rows)


def test_query_removes_the_ranges(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    spans = {}
    for i, ix, last, a, z, kept in run(spark, rows, open_ends=True):
        spans.setdefault(i, []).append((ix, last, a, z, kept))
    want = []
    for i, t in rows:
        for _, _, a, z, _ in sorted(spans.get(i, []), reverse=True):
            t = t[:a] + t[z:]
        want.append((i, sorted(spans[i]) if i in spans else None, t if t is None else len(t),
                     t if t is None else hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.ranges and [tuple(x) for x in r.ranges], r.chars_left, r.text_sha256) for r in Q.op5_sentence_removal(spark, sf).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert 143 in spans and len(got) == len(rows)
