import hashlib
import random
import re

import pytest
from helpers import docs_frame, sample_docs, words

from fieldloom.llm import queries as Q
from fieldloom.llm.sentence_spans import remove_spans, repeated_spans


def sentences(text):
    """(start, end, words) of each sentence of the text."""
    out, cur = [], []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        if cur and re.search(r"[.!?\n]", re.sub(r".*[0-9A-Za-z\x80-\U0010ffff]", "", cur[-1][2]) + text[cur[-1][1]:m.start()]):
            out.append(cur)
            cur = []
        cur.append((m.start(), m.end(), m.group()))
    if cur:
        out.append(cur)
    fold = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
    return [(s[0][0], s[-1][1], tuple(fold(x[2]) for x in s)) for s in out]


def brute(rows, k=2, least=25, stretch=0):
    """Ranges per text; ``stretch``: the least number of words in a range."""
    where = {}
    runs = []
    for n, (i, t) in enumerate(rows):
        if i is None:
            continue
        s = sentences(t)
        for j in range(len(s)):
            z = j + k
            while z < len(s) and sum(len(x[2]) for x in s[j:z]) < least:
                z += 1
            w = sum((x[2] for x in s[j:z]), ())
            if z <= len(s) and len(w) >= least:
                runs.append((n, i, j, w, s[j][0], s[z - 1][1], z - 1))
                where.setdefault(w, []).append((i, n, j))
    out = {}
    for n, i, j, w, a, z, last in runs:
        first = min(x[0] for x in where[w])
        again = any(x[1] == n and x[2] < j for x in where[w])
        if i > first or again:
            out.setdefault((i, n), set()).add((j, a, z, first, last))
    result = []
    for (i, n), hits in out.items():
        isl = []
        for j, a, z, f, last in sorted(hits):
            if isl and j <= isl[-1][1] + 1:
                isl[-1] = [isl[-1][0], max(isl[-1][1], last), min(isl[-1][2], a), max(isl[-1][3], z), min(isl[-1][4], f)]
            else:
                isl.append([j, last, a, z, f])
        s = sentences(rows[n][1])
        result += [(i, *x) for x in isl if sum(len(q[2]) for q in s[x[0]:x[1] + 1]) >= stretch]
    return sorted(set(result))


def run(spark, rows, **kw):
    spans = repeated_spans(docs_frame(spark, rows), **{"min_words": 25, "min_stretch": 0, **kw})
    return sorted(tuple(r) for r in spans.drop("text_hash").collect())


def passages(seed=4):
    rng = random.Random(seed)
    text = lambda n: " ".join(words(rng, rng.randint(4, 15), 3000).capitalize() + rng.choice(".!?\n") for _ in range(n))
    p = [text(6) for _ in range(4)]
    rows = [(i, text(rng.randint(0, 9)) + " " + (rng.choice(p) if i % 3 else "") + " " + text(rng.randint(0, 5))) for i in range(80)]
    return rows + [(200, p[0] + " " + p[0]), (201, p[1].upper().replace(" ", "  "))]


def test_brute_force(spark):
    rows = passages()
    want = brute(rows)
    assert len(want) > 40
    assert run(spark, rows) == want
    assert run(spark, rows, k=3, min_words=5) == brute(rows, 3, 5)
    for stretch in (12, 25, 40):
        assert run(spark, rows, min_words=8, min_stretch=stretch) == brute(rows, 2, 8, stretch)


def test_short_repeats_are_spared_and_long_ones_found(spark):
    """A repeated line stays; a passage of the same sentences in a row goes, wherever the runs begin."""
    rng = random.Random(8)
    say = lambda n: words(rng, n, 9000).capitalize() + ". "
    line = say(9) + say(10)  # 19 words: two short sentences
    passage = say(6) + say(7) + say(21) + say(5) + say(14)
    rows = [(i, say(12) + (line if i % 2 else passage) + say(11)) for i in range(20)]
    got = run(spark, rows, min_words=8, min_stretch=25)
    assert got == brute(rows, 2, 8, 25) and {r[0] for r in got} == set(range(2, 20, 2))


def test_texts_of_one_id_are_told_apart(spark):
    rng = random.Random(9)
    say = lambda n: words(rng, n, 9000).capitalize() + ". "
    p = say(15) + say(20) + say(18)
    clean = say(12) + say(14) + say(13) + say(16)
    rows = [(1, p + say(9)), (2, say(8) + p), (2, clean), (2, None), (2, clean), (3, p)]
    df = docs_frame(spark, rows)
    spans = repeated_spans(df)
    assert sorted(tuple(r) for r in spans.drop("text_hash").collect()) == brute(rows, 2, 8, 25)
    got = sorted((r.doc_id, r.text) for r in remove_spans(df.where("text is not null"), spans).collect())
    left = rows[1][1][:rows[1][1].index(p)] + rows[1][1][rows[1][1].index(p) + len(p.rstrip()):]
    assert got == sorted([(1, rows[0][1]), (2, left), (2, clean), (2, clean), (3, p[len(p.rstrip()):])])


def test_removal_minds_no_column_names(spark):
    rows = [(1, "a"), (2, None)]
    df = docs_frame(spark, rows).withColumnRenamed("spans", "__cut0").withColumnRenamed("ids", "__id")
    out = remove_spans(df, repeated_spans(df))
    assert out.columns == df.columns and out.count() == 2


def test_awkward_rows(spark):
    rows = sample_docs()
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "One. Two.")]])
def test_tiny(spark, rows):
    assert run(spark, rows) == []


def test_removal(spark):
    rows = passages() + [(300, None)]
    df = docs_frame(spark, rows)
    spans = repeated_spans(df)
    cut = {}
    for i, _, _, a, z, _ in brute(rows, 2, 8, 25):
        cut.setdefault(i, []).append((a, z))
    out = remove_spans(df, spans)
    assert out.columns == df.columns
    for r in out.collect():
        t = dict(rows)[r.doc_id]
        for a, z in sorted(cut.get(r.doc_id, []), reverse=True):
            t = t[:a] + t[z:]
        assert r.text == t


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    ranges, want = brute(rows, 2, 8, 25), []
    cut = {}
    for r in ranges:
        cut.setdefault(r[0], []).append(r[3:5])
    for r in ranges:
        t = dict(rows)[r[0]]
        for a, z in sorted(cut[r[0]], reverse=True):
            t = t[:a] + t[z:]
        want.append((*r, len(t), hashlib.sha256(t.encode()).hexdigest()))
    got = Q.op5_sentence_spans(spark, sf)
    assert got.columns == ["doc_id", "first_sentence", "last_sentence", "start", "stop", "kept_in", "chars_left", "text_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 10
