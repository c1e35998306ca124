import random

import pytest
from helpers import docs_frame, sample_docs, words

from fieldloom.llm import queries as Q
from fieldloom.llm.spaced_seeds import MASKS, MISS, Seeds, contaminated, decontaminate

ITEMS = "item_id long, text string, matched long, words string"


def tokens(t):
    out, cur = [], bytearray()
    for b in (t or "").encode().lower() + b" ":
        if b >= 128 or chr(b).isalnum():
            cur.append(b)
        elif cur:
            out.append(bytes(cur))
            cur = bytearray()
    return out


def brute(docs, items, least=13):
    """Every shift of every item over every text; a cell counts only if a mask hits in it."""
    out = {}
    for i, t in docs:
        d = tokens(t)
        for k, s in items:
            q = tokens(s)
            if i is None or k is None or not q:
                continue
            masks = [m for m in MASKS if len(m) <= len(q)] + (["1" * len(q)] if len(q) < max(map(len, MASKS)) else [])
            for shift in range(-len(q) + 1, len(d)):
                eq = [0 <= shift + j < len(d) and d[shift + j] == q[j] for j in range(len(q))]
                if sum(eq) < min(least, len(q)):
                    continue
                if not any(all(eq[j + x] for x, c in enumerate(m) if c == "1") and 0 <= shift + j and shift + j + len(m) <= len(d)
                           for m in masks for j in range(len(q) - len(m) + 1)):
                    continue
                lo, hi = max(0, -shift), min(len(q), len(d) - shift)
                best = (0, 0, 0)
                for a in range(lo, hi):
                    v = 0
                    for b in range(a, hi):
                        v += 1 if eq[b] else -MISS
                        if v > best[0]:
                            best = (v, a, b + 1)
                n = sum(eq[best[1]:best[2]])
                if n >= min(least, len(q)):
                    row = (-n, best[2] - best[1], shift + best[1], best[1])
                    out[i, k] = min(out.get((i, k), row), row)
    return sorted((i, k, -n, a, x, y) for (i, k), (n, a, x, y) in out.items())


def corpus(seed=8):
    rng = random.Random(seed)
    items = [(k, words(rng, rng.randint(14, 40), 900).capitalize() + ".") for k in range(6)]
    docs = []
    for i in range(60):
        parts = [words(rng, rng.randint(0, 30), 900)]
        if i % 2:
            p = rng.choice(items)[1].split()
            for _ in range(i % 4):
                p[rng.randrange(len(p))] = "other"  # substitutions
            parts.append(" ".join(p).upper() if i % 3 else ",  ".join(p))
        parts.append(words(rng, rng.randint(0, 30), 900))
        docs.append((i, "\n".join(parts)))
    return docs, items


def run(spark, docs, items, **kw):
    it = spark.createDataFrame([(*x, 0, "w") for x in items], ITEMS)
    return sorted(tuple(r) for r in contaminated(docs_frame(spark, docs), it, **kw).collect())


def test_brute_force(spark):
    docs, items = corpus()
    want = brute(docs, items)
    assert len(want) >= 20
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_words=40) == want  # many blocks, the same result


def test_clean_texts_are_left(spark):
    docs, items = corpus()
    it = spark.createDataFrame([(*x, 0, "w") for x in items], ITEMS)
    df = docs_frame(spark, docs)
    kept = {r.doc_id for r in decontaminate(df, it).collect()}
    assert kept >= {i for i, _ in docs if i % 2 == 0}
    assert not kept & {h[0] for h in brute(docs, items)}
    assert decontaminate(df, it).columns == df.columns


def test_awkward_rows(spark):
    docs = sample_docs() + [(500, "Short item here"), (501, "a short ITEM, here it is")]
    items = [(1, None), (2, ""), (None, docs[0][1]), (3, "short item here"), (3, "short item here"), (4, docs[4][1]), (5, "x" * 9000)]
    assert run(spark, docs, items) == brute(docs, [x for x in items if x[0] is not None])


@pytest.mark.parametrize("docs,items", [([], [(1, "a b c")]), ([(1, "a b c")], []), ([], [])])
def test_empty(spark, docs, items):
    assert run(spark, docs, items) == []


def test_seed_hits_ignore_masked_words():
    import numpy as np
    w = np.arange(1, 20, dtype=np.uint64) * np.uint64(2654435761)
    s = Seeds([(1, w.tobytes())])
    t = w.copy()
    t[3] = 5  # ignored by the first mask at position 0
    assert (0, 0, 0) in {x for h in s.hits(t) for x in zip(*map(list, h), strict=True)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(sf + "/benchmark.parquet").collect()]
    got = sorted(tuple(r) for r in Q.op7_benchmark_overlap(spark, sf).collect())
    # whole items found in the text as they stand
    plain = {(i, k) for i, t in docs for k, s in items if s in t}
    assert plain and plain <= {g[:2] for g in got}
