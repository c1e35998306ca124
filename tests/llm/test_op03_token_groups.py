import random

import pytest
from helpers import components, docs_frame, sample_docs, words

from fieldloom.llm import queries as Q
from fieldloom.llm import token_groups
from fieldloom.llm.token_groups import jaccard_classes


def brute(rows, k=5, percent=80):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            inter = len(sets[a] & sets[b])
            if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                links.append((rows[a][0], rows[b][0]))
    comp = components({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), comp.get(i)) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def run(spark, rows, **kw):
    return sorted((tuple(r) for r in jaccard_classes(docs_frame(spark, rows), buckets=1 << 12, **kw).collect()), key=repr)


def test_awkward_rows(spark):
    rows = sample_docs()
    want = brute(rows)
    assert sum(c != i for i, _, c in want if i is not None) >= 7
    assert run(spark, rows) == want


def test_borders_of_the_threshold(spark):
    """Sets of many sizes that share a passage and overlap by just about 80 %."""
    rng = random.Random(3)
    common = words(rng, 12).split()
    rows = []
    for i in range(60):
        base = words(rng, 10 + 3 * i).split()
        cut = round(len(base) * rng.choice([0.05, 0.1, 0.15]))
        rows.append((3 * i, " ".join(base + common)))
        rows.append((3 * i + 1, " ".join(base[cut:] + common)))
        rows.append((3 * i + 2, " ".join(base + words(rng, cut).split() + common)))
    assert run(spark, rows) == brute(rows)


def test_large_groups_are_cut_and_still_meet(spark, monkeypatch):
    monkeypatch.setattr(token_groups, "GROUP_DOCS", 4)
    rng = random.Random(5)
    base = words(rng, 60).split()
    rows = []
    for i in range(50):  # near copies of one text
        t = list(base)
        t[rng.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join(base)) for i in range(50)]
    assert run(spark, rows) == brute(rows)


def test_an_id_with_several_texts_is_one_vertex(spark, monkeypatch):
    rng = random.Random(12)
    def near(t):
        w = t.split()
        w[len(w) // 2] = "changed"
        return " ".join(w)
    a, b, c, d = (words(rng, 60, 9000) for _ in range(4))
    rows = [(1, near(a)), (5, a), (5, b), (7, near(b)), (8, c), (9, c), (9, d), (9, d), (11, near(d)), (12, words(rng, 30, 9000)), (12, words(rng, 30, 9000))]
    want = brute(rows)
    assert {i: comp for i, _, comp in want} == {1: 1, 5: 1, 7: 1, 8: 8, 9: 8, 11: 8, 12: 12}
    for seed in range(3):  # whatever comes first
        rng.shuffle(rows)
        assert run(spark, rows) == brute(rows) == want


@pytest.mark.parametrize("rows", [[], [(5, None)], [(5, "a b c d e f")]])
def test_tiny(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    df = Q.op3_ngram_jaccard(spark, sf)
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == brute(rows)
