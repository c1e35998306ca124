import random
import zlib

from helpers import docs_frame, sample_docs, words

from fieldloom.llm import queries as Q
from fieldloom.llm.toxicity import toxicity

BAD = ["vile", "nasty", "rotten"]


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        sents = [words(rng, rng.randint(4, 12)) for _ in range(rng.randint(1, 12))]
        bad = i % 4 == 0
        if bad:
            k = rng.randrange(len(sents))
            sents[k] = sents[k] + " " + rng.choice(BAD)
        rows.append((i, ". ".join(sents) + "."))
        if i % 5:
            labels.append((i, int(bad), 0))
    return rows, labels


def test_learns_from_labels_and_finds_the_sentence(spark):
    rows, labels = corpus()
    labels += [(1, None, 0), (None, 1, 0), (2, 0, 0), (2, 0, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, score int")
    out = {r.doc_id: r for r in toxicity(docs_frame(spark, rows), lab).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        r = out[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.predicted == int(i % 4 == 0)
        if r.predicted:
            assert any(any(b in t[s.start:s.end] for b in BAD) for s in r.offending)
            assert len(r.offending) == 1


def test_awkward_rows(spark):
    rows, labels = corpus(200)
    rows += [(1000 + (i or 0) if i is not None else None, t) for i, t in sample_docs()]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, x int")
    out = toxicity(docs_frame(spark, rows), lab).collect()
    assert len(out) == len(rows)
    empty = [r for r in out if r.doc_id in (1300, 1301, 1302)]
    assert [(r.score, r.predicted, r.n_sentences) for r in empty] == [(0.0, 0, 0)] * 3


def test_nothing_to_learn_from(spark):
    rows = [(1, "vile words"), (2, None)]
    for labels in ([], [(1, 1)]):
        out = toxicity(docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert sorted((r.doc_id, r.score, r.predicted) for r in out) == [(1, 0.0, 0), (2, 0.0, 0)]
    assert toxicity(docs_frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_held_out_accuracy(spark):
    """Held-out rows of the given tables."""
    sf = "/root/testdata/sf0.01"
    got = Q.op4_toxicity(spark, sf).join(spark.read.parquet(sf + "/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.93
