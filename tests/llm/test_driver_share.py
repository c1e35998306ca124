"""What the driver runs and holds must not grow with partitions or texts."""

import random
import uuid
from contextlib import contextmanager

import numpy as np
import pytest
from helpers import components as brute_components
from helpers import docs_frame
from test_op04_toxicity import corpus

from fieldloom.llm import graph, token_groups, toxicity


@contextmanager
def many_partitions(spark, n):
    """``n`` shuffle partitions, none put together."""
    conf = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def jobs(spark, run):
    """The result of ``run()`` and how many Spark jobs it started."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_the_fit_gets_evidence_and_no_other_features(spark, monkeypatch):
    rows, labels = corpus()
    seen = []
    fit = toxicity.fit

    def watched(bags, *args, **kw):
        seen.append(sum(len(x) for b in bags for x in b if isinstance(x, bytes)))
        return fit(bags, *args, **kw)
    monkeypatch.setattr(toxicity, "fit", watched)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, score int")
    weights, bias = toxicity.train(docs_frame(spark, rows), lab)
    assert np.count_nonzero(weights) and np.isfinite(bias)
    every = 8 * sum(len(t.split()) for _, t in rows) // 2  # two features a word; about half of the rows are learned from
    assert seen and seen[0] < every / 10


def test_training_takes_no_job_per_partition(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, score int")
    with many_partitions(spark, 4):
        few, _ = jobs(spark, lambda: toxicity.train(docs_frame(spark, rows).coalesce(1), lab))
    with many_partitions(spark, 60):
        many, n = jobs(spark, lambda: toxicity.train(docs_frame(spark, rows).repartition(60), lab))
    assert n < 40
    assert np.allclose(few[0], many[0]) and few[1] == pytest.approx(many[1])


def test_level_table_takes_no_job_per_partition(spark):
    rng = np.random.default_rng(3)
    buckets = 2 * token_groups.SLICE
    counts = [np.zeros(buckets, dtype=np.int32) for _ in range(70)]
    rows = []
    for t, c in enumerate(counts):
        at = rng.integers(0, buckets, 500)
        c[at] = rng.integers(1, 1000, 500)
        rows += [(s, t, token_groups._pack(c[s * token_groups.SLICE:(s + 1) * token_groups.SLICE])) for s in (0, 1)]
    scan = spark.createDataFrame([(s, t, bytearray(c)) for s, t, c in rows], "slice long, task long, counts binary")
    with many_partitions(spark, 60):
        levels, n = jobs(spark, lambda: token_groups._levels(scan, buckets))
    assert levels.tolist() == np.minimum(255, np.round(8 * np.log2(1.0 + sum(counts)))).astype(np.uint8).tolist()
    assert n < 20


def rounds(spark, monkeypatch, edges):
    """Components of ``edges`` and how many tables were written for them."""
    cuts = []
    cut = graph._cut
    monkeypatch.setattr(graph, "_cut", lambda df: cuts.append(0) or cut(df))
    out = {r[0]: r[1] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    monkeypatch.setattr(graph, "_cut", cut)
    return out, len(cuts)


def test_stars_take_no_round(spark, monkeypatch):
    stars = [(10 * i, 10 * i + j) for i in range(5) for j in range(1, 6)]
    out, cuts = rounds(spark, monkeypatch, [*stars, *(e[::-1] for e in stars[:7]), (3, 3), (None, 4), (4, None)])
    assert out == {x: 10 * (x // 10) for e in stars for x in e}
    assert cuts == 1
    assert rounds(spark, monkeypatch, []) == ({}, 1)


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)],
    [(40 - i, 39 - i) for i in range(0, 40, 2)] + [(0, 39)],
    [(random.Random(9).randrange(10), i) for i in range(5, 30)],
    [(a := random.Random(i)).sample(range(60), 2) for i in range(45)],
    [(5, 9), (7, 9)], [(1, 9), (9, 12)],
])
def test_components_equal_brute_force(spark, monkeypatch, edges):
    edges = [tuple(e) for e in edges]
    out, _ = rounds(spark, monkeypatch, edges)
    want = brute_components({x for a, b in edges if a != b for x in (a, b)}, edges)
    assert out == want
