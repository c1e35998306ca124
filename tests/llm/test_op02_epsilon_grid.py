import math
import random

import numpy as np
import pytest
from helpers import components

from fieldloom.llm import queries as Q
from fieldloom.llm.epsilon_grid import near_copies

SCHEMA = "vec_id long, embedding array<float>, label int, links long, vec string, dim int"


def brute(rows, cosine=0.98):
    """rows (vec_id, vector, label) -> sorted (vec_id, links, component, kept)."""
    ok = []
    for i, v, lab in rows:
        good = i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, dtype=np.float32).astype(float) if good else None)
    links, edges = [0] * len(rows), []
    for a in range(len(rows)):
        for b in range(a):
            x, y = ok[a], ok[b]
            if x is None or y is None or rows[a][2] != rows[b][2] or len(x) != len(y):
                continue
            if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= cosine:
                links[a] += 1
                links[b] += 1
                edges.append((rows[a][0], rows[b][0]))
    comp = components({i for i, _, _ in rows if i is not None}, edges)
    return sorted(((i, n, comp.get(i), None if i is None else comp[i] == i) for (i, _, _), n in zip(rows, links, strict=True)), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 0, "x", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in near_copies(df, **kw).collect()), key=repr)


def vectors(n, d=8, seed=1, spread=0.12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, d))
    return [(i, (centre[i % 6] + spread * rng.normal(size=d)).astype(np.float32).tolist(), i % 2 if i % 11 else 2) for i in range(n)]


def test_brute_force(spark):
    rows = vectors(300)
    want = brute(rows)
    assert any(w[1] for w in want) and any(w[3] for w in want)
    assert run(spark, rows, block=16) == want


def test_awkward_rows(spark):
    rows = vectors(40)
    nan, inf = float("nan"), float("inf")
    rows += [(100, None, 0), (101, [], 0), (102, [0.0] * 8, 0), (103, [None] * 8, 0), (104, [nan] * 8, 0), (105, [inf] * 8, 0),
             (106, rows[0][1], None), (None, rows[0][1], 0), (107, rows[0][1], rows[0][2]), (107, rows[0][1], rows[0][2]),
             (108, [2 * x for x in rows[0][1]], rows[0][2]), (109, rows[0][1][:4], rows[0][2]), (110, [1e-30] * 8, 0), (111, [1e30] * 8, 0),
             (112, [-0.0, 1.0] + [0.0] * 6, 1), (113, [0.0, 1.0] + [0.0] * 6, 1)]
    random.Random(1).shuffle(rows)
    assert run(spark, rows, block=8) == brute(rows)


def test_many_copies_and_a_chain(spark):
    chain = [(i, [math.cos(i * 0.19), math.sin(i * 0.19)], 0) for i in range(30)]  # each step links, two steps do not
    rows = chain + [(100 + i, [0.6, 0.8, 0.0], 0) for i in range(200)]
    assert run(spark, rows, block=8) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0], 0)]])
def test_tiny(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted((tuple(r) for r in Q.op2_epsilon_grid(spark, sf).collect()), key=repr)
    assert got == brute(rows)
