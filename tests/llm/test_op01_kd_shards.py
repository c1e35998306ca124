import zlib
from collections import defaultdict

import pytest
from helpers import docs_frame, sample_docs
from pyspark.sql import functions as F

from fieldloom.llm import queries as Q
from fieldloom.llm.kd_shards import kd_shards

SMALL = "/root/testdata/sf0.001"


def check(rows, source, shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in source)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_awkward_rows(spark):
    source = sample_docs()
    check(kd_shards(docs_frame(spark, source), 5).collect(), source, 5)


def test_balanced_and_native(spark):
    # a third of all rows in one source, and a group of equal texts
    source = [(i, "same text " * 3 if i % 5 == 0 else f"text {i} " * (1 + i % 4)) for i in range(2000)]
    df = docs_frame(spark, source).withColumn("source", F.expr("if(doc_id % 3 = 0, 'hot', source)"))
    out = kd_shards(df, 7)
    assert "Python" not in out._jdf.queryExecution().toString()
    rows = out.collect()
    check(rows, source, 7)
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.size
    mean = sum(size.values()) / 7
    assert all(abs(s - mean) < 0.03 * mean for s in size.values())


def test_neighbours_share_metadata(spark):
    """Two languages of equal bytes and two shards: the cut is between them."""
    df = docs_frame(spark, [(i, "ten bytes.") for i in range(200)]).withColumn("lang", F.expr("if(doc_id % 2 = 0, 'de', 'fr')"))
    out = kd_shards(df, 2, dims=("lang",)).join(df.select("doc_id", "lang"), "doc_id").groupBy("shard", "lang").count().collect()
    assert sorted((r.shard, r.lang, r["count"]) for r in out) == [(0, "de", 100), (1, "fr", 100)]


@pytest.mark.parametrize("rows", [[], [(1, "only")], [(1, None), (1, None)]])
def test_tiny(spark, rows):
    check(kd_shards(docs_frame(spark, rows), 4).collect(), rows, 4)


def test_query(spark):
    df = Q.op1_kd_shards(spark, SMALL)
    assert dict(df.dtypes)["grown_shard"] == "int" and dict(df.dtypes)["slot"] == "bigint"
    rows = df.collect()
    check(rows, [tuple(r) for r in spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text").collect()], 24)
    assert {r.law for r in rows} == {"bytes"}
