"""The streaming document sink equals the batch result, whatever the micro-batches."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from fieldloom.plans import pipeline
from fieldloom.plans import tables as T
from fieldloom.streaming import pages as S
from fieldloom.streaming.incremental import DocumentSink, latest_documents


def flat(docs):
    fields = docs.select("page_id", "url", F.explode(F.map_entries("fields")).alias("f"))
    rows = fields.select("page_id", "url", "f.key", F.to_json("f.value").alias("value")).collect()
    return sorted(map(tuple, rows))


@pytest.fixture(scope="module")
def crawl(spark):
    """Pages in four files; a block of a site turns into boilerplate in the second and in the fourth."""
    real = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").limit(36)
    line = "<p>This long line of a site stands on many of its pages, as any foot line does.</p>"
    late = "<p>Another long line that comes back only on the very last page of this site.</p>"
    own = "<p>Page {0} has this long line of its own, written to someone{0}@example.com by hand.</p>"
    made = [(9000 + i, f"http://s{i % 2}.example.com/{i}", f"<title>T{i}</title>" + (line if i % 4 < 2 else "") + (late if i in (0, 2, 7 * 2) else "") + own.format(i))
            for i in range(16)]
    rows = real.unionByName(spark.createDataFrame(made, "page_id long, url string, html string")).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_500_000_000) + F.col("page_id"))).collect()
    rows.sort(key=lambda r: r.page_id % 4)
    folder = tempfile.mkdtemp(prefix="fl-crawl-")
    schema = "page_id long, url string, html string, ts timestamp"
    step = -(-len(rows) // 4)
    for k in range(4):
        part = rows[k * step:(k + 1) * step]
        if k == 2:
            part = part + [rows[0]]  # a page of the first file is crawled again
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):  # one file after another, in this order
            if f.startswith("part-"):
                os.rename(os.path.join(folder, f), os.path.join(folder, f"file{k}.parquet"))
    return folder, schema, rows


@pytest.fixture(scope="module")
def batch(spark, crawl):
    pages = spark.createDataFrame(crawl[2], crawl[1])
    return flat(pipeline.consolidate_documents(pages.drop("ts"), T.phrase_vocab(spark)))


@pytest.mark.parametrize("files", [1, 2])
def test_sink_equals_batch(spark, crawl, batch, files):
    out = tempfile.mkdtemp(prefix="fl-sink-")
    stream = S.read_page_stream(spark, crawl[0], crawl[1], fmt="parquet", glob="file*.parquet", max_files_per_trigger=files)
    q = S.start_document_sink(stream, T.phrase_vocab(spark), out, name=f"sink{files}-{os.getpid()}", ts_col="ts", delay="1 day")
    q.awaitTermination(600)
    assert q.exception() is None
    epochs = [d for d in os.listdir(f"{out}/documents") if d.startswith("epoch=")]
    assert len(epochs) >= 4 // files
    assert flat(latest_documents(spark, out).drop("ts")) == batch
    written = spark.read.parquet(f"{out}/documents").count()
    assert written > len(crawl[2])  # pages whose block turned were written again


def test_replayed_epoch_adds_nothing_and_compaction_changes_nothing(spark, crawl, batch):
    out, state = tempfile.mkdtemp(prefix="fl-sink-"), tempfile.mkdtemp(prefix="fl-state-")
    sink = DocumentSink(spark, T.phrase_vocab(spark), out, state, compact_every=2)
    for e in range(4):
        part = spark.read.schema(crawl[1]).parquet(f"{crawl[0]}/file{e}.parquet").drop("ts")
        sink.write(part, e)
        if e in (1, 2):
            before = sorted(map(str, spark.read.parquet(f"{out}/documents").collect()))
            sink.write(part, e)
            assert sorted(map(str, spark.read.parquet(f"{out}/documents").collect())) == before
    assert flat(latest_documents(spark, out)) == batch
    with pytest.raises(ValueError, match="another stream"):
        DocumentSink(spark, T.phrase_vocab(spark), out, state + "-other")


def test_drop_recrawls_keeps_the_first(spark, crawl):
    stream = S.read_page_stream(spark, crawl[0], crawl[1], fmt="parquet", glob="file*.parquet", max_files_per_trigger=1)
    name = f"recrawls{os.getpid()}"
    q = (S.drop_recrawls(stream, "page_id", "ts", "1 day").select("page_id").writeStream.format("memory").queryName(name)
         .option("checkpointLocation", S.checkpoint_location(spark, name)).trigger(availableNow=True).start())
    q.awaitTermination(300)
    ids = [r.page_id for r in spark.sql(f"select * from {name}").collect()]
    assert len(ids) == len(set(ids)) == len(crawl[2])
