"""Structured Streaming over crawled pages.

Stage 1's per-page work (title, block text, tokens, vocabulary spans, regex
mentions) is stateless, so the batch functions run unchanged on a stream; the
vocabulary is a static broadcast side of a stream-static join.  Re-crawled
pages are dropped with a watermark on the crawl time.  Stage 2 runs per
micro-batch in ``foreachBatch``, over block counts that are kept for the whole
stream (see ``fieldloom.streaming.incremental``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import content, mentions, tokens
from fieldloom.session import ensure_checkpoint_dir


def read_page_stream(spark: SparkSession, path: str, schema, fmt: str = "json", glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def drop_recrawls(stream: DataFrame, id_col: str, ts_col: str, delay: str = "1 day") -> DataFrame:
    """Keep the first crawl of a page within the watermark delay."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def page_mentions(pages: DataFrame, vocab: DataFrame, *, id_col: str = "page_id", html_col: str = "html",
                  field: str = "phrase", n: int = 3) -> DataFrame:
    """Stateless per-page extraction: relaxed content -> tokens -> vocabulary
    spans, as ``(id, segment, field, value, start, end)``."""
    segs = pages.select(id_col, F.lit("content_relaxed").alias("segment"),
                        content.relaxed_content(content.html_blocks(html_col)).alias("text"))
    toks = segs.select(id_col, "segment", tokens.tokenize(F.col("text")).alias("tokens"))
    m = mentions.dictionary_mentions(toks, [id_col, "segment"], "tokens", vocab, field=field, n=n)
    return m.select(id_col, "segment", "field", "value", "start", "end")


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Streaming checkpoint under the shared ``spark.checkpoint.dir``."""
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"


def start_document_sink(pages_stream: DataFrame, vocab: DataFrame, out_path: str, name: str = "documents",
                        id_col: str = "page_id", ts_col: str | None = None, delay: str = "1 day", trigger: dict | None = None, **kw):
    """Run the full pipeline on a stream of pages and write index documents below
    ``out_path``; ``incremental.latest_documents`` reads them.  With ``ts_col``,
    re-crawls within ``delay`` are dropped by the stream's own state.  The page and
    block state of the sink lives beside the stream's checkpoint."""
    from fieldloom.streaming.incremental import DocumentSink

    location = checkpoint_location(pages_stream.sparkSession, name)
    sink = DocumentSink(pages_stream.sparkSession, vocab, out_path, f"{location}-state", id_col=id_col, **kw)
    if ts_col:
        pages_stream = drop_recrawls(pages_stream, id_col, ts_col, delay)
    w = pages_stream.writeStream.foreachBatch(sink.write).option("checkpointLocation", location)
    return w.trigger(**(trigger or {"availableNow": True})).start()
