import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL


def test_stream_matches_batch(spark):
    from fieldloom.plans import tables as T
    from fieldloom.streaming import pages as S
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    vocab = T.phrase_vocab(spark).select("entry")
    batch = sorted(tuple(r) for r in S.page_mentions(pages, vocab).collect())
    stream = S.read_page_stream(spark, SMALL, pages.schema, fmt="parquet", glob="pages.parquet")
    q = (S.page_mentions(stream, vocab).writeStream.format("memory").queryName("pm_test")
         .option("checkpointLocation", S.checkpoint_location(spark, "pm_test_" + str(os.getpid())))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("select * from pm_test").collect())
    assert got == batch and len(got) > 0


def test_read_pages_jsonl(spark):
    from fieldloom.sources import pages as P
    d = tempfile.mkdtemp(prefix="fl-src-")
    rec = {"_id": "ab" * 32, "url": "http://a.example.com/x", "raw_content": "<title>T</title><p>hello</p>",
           "timestamp": 1500000000000, "crawl_data": {"response_headers": {"x": ["y"]}},
           "inferlink_age": [{"result": {"value": "25"}}]}
    with open(os.path.join(d, "part.jl"), "w") as fh:
        fh.write(json.dumps(rec) + "\n")
    with open(os.path.join(d, "ignored.txt"), "w") as fh:
        fh.write("not json\n")
    df = P.read_pages(spark, d)
    r = df.first()
    assert df.count() == 1 and r.cdr_id == "ab" * 32 and r["inferlink_age"] == ["25"]
    assert "crawl_data" not in df.columns


def test_vocabulary_loader(spark):
    from fieldloom.sources.configs import load_vocabulary
    d = tempfile.mkdtemp(prefix="fl-voc-")
    p = os.path.join(d, "v.json")
    with open(p, "w") as fh:
        json.dump(["Boston", "new york", "boston"], fh, indent=1)  # over several lines
    got = sorted(r.entry for r in load_vocabulary(spark, p).collect())
    assert got == ["boston", "new york"]


def test_configuration_loaders(spark):
    from fieldloom.sources import configs
    d = tempfile.mkdtemp(prefix="fl-conf-")
    with open(os.path.join(d, "n.json"), "w") as fh:
        json.dump({"age": {"data_type": "int", "function": "clean_age", "range": {"lower_bound": 18, "upper_bound": 60}},
                   "title": {"data_type": "string", "function": "identity"}}, fh, indent=1)
    with open(os.path.join(d, "s.json"), "w") as fh:
        json.dump({"eye_color": {"references": ["blue: azure", "green"], "parameters": {"threshold": "0.90"}}}, fh, indent=1)
    conf = configs.load_normalize_config(spark, os.path.join(d, "n.json"))
    assert conf == {"age": {"data_type": "int", "function": "clean_age", "range": (18, 60)}, "title": {"data_type": "string", "function": "identity"}}
    rows = configs.load_synonyms(spark, os.path.join(d, "s.json")).collect()
    assert {(r.field, r.canonical, r.synonym, r.threshold) for r in rows} >= {("eye_color", "blue", "azure", 0.9), ("eye_color", "green", "green", 0.9)}


def test_site_fields_from_jsonl_shape(spark):
    from fieldloom.operators.mentions import site_field_mentions
    df = spark.createDataFrame([("d1", ["25", "26"], None)], "doc_id string, `inferlink_age` array<string>, `inferlink_name` string")
    got = sorted((r.field, r.value) for r in site_field_mentions(df, ["doc_id"]).collect())
    assert got == [("age", "25"), ("age", "26")]


def test_cell_mentions_and_annotations(spark):
    from fieldloom.operators import spans
    from fieldloom.plans import pipeline
    html = ("<table><tr><td>Released under the MIT License.</td><td>x</td></tr>"
            "<tr><th>of the</th></tr></table>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    vocab = spark.createDataFrame([("mit license", 0.9), ("of the", 0.3)], "entry string, weight double")
    m = pipeline.cell_mentions(pages, vocab)
    got = sorted((r.row_ix, r.cell_ix, r.value, r.start, r.end) for r in m.collect())
    assert got == [(0, 0, "mit license", 3, 5), (1, 0, "of the", 0, 2)]
    ann = spans.token_annotations(m, ["page_id", "table_ix", "row_ix", "cell_ix"]).collect()
    assert sorted((a.row_ix, a.pos, a.offset, a.length) for a in ann) == [
        (0, 3, 0, 2), (0, 4, 1, None), (1, 0, 0, 2), (1, 1, 1, None)]


def test_select_regexes_skips_unknown():
    from fieldloom.plans import pipeline
    seen = []
    out = pipeline.select_regexes(["email", "nonsense"], log=seen.append)
    assert list(out) == ["email"] and seen == ["nonsense - Not found"]


def test_jsonl_record_to_index_documents(spark):
    """A crawled record (JSON line) through the whole pipeline to the index shape."""
    from fieldloom.plans import pipeline
    from fieldloom.sources import pages as P
    d = tempfile.mkdtemp(prefix="fl-e2e-")
    html = ("<html><head><title>Hello There</title><script>var x='</p>';</script></head><body>"
            "<nav><ul><li><a href='/a'>a</a></li></ul></nav><article><p>Released under the MIT License. "
            "Write to someone@example.com for the details of the licence terms.</p></article></body></html>")
    rec = {"_id": "c" * 64, "url": "http://www.site.example.com/p/1", "raw_content": html,
           "inferlink_age": [{"result": {"value": "25"}}, {"result": {"value": "25"}}],
           "inferlink_hair-color": [{"result": {"value": "Auburn"}}],
           "inferlink_price": [{"result": {"value": "x"}}, {"result": {"value": "x"}}]}
    with open(os.path.join(d, "a.jl"), "w") as fh:
        fh.write(json.dumps(rec) + "\n")
    pages = P.read_pages(spark, d)
    vocab = spark.createDataFrame([("mit license", 0.9)], "entry string, weight double")
    from fieldloom.operators.canonical import default_references
    docs = pipeline.consolidate_documents(pages, vocab, id_col="cdr_id", html_col="raw_content",
                                          references=default_references(spark))
    out = P.index_documents(docs).first()
    f = out.fields
    assert out.cdr_id == "c" * 64
    assert [v.name for v in f["title"].strict] == ["Hello There"]
    # first value strict; the second is demoted (not first, no probability) and is new in relaxed
    assert [v.name for v in f["age"].strict] == ["25"] and [v.name for v in f["age"].relaxed] == ["25"]
    assert [(v.key, v.name) for v in f["hair-color"].strict] == [("auburn", "auburn")]  # renamed + canonicalised
    assert [v.name for v in f["phrase"].strict] == ["MIT License"]
    assert [v.name for v in f["email"].strict] == ["someone@example.com"]
    prices = [v.name for v in f["price"].strict] + [v.name for v in f["price"].relaxed]
    assert prices == ["x", "x"]   # unconfigured field: never deduplicated
