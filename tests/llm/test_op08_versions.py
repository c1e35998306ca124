from test_op08_arc_warc import PAGES, brute, digest, frame

from fieldloom.llm import arc_warc
from fieldloom.llm import queries as Q
from fieldloom.llm.arc_warc import convert


def test_both_headers_give_one_result(spark):
    assert digest(convert(frame(spark, PAGES), None, max_records=9)) == brute(PAGES)


def test_query_parses_both_headers(spark, monkeypatch):
    seen = []
    read = arc_warc.read_arc
    monkeypatch.setattr(arc_warc, "read_arc", lambda *a: seen.append(read(*a)) or seen[-1])
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/pages.parquet").collect()]
    assert sorted((tuple(r) for r in Q.op8_arc_warc(spark, sf).collect()), key=repr) == brute(rows)
    count = {r["version"]: r["count"] for df in seen for r in df.groupBy("version").count().collect()}
    assert set(count) == {1, 2} and sum(count.values()) == len(rows)
