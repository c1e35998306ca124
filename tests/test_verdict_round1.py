"""Costs that must stay linear, and wiring of the document pipeline."""

import time

from pyspark.sql import functions as F

from fieldloom.functions import text as T
from fieldloom.operators import canonical as J
from fieldloom.operators import mentions
from fieldloom.operators.plumbing import host_of
from fieldloom.plans import pipeline as P


def test_regex_mentions_cost_follows_the_matches(spark):
    def run(n):
        df = spark.createDataFrame([(1, "x " + " ".join(f"u{i}@mail{i}.com" for i in range(n)))], "id long, text string")
        t = time.time()
        rows = mentions.regex_mentions(df, ["id"], "text", mentions.EMAIL_PATTERN, field="email").collect()
        assert len(rows) == n and rows[-1].value == f"u{n - 1}@mail{n - 1}.com"
        return time.time() - t
    run(400)
    small, large = min(run(400) for _ in range(3)), min(run(800) for _ in range(3))
    assert large < 2.5 * small + 0.3


def test_regex_group_keeps_its_context(spark):
    df = spark.createDataFrame([(1, "id=12 and 34, id=56;\u0001 id=78")], "id long, text string")
    rows = mentions.regex_mentions(df, ["id"], "text", r"(?<=id=)([0-9])([0-9])", field="n", group=2).collect()
    assert [(r.value, r.text, r.start, r.end, r.match_ix) for r in rows] == [("2", "12", 3, 5, 0), ("6", "56", 17, 19, 1), ("8", "78", 24, 26, 2)]


def test_jaro_of_long_words_and_of_two_frames(spark):
    a = spark.createDataFrame([("abcdefghijklmnopqrstuvwx", "abcdefghijklmnopqrstuvxw")] * 200, "a string, b string")
    t = time.time()
    got = {r[0] for r in a.select(T.jaro(a["a"], a["b"])).collect()}
    assert len(got) == 1 and abs(got.pop() - (1 + 1 + 23 / 24) / 3) < 1e-12
    assert time.time() - t < 10
    b = spark.createDataFrame([("martha", "marhta")], "a string, b string")
    assert abs(b.select(T.jaro(b["a"], b["b"])).first()[0] - 17 / 18) < 1e-12


def test_repeated_value_tokens_match_one_reference_token(spark):
    refs = J.reference_table(spark, {None: ["red", "dark red: maroon"]})
    df = spark.createDataFrame([("red red",), ("RED",), ("drak red",), ("maroon",), ("blue",)], "v string")
    got = {r.v: (r.canonical, round(r.score, 3) if r.score else None) for r in J.canonicalize(df, "v", refs, score_col="score").collect()}
    assert got["red red"] == (None, None) and got["RED"] == ("red", 1.0) and got["maroon"] == ("dark red", 1.0) and got["blue"] == (None, None)
    assert got["drak red"][0] == "dark red"


def test_low_thresholds_and_thresholds_of_references(spark):
    refs = J.reference_table(spark, {None: ["abcdefghij"]})
    df = spark.createDataFrame([("abc",), ("abcdefghik",)], "v string")
    got = {r.v: r.canonical for r in J.canonicalize(df, "v", refs, threshold=0.6).collect()}
    assert got == {"abc": "abcdefghij", "abcdefghik": "abcdefghij"}
    strict = refs.withColumn("threshold", F.lit(0.99))
    assert {r.canonical for r in J.canonicalize(df, "v", strict).collect()} == {None}


def test_numeric_entities(spark):
    df = spark.createDataFrame([("a&#8217;b &#x2019; &#0; &#xD800; &#9999999; &amp;#65;",)], "t string")
    assert df.select(T.unescape_entities("t")).first()[0] == "a’b ’ &#0; &#xD800; &#9999999; &#65;"


def test_hosts(spark):
    urls = ["http://my_site.example.com/a", "https://u:p@Host.com:80/x y|z", "http://[::1]:8/x", "nohost", "mailto:a@b.c", None, "http://a?b"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(host_of("u")).collect()] == ["my_site.example.com", "host.com", "[::1]", None, None, None, "a"]


def test_site_title_and_description_reach_the_documents(spark):
    body = "<p>" + "A long paragraph of plain text without any link in it. " * 3 + "</p>"
    pages = spark.createDataFrame([
        (1, "http://a.com/1", f"<html>{body}</html>", ["", "Site title"], ["Site description"]),
        (2, "http://b.com/2", f"<html><title>Own</title>{body}</html>", ["Site title"], None)],
        "page_id long, url string, html string, inferlink_title array<string>, inferlink_description array<string>")
    vocab = spark.createDataFrame([("nothing", 0.9)], "entry string, weight double")
    docs = {r.page_id: r.fields for r in P.consolidate_documents(pages, vocab).collect()}
    assert docs[1]["title"].strict[0].name == "Site title" and docs[2]["title"].strict[0].name == "Own"
    assert docs[1]["description"].strict[0].name == "Site description"
    assert docs[2]["description"].strict[0].name.startswith("A long paragraph")


def test_user_configuration_reaches_consolidation(spark):
    from fieldloom.operators import consolidate as G
    conf = {"age": {"data_type": "int", "range": (1, 99), "function": "clean_age"}, "name": {"function": lambda v: F.upper(v)}}
    rows = spark.createDataFrame([(1, "age", "strict", 2, 0.0, 0, "75"), (1, "name", "strict", 2, 0.0, 0, "ann")],
                                 "doc_id long, field string, tier string, pass_no int, rank double, pos long, value string")
    got = {r.field: (r.key, r.name) for r in G.consolidate(rows, conf).collect()}
    assert got == {"age": ("75", "75"), "name": ("ANN", "ANN")}
