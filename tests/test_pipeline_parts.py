"""Suffix rules, landmark values in place, hooks with isolated errors, cells and URL words in one run, the typed index."""

import tempfile
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.operators import content, mentions, spans, tokens
from fieldloom.operators.plumbing import registered_domains, suffix_rules
from fieldloom.plans import pipeline
from fieldloom.sources import pages as P


def test_suffix_rules(spark):
    rules = suffix_rules(spark, ["com", "*.ck", "!www.ck", "CO.UK ", "uk", None, "", "*.kobe.jp", "!city.kobe.jp", "jp"])
    want = {"a.b.com": "b.com", "com": None, "x.y.foo.ck": "y.foo.ck", "foo.ck": "foo.ck", "www.ck": "www.ck", "a.www.ck": "www.ck",
            "a.b.co.uk": "b.co.uk", "co.uk": "co.uk", "c.x.kobe.jp": "c.x.kobe.jp", "city.kobe.jp": "city.kobe.jp", "z.city.kobe.jp": "city.kobe.jp",
            "a.unlisted": "a.unlisted", "127.0.0.1": None, "[::1]": None}
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r.host: r.registered_domain for r in registered_domains(hosts, rules).collect()}
    assert got == {h: d for h, d in want.items() if d}


def site_pages(spark):
    rows = [(1, "http://www.shop.com/a", "<b>Ann</b><i>9</i>"), (2, "http://shop.com/b", "<b> Bo </b>"), (3, "http://other.com/", "<b>no rule</b>"),
            (4, None, "<b>x</b>"), (5, "http://x.shop.com/", None), (6, "http://y.shop.com/", "<b></b>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_landmark_values_leave_the_html_where_it_is(spark):
    rules = spark.createDataFrame([("shop.com", "inferlink_name", "<b>", "</b>"), ("shop.com", "inferlink_price", "<i>", "</i>")],
                                  "site string, field string, begin string, end string")
    sfx = suffix_rules(spark, ["com"])
    out = content.landmark_values(site_pages(spark).repartition(4), rules, "page_id", sfx)
    assert sorted((r.page_id, r.field, r.value, r.rule_ix) for r in out.collect()) == [
        (1, "inferlink_name", "Ann", 0), (1, "inferlink_price", "9", 1), (2, "inferlink_name", "Bo", 0), (6, "inferlink_name", "", 0)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        folder = tempfile.mkdtemp(prefix="fl-pages-")
        site_pages(spark).write.mode("overwrite").parquet(folder)
        df = content.landmark_values(spark.read.parquet(folder), rules, "page_id", sfx)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "html" in plan
        assert not any("Exchange hash" in line for line in plan.splitlines())  # the HTML side meets no exchange at all
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    c = pipeline.landmark_candidates(site_pages(spark), rules, sfx)
    assert sorted((r.doc_id, r.field, r.value, r.tier) for r in c.collect()) == [(1, "name", "Ann", "strict"), (1, "price", "9", "strict"), (2, "name", "Bo", "strict")]


def test_vocabularies_of_several_fields(spark):
    df = spark.createDataFrame([(1, "New York Ann blue New")], "id long, text string").select("id", tokens.tokenize("text").alias("tokens"))
    t = lambda *w: spark.createDataFrame([(x,) for x in w], "entry string")
    weighted = spark.createDataFrame([("blue", 0.7)], "entry string, weight double")
    v = mentions.vocabularies({"city": (t("new york", "new"), 3), "name": (t("ann", "new york"), 1), "eye_color": (weighted, 1)})
    m = mentions.dictionary_mentions(df, ["id"], "tokens", v, field="", n=3)
    assert sorted((r.field, r.extractor, r.value, r.start, r.weight) for r in m.collect()) == [
        ("city", "city_dictionary", "new", 0, None), ("city", "city_dictionary", "new", 4, None), ("city", "city_dictionary", "new york", 0, None),
        ("eye_color", "eye_color_dictionary", "blue", 3, 0.7), ("name", "name_dictionary", "ann", 2, None)]


def number_finder():
    def numbers(text):  # a closure travels to the workers by value
        if "boom" in text:
            raise ValueError("bad text")
        return [w for w in text.split() if w.isdigit()]
    return numbers


def test_a_failing_extractor_leaves_other_rows_whole(spark):
    df = spark.createDataFrame([(1, "a 1 b 2"), (2, "boom 3"), (3, None), (4, "none"), (5, "7")], "id long, text string").repartition(2)
    found, errors = mentions.hook_mentions(df, ["id"], "text", number_finder(), field="code")
    assert sorted((r.id, r.value, r.match_ix) for r in found.collect()) == [(1, "1", 0), (1, "2", 1), (5, "7", 0)]
    assert [(r.id, r.extractor, r.error) for r in errors.collect()] == [(2, "code_hook", "ValueError: bad text")]


def table_pages(spark):
    html = ("<title>T</title><p>This is the main text of the page, it is 180 cm and 70 kg or so, call code 55.</p>"
            "<table><tr><td>new york</td><td>boom 1</td></tr><tr><td>Age: 31</td><td>new york</td></tr></table>")
    return spark.createDataFrame([(1, "http://new.york.example.com/boston?x=1", html), (2, "http://b.example.com/", "<p>nothing</p>")], "page_id long, url string, html string")


def test_cells_url_words_measures_and_hooks_in_one_run(spark):
    cities = spark.createDataFrame([("new york", 0.9), ("boston", 0.8)], "entry string, weight double")
    vocab = mentions.vocabularies({"city": (cities, config.DICTIONARY_NGRAMS["city"])})
    errors = tempfile.mkdtemp(prefix="fl-errors-") + "/e"
    args = dict(cells=True, url_tokens=True, height_weight=True, hooks={"code": number_finder()}, regexes={"age": pipeline.REGEX_EXTRACTORS["age"]})
    ex = pipeline.extract(table_pages(spark), vocab, **args)
    cands = {(r.field, r.pass_no, r.value, r.segment, r.cell, r.extractor) for r in pipeline.candidates(ex).where("doc_id = 1").collect()}
    assert {c for c in cands if c[3] == "table"} == {
        ("city", 9, "new york", "table", "0/0/0", "city_dictionary"), ("city", 9, "new york", "table", "0/1/1", "city_dictionary"),
        ("age", 10, "Age: 31", "table", "0/1/0", "age_regex"), ("code", 10, "31", "table", "0/1/0", "code_hook")}
    assert {c for c in cands if c[3] == "url"} == {("city", 11, v, "url", None, "city_dictionary") for v in ("new york", "boston")}
    assert {(c[0], c[2]) for c in cands if c[5] == "height_weight" and c[3] == "content_strict"} == {("height", "180"), ("weight", "70")}
    fields = pipeline.consolidate_fields(table_pages(spark), vocab, errors_path=errors, **args).where("doc_id = 1").collect()
    assert ("city", "relaxed", "boston", "url", "city_dictionary") in {(r.field, r.tier, r.name, r.segment, r.extractor) for r in fields}
    assert {(r.field, r.tier, r.num) for r in fields if r.field in ("height", "weight")} == {(f, t, n) for f, n in (("height", 180.0), ("weight", 70.0)) for t in ("strict", "relaxed")}
    bad = spark.read.parquet(errors).collect()
    assert {(r.page_id, r.segment, r.cell, r.extractor) for r in bad} >= {(1, "table", "0/0/1", "code_hook")}
    # the same annotations for cells
    ann = spans.token_annotations(ex["spans"].where("segment = 'table'"), ["page_id", "segment", "cell"]).collect()
    assert sorted((a.cell, a.pos, a.offset, a.length) for a in ann) == [("0/0/0", 0, 0, 2), ("0/0/0", 1, 1, None), ("0/1/1", 0, 0, 2), ("0/1/1", 1, 1, None)]


def test_typed_index(spark):
    rows = [(1, "age", "strict", 2, 0.0, 0, "25", "25"), (1, "age", "relaxed", 7, 0.0, 0, "", "about 30"), (1, "age", "relaxed", 7, 0.0, 1, "", "17"),
            (1, "eye_color", "strict", 2, 0.0, 0, "blue", "blue"), (1, "title", "strict", 3, 0.0, 0, None, "T"), (1, "title", "relaxed", 4, 0.0, 0, None, "T"),
            (1, "posting-date", "strict", 2, 0.0, 0, "2017-03-04T05:06:07", "2017-03-04T05:06:07"), (1, "posting-date", "relaxed", 7, 0.0, 0, "", "yesterday"),
            (1, "posting-date", "relaxed", 7, 0.0, 1, "2017-03-05", "2017-03-05"), (1, "phrase", "relaxed", 7, 0.0, 0, "x", "x"),
            (2, "height", "strict", 2, 0.0, 0, "180", "180"), (None, "price", "strict", 2, 0.0, 0, "5", "5")]
    fields = spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, field string, tier string, pass_no int, rank double, pos long, key string, name string, num double, search string")
    good, bad = P.index_rows(fields)
    assert sorted((r.field, r.tier, r.name, r.reason) for r in bad.collect()) == [
        ("age", "relaxed", "about 30", "wrong type"), ("phrase", "relaxed", "x", "not in the index"),
        ("posting-date", "relaxed", "yesterday", "wrong type"), ("title", "relaxed", "T", "not in the index")]
    docs = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (None, "u4")], "doc_id long, url string")
    out = P.index_rows_to_documents(good, docs)
    assert [f.name for f in out.schema["fields"].dataType] == list(config.INDEX_FIELDS)
    d = {r.url: r.fields for r in out.collect()}
    assert [(v.key, v.name) for v in d["u1"]["age"].strict] == [(25, 25)] and [(v.key, v.name) for v in d["u1"]["age"].relaxed] == [(None, 17)]
    assert [v.name for v in d["u1"]["posting-date"].strict] == [datetime(2017, 3, 4, 5, 6, 7)] and d["u1"]["posting-date"].relaxed[0].key == datetime(2017, 3, 5)
    assert d["u1"]["title"].asDict().keys() == {"strict"} and [v.name for v in d["u1"]["eye-color"].strict] == ["blue"]
    assert d["u2"]["height"].strict[0].search is None and d["u3"]["age"].strict == [] and d["u4"]["price"].strict[0].name == "5"


@pytest.mark.parametrize("value,ok", [("2017", True), ("2017-03", True), ("2017-03-04", True), ("2017-03-04T05", True), ("2017-03-04T05:06Z", True),
                                      ("2017-03-04T05:06:07.123+02:00", True), ("1500000000000", True), ("2017-13-04", False), ("03/04/2017", False), ("", False)])
def test_index_dates(spark, value, ok):
    got = spark.createDataFrame([(value,)], "v string").select(P._typed(F.col("v"), "date").alias("d")).first().d
    assert (got is not None) == ok


def test_many_matches_and_elements_in_one_row(spark):
    """Linear: ten times the matches or elements take nowhere near a hundred times as long."""
    def seconds(df):
        df.count()
        t = time.time()
        rows = df.agg(F.count("*").alias("n"), F.max("end" if "end" in df.columns else "list_ix").alias("m")).first()
        return rows.n, rows.m, time.time() - t
    text = lambda n: spark.createDataFrame([(1, " ".join(f"a{i:06d}@b.com" for i in range(n)))], "id long, text string")
    email = lambda n: mentions.regex_mentions(text(n), ["id"], "text", mentions.EMAIL_PATTERN, field="e")
    n, end, t = seconds(email(32_000))
    assert n == 32_000 and end == 32_000 * 14 - 1 and t < 30
    html = spark.createDataFrame([(1, "".join(f"<ul><li>a{i}</li></ul>" for i in range(16_000)))], "id long, html string")
    n, last, t = seconds(content.extract_lists(html, "id"))
    assert n == 16_000 and last == 15_999 and t < 30


def test_grouped_matches_over_many_blocks(spark):
    rows = [(i, " ".join(f"my name is n{i}x{k}" for k in range(m))) for i, m in enumerate((0, 1, 127, 128, 129, 300))]
    df = spark.createDataFrame(rows, "id long, text string")
    m = mentions.regex_mentions(df, ["id"], "text", config.MY_NAME_IS_PATTERN, field="name", group=1).collect()
    texts = dict(rows)
    assert len(m) == sum((0, 1, 127, 128, 129, 300))
    for r in m:
        assert r.value == f"n{r.id}x{r.match_ix}" and texts[r.id][r.start:r.end] == r.text == f"my name is {r.value}"
