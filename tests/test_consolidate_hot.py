"""Hot (document, field) keys, list values and provenance in consolidation."""

from pyspark.sql import functions as F

from fieldloom.operators import consolidate as G
from test_consolidate import SCHEMA


def hot_rows(spark, n=40_000):
    """One (document, field) holds nine tenths of all rows, each with a name of its own."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(-1)).alias("doc_id"), F.lit("title").alias("field"),
        F.when(F.col("id") % 2 == 0, "strict").otherwise("relaxed").alias("tier"), F.lit(2).alias("pass_no"), F.lit(0.0).alias("rank"),
        F.col("id").alias("pos"), F.concat(F.lit("v"), (F.col("id") % 20_000).cast("string")).alias("value"))


def largest_share(df):
    per = [r["count"] for r in df.where("doc_id = -1").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(per) / sum(per)


def test_hot_document_is_spread_over_tasks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan itself spreads, not a later re-plan
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = hot_rows(spark)
        assert largest_share(G.route(G.with_optional_columns(rows))) < 0.15
        assert largest_share(G.consolidate(rows)) < 0.15
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_first_strict_of_a_hot_field(spark):
    out = G.route(G.with_optional_columns(hot_rows(spark, 2000)))
    strict = out.where("routed_tier = 'strict'").select("doc_id", "pos").collect()
    assert (-1, 2) in {tuple(r) for r in strict} and sum(r.doc_id == -1 for r in strict) == 1
    assert all(r.pos == r.doc_id for r in strict if r.doc_id != -1)


def test_equal_seq_and_null_keys(spark):
    rows = [(None, "x", "strict", 2, 0.0, 0, "a", None, None), (None, "x", "strict", 2, 0.0, 0, "b", None, None),
            (1, "x", "strict", None, None, None, "c", None, None), (1, "x", "strict", 2, 0.0, 1, "d", None, None)]
    got = sorted((r.name, r.tier) for r in G.consolidate(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("a", "strict"), ("b", "strict"), ("c", "strict"), ("d", "relaxed")]


def test_list_values_explode_in_order(spark):
    rows = [(1, "age", "strict", 2, 0.0, 5, None, ["25", None, "30", "25", "x"]), (1, "age", "strict", 2, 0.0, 9, "41", None),
            (1, "age", "relaxed", 7, 0.0, 1, "ignored", []), (2, "price", "relaxed", 7, 0.0, 0, None, ["7", "7"])]
    df = spark.createDataFrame(rows, "doc_id long, field string, tier string, pass_no int, rank double, pos long, value string, values array<string>")
    got = sorted((r.doc_id, r.tier, r.pos, r.ix, r.key, r.name) for r in G.consolidate(df).collect())
    # the first element stays strict, the others follow in relaxed; "25" is there again, since it is new in that tier
    assert got == [(1, "relaxed", 5, 1, "30", "30"), (1, "relaxed", 5, 2, "25", "25"), (1, "relaxed", 5, 3, "", "x"),
                   (1, "relaxed", 9, 0, "41", "41"), (1, "strict", 5, 0, "25", "25"),
                   (2, "relaxed", 0, 0, "7", "7"), (2, "relaxed", 0, 1, "7", "7")]
    doc = {r.doc_id: r.fields for r in G.assemble(G.consolidate(df), df.select("doc_id").distinct()).collect()}
    assert [v.name for v in doc[1]["age"].relaxed] == ["30", "25", "x", "41"]


def test_nested_lists_are_flattened(spark):
    rows = [(1, "x", "strict", 2, 0.0, 0, None, [["a", "b"], None, [], ["c", None]])]
    df = spark.createDataFrame(rows, "doc_id long, field string, tier string, pass_no int, rank double, pos long, value string, values array<array<string>>")
    assert sorted((r.ix, r.tier, r.name) for r in G.consolidate(df).collect()) == [(0, "strict", "a"), (1, "relaxed", "b"), (2, "relaxed", "c")]


def test_provenance_reaches_the_fields(spark):
    rows = [(1, "age", "relaxed", 7, 0.0, 0, "25", "age_regex", "text", "html", "content_relaxed", None),
            (1, "age", "relaxed", 9, 0.0, 0, "25", "age_regex", "text", "html", "table", "0/1/2"),
            (1, "age", "relaxed", 9, 0.0, 0, "31", "age_regex", "text", "html", "table", "0/1/3")]
    df = spark.createDataFrame(rows, "doc_id long, field string, tier string, pass_no int, rank double, pos long, value string, "
                                     "extractor string, input_type string, source string, segment string, cell string")
    got = sorted((r.name, r.segment, r.cell, r.extractor) for r in G.consolidate(df).collect())
    assert got == [("25", "content_relaxed", None, "age_regex"), ("31", "table", "0/1/3", "age_regex")]
