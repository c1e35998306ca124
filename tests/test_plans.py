"""Plan shape checks: broadcast vocabulary joins, pushed-down scans, no Python UDFs."""

import pytest

from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dictionary_join_is_broadcast(spark):
    from fieldloom.plans.queries import QUERIES
    p = plan(QUERIES["dictionary_mentions"](spark, SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scan_prunes_columns(spark):
    from fieldloom.plans.queries import QUERIES
    df = QUERIES["title_extract"](spark, SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p or "page_id:bigint,html:string" in p
    assert "url" not in p.split("ReadSchema")[-1][:80]


@pytest.mark.parametrize("name", ["consolidate_fields", "normalize_weight", "canonicalize_vocab", "content_strict",
                                  "score_mentions", "consistent_locations"])
def test_no_python_udf(spark, name):
    from fieldloom.plans.queries import QUERIES
    p = plan(QUERIES[name](spark, SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_bounded_broadcast_respects_bound(spark):
    from pyspark.sql import functions as F
    from fieldloom.operators.plumbing import bounded_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(0, 1000).withColumnRenamed("id", "k")
        small = spark.range(0, 10).withColumnRenamed("id", "k")
        under = big.join(bounded_broadcast(small, max_rows=100), "k")
        over = big.join(bounded_broadcast(big.select((F.col("k") * 2).alias("k")), max_rows=100), "k")
        assert "BroadcastHashJoin" in plan(under)
        assert "BroadcastHashJoin" not in plan(over)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_only_when_under_partitioned(spark):
    from fieldloom.plans.tables import spread
    target = spark.sparkContext.defaultParallelism
    one = spark.range(0, 100, numPartitions=1)
    many = spark.range(0, 100, numPartitions=target * 2)
    assert spread(one).rdd.getNumPartitions() == target
    assert spread(many).rdd.getNumPartitions() == target * 2
    assert "Exchange" not in plan(spread(many))
