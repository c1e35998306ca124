"""The JVM interprets methods of more than 8,000 bytes: generated code stays below, texts keep their digits."""

import re

import pytest
from conftest import SMALL


def largest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("name", ["normalize_weight_stone", "normalize_height", "normalize_weight"])
def test_methods_are_compiled(spark, name):
    from fieldloom.plans.queries import QUERIES
    assert largest_method(spark, QUERIES[name](spark, SMALL)) < 8000


def test_stone_is_read_up_to_a_second_mark(spark):
    from fieldloom.functions import normalize as N
    values = ["10st 5lb", "10 stone 5 pounds", "10 stone 5 stone 9", "10st5st9", "10 stones", "x stone 5", "9st five", "150 lbs", "55kg", "é st 9"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = N.apply(df, "clean_weight", conf={"data_type": "number", "range": (40, 150), "fix_stone": True}, value="v").orderBy("i").collect()
    want = [145 / 2.2, 145 / 2.2, 145 / 2.2, 145 / 2.2, 140 / 2.2, None, 126 / 2.2, 150 / 2.2, 55.0, None]
    assert [r.fv and r.fv.num for r in rows] == want


def test_height_search_text(spark):
    from fieldloom.functions import normalize as N
    df = spark.sql("select \"5'9\\\"\" v, cast(null as array<int>) c union all select null, array(300, 150) union all select \"tall\", null")
    rows = N.apply(df, "clean_height", value="v", centimeter="c").collect()
    assert sorted(r.fv.search for r in rows) == [" None None", "150 4.92125984252 59.0551181102", "175.26 5.75 69.0"]


def test_py2_str_near_powers_of_ten(spark):
    from fieldloom.functions import text as T
    values = [0.99999999999951, 1.0, 9.9999999999949, 9.999999999995, 99.99999999995, 999.9999999995, 1000.0, -12.5, 1 / 3, 123456789012.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.s for r in df.select("i", T.py2_str("x").alias("s")).orderBy("i").collect()]
    assert got == ["1.0", "1.0", "9.99999999999", "10.0", "100.0", "1000.0", "1000.0", "-12.5", "0.333333333333", "123456789012.0", None]


def test_stages_with_large_methods_run_in_smaller_ones(spark):
    from fieldloom.plans import tables as T
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    T.load(spark, SMALL, "region")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
