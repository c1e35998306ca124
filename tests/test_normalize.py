"""Golden rows of the normalisers, hand-derived from the reproduced code."""

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import normalize as N


def run_both(spark, fn_name, values, column_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    col = df.select("i", column_fn(F.col("v")).alias("o")).orderBy("i").collect()
    frame = N.apply(df, fn_name, "o", value="v").orderBy("i").collect()
    a = [None if r.o is None else tuple(r.o) for r in col]
    b = [None if r.o is None else tuple(r.o) for r in frame]
    assert a == b
    return a


def test_age(spark):
    out = run_both(spark, "clean_age", ["25-30", " 60 yo", "18", "17", "25.5", "0", ""], N.clean_age)
    assert [o and o[1] for o in out] == ["25", "60", "18", None, None, None, None]


def test_name(spark):
    out = run_both(spark, "clean_name", ["o'neil  mary-jane", "3cd"], N.clean_name)
    assert [o[1] for o in out] == ["O'Neil Mary-Jane", "3Cd"]


def test_height(spark):
    vals = ["5'9\"", "5'6\" - 5'8\"", "6'", "7'1\"", "170", "170 cm", "tall"]
    out = run_both(spark, "clean_height", vals, N.clean_height)
    assert out[0] == ("175.26", "175.26", pytest.approx(175.26), "175.26 5.75 69.0")
    assert out[1][1] == "167.64" and out[1][3] == "167.64 5.5 66.0"
    assert out[2][1] == "182.88" and out[2][3] == "182.88 6.0 72.0"
    assert out[3] is None and out[4] is None and out[5] is None
    assert out[6] == ("", "", None, " None None")


def test_weight(spark):
    vals = ["120 lbs", "150", "55kg", "55 kilos", "55 kilograms", "54.7", "88 lb", "10 stone", "10st 5lb", "heavy"]
    out = run_both(spark, "clean_weight", vals, N.clean_weight)
    assert out[0][1] == "54.5454545455" and out[0][3] == "54.5454545455 120.252"
    assert out[1][1] == "68.1818181818" and out[1][3] == "68.1818181818 150.315"
    for o in out[2:5]:
        assert o[1] == "55" and o[3] == "55 121.2541"
    assert out[5][1] == "54.0" and out[5][3] == "54.0 119.04948"
    assert out[6][1] == "40.0"
    assert out[7] is None and out[8] is None and out[9] is None


def test_lists(spark):
    df = spark.sql("select array(300, 175, 180) c, array(30.0D, 55.5D) k")
    r = df.select(N.clean_height_list(F.col("c")).alias("h"), N.clean_weight_list(F.col("k")).alias("w")).first()
    assert r.h.name == "175" and r.w.name == "55.5"


def test_city_and_identity(spark):
    df = spark.sql("select 'a' v, 'b' s, 'c' c, 1.0D lo, 2.0D la")
    r = df.select(N.clean_city(F.col("v"), F.col("s"), F.col("c"), F.col("lo"), F.col("la")).alias("full"),
                  N.clean_city(F.col("v")).alias("short"), N.identity(F.col("v")).alias("ident")).first()
    assert (r.full.key, r.full.name) == ("a:b:c:1.0:2.0", "a")
    assert (r.short.key, r.short.name) == ("a", "a")
    assert r.ident.key is None and r.ident.name == "a"


def test_unit_conversion(spark):
    df = spark.sql("select 10.0D v")
    r = df.select(N.unit_conversion(F.col("v"), "kg", "lb").alias("a"), N.unit_conversion(F.col("v"), "cm", "cm").alias("b"),
                  N.unit_conversion(F.col("v"), "ft", "lb").alias("c")).first()
    assert r.a == pytest.approx(22.0462) and r.b == 10.0 and r.c is None


def test_posting_date(spark):
    df = spark.createDataFrame([("1995-01-05",), ("01/05/1995",), ("January 5, 1995",), ("never",)], "v string")
    out = [r.o and r.o.name for r in df.select(N.clean_posting_date(F.col("v")).alias("o")).collect()]
    assert out == ["1995-01-05T00:00:00"] * 3 + [None]
