import random

import duckdb
from pyspark.sql import functions as F

from fieldloom.functions import text as T


def test_py2_str_matches_python_g12(spark):
    vals = [54.54545454545454, 175.26000000000002, 69.0, 0.0, 1e-5, 1e16, 120.25200000000001, 5.75, 0.3, -3.5, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.s for r in df.select(T.py2_str(F.col("x")).alias("s")).collect()]
    want = []
    for v in vals:
        s = "%.12g" % v
        want.append(s if ("." in s or "e" in s) else s + ".0")
    assert got == want


def test_jaro_matches_duckdb(spark):
    random.seed(7)
    pairs = [("martha", "marhta"), ("dwayne", "duane"), ("", ""), ("a", ""), ("abcd", "dcba")]
    for _ in range(150):
        pairs.append(("".join(random.choice("abcde") for _ in range(random.randint(1, 8))),
                      "".join(random.choice("abcde") for _ in range(random.randint(1, 8)))))
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", T.jaro(F.col("a"), F.col("b")).alias("j")).collect()
    con = duckdb.connect()
    for r in rows:
        assert abs(con.execute("select jaro_similarity(?, ?)", [r.a, r.b]).fetchone()[0] - r.j) < 1e-12


def test_py_float_grammar(spark):
    df = spark.createDataFrame([(" 12 ",), ("1e2",), ("55d",), ("inf",), (".5",), ("abc",)], "s string")
    got = [r.f for r in df.select(T.py_float(F.col("s")).alias("f")).collect()]
    assert got[0] == 12.0 and got[1] == 100.0 and got[2] is None and got[4] == 0.5 and got[5] is None
