"""Rows with much work each are dealt into more tasks as the table grows."""

from fieldloom.plans import tables as T


def test_tasks_grow_in_number_and_not_in_length(spark, tmp_path):
    spark.range(0, 40_000, numPartitions=2).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).coalesce(1)
    few, many = T.dealt(df, rows_per_task=40_000), T.dealt(df, rows_per_task=1_000)
    assert few.rdd.getNumPartitions() == 1
    sizes = many.rdd.glom().map(len).collect()
    assert len(sizes) == 40 and sum(sizes) == 40_000 and max(sizes) <= 1_100
    assert sorted(r.id for r in many.collect()) == list(range(40_000))
