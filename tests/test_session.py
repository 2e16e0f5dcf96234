from collections import Counter

from pyspark.sql import functions as F

from notewright.session import spread


def test_a_file_of_one_row_group_is_dealt_out_evenly(spark, tmp_path):
    """Split by bytes it has partitions enough, but all rows come in one of them."""
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("id as k", "id * 3 as c", "id % 7 as d").coalesce(1).write.parquet(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        even = spread(rows)
        held = Counter(r[0] for r in even.select(F.spark_partition_id()).collect())
        assert sorted(even.collect()) == sorted(rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert max(held.values()) < 20_000 / spark.sparkContext.defaultParallelism


def test_rows_of_one_key_are_dealt_out(spark):
    rows = spark.range(0, 20_000, 1, 1).selectExpr("1 as k", "id as c", "cast(null as date) as d")
    held = Counter(r[0] for r in spread(rows).select(F.spark_partition_id()).collect())
    assert max(held.values()) < 20_000 / 2
