from pyspark.sql import functions as F


def orders(spark, n):
    """Rows to merge notes from: a key, a number and a date."""
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") * 3).alias("c"),
        F.date_add(F.lit("2025-01-01"), (F.col("id") % 400).cast("int")).alias("d"))
