"""Shared pieces: lineage cuts in the shared folder, held-out folds, bounded samples."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def use_shared_folder(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names in spark.checkpoint.dir.

    Only where that setting is absent and the master is local (tests) is an own folder made.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(shared)


def durable(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there, so that a lost executor costs little."""
    use_shared_folder(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo folds; null keys fall in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds)), F.lit(0))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int
) -> DataFrame:
    """At most per_class labelled documents of each class 0 and 1: the smallest hashed ids.

    Returns doc_id, text, label. An id that labels contradicts itself on is left out, as are
    null labels and labels of no document; of repeated rows of an id one is used.
    """
    known = (
        labels.where(keep & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("most"))
        .where("label = most").select("doc_id", F.col("label").cast("int").alias("label"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    chosen = [
        known.where(F.col("label") == c).orderBy("order", "doc_id").limit(per_class)
        for c in (0, 1)
    ]
    picked = F.broadcast(chosen[0].unionAll(chosen[1]))  # at most 2 * per_class rows
    return (
        docs.select("doc_id", text_or_empty().alias("text")).join(picked, "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    )


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most `rows` rows go to Python at a time: texts are long. Smaller settings are kept."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def unused(df: DataFrame, name: str) -> str:
    """name, or the first of name_, name__, ... that is no column of df, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
