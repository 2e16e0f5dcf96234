"""JSONL records: notes, gold labels, predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.schemas import NOTE


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _required(name: str) -> Column:
    c = F.col(name)
    return F.coalesce(c, F.raise_error(F.lit(f"a record has no {name}"))).alias(name)


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """Notes ``note_id, text``; a line that is not JSON, or lacks a key, fails the job."""
    lines = spark.read.schema(_nullable(NOTE)).option("mode", "FAILFAST").json(path)
    return lines.select(*[_required(c) for c in NOTE.fieldNames()])


def read_keyed(spark: SparkSession, path: str, schema: T.StructType,
               key: str = "note_id") -> DataFrame:
    """Records by key with their position in the input as ``seq``.

    Rows of one file split keep their order within a task, so file, split offset and a number
    that rises within a task give the order of lines, without sorting or numbering globally.
    A later file, by path, comes after an earlier one.
    """
    lines = spark.read.schema(_nullable(schema)).option("mode", "FAILFAST").json(path)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("line"),
    )
    others = [c for c in schema.fieldNames() if c != key]
    return lines.select(_required(key), *others, position.alias("seq"))


def write_jsonl(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per row, nulls written out."""
    records.write.mode(mode).option("ignoreNullFields", "false").json(path)
