"""Exact duplicates of whole texts, by a tree of merged digest runs.

Rows are dealt to runs by a hash of their id, and every run holds each digest once, with its smallest
id and its number of rows. Runs then meet in rounds: in each, FAN_IN neighbouring runs are exchanged,
once for every range of the digest space, put into the order of digests and ids, and merged in one
pass along that order: of neighbours that are verified to be equal the first stays and takes over the
rows of the others. The last round leaves one run in each range. Spark's exchange keeps no order, so
the sort of a round is what merges the runs that arrive. At most FAN_IN neighbours are equal in a
round, however many copies a text has, and no task holds more than ranges of one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import durable, text_or_empty

RUNS = 64
FAN_IN = 8
DIGEST = ("text_sha256", "check", "length")


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed or return becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the normalised text, and what verifies it: a second hash, the length."""
    return docs.select("doc_id", normalised(text_or_empty()).alias("text")).select(
        "doc_id", F.sha2(F.col("text"), 256).alias("text_sha256"),
        F.xxhash64("text").alias("check"), F.length("text").alias("length"),
    )


def merged(level: DataFrame) -> DataFrame:
    """One round: runs of the same range and number, exchanged, sorted and merged.

    The pass along the order compares digest, second hash and length of neighbours. A digest whose
    rows all lack an id keeps a null id.
    """
    equal = Window.partitionBy("range", "run", *DIGEST)
    ordered = equal.orderBy(F.col("keep_id").asc_nulls_last())
    return (
        level.repartition("range", "run")
        .select("range", "run", *DIGEST, "keep_id", F.row_number().over(ordered).alias("place"),
                F.sum("rows").over(ordered.rowsBetween(
                    Window.unboundedPreceding, Window.unboundedFollowing)).alias("rows"))
        .where("place = 1").drop("place")
    )


def merge_runs(digested: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """The smallest doc_id and the row count of every digest, merged in log(runs) rounds.

    Two rows count as equal only if digest, second hash and length all agree, at every level. Copies
    within a run are counted before anything is exchanged, so a text of very many copies sends few rows.
    """
    level = (
        digested.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)))
        .groupBy("run", *DIGEST).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("rows"))
        .withColumn("range", F.substring("text_sha256", 1, 3))
    )
    while runs > 1:
        runs = -(-runs // fan_in)
        level = merged(level.withColumn("run", F.floor(F.col("run") / fan_in)))
    return level.select(*DIGEST, "keep_id", F.col("rows").alias("group_size"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and all empty texts are one group. A row without doc_id counts in
    its group but never stays; a group of such rows only has a null keep_id. Rows repeated with
    the same id and text are one document: all of them carry its kept flag. Other columns of docs
    are not read. An empty table gives an empty result.
    """
    digested = durable(digests(docs))
    winners = merge_runs(digested)
    return digested.join(winners, list(DIGEST)).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256",
    )
