"""How filters of a corpus interact, by the potential of the game of what they remove.

A coalition S of filters is worth v(S), the documents that at least one of S fails. Its potential is

    P(empty) = 0,   P(S) = (v(S) + sum over i in S of P(S without i)) / |S|

(Hart and Mas-Colell), and the Shapley value of filter i is P(all) - P(all without i). Everything
that a sequence of filters does at a step is a difference of worths of two coalitions: those applied
before, and these with the step's filter. So one count of documents by the set of filters they
fail, for each part, answers all orders.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.llm.common import durable, small_batches, text_or_empty

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of words
MOST_CAPITALS = 2  # percent of code points
MARKS = b"#$%&*|"
_REPEATED = FILTERS.index("E")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes of a code point behind its first
_COALITIONS = 1 << len(FILTERS)
_EXACT = math.factorial(len(FILTERS))  # potentials times this are whole


def failed_alone(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    fails = (
        len(words) < LEAST_WORDS, 100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * points, re.search(b"[" + MARKS + b"]", text) is not None)
    return sum(1 << i for i, f in enumerate(fails) if f)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("part"),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array([failed_alone(t) for t in texts], pa.int32()),
        ], ["doc_id", "part", "digest", "failed"])


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and by the set of all five filters they fail.

    Texts are compared by their SHA-256. Rows of one id, text and part are counted before anything
    is joined, and copies within a part before they meet, so that a text of very many copies is a
    few rows.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *T.StructType.fromDDL(
        "part string, digest binary, failed int").fields])
    rows = durable(
        docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                    text_or_empty().cast("binary").alias("text"))
        .mapInArrow(_judged, schema)
        .groupBy("digest", "part", "failed", "doc_id").agg(F.count("*").alias("n")))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = rows.where("doc_id is not null").join(marks, F.col("doc_id") == F.col("id"), "left").drop("id")
    every = known.unionByName(rows.where("doc_id is null"), allowMissingColumns=True).fillna(False, ["good", "toxic"])
    # of a text: the smallest id, with its rows, of each part and label
    classes = every.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), F.sum("n").alias("n"))
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0) + F.col("unnamed")
    split = classes.withColumn("first_rows", own).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct("failed", F.col("first_rows").alias("n")),
            F.struct(F.col("failed").bitwiseOR(F.lit(1 << _REPEATED)).alias("failed"),
                     (F.col("n") - F.col("first_rows")).alias("n")))).alias("x"))
    counted = lambda flag: F.sum(F.when(F.col(flag), F.col("x.n")).otherwise(0))
    return split.where("x.n > 0").groupBy("part", F.col("x.failed").alias("failed")).agg(
        F.sum("x.n").alias("n"), counted("good").alias("good"), counted("toxic").alias("toxic"))


def _worths(name: str) -> str:
    """SQL of the worth of every coalition: what documents failing one of it hold of `name`."""
    return f"""transform(sequence(0, {_COALITIONS - 1}), s -> aggregate(failures, 0L,
                 (sum, f) -> sum + if(f.failed & s <> 0, f.{name}, 0L)))"""


# by ascending coalitions: S without i is always known before S
_POTENTIALS = f"""aggregate(sequence(1, {_COALITIONS - 1}), array(0L), (known, s) -> concat(known, array(
    (aggregate(sequence(0, {len(FILTERS) - 1}), {_EXACT}L * worth[s],
               (sum, i) -> sum + if(shiftright(s, i) & 1 = 1, known[s ^ shiftleft(1, i)], 0L))) div bit_count(s))))"""


def audit(failures: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; failures as failure_counts gives them."""
    everything = _COALITIONS - 1
    orders = ["".join(o) for o in permutations(FILTERS)]
    parts = (
        failures.groupBy("part").agg(
            F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("failures"), F.sum("n").alias("total"))
        .withColumns({"worth": F.expr(_worths("n")), "goods": F.expr(_worths("good")), "toxics": F.expr(_worths("toxic"))})
        .withColumn("potential", F.expr(_POTENTIALS)))
    bit = f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {{}}, 1)) - 1)"
    steps = (
        parts.withColumn("filter_order", F.explode(F.lit(orders)))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", F.expr(bit.format("step")))
        .withColumn("before", F.expr(
            f"aggregate(filter(sequence(1, {len(FILTERS)}), k -> k < step), 0, (sum, k) -> sum | {bit.format('k')})"))
        .withColumn("after", F.expr("before | own")))
    return steps.select(
        "part", "filter_order", "step",
        F.expr("total - worth[after]").alias("kept"),
        F.expr("worth[after] - worth[before]").alias("removed"),
        F.expr("worth[own] - (worth[after] - worth[before])").alias("redundant"),
        F.expr(f"worth[{everything}] - worth[{everything} ^ own]").alias("unique_fails"),
        F.expr("goods[after] - goods[before]").alias("good_lost"),
        F.expr("toxics[after] - toxics[before]").alias("toxic_lost"),
        F.expr(f"potential[{everything}] - potential[{everything} ^ own]").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over docs (doc_id, text, source), for each source, all 120 orders and steps.

    A text fails A with under 200 words; B if fewer than half of them are distinct; C if more than 2
    percent of its code points are A-Z; D if it holds one of the MARKS; E if a smaller doc_id has
    the same text, wherever. Returns part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley, which is the Shapley value times the number of
    orders. A null text is empty, a null source the part ''. A row without doc_id neither fails E nor
    makes others fail it; rows that repeat an id count each, and don't fail E by one another. A document
    is good or toxic if any of its rows in labels says so. Other columns are not read; an empty table
    gives an empty result.
    """
    return audit(failure_counts(docs, labels))
