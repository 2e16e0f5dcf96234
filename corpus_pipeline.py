"""From raw documents to encoded training text, in stages that each keep what the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm import line_dedup, mixing, quality, sentencepiece, simhash
from notewright.llm.common import fold, table
from notewright.llm.queries import MODEL_FILE
from notewright.session import scratch_path

# Shares of the tokens that reach the mixing stage. More refined text is wanted than there is, so
# that documents which are only likely to be refined stay as well.
TARGETS = {"refined": 1.1, "rough": 0.05, "harsh": 0.05}
STAY = 0.02  # against rates that reach the targets by a few documents, for nothing is repeated here
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from labels outside fold 1 of 3."""
    return quality.of_quality(docs.select(COLUMNS), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and with them documents of which nothing else is left.

    n_chars becomes the length of the text that is left.
    """
    cut = line_dedup.drop_repeated_lines(docs.select(COLUMNS)).where("n_removed = 0 or n_removed < n_lines")
    return cut.withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    ).select(COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the document with the smallest doc_id stays.

    Rows that share a doc_id stay or go together; rows without one stay if their group has no ids.
    """
    grouped = simhash.near_duplicates(docs, simhash.WORDS, simhash.MOST_BITS)
    gone = grouped.where("not doc_id <=> component_id").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are thinned to the target weights."""
    domains = mixing.quality_domains(table(spark, sf_dir, "labels"))
    return mixing.thin(docs, domains, TARGETS, STAY)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the best segmentation, n_best_scores."""
    return sentencepiece.encode(docs, MODEL_FILE)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

# Learned models, iteration and A-star search can't be stated in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
