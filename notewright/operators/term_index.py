"""Terms of a table in the texts of notes, through an index of runs of characters.

Each term is posted once, under the run of up to GRAM of its characters that stands at the fewest places; a
note meets a term only where it holds that run, by a hash join, and the whole term is then looked for
in the note's text. The plan is the same for ten terms and for a million: terms are rows, never
literals, and Spark broadcasts them by its own rule or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.session import scratch_path

GRAM = 4  # characters; shorter terms are their own run


def _runs(text: Column, size: int) -> Column:
    """The runs of a size, in characters, of a text, as often as they stand in it; one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def term_hits(notes: DataFrame, terms: DataFrame) -> DataFrame:
    """(note_id, term): every term that a note's text holds, whatever the case, each once.

    notes: note_id, text, ids unique and not null, or a hit counts for all notes of the id; terms: term.
    Null and empty terms and null texts hit nothing; repeated terms count once. Both are lower-cased as
    a whole before they are compared, so a term is found inside words. Equal to testing each text for each
    term. Other columns are not read.

    The terms' runs, and the notes' runs that are among them, are written to the shared folder: the size of
    the first is known when the join is planned, and texts are taken apart once.
    """
    spark = notes.sparkSession

    def written(rows: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        rows.write.parquet(path)
        return spark.read.parquet(path)

    lowered = notes.select("note_id", F.lower("text").alias("text"))
    wanted = terms.select("term").where("term <> ''").distinct().withColumn("low", F.lower("term"))
    length = F.char_length("low")
    of_terms = written(wanted.select("term", "low", F.explode(F.when(
        length >= GRAM, _runs(F.col("low"), GRAM)).otherwise(F.array("low"))).alias("run")).distinct(), "term-runs")
    # texts are taken apart into the sizes that the terms' runs have, no others
    sizes = of_terms.agg(F.collect_set(F.char_length("run")).alias("sizes")).scalar()
    runs = F.concat(*[
        F.when(F.array_contains(sizes, size), _runs(F.col("text"), size)).otherwise(F.array().cast("array<string>"))
        for size in range(1, GRAM + 1)])
    of_notes = lowered.select("note_id", F.explode(runs).alias("run"))
    # by their hash, a number, for there are as many as the texts have characters; runs that share one meet no term
    hashed = of_terms.select(F.xxhash64("run").alias("_hash")).distinct()
    met = written(of_notes.withColumn("_hash", F.xxhash64("run")).join(hashed, "_hash", "left_semi").select("note_id", "run"), "runs")
    spread = met.groupBy("run").agg(F.count("*").alias("places"))  # runs that no note holds drop out, and their terms
    every = of_terms.join(spread, "run", "left")
    posted = every.groupBy("term", "low").agg(
        F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "run")).alias("rarest"))
    posted = posted.where("rarest.places > 0").select("term", "low", F.col("rarest.run").alias("run"))
    candidates = met.join(posted, "run").select("note_id", "term", "low").distinct()
    return candidates.join(lowered, "note_id").where(F.contains("text", "low")).select("note_id", "term").distinct()


def terms_of_notes(notes: DataFrame, terms: DataFrame) -> DataFrame:
    """note_id and the terms its text holds, sorted by code point; an empty list where there are none."""
    found = term_hits(notes, terms).groupBy("note_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    return notes.select("note_id").join(found, "note_id", "left").select(
        "note_id", F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))


def classes_of_notes(notes: DataFrame, keywords: DataFrame) -> DataFrame:
    """note_id with primary_diagnosis, primary_site and histology of the first group that a note hits.

    keywords: term, place (groups in order), primary_diagnosis, primary_site, histology. Of groups of one
    place the smallest values are taken. Notes without a hit have nulls.
    """
    facts = ["primary_diagnosis", "primary_site", "histology"]
    hits = term_hits(notes, keywords).join(keywords.select("term", "place", *facts), "term")
    first = hits.groupBy("note_id").agg(F.min(F.struct("place", *facts)).alias("first"))
    return notes.select("note_id").join(first, "note_id", "left").select("note_id", *[F.col(f"first.{f}").alias(f) for f in facts])
