"""Inputs of the queries, derived by Spark from the supplied tables.

No supplied table holds clinical text, so one note is rendered per ``orders`` row. Model
responses are built from the gold labels; their key decides how an answer is written or
broken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.deidentify import deidentify
from notewright.operators.extract import extract
from notewright.operators.responses import model_predictions
from notewright.plans.note_fixture import draw, pick, render_notes
from notewright.schemas import FACT_COLUMNS
from notewright.session import spread

RESPONSE_KINDS = (
    "plain", "plain", "plain", "fenced", "fenced_json", "prose", "tail", "ecog_text",
    "upper_case", "keys_left_out", "array", "two_objects", "no_response", "bad_domain",
    "extra_members", "plain_member", "null_stage", "odd_text",
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with gold labels, one per order."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return render_notes(spread(orders), "o_orderkey", "o_custkey", "o_orderdate")


def raw_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(spark, sf_dir).select("note_id", "text")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(spark, sf_dir).select("note_id", *FACT_COLUMNS)


def deidentified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deidentify(raw_notes(spark, sf_dir))


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(deidentified(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied documents as notes."""
    return table(spark, sf_dir, "documents", F.col("doc_id").alias("note_id"), "text")


def given_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All supplied texts as notes: documents, turns of conversations, and pages as they are."""
    def named(name: str, key: Column, text: str) -> DataFrame:
        return table(spark, sf_dir, name, key.alias("note_id"), F.col(text).alias("text"))

    return (
        named("documents", F.concat(F.lit("d"), "doc_id"), "text")
        .unionByName(named("conversations", F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn"), "text"))
        .unionByName(named("pages", F.concat(F.lit("p"), "page_id"), "html")))


def note_key(note_id: Column) -> Column:
    return F.substring(note_id, len("NOTE-") + 1, 20).cast("bigint")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses to all notes."""
    return responses_to(gold(spark, sf_dir))


def responses_to(labels: DataFrame) -> DataFrame:
    """A response table as it would come back from a model, some of it broken.

    An answer arrives as two text blocks with another kind of block between them.
    """
    key = note_key(F.col("note_id"))
    keyed = labels.withColumn("_key", key).withColumn(
        "_kind", pick("_key", "response", RESPONSE_KINDS)).where("_kind <> 'no_response'")
    is_kind = {k: F.col("_kind") == k for k in RESPONSE_KINDS}

    def quoted(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))

    def diagnosis(c: Column) -> Column:
        # outer blanks and a line end, escaped as JSON wants it
        return F.when(is_kind["odd_text"], F.concat(F.lit('"  '), c, F.lit('\\nsecond line  "'))).otherwise(cased(c))

    def cased(c: Column) -> Column:
        return quoted(F.when(is_kind["upper_case"], F.upper(c)).otherwise(c))

    tnm = F.col("tnm_stage")
    stage = F.when(is_kind["bad_domain"], "IIIC").otherwise(tnm["overall_stage"])
    site = F.when(is_kind["bad_domain"], "").otherwise(F.col("primary_site"))
    ecog = F.col("ecog_performance_status").cast("string")
    markers = F.array_join(F.transform("biomarkers", lambda m: F.concat(
        F.lit('{"name": '), quoted(m["name"]), F.lit(', "status": '), quoted(m["status"]),
        F.when(is_kind["extra_members"], F.lit(', "method": "IHC"')).otherwise(""),
        F.lit("}"))), ", ")
    plain = F.when(F.size("biomarkers") > 0, ', "PTEN"').otherwise('"PTEN"')
    markers = F.concat(markers, F.when(is_kind["plain_member"], plain).otherwise(""))
    optional = F.when(is_kind["keys_left_out"], "").otherwise(F.concat(
        F.lit(', "histology": '), cased(F.col("histology")),
        F.lit(', "biomarkers": ['), markers, F.lit("]")))
    body = F.concat(
        F.lit('{"primary_diagnosis": '), diagnosis(F.col("primary_diagnosis")),
        F.lit(', "primary_site": '), cased(site),
        F.lit(', "tnm_stage": '), F.when(is_kind["null_stage"], F.lit("null")).otherwise(F.concat(
            F.lit('{"t": '), quoted(tnm["t"]), F.lit(', "n": '), quoted(tnm["n"]),
            F.lit(', "m": '), quoted(tnm["m"]), F.lit(', "overall_stage": '), quoted(stage),
            F.lit("}"))), optional,
        F.lit(', "medications": ['),
        F.array_join(F.transform("medications", quoted), ", "),
        F.lit('], "ecog_performance_status": '),
        F.when(is_kind["ecog_text"], quoted(ecog)).otherwise(F.coalesce(ecog, F.lit("null"))),
        F.lit("}"),
    )
    with_body = keyed.withColumn("_body", body)
    b = F.col("_body")
    answer = (
        F.when(is_kind["fenced"], F.concat(F.lit("```\n"), b, F.lit("\n```")))
        .when(is_kind["fenced_json"], F.concat(F.lit("\n```json\n"), b, F.lit("\n```\n")))
        .when(is_kind["prose"], F.lit("The note could not be read."))
        .when(is_kind["tail"], F.concat(b, F.lit("\n\nAsk if more is needed.")))
        .when(is_kind["array"], F.concat(F.lit("["), b, F.lit("]")))
        .when(is_kind["two_objects"], F.concat(b, F.lit(" "), b))
        .otherwise(b)
    )

    def block(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    answered = with_body.withColumn("_answer", answer)
    a = F.col("_answer")
    cut = F.floor(F.length(a) / 2).cast("int")
    return answered.select(
        "note_id",
        F.array(
            block("text", F.substring(a, F.lit(1), cut)),
            block("thinking", F.lit("not part of the answer")),
            block("text", F.substring(a, cut + 1, F.length(a))),
        ).alias("content"),
        F.expr(f"400 + {draw('_key', 'tokens_in')} % 800").alias("input_tokens"),
        F.expr(f"60 + {draw('_key', 'tokens_out')} % 200").alias("output_tokens"),
    )


def responded_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per note from the response table, missing answers included."""
    return model_predictions(raw_notes(spark, sf_dir), responses(spark, sf_dir))
