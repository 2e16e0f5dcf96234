"""One batch from raw notes to marts, stopped by the gate before anything lands, and resumable."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.functions.ratios import ratio
from notewright.operators import landing, marts, quality
from notewright.operators.deidentify import DEFAULT_RULES, Rule, redact
from notewright.operators.extract import Extractor, extract, rule_facts
from notewright.operators.responses import model_predictions
from notewright.schemas import LANDING
from notewright.sources import commits
from notewright.sources import landing as landing_table

FCT, DIM = "fct_diagnoses", "dim_biomarkers"


def run_batch(
    notes: DataFrame, folder: str, run_id: str, codes: DataFrame,
    responses: DataFrame | None = None, order: str | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES, extractor: Extractor = rule_facts,
    loaded_at: datetime | None = None,
) -> None:
    """Redact, extract or take a model's responses, check, land, and add the run to the marts.

    Below folder: ``work/<run_id>/`` holds the batch's redacted notes and predictions; ``landing`` and
    each of ``marts`` keep the run as a partition of its own, made from the run's rows only; ``journal``
    has the steps that are done, ``versions`` the runs that readers see (:func:`read_mart`). The
    measures of the gate are observed while notes and predictions are written.

    A run that was lost on its way goes on after its last finished step when it is called again with
    the same notes; what a lost step left is replaced. Readers see the run in all marts or in none.
    A failed gate raises :class:`GateFailure`, leaves landing and marts as they were, and lets the
    run begin anew. A run that was landed before raises and changes nothing.
    """
    spark = notes.sparkSession
    run, work, landed_at = commits.Run(spark, folder, run_id), f"{folder}/work/{run_id}", f"{folder}/landing"
    begun = run.found("begun") is not None
    if run_id in committed_runs(spark, folder) or (
            not begun and commits.exists(spark, commits.partition_path(spark, landed_at, run_id))):
        raise ValueError(f"run {run_id} was landed before")
    run.once("begun", dict)

    def write_notes() -> dict:
        redacted = redact(notes.select("note_id", "text"), rules)
        return _written(redacted, f"{work}/notes", ["note_id", "text"], {
            "notes": F.count(F.lit(1)), "redactions": F.coalesce(F.sum("redactions"), F.lit(0)),
            **quality.note_measures()})

    def write_predictions() -> dict:
        clean = spark.read.parquet(f"{work}/notes")
        predictions = (extract(clean, extractor) if responses is None
                       else model_predictions(clean, responses, order=order))
        return _written(predictions, f"{work}/predictions", predictions.columns, quality.prediction_measures(predictions))

    measures = run.once("notes", write_notes) | run.once("predictions", write_predictions)
    predictions = spark.read.parquet(f"{work}/predictions")
    try:
        quality.enforce_rows(quality.measured_verdict(measures, predictions))
    except quality.GateFailure:
        run.forget()
        raise

    def land() -> dict:
        rows = landing.landing_rows(landing.landing_text(predictions, run_id), loaded_at)
        landing_table.land_run(rows, landed_at, run_id)
        return {}

    run.once("landed", land)
    made = {name: run.once(name, lambda name=name: _write_mart(spark, folder, name, run_id, codes)) for name in (FCT, DIM)}
    commits.commit(spark, folder, {
        "run": run_id, "notes": measures["notes"], "redactions": measures["redactions"], "marts": made})


def _written(df: DataFrame, path: str, columns: Sequence[str], measures: dict[str, Column]) -> dict:
    """Write some columns of df as a table, and return aggregates over df observed on the way."""
    seen = Observation()
    (df.observe(seen, *[c.alias(name) for name, c in measures.items()]).select(*columns)
     .write.mode("overwrite").parquet(path))
    return dict(seen.get)


def _write_mart(spark: SparkSession, folder: str, name: str, run_id: str, codes: DataFrame) -> dict:
    """Make one run's part of a mart from the run's own landed rows."""
    staged = marts.staging(landing_table.read_run(spark, f"{folder}/landing", run_id))
    mart = marts.fct_diagnoses(staged, codes) if name == FCT else marts.dim_biomarkers(staged)
    stored = [c for c in mart.columns if c != "run_id"]  # which the folder's name says
    path = commits.partition_path(spark, f"{folder}/marts/{name}", run_id)
    return _written(mart, path, stored, {"rows": F.count(F.lit(1))}) | {"schema": mart.schema.json()}


def committed_runs(spark: SparkSession, folder: str) -> list[str]:
    """The runs that readers of the marts see, in the order they were committed."""
    return [run["run"] for run in commits.version(spark, folder)[1]]


def read_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart as of the newest version: all rows of all its runs, none of a run on its way.

    Only folders of these runs are listed. The version is looked up now; a later one needs another
    call. A folder without a version raises.
    """
    _, runs = commits.version(spark, folder)
    if not runs:
        raise ValueError(f"no run has been committed to {folder}")
    schema = T.StructType.fromJson(json.loads(runs[-1]["marts"][name]["schema"]))
    path = f"{folder}/marts/{name}"
    folders = [commits.partition_path(spark, path, run["run"]) for run in runs]
    stored = schema if "run_id" in schema.names else T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*schema.names)


def redaction_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Notes, redactions and redactions per note of every committed run, as observed when it was written."""
    _, runs = commits.version(spark, folder)
    rows = [(run["run"], run["notes"], run["redactions"]) for run in runs]
    return spark.createDataFrame(rows, "run_id string, notes long, redactions long").withColumn(
        "redactions_per_note", ratio(F.col("redactions"), F.col("notes")))
