"""Quality gate: a batch is stopped when its predictions or notes break a contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright import fixed_values as fv
from notewright.functions.ratios import ratio
from notewright.functions.text import may_match, spark_regex

SAMPLE_SIZE = 3
SITE_FILL, STAGE_DOMAIN, LEAKS, NO_KEY = (
    "site_fill_rate", "invalid_stage", "residual_identifiers", "missing_note_id",
)


class GateFailure(Exception):
    """The batch failed its quality gate; ``failures`` lists why."""

    def __init__(self, failures: list[str]):
        super().__init__("; ".join(failures))
        self.failures = failures


def leaks_identifier(text: Column, patterns=fv.LEAK_PATTERNS) -> Column:
    """Whether a note still holds text that looks like an identifier."""
    result = F.lit(False)
    for pattern, ignore_case, literal in patterns:
        found = F.when(
            may_match(text, None, literal, ignore_case),
            text.rlike(spark_regex(pattern, ignore_case)),
        ).otherwise(False)
        result = result | found
    return result


def _as_text(predictions: DataFrame, column: str, part: str = "") -> Column:
    """A fact, or a part of it, as text, whether it is typed or came whole from a model."""
    if isinstance(predictions.schema[column].dataType, T.VariantType):
        return F.try_variant_get(column, "$" + part, "string")
    return F.col(column + part)


def _bad_stage(predictions: DataFrame, valid_stages: Sequence[str]) -> Column:
    stage = _as_text(predictions, "tnm_stage", ".overall_stage")
    return F.coalesce(~stage.isin(list(valid_stages)), F.lit(False))


def prediction_measures(predictions: DataFrame, valid_stages: Sequence[str] = fv.VALID_STAGES) -> dict[str, Column]:
    """Aggregates over predictions that the gate needs, for an aggregate or an observation."""
    site = _as_text(predictions, "primary_site")
    return {
        "rows": F.count(F.lit(1)),
        "filled": F.count_if(F.coalesce(site != "", F.lit(False))),
        "bad_stage": F.count_if(_bad_stage(predictions, valid_stages)),
        "no_key": F.count_if(F.col("note_id").isNull()),
    }


def note_measures() -> dict[str, Column]:
    """Aggregates over redacted notes that the gate needs."""
    return {"leaks": F.count_if(leaks_identifier(F.col("text")))}


def stage_offenders(predictions: DataFrame, valid_stages: Sequence[str] = fv.VALID_STAGES) -> DataFrame:
    """One row: the first offenders by id, joined by commas. A distributed top-k."""
    return (
        predictions.where(_bad_stage(predictions, valid_stages)).select("note_id").orderBy("note_id").limit(SAMPLE_SIZE)
        .agg(F.array_join(F.sort_array(F.collect_list("note_id")), ",").alias("sample")))


def measured_verdict(
    measures: dict[str, int], predictions: DataFrame, min_fill: float = fv.MIN_SITE_FILL_RATE,
    valid_stages: Sequence[str] = fv.VALID_STAGES,
) -> list[Row]:
    """The rows of :func:`gate_verdict` from measures that were observed while tables were written.

    Predictions are read only to name offenders, when there are any.
    """
    fill = measures["filled"] / measures["rows"] if measures["rows"] else 0.0
    bad = measures["bad_stage"]
    sample = stage_offenders(predictions, valid_stages).first()["sample"] if bad else ""

    def row(check: str, value: float, threshold: float, passed: bool, sample: str = "") -> Row:
        return Row(check=check, value=float(value), threshold=float(threshold), passed=passed, sample=sample)

    return [
        row(SITE_FILL, fill, min_fill, fill >= min_fill), row(STAGE_DOMAIN, bad, 0, bad == 0, sample),
        row(NO_KEY, measures["no_key"], 0, measures["no_key"] == 0),
        row(LEAKS, measures["leaks"], 0, measures["leaks"] == 0),
    ]


def gate_verdict(
    predictions: DataFrame,
    notes: DataFrame,
    min_fill: float = fv.MIN_SITE_FILL_RATE,
    valid_stages: Sequence[str] = fv.VALID_STAGES,
) -> DataFrame:
    """One row per check: ``check, value, threshold, passed, sample``.

    An empty site counts as unfilled. A stage may be null or one of the valid ones; the
    sample names the first three offenders by id. One aggregate runs over the predictions
    and one over the notes; the sample, a distributed top-3, reads the predictions' ids and stages
    again. Give it tables that were written, as :func:`notewright.plans.batch.run_batch` does, or
    redaction and extraction run once for each of the three.
    """
    m = prediction_measures(predictions, valid_stages)
    over_predictions = predictions.agg(
        ratio(m["filled"], m["rows"]).alias("fill"), m["bad_stage"].alias("bad_stage"), m["no_key"].alias("no_key"),
    ).select(F.inline(F.array(
        _measured(SITE_FILL, F.col("fill"), min_fill, F.col("fill") >= min_fill),
        _measured(STAGE_DOMAIN, F.col("bad_stage"), 0, F.col("bad_stage") == 0),
        _measured(NO_KEY, F.col("no_key"), 0, F.col("no_key") == 0),
    )))
    over_notes = notes.agg(note_measures()["leaks"].alias("leaks")).select(
        F.inline(F.array(_measured(LEAKS, F.col("leaks"), 0, F.col("leaks") == 0))))
    offenders = stage_offenders(predictions, valid_stages).select(F.lit(STAGE_DOMAIN).alias("check"), "sample")
    measures = over_predictions.unionByName(over_notes).unionByName(
        offenders, allowMissingColumns=True)
    return measures.groupBy("check").agg(
        F.max("value").alias("value"), F.max("threshold").alias("threshold"),
        F.bool_and("passed").alias("passed"),
        F.coalesce(F.max("sample"), F.lit("")).alias("sample"),
    )


def enforce_gate(verdict: DataFrame) -> None:
    """Raise :class:`GateFailure` if a check did not pass. Collects the few verdict rows."""
    enforce_rows(verdict.collect())


def enforce_rows(rows: Sequence[Row]) -> None:
    """Raise :class:`GateFailure` if one of the verdict's rows did not pass."""
    failures = [_message(row) for row in sorted(rows, key=lambda r: r["check"]) if not row["passed"]]
    if failures:
        raise GateFailure(failures)


def _measured(check: str, value: Column, threshold: float, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        passed.alias("passed"),
        F.lit("").alias("sample"),
    )


def _message(row) -> str:
    count = int(row["value"])
    return {
        SITE_FILL: f"site fill rate {row['value']:.3f} below threshold {row['threshold']}",
        STAGE_DOMAIN: f"{count} rows with an invalid overall_stage, such as {row['sample']}",
        LEAKS: f"{count} de-identified notes still hold text that looks like an identifier",
        NO_KEY: f"{count} rows without a note_id",
    }[row["check"]]
