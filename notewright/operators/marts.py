"""Staging and marts over the landing table, and the cohorts they are for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright import fixed_values as fv
from notewright.schemas import TNM

_CATEGORY = {"t": "t_category", "n": "n_category", "m": "m_category",
             "overall_stage": "overall_stage"}


def staging(landed: DataFrame) -> DataFrame:
    """The landed rows with the stage flattened to typed columns. Narrow, and lazy as a view."""
    return landed.select(
        "note_id", "run_id", "method", "primary_diagnosis", "primary_site", "histology",
        *[F.try_variant_get("tnm_stage", f"$.{part}", "string").alias(_CATEGORY[part])
          for part in TNM.fieldNames()],
        "ecog_performance_status", "biomarkers", "medications", "loaded_at",
    )


def stage_group(stage: Column) -> Column:
    result = None
    for stages, group in fv.STAGE_GROUPS:
        hit = stage.isin(list(stages))
        result = F.when(hit, group) if result is None else result.when(hit, group)
    return result.otherwise(fv.STAGE_GROUP_OTHER)


def with_site_codes(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Left join to the site codes, exact case; an unknown site gets a null code.

    Nothing is broadcast by a hint: a code table of known, small size is broadcast by Spark's own
    rule, by bytes; a larger one is joined by a shuffle, in which adaptive execution splits a site
    that holds a third of all rows. No job runs while the plan is built.
    """
    return rows.join(codes, "primary_site", "left")


def fct_diagnoses(staged: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per note and run: diagnosis, site with its code, stage and stage group."""
    return with_site_codes(staged, codes).select(
        "note_id", "run_id", "primary_site", "icdo3_code", "icdo3_label", "primary_diagnosis",
        "histology", "overall_stage", "t_category", "n_category", "m_category",
        "ecog_performance_status", stage_group(F.col("overall_stage")).alias("stage_group"),
        "method", "loaded_at",
    )


def dim_biomarkers(staged: DataFrame) -> DataFrame:
    """One row per note and biomarker; a note without biomarkers has none. No shuffle."""
    markers = staged.sparkSession.tvf.variant_explode(F.col("biomarkers").outer())
    return staged.select("note_id", "primary_site", "biomarkers").lateralJoin(markers).select(
        "note_id", "primary_site",
        F.try_variant_get("value", "$.name", "string").alias("biomarker_name"),
        F.try_variant_get("value", "$.status", "string").alias("biomarker_status"),
    )


def marker_cases(biomarkers: DataFrame, site: str, name: str, status: str) -> DataFrame:
    """The number of notes of a site with a biomarker of a status."""
    return biomarkers.where(
        (F.col("primary_site") == site) & (F.col("biomarker_name") == name)
        & (F.col("biomarker_status") == status)
    ).agg(F.count_distinct("note_id").alias("cases"))


def treated_cohort(fct: DataFrame, staged: DataFrame, site: str, stage_prefix: str, name: str,
                   status: str, medication: str) -> DataFrame:
    """Facts of notes of a site and stage, with a biomarker of a status, on a medication.

    All evidence for a row comes from its own run: markers and medications are read from staging,
    which knows the run, and joined on note and run. Each side is filtered to the cohort's own
    rows before the semi joins.
    """
    facts = fct.where((F.col("primary_site") == site)
                      & F.col("overall_stage").startswith(stage_prefix))
    own = staged.where(F.col("primary_site") == site)
    text = lambda m, part: F.try_variant_get(m, f"$.{part}", "string")
    markers = F.try_variant_get("biomarkers", "$", "array<variant>")
    marked = own.where(F.exists(
        markers, lambda m: (text(m, "name") == name) & (text(m, "status") == status)))
    on_drug = own.where(F.array_contains(
        F.try_variant_get("medications", "$", "array<string>"), medication))
    return (facts.join(marked, ["note_id", "run_id"], "left_semi")
            .join(on_drug, ["note_id", "run_id"], "left_semi"))
