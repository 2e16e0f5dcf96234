"""Row types of notes, facts and landed extractions, and the JSON contract sent to a model."""

from __future__ import annotations

import json

from pyspark.sql import types as T

NOTE = T.StructType([
    T.StructField("note_id", T.StringType(), False),
    T.StructField("text", T.StringType(), False),
])

TNM = T.StructType([T.StructField(c, T.StringType()) for c in ("t", "n", "m", "overall_stage")])

BIOMARKER = T.StructType([T.StructField(c, T.StringType()) for c in ("name", "status")])

FACTS = T.StructType([
    T.StructField("primary_diagnosis", T.StringType()),
    T.StructField("primary_site", T.StringType()),
    T.StructField("histology", T.StringType()),
    T.StructField("tnm_stage", TNM),
    T.StructField("biomarkers", T.ArrayType(BIOMARKER)),
    T.StructField("medications", T.ArrayType(T.StringType())),
    T.StructField("ecog_performance_status", T.IntegerType()),
])

FACT_COLUMNS = FACTS.fieldNames()

GOLD = T.StructType([T.StructField("note_id", T.StringType()), *FACTS.fields])

PREDICTION = T.StructType([
    T.StructField("note_id", T.StringType()),
    T.StructField("method", T.StringType()),
    *FACTS.fields,
])

# what a model answered, as it came: any fact may be of any JSON type
MODEL_PREDICTION = T.StructType([
    *PREDICTION.fields[:2],
    *[T.StructField(f.name, T.VariantType()) for f in FACTS.fields],
])

SITE_CODE = T.StructType([
    T.StructField(c, T.StringType()) for c in ("primary_site", "icdo3_code", "icdo3_label")
])

LANDING = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("note_id", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("primary_diagnosis", T.StringType()),
    T.StructField("primary_site", T.StringType()),
    T.StructField("histology", T.StringType()),
    T.StructField("tnm_stage", T.VariantType()),
    T.StructField("biomarkers", T.VariantType()),
    T.StructField("medications", T.VariantType()),
    T.StructField("ecog_performance_status", T.IntegerType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

# the landed columns before the load time is stamped, nested values still as JSON text
LANDING_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VariantType) else f.dataType)
    for f in LANDING.fields if f.name != "loaded_at"
])

_WHAT_IT_HOLDS = {
    "primary_diagnosis": "Cancer diagnosis the note is about.",
    "primary_site": "Organ in which the primary tumor arose, such as breast, lung or colon.",
    "histology": "Microscopic type of the tumor, if the note states it.",
    "tnm_stage": "T, N and M categories and overall stage group; null where not stated.",
    "biomarkers": "Markers with their result, such as positive, mutated or 80%.",
    "medications": "Cancer drugs and regimens the note mentions.",
    "ecog_performance_status": "ECOG performance status, 0 to 5, if the note states it.",
}
_NEVER_NULL = ("primary_diagnosis", "primary_site")
_MAY_BE_ABSENT = ("histology", "ecog_performance_status")


def _json_type(data_type: T.DataType, nullable: bool) -> dict:
    if isinstance(data_type, T.StructType):
        return {
            "type": "object",
            "properties": {f.name: _json_type(f.dataType, nullable) for f in data_type.fields},
            "required": data_type.fieldNames(),
        }
    if isinstance(data_type, T.ArrayType):
        return {"type": "array", "items": _json_type(data_type.elementType, False)}
    name = "integer" if isinstance(data_type, T.IntegerType) else "string"
    return {"type": [name, "null"] if nullable else name}


def facts_json_schema() -> str:
    """The facts type as JSON-schema text, derived from the Spark type."""
    properties = {}
    for field in FACTS.fields:
        spec = _json_type(field.dataType, field.name not in _NEVER_NULL)
        properties[field.name] = {**spec, "description": _WHAT_IT_HOLDS[field.name]}
    required = [c for c in FACT_COLUMNS if c not in _MAY_BE_ABSENT]
    return json.dumps({"type": "object", "properties": properties, "required": required}, indent=2)
