"""Landing projection: predictions to the landing columns."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.schemas import LANDING_TEXT

NESTED = ("tnm_stage", "biomarkers", "medications")


def new_run_id(now: datetime | None = None) -> str:
    """``YYYYMMDDThhmmss-6hex`` in UTC; make one per load, on the driver."""
    now = now or datetime.now(timezone.utc)
    return f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"


def landing_text(predictions: DataFrame, run_id: str) -> DataFrame:
    """The landed columns with nested values as JSON text; an absent value is JSON null."""
    present = {f.name: f.dataType for f in predictions.schema.fields}

    def landed(field: T.StructField) -> Column:
        name = field.name
        if name == "run_id":
            return F.lit(run_id).alias(name)
        if name not in present:
            return F.lit("null" if name in NESTED else None).cast(field.dataType).alias(name)
        c = F.col(name)
        if name in NESTED:
            c = F.coalesce(F.to_json(c, {"ignoreNullFields": "false"}), F.lit("null"))
        elif isinstance(present[name], T.VariantType):
            c = F.try_variant_get(c, "$", field.dataType.simpleString())
        return c.cast(field.dataType).alias(name)

    return predictions.select(*[landed(f) for f in LANDING_TEXT.fields])


def landing_rows(landed: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Landing rows ready to append: JSON text parsed to VARIANT, load time stamped."""
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    return landed.withColumns({
        **{c: F.parse_json(F.col(c)) for c in NESTED},
        "loaded_at": stamp.cast("timestamp_ntz"),
    })
