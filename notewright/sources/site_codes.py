"""The registry codes of tumor sites, a small dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notewright import fixed_values as fv
from notewright.schemas import SITE_CODE


def default_site_codes(spark: SparkSession) -> DataFrame:
    """The five built-in codes, as a literal table that needs no job to read."""
    rows = ", ".join("('" + "', '".join(row) + "')" for row in fv.SITE_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes({', '.join(SITE_CODE.fieldNames())})")


def read_site_codes(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; a comma inside a label is quoted."""
    return (spark.read.schema(SITE_CODE).option("escape", '"').option("mode", "FAILFAST")
            .csv(path, header=True))


def write_site_codes(codes: DataFrame, path: str) -> None:
    codes.write.option("escape", '"').csv(path, header=True)
