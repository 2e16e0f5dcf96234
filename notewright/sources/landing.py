"""The landing table: predictions as they came, appended under a run id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from notewright.schemas import LANDING, LANDING_TEXT
from notewright.sources.commits import partition_path


def append_landing(rows: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Append landed rows, one folder per run. No shuffle: each task writes its own rows.

    Files appear on commit only, so a lost executor leaves neither gaps nor duplicates.
    """
    (rows.select(*LANDING.fieldNames()).write.mode("append").partitionBy("run_id")
     .option("maxRecordsPerFile", rows_per_file).parquet(path))


def read_landing(spark: SparkSession, *paths: str, run_id: str | None = None) -> DataFrame:
    """All landed rows, or one run's; the run id prunes folders, other runs are not read."""
    columns = LANDING.fieldNames()
    tables = [spark.read.schema(LANDING).parquet(path).select(*columns) for path in paths]
    landed = reduce(DataFrame.unionByName, tables)
    return landed if run_id is None else landed.where(landed["run_id"] == run_id)


def land_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Land the rows of one run in place of whatever a lost attempt of that run left there.

    A run without rows gets its folder as well.
    """
    columns = [c for c in LANDING.fieldNames() if c != "run_id"]
    rows.select(*columns).write.mode("overwrite").parquet(partition_path(rows.sparkSession, path, run_id))


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """One run's landed rows; folders of other runs are not even listed."""
    return (spark.read.schema(LANDING).option("basePath", path).parquet(partition_path(spark, path, run_id))
            .select(*LANDING.fieldNames()))


_CSV = {
    "escape": '"', "emptyValue": "", "header": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


CSV_ROWS = 100_000  # of a file


def write_landing_csv(rows: DataFrame, path: str, rows_per_file: int = CSV_ROWS) -> None:
    """The landing columns as CSV with a header, nested values as JSON text.

    A file that holds line ends inside values can't be split when it is read, so files are kept to
    rows_per_file rows each: reading back has a task for every one of them, however large the table.
    Quotes are doubled inside quoted values; outer blanks and line ends inside a value stay. An
    empty batch gives no data rows. An empty text is written like null, and comes back as null.
    """
    (rows.select(*LANDING_TEXT.fieldNames()).write.options(**_CSV)
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def read_landing_csv(spark: SparkSession, path: str) -> DataFrame:
    """What write_landing_csv wrote. A value may span lines, so a file is read by one task."""
    return spark.read.schema(LANDING_TEXT).options(**_CSV, multiLine="true").csv(path)
