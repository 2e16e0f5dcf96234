"""Incremental landing: note files that arrived since the last run are redacted, extracted
and appended, each exactly once, as they are or behind the gate.

Redaction, extraction and the landing projection are row-local, so the batch operators run on
a stream unchanged and keep no state. Progress lies in a checkpoint folder; give it, like the
landing path, in storage that every executor reaches. The landing path belongs to the stream,
whose log says which files count; read it next to a batch-landed one with ``read_landing``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright import fixed_values as fv
from notewright.operators.deidentify import DEFAULT_RULES, Rule, deidentify
from notewright.operators.extract import Extractor, extract, rule_facts
from notewright.operators.landing import landing_rows, landing_text
from notewright.operators.quality import GateFailure
from notewright.plans.batch import committed_runs, run_batch
from notewright.schemas import LANDING, NOTE


def _new_notes(spark: SparkSession, incoming: str, files_per_step: int) -> DataFrame:
    """A stream of the notes in files not read before."""
    lines = (spark.readStream.schema(NOTE).option("mode", "FAILFAST")
             .option("maxFilesPerTrigger", files_per_step).json(incoming))
    return lines.select(*[
        F.coalesce(F.col(c), F.raise_error(F.lit(f"a record has no {c}"))).alias(c)
        for c in NOTE.fieldNames()
    ])


def land_new_notes(
    spark: SparkSession, incoming: str, landing_path: str, progress: str, run_id: str,
    loaded_at: datetime | None = None, extractor: Extractor = rule_facts,
    method: str = fv.METHOD_RULES, files_per_step: int = 1000,
) -> None:
    """Land every note file not landed before, then stop."""
    notes = _new_notes(spark, incoming, files_per_step)
    predictions = extract(deidentify(notes), extractor, method)
    rows = landing_rows(landing_text(predictions, run_id), loaded_at)
    stream = (rows.select(*LANDING.fieldNames()).writeStream.format("parquet")
              .partitionBy("run_id").option("path", landing_path)
              .option("checkpointLocation", progress).trigger(availableNow=True).start())
    stream.awaitTermination()


def land_checked_notes(
    spark: SparkSession, incoming: str, folder: str, codes: DataFrame, progress: str, run_id: str,
    loaded_at: datetime | None = None, rules: Sequence[Rule] = DEFAULT_RULES, extractor: Extractor = rule_facts,
    files_per_step: int = 1000,
) -> None:
    """Put every note file not landed before through the gate, land it and add it to the marts, then stop.

    Each micro-batch is a batch of its own (:func:`notewright.plans.batch.run_batch`) below folder,
    under the run id and its own number. One that fails its gate stops the stream with
    :class:`GateFailure`: nothing of it lands, what came before it stays, and its files are the next
    to be tried. A micro-batch that is replayed, because the stream was lost before it noted it,
    goes on where it stood, or is left alone if it was through.
    """
    failed: list[GateFailure] = []

    def step(notes: DataFrame, number: int) -> None:
        own = f"{run_id}-{number:06d}"
        if own in committed_runs(spark, folder):
            return
        try:
            run_batch(notes, folder, own, codes, rules=rules, extractor=extractor, loaded_at=loaded_at)
        except GateFailure as failure:
            failed.append(failure)
            raise

    stream = (_new_notes(spark, incoming, files_per_step).writeStream.foreachBatch(step)
              .option("checkpointLocation", progress).trigger(availableNow=True).start())
    try:
        stream.awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise
