"""Rule extraction: de-identified text in, facts out.

An extractor is any function from notes (``note_id, text``) to ``note_id`` and the facts
columns. :func:`rule_facts` is the one built here; its keyword groups, word lists and patterns
are parameters. :func:`arrow_extractor` makes one from a function over Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from notewright import fixed_values as fv
from notewright.functions.once import settled
from notewright.functions.text import (
    folded, may_match, null_if_empty, spark_regex, without_nulls,
)
from notewright.schemas import BIOMARKER, FACT_COLUMNS, GOLD

Extractor = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Pattern:
    """A pattern and a text that every match contains, by which other notes are passed over."""

    text: str
    literal: str | None = None


@dataclass(frozen=True)
class ExtractionRules:
    """What the rules look for. A pattern given as plain text has no literal."""

    keyword_groups: tuple = fv.KEYWORD_GROUPS
    biomarkers: tuple[str, ...] = fv.BIOMARKER_NAMES
    biomarker_status: str = fv.BIOMARKER_STATUS
    medications: tuple[str, ...] = fv.MEDICATIONS
    t: str | Pattern = fv.T_PATTERN
    n: str | Pattern = fv.N_PATTERN
    m: str | Pattern = fv.M_PATTERN
    stage: str | Pattern = Pattern(fv.STAGE_PATTERN, "stage")
    ecog: str | Pattern = Pattern(fv.ECOG_PATTERN, "ECOG")


DEFAULT_RULES = ExtractionRules()


def classify(lowered: Column, groups) -> Column:
    """Diagnosis, site and histology of the first keyword group with a hit; else null."""
    result = None
    for keywords, diagnosis, site, histology in groups:
        hit = _any(lowered.contains(k) for k in keywords)
        facts = F.struct(
            F.lit(diagnosis).alias("primary_diagnosis"),
            F.lit(site).alias("primary_site"),
            F.lit(histology).alias("histology"),
        )
        result = F.when(hit, facts) if result is None else result.when(hit, facts)
    return result


def listed_terms(lowered: Column, terms) -> Column:
    """The terms whose lower-case form occurs in the text, sorted by code point."""
    return without_nulls(F.array(*[
        F.when(lowered.contains(term.lower()), F.lit(term)) for term in sorted(set(terms))
    ]), "string")


def rule_facts(notes: DataFrame, rules: ExtractionRules = DEFAULT_RULES,
               fields: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """The wanted facts of each note by rules. Narrow: one pass over the text, no shuffle.

    The raw extracts are settled: each regular expression runs once per note, though its result
    is tested and used, and a filter on the notes' own columns still reaches their scan. Settled
    columns are computed whether they are read or not, so leave out of fields what is not wanted.
    """
    text, folded_text = F.col("text"), F.col("_folded")

    def first_group(pattern: str | Pattern, ignore_case: bool = False) -> Column:
        pattern = pattern if isinstance(pattern, Pattern) else Pattern(pattern)
        found = F.regexp_extract(text, spark_regex(pattern.text, ignore_case), 1)
        may = may_match(text, folded_text, pattern.literal, ignore_case)
        return F.when(may, found).otherwise("")

    read = notes.select("note_id", "text").withColumns({
        "_lowered": F.lower(text),
        "_folded": folded(text),
    })
    raw: dict[str, Column] = {}
    if {"primary_diagnosis", "primary_site", "histology"} & set(fields):
        raw["_class"] = classify(F.col("_lowered"), rules.keyword_groups)
    if "medications" in fields:
        raw["_medications"] = listed_terms(F.col("_lowered"), rules.medications)
    if "tnm_stage" in fields:
        raw |= {"_t": first_group(rules.t), "_n": first_group(rules.n), "_m": first_group(rules.m),
                "_stage": first_group(rules.stage, True)}
    if "ecog_performance_status" in fields:
        raw["_ecog"] = first_group(rules.ecog, True)
    if "biomarkers" in fields:
        for i, name in enumerate(rules.biomarkers):
            raw[f"_marker_{i}"] = first_group(
                Pattern(re.escape(name) + rules.biomarker_status, name), True)
    extracted = settled(
        read.select("note_id", *[c.alias(name) for name, c in raw.items()]), *raw)

    def markers() -> Column:
        return without_nulls(F.array(*[
            # a status of dots alone is still a hit, with an empty status
            F.when(F.col(f"_marker_{i}") != "", F.struct(
                F.lit(name).alias("name"),
                F.rtrim(F.col(f"_marker_{i}"), F.lit(".")).alias("status"),
            ))
            for i, name in enumerate(rules.biomarkers)
        ]), BIOMARKER.simpleString())

    def category(letter: str, column: str) -> Column:
        return F.when(F.col(column) != "", F.concat(F.lit(letter), F.col(column)))

    facts = {
        "primary_diagnosis": lambda: F.col("_class.primary_diagnosis"),
        "primary_site": lambda: F.col("_class.primary_site"),
        "histology": lambda: F.col("_class.histology"),
        "tnm_stage": lambda: F.struct(
            category("T", "_t").alias("t"), category("N", "_n").alias("n"),
            category("M", "_m").alias("m"),
            F.upper(null_if_empty(F.col("_stage"))).alias("overall_stage")),
        "biomarkers": markers,
        "medications": lambda: F.col("_medications"),
        "ecog_performance_status": lambda: null_if_empty(F.col("_ecog")).cast("int"),
    }
    return extracted.select(
        "note_id", *[build().alias(name) for name, build in facts.items() if name in fields])


def extract(notes: DataFrame, extractor: Extractor = rule_facts,
            method: str = fv.METHOD_RULES) -> DataFrame:
    """Predictions: ``note_id``, the ``method`` tag and the facts of an extractor."""
    facts = extractor(notes)
    return facts.select("note_id", F.lit(method).alias("method"),
                        *[c for c in FACT_COLUMNS if c in facts.columns])


def arrow_extractor(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], fields: Sequence[str] = FACT_COLUMNS, rows: int = 512,
    characters: int = 4 << 20,
) -> Extractor:
    """An extractor from a function over Arrow batches, for a model or a table that runs in tasks.

    work gets batches of ``note_id, text`` of at most ``rows`` notes and, unless a single note is
    longer, ``characters`` bytes of text. It returns note_id and all of ``fields``, in any order,
    one row for each note it got. Columns are cast to the type of the facts. A batch with other
    columns, a column that can't be cast, or notes that are missing, doubled or made up fails the
    job: a plug-in can't lose notes or invent them. No shuffle; the function is sent to the tasks.
    """
    unknown = sorted(set(fields) - set(FACT_COLUMNS))
    if unknown:
        raise ValueError(f"no facts: {', '.join(unknown)}")
    schema = T.StructType([GOLD["note_id"], *[GOLD[name] for name in FACT_COLUMNS if name in fields]])
    wanted = to_arrow_schema(schema)

    def checked(given: pa.RecordBatch) -> pa.RecordBatch:
        found = work(given)
        if sorted(found.schema.names) != sorted(wanted.names):
            raise ValueError(f"an extractor returned {found.schema.names} instead of {wanted.names}")
        if sorted(found.column("note_id").to_pylist(), key=str) != sorted(given.column("note_id").to_pylist(), key=str):
            raise ValueError("an extractor did not return one row for each note")
        columns = []
        for field in wanted:
            try:
                columns.append(found.column(field.name).cast(field.type))
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as wrong:
                raise ValueError(f"an extractor returned {field.name} as {found.column(field.name).type}: {wrong}") from None
        return pa.RecordBatch.from_arrays(columns, schema=wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held = 0, 0
            for at, text in enumerate(batch.column("text")):
                size = len(text.as_py() or "")
                if at > start and (at - start >= rows or held + size > characters):
                    yield checked(batch.slice(start, at - start))
                    start, held = at, 0
                held += size
            if batch.num_rows > start:
                yield checked(batch.slice(start))

    return lambda notes: notes.select("note_id", "text").mapInArrow(run, schema)


def _any(conditions) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return result
