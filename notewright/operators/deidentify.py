"""De-identification: ordered redaction rules, each applied to the previous rule's output."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright import fixed_values as fv
from notewright.functions.once import settled
from notewright.functions.ratios import ratio
from notewright.functions.text import may_match, quote_replacement, spark_regex


@dataclass(frozen=True)
class Rule:
    """One redaction rule.

    ``literal`` is a text every match contains; with it, notes that cannot match are passed
    over by a byte search. Leave it out if there is none.
    """

    label: str
    pattern: str
    ignore_case: bool = False
    literal: str | None = None


DEFAULT_RULES = tuple(Rule(*rule) for rule in fv.REDACTION_RULES)


def redact(
    notes: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    token: str = fv.REDACTION_TOKEN,
    text: str = "text",
    counted: bool = True,
) -> DataFrame:
    """Replace what the rules match, and count the replacements.

    Adds ``rule_redactions`` (one count per rule, in rule order) and ``redactions`` (their
    sum), unless ``counted`` is false.

    Counting by a second scan for the pattern would double the work. Matches are replaced by a
    mark first and the mark by the token, so the growth in bytes gives their number. A text
    that holds the mark already is replaced directly and counted by the pattern. The plan
    grows by the same step for each rule.
    """
    kept = notes.columns
    quoted, mark = quote_replacement(token), _mark_for(token)
    growth = len(token.encode()) - len(mark.encode())
    column, plain = F.col(text), F.col("_plain")
    if counted:
        notes = notes.withColumn("_plain", ~column.contains(mark))
    for i, rule in enumerate(rules):
        pattern = F.lit(spark_regex(rule.pattern, rule.ignore_case))
        candidate = may_match(column, None, rule.literal, rule.ignore_case)
        if not counted:
            replaced = F.regexp_replace(column, pattern, F.lit(quoted))
            notes = notes.withColumn(text, F.when(candidate, replaced).otherwise(column))
            continue
        stand_in = F.when(plain, mark).otherwise(quoted)
        notes = notes.withColumns({
            "_marked": F.when(candidate, F.regexp_replace(column, pattern, stand_in))
            .otherwise(column),
            "_counted": F.when(candidate & ~plain, F.regexp_count(column, pattern)).otherwise(0),
        })
        marked = F.col("_marked")
        # only what a match has changed holds marks
        swapped = F.when(plain & (marked != column), F.replace(marked, F.lit(mark), F.lit(token))).otherwise(marked)
        grown = (F.octet_length(swapped) - F.octet_length(marked)) / growth
        notes = notes.withColumns({
            text: swapped,
            f"_rule_{i}": F.when(plain, grown.cast("int")).otherwise(F.col("_counted")),
        })
    if not counted:
        return settled(notes.select(*kept), text)
    counts = [f"_rule_{i}" for i in range(len(rules))]
    with_counts = notes.select(
        *kept, F.array(*counts).cast("array<int>").alias("rule_redactions"),
        sum((F.col(c) for c in counts), F.lit(0)).alias("redactions"))
    return settled(with_counts, text, "rule_redactions", "redactions")


def _mark_for(token: str) -> str:
    """A character that texts hardly hold, is not in the token and differs from it in length. One of a
    byte comes first: with a wider one the JVM keeps, searches and writes a text in two bytes a character."""
    return next(m for m in ("\x01", "\ue000", "\U000f0000")
                if m not in token and len(m.encode()) != len(token.encode()))


def deidentify(notes: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES,
               token: str = fv.REDACTION_TOKEN) -> DataFrame:
    """Notes fit to go on: ``note_id`` and redacted ``text``; the raw text is dropped."""
    return redact(notes.select("note_id", "text"), rules, token, counted=False)


def redaction_stats(redacted: DataFrame) -> DataFrame:
    """Notes, redactions and redactions per note of a batch, in one aggregate."""
    return redacted.agg(
        F.count(F.lit(1)).alias("notes"),
        F.coalesce(F.sum("redactions"), F.lit(0)).alias("redactions"),
    ).withColumn("redactions_per_note", ratio(F.col("redactions"), F.col("notes")))
