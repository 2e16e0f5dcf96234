import re

import pytest
from pyspark.sql import functions as F

from notewright import fixed_values as fv
from helpers import orders

from notewright.functions.text import spark_regex
from notewright.operators.deidentify import DEFAULT_RULES, Rule, _mark_for, deidentify, redact, redaction_stats
from notewright.plans.note_fixture import render_notes


def cleaned(df):
    return [r["text"] for r in df.orderBy("note_id").collect()]


def test_identifiers_are_removed(notes):
    [row] = redact(notes(
        "MRN: 7654321   DOS: 01/02/2026   Provider: Dr. B. Jones\nPatient Anna Lee is here."
    )).collect()
    assert row["redactions"] == 4
    assert row["rule_redactions"] == [1, 0, 1, 1, 1]
    for identifier in ("7654321", "01/02/2026", "Dr. B. Jones", "Anna Lee"):
        assert identifier not in row["text"]


CASES = {
    "(MRN 1234567)": "([REDACTED])",  # the plain rule fires first
    "mrn#1234567 seen 1/2/26": "[REDACTED] seen [REDACTED]",
    "MRN 12345678901": "MRN 12345678901",  # eleven digits are too many
    "Patient John McDonald": "Patient [REDACTED]Donald",
    "Patient Ann Smith-Jones": "Patient [REDACTED]-Jones",
    "patient Ann Smith": "patient Ann Smith",
    "xMRN 1234567": "xMRN 1234567",
    "éMRN 1234567": "éMRN 1234567",  # a letter outside ASCII is a word character
    "MRN 1234567²": "MRN 1234567²",
    "MRN ١٢٣٤٥٦٧": "[REDACTED]",
    "MRN\x1c1234567": "[REDACTED]",
    "": "",
}


def test_rule_cases(notes):
    assert cleaned(deidentify(notes(*CASES))) == cleaned(
        notes(*CASES.values()))


def test_agrees_with_unicode_regexes(notes):
    """An independent run of the same patterns by Python's engine."""
    texts = [*CASES, "MRN:1234567 and MRN 7654321 on 12/31/1999, 1/1/20", "Dr. A. Bee Dr. C. Dee",
             "Patient Ann Lee Patient Bob Ray", "9/9/999 99/99/99999", "MRN 123456, mrn: 1234567890"]
    expected, counts = [], []
    for text in texts:
        per_rule = []
        for _, pattern, ignore_case, _ in fv.REDACTION_RULES:
            text, n = re.subn(pattern, "[REDACTED]", text, flags=re.I if ignore_case else 0)
            per_rule.append(n)
        expected.append(text)
        counts.append(per_rule)
    got = {r["note_id"]: r for r in redact(notes(*texts)).collect()}
    rows = [got[f"n{i}"] for i in range(len(texts))]
    assert [r["text"] for r in rows] == expected
    assert [r["rule_redactions"] for r in rows] == counts


@pytest.mark.parametrize("token", ["$1\\", "abc", "", "[R]", "<>"])
def test_tokens_and_counts(notes, token):
    rows = redact(notes("MRN 1234567 on 1/2/2026 and 3/4/22", " MRN 1234567 "),
                  token=token).orderBy("note_id").collect()
    assert rows[0]["text"] == f"{token} on {token} and {token}"
    assert rows[1]["text"] == f" {token} "
    assert [r["redactions"] for r in rows] == [3, 1]


def test_custom_rule(notes):
    rule = Rule("EMAIL", r"\S+@\S+", literal="@")
    assert cleaned(deidentify(notes("write a@b.c now"), (*DEFAULT_RULES, rule))) == [
        "write [REDACTED] now"]


def test_stats(spark, notes):
    [row] = redaction_stats(redact(notes("MRN 1234567", "none"))).collect()
    assert (row["notes"], row["redactions"], row["redactions_per_note"]) == (2, 1, 0.5)
    [row] = redaction_stats(redact(notes("x").limit(0))).collect()
    assert (row["notes"], row["redactions"], row["redactions_per_note"]) == (0, 0, 0.0)


def test_rendered_notes_are_clean_after_one_pass(spark):
    rendered = render_notes(orders(spark, 400), "k", "c", "d")
    once = deidentify(rendered)
    assert redact(once).agg(F.sum("redactions")).first()[0] == 0


def test_rendering_depends_on_the_key_only(spark):
    rows = orders(spark, 200)
    a = render_notes(rows, "k", "c", "d").orderBy("note_id").collect()
    b = render_notes(rows.repartition(7).where("k >= 0"), "k", "c", "d").orderBy("note_id").collect()
    assert a == b and len({r["text"] for r in a}) > 190


def test_many_rules_and_a_join_on_the_result_still_plan(spark, notes):
    """The plan must not multiply with the number of rules."""
    rules = [Rule(f"r{i}", rf"\bcode{i}\d+", True, f"code{i}") for i in range(12)]
    df = redact(notes("code3 x code311 CODE42"), rules)
    other = df.select(F.col("text").alias("other"))
    joined = df.join(other, df["text"] == other["other"]).where("redactions > 0")
    assert [r["redactions"] for r in joined.collect()] == [2]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 100_000


def test_boundary_forms():
    assert spark_regex(r"\bT1").startswith("T(?<!")
    assert spark_regex(r"\bT?1").startswith("(?:(?<=")


PATTERNS = [
    r"\b\d?AB\d{3}\b", r"\b\d*AB", r"\b\d{0,2}X", r"\b\d{1,2}/\d{2}\b", r"\w+", r"\W+", r"\D+", r"\S+",
    r"\Bb", r"b\B", r"[\w.]+@[\w-]+", r"[\s,]+x", r"\bA?B", r"\bA|C", r"\bAB\b", r"[]x]+", r"[^]x]+",
    r"[&&a]+", r"[a[b]+", r"x\b|\d", r"\b\d|Z", r"[\d/]+", r"\(\w\)",
]
TEXTS = [
    "AB123", "1AB123 xAB123", "12X X 3X", "Zoë-é12", "12/34 1/22", "a b x,\u2003x", "b ab ba bab", "foo.bar@é-x.de",
    "CAB AB B", "x]x&&a[b", "\u0663AB123 \u0663", "z(é) Z9 x9", "", "a\nb_c",
]


def test_own_patterns_agree_with_python(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").coalesce(1)
    found = rows.select(*[
        F.regexp_replace("t", F.lit(spark_regex(p)), F.lit("#")).alias(str(i)) for i, p in enumerate(PATTERNS)])
    wanted = [tuple(re.sub(p, "#", t) for p in PATTERNS) for t in TEXTS]
    assert [tuple(r) for r in found.collect()] == wanted
    for refused in (r"[\W]", r"[a\b]", r"[^\S]"):
        with pytest.raises(ValueError, match="no counterpart"):
            spark_regex(refused)


def test_own_rules_leave_nothing(notes):
    rules = [Rule("code", r"\b\d?AB\d{3}\b"), Rule("word", r"\bkey:\w+")]
    [row] = redact(notes("AB123 and 7AB456, key:Zoë_é12."), rules).collect()
    assert row["text"] == "[REDACTED] and [REDACTED], [REDACTED]." and list(row["rule_redactions"]) == [2, 1]


def test_filters_on_ids_reach_the_scan(spark, notes, tmp_path):
    from notewright.operators.extract import extract

    notes("melanoma, ER positive", "x").write.parquet(str(tmp_path / "n"))
    stored = spark.read.parquet(str(tmp_path / "n"))
    for df in (deidentify(stored), redact(stored), extract(stored), extract(deidentify(stored))):
        plan = df.where("note_id = 'n1'")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(note_id,n1)" in plan and df.where("note_id = 'n1'").count() == 1


def test_marks_of_one_byte_and_texts_that_hold_them(notes):
    assert all(len(_mark_for(token).encode()) == 1 for token in ("[REDACTED]", "", "[R]"))
    marked = "\x01MRN 1234567 \x01 and 1/2/2026\x01"
    rows = redact(notes(marked, "mrn 1234567 é", "\x01", "no  MRN 12345678")).orderBy("note_id").collect()
    assert [r["text"] for r in rows] == [
        "\x01[REDACTED] \x01 and [REDACTED]\x01", "[REDACTED] é", "\x01", "no  [REDACTED]"]
    assert [r["redactions"] for r in rows] == [2, 1, 0, 1]
