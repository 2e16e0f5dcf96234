import pytest

from notewright.operators.deidentify import deidentify
from notewright.operators.quality import GateFailure, enforce_gate, gate_verdict

PRED = "note_id string, primary_site string, tnm_stage struct<overall_stage: string>"


def verdict(spark, notes, rows, *texts):
    return gate_verdict(spark.createDataFrame(rows, PRED), notes(*texts))


def by_check(df):
    return {r["check"]: r for r in df.collect()}


def test_clean_batch_passes(spark, notes):
    df = verdict(spark, notes, [("a", "lung", ("IV",)), ("b", "skin", (None,)), ("c", "x", None)],
                 "clean text")
    assert all(r["passed"] for r in by_check(df).values())
    enforce_gate(df)


def test_every_failure_is_named(spark, notes):
    rows = [("d", "", ("II",)), ("b", None, ("IIIC",)), ("c", "x", ("V",)), ("a", "x", ("",)),
            (None, "x", (None,))]
    df = verdict(spark, notes, rows, "MRN 1234567", "on 01/02/2026", "both MRN 123456 1/2/2026")
    got = by_check(df)
    assert got["site_fill_rate"]["value"] == pytest.approx(0.6)
    assert got["invalid_stage"]["value"] == 4 and got["invalid_stage"]["sample"] == "a,b,c"
    assert got["residual_identifiers"]["value"] == 3  # notes, not hits
    assert got["missing_note_id"]["value"] == 1
    with pytest.raises(GateFailure) as caught:
        enforce_gate(df)
    assert len(caught.value.failures) == 4


def test_empty_batch_fails_on_fill(spark, notes):
    df = verdict(spark, notes, [], "x")
    assert not by_check(df)["site_fill_rate"]["passed"]
    assert by_check(df)["invalid_stage"]["passed"]


def test_scan_is_narrower_and_wider_than_the_rules(spark, notes):
    ok = [("a", "x", (None,))]
    missed = verdict(spark, notes, ok, "MRN: 1234567", "1/2/26", "Dr. A. Bee")
    assert by_check(missed)["residual_identifiers"]["value"] == 0
    long_number = deidentify(notes("MRN 12345678901"))
    left = gate_verdict(spark.createDataFrame(ok, PRED), long_number)
    assert by_check(left)["residual_identifiers"]["value"] == 1


def test_threshold_is_a_parameter(spark, notes):
    rows = [("a", "x", (None,)), ("b", "", (None,))]
    df = gate_verdict(spark.createDataFrame(rows, PRED), notes("x"), min_fill=0.5)
    assert by_check(df)["site_fill_rate"]["passed"]
