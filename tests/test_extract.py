import re
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException

from notewright import fixed_values as fv
from notewright.operators.extract import ExtractionRules, Pattern, arrow_extractor, extract, rule_facts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks can't import tests


def facts(notes, *texts):
    rows = rule_facts(notes(*texts)).collect()
    return [r for r in sorted(rows, key=lambda r: int(r["note_id"][1:]))]


def markers(row):
    return {m["name"]: m["status"] for m in row["biomarkers"]}


def test_fields_of_a_plain_note(notes):
    [row] = facts(notes, (
        "Left breast biopsy: IDC. Extent T3 N0 M0 (stage IIA by our count). Receptors ER negative, "
        "PR positive. ECOG 2. Started paclitaxel and trastuzumab."))
    assert (row["primary_site"], row["histology"]) == ("breast", "invasive ductal carcinoma")
    assert row["tnm_stage"].asDict() == {"t": "T3", "n": "N0", "m": "M0", "overall_stage": "IIA"}
    assert (row["ecog_performance_status"], row["medications"]) == (2, ["paclitaxel", "trastuzumab"])
    assert markers(row) == {"ER": "negative", "PR": "positive"}


def test_shapes_that_hide_facts(notes):
    rows = facts(
        notes,
        "NSCLC, right hilum, now T4N2M1 (stage IV); EGFR exon 19 deletion and PD-L1 70%. ECOG performance "
        "status 3, on pembrolizumab with Carboplatin.",
        "[REDACTED] for a prostate tumor, clinical stage IIB. PSA 11.7 ng/mL. ECOG 1. docetaxel planned.",
        "Mass of the left breast, T1 N0 M0, stage I. HER2 3+ / ER(positive) / Ki-67 8%; anastrozole.",
        "Scalp melanoma, T2 N1 M0 - stage IIIB, nothing given yet",
    )
    assert [r["primary_site"] for r in rows] == ["lung", "prostate", "breast", "skin"]
    assert [tuple(r["tnm_stage"]) for r in rows] == [
        (None, None, None, "IV"), (None, None, None, "IIB"), ("T1", "N0", "M0", "I"),
        ("T2", "N1", "M0", "IIIB")]
    assert [markers(r) for r in rows] == [
        {"EGFR": "exon", "PD-L1": "70%"}, {"PSA": "11.7"}, {"HER2": "3", "Ki-67": "8%"}, {}]
    assert [r["medications"] for r in rows] == [
        ["carboplatin", "pembrolizumab"], ["docetaxel"], ["anastrozole"], []]
    assert [r["ecog_performance_status"] for r in rows] == [3, 1, None, None]


def test_stage_and_category_traps(notes):
    rows = facts(notes, "stage II", "stage IIIC", "Stage iv", "T2N1M0", "t2 n1 m0", "xT2", "T2²",
                 "stage  ", "")
    assert [tuple(r["tnm_stage"]) for r in rows] == [
        (None, None, None, "II"), (None,) * 4, (None, None, None, "IV"), (None,) * 4, (None,) * 4,
        (None,) * 4, (None,) * 4, (None,) * 4, (None,) * 4]


def test_marker_traps(notes):
    rows = facts(notes, "over the hill, ER positive", "ER ...", "BRAF V600E mutated",
                 "river 5 runs", "ER PR positive", "no markers")
    assert [markers(r) for r in rows] == [
        {"ER": "the"}, {"ER": ""}, {"BRAF": "V600E"}, {"ER": "5"},
        {"ER": "PR", "PR": "positive"}, {}]
    assert all(r["biomarkers"] is not None and r["medications"] is not None for r in rows)


def test_folded_letters_match(notes):
    """The literal search before a pattern must not lose a match that folds case."""
    rows = facts(notes, "pſa 5", "KRAſ mutated", "Kİ-67 30%", "Mſı high",
                 "ſtage IV", "EſOG 1")
    assert [markers(r) for r in rows][:4] == [
        {"PSA": "5"}, {"KRAS": "mutated"}, {"Ki-67": "30%"}, {"MSI": "high"}]
    assert rows[4]["tnm_stage"]["overall_stage"] == "IV"
    assert rows[5]["ecog_performance_status"] is None


def test_order_and_substring_rules(notes):
    rows = facts(notes, "on FOLFOX, tamoxifen and cetuximab", "semicolon use; melanoma")
    assert rows[0]["medications"] == ["FOLFOX", "cetuximab", "tamoxifen"]
    assert rows[1]["primary_site"] == "colon"


def test_markers_agree_with_python(notes):
    texts = ["ER+ PR -, HER2 neg", "Ki-67\t30% er\nx", "PD-L1 <1%. ALK rearranged.", "NRAS  wt.."]
    expected = []
    for text in texts:
        found = {}
        for name in fv.BIOMARKER_NAMES:
            hit = re.search(re.escape(name) + fv.BIOMARKER_STATUS, text, re.I)
            if hit:
                found[name] = hit.group(1).rstrip(".")
        expected.append(found)
    assert [markers(r) for r in facts(notes, *texts)] == expected


def test_own_rules_and_extractor(notes):
    rules = ExtractionRules(medications=("Aspirin",), biomarkers=("XYZ",))
    [row] = extract(notes("aspirin, xyz high"), lambda n: rule_facts(n, rules), "mine").collect()
    assert (row["method"], row["medications"]) == ("mine", ["Aspirin"])
    assert markers(row) == {"XYZ": "high"}


def test_filter_on_a_fact_runs_the_patterns_once(notes):
    df = rule_facts(notes("melanoma")).where("primary_site = 'skin'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(_lowered") <= 2 * 40 and df.count() == 1
    assert plan.count("(?iu)HER2") <= 1


def test_an_own_pattern_has_no_foreign_literal(notes):
    own = ExtractionRules(stage=r"stadium\s+(IV|III)\b", ecog=Pattern(r"zubrod\s+([0-5])", "zubrod"))
    [row] = rule_facts(notes("Stadium IV, Zubrod 2"), own).collect()
    assert (row["tnm_stage"]["overall_stage"], row["ecog_performance_status"]) == ("IV", 2)


def test_only_wanted_fields_are_computed(notes):
    df = rule_facts(notes("melanoma, ER positive"), fields=("primary_site",))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert df.columns == ["note_id", "primary_site"] and "HER2" not in plan and "ECOG" not in plan


def _noted(notes, **columns):
    n = notes.num_rows
    arrays = {"note_id": notes.column("note_id"), **{k: pa.array([v] * n) for k, v in columns.items()}}
    return pa.RecordBatch.from_pydict(arrays)


def test_a_plugged_in_extractor_equals_the_rules(spark, notes):
    """A table-driven extractor over Arrow batches, in batches of few notes."""
    sizes = spark.sparkContext.accumulator(0)
    table = {k: (d, s, h) for ks, d, s, h in reversed(fv.KEYWORD_GROUPS) for k in reversed(ks)}

    def work(batch):
        sizes.add(1)
        assert batch.num_rows <= 2
        found = [next((table[k] for ks, *_ in fv.KEYWORD_GROUPS for k in ks if k in text.lower()), (None,) * 3)
                 for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], pa.large_string()) for i in (1, 0, 2)] + [batch.column("note_id")],
            ["primary_site", "primary_diagnosis", "histology", "note_id"])

    fields = ("primary_diagnosis", "primary_site", "histology")
    texts = notes("Melanoma of the arm", "nothing", "PROSTATE cancer", "lung adenocarcinoma", "").coalesce(1)
    found = extract(texts, arrow_extractor(work, fields, rows=2), method="plugged")
    assert found.columns == ["note_id", "method", *fields]
    assert sorted(found.drop("method").collect(), key=str) == sorted(rule_facts(texts, fields=fields).collect(), key=str)
    assert sizes.value >= 3


def test_long_notes_come_in_batches_of_their_own(notes):
    def work(batch):
        assert batch.num_rows == 1 or sum(map(len, batch.column("text").to_pylist())) <= 100
        return _noted(batch, primary_site="x")

    found = arrow_extractor(work, ("primary_site",), characters=100)(notes("a" * 500, "b" * 60, "c" * 60, "d", "e").coalesce(1))
    assert found.count() == 5 and found.where("primary_site = 'x'").count() == 5


@pytest.mark.parametrize(("work", "why"), [
    (lambda b: _noted(b), "instead of"),
    (lambda b: _noted(b, primary_site="x", extra=1), "instead of"),
    (lambda b: _noted(b, primary_site="x").slice(1), "one row for each note"),
    (lambda b: _noted(b.slice(0, 1), primary_site="x"), "one row for each note"),
    (lambda b: pa.RecordBatch.from_pydict({"note_id": ["made up"] * b.num_rows, "primary_site": ["x"] * b.num_rows}),
     "one row for each note"),
    (lambda b: _noted(b, primary_site=[1, 2]), "returned primary_site as"),
])
def test_a_bad_plug_in_is_refused(notes, work, why):
    with pytest.raises(PySparkException, match=why):
        arrow_extractor(work, ("primary_site",))(notes("a", "b").coalesce(1)).collect()


def test_a_plug_in_of_unknown_facts_is_refused():
    with pytest.raises(ValueError, match="no facts: grade"):
        arrow_extractor(lambda b: b, ("grade",))
