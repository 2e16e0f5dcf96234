import csv
import json
import re
from datetime import datetime
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from notewright.operators import marts
from notewright.operators.deidentify import deidentify
from notewright.operators.extract import extract
from notewright.operators.landing import landing_rows, landing_text, new_run_id
from notewright.operators.scoring import last_record_wins
from notewright.schemas import GOLD, LANDING, PREDICTION
from notewright.session import scratch_path
from notewright.sources import landing as table
from notewright.sources import records, site_codes
from notewright.streaming.incremental import land_new_notes

AT = datetime(2026, 1, 1)


@pytest.fixture
def predictions(spark):
    rows = [
        ("a", "m", "d", "breast", "h", ("T2", None, None, "IIIA"),
         [("HER2", "positive"), ("ER", "negative")], ["trastuzumab"], 1),
        ("b", "m", None, "Breast", None, (None,) * 4, [], [], None),
        ("c", "m", 'a "quoted", text', "lung", None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, PREDICTION)


@pytest.fixture
def landed(spark, predictions):
    path = scratch_path(spark, "landing")
    for run in ("r1", "r2"):
        table.append_landing(landing_rows(landing_text(predictions, run), AT), path)
    return table.read_landing(spark, path)


def test_two_runs_stay_side_by_side(spark, landed):
    assert landed.schema.fieldNames() == LANDING.fieldNames()
    assert {r["run_id"]: r["count"] for r in landed.groupBy("run_id").count().collect()} == {
        "r1": 3, "r2": 3}
    nulls = landed.where("note_id = 'c'").select(
        F.is_variant_null("tnm_stage"), F.is_variant_null("biomarkers")).first()
    assert tuple(nulls) == (True, True)  # absent is JSON null, not SQL NULL


def test_run_filter_prunes_folders(spark, predictions):
    path = scratch_path(spark, "landing")
    table.append_landing(landing_rows(landing_text(predictions, "r1"), AT), path)
    df = table.read_landing(spark, path, run_id="r1")
    assert "PartitionFilters: [isnotnull(run_id" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 3


def test_absent_columns_and_run_id(predictions):
    row = landing_text(predictions.select("note_id", "method"), "r").first()
    assert (row["tnm_stage"], row["primary_site"], row["ecog_performance_status"]) == (
        "null", None, None)
    assert re.fullmatch(r"\d{8}T\d{6}-[0-9a-f]{6}", new_run_id())


def test_csv_is_plain_csv(spark, predictions):
    path = scratch_path(spark, "csv")
    text = landing_text(predictions, "r")
    table.write_landing_csv(text.coalesce(1), path)
    [file] = Path(path).glob("*.csv")
    with open(file, newline="") as lines:
        rows = list(csv.DictReader(lines))
    assert rows[2]["primary_diagnosis"] == 'a "quoted", text'
    assert json.loads(rows[0]["tnm_stage"]) == {
        "t": "T2", "n": None, "m": None, "overall_stage": "IIIA"}
    assert rows[2]["biomarkers"] == "null" and rows[1]["biomarkers"] == "[]"
    assert sorted(table.read_landing_csv(spark, path).collect()) == sorted(text.collect())


def test_staging_and_facts(spark, landed):
    staged = marts.staging(landed)
    fct = marts.fct_diagnoses(staged, site_codes.default_site_codes(spark))
    got = {(r["note_id"], r["run_id"]): r for r in fct.collect()}
    assert len(got) == fct.count() == landed.count()  # one row per note and run
    assert (got["a", "r1"]["icdo3_code"], got["a", "r1"]["stage_group"]) == (
        "C50.9", "locally_advanced")
    assert got["b", "r1"]["icdo3_code"] is None  # exact case
    assert got["c", "r2"]["icdo3_label"] == "Lung, NOS"
    assert got["c", "r2"]["stage_group"] == "unknown"


def test_codes_too_large_to_broadcast_give_the_same(spark, landed):
    staged, codes = marts.staging(landed), site_codes.default_site_codes(spark)
    columns = ["note_id", "run_id", "primary_site", "icdo3_code"]
    small = marts.with_site_codes(staged, codes).select(columns)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    wanted = sorted(small.collect(), key=str)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        large = marts.with_site_codes(staged, codes).select(columns)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(large.collect(), key=str) == wanted
    finally:
        spark.conf.set(name, before)


def test_biomarkers_and_cohorts(spark, landed):
    staged = marts.staging(landed)
    dim = marts.dim_biomarkers(staged)
    assert dim.count() == 4  # b has none, c has null; both vanish
    assert "Exchange" not in dim._jdf.queryExecution().executedPlan().toString()
    assert marts.marker_cases(dim, "breast", "HER2", "positive").first()["cases"] == 1
    cohort = marts.treated_cohort(
        marts.fct_diagnoses(staged, site_codes.default_site_codes(spark)), staged, "breast", "III", "HER2", "positive", "trastuzumab")
    assert sorted(r["run_id"] for r in cohort.collect()) == ["r1", "r2"]


def test_site_codes_round_trip(spark):
    path = scratch_path(spark, "codes")
    codes = site_codes.default_site_codes(spark)
    site_codes.write_site_codes(codes, path)
    assert sorted(site_codes.read_site_codes(spark, path).collect()) == sorted(codes.collect())


def test_bad_records_abort(spark, tmp_path):
    good = '{"note_id": "a", "text": "t"}\n'
    for name, line, why in (("broken", '{"note_id": \n', "MALFORMED_RECORD"),
                            ("keyless", '{"note_id": "b"}\n', "a record has no text")):
        (tmp_path / name).write_text(good + line)
        with pytest.raises((PySparkException, Py4JJavaError), match=why):
            records.read_notes(spark, str(tmp_path / name)).collect()
    (tmp_path / "good").write_text(good)
    assert records.read_notes(spark, str(tmp_path / "good")).count() == 1


def test_last_line_wins_across_splits(spark, tmp_path):
    """Many splits of one file, and a second file, keep the order of lines."""
    for name in ("a.json", "b.json"):
        with open(tmp_path / name, "w") as lines:
            for i in range(3000):
                key = "hot" if i % 3 == 0 else f"k{i % 50}-{name}"
                lines.write(json.dumps({"note_id": key, "primary_site": f"{name}{i}"}) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = records.read_keyed(spark, str(tmp_path), GOLD)
        assert df.rdd.getNumPartitions() > 5
        got = {r["note_id"]: r["primary_site"]
               for r in last_record_wins(df, "note_id", "seq").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got["hot"] == "b.json2997"
    assert got["k1-a.json"] == "a.json2951" and got["k49-b.json"] == "b.json2999"


def test_jsonl_writes_nulls(spark, predictions, tmp_path):
    records.write_jsonl(predictions.coalesce(1), str(tmp_path / "p"))
    [file] = (tmp_path / "p").glob("*.json")
    lines = [json.loads(line) for line in file.read_text().splitlines()]
    assert lines[1]["ecog_performance_status"] is None and "histology" in lines[1]


def test_new_files_are_landed_once(spark, notes, tmp_path):
    incoming, path, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    first, second = notes("melanoma, T2 N0 M0", "MRN 1234567"), notes("x", "y", "prostate")
    records.write_jsonl(first, incoming, mode="append")
    land_new_notes(spark, incoming, path, progress, "r1", AT)
    land_new_notes(spark, incoming, path, progress, "r2", AT)
    assert table.read_landing(spark, path).count() == 2
    records.write_jsonl(second, incoming, mode="append")
    land_new_notes(spark, incoming, path, progress, "r2", AT)
    batch = landing_rows(landing_text(extract(deidentify(second)), "r2"), AT)
    columns = ["note_id", "method", "primary_site", "ecog_performance_status"]
    streamed = table.read_landing(spark, path, run_id="r2")
    assert sorted(streamed.select(columns).collect(), key=str) == sorted(
        batch.select(columns).collect(), key=str)


def test_csv_keeps_blanks_and_line_ends(spark, predictions, tmp_path):
    text = landing_text(predictions, "r").withColumn(
        "primary_diagnosis", F.concat(F.lit("  two\nlines, \"quoted\"\r\nthree "), F.col("note_id"), F.lit("  ")))
    table.write_landing_csv(text, str(tmp_path / "csv"))
    back = table.read_landing_csv(spark, str(tmp_path / "csv"))
    columns = ["note_id", "primary_diagnosis", "tnm_stage"]
    assert sorted(back.select(columns).collect()) == sorted(text.select(columns).collect())


def test_cohort_evidence_comes_from_the_row_s_own_run(spark, predictions, tmp_path):
    path = str(tmp_path / "landing")
    first = predictions.where("note_id = 'a'")
    turned = first.withColumn("biomarkers", F.transform("biomarkers", lambda m: F.struct(
        m["name"].alias("name"), F.lit("negative").alias("status"))))
    for run, frame in (("r1", first), ("r2", turned)):
        table.append_landing(landing_rows(landing_text(frame, run), AT), path)
    staged = marts.staging(table.read_landing(spark, path))
    cohort = marts.treated_cohort(
        marts.fct_diagnoses(staged, site_codes.default_site_codes(spark)), staged, "breast", "III", "HER2",
        "positive", "trastuzumab")
    assert [r["run_id"] for r in cohort.collect()] == ["r1"]


def test_a_failed_gate_leaves_landing_and_marts(spark, notes, tmp_path):
    from notewright.operators.quality import GateFailure
    from notewright.plans.batch import run_batch

    codes, folder = site_codes.default_site_codes(spark), str(tmp_path / "batch")
    run_batch(notes("MRN 1234567 melanoma stage IV", "prostate"), folder, "r1", codes, loaded_at=AT)

    def state():
        return [sorted(map(str, spark.read.parquet(f"{folder}/{t}").collect())) for t in (
            "landing", "marts/fct_diagnoses", "marts/dim_biomarkers")]

    before = state()
    assert len(before[0]) == len(before[1]) == 2
    with pytest.raises(GateFailure, match="site fill rate"):
        run_batch(notes("nothing known", "nor here"), folder, "r2", codes, loaded_at=AT)
    with pytest.raises(ValueError, match="landed before"):
        run_batch(notes("melanoma"), folder, "r1", codes, loaded_at=AT)
    assert state() == before
    run_batch(notes("melanoma, BRAF mutated"), folder, "r3", codes, loaded_at=AT)
    assert [len(t) for t in state()] == [3, 3, 1]


def test_csv_files_are_bounded_and_read_by_many_tasks(spark, notes, tmp_path):
    text = landing_text(extract(notes(*["two\nlines, lung"] * 10)).coalesce(1), "r")
    table.write_landing_csv(text, str(tmp_path / "csv"), rows_per_file=3)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 4
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1k")
    try:
        back = table.read_landing_csv(spark, str(tmp_path / "csv"))
        assert back.rdd.getNumPartitions() == 4
        assert sorted(back.collect()) == sorted(text.collect())
    finally:
        spark.conf.set(name, before)
