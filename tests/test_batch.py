from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from notewright.operators import marts, quality
from notewright.operators.deidentify import deidentify, redact, redaction_stats
from notewright.operators.extract import extract
from notewright.plans import batch
from notewright.plans.batch import DIM, FCT, committed_runs, read_mart, redaction_statistics, run_batch
from notewright.sources import commits, site_codes
from notewright.sources import landing as table
from notewright.sources import records
from notewright.streaming.incremental import land_checked_notes

AT = datetime(2026, 1, 1)
TEXTS = {
    "r1": ("MRN 1234567 melanoma stage IV, BRAF mutated", "prostate"),
    "r2": ("lung adenocarcinoma, EGFR positive, stage IIIA, seen 01/02/2026", "breast, HER2 positive", "colon"),
}


class Killed(Exception):
    pass


def rows(df):
    return sorted(map(str, df.collect()))


def marts_of(spark, folder):
    return [rows(read_mart(spark, folder, name)) for name in (FCT, DIM)]


def rebuilt(spark, folder):
    """Both marts from all of landing."""
    staged = marts.staging(table.read_landing(spark, f"{folder}/landing"))
    return [rows(marts.fct_diagnoses(staged, site_codes.default_site_codes(spark))), rows(marts.dim_biomarkers(staged))]


@pytest.fixture
def run(spark, notes, tmp_path):
    folder = str(tmp_path / "batch")

    def one(name, **options):
        run_batch(notes(*TEXTS[name]), folder, name, site_codes.default_site_codes(spark), loaded_at=AT, **options)

    return folder, one


def test_a_run_killed_anywhere_is_finished_by_a_second_call(spark, run, monkeypatch):
    folder, one = run
    one("r1")
    old = marts_of(spark, folder)
    real, steps = commits.put, ["begun", "notes", "predictions", "landed", FCT, DIM, "versions"]
    for step in steps:  # killed again and again, each time one step further
        def put(session, path, content, step=step):
            if step in path:
                raise Killed(step)
            return real(session, path, content)

        monkeypatch.setattr(commits, "put", put)
        with pytest.raises(Killed):
            one("r2")
        assert marts_of(spark, folder) == old and committed_runs(spark, folder) == ["r1"]
    monkeypatch.setattr(commits, "put", real)
    monkeypatch.setattr(batch, "redact", None)  # nothing that is done is done again
    one("r2")
    new = marts_of(spark, folder)
    assert new == rebuilt(spark, folder) and [len(m) for m in new] == [5, 3]
    assert committed_runs(spark, folder) == ["r1", "r2"]
    with pytest.raises(ValueError, match="landed before"):
        one("r2")
    assert marts_of(spark, folder) == new


def test_what_a_lost_step_left_is_replaced(spark, run, notes):
    folder, one = run
    one("r1")
    commits.Run(spark, folder, "r2").once("begun", dict)
    stray = table.read_landing(spark, f"{folder}/landing").withColumn("run_id", F.lit("r2"))
    table.append_landing(stray, f"{folder}/landing")  # a part of a commit
    (spark.createDataFrame([("x", "lung", "r2")], "note_id string, primary_site string, run_id string")
     .write.mode("append").partitionBy("run_id").parquet(f"{folder}/marts/{DIM}"))
    assert len(marts_of(spark, folder)[1]) == 1
    one("r2")
    assert table.read_run(spark, f"{folder}/landing", "r2").count() == 3
    assert marts_of(spark, folder) == rebuilt(spark, folder)


def test_a_run_reads_its_own_landed_rows_only(spark, run):
    folder, one = run
    one("r1")
    files = list(Path(f"{folder}/landing/run_id=r1").iterdir())
    before = {f: f.read_bytes() for f in files}
    for file in files:
        file.write_bytes(b"not to be read")
    one("r2")
    assert len(marts_of(spark, folder)[0]) == 5
    for file, content in before.items():
        file.write_bytes(content)
    assert marts_of(spark, folder) == rebuilt(spark, folder)


def test_observed_measures_equal_the_gate_and_the_statistics(spark, run, notes):
    folder, one = run
    for name in TEXTS:
        one(name)
        clean = deidentify(notes(*TEXTS[name]))
        predictions = extract(clean)
        journal = commits.Run(spark, folder, name)
        measures = journal.found("notes") | journal.found("predictions")
        observed = quality.measured_verdict(measures, predictions)
        assert {r["check"]: tuple(r) for r in observed} == {
            r["check"]: tuple(r) for r in quality.gate_verdict(predictions, clean).collect()}
    wanted = [(n, *redaction_stats(redact(notes(*texts))).first()) for n, texts in TEXTS.items()]
    assert [tuple(r) for r in redaction_statistics(spark, folder).orderBy("run_id").collect()] == wanted


def test_a_broken_batch_gives_the_verdict_of_the_gate(spark, notes):
    rows = [("d", "", ("II",)), ("b", None, ("IIIC",)), ("c", "x", ("V",)), (None, "x", (None,))]
    predictions = spark.createDataFrame(rows, "note_id string, primary_site string, tnm_stage struct<overall_stage: string>")
    clean = notes("MRN 1234567", "clean")
    measures = {
        n: v for m, df in ((quality.prediction_measures(predictions), predictions), (quality.note_measures(), clean))
        for n, v in df.agg(*[c.alias(n) for n, c in m.items()]).first().asDict().items()}
    observed = quality.measured_verdict(measures, predictions)
    assert {r["check"]: tuple(r) for r in observed} == {
        r["check"]: tuple(r) for r in quality.gate_verdict(predictions, clean).collect()}
    with pytest.raises(quality.GateFailure, match="b,c,d"):
        quality.enforce_rows(observed)


def test_a_failed_gate_lets_the_run_begin_anew(spark, notes, run):
    folder, one = run
    codes = site_codes.default_site_codes(spark)
    with pytest.raises(quality.GateFailure):
        run_batch(notes("nothing known"), folder, "r1", codes, loaded_at=AT)
    with pytest.raises(ValueError, match="no run"):
        read_mart(spark, folder, FCT)
    one("r1")
    assert len(marts_of(spark, folder)[0]) == 2


def test_rows_landed_by_others_are_left_alone(spark, run):
    folder, one = run
    one("r1")
    other = table.read_landing(spark, f"{folder}/landing").withColumn("run_id", F.lit("r2"))
    table.append_landing(other, f"{folder}/landing")
    with pytest.raises(ValueError, match="landed before"):
        one("r2")
    assert table.read_run(spark, f"{folder}/landing", "r2").count() == 2


def test_of_two_writers_of_a_version_one_wins_and_the_other_follows(spark, tmp_path, monkeypatch):
    folder, real = str(tmp_path / "batch"), commits.version
    raced = []

    def behind(session, where):
        found = real(session, where)
        if not raced:
            raced.append(commits.put(session, commits._version_path(folder, 1), {"runs": [{"run": "other"}]}))
        return found

    monkeypatch.setattr(commits, "version", behind)
    assert commits.commit(spark, folder, {"run": "mine"}) == 2
    assert real(spark, folder) == (2, [{"run": "other"}, {"run": "mine"}])
    assert commits.commit(spark, folder, {"run": "mine"}) == 2
    assert not commits.put(spark, f"{folder}/versions/000000000001.json", {}) and raced == [True]
    assert [n for n in commits.names(spark, f"{folder}/versions") if n.startswith(".0000") and not n.endswith(".crc")] == []


def test_odd_run_names(spark, notes, tmp_path):
    folder, codes = str(tmp_path / "batch"), site_codes.default_site_codes(spark)
    for name in ("2026-01-01T00:00:00", "007", "a b=c"):
        run_batch(notes("melanoma"), folder, name, codes, loaded_at=AT)
    assert sorted(r["run_id"] for r in read_mart(spark, folder, FCT).collect()) == ["007", "2026-01-01T00:00:00", "a b=c"]


def test_micro_batches_go_through_the_gate(spark, notes, tmp_path):
    incoming, folder, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    codes = site_codes.default_site_codes(spark)

    def land(**options):
        land_checked_notes(spark, incoming, folder, codes, progress, "s", AT, **options)

    records.write_jsonl(notes(*TEXTS["r1"]).coalesce(1), incoming, mode="append")
    land()
    first = marts_of(spark, folder)
    records.write_jsonl(notes("MRN 1234567, breast", "colon").coalesce(1), incoming, mode="append")
    for _ in range(2):  # its files are tried again
        with pytest.raises(quality.GateFailure, match="looks like an identifier"):
            land(rules=())
        assert marts_of(spark, folder) == first and committed_runs(spark, folder) == ["s-000000"]
        assert table.read_landing(spark, f"{folder}/landing").count() == 2
    land()
    assert committed_runs(spark, folder) == ["s-000000", "s-000001"]
    assert table.read_landing(spark, f"{folder}/landing").count() == 4
    assert marts_of(spark, folder) == rebuilt(spark, folder)


def test_a_replayed_micro_batch_lands_once(spark, notes, tmp_path, monkeypatch):
    incoming, folder, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    codes, real = site_codes.default_site_codes(spark), commits.put
    records.write_jsonl(notes(*TEXTS["r1"]).coalesce(1), incoming, mode="append")

    def put(session, path, content):
        if "versions" in path:
            raise Killed
        return real(session, path, content)

    monkeypatch.setattr(commits, "put", put)
    with pytest.raises(Exception, match="Killed"):  # landed, in no version
        land_checked_notes(spark, incoming, folder, codes, progress, "s", AT)
    assert committed_runs(spark, folder) == []
    monkeypatch.setattr(commits, "put", real)
    land_checked_notes(spark, incoming, folder, codes, progress, "s", AT)
    for noted in Path(progress, "commits").iterdir():  # the stream was lost before it noted the batch
        noted.unlink()
    land_checked_notes(spark, incoming, folder, codes, progress, "s", AT)
    assert committed_runs(spark, folder) == ["s-000000"]
    assert table.read_landing(spark, f"{folder}/landing").count() == 2
    assert [len(m) for m in marts_of(spark, folder)] == [2, 1]
