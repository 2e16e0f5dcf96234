"""The registered queries: name to ``(spark, sf_dir) -> DataFrame``.

Each output is flat, with nested values exploded or joined to text, so that it can be compared
with plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright import fixed_values as fv
from notewright.functions.text import strip
from notewright.operators import deidentify as deid
from notewright.operators import landing, marts, quality, responses, scoring, term_index
from notewright.operators.extract import arrow_extractor, extract, rule_facts
from notewright.plans import corpus
from notewright.plans.batch import DIM, FCT, read_mart, redaction_statistics, run_batch
from notewright.schemas import FACT_COLUMNS, GOLD, MODEL_PREDICTION
from notewright.session import scratch_path
from notewright.sources import landing as landing_table
from notewright.sources import records, site_codes
from notewright.streaming.incremental import land_checked_notes, land_new_notes

Query = Callable[[SparkSession, str], DataFrame]

# fixed, so that results do not depend on the time of the run
RULE_RUN, MODEL_RUN = "20260101T000000-aaaaaa", "20260102T000000-bbbbbb"
LOADED_AT = datetime(2026, 1, 1, 12, 0, 0)
EMAIL_RULE = deid.Rule("EMAIL", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+\.[A-Za-z]{2,}", literal="@")
# an optional digit in front, and a class of word characters
OWN_RULES = (
    deid.Rule("CODE", r"\b\d?AB\d{3}\b"),
    deid.Rule("SECRET", r"password=\w+", literal="password="),
)


def _stage_columns() -> list[Column]:
    return [F.col(f"tnm_stage.{c}").alias(c) for c in ("t", "n", "m", "overall_stage")]


def _markers_text(column: str = "biomarkers") -> Column:
    return F.array_join(F.transform(
        column, lambda m: F.concat_ws("=", m["name"], F.coalesce(m["status"], F.lit("")))), ";")


def _rounded(df: DataFrame, *columns: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def notes_rendered(spark, sf_dir):
    return corpus.rendered(spark, sf_dir).select(
        "note_id", "text", "primary_diagnosis", "primary_site", "histology", *_stage_columns(),
        "ecog_performance_status")


def gold_long(spark, sf_dir):
    labels = corpus.gold(spark, sf_dir)
    meds = F.transform("medications", lambda m: F.struct(
        F.lit("medication").alias("kind"), m.alias("name"), F.lit("").alias("status")))
    markers = F.transform("biomarkers", lambda m: F.struct(
        F.lit("biomarker").alias("kind"), m["name"].alias("name"), m["status"].alias("status")))
    numbered = [F.transform(items, lambda item, i: F.struct(
        i.alias("pos"), item["kind"].alias("kind"), item["name"].alias("name"),
        item["status"].alias("status"))) for items in (markers, meds)]
    return labels.select("note_id", F.inline(F.concat(*numbered)))


def deid_text(spark, sf_dir):
    return corpus.deidentified(spark, sf_dir)


def deid_counts(spark, sf_dir):
    names = ("mrn", "mrn_in_parentheses", "date", "provider", "name")
    redacted = deid.redact(corpus.raw_notes(spark, sf_dir))
    return redacted.select(
        "note_id", *[F.col("rule_redactions")[i].alias(n) for i, n in enumerate(names)],
        "redactions")


def deid_stats(spark, sf_dir):
    return _rounded(deid.redaction_stats(deid.redact(corpus.raw_notes(spark, sf_dir))),
                    "redactions_per_note")


def deid_custom_rule(spark, sf_dir):
    docs = corpus.documents(spark, sf_dir)
    return deid.redact(docs, (*deid.DEFAULT_RULES, EMAIL_RULE)).select(
        F.col("note_id").alias("doc_id"), F.md5("text").alias("text_md5"),
        F.col("rule_redactions")[len(deid.DEFAULT_RULES)].alias("emails"), "redactions")


def deid_given(spark, sf_dir):
    """Every supplied text, redacted and counted."""
    redacted = deid.redact(corpus.given_texts(spark, sf_dir), (*deid.DEFAULT_RULES, EMAIL_RULE, *OWN_RULES))
    emails = len(deid.DEFAULT_RULES)
    return redacted.select(
        "note_id", F.md5("text").alias("text_md5"), F.col("rule_redactions")[emails].alias("emails"),
        F.col("rule_redactions")[emails + 1].alias("codes"),
        F.col("rule_redactions")[emails + 2].alias("secrets"), "redactions")


def facts_given(spark, sf_dir):
    """The rules on every supplied text."""
    facts = rule_facts(corpus.given_texts(spark, sf_dir))
    return facts.select(
        "note_id", "primary_site", *_stage_columns(), _markers_text().alias("biomarkers"),
        F.array_join("medications", ",").alias("medications"), "ecog_performance_status")


def gate_given(spark, sf_dir):
    """The gate on every supplied text, which is no clinical batch and must not pass."""
    notes = corpus.given_texts(spark, sf_dir)
    return _gated(spark, extract(notes), notes)


def facts_scalar(spark, sf_dir):
    fields = ("primary_diagnosis", "primary_site", "histology", "tnm_stage", "ecog_performance_status")
    return rule_facts(corpus.deidentified(spark, sf_dir), fields=fields).select(
        "note_id", "primary_diagnosis", "primary_site", "histology", *_stage_columns(),
        "ecog_performance_status")


def facts_biomarkers(spark, sf_dir):
    facts = rule_facts(corpus.deidentified(spark, sf_dir), fields=("biomarkers",))
    return facts.select("note_id", F.inline("biomarkers"))


def biomarker_false_hits(spark, sf_dir):
    return rule_facts(corpus.documents(spark, sf_dir), fields=("biomarkers",)).select(
        F.col("note_id").alias("doc_id"), F.inline("biomarkers"))


def facts_meds(spark, sf_dir):
    facts = rule_facts(corpus.deidentified(spark, sf_dir), fields=("medications",))
    return facts.select("note_id", F.explode("medications").alias("medication"))


def facts_plugged(spark, sf_dir):
    """Medications looked up by a plugged-in function over Arrow batches."""
    terms = sorted(set(fv.MEDICATIONS))

    def work(notes: pa.RecordBatch) -> pa.RecordBatch:
        lowered = [text.lower() for text in notes.column("text").to_pylist()]
        found = [[term for term in terms if term.lower() in text] for text in lowered]
        return pa.RecordBatch.from_arrays([notes.column("note_id"), pa.array(found, pa.list_(pa.string()))],
                                          ["note_id", "medications"])

    predictions = extract(corpus.deidentified(spark, sf_dir), arrow_extractor(work, ("medications",)))
    return predictions.select("note_id", F.explode("medications").alias("medication"))


def facts_indexed(spark, sf_dir):
    """Classification and medications of notes by an index of terms."""
    notes = _table(spark, corpus.deidentified(spark, sf_dir), "notes")
    drugs = spark.createDataFrame([(m,) for m in fv.MEDICATIONS], "term string")
    groups = spark.createDataFrame(
        [(k, place, *facts) for place, (keys, *facts) in enumerate(fv.KEYWORD_GROUPS) for k in keys],
        "term string, place int, primary_diagnosis string, primary_site string, histology string")
    listed = term_index.terms_of_notes(notes, drugs).select("note_id", F.array_join("terms", ",").alias("medications"))
    return term_index.classes_of_notes(notes, groups).join(listed, "note_id")


def _assembled(predictions):
    return predictions.select(
        "note_id", "method", "primary_site", F.col("tnm_stage.overall_stage"),
        _markers_text().alias("biomarkers"), F.array_join("medications", ",").alias("medications"),
        "ecog_performance_status")


def facts_assembled(spark, sf_dir):
    return _assembled(corpus.rule_predictions(spark, sf_dir))


def model_offline(spark, sf_dir):
    return _assembled(responses.model_predictions(corpus.deidentified(spark, sf_dir)))


def prompts(spark, sf_dir):
    return responses.prompts(corpus.deidentified(spark, sf_dir)).select(
        "note_id", F.md5("system").alias("system_md5"), F.md5("prompt").alias("prompt_md5"),
        F.length("prompt").alias("prompt_length"))


def responses_joined(spark, sf_dir):
    text = responses.response_text(F.col("content"))
    return corpus.responses(spark, sf_dir).select("note_id", text.alias("text")).select(
        "note_id", F.md5("text").alias("text_md5"),
        F.md5(responses.without_fence(strip(F.col("text")))).alias("body_md5"))


def _parsed(predictions):
    """Predictions of a model, typed, with what no type shows: ECOG as JSON, extra members."""
    extra = F.size(F.filter(
        F.coalesce(F.try_variant_get("biomarkers", "$", "array<variant>"), F.array()),
        lambda m: F.try_variant_get(m, "$.method", "string").isNotNull()))
    whole = predictions.withColumns({
        "ecog": F.to_json("ecog_performance_status"), "with_method": extra})
    return responses.typed_facts(whole).select(
        "note_id", "method", "primary_diagnosis", "primary_site", "histology",
        *_stage_columns(),
        F.when(F.col("biomarkers").isNotNull(), _markers_text()).alias("biomarkers"),
        F.array_join("medications", ",").alias("medications"),
        "ecog", "with_method", "input_tokens", "output_tokens")


def responses_parsed(spark, sf_dir):
    return _parsed(corpus.responded_predictions(spark, sf_dir))


def responses_repeated(spark, sf_dir):
    """A third of the requests was retried: an earlier answer must not count."""
    final = corpus.responses(spark, sf_dir).withColumn("seq", F.lit(1))
    early = final.where(corpus.note_key(F.col("note_id")) % 3 == 0).withColumns({
        "content": F.array(F.struct(F.lit("text").alias("type"), F.lit('{"primary_site": "early"}').alias("text"))),
        "seq": F.lit(0)})
    return _parsed(responses.model_predictions(
        corpus.raw_notes(spark, sf_dir), early.unionByName(final), order="seq"))


def usage_cost(spark, sf_dir):
    usage = responses.usage_cost(corpus.responded_predictions(spark, sf_dir))
    return _rounded(usage, "cost", "cost_per_note", places=6)


def _gated(spark, predictions, notes):
    """The verdict on a batch that was written, so that neither side is computed twice."""
    return _rounded(quality.gate_verdict(
        _table(spark, predictions, "predictions"), _table(spark, notes, "notes")), "value")


def gate_clean(spark, sf_dir):
    notes = _table(spark, corpus.deidentified(spark, sf_dir), "notes")
    return _gated(spark, extract(notes), notes)


def gate_broken(spark, sf_dir):
    return _gated(
        spark, corpus.responded_predictions(spark, sf_dir), corpus.raw_notes(spark, sf_dir))


def leak_scan(spark, sf_dir):
    texts = [
        corpus.table(spark, sf_dir, name, F.lit(name).alias("source"), F.col(column).alias("text"))
        for name, column in (("documents", "text"), ("conversations", "text"), ("pages", "html"))
    ]
    everything = texts[0].unionByName(texts[1]).unionByName(texts[2])
    leak = quality.leaks_identifier(F.col("text"))
    return everything.groupBy("source").agg(
        F.count(F.lit(1)).alias("notes"), F.count_if(leak).alias("leaks"))


def last_record_wins(spark, sf_dir):
    """Facts with later versions of some records; one key holds a third of all versions."""
    facts = rule_facts(corpus.deidentified(spark, sf_dir), fields=("primary_site",))
    key = corpus.note_key(F.col("note_id"))
    versions = F.array_compact(F.array(
        F.struct("note_id", F.lit(0).cast("bigint").alias("seq"), "primary_site"),
        F.when(key % 5 == 0, F.struct(
            "note_id", F.lit(1).cast("bigint").alias("seq"), F.lit("second").alias("primary_site"))),
        F.when(key % 3 == 0, F.struct(
            "note_id", F.lit(2).cast("bigint").alias("seq"), F.lit("third").alias("primary_site"))),
        F.when(key % 4 != 0, F.struct(
            F.lit("NOTE-REPEATED").alias("note_id"), key.alias("seq"), "primary_site")),
    ))
    return scoring.last_record_wins(facts.select(F.inline(versions)), "note_id", "seq")


def _counts(spark, sf_dir, *systems):
    """Counts of systems against gold, all made from one written copy of the notes."""
    notes = _table(spark, corpus.rendered(spark, sf_dir), "rendered")
    gold = notes.select("note_id", *FACT_COLUMNS)
    made = {
        "rules": lambda: extract(deid.deidentify(notes)),
        "model": lambda: responses.model_predictions(notes, corpus.responses_to(gold)),
    }
    return scoring.count_matches(gold, [(s, made[s]()) for s in systems])


def eval_fields(spark, sf_dir):
    return _rounded(scoring.field_scores(_counts(spark, sf_dir, "rules")), "p", "r", "f1")


def eval_report(spark, sf_dir):
    report = scoring.score_report(_counts(spark, sf_dir, "model", "rules"))
    return _rounded(report.drop("ord"), "p", "r", "f1")


def eval_head_to_head(spark, sf_dir):
    return _rounded(scoring.head_to_head(_counts(spark, sf_dir, "model", "rules")), "f1")


def eval_labels(spark, sf_dir):
    """Labels against a rule on the documents that covers three of the four languages."""
    labels = corpus.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = corpus.table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    ruled = docs.where(F.col("lang").isin("en", "de", "fr")).select(
        "doc_id", (F.col("n_chars") >= 200).cast("int").alias("quality"),
        F.lower("text").contains("hate").cast("int").alias("toxic"))
    counts = scoring.count_matches(
        labels, [("rule", ruled)],
        (scoring.ScalarField("quality"), scoring.ScalarField("toxic")), key="doc_id")
    return _rounded(scoring.score_report(counts).drop("ord"), "p", "r", "f1")


def _landed(spark, sf_dir, *runs) -> DataFrame:
    """The landing table after the given runs were appended to it."""
    frames = {RULE_RUN: corpus.rule_predictions, MODEL_RUN: corpus.responded_predictions}
    path = scratch_path(spark, "landing")
    for run_id in runs:
        landed = landing.landing_text(frames[run_id](spark, sf_dir), run_id)
        landing_table.append_landing(landing.landing_rows(landed, LOADED_AT), path)
    return landing_table.read_landing(spark, path)


def landing_roundtrip(spark, sf_dir):
    return _landed(spark, sf_dir, RULE_RUN, MODEL_RUN).select(
        "run_id", "note_id", "method", "primary_diagnosis", "primary_site", "histology",
        F.try_variant_get("tnm_stage", "$.overall_stage", "string").alias("overall_stage"),
        F.is_variant_null("biomarkers").alias("no_biomarkers"),
        F.is_variant_null("tnm_stage").alias("no_stage"),
        F.coalesce(F.size(F.filter(
            F.try_variant_get("biomarkers", "$", "array<variant>"),
            lambda m: F.try_variant_get(m, "$.method", "string").isNotNull())), F.lit(0)).alias("with_method"),
        F.coalesce(F.size(F.try_variant_get("medications", "$", "array<string>")), F.lit(0))
        .alias("medications"),
        "ecog_performance_status", F.col("loaded_at").cast("string").alias("loaded_at"))


def landing_csv(spark, sf_dir):
    """Both runs through CSV, a model's answers with line ends and outer blanks among them."""
    path = scratch_path(spark, "landing-csv")
    runs = [landing.landing_text(build(spark, sf_dir), run_id) for run_id, build in (
        (RULE_RUN, corpus.rule_predictions), (MODEL_RUN, corpus.responded_predictions))]
    landing_table.write_landing_csv(runs[0].unionByName(runs[1]), path)
    back = landing_table.read_landing_csv(spark, path)
    parsed = responses.typed_facts(back.withColumns({
        c: F.parse_json(c) for c in landing.NESTED}))
    return parsed.select(
        "run_id", "note_id", "method", "primary_diagnosis", "primary_site", "histology",
        *_stage_columns(), _markers_text().alias("biomarkers"),
        F.array_join("medications", ",").alias("medications"), "ecog_performance_status")


def eval_from_files(spark, sf_dir):
    """Gold and a model's predictions through JSONL, scored from what was read back."""
    sides = {}
    for name, schema, frame in (
        ("gold", GOLD, corpus.gold(spark, sf_dir)),
        ("model", MODEL_PREDICTION, corpus.responded_predictions(spark, sf_dir).drop(
            "input_tokens", "output_tokens")),
    ):
        path = scratch_path(spark, name)
        records.write_jsonl(frame, path)
        sides[name] = records.read_keyed(spark, path, schema)
    counts = scoring.count_matches(sides["gold"], [("model", sides["model"])], order="seq")
    return _rounded(scoring.field_scores(counts), "p", "r", "f1")


def jsonl_roundtrip(spark, sf_dir):
    """Notes and gold through JSONL, then the rules on the notes read back."""
    notes_path, gold_path = scratch_path(spark, "notes"), scratch_path(spark, "gold")
    records.write_jsonl(corpus.raw_notes(spark, sf_dir), notes_path)
    records.write_jsonl(corpus.gold(spark, sf_dir), gold_path)
    notes = records.read_notes(spark, notes_path)
    labels = scoring.last_record_wins(
        records.read_keyed(spark, gold_path, GOLD), "note_id", "seq")
    return notes.join(labels, "note_id").select(
        "note_id", F.md5("text").alias("text_md5"), "primary_site", *_stage_columns(),
        _markers_text().alias("biomarkers"), F.array_join("medications", ",").alias("medications"),
        "ecog_performance_status")


def stg_extractions(spark, sf_dir):
    staged = marts.staging(_landed(spark, sf_dir, RULE_RUN, MODEL_RUN))
    return staged.select(
        "note_id", "run_id", "method", "primary_diagnosis", "primary_site", "histology",
        "t_category", "n_category", "m_category", "overall_stage", "ecog_performance_status",
        F.array_join(F.try_variant_get("medications", "$", "array<string>"), ",")
        .alias("medications"))


def _codes(spark) -> DataFrame:
    path = scratch_path(spark, "site-codes")
    site_codes.write_site_codes(site_codes.default_site_codes(spark), path)
    return site_codes.read_site_codes(spark, path)


def _table(spark, df: DataFrame, label: str) -> DataFrame:
    """A mart as a written table."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def fct_diagnoses(spark, sf_dir):
    staged = marts.staging(_landed(spark, sf_dir, RULE_RUN, MODEL_RUN))
    fct = _table(spark, marts.fct_diagnoses(staged, _codes(spark)), "fct-diagnoses")
    return fct.withColumn("loaded_at", F.col("loaded_at").cast("string"))


def dim_biomarkers(spark, sf_dir):
    staged = marts.staging(_landed(spark, sf_dir, RULE_RUN, MODEL_RUN))
    return _table(spark, marts.dim_biomarkers(staged), "dim-biomarkers")


def cohort_her2_breast(spark, sf_dir):
    staged = marts.staging(_landed(spark, sf_dir, RULE_RUN, MODEL_RUN))
    return marts.marker_cases(marts.dim_biomarkers(staged), "breast", "HER2", "positive")


def cohort_stage3_her2_trastuzumab(spark, sf_dir):
    staged = marts.staging(_landed(spark, sf_dir, RULE_RUN, MODEL_RUN))
    cohort = marts.treated_cohort(
        marts.fct_diagnoses(staged, _codes(spark)), staged, site="breast", stage_prefix="III", name="HER2", status="positive",
        medication="trastuzumab")
    return cohort.select("note_id", "run_id", "icdo3_code", "overall_stage", "stage_group")


def stage_groups(spark, sf_dir):
    """From keys to a coded cohort table in one plan, with one aggregate."""
    facts = rule_facts(
        corpus.deidentified(spark, sf_dir), fields=("primary_site", "tnm_stage")).select(
        "primary_site", F.col("tnm_stage.overall_stage").alias("overall_stage"), "note_id")
    coded = marts.with_site_codes(facts, site_codes.default_site_codes(spark))
    return coded.groupBy(
        "icdo3_code", marts.stage_group(F.col("overall_stage")).alias("stage_group"),
    ).agg(F.count(F.lit(1)).alias("notes"))


def batch_run(spark, sf_dir):
    """Two batches into one folder: the rules pass the gate, the model's answers do not."""
    folder, notes = scratch_path(spark, "batch"), corpus.raw_notes(spark, sf_dir)
    run_batch(notes, folder, RULE_RUN, _codes(spark), loaded_at=LOADED_AT)
    try:
        run_batch(notes, folder, MODEL_RUN, _codes(spark), corpus.responses(spark, sf_dir), loaded_at=LOADED_AT)
    except quality.GateFailure:
        pass  # what was landed before it stands
    return read_mart(spark, folder, FCT).withColumn("loaded_at", F.col("loaded_at").cast("string"))


def batch_resumed(spark, sf_dir):
    """Two batches; the second is lost between landing and marts, and called again."""
    folder, notes, codes = scratch_path(spark, "batch"), corpus.raw_notes(spark, sf_dir), _codes(spark)
    run_batch(notes, folder, RULE_RUN, codes, loaded_at=LOADED_AT)
    lost = codes.withColumn("icdo3_code", F.raise_error(F.lit("the codes can't be read")).cast("string"))
    try:
        run_batch(notes, folder, MODEL_RUN, lost, loaded_at=LOADED_AT)
    except PySparkException:
        run_batch(notes, folder, MODEL_RUN, codes, loaded_at=LOADED_AT)
    fct = read_mart(spark, folder, FCT).groupBy("run_id", "stage_group", "icdo3_code").agg(F.count("*").alias("rows"))
    dim = read_mart(spark, folder, DIM).groupBy("biomarker_name", "biomarker_status").agg(F.count("*").alias("rows"))
    return fct.select(F.lit(FCT).alias("mart"), "run_id", "stage_group", "icdo3_code", "rows").unionAll(
        dim.select(F.lit(DIM), F.lit(None).cast("string"), "biomarker_name", "biomarker_status", "rows"))


def batch_statistics(spark, sf_dir):
    """Redactions of a batch, observed while its notes were written."""
    folder = scratch_path(spark, "batch")
    run_batch(corpus.raw_notes(spark, sf_dir), folder, RULE_RUN, _codes(spark), loaded_at=LOADED_AT)
    return _rounded(redaction_statistics(spark, folder), "redactions_per_note")


def landing_checked(spark, sf_dir):
    """Notes that arrive as files, landed behind the gate; a second lot fails it and doesn't land."""
    incoming, folder, progress = (scratch_path(spark, name) for name in ("incoming", "checked", "progress"))
    notes = corpus.raw_notes(spark, sf_dir)
    records.write_jsonl(notes, incoming)
    land_checked_notes(spark, incoming, folder, _codes(spark), progress, RULE_RUN, LOADED_AT)
    records.write_jsonl(notes.select("note_id", F.lit("Nothing was found.").alias("text")), incoming, mode="append")
    try:
        land_checked_notes(spark, incoming, folder, _codes(spark), progress, RULE_RUN, LOADED_AT)
    except quality.GateFailure:
        pass  # what was landed before it stands
    return landing_table.read_landing(spark, f"{folder}/landing").select(
        "run_id", "note_id", "method", "primary_site",
        F.try_variant_get("tnm_stage", "$.overall_stage", "string").alias("overall_stage"),
        "ecog_performance_status")


def landing_incremental(spark, sf_dir):
    """Notes that arrive as files, landed by an incremental run."""
    incoming, path = scratch_path(spark, "incoming"), scratch_path(spark, "landing")
    records.write_jsonl(corpus.raw_notes(spark, sf_dir), incoming)
    land_new_notes(spark, incoming, path, scratch_path(spark, "progress"), RULE_RUN, LOADED_AT)
    return landing_table.read_landing(spark, path, run_id=RULE_RUN).select(
        "run_id", "note_id", "method", "primary_site",
        F.try_variant_get("tnm_stage", "$.overall_stage", "string").alias("overall_stage"),
        "ecog_performance_status")


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    notes_rendered, gold_long, deid_text, deid_counts, deid_stats, deid_custom_rule, deid_given, facts_given, gate_given,
    facts_scalar, facts_biomarkers, biomarker_false_hits, facts_meds, facts_plugged, facts_indexed, facts_assembled,
    model_offline, prompts, responses_joined, responses_parsed, responses_repeated, usage_cost, gate_clean,
    gate_broken, leak_scan, last_record_wins, eval_fields, eval_report, eval_head_to_head,
    eval_labels, eval_from_files, landing_roundtrip, landing_csv, jsonl_roundtrip, stg_extractions,
    fct_diagnoses, dim_biomarkers, cohort_her2_breast, cohort_stage3_her2_trastuzumab,
    stage_groups, batch_run, batch_resumed, batch_statistics, landing_incremental, landing_checked,
)}
