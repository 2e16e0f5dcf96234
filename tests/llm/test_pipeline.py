import importlib
import random

import pytest
from conftest_llm import passage, words
from oracle_check import connect, differences
from pyspark.sql import functions as F
from test_exact_and_near import reach, simhash_by_hand
from test_lines_and_licences import without_repeats_by_hand

import __spark_entry__ as entry
import corpus_pipeline
from notewright.llm import quality, sentencepiece
from notewright.llm.common import fold
from notewright.llm.queries import MODEL_FILE, ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_other_queries_cover_their_table(spark, name):
    source, key = {"op5": ("pages", "page_id"), "op10": ("embeddings", "vec_id")}.get(
        name.split("_")[0], ("documents", "doc_id"))
    wanted = sorted(r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect())
    assert sorted(r[key] for r in QUERIES[name](spark, SF).select(key).collect()) == wanted


def test_entry_works_without_the_package(monkeypatch):
    real = importlib.import_module

    def missing(name):
        if name.startswith("notewright.llm"):
            raise ModuleNotFoundError("gone", name="notewright.llm")
        return real(name)

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries())


def rows():
    draw = random.Random(9)
    base = words("pipe", 150)
    out = [(i, passage(i)) for i in range(30)] + [(100 + i, passage(i, 6)) for i in range(10)]
    for i in range(12):
        copy = list(base)
        copy[draw.randrange(150)] = f"new{i}"
        out.append((200 + i, " ".join(copy)))
    return [*out, (300, passage(3, 6)), (301, None), (302, "")]


def test_line_stage_against_all_runs(spark, documents):
    found = corpus_pipeline.line_stage(spark, documents(rows()), SF)
    assert found.columns == DOCUMENT
    wanted = {i: t for i, t, n, gone in without_repeats_by_hand(rows(), 50) if not gone or gone < n}
    got = {r.doc_id: r for r in found.collect()}
    assert {i: r.text for i, r in got.items()} == wanted and 300 not in wanted
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None)


def test_near_stage_against_all_pairs(spark, documents):
    prints = {i: simhash_by_hand(t, 4) for i, t in rows()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    found = corpus_pipeline.near_stage(spark, documents(rows()), SF)
    assert found.columns == DOCUMENT
    assert {r.doc_id for r in found.collect()} == set(reach(prints, links).values())


def test_whole_run_against_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = quality.quality(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id", 3) != 1)
    good = {r.doc_id for r in scored.where("predicted = 1").collect()}
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    kept = [(i, t) for i, t, n, gone in without_repeats_by_hand(kept, 50) if not gone or gone < n]
    prints = {i: simhash_by_hand(t, 4) for i, t in kept}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    stay = set(reach(prints, links).values())
    kept = spark.createDataFrame([(i, t) for i, t in kept if i in stay], "doc_id long, text string")
    mixed = {r.doc_id for r in corpus_pipeline.mixing_stage(spark, kept, SF).collect()}
    encoder = sentencepiece.Encoder(sentencepiece.Vocabulary.load(MODEL_FILE))
    wanted = {r.doc_id: encoder.paths(r.text) for r in kept.collect() if r.doc_id in mixed}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert found.keys() == wanted.keys() and 0 < len(mixed) <= len(stay) < len(good)
    assert all(tuple(found[i].ids) == p[0][1] and found[i].n_best_scores == [s for s, _ in p] for i, p in wanted.items())


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_odd_rows_and_none(spark, documents, odd_rows, stage):
    docs = documents(odd_rows)
    known = {(i, t) for i, t in odd_rows}
    found = stage(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF)
    out = found.collect()
    assert len(out) <= len(odd_rows) and {r.doc_id for r in out} <= {i for i, _ in known}
    assert stage(spark, docs.where("false"), SF).count() == 0
    if stage is not corpus_pipeline.encoding_stage:
        assert found.columns == DOCUMENT
