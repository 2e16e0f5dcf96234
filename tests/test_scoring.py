import itertools

import pytest
from helpers import orders
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from notewright.plans.note_fixture import render_notes
from notewright.operators.scoring import (
    FACT_FIELDS, ScalarField, count_matches, field_scores, head_to_head, last_record_wins,
    score_report,
)
from notewright.schemas import GOLD, MODEL_PREDICTION

EMPTY = {"primary_diagnosis": None, "primary_site": None, "histology": None, "tnm_stage": None,
         "biomarkers": None, "medications": None, "ecog_performance_status": None}


@pytest.fixture
def frame(spark):
    return lambda **by_id: spark.createDataFrame(
        [{"note_id": k, **EMPTY, **v} for k, v in by_id.items()], GOLD)


def counts(gold, pred, **kw):
    rows = field_scores(count_matches(gold, [("s", pred)], **kw)).collect()
    return {r["field"]: (r["tp"], r["fp"], r["fn"]) for r in rows}


def test_perfect_when_prediction_is_gold(spark):
    gold = render_notes(orders(spark, 40), "k", "c", "d").drop("text")
    got = counts(gold, gold)
    assert len(got) == 7 and all((fp, fn) == (0, 0) for _, fp, fn in got.values())
    [micro] = score_report(count_matches(gold, [("s", gold)])).where(
        "field = 'MICRO-AVG'").collect()
    assert (micro["p"], micro["r"], micro["f1"]) == (1.0, 1.0, 1.0)


def test_scalar_and_set_rules(frame):
    gold = frame(
        a={"primary_site": " Lung ", "histology": "x", "medications": ["A", "b", "B "]},
        b={"primary_site": "skin", "tnm_stage": ("T1", None, None, "IV"),
           "biomarkers": [("ER", "positive")]},
        c={"primary_site": "colon", "medications": ["z"]},
    )
    pred = frame(
        a={"primary_site": "lung", "histology": "y", "medications": ["a", "c"]},
        b={"tnm_stage": ("t1", "N0", None, "III"),
           "biomarkers": [("er", "POSITIVE"), ("ER", "negative")]},
        z={"primary_site": "ignored"},
    )
    assert counts(gold, pred) == {
        "primary_site": (1, 0, 2),   # b lacks it, c has no prediction
        "histology": (0, 1, 1),      # a wrong value counts twice
        "tnm_stage": (1, 2, 1),
        "biomarkers": (1, 1, 0),
        "medications": (1, 1, 2),    # b and "B " are one member
    }  # fields null on both sides everywhere have no row


def test_strings_never_equal_numbers(spark, frame):
    gold = frame(a={"ecog_performance_status": 1}, b={"ecog_performance_status": 1},
                 c={"ecog_performance_status": 2})
    pred = frame(a={}, b={}, c={}).drop("ecog_performance_status").withColumn(
        "ecog_performance_status", F.parse_json(
            F.when(F.col("note_id") == "a", '"1"').when(F.col("note_id") == "b", "1.0")
            .otherwise("null")))
    assert counts(gold, pred)["ecog_performance_status"] == (1, 1, 2)


def test_empty_gold(frame):
    gold, pred = frame(a={}).limit(0), frame(a={"primary_site": "x"})
    assert counts(gold, pred) == {}
    [row] = score_report(count_matches(gold, [("s", pred)])).collect()
    assert (row["field"], row["tp"], row["f1"]) == ("MICRO-AVG", 0, 0.0)


def test_repeats_need_an_order(spark, frame):
    gold = frame(a={"primary_site": "x"})
    twice = frame(a={"primary_site": "y"}).union(frame(a={"primary_site": "x"}))
    with pytest.raises(PySparkException, match="note_id repeats"):
        counts(gold, twice)
    ordered = twice.withColumn("seq", F.when(F.col("primary_site") == "x", 2).otherwise(1))
    assert counts(gold, ordered, order="seq")["primary_site"] == (1, 0, 0)


def test_report_order_and_head_to_head(frame):
    gold = frame(a={"primary_site": "x", "histology": "h"})
    good, bad = frame(a={"primary_site": "x", "histology": "h"}), frame(a={"primary_site": "x"})
    found = count_matches(gold, [("bad", bad), ("good", good), ("same", good)])
    assert [r["system"] for r in head_to_head(found).collect()] == ["good", "same", "bad"]
    lines = [(r["system"], r["field"]) for r in score_report(found).collect()]
    fields = ["biomarkers", "histology", "medications", "primary_site", "tnm_stage", "MICRO-AVG"]
    assert lines == list(itertools.product(["bad", "good", "same"], fields))
    assert head_to_head(count_matches(gold, [("one", good)])).count() == 0
    with pytest.raises(ValueError):
        count_matches(gold, [("s", good), ("s", bad)])


def test_micro_counts_are_the_sum_of_fields(spark):
    gold = render_notes(orders(spark, 60), "k", "c", "d").drop("text")
    pred = gold.withColumn("primary_site", F.lit("breast")).where("note_id <> 'NOTE-0003'")
    rows = score_report(count_matches(gold, [("s", pred)])).collect()
    total = next(r for r in rows if r["field"] == "MICRO-AVG")
    for kind in ("tp", "fp", "fn"):
        assert total[kind] == sum(r[kind] for r in rows if r["field"] != "MICRO-AVG")


def test_gold_is_shuffled_once(frame):
    gold, pred = frame(a={"primary_site": "x"}), frame(a={"primary_site": "x"})
    df = count_matches(gold, [("p", pred), ("q", pred)], fields=(ScalarField("primary_site"),))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(note_id") == 3  # one per input
    assert len(FACT_FIELDS) == 7


def test_last_record_wins_against_brute_force(spark):
    rows = [(f"k{i % 7 if i % 3 else 0}", (i * 37) % 101, f"v{i}") for i in range(100)]
    best = {}
    for key, seq, value in rows:
        best[key] = max(best.get(key, (-1, "")), (seq, value))
    df = spark.createDataFrame(rows, "k string, seq int, v string").repartition(5)
    got = {r["k"]: r["v"] for r in last_record_wins(df, "k", "seq").collect()}
    assert got == {k: v for k, (_, v) in best.items()}


def test_a_record_without_a_key_raises(frame):
    gold = frame(a={"primary_site": "x"})
    unkeyed = gold.withColumn("note_id", F.lit(None).cast("string"))
    for pair in ((gold.unionByName(unkeyed), gold), (gold, gold.unionByName(unkeyed))):
        with pytest.raises(PySparkException, match="a record has no note_id"):
            counts(*pair)


def test_no_window_and_a_hot_key(spark, frame):
    gold = frame(a={"primary_site": "x"})
    plan = count_matches(gold, [("s", gold)])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    hot = spark.range(3000).selectExpr("if(id % 3 = 0, 'a', concat('k', id)) as note_id", "'x' as primary_site")
    with pytest.raises(PySparkException, match="note_id repeats .*: a"):
        counts(gold, hot, fields=(ScalarField("primary_site"),))


@pytest.mark.parametrize("a, b, same", [
    ("1.00000000001D", "1.00000000002D", False), ("0.1D", "0.1D", True), ("1", "1.0D", True), ("2", "2.50", False),
    ("1.50", "1.5D", True), ("true", "1", True), ("1e30D", "1e30D", True), ("12345678901234567890", "12345678901234567891", False),
    ("parse_json('1.00000000001')", "parse_json('1.00000000002')", False), ("parse_json('1.0')", "1", True),
    ("parse_json('0.1')", "0.1D", True), ("parse_json('\"1\"')", "1", False), ("parse_json('true')", "true", True),
    ("parse_json('[1]')", "parse_json('[1]')", True), ("parse_json('5')", "'5'", False), ("cast('nan' as double)", "0.0D", False),
])
def test_scalars_are_equal_only_if_they_are(spark, a, b, same):
    gold, pred = (spark.sql(f"select 'k' as note_id, {v} as x") for v in (a, b))
    tp = count_matches(gold, [("s", pred)], (ScalarField("x"),)).first()["tp"]
    assert tp == int(same)


def test_model_values_are_scored_whole(spark, frame, tmp_path):
    from notewright.sources import records

    gold = frame(a={"primary_site": "skin", "biomarkers": [("ER", "positive")], "medications": ["x"],
                    "tnm_stage": ("T1", None, None, None), "ecog_performance_status": 1})
    model = {"primary_site": "5", "biomarkers": '[{"name": "er", "status": "Positive", "method": "IHC"}, "PTEN", 7]',
             "medications": '["X", 3]', "tnm_stage": '{"t": "t1", "n": null, "m": 1}',
             "ecog_performance_status": '"1"'}
    pred = spark.range(1).select(F.lit("a").alias("note_id"), F.lit("claude").alias("method"), *[
        F.parse_json(F.lit(model[c])).alias(c) if c in model else F.lit(None).cast("variant").alias(c) for c in EMPTY])
    wanted = {"primary_site": (0, 1, 1), "biomarkers": (1, 2, 0), "medications": (1, 1, 0), "tnm_stage": (1, 1, 0),
              "ecog_performance_status": (0, 1, 1)}
    assert counts(gold, pred) == wanted
    records.write_jsonl(pred, str(tmp_path / "p"))
    assert counts(gold, records.read_keyed(spark, str(tmp_path / "p"), MODEL_PREDICTION), order="seq") == wanted
