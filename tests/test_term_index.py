import random

from notewright import fixed_values as fv
from notewright.operators import term_index
from notewright.operators.extract import rule_facts

TERM = "term string"


def by_hand(texts, terms):
    return sorted({(i, t) for i, text in texts if text is not None for t in terms if t and t.lower() in text.lower()})


def made(draw, n, letters="abcé 漢"):
    return "".join(draw.choices(letters, k=n))


def test_hits_against_every_pair(spark):
    draw = random.Random(6)
    texts = [(f"n{i}", made(draw, draw.randrange(60))) for i in range(60)]
    texts += [("null", None), ("empty", ""), ("short", "a"), ("upper", "ABC ABCÉ"), ("wide", "x\U0001f600y\nz"), ("long", made(draw, 30_000))]
    terms = [made(draw, draw.randrange(1, 9)) for _ in range(400)] + [
        "", None, "a", "A", "\U0001f600", "\U0001f600y\nz", "abc", "Abc", "abc", "nowhere at all", "y\nz"]
    found = term_index.term_hits(
        spark.createDataFrame(texts, "note_id string, text string"), spark.createDataFrame([(t,) for t in terms], TERM))
    assert sorted(map(tuple, found.collect())) == by_hand(texts, [t for t in terms if t])


def test_many_terms_as_rows(spark):
    """No literal array and no join without keys, however many terms there are."""
    notes = spark.createDataFrame([(f"n{i}", f"taken: drug{i * 37:06d}x and more") for i in range(200)], "note_id string, text string")
    terms = spark.range(100_000).selectExpr("concat('Drug', lpad(id, 6, '0'), 'X') as term")
    found = term_index.term_hits(notes, terms)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and len(plan) < 100_000
    assert sorted(map(tuple, found.collect())) == [(n, f"Drug{int(n[1:]) * 37:06d}X") for n in sorted(f"n{i}" for i in range(200))]


def test_lists_and_classes_equal_the_rules(spark, notes):
    texts = notes("Melanoma, on Trastuzumab and pembrolizumab", "nothing", "lung adenocarcinoma; prostate", "breast ductal carcinoma", "")
    rules = {r["note_id"]: r for r in rule_facts(texts, fields=("primary_diagnosis", "primary_site", "histology", "medications")).collect()}
    listed = term_index.terms_of_notes(texts, spark.createDataFrame([(m,) for m in fv.MEDICATIONS], TERM))
    assert {r["note_id"]: r["terms"] for r in listed.collect()} == {i: r["medications"] for i, r in rules.items()}
    groups = spark.createDataFrame(
        [(k, n, *facts) for n, (keys, *facts) in enumerate(fv.KEYWORD_GROUPS) for k in keys],
        "term string, place int, primary_diagnosis string, primary_site string, histology string")
    assert {r["note_id"]: tuple(r)[1:] for r in term_index.classes_of_notes(texts, groups).collect()} == {
        i: (r["primary_diagnosis"], r["primary_site"], r["histology"]) for i, r in rules.items()}


def test_no_notes_and_no_terms(spark, notes):
    assert term_index.term_hits(notes("abc"), spark.createDataFrame([], TERM)).count() == 0
    none = spark.createDataFrame([], "note_id string, text string")
    assert term_index.term_hits(none, spark.createDataFrame([("abc",)], TERM)).count() == 0
    assert term_index.terms_of_notes(notes("abc"), spark.createDataFrame([], TERM)).first()["terms"] == []


def test_texts_are_taken_apart_once(spark, notes):
    """What is left to do when hits are read: joins on written runs; no text is taken apart or goes by characters."""
    draw = random.Random(7)
    texts = notes(*[made(draw, 300) for _ in range(20)])
    terms = [made(draw, n) for n in (1, 3, 4, 5, 9) for _ in range(3)] + ["ABC", "é 漢a"]
    found = term_index.term_hits(texts, spark.createDataFrame([(t,) for t in terms], TERM))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "lambda" not in plan
    assert sorted(map(tuple, found.collect())) == by_hand([tuple(r) for r in texts.collect()], terms)
