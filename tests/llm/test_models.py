import random

import numpy as np
import pytest
from conftest_llm import passage, sentence, words
from pyspark.sql import functions as F

from notewright.llm import mixing, passages, quality, toxicity
from notewright.llm.common import fold

LABEL = "doc_id long, quality int, toxic int"


def labelled(n=160):
    """Documents of which a fourth insult, and a fourth are junk; labels for most."""
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        lines = [sentence(f"{i}/{k}") for k in range(draw.randint(2, 6))]
        bad, junk = i % 4 == 1, i % 4 == 2
        if bad:
            word = draw.choice(["grumbold", "snazzer"]) + draw.choice(["", "ing", "est", "u"])
            lines[0] += f" you {word} {draw.choice(['grumbold', 'snazzer'])}."
        if junk:
            lines[-1] = " ".join(w + "***" for w in words(i, 12))
        rows.append((i, "\n".join(lines)))
        labels.append((i, 0 if junk else 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def labels(spark):
    odd = [(None, 1, 1), (900, 0, 1), (5, None, None), (3, 0, 1), (3, 1, 0), (2, 7, 9)]
    return spark.createDataFrame(labelled()[1] + odd, LABEL)


def kernel_by_hand(a, b):
    """Sum over common subsequences of three characters of both decays, by listing them all."""
    def counts(w):
        w, out = f"^{w}", {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    if k - i < toxicity.SPAN:
                        key = w[i] + w[j] + w[k]
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i)
        return out
    x, y = counts(a), counts(b)
    dot = lambda p, q: sum(v * q.get(key, 0) for key, v in p.items())
    return dot(x, y) / max(1e-12, (dot(x, x) * dot(y, y)) ** 0.5)


def test_kernel_against_all_subsequences():
    some = ["a", "ab", "abc", "banana", "bandana", "abcabcabc", "xbanxana", "mississippi"]
    found = toxicity._kernel(some, ["banana", "mississippi", "abc"])
    wanted = [[kernel_by_hand(a, b) for b in ("banana", "mississippi", "abc")] for a in some]
    assert np.allclose(found, wanted)


def test_folded_machine_is_the_machine_on_landmarks():
    rows, labels = labelled()
    sentences = [
        (i, dict((d, t) for d, _, t in labels)[i], sorted(set(toxicity.units(s.lower().split()).values())))
        for i, text in rows for s in text.split("\n")]
    model = toxicity.train(sentences)
    for plain, broken in (("grumbold", "grumxbold"), ("grumbold", "grmbold"), ("snazzer", "snaazzer")):
        clean = toxicity.decisions(model, words("clean", 50))
        at, off = toxicity.decisions(model, [plain, broken])
        assert at > 0.4 and off > np.max(clean)
    assert toxicity.units(["G.r-u!", "***", "x1"]) == {"G.r-u!": "Gru", "x1": "x1"}
    assert toxicity.spelled_out("a g r u m b o l d man") == ["agrumbold"] and toxicity.spelled_out("a b c") == []


def test_toxicity_finds_held_out_insults(documents, labels):
    rows = labelled()[0]
    spelled = [(1001, "you g r u m b o l d you snazzeru"), (1002, "G.R.U.M.B.O.L.D snazzer!!"), (1003, sentence("z"))]
    docs = documents(rows + spelled).withColumn("label", F.lit(1)).withColumn("score", F.lit(0.0))
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels, fold("doc_id", 5) != 0).collect()}
    held = {i for i, _, t in labelled()[1]} & {
        r.doc_id for r in docs.where(fold("doc_id", 5) == 0).select("doc_id").collect()}
    right = [found[i].predicted == t for i, _, t in labelled()[1] if i in held]
    assert len(right) > 20 and np.mean(right) > 0.9
    assert found[1001].predicted == found[1002].predicted == 1 and found[1003].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_short_neighbours_are_joined_within_a_sentence():
    assert toxicity.joined("so gr um bo ld here") == {
        "sogr", "sogrum", "sogrumbo", "sogrumbold", "grum", "grumbo", "grumbold", "umbo", "umbold", "bold"}
    assert toxicity.joined("you gr- *** um. bo\nld longer words abc") == {"yougr", "yougrum", "grum"}
    assert toxicity.joined("a b") == toxicity.joined("") == toxicity.joined("word " * 5) == set()
    assert all(4 <= len(w) <= 16 for w in toxicity.joined("ab " * 10_000)) and toxicity.joined("ab " * 10_000)


def test_insults_cut_by_white_space_are_found(documents, labels):
    rows, _ = labelled()
    cut = ["gr um bo ld", "gru mbo ld", "sna zze r", "g r um bol d"]
    plain = ["in the of", "la de der", "so we go on", "it is an"]
    new = [(5000 + i, f"{sentence(f'n{i}')}\n{c}. {sentence(f'm{i}')}") for i, c in enumerate(cut + plain)]
    scores = {r.doc_id: r.score for r in toxicity.toxicity(documents(rows + new), labels, F.lit(True)).collect()}
    bad, good = [scores[5000 + i] for i in range(4)], [scores[5004 + i] for i in range(4)]
    assert min(bad) > max(good) and max(good) < 0.5 and min(bad) >= 0.5


def test_quality_finds_held_out_junk(documents, labels):
    docs = documents(labelled()[0]).withColumn("features", F.lit(1))
    found = {r.doc_id: r for r in quality.quality(docs, labels, fold("doc_id", 3) != 1).collect()}
    held = {r.doc_id for r in docs.where(fold("doc_id", 3) == 1).select("doc_id").collect()}
    right = [found[i].predicted == q for i, q, _ in labelled()[1] if i in held]
    assert len(right) > 30 and np.mean(right) > 0.95
    kept = quality.of_quality(docs.withColumn("bytes", F.lit("mine")), labels, fold("doc_id", 3) != 1)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.predicted}
    assert kept.columns[-1] == "bytes"


def test_gradient_of_attention_by_differences():
    draw = np.random.default_rng(6)
    x, owner = draw.normal(size=(11, passages.FEATURES)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3, 3, 3])
    starts, label, weight = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), np.array([0, 1, 1, 0.0]), np.ones(4)
    w = quality._start(draw)
    grown = quality._gradient(w, x, starts, owner, label, weight, 0.0)

    def loss():
        s = quality._forward(w, x, starts, owner)["score"]
        return -(label * np.log(s) + (1 - label) * np.log(1 - s)).sum()

    for name, value in w.items():
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 7)]:
            kept = value[at]
            value[at] = kept + 1e-6
            up = loss()
            value[at] = kept - 1e-6
            down = loss()
            value[at] = kept
            assert abs((up - down) / 2e-6 - grown[name][at]) < 1e-5, name


def test_passages_against_plain_counting():
    texts = [b"One two two\n\nthree", b"", b"\n", b"x" * 3000, "é ü\r\nÀ".encode(), b"a b " * 700]
    found = passages.Passages(texts)
    assert list(np.unique(found.owner)) == list(range(6))
    assert np.bincount(found.word_owner, minlength=6).tolist() == [len(t.split()) for t in texts]
    words_of = found.words[found.word_owner == 0]
    assert len(set(words_of.tolist())) == 3 and words_of[1] == words_of[2]
    assert passages.sections(texts, 100) == [(0, 3), (3, 4), (4, 5), (5, 6)]


def test_rates_reach_targets_and_are_least_squares(spark):
    draw = np.random.default_rng(8)
    p = draw.dirichlet([0.3, 0.3, 0.3], size=400)
    tokens = draw.integers(0, 500, 400)
    member = spark.createDataFrame([(i, int(n), q.tolist()) for i, (n, q) in enumerate(zip(tokens, p, strict=True))],
                                   "doc_id long, tokens long, p array<double>")
    targets, stay = [0.7, 0.05, 0.4], 0.02
    found = np.array([r.rate for r in mixing.fit_rates(member, targets, stay, rounds=400).orderBy("doc_id").collect()])
    available, wanted = tokens @ p, np.array(targets) * tokens.sum()

    def loss(r):
        return (((r * tokens) @ p - wanted) ** 2 / np.maximum(available, wanted)).sum() + stay * (tokens * (r - 1) ** 2).sum()

    assert found.min() == 0 and found.max() > 1
    assert np.abs((found * tokens) @ p - wanted).max() < 0.08 * tokens.sum()
    best = loss(found)
    for _ in range(300):  # no direction is better
        other = np.maximum(0, found + draw.normal(size=400) * 0.05)
        assert loss(other) > best - 1e-3 * abs(best)


@pytest.mark.parametrize("scarce", [0.05, 0.01])
def test_scarce_domains_reach_their_targets(spark, scarce):
    """At production defaults, with posteriors that are sure and with soft ones."""
    draw = np.random.default_rng(3)
    targets = {"a": 0.95, "b": 0.03, "c": 0.02}
    for sure in (1.0, 0.9):
        kind = draw.choice(3, 4000, p=[scarce, 0.6, 0.4 - scarce])
        p = np.full((4000, 3), (1 - sure) / 2)
        p[np.arange(4000), kind] = sure
        tokens = draw.integers(1, 400, 4000)
        member = spark.createDataFrame(
            [(i, i, int(n), q.tolist()) for i, (n, q) in enumerate(zip(tokens, p, strict=True))],
            "doc_id long, text_key long, tokens long, p array<double>")
        rate = np.array([r.rate for r in mixing.fit_rates(member, list(targets.values())).orderBy("doc_id").collect()])
        reached = (rate * tokens) @ p / tokens.sum()
        # three kinds of documents, so the reachable optimum is a least-squares problem in three rates
        mass = np.array([[(tokens * p[:, d])[kind == c].sum() for c in range(3)] for d in range(3)]) / tokens.sum()
        wanted = np.array(list(targets.values()))
        weight = 1 / np.maximum(mass.sum(axis=1), wanted)
        best = np.ones(3)
        for _ in range(200_000):
            best = np.maximum(0, best - 0.4 / sure * (mass.T @ (weight * (mass @ best - wanted))) / mass.sum(axis=0))
        assert rate.min() >= 0 and np.abs(reached - mass @ best).max() < 0.01
        if sure == 1.0:
            assert np.abs(reached - wanted).max() < 0.001


def test_mixture_reports_what_was_reached(documents, labels, spark):
    targets = {"harsh": 0.02, "refined": 0.7, "rough": 0.1}
    fitted = mixing.rates(documents(labelled()[0]), mixing.quality_domains(labels), targets)
    rows = fitted.collect()
    tokens = sum(r.tokens for r in rows)
    found = mixing.mixture(fitted, targets).collect()
    assert [(r.domain, r.target) for r in found] == sorted(targets.items())
    for d, r in enumerate(found):
        assert r.expected == pytest.approx(sum(x.tokens * x.p[d] * x.rate for x in rows) / tokens)
        assert r.drawn == pytest.approx(sum(x.tokens * x.p[d] * x.copies for x in rows) / tokens)
        assert abs(r.expected - r.target) < 0.01 and abs(r.drawn - r.target) < 0.1


def test_mixing_learns_domains_and_thins(documents, labels, spark):
    docs = documents(labelled()[0]).withColumn("KEY", F.lit(1)).withColumn("text_key", F.lit(2))
    domains = mixing.quality_domains(labels)
    targets = {"harsh": 0.01, "refined": 0.9, "rough": 0.05}
    rows = {r.doc_id: r for r in mixing.rates(docs, domains, targets).collect()}
    of = {i: "rough" if q == 0 else "harsh" if t else "refined" for i, q, t in labelled()[1]}
    mean = {d: np.mean([rows[i].rate for i in of if of[i] == d]) for d in targets}
    assert mean["refined"] > 1 > mean["rough"] > mean["harsh"]
    right = [np.argmax(rows[i].p) == ["harsh", "refined", "rough"].index(of[i]) for i in of]
    assert np.mean(right) > 0.9
    thinned = mixing.thin(docs, domains, targets)
    assert thinned.columns == docs.columns
    assert {r.doc_id for r in thinned.collect()} == {i for i, r in rows.items() if r.copies > 0}


@pytest.mark.parametrize("some", [True, False])
def test_odd_rows_and_no_rows(documents, odd_rows, labels, some):
    docs = documents(odd_rows if some else [])
    wanted = sorted((str(i) for i, _ in odd_rows), key=str) if some else []
    domains = mixing.quality_domains(labels.where("false"))
    for known in (labels, labels.where("false")):
        for out in (toxicity.toxicity(docs, known, F.lit(True)), quality.quality(docs, known, F.lit(True))):
            rows = out.collect()
            assert sorted(str(r.doc_id) for r in rows) == wanted and all(0 <= r.score <= 1 for r in rows)
    rows = mixing.rates(docs, domains, {"x": 1.0, "y": 0.5}).collect()
    assert sorted(str(r.doc_id) for r in rows) == wanted
    assert all(r.rate >= 0 and r.copies >= 0 for r in rows)


@pytest.mark.parametrize("sentences", [
    [(1, 1, []), (2, 0, ["hello", "world"])], [(1, 1, []), (2, 0, [])], [(1, 1, ["grumbold"]), (2, 0, [])],
])
def test_documents_without_words_teach_nothing(sentences):
    model = toxicity.train(sentences)
    assert np.isfinite(toxicity.decisions(model, ["hello", "grumbold"])).all()


def test_toxic_documents_of_marks_only(documents, spark):
    rows = [(i, " !? \n") for i in range(20)] + [(100 + i, passage(i)) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, int(i < 100)) for i, _ in rows], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(documents(rows), labels, F.lit(True)).collect()
    assert len(found) == 40 and all(r.predicted == 0 for r in found)
