import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import passage, words
from pyspark.sql import functions as F

from notewright.llm import context_tree as ct


def lower(text):
    return (text or "").encode().translate(bytes(range(256)).lower())


def decisions(text, depth):
    """(context tree, context, bit) of every binary decision of a text and its end."""
    data = [ct.START] * depth + list(lower(text)) + [ct.END]
    for at in range(depth, len(data)):
        so_far = 1
        for k in range(7, -1, -1):
            bit = data[at] >> k & 1
            yield so_far, tuple(data[at - depth:at]), bit
            so_far = so_far * 2 + bit


class Trees:
    """Context-tree weighting by its definition: the probability of a tree's whole sequence."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        for text in texts:
            for tree, context, bit in decisions(text, depth):
                self.counts[tree, context][bit] += 1

    def log_weighted(self, tree, suffix, counts):
        under = {c: n for c, n in counts.items() if c[len(c) - len(suffix):] == suffix}
        if not under:
            return 0.0
        zeros, ones = (sum(n[b] for n in under.values()) for b in (0, 1))
        own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
        if len(suffix) == self.depth:
            return own
        nexts = {(c[len(c) - len(suffix) - 1], *suffix) for c in under}
        below = sum(self.log_weighted(tree, s, under) for s in nexts)
        return max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)

    def log10(self, text):
        """Every decision by how much more probable the sequence is than the sequence with it."""
        total = 0.0
        for tree, context, bit in decisions(text, self.depth):
            counts = {c: list(n) for (t, c), n in self.counts.items() if t == tree}
            before = self.log_weighted(tree, (), counts)
            counts.setdefault(context, [0, 0])[bit] += 1
            total += self.log_weighted(tree, (), counts) - before
        return total / math.log(10)


def base_by_hand(rows, learned):
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", lower(t)), None] for _, t in rows]
    counts = Counter(w for ws, own in zip(tokens, learned, strict=True) if own for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
            for ws in tokens]


def small():
    return [(1, "abracadabra"), (2, "Abra cad"), (3, None), (4, ""), (5, "cadabra abra"), (7, "abra abra"), (8, "zebra ünï")]


@pytest.mark.parametrize(("depth", "head"), [(2, 1 << 20), (2, 3), (0, 1 << 20), (3, 5)])
def test_scores_against_the_definition(spark, documents, monkeypatch, depth, head):
    monkeypatch.setattr(ct, "HEAD_GRAMS", head)
    monkeypatch.setattr(ct, "HEAD_TOKENS", head)
    rows = small()
    docs = documents(rows).withColumns({n: F.lit("mine") for n in ("gram", "digest", "n", "score", "learned")})
    found = {r.doc_id: r for r in ct.lm_scores(docs, F.col("doc_id") < 7, depth).collect()}
    trees = Trees([t for i, t in rows if i < 7], depth)
    base = base_by_hand(rows, [i < 7 for i, _ in rows])
    for (i, text), (n, known, total, log) in zip(rows, base, strict=True):
        r = found[i]
        assert (r.learned, r.n_tokens, r.n_known, r.train_tokens) == (i < 7, n, known, total)
        assert r.base_score == pytest.approx(log, abs=1e-9) and r.score == pytest.approx(trees.log10(text), abs=1e-6)
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / (len(lower(text)) + 1))


def test_odd_rows(spark, documents, odd_rows, monkeypatch):
    monkeypatch.setattr(ct, "HEAD_GRAMS", 500)
    monkeypatch.setattr(ct, "HEAD_TOKENS", 50)
    monkeypatch.setattr(ct, "_WINDOW", 1000)
    found = ct.lm_scores(documents(odd_rows), F.crc32(F.col("doc_id").cast("string")) % 7 != 2).collect()
    learned = [i is not None and r for i, r in zip(
        [i for i, _ in odd_rows], [i is not None and __import__("zlib").crc32(str(i).encode()) % 7 != 2 for i, _ in odd_rows], strict=True)]
    base = base_by_hand(odd_rows, learned)
    wanted = sorted((str(i), n, k, round(b, 6)) for (i, _), (n, k, _, b) in zip(odd_rows, base, strict=True))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert len({r.score for r in found if r.doc_id == 4}) == 2


def test_windows_do_not_change_scores(spark, documents, monkeypatch):
    docs = documents([(i, passage(i, 5)) for i in range(20)])
    found = []
    for window in (1 << 20, 97):
        monkeypatch.setattr(ct, "_WINDOW", window)
        found.append({r.doc_id: r.score for r in ct.lm_scores(docs, F.col("doc_id") < 15).collect()})
    assert all(found[0][i] == pytest.approx(found[1][i], abs=1e-9) for i in range(20))


def test_learning_more_costs_unseen_text_less(spark, documents):
    rows = [(i, " ".join(words(f"lm{i % 40}", 40))) for i in range(200)]
    costs = [
        np.mean([r.bits_per_byte for r in ct.lm_scores(documents(rows), F.col("doc_id") < n).collect() if r.doc_id >= 160])
        for n in (0, 5, 30)]
    assert costs[0] == pytest.approx(8.0) and costs[0] > costs[1] > costs[2]


def test_nothing_to_score(documents):
    assert ct.lm_scores(documents([]), F.col("doc_id") > 0).count() == 0


def test_head_finds_exactly_its_keys():
    keys = np.random.default_rng(1).choice(1 << 47, 5000, replace=False)
    head = ct.Head(keys[:3000], np.arange(3000.0))
    value, found = head(keys)
    assert found.tolist() == [True] * 3000 + [False] * 2000 and value[:3000].tolist() == list(range(3000))
