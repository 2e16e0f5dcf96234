import re
from collections import defaultdict
from itertools import permutations

import pytest
from conftest_llm import passage, words
from pyspark.sql import functions as F

from notewright.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def fails_by_hand(rows):
    """The letters of the filters that each row fails, rows being (doc_id, text, source)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(letter for letter, fails in (
            ("A", len(ws) < 200), ("B", 100 * len(set(ws)) < 50 * len(ws)),
            ("C", 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t)), ("D", any(c in "#$%&*|" for c in t)),
            ("E", i is not None and first[t] < i)) if fails))
    return out


def audit_by_hand(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = fails_by_hand(rows)
    out, shapley = {}, defaultdict(int)
    for order in map("".join, permutations("ABCDE")):
        for part in {r[2] or "" for r in rows}:
            left = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
            everyone = left
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[part, letter] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(letter in f for _, f in everyone) - len(gone),
                    sum(f == letter for _, f in everyone), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def corpus(odd_rows):
    long = " ".join(words("audit", 260))
    rows = [(100 + i, long + f" {i % 7}", f"s{i % 3}") for i in range(40)]
    rows += [(200 + i, " ".join(["same"] * 300), "s0" if i else None) for i in range(6)]
    rows += [(300 + i, long.upper() + "#" * (i % 2), "s1") for i in range(6)] + [(400, "50% off | now", "")]
    rows += [(None, long + " 3", "s1"), (100, long + " 0", "s1"), (100, long + " 0", "s0"), (500, "Ünï " * 210, "s2")]
    return rows + [(i, t, "odd") for i, t in odd_rows] + [(i, passage(i, 30), "s2") for i in range(20, 30)]


def test_audit_against_every_order_by_hand(spark, odd_rows):
    rows = corpus(odd_rows)
    labels = [(r[0], k % 2, (k + 1) % 3 % 2) for k, r in enumerate(rows) if k % 4] + [
        (100, 1, None), (100, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = docs.withColumns({n: F.lit("mine") for n in ("part", "failed", "n", "good", "digest", "step", "own")})
    found = filter_audit.filter_audit(clashing, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len({r[2] or "" for r in rows}) * 600
    assert set(map(tuple, found)) == audit_by_hand(rows, labels)


def test_shapley_values_share_out_what_all_filters_remove(spark, odd_rows):
    docs = spark.createDataFrame(corpus(odd_rows), "doc_id long, text string, source string")
    found = filter_audit.filter_audit(docs, spark.createDataFrame([], LABELS)).where("filter_order = 'ABCDE'").collect()
    by_part = defaultdict(list)
    for r in found:
        by_part[r.part].append(r)
    for steps in by_part.values():
        assert sum(r.shapley for r in steps) == 120 * sum(r.removed for r in steps)
    assert all(r.good_lost == r.toxic_lost == 0 for r in found)


def test_nothing_to_audit(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.filter_audit(docs, spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0


@pytest.mark.parametrize(("n", "text"), [(199, True), (200, False)])
def test_the_number_of_words_is_a_strict_bound(n, text):
    assert bool(filter_audit.failed_alone(" ".join(words("bound", n)).encode()) & 1) is text
