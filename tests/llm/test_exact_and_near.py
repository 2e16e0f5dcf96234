import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from conftest_llm import passage, sha, words
from pyspark.sql import functions as F

from notewright.llm import embedding_dedup, exact_dedup, groups, simhash
from notewright.llm.components import components


def reach(nodes, links):
    """The smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(7, 7), (300, 200)]
    links += [(draw.randint(400, 450), draw.randint(400, 450)) for _ in range(40)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == reach(nodes, [(a, b) for a, b in links if a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_bring_any_two_rows_of_a_key_together_once(spark):
    rows = [(0, i) for i in range(25)] + [(1, i) for i in range(3)]
    placed = groups.in_blocks(spark.createDataFrame(rows, "key long, member long"), "member", block=6).collect()
    met = defaultdict(int)
    by_pair = defaultdict(list)
    for r in placed:
        by_pair[r.key, r.one, r.two].append(r)
    for (_, one, two), inside in by_pair.items():
        assert len(inside) <= 25
        for i, a in enumerate(inside):
            for b in inside[i + 1:]:
                if one == two or a.own != b.own:
                    met[a.key, min(a.member, b.member), max(a.member, b.member)] += 1
    assert set(met.values()) == {1} and len(met) == 25 * 24 // 2 + 3


def exact_by_hand(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    keep, size = {}, defaultdict(int)
    for (i, _), t in zip(rows, texts, strict=True):
        size[t] += 1
        keep[t] = min((x for x in (keep.get(t), i) if x is not None), default=None)
    return sorted(
        ((i, keep[t], size[t], i is not None and i == keep[t], sha(t))
         for (i, _), t in zip(rows, texts, strict=True)), key=str)


def test_exact_duplicates_of_odd_rows(documents, odd_rows):
    rows = odd_rows + [(20, "a  b"), (19, "a\tb"), (21, "a b")]
    found = exact_dedup.exact_duplicates(documents(rows).withColumn("check", F.lit(1)).withColumn("run", F.lit(2)))
    assert sorted(map(tuple, found.collect()), key=str) == exact_by_hand(rows)
    assert exact_dedup.exact_duplicates(documents([])).count() == 0


def test_every_round_sorts_and_merges(documents):
    rounds = exact_dedup.merge_runs(exact_dedup.digests(documents([(i, f"t {i % 5}") for i in range(50)])), 64, 8)
    assert rounds.count() == 5
    final = rounds._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the order is not optimised away, and the pass along it numbers the equal neighbours
    assert len(re.findall(r"Sort \[range#\d+ ASC NULLS FIRST, run#\d+L? ASC NULLS FIRST, text_sha256", final)) == 2
    assert len(re.findall(r"row_number\(\) windowspec", final)) >= 2


def test_every_fan_in_merges_to_the_same(documents):
    rows = [(i, f"text {i % 37}") for i in range(400)]
    digested = exact_dedup.digests(documents(rows))
    results = {
        (runs, fan): sorted(map(tuple, exact_dedup.merge_runs(digested, runs, fan).collect()))
        for runs, fan in ((1, 2), (8, 2), (64, 8))}
    assert len(set(map(str, results.values()))) == 1 and len(results[64, 8]) == 37


def simhash_by_hand(text, size):
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(tokens[i:i + size]) for i in range(max(1, len(tokens) - size + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_rows():
    base = words("near", 120)
    rows = [(i, passage(i)) for i in range(100, 140)]
    for i in range(40):
        copy = list(base)
        copy[random.Random(i).randrange(120)] = "changed"
        rows.append((i, " ".join(copy)))
    return rows


def test_near_duplicates_against_all_pairs(documents, odd_rows):
    rows = near_rows() + [(i if i is None else i + 1000, t) for i, t in odd_rows]
    prints = [simhash_by_hand(t, 4) for _, t in rows]
    distinct = sorted(set(prints))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[i:] if (a ^ b).bit_count() <= 4]
    root = reach(distinct, links)
    first = {}
    for (i, _), p in zip(rows, prints, strict=True):
        first[root[p]] = min((x for x in (first.get(root[p]), i) if x is not None), default=None)
    wanted = sorted(
        ((i, f"{p:016x}", first[root[p]]) for (i, _), p in zip(rows, prints, strict=True)), key=str)
    found = simhash.near_duplicates(documents(rows).withColumn("fingerprint", F.lit("mine")))
    assert sorted(map(tuple, found.collect()), key=str) == wanted
    assert len({w[2] for w in wanted if w[0] is not None and w[0] < 40}) < 40
    assert simhash.near_duplicates(documents([])).count() == 0


def test_any_four_bytes_hold_a_triple():
    from itertools import combinations

    triples = simhash.position_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_links_connect_flips_of_up_to_four_bits(spark):
    draw = random.Random(3)
    prints = {draw.getrandbits(64)}
    for p in list(prints):
        for _ in range(300):
            bits = draw.sample(range(64), draw.randint(1, 6))
            prints.add(p ^ sum(1 << b for b in bits))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long")).collect()
    wanted = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert reach(signed, [tuple(r) for r in found]) == reach(signed, wanted)


VECTOR = "vec_id long, embedding array<float>, label int"


def vectors(n=300, size=24):
    draw = np.random.default_rng(2)
    rows = []
    for i in range(n):
        x = draw.normal(size=size)
        rows.append((i, x.astype(np.float32).tolist(), i % 3))
        if i % 4 == 0:
            y = x + draw.normal(size=size) * 0.1
            rows.append((1000 + i, y.astype(np.float32).tolist(), i % 3 if i % 8 else None))
        if i % 30 == 0:
            rows += [(2000 + i + k, x.astype(np.float32).tolist(), i % 3) for k in range(3)]
    hub = draw.normal(size=size)
    rows += [(5000 + i, (hub + draw.normal(size=size) * 0.05).astype(np.float32).tolist(), 1) for i in range(80)]
    return rows


def test_near_vectors_against_all_pairs(spark):
    rows = vectors() + [
        (7000, None, 1), (7001, [0.0] * 24, 1), (7002, [float("nan")] * 24, 1), (7003, [None] * 24, 1),
        (7004, [float("inf")] * 24, 1), (7005, [1.0], 1), (7006, [], 1), (7007, [0.0] * 24, 1)]
    out = embedding_dedup.near_vectors(
        spark.createDataFrame(rows, VECTOR).withColumn("component", F.lit(1)).withColumn("code", F.lit(2)))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = {r.vec_id: r for r in out.collect()}
    usable = [r for r in rows if r[2] is not None and r[0] < 7000]
    x = np.array([r[1] for r in usable], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in usable])
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    wanted = dict.fromkeys((r[0] for r in rows), 0)
    for r, n in zip(usable, near.sum(axis=1), strict=True):
        wanted[r[0]] = int(n)
    assert len(found) == len(rows)
    assert all(found[i].n_links <= n for i, n in wanted.items())
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(wanted.values()) > 5000
    exact = reach(wanted, [(usable[a][0], usable[b][0]) for a, b in zip(*np.nonzero(near), strict=True)])
    assert np.mean([found[i].component_id == c for i, c in exact.items()]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_vectors_without_any_usable(spark):
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, 2.0], None)]
    found = embedding_dedup.near_vectors(spark.createDataFrame(rows, VECTOR)).collect()
    assert sorted(map(tuple, found)) == [(i, 0, i, True) for i in (1, 2, 3)]
    assert embedding_dedup.near_vectors(spark.createDataFrame([], VECTOR)).count() == 0
