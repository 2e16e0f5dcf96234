import numpy as np
import pytest
from pyspark.sql import functions as F

from notewright.llm import hard_negatives as hn

VECTOR = "vec_id long, embedding array<double>, label string"


def by_hand(rows, anchor, scale=256):
    usable = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        q = tuple(int(np.floor(scale * v)) for v in x)
        if (max((abs(v) * scale for v in x), default=0) + 1) * len(q) ** 0.5 <= 1 << 28:
            usable[i, label, q] = None
    usable = list(usable)
    out = []
    for i, label, q in usable:
        if not anchor(i):
            continue
        scores = sorted(
            ((-sum(a * b for a, b in zip(q, p, strict=True)), j, l) for j, l, p in usable if j != i and len(p) == len(q)))
        for minus, j, _ in [s for s in scores if s[2] == label][:5]:
            inside = [(k, -m) for m, k, l in scores if l != label and 50 * -minus <= 100 * -m <= 95 * -minus][:3]
            out += [(i, j, rank, k, -minus, s) for rank, (k, s) in enumerate(inside, 1)]
    return sorted(out)


def clustered(n=900, size=12, seed=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, size))
    return [(i, (centres[i % 12] + draw.normal(size=size) * 0.15).tolist(), str(i % 6)) for i in range(n)]


def odd():
    return [
        (None, [1.0] * 12, "1"), (2000, None, "1"), (2050, [1.0] * 12, None), (2100, [1.0] * 11 + [None], "1"),
        (2150, [float("nan")] * 12, "1"), (2200, [float("inf")] * 12, "1"), (2250, [-1e300] * 12, "1"),
        (2300, [0.0] * 12, "1"), (2350, [], "1"), (2400, [], "2"), (2450, [0.5, 1.0], "1"), (2451, [0.5, 1.0], "1"),
        (2452, [0.3, 0.9], "2"), (2453, [-0.5, -1.0], "2"), (2500, [70_000.0] * 12, "1"), (2501, [70_000.1] * 12, "1"),
        (2502, [50_000.0] * 12, "2"), (2503, [50_000.0] * 12, "3"), (2550, [7_000_000.0] * 12, "1"),
    ]


@pytest.mark.parametrize(("block", "group", "page"), [(256, 2048, 256), (16, 7, 3)])
def test_against_all_pairs(spark, monkeypatch, block, group, page):
    monkeypatch.setattr(hn, "GROUP_ANCHORS", group)
    monkeypatch.setattr(hn.anchor_groups, "__defaults__", (group,))
    monkeypatch.setattr(hn.zone_pages, "__defaults__", (page,))
    monkeypatch.setattr(hn, "TASK_BLOCKS", 5)
    copies = [(3000 + i, [0.7] * 12, "1") for i in range(120)] + [(3200 + i, [0.6] * 12, "2") for i in range(120)]
    rows = clustered() + odd() + copies + [(0, [0.1] * 12, "0")] + clustered(40)
    table = spark.createDataFrame(rows, VECTOR).withColumns({n: F.lit(1) for n in ("block", "size", "q", "window", "score")})
    found = hn.hard_negatives(table, F.col("vec_id") % 50 == 0, block_rows=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == by_hand(rows, lambda i: i % 50 == 0)


def test_zone_maps_spare_blocks(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 8)) * 4
    rows = [(i, (centres[i % 40] + draw.normal(size=8) * 0.02).tolist(), str(i % 4)) for i in range(4000)]
    blocks = hn.write_blocks(hn.whole_rows(spark.createDataFrame(rows, VECTOR), F.col("vec_id") % 50 == 0, 256), block_rows=50)
    pages, groups = hn.zone_pages(blocks), hn.anchor_groups(blocks, 20)
    asking = groups.select(
        "group", "size", "ids", "labels", "q", F.col("floors").alias("low"),
        F.transform("floors", lambda _: F.lit(1 << 62)).alias("high"),
        F.transform("floors", lambda _, i: i.cast("long")).alias("owner"))
    needs = hn.needed_blocks(asking, pages, True).select(F.sum(F.size("members"))).first()[0]
    possible = 80 * blocks.groupBy("label").count().agg(F.max("count")).first()[0]
    assert 80 <= needs < possible / 4


def test_the_curve_visits_every_cell_by_single_steps():
    for bits, n in ((3, 2), (2, 3), (2, 4)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), axis=-1).reshape(-1, n)
        place = hn.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_large_scores_stay_exact():
    big = np.array([[(1 << 27) + 1, 3]], dtype=np.int32)
    assert hn._products(big, big)[0, 0] == ((1 << 27) + 1) ** 2 + 9


def test_without_rows_or_anchors(spark):
    none = spark.createDataFrame([], VECTOR)
    assert hn.hard_negatives(none, F.col("vec_id") % 50 == 0).count() == 0
    assert hn.hard_negatives(spark.createDataFrame(clustered(30), VECTOR), F.lit(None).cast("boolean")).count() == 0
