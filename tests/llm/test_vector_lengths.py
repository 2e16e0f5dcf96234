import numpy as np
import pytest
from test_exact_and_near import VECTOR

from notewright.llm import embedding_dedup


@pytest.mark.parametrize("block", [4096, 50])
def test_a_longer_vector_takes_no_links_from_others(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    draw = np.random.default_rng(5)
    rows = []
    for size, first, pairs in ((24, 0, 100), (40, 1000, 100), (7, 2000, 3)):
        for i in range(pairs):
            x = draw.normal(size=size)
            rows += [(first + 2 * i + k, (x * (1 + k)).astype(np.float32).tolist(), -1 if i % 2 else 1) for k in (0, 1)]
    odd = [(5000, [0.0] * 90, 1), (5001, [1.0] * 80, None), (5002, [1.0] * 70, 1), (5003, [1.0] * 60, 1),
           (5004, [1.0] * 60, 2), (5005, [3.0] * 60, 1)]
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows + odd, VECTOR)).collect()}
    assert len(found) == len(rows) + len(odd)
    assert all(found[i].n_links >= 1 and found[i].component_id <= i - i % 2 for i, _, _ in rows)
    assert [(i, found[i].n_links, found[i].component_id) for i, _, _ in odd] == [
        (5000, 0, 5000), (5001, 0, 5001), (5002, 0, 5002), (5003, 1, 5003), (5004, 0, 5004), (5005, 1, 5003)]


@pytest.mark.parametrize("size", [1, 2, 7, 24, 40, 64, 200])
def test_pairs_at_the_cosine_are_found_at_every_length(spark, size):
    """Recall over random pairs just above the cosine; none below it, none of another label."""
    draw = np.random.default_rng(size)
    rows, pairs = [], 600
    for i in range(pairs):
        x = draw.normal(size=size)
        x /= np.linalg.norm(x)
        y = draw.normal(size=size)
        y -= (y @ x) * x
        cosine = draw.uniform(0.9802, 0.985) if i % 3 else draw.uniform(0.97, 0.9798)
        z = x if size == 1 else cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)
        other = i % 5 == 0
        rows += [(2 * i, x.tolist(), f"l{i % 2}"), (2 * i + 1, (z * 3).tolist(), f"l{1 - i % 2 if other else i % 2}")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(table).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    links, wanted = np.array([found[i].n_links for i in range(len(rows))]), near.sum(axis=1)
    assert (links <= wanted).all() and links.sum() >= 0.9 * wanted.sum() > 0
    same = {r[0]: r[2] for r in rows}
    assert all(same[i] == same[r.component_id] for i, r in found.items())
