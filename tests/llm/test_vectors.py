"""Embeddings: near-duplicates and exact search against brute force."""

import numpy as np
import pytest

from foretide.llm import components, pivots, topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, node string"
ODD = [
    (9001, None, 1), (9002, [], 1), (9003, [0.0] * 8, 1), (9004, [1.0, None] + [0.0] * 6, 1),
    (9005, [float("nan")] * 8, 1), (9006, [float("inf")] * 8, 1), (9007, [0.5] * 8, None), (None, [0.5] * 8, 1),
    (9008, [0.5] * 3, 1), (9100, [0.25] * 8, 2),
]


def vectors(spark, many=700, seed=2):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(60, 8))
    x = (centre[r.integers(0, 60, many)] + 0.25 * r.normal(size=(many, 8))) * r.uniform(0.2, 3, (many, 1))
    x[::50] = x[1]  # equal vectors
    rows = [(i, v.astype(np.float32).tolist(), int(i % 2)) for i, v in enumerate(x)] + ODD
    rows += [rows[3], rows[3]]
    return rows, spark.createDataFrame([(*row, "clash", "clash") for row in rows], SCHEMA).repartition(3)


def usable(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v)


def filled(v):
    return np.r_[np.array(v, np.float64), np.zeros(8 - len(v))]


@pytest.mark.parametrize("block", [1024, 16])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rows, df = vectors(spark)
    found = pivots.near_duplicates(df).collect()
    assert len(found) == len(rows)
    held = [(i, filled(v) / np.linalg.norm(filled(v)), g) for i, v, g in rows if usable(v) and any(v) and g is not None and i is not None]
    x, label = np.array([h[1] for h in held]), np.array([h[2] for h in held])
    link = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    ids = np.array([h[0] for h in held])
    least = ids.copy()
    for _ in range(len(ids)):
        new = np.minimum(least, np.where(link, least, 10**9).min(1))
        if (new == least).all():
            break
        least = new
    links = sorted(zip(ids.tolist(), link.sum(1).tolist(), strict=True))
    ours = sorted((r.vec_id, r.n_links) for r in found if r.vec_id in set(ids.tolist()))
    total = sum(n for _, n in links)
    assert total > 1000 and all(a[1] <= b[1] for a, b in zip(ours, links, strict=True))  # none below the limit
    assert sum(n for _, n in ours) >= 0.98 * total
    component = dict(zip(ids.tolist(), least.tolist(), strict=True))
    assert sum(r.component_id == component[r.vec_id] for r in found if r.vec_id in component) >= 0.98 * len(ids)
    for r in found:
        if r.vec_id not in component:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
        else:
            assert r.kept == (r.vec_id == r.component_id)


def test_large_group_of_near_vectors(spark):
    """A third of the vectors in one group of pairwise cosine about 0.95, and all of them."""
    r = np.random.default_rng(5)
    for many, group in ((1800, 600), (900, 900)):
        x = r.normal(size=(many, 64)) / 8
        x[:group] = 0.95**0.5 * x[0] / np.linalg.norm(x[0]) + 0.05**0.5 * x[:group]
        x /= np.linalg.norm(x, axis=1)[:, None]
        df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
        link = x @ x.T >= 0.93
        np.fill_diagonal(link, False)
        found = pivots.near_duplicates(df.repartition(3)).collect()
        assert link.sum() > 0.5 * group**2
        assert link.sum() >= sum(r.n_links for r in found) >= 0.99 * link.sum()


@pytest.mark.parametrize(("block", "queries"), [(8192, 2048), (100, 3)])
def test_top_products(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rows, df = vectors(spark)
    found = sorted(tuple(r) for r in topk.top_products(df).collect())
    held = [(i, np.floor(1024 * filled(v)).astype(np.int64)) for i, v, _ in rows if usable(v) and i is not None]
    expected = []
    for q, v in held:
        if q % 100 == 0:
            best = sorted((-int(v @ w), i) for i, w in held if i != q)[:10]
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert found == sorted(expected)
    assert len({r[0] for r in found}) == 8


def test_few_and_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_products(none).count() == 0 and pivots.near_duplicates(none).count() == 0
    bad = spark.createDataFrame([(100, None, 1, "", ""), (None, [1.0], 1, "", "")], SCHEMA)
    assert topk.top_products(bad).count() == 0
    assert sorted(r.n_links for r in pivots.near_duplicates(bad).collect()) == [0, 0]
    few = spark.createDataFrame([(100, [1.0], 1, "", ""), (7, [2.0], 1, "", ""), (8, [-2.0], 1, "", "")], SCHEMA)
    assert [tuple(r) for r in topk.top_products(few).orderBy("rank").collect()] == [
        (100, 1, 7, 2 * 1024**2), (100, 2, 8, -2 * 1024**2)
    ]


def test_components(spark):
    r = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(400, 460)] + [(5, 5)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {(r.node, r.component) for r in found} == {(n, find(n)) for n in linked}
