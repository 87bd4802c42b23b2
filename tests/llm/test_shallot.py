"""Clusters against measuring every vector to every centroid."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tallyline.llm import shallot

SCHEMA = "vec_id long, embedding array<double>, cluster string, id string, v string"


def plain(rows: list[tuple], count: int, rounds: int, dims: int, scale: int) -> list[tuple]:
    limit = np.sqrt(2**62 / dims) / 2
    good = [(r[0], [int(np.floor(x * scale)) for x in r[1]]) for r in rows if r[1] and len(r[1]) == dims and all(x is not None and np.isfinite(x) and abs(x) * scale < limit for x in r[1])]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in good if i is not None)
    centroids = [v for _, v in first[:count]]

    def assign() -> list[tuple[int, int]]:
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for _, v in good]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (_, own) in zip(good, found, strict=True) if own == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assign()
    inertia = [sum(d for d, own in found if own == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia), digest[k]) for (i, _), (d, k) in zip(good, found, strict=True)), key=str)


def vectors(n: int = 300, dims: int = 6) -> list[tuple]:
    rng = np.random.default_rng(5)
    heart = rng.normal(0, 1, (5, dims))
    rows = [(k, (heart[k % 5] + rng.normal(0, 0.2, dims)).tolist()) for k in range(n)]
    rows += [(1000 + k, rows[7][1]) for k in range(40)]  # ties
    rows += [(k, rows[k][1]) for k in range(20)]  # repeated rows
    rows += [(2000, None), (2001, []), (2002, [0.5]), (2003, [None] * dims), (2004, [float("nan")] * dims), (2005, [float("inf")] * dims)]
    rows += [(2006, [1e30] + [0.0] * (dims - 1)), (2007, [1e5] * dims), (None, [0.25] * dims), (2008, [0.0] * dims), (2009, [-0.0] * dims)]
    return [(*r, "clash", "clash", "clash") for r in rows]


def found(table, **settings) -> list[tuple]:
    return sorted((tuple(r) for r in shallot.cluster(table, **settings).collect()), key=str)


@pytest.mark.parametrize(("count", "rounds", "block"), [(16, 3, 4096), (7, 6, 8), (1, 2, 4096), (3, 0, 16), (1000, 1, 64)])
def test_clusters_of_awkward_vectors(spark, monkeypatch, count, rounds, block):
    monkeypatch.setattr(shallot, "BLOCK", block)
    table = spark.createDataFrame(vectors(), SCHEMA).repartition(3)
    assert found(table, count=count, rounds=rounds, dims=6) == plain(vectors(), count, rounds, 6, 64)


def test_clusters_on_a_grid_of_ties(spark):
    rows = [(k, [k % 5 / 64, k // 5 % 5 / 64], "", "", "") for k in range(200)]
    assert found(spark.createDataFrame(rows, SCHEMA), count=9, rounds=4, dims=2) == plain(rows, 9, 4, 2, 64)


def test_clusters_of_nothing_and_without_ids(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    rows = [(None, [0.5, 0.5], "", "", "")]
    assert found(spark.createDataFrame(rows, SCHEMA), dims=2) == [(None,) * 6]


def test_most_vectors_keep_their_centroid_unseen():
    rng = np.random.default_rng(1)
    heart = rng.integers(-60, 60, (16, 64))
    points = heart[rng.integers(0, 16, 4000)] + rng.integers(-5, 6, (4000, 64))
    near, second = np.zeros(4000, np.int64), np.ones(4000, np.int64)
    upper, lower = np.full(4000, np.inf), np.full(4000, -np.inf)
    before = points[:16].copy()
    shallot.Ball(before).assign(points, near, second, upper, lower)
    for _ in range(6):
        after = np.array([points[near == c].mean(0) if (near == c).any() else before[c] for c in range(16)]).astype(np.int64)
        shallot.moved(near, upper, lower, before, after)
        looked = shallot.Ball(after).assign(points, near, second, upper, lower)
        before = after
        exact = ((points[:, None] - after[None]) ** 2).sum(-1)
        assert (near == exact.argmin(1)).all() and (upper >= np.sqrt(exact.min(1))).all()
        assert (lower <= np.sqrt(np.sort(exact, 1)[:, 1]) + 1e-6).all()
    assert looked < 1000


def test_the_query_equals_its_sql(spark):
    import duckdb

    from tallyline.llm.queries import llm_oracles, llm_queries

    folder = "/root/testdata/sf0.01"
    out = llm_queries()["op13_shallot"](spark, folder)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    expected = connection.sql(f"SELECT {', '.join(out.columns)} FROM ({llm_oracles()['op13_shallot']})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(expected) and expected
