"""Neighbour searches against brute force: deep trees, skewed data, ties; recall of the hashed search."""

from __future__ import annotations

import numpy as np
import pytest

from corpusloom.operators import neighbours as N
from corpusloom.operators.resample import nearest_neighbours


def table(spark, x):
    return spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "id long, v array<double>")


def brute(x, k):
    out = {}
    for i, d in enumerate(N.distances(x, x)):
        d[i] = np.inf
        order = np.lexsort((np.arange(len(x)), d))[:k]
        out[i] = [(int(j), float(d[j])) for j in order if np.isfinite(d[j])]
    return out


def collected(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.id, r.distance, r.neighbour)):
        out.setdefault(r.id, []).append((r.neighbour, r.distance))
    return out


def clustered(n, dims=3, seed=0):
    rng = np.random.default_rng(seed)
    return np.unique(rng.normal(size=(n, dims)).round(3) + rng.integers(0, 6, (n, 1)) * 5, axis=0)


@pytest.mark.parametrize(("leaf", "fanout"), [(40, 3), (100, 8), (5_000, 32)])
def test_exact_search_equals_brute_force(spark, leaf, fanout):
    x = clustered(1_200)
    tree = N.PivotTree(table(spark, x).repartition(3), 7, leaf, fanout)
    assert (len(tree.levels) > 1) == (leaf < 5_000) and tree.home.count() == len(x)
    assert tree.home.groupBy("cell").count().agg({"count": "max"}).first()[0] <= leaf
    assert collected(tree.nearest(4)) == brute(x, 4)


def test_one_dense_spot_and_lone_points(spark):
    rng = np.random.default_rng(4)
    dense = rng.normal(scale=1e-6, size=(900, 2))
    lone = np.array([[1e3 * i, -1e3 * i * i] for i in range(1, 12)])
    x = np.concatenate([dense, lone])
    assert collected(N.exact_nearest(table(spark, x), 5, 1, 50, 4)) == brute(x, 5)


def test_ties_go_to_the_smaller_id(spark):
    x = np.array([[float(i), float(j)] for i in range(18) for j in range(18)])
    assert collected(N.exact_nearest(table(spark, x), 3, 2, 30, 3)) == brute(x, 3)


def test_more_neighbours_than_points_in_a_leaf(spark):
    x = clustered(300, 2)
    assert collected(N.exact_nearest(table(spark, x), 25, 3, 12, 3)) == brute(x, 25)


def test_hashed_search_finds_nearly_all(spark):
    x = clustered(3_000, 8, 5)
    got, want = collected(N.hashed_nearest(table(spark, x), 5, 11, tables=10, leaf_rows=150)), brute(x, 5)
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits / (5 * len(want)) >= 0.9
    assert all(d == pytest.approx(float(N.distances(x[i : i + 1], x[j : j + 1])[0, 0])) for i in range(0, 3_000, 100) for j, d in got[i])
    dense = np.concatenate([np.random.default_rng(1).normal(scale=1e-3, size=(1_500, 4)), clustered(100, 4)])
    got, want = collected(N.hashed_nearest(table(spark, dense), 3, 2, leaf_rows=100)), brute(dense, 3)
    assert sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want) / (3 * len(want)) >= 0.9


def test_both_modes_on_rows(spark):
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(70)], "k long, a double, b double")
    exact = nearest_neighbours(rows, "k", ["a", "b"], 3).collect()
    assert sorted(exact) == sorted(nearest_neighbours(rows, "k", ["a", "b"], 3, approximate=True).collect())
    assert N.hashed_nearest(table(spark, np.zeros((1, 2))).limit(0), 2, 1).count() == 0
