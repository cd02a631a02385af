"""The distributed order operators against plain Python on small fixtures."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ordered as O
from corpusloom.operators import resample as R


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """Three groups, one of which holds most rows; values repeat."""
    rng = random.Random(5)
    rows = [(i, "hot" if i % 10 else ("cold" if i % 20 else None), float(rng.randint(0, 60)), i % 2) for i in range(700)]
    df = spark.createDataFrame(rows, "id int, g string, v double, y int").repartition(5)
    return rows, df


@pytest.mark.parametrize("range_rows", [None, 7])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(skewed, range_rows, descending):
    rows, df = skewed
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    out = O.running_sums(counts, ["g"], "v", ["n", "pos"], descending=descending, range_rows=range_rows).collect()
    assert len(out) == counts.count()
    for r in out:
        group = [x for x in rows if x[1] == r.g]
        upto = [x for x in group if (x[2] >= r.v if descending else x[2] <= r.v)]
        assert (r.cum_n, r.tot_n) == (len(upto), len(group))
        assert (r.cum_pos, r.tot_pos) == (sum(x[3] for x in upto), sum(x[3] for x in group))


@pytest.mark.parametrize("range_rows", [None, 5])
def test_quantiles(skewed, range_rows):
    rows, df = skewed
    shares = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q99": 0.99, "q100": 1.0}
    out = {r.g: r for r in O.quantiles(df, ["g"], "v", shares, range_rows=range_rows).collect()}
    for g in ("hot", "cold", None):
        values = [x[2] for x in rows if x[1] == g]
        for name, share in shares.items():
            assert out[g][name] == pytest.approx(np.quantile(values, share))


@pytest.mark.parametrize("accuracy", [20, 40, 10_000])
def test_sketched_quantiles_are_exact_too(spark, accuracy):
    rng = random.Random(1)
    rows = [("hot" if i % 5 else "cold", rng.expovariate(1) if i % 3 else 1.0) for i in range(3000)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    shares = {"q0": 0.0, "q25": 0.25, "q5": 0.5, "q75": 0.75, "q99": 0.99, "q100": 1.0}
    out = {r.g: r for r in O.quantiles(df, ["g"], "v", shares, sketch=True, accuracy=accuracy, range_rows=50).collect()}
    assert set(out) == {"hot", "cold", "one"}
    for g, r in out.items():
        for name, share in shares.items():
            assert r[name] == pytest.approx(np.quantile([v for k, v in rows if k == g], share))
    whole = O.quantiles(df, [], "v", {"m": 0.5}, sketch=True, accuracy=accuracy).first()
    assert whole.m == pytest.approx(np.median([v for _, v in rows if v is not None]))


def test_quantiles_of_everything(skewed):
    rows, df = skewed
    row = O.quantiles(df, [], "v", {"m": 0.5}, range_rows=4).first()
    assert row.m == pytest.approx(np.median([x[2] for x in rows]))


@pytest.mark.parametrize("step", [1, 4])
def test_hash_cutoffs_take_exactly_the_quota(skewed, monkeypatch, step):
    monkeypatch.setattr(O, "HASH_STEP", step)
    rows, df = skewed
    quotas = {"hot": 123, "cold": 7, None: 0}
    got = sorted(r.id for r in O.first_by_hash(df, "id", 9, quotas, "g").collect())
    want = []
    for g, q in quotas.items():
        ranked = sorted((x for x in rows if x[1] == g), key=lambda x: md5(f"9|{x[0]}"))
        want += [x[0] for x in ranked[:q]]
    assert got == sorted(want)


def test_first_by_hash_over_quota_keeps_everything(skewed):
    rows, df = skewed
    assert O.first_by_hash(df, "id", 1, 10_000, "g").count() == len(rows)
    assert O.first_by_hash(df, "id", 1, 50).count() == 50


def test_dense_index(skewed):
    rows, df = skewed
    got = {r.id: r.idx for r in O.dense_index(df, "id", 3).collect()}
    want = {x[0]: i for i, x in enumerate(sorted(rows, key=lambda x: md5(f"3|{x[0]}")))}
    assert got == want


def test_too_many_groups_are_refused(spark):
    with pytest.raises(ValueError):
        O.bounded_rows(spark.range(20), 10)


def brute_neighbours(points, k):
    out = []
    for i, p in points:
        near = sorted((math.dist(p, q), j) for j, q in points if j != i)
        out += [(i, j, round(d, 9), place) for place, (d, j) in enumerate(near[:k], 1)]
    return sorted(out)


def test_nearest_neighbours_are_exact(spark):
    """Clusters, a heap of equal points and strays; small chunks mean many pivots."""
    rng = random.Random(2)
    points = [(i, (rng.gauss(i % 3 * 6, 1), rng.gauss(i % 2 * 4, 1), float(rng.randint(0, 2)))) for i in range(120)]
    points += [(200 + i, (1.0, 1.0, 1.0)) for i in range(70)] + [(300, (90.0, -50.0, 3.0))]
    df = spark.createDataFrame([(i, *p) for i, p in points], "id int, a double, b double, c double").repartition(3)
    got = R.nearest_neighbours(df, "id", ["a", "b", "c"], 3).collect()
    assert sorted((r.id, r.neighbour, round(r.distance, 9), r.place) for r in got) == brute_neighbours(points, 3)


def test_neighbours_of_equal_points_only(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(4)], "id int, a double")
    got = sorted((r.id, r.neighbour) for r in R.nearest_neighbours(df, "id", ["a"], 2).collect())
    assert got == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (3, 0), (3, 1)]


@pytest.fixture(scope="module")
def imbalanced(spark):
    rng = random.Random(4)
    rows = [(i, int(i % 6 == 0), rng.random(), rng.random() * 3) for i in range(120)]
    return spark.createDataFrame(rows, "id int, y int, a double, b double")


def counts(df):
    return {r.y: r["count"] for r in df.groupBy("y").count().collect()}


def test_resampling_sizes(imbalanced):
    assert counts(R.under_sample(imbalanced, "id", "y")) == {0: 20, 1: 20}
    over = R.over_sample(imbalanced, "id", "y")
    assert counts(over) == {0: 100, 1: 100}
    assert over.join(imbalanced, imbalanced.columns, "left_anti").count() == 0
    weights = {r.y: r.weight for r in R.balanced_weights(imbalanced, "y").select("y", "weight").distinct().collect()}
    assert weights == {0: pytest.approx(0.6), 1: pytest.approx(3.0)}
    with pytest.raises(ValueError):
        R.over_sample(imbalanced.filter("y = 0"), "id", "y")


@pytest.mark.parametrize("k", [1, 5])
def test_smote_points_lie_between_neighbours(imbalanced, k):
    out = R.smote(imbalanced, "id", "y", ["a", "b"], k=k)
    assert counts(out) == {0: 100, 1: 100}
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, R.smote(imbalanced, "id", "y", ["a", "b"], k=k).collect()))
    small = [(r.id, (r.a, r.b)) for r in imbalanced.filter("y = 1").collect()]
    pairs = [(dict(small)[i], dict(small)[j]) for i, j, _, _ in brute_neighbours(small, k)]
    for r in out.filter("y = 1").collect():
        p = (r.a, r.b)
        on_a_segment = any(abs(math.dist(s, p) + math.dist(p, e) - math.dist(s, e)) < 1e-9 for s, e in pairs)
        assert on_a_segment or any(math.dist(p, q) < 1e-12 for _, q in small)


def test_few_values_in_many_rows_are_counted_at_once(spark, monkeypatch):
    """a30, a29, m7: no narrowing of the rows for columns with few values; the medians stay exact, and null-free groups with many values are narrowed."""
    from corpusloom.operators import ordered as O

    labels, write = [], O.materialise
    monkeypatch.setattr(O, "materialise", lambda df, label="stage": labels.append(label) or write(df, label))
    rows = spark.range(1000).selectExpr("'few' AS g", "CAST(id % 5 AS DOUBLE) AS v")
    found = O.quantiles(rows, ["g"], "v", {"a": 0.5, "b": 0.99, "c": 0.1999}, sketch=True, range_rows=50).collect()
    assert [tuple(r)[:3] for r in found] == [("few", 2.0, 4.0)] and abs(found[0].c - 0.7001) < 1e-6
    assert "narrowed" not in labels
    both = rows.union(spark.range(1000).selectExpr("'many'", "CAST(id AS DOUBLE)"))
    got = {r.g: r.a for r in O.quantiles(both, ["g"], "v", {"a": 0.5}, sketch=True, range_rows=50).collect()}
    assert got == {"few": 2.0, "many": 499.5} and "narrowed" in labels
