"""Exact ranks by narrowing, ranks along an order, quotas over many strata, binned densities and wide encodings."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from corpusloom.operators import ordered as O
from corpusloom.operators import stats as S
from corpusloom.operators.prep import NotFittedError
from corpusloom.operators.split import quota_table, split_rows, stratified_quotas
from corpusloom.operators.wide import WideEncoder, column_sums


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [("even", rng.random()) for _ in range(900)] + [("ties", float(rng.choice([1, 1, 1, 1, 2, 9]))) for _ in range(800)]
    rows += [("equal", 4.0)] * 500 + [("skewed", math.exp(rng.gauss(0, 9))) for _ in range(700)] + [("one", -1.5), (None, 2.0), (None, 3.0)]
    rows += [("infinite", v) for v in [math.inf] * 150 + [-math.inf] * 150 + [0.0] * 10] + [("even", None), ("even", math.nan), ("none", None)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(3)


@pytest.mark.parametrize("few", [1, 40, 100_000])
@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_ranks_are_exact_however_rough_the_sketch(values, few, accuracy):
    rows, df = values
    groups = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    shares = {"lowest": 0.0, "q": 0.31, "half": 0.5, "p99": 0.99, "highest": 1.0}
    got = {r.g: r for r in O.quantiles(df, ["g"], "v", shares, sketch=True, accuracy=accuracy, range_rows=few).collect()}
    assert got.keys() == groups.keys()
    for g, found in groups.items():
        found.sort()
        if g == "infinite":
            assert (got[g].lowest, got[g].highest) == (-math.inf, math.inf)
            continue
        for name, share in shares.items():
            assert got[g][name] == pytest.approx(float(np.quantile(found, share)), rel=1e-12)


def test_quantile_of_everything_and_of_nothing(spark, values):
    whole = O.quantiles(spark.range(1_001).selectExpr("id * 1.0D AS v"), [], "v", {"m": 0.5, "p": 0.9}, sketch=True, range_rows=10).first()
    assert (whole.m, whole.p) == (500.0, 900.0)
    assert O.quantiles(values[1].limit(0), ["g"], "v", {"m": 0.5}, sketch=True).count() == 0


def test_describe_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    df = spark.createDataFrame([(float(v), int(i % 7), None if i % 3 else float(i)) for i, v in enumerate(x)], "a double, b int, c double")
    rows = {r.feature: r for r in S.describe(df, ["a", "b", "c"]).collect()}
    assert rows["a"]["std"] == pytest.approx(x.std(ddof=1)) and rows["a"].p25 == pytest.approx(np.quantile(x, 0.25))
    assert rows["c"]["count"] == 167 and rows["b"].p75 == np.quantile(np.arange(500) % 7, 0.75)


@pytest.mark.parametrize("range_rows", [7, 1_000])
def test_global_rank(spark, range_rows):
    rng = random.Random(1)
    rows = [(f"k{i:03d}", rng.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(4)
    got = {r.k: r.at for r in O.global_rank(df, [F.col("n").desc(), "k"], "at", range_rows).collect()}
    assert got == {k: i for i, (k, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}


@pytest.mark.parametrize("total", [0, 1, 61, 300])
def test_quotas_over_many_strata(spark, total):
    rng = random.Random(total)
    sizes = {f"s{i}": rng.choice([1, 1, 1, 2, 5]) for i in range(170)} | {None: 3}
    table = spark.createDataFrame(list(sizes.items()), "g string, n long")
    assert {r.g: r.quota for r in quota_table(table, "g", total, 20).collect()} == stratified_quotas(sizes, total)


def test_binned_density_is_within_its_bound(spark):
    rng = random.Random(8)
    rows = [("a", rng.gauss(50, 9)) for _ in range(600)] + [("b", rng.uniform(20, 140)) for _ in range(400)] + [("c", 5.0), ("c", 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    exact = {(r.g, r.at): r.density for r in S.density(df, "v", ["g"], 0, 100, 41).collect()}
    height = {r.g: 1 / (math.sqrt(2 * math.pi) * r.h) for r in df.filter("v IS NOT NULL").groupBy("g").agg((F.stddev_samp(F.least("v", F.lit(100.0))) * F.pow(F.count("v").cast("double"), F.lit(-0.2))).alias("h")).collect() if r.h}
    for fineness in (4, 32):
        got = {(r.g, r.at): r.density for r in S.binned_density(df, "v", ["g"], 0, 100, 41, fineness).collect()}
        assert got.keys() == exact.keys() and got["c", 0.0] is None
        assert all(abs(got[k] - exact[k]) <= height[k[0]] / (8 * fineness**2) + 1e-12 for k in exact if exact[k] is not None)
    assert S.binned_density(df.limit(0), "v", ["g"], 0, 100, 5).count() == 0


@pytest.fixture(scope="module")
def wide_split(spark):
    rows = [(i, f"level {i % 1_200:05d}", "x" if i % 3 else None, float(i)) for i in range(3_000)]
    return split_rows(spark.createDataFrame(rows, "id long, big string, small string, n double"), "id")


def test_wide_encoding_is_sparse_and_from_the_training_half(wide_split):
    encoder = WideEncoder(["big", "small"]).fit(wide_split.train)
    levels = sorted({r.big for r in wide_split.train.X.select("big").collect()})
    assert encoder.sizes == {"big": len(levels), "small": 1}
    for row in encoder.transform(wide_split.assigned, ["n"]).select("id", "big", "n", "features").collect():
        assert isinstance(row.features, SparseVector) and len(row.features) == 2 + len(levels)
        want = {0: row.n, 1 + len(levels): 1.0} | ({1 + levels.index(row.big): 1.0} if row.big in levels else {})
        assert dict(zip(row.features.indices.tolist(), row.features.values.tolist())) == {i: v for i, v in want.items() if v}


def test_wide_encoding_guards(spark, wide_split):
    with pytest.raises(TypeError):
        WideEncoder(["big"]).fit(wide_split.assigned)
    with pytest.raises(NotFittedError):
        WideEncoder(["big"]).transform(wide_split.assigned)
    encoder = WideEncoder(["big"]).fit(wide_split.train)
    strange = spark.createDataFrame([(1, "never seen"), (2, None)], "id long, big string")
    got = {r.id: sum(r.v) for r in encoder.transform(strange).select("id", vector_to_array("features").alias("v")).collect()}
    assert got == {1: 0.0, 2: 1.0}


def test_wide_vectors_name_no_columns_and_are_summed_by_their_entries(spark, wide_split):
    """The metadata of a vector with a name per level would be as large as the levels, on the driver."""
    made = WideEncoder(["big", "small"]).fit(wide_split.train).transform(wide_split.assigned, ["n"])
    assert made.schema["features"].metadata == {}
    want = np.array(made.select(vector_to_array("features").alias("v")).toPandas()["v"].to_list()).sum(axis=0)
    got = {r.place: r.n for r in column_sums(made).collect()}
    assert got == {i: v for i, v in enumerate(want.tolist()) if v}
    encoder = WideEncoder(["big"]).fit(wide_split.train)
    holes = encoder.transform(spark.createDataFrame([("a", None), ("b", 0.0)], "big string, n double"), ["n"])
    assert sorted(str(r.features) for r in holes.select("features").collect()) == [f"({1 + encoder.sizes['big']},{e})" for e in ("[0],[nan]", "[],[]")]
