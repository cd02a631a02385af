"""Model plans on small deterministic data: sanity, not scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.listings import clean_listings
from corpusloom.plans import models as M


@pytest.fixture(scope="module")
def listings(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        power, year = rng.randint(40, 200), rng.randint(2001, 2020)
        price = 3000.0 * power + 9000.0 * (year - 2000) + rng.gauss(0, 15000) + (power > 150) * 200000
        rows.append(
            (i, rng.choice(["Tata x", "Honda y", "bmw z"]), year, price, rng.randint(5, 90) * 1000, rng.choice(["Petrol", "Diesel"]),
             None if i % 20 == 3 else f"{rng.randint(10, 25)}.5 kmpl", f"{power * 10} CC", f"{power} bhp", f"{power * 2}Nm@ 2000rpm", "First Owner")
        )
    raw = spark.createDataFrame(
        rows, "id int, name string, year int, selling_price double, km_driven int, fuel string, mileage string, engine string, max_power string, torque string, owner string"
    )
    return clean_listings(raw)


def test_six_families(listings):
    table, models = M.run_comparison(listings, "id", "selling_price", trees=8, max_depth=10, max_bins=64, fourier_components=80)
    rows = {r.model: r for r in table.collect()}
    assert len(rows) == len(models) == 6
    order = [r.test_r2 for r in table.collect()]
    assert order == sorted(order, reverse=True)
    simple, multiple = rows["Simple linear (1 feature)"], rows["Multiple linear"]
    assert simple.n_features == 1 and multiple.n_features > 6
    assert multiple.train_r2 >= simple.train_r2
    assert rows["Decision tree"].train_r2 > 0.95 > 0 and rows["Decision tree"].train_r2 > multiple.train_r2
    assert rows["Polynomial (degree 3)"].train_r2 >= multiple.train_r2 - 1e-6
    assert rows["RBF (random Fourier features)"].test_r2 > 0.8
    for r in rows.values():
        assert r.r2_gap == pytest.approx(r.train_r2 - r.test_r2) and r.test_rmse > 0
    with pytest.raises(KeyError):
        M.run_comparison(listings, "id", "selling_price", simple_feature="absent")


def test_trees_are_unpruned_by_default(listings):
    table, models = M.run_comparison(listings, "id", "selling_price", trees=5, fourier_components=20)
    rows = {r.model: r for r in table.collect()}
    assert rows["Decision tree"].train_r2 == pytest.approx(1.0, abs=1e-9)
    assert rows["Random forest (5 trees)"].train_r2 > 0.9 and models["Decision tree"].n_nodes > 300


def test_multiple_linear_equals_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    y = x @ [2.0, -1.0, 0.5] + 4 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    model = M.LinearRegression(labelCol="y", solver="auto", regParam=0.0).fit(M.as_vector(df, ["a", "b", "c"]))
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(200)]), y, rcond=None)
    assert [*model.coefficients, model.intercept] == pytest.approx(want.tolist())
    slope, intercept, r2 = M.simple_line(df, "a", "y")
    assert [slope, intercept] == pytest.approx(np.polyfit(x[:, 0], y, 1).tolist()) and 0 < r2 < 1


def test_degree_sweep(listings):
    rows = M.degree_sweep(listings, "id", "selling_price", degrees=(1, 2, 3), n_features=6).collect()
    assert [r.n_terms for r in rows] == [6, 27, 83]
    train = [r.train_r2 for r in rows]
    assert all(b >= a - 1e-6 for a, b in zip(train, train[1:]))
    assert sum(r.is_test_peak for r in rows) == 1 and rows[0].train_r2_change is None
    assert rows[1].test_r2_change == pytest.approx(rows[1].test_r2 - rows[0].test_r2)


def test_term_count_of_degree_four():
    assert math.comb(6 + 4, 4) - 1 == 209


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(9)
    rows = []
    for i in range(500):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        y = int(a * b + a + rng.gauss(0, 0.4) > 1.0)
        rows.append((i, y, "test" if i % 4 == 0 else "train", a, b))
    return spark.createDataFrame(rows, "id int, y int, partition string, a double, b double")


def forest(**params):
    return M.forest_classifier(8, 6, labelCol="y", **params)


def test_classifiers(prepared):
    table, models = M.compare_classifiers(prepared, ["a", "b"], "y", trees=8, max_depth=6)
    rows = {r.model: r for r in table.collect()}
    base = rows["Baseline (most frequent)"]
    assert (base.precision, base.recall, base.f1) == (0.0, 0.0, 0.0) and 0.5 < base.accuracy < 1
    assert rows["Decision tree"].train_f1 > 0.9 and rows["Random forest (8 trees)"].f1 > 0.5
    ranked = M.importances(models["Random forest (8 trees)"], ["a", "b"], prepared.sparkSession).collect()
    assert sum(r.importance for r in ranked) == pytest.approx(1.0)


def test_error_listing(spark):
    rows = [(i, 1, 0, i / 100, f"call 0791234567{i} Maria") for i in range(6)] + [(9, 0, 1, 0.9, "fine")]
    scored = spark.createDataFrame(rows, "row_key int, y int, predicted int, p double, text string")
    listing = M.error_listing(scored, "y", "text").collect()
    assert [(r.error, r.row_key) for r in listing] == [("missed", 0), ("missed", 1), ("missed", 2), ("missed", 3), ("misfiled", 9)]
    assert listing[0].shown == "call <PHONE> <NAME>" and listing[0].n_digits == 11


def test_learning_curve(prepared):
    curve = M.learning_curve(prepared, "id", ["a", "b"], "y", fractions=(0.1, 0.5, 1.0), seeds=2, estimator_factory=forest).collect()
    assert [r.fraction for r in curve] == [0.1, 0.5, 1.0]
    sizes = [r.n_rows for r in curve]
    assert sizes == [37, 187, 375] and curve[-1].f1_std == 0.0
    assert curve[0].gain is None and curve[1].gain == pytest.approx(curve[1].f1_mean - curve[0].f1_mean)


def test_resampling_comparison(prepared):
    rows = M.compare_resampling(prepared, "id", ["a", "b"], "y", estimator_factory=forest).orderBy("position").collect()
    assert [r.strategy for r in rows][0] == "none" and len(rows) == 6
    by = {r.strategy: r for r in rows}
    assert by["none"].f1_gain == 0.0 and by["balanced weights"].train_rows == by["none"].train_rows
    for name in ("random over-sampling", "SMOTE (k=5)", "SMOTE (k=1)", "random under-sampling"):
        assert by[name].train_positive_share == pytest.approx(0.5)
    assert by["random under-sampling"].train_rows < by["none"].train_rows < by["SMOTE (k=5)"].train_rows
