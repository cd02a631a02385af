from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import FEATURES
from corpusloom.operators import audit as A
from corpusloom.operators import dedupe as D
from corpusloom.operators import metrics as M
from corpusloom.operators import stats as S


def frame(spark, values, y):
    return spark.createDataFrame(list(zip(map(float, values), y)), "v double, y int")


def d_of(spark, values, y):
    return S.cohens_d(frame(spark, values, y), ["v"], "y").first().cohens_d


def test_cohens_d(spark):
    a, b = [5.0, 6.0, 7.0, 9.0], [1.0, 2.0, 4.0]
    pooled = math.sqrt((3 * np.var(a, ddof=1) + 2 * np.var(b, ddof=1)) / 5)
    assert d_of(spark, a + b, [1] * 4 + [0] * 3) == pytest.approx((np.mean(a) - np.mean(b)) / pooled)
    assert d_of(spark, [3, 3, 3, 3], [0, 0, 1, 1]) == 0.0
    assert d_of(spark, [1, 1, 2, 2], [0, 0, 1, 1]) == math.inf
    assert d_of(spark, [2, 2, 1, 1], [0, 0, 1, 1]) == -math.inf
    assert d_of(spark, [1, 2, 3], [0, 1, 1]) == 0.0
    assert d_of(spark, [1, 2, 3], [1, 1, 1]) == 0.0


def brute_stump(values, y):
    def gini(part):
        p = sum(part) / len(part)
        return 2 * p * (1 - p) * len(part)

    best, cut = math.inf, None
    for c in sorted(set(values))[:-1]:
        left = [t for v, t in zip(values, y) if v <= c]
        right = [t for v, t in zip(values, y) if v > c]
        score = gini(left) + gini(right)
        if score < best - 1e-12:
            best, cut = score, c
    if cut is None or len(set(y)) < 2:
        predict = [int(sum(y) * 2 > len(y))] * len(y)
    else:
        sides = {s: [t for v, t in zip(values, y) if (v <= cut) == s] for s in (True, False)}
        predict = [int(sum(sides[v <= cut]) * 2 > len(sides[v <= cut])) for v in values]
    tp = sum(p and t for p, t in zip(predict, y))
    return 2 * tp / max(sum(predict) + sum(y), 1)


@pytest.mark.parametrize("range_rows", [None, 3])
def test_stumps_against_brute_force(spark, range_rows):
    rng = random.Random(3)
    for trial in range(3):
        values = [rng.randint(0, 8) + 0.5 for _ in range(40)]
        y = [int(rng.random() < 0.2 + 0.08 * v) for v in values]
        found = S.stumps(frame(spark, values, y), ["v"], "y", range_rows=range_rows).first()
        assert found.stump_f1 == pytest.approx(brute_stump(values, y))


def test_stump_without_a_split(spark):
    assert S.stumps(frame(spark, [2, 2, 2], [0, 1, 0]), ["v"], "y").first().stump_f1 == 0.0
    assert S.stumps(frame(spark, [2, 2, 2], [1, 1, 0]), ["v"], "y").first().stump_f1 == pytest.approx(0.8)
    assert S.stumps(frame(spark, [1, 2, 3], [1, 1, 1]), ["v"], "y").first().stump_f1 == 1.0


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, v double")
    got = {r.g: (r["count"], r.mean, r.median) for r in S.grouped_stats(df, ["g"], "v").collect()}
    assert got == {"a": (2, 2.0, 2.0), None: (1, 5.0, 5.0)}


def test_histograms_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert [(r.bin, r.n, r.bin_start) for r in S.histogram_over_range(df, "v", 5).collect()] == [(1, 2, 2.0)]
    assert S.histogram_over_range(df.filter("v IS NULL"), "v", 5).count() == 0


def test_description_matches_pandas(spark):
    rng = random.Random(8)
    pdf = pd.DataFrame({"a": [rng.gauss(0, 3) for _ in range(90)], "b": [rng.choice([1.0, 2.0, None]) for _ in range(90)]})
    df = spark.createDataFrame(pdf)
    want = pdf.describe()
    for r in S.describe(df, ["a", "b"]).collect():
        assert [r["count"], r["mean"], r["std"], r["min"], r.p25, r.p50, r.p75, r["max"]] == pytest.approx(want[r.feature].tolist())
    assert S.skew_summary(df, "a").first().skewness == pytest.approx(pdf["a"].skew())
    missing = {r.feature: r.n_missing for r in S.null_counts(df).collect()}
    assert missing == {"b": int(pdf["b"].isna().sum())}
    assert S.correlations(df, ["a"], "b").first().r == pytest.approx(pdf["a"].corr(pdf["b"]))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (100.0,), (101.0,), (None,)], "v double")
    assert {r.bin: r.n for r in S.histogram(df, "v", 0, 100, 10).collect()} == {1: 2, 2: 1, 10: 1}


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(i % 2, float(40 + i % 17)) for i in range(200)], "y int, v double")
    rows = S.density(df, "v", ["y"], 0, 100, 101).collect()
    for y in (0, 1):
        assert sum(r.density for r in rows if r.y == y) == pytest.approx(1.0, abs=0.01)


def test_duplicates(spark):
    df = spark.createDataFrame([(3, "x", None), (1, "x", None), (2, "y", 1.0), (4, "z", 1.0)], "id int, t string, v double")
    kept = D.drop_duplicates(df, "id")
    assert sorted(r.id for r in kept.collect()) == [1, 2, 4] and kept.columns == df.columns
    by_v = D.drop_duplicates(df, "id", ["v"])
    assert sorted((r.id, r.t) for r in by_v.collect()) == [(1, "x"), (2, "y")]
    assert sorted(r.id for r in D.duplicate_members(df, ["t", "v"]).collect()) == [1, 3]
    assert D.duplicate_summary(df.drop("id")).first().asDict() == {"n_rows": 4, "n_duplicates": 1, "duplicate_share": 0.25}
    assert D.duplicate_summary(df.limit(0)).first().asDict() == {"n_rows": 0, "n_duplicates": 0, "duplicate_share": 0.0}


@pytest.fixture(scope="module")
def contaminated(spark):
    rows = [(f"k{i}", f"plain text escapenumber {i % 7} A" if i % 2 == 0 else f"Text {i % 7}!", i % 2) for i in range(200)]
    return spark.createDataFrame(rows, "k string, text string, y int")


def test_marker_audit(contaminated):
    found = {r.marker: r for r in A.marker_audit(contaminated, "text", "y").collect()}
    planted = found["has 'escapenumber'"]
    assert (planted.negative_share, planted.positive_share, planted.auc, planted.exact_zero) == (1.0, 0.0, 0.0, True)
    assert found["has a raw digit"].auc == 0.5 and not found["has a raw digit"].exact_zero
    flagged = A.suspicious_zero_cells(A.marker_audit(contaminated, "text", "y"))
    assert {r.marker for r in flagged.collect()} == {"has 'escapenumber'", "has '!'"}


def test_strong_but_leaky_marker_is_not_flagged(spark):
    rows = [("call 1", 1)] * 100 + [("call 1", 0)] * 5 + [("call me", 0)] * 95
    audit = A.marker_audit(spark.createDataFrame(rows, "text string, y int"), "text", "y")
    digit = audit.filter("marker = 'has a raw digit'").first()
    assert digit.auc == pytest.approx(0.975) and not digit.exact_zero
    assert A.suspicious_zero_cells(audit).count() == 0


def test_marker_case_and_nulls(spark):
    df = spark.createDataFrame([("lower", 0), (None, 0), ("ESCAPENUMBER", 1)], "text string, y int")
    found = {r.marker: r for r in A.marker_audit(df, "text", "y").collect()}
    assert found["has any uppercase"].negative_share == 0.0 and found["has 'escapenumber'"].positive_share == 1.0
    loose = {r.marker: r for r in A.marker_audit(df, "text", "y", A.caseless(A.MARKERS)).collect()}
    assert loose["has any uppercase"].negative_share == 0.5
    table = spark.createDataFrame([("dot", ".", False), ("word", r"^\w+$", True)], "name string, pattern string, is_regex boolean")
    own = {r.marker: r for r in A.marker_audit(df, "text", "y", A.markers_from_table(table)).collect()}
    assert own["dot"].positive_share == 0.0 and own["word"].positive_share == 1.0


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "text string, y int")
    with pytest.raises(Exception, match="both classes"):
        A.marker_audit(df, "text", "y").collect()


def test_viability(spark):
    flat = spark.createDataFrame([(i, "all lower case words") for i in range(120)] + [(999, None)], "k int, text string")
    grades = {r.feature: r for r in A.feature_viability(flat, "text", "k", FEATURES, sample=50).collect()}
    assert grades["has_url_like"].status == "dead" and grades["digit_count"].status == "dead"
    assert grades["char_length"].status == "ok" and grades["char_length"].mean == 20.0


def test_full_audit(contaminated):
    both = contaminated.withColumn("corpus", F.lit("bad")).unionByName(
        contaminated.select("k", F.lit("Some text 1!").alias("text"), "y", F.lit("even").alias("corpus"))
    )
    found = A.audit_corpora(both, "corpus", "text", "y", "k")
    verdicts = {r.corpus: r for r in found.verdicts.collect()}
    assert verdicts["bad"].verdict == "rejected" and verdicts["bad"].worst_marker_auc == 1.0
    assert (verdicts["even"].verdict, verdicts["even"].dead_features, verdicts["even"].n_features) == ("dead_features", 4, 12)
    assert verdicts["even"].n_rows == 200


def test_scores(spark):
    rows = [(1, 1, 0.9)] * 3 + [(1, 0, 0.4)] * 1 + [(0, 1, 0.6)] * 2 + [(0, 0, 0.1)] * 4
    df = spark.createDataFrame(rows, "y int, p int, s double")
    assert M.confusion(df, "y", "p").first().asDict() == {"tn": 4, "fp": 2, "fn": 1, "tp": 3}
    s = M.classification_scores(df, "y", "p").first()
    assert (s.precision, s.recall, s.f1, s.accuracy) == pytest.approx((0.6, 0.75, 2 / 3, 0.7))
    none = M.classification_scores(df.withColumn("p", F.lit(0)), "y", "p").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    report = {r.label: r for r in M.classification_report(df, "y", "p").collect()}
    assert report["0"].support == 6 and report["weighted avg"].support == 10
    assert report["macro avg"].recall == pytest.approx((0.75 + 4 / 6) / 2)
    curve = M.pr_curve(df, "y", "s", range_rows=1)
    ap = M.pr_summary(curve).first()
    assert ap.average_precision == pytest.approx(0.75 * 1.0 + 0.25 * 4 / 6)
    assert ap.near_threshold == 0.4 and ap.prevalence == 0.4


def test_regression_scores(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    s = M.regression_scores(df, "y", "p").first()
    assert s.r2 == pytest.approx(1 - 1.25 / np.var([1, 2, 4]) / 3) and s.rmse == pytest.approx(math.sqrt(1.25 / 3))
    r = M.residual_summary(df, "y", "p").first()
    assert r.median_abs_error == 0.5 and r.within_share == pytest.approx(1 / 3)
    bands = {b.band: (b.n, b.mean_residual) for b in M.residuals_by_band(df, "y", "p", (2.0, 3.0)).collect()}
    assert bands == {0: (1, 0.5), 1: (1, 0.0), 2: (1, -1.0)}


def test_design_diagnostics_match_numpy(spark):
    rng = np.random.default_rng(1)
    n = 200
    a, b = rng.integers(0, 4, n), rng.integers(0, 2, n)
    full = np.column_stack([rng.normal(size=n), *[(a == i).astype(float) for i in range(4)], *[(b == i).astype(float) for i in range(2)]])
    for matrix, rank in ((full, 6), (np.delete(full, [1, 5], axis=1), 6)):
        names = [f"c{i}" for i in range(matrix.shape[1])]
        df = spark.createDataFrame(matrix.tolist(), ", ".join(f"{c} double" for c in names)).repartition(3)
        d = M.design_diagnostics(df, names, [1.0, -7.0]).first()
        assert (d.n_rows, d.n_columns, d.rank_with_intercept) == (n, matrix.shape[1], rank)
        assert d.max_abs_coefficient == 7.0
    assert d.full_rank == 6 and d.condition_number == pytest.approx(np.linalg.cond(matrix))


def test_result_tables(spark):
    table = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "name string, v double")
    ranked = M.rank_with_running_share(table, "name", "v").collect()
    assert [(r["rank"], r.name) for r in ranked] == [(1, "a"), (2, "b"), (3, "c")]
    assert [r.running_share for r in ranked] == pytest.approx([0.5, 0.8, 1.0])
    assert M.best_and_worst(table, "name", "v").first().asDict() == {"best": "a", "best_score": 0.5, "worst": "c", "worst_score": 0.2}
    assert [r.gain for r in A.step_gain(table, "v", "v").orderBy("v").collect()][1:] == pytest.approx([0.1, 0.2])


def test_columns_without_spread(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (1.0, 2.0, 0), (1.0, None, 1)], "c double, v double, y int")
    found = {r.feature: r.r for r in S.correlations(df, ["c", "v"], "v").collect()}
    assert found["c"] is None and found["v"] == pytest.approx(1.0)
    assert S.strongest(df, ["c", "v"], "v", 1).first().feature == "v"
    assert {r.density for r in S.density(df, "c", ["y"], 0, 10, 3).collect()} == {None}
