"""Scores on deterministic predictors (checked in SQL) and model fits (rows only)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions.text import FEATURE_NAMES, digit_count, digit_ratio
from corpusloom.operators import metrics as M
from corpusloom.operators.features import feature_frame
from corpusloom.operators.prep import Preparation
from corpusloom.operators.resample import balanced_weights
from corpusloom.operators.split import assign_partitions, split_rows
from corpusloom.operators.stats import pearson
from corpusloom.plans import models as P

from .base import LABELLED, PRICED, labelled, priced_lines, query, rounded, sql_features, table
from .listings import cleaned
from .preparation import _SPLIT_LABELS, sql_split, sql_stratified


# -- scores of a fixed rule: the more digits, the more suspicious -----------
def scored_documents(spark, folder):
    text = F.col("text")
    p = F.round(F.least(F.lit(1.0), digit_ratio(text) * 10 + digit_count(text) / 100.0), 6)
    rows = labelled(spark, folder).select("doc_id", "text", "y", p.alias("p"))
    return rows.withColumn("predicted", (F.col("p") >= 0.5).cast("int"))


SCORED = (
    "WITH " + LABELLED + ", feats AS (" + sql_features("labelled", "doc_id, y, text", ("digit_ratio", "digit_count")) + "), "
    "pp AS (SELECT doc_id, text, y, round(least(1.0, digit_ratio * 10 + digit_count / 100.0), 6) AS p FROM feats), "
    "scored AS (SELECT *, CAST(p >= 0.5 AS INTEGER) AS predicted FROM pp)"
)
_CELLS = (
    ", cells AS (SELECT count(*) FILTER (WHERE y = 0 AND predicted = 0) AS tn, count(*) FILTER (WHERE y = 0 AND predicted = 1) AS fp, "
    "count(*) FILTER (WHERE y = 1 AND predicted = 0) AS fn, count(*) FILTER (WHERE y = 1 AND predicted = 1) AS tp FROM scored)"
)


@query("a21_confusion_matrix", SCORED + _CELLS + " SELECT * FROM cells")
def a21(spark, folder):
    return M.confusion(scored_documents(spark, folder), "y", "predicted")


@query(
    "a22_classification_scores",
    SCORED + _CELLS + " SELECT round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall, "
    "round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy FROM cells",
)
def a22(spark, folder):
    found = M.classification_scores(scored_documents(spark, folder), "y", "predicted")
    return rounded(found, "precision", "recall", "f1", "accuracy")


@query(
    "a23_classification_report",
    SCORED + ", per AS (SELECT CAST(c AS VARCHAR) AS label, coalesce(count(*) FILTER (WHERE y = c AND predicted = c) / nullif(count(*) FILTER (WHERE predicted = c), 0), 0.0) AS precision, "
    "coalesce(count(*) FILTER (WHERE y = c AND predicted = c) / nullif(count(*) FILTER (WHERE y = c), 0), 0.0) AS recall, "
    "coalesce(2.0::DOUBLE * count(*) FILTER (WHERE y = c AND predicted = c) / nullif(count(*) FILTER (WHERE predicted = c) + count(*) FILTER (WHERE y = c), 0), 0.0) AS f1, "
    "count(*) FILTER (WHERE y = c) AS support FROM scored CROSS JOIN (VALUES (0), (1)) t(c) GROUP BY c) "
    "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per "
    "UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
    "round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per",
)
def a23(spark, folder):
    return rounded(M.classification_report(scored_documents(spark, folder), "y", "predicted"), "precision", "recall", "f1")


_CURVE = SCORED + (
    ", c AS (SELECT p, count(*) AS n, sum(y) AS pos FROM scored GROUP BY p), w AS (SELECT p AS threshold, pos, sum(n) OVER o AS cn, sum(pos) OVER o AS cp, "
    "sum(pos) OVER () AS tp, sum(n) OVER () AS tn FROM c WINDOW o AS (ORDER BY p DESC)), curve AS (SELECT threshold, cp / cn AS precision, cp / tp AS recall, "
    "pos / tp AS recall_step, tp / tn AS prevalence FROM w)"
)


@query("a24_precision_recall_curve", _CURVE + " SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve")
def a24(spark, folder):
    curve = M.pr_curve(scored_documents(spark, folder), "y", "p")
    return rounded(curve.select("threshold", "precision", "recall"), "precision", "recall")


@query(
    "a24_average_precision",
    _CURVE + ", near AS (SELECT * FROM curve ORDER BY round(abs(threshold - 0.5), 12), threshold LIMIT 1) SELECT round(sum(c.recall_step * c.precision), 6) AS average_precision, "
    "any_value(n.threshold) AS near_threshold, round(any_value(n.precision), 6) AS near_precision, round(any_value(n.recall), 6) AS near_recall, "
    "round(max(c.prevalence), 6) AS prevalence FROM curve c CROSS JOIN near n",
)
def a24_ap(spark, folder):
    found = M.pr_summary(M.pr_curve(scored_documents(spark, folder), "y", "p"))
    return rounded(found, "average_precision", "near_precision", "near_recall", "prevalence")


# -- scores of a one-feature line -------------------------------------------
LINE = (
    "WITH " + PRICED + ", assigned AS (" + sql_split("priced", "row_key") + "), line AS (SELECT regr_slope(price, quantity) AS a, regr_intercept(price, quantity) AS b, "
    "regr_r2(price, quantity) AS r FROM assigned WHERE partition = 'train'), predicted AS (SELECT assigned.*, a * quantity + b AS prediction FROM assigned, line)"
)


def line_predictions(spark, folder):
    rows = assign_partitions(priced_lines(spark, folder), "row_key")
    a, b, _ = P.simple_line(rows.filter("partition = 'train'"), "quantity", "price")
    return rows.withColumn("prediction", F.lit(a) * F.col("quantity") + F.lit(b))


@query("m6_simple_linear", LINE + " SELECT round(a, 4) AS slope, round(b, 3) AS intercept, round(r, 6) AS train_r2 FROM line")
def m6(spark, folder):
    rows = assign_partitions(priced_lines(spark, folder), "row_key")
    slope, intercept, r2 = (
        f("price", "quantity") for f in (F.regr_slope, F.regr_intercept, F.regr_r2)
    )
    return rows.filter("partition = 'train'").agg(
        F.round(slope, 4).alias("slope"), F.round(intercept, 3).alias("intercept"), F.round(r2, 6).alias("train_r2")
    )


@query(
    "a25_regression_scores",
    LINE + ", s AS (SELECT partition, 1 - sum(power(price - prediction, 2)) / (var_pop(price) * count(*)) AS r2, sqrt(avg(power(price - prediction, 2))) AS rmse FROM predicted GROUP BY partition) "
    "SELECT round(max(r2) FILTER (WHERE partition = 'train'), 6) AS train_r2, round(max(rmse) FILTER (WHERE partition = 'train'), 3) AS train_rmse, "
    "round(max(r2) FILTER (WHERE partition = 'test'), 6) AS test_r2, round(max(rmse) FILTER (WHERE partition = 'test'), 3) AS test_rmse, "
    "round(max(r2) FILTER (WHERE partition = 'train') - max(r2) FILTER (WHERE partition = 'test'), 6) AS r2_gap FROM s",
)
def a25(spark, folder):
    found = M.regression_table(line_predictions(spark, folder), "price", "prediction")
    return rounded(rounded(found, "train_r2", "test_r2", "r2_gap"), "train_rmse", "test_rmse", digits=3)


@query(
    "a26_residual_summary",
    LINE + " SELECT round(median(abs(prediction - price)), 3) AS median_abs_error, round(avg(CASE WHEN abs(prediction - price) / price < 0.1 THEN 1.0 ELSE 0.0 END), 6) AS within_share "
    "FROM predicted WHERE partition = 'test'",
)
def a26(spark, folder):
    test = line_predictions(spark, folder).filter("partition = 'test'")
    found = M.residual_summary(test, "price", "prediction")
    return rounded(rounded(found, "within_share"), "median_abs_error", digits=3)


@query(
    "a27_residuals_by_price_band",
    LINE + " SELECT CAST(CASE WHEN price < 20000 THEN 0 WHEN price < 40000 THEN 1 WHEN price < 60000 THEN 2 WHEN price < 80000 THEN 3 ELSE 4 END AS BIGINT) AS band, "
    "count(*) AS n, round(avg(prediction - price), 3) AS mean_residual FROM predicted WHERE partition = 'test' GROUP BY band",
)
def a27(spark, folder):
    test = line_predictions(spark, folder).filter("partition = 'test'")
    found = M.residuals_by_band(test, "price", "prediction", (20_000, 40_000, 60_000, 80_000))
    return rounded(found, "mean_residual", digits=3)


# -- prepared classification rows -------------------------------------------
_UNIQUE = LABELLED + ", firsts AS (SELECT min(doc_id) AS doc_id, text, y FROM labelled GROUP BY text, y)"
ASSIGNED = "WITH " + _UNIQUE + ", assigned AS (" + sql_stratified("firsts", "doc_id", "y") + ")"


def prepared_documents(spark, folder):
    """Features of the unique labelled documents, split by class and standardised."""
    rows = feature_frame(labelled(spark, folder), "text", ["doc_id", "y", "text"])
    split = split_rows(
        rows, "doc_id", target="y", stratify=True, duplicate_subset=["text", "y"], keep_columns=list(FEATURE_NAMES)
    )
    return split, Preparation().fit_on_split(split)


@query(
    "m1_majority_baseline",
    ASSIGNED + ", top AS (SELECT y AS predicted FROM assigned WHERE partition = 'train' GROUP BY y ORDER BY count(*) DESC, y LIMIT 1), "
    "scored AS (SELECT y, CAST(predicted AS INTEGER) AS predicted FROM assigned, top WHERE partition = 'test')" + _CELLS
    + " SELECT round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall, "
    "round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy FROM cells",
)
def m1(spark, folder):
    split = split_rows(labelled(spark, folder), "doc_id", target="y", stratify=True)
    train = split.assigned.filter("partition = 'train'")
    scored = P.majority_prediction(train, split.test_rows, "y")
    return rounded(M.classification_scores(scored, "y", "predicted"), "precision", "recall", "f1", "accuracy")


@query(
    "m4_balanced_class_weights",
    "SELECT doc_id, round((SELECT count(*) FROM labels) / (2.0::DOUBLE * count(*) OVER (PARTITION BY toxic)), 6) AS weight FROM labels",
)
def m4(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return rounded(balanced_weights(labels, "toxic").select("doc_id", "weight"), "weight")


@query("m2_decision_tree")
def m2(spark, folder):
    _, prepared = prepared_documents(spark, folder)
    rows = P.as_vector(prepared, FEATURE_NAMES)
    model = P.tree_classifier(labelCol="y").fit(rows.filter("partition = 'train'"))
    return M.classification_scores(P.score_rows(model, rows, ["y", "partition"]), "y", "predicted", ["partition"])


def _forest(spark, folder):
    split, prepared = prepared_documents(spark, folder)
    rows = P.as_vector(prepared, FEATURE_NAMES)
    model = P.forest_classifier(labelCol="y").fit(rows.filter("partition = 'train'"))
    return split, rows, model


@query("m3_random_forest_probabilities")
def m3(spark, folder):
    _, rows, model = _forest(spark, folder)
    return P.score_rows(model, rows.filter("partition = 'test'"), ["doc_id", "y"])


@query("m5_impurity_importances")
def m5(spark, folder):
    _, _, model = _forest(spark, folder)
    return P.importances(model, FEATURE_NAMES, spark)


@query("w4_importance_ranking")
def w4(spark, folder):
    _, _, model = _forest(spark, folder)
    return M.rank_with_running_share(P.importances(model, FEATURE_NAMES, spark), "feature", "importance")


@query(
    "w4_ranking_with_running_share",
    "WITH v AS (SELECT source, round(sum(length(text)) / CAST(sum(sum(length(text))) OVER () AS DOUBLE), 9) AS share FROM documents GROUP BY source) "
    "SELECT row_number() OVER (ORDER BY share DESC, source) AS rank, source, share, round(sum(share) OVER (ORDER BY share DESC, source "
    "ROWS UNBOUNDED PRECEDING), 6) AS running_share FROM v",
)
def w4_shares(spark, folder):
    sizes = table(spark, folder, "documents").groupBy("source").agg(F.sum(F.length("text")).cast("double").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    shares = sizes.select("source", F.round(F.col("n") / total, 9).alias("share"))
    return rounded(M.rank_with_running_share(shares, "source", "share"), "running_share").withColumn("rank", F.col("rank").cast("long"))


@query(
    "w5_best_and_worst_brand",
    "WITH " + PRICED + ", f AS (SELECT brand, round(corr(price, quantity), 6) AS r FROM priced GROUP BY brand) "
    "SELECT arg_max(brand, r) AS best, max(r) AS best_score, arg_min(brand, r) AS worst, min(r) AS worst_score FROM f",
)
def w5_brands(spark, folder):
    fits = priced_lines(spark, folder).groupBy("brand").agg(F.round(pearson(F.col("price"), F.col("quantity")), 6).alias("r"))
    return M.best_and_worst(fits, "brand", "r")


@query("p13_error_listing")
def p13(spark, folder):
    split, rows, model = _forest(spark, folder)
    scored = P.score_rows(model, rows.filter("partition = 'test'"), ["doc_id", "y"])
    with_text = scored.join(split.meta("test"), "doc_id", "left").withColumnRenamed("doc_id", "row_key")
    return P.error_listing(with_text, "y", "text")


@query("m14_classifier_comparison")
def m14(spark, folder):
    _, prepared = prepared_documents(spark, folder)
    return P.compare_classifiers(prepared, FEATURE_NAMES, "y")[0]


@query(
    "j2_scored_rows_with_meta",
    _SPLIT_LABELS + ", feats AS (" + sql_features("assigned", "doc_id, y, text, partition", ("digit_ratio", "digit_count")) + "), "
    "pp AS (SELECT *, round(least(1.0, digit_ratio * 10 + digit_count / 100.0), 6) AS p FROM feats WHERE partition = 'test') "
    "SELECT doc_id, y, p, CAST(p >= 0.5 AS INTEGER) AS predicted, md5(text) AS digest FROM pp",
)
def j2_scored(spark, folder):
    """Predictions and probabilities of the test half, joined to the text that was held out of the model."""
    rows = feature_frame(labelled(spark, folder), "text", ["doc_id", "y", "text"])
    split = split_rows(rows, "doc_id", target="y", stratify=True, duplicate_subset=["text", "y"], keep_columns=["digit_ratio", "digit_count"])
    p = F.round(F.least(F.lit(1.0), F.col("digit_ratio") * 10 + F.col("digit_count") / 100.0), 6)
    scored = split.test_rows.select("doc_id", "y", p.alias("p")).withColumn("predicted", (F.col("p") >= 0.5).cast("int"))
    return scored.join(split.meta("test").select("doc_id", F.md5("text").alias("digest")), "doc_id", "left")


@query("m17_learning_curve")
def m17(spark, folder):
    _, prepared = prepared_documents(spark, folder)
    return P.learning_curve(prepared, "doc_id", FEATURE_NAMES, "y")


@query("m18_resampling_comparison")
def m18(spark, folder):
    _, prepared = prepared_documents(spark, folder)
    return P.compare_resampling(prepared, "doc_id", FEATURE_NAMES, "y")


# -- regression -------------------------------------------------------------
def _comparison(spark, folder):
    return P.run_comparison(cleaned(spark, folder), "listing_id", "selling_price")


@query("m15_regression_comparison")
def m15(spark, folder):
    return _comparison(spark, folder)[0]


@query("w5_best_and_worst_model")
def w5(spark, folder):
    return M.best_and_worst(_comparison(spark, folder)[0], "model", "test_r2")


@query("m16_degree_sweep")
def m16(spark, folder):
    return P.degree_sweep(cleaned(spark, folder), "listing_id", "selling_price")


def _prepared_lines(spark, folder):
    columns = ["quantity", "discount", "tax", "size", "retail", "flag", "type"]
    rows = priced_lines(spark, folder).select("row_key", "price", *columns)
    split = split_rows(rows, "row_key", target="price")
    prep = Preparation(drop_first=True)
    return prep, prep.fit_on_split(split)


def _line_scores(model, rows):
    scored = model.transform(rows).select("partition", "price", "prediction")
    return M.regression_scores(scored, "price", "prediction", ["partition"])


@query("m7_multiple_linear")
def m7(spark, folder):
    prep, prepared = _prepared_lines(spark, folder)
    rows = P.as_vector(prepared, prep.feature_names_out)
    model = P.LinearRegression(labelCol="price", solver="auto", regParam=0.0).fit(rows.filter("partition = 'train'"))
    return _line_scores(model, rows)


@query("m8_polynomial_regression")
def m8(spark, folder):
    prep, prepared = _prepared_lines(spark, folder)
    rest = [c for c in prep.feature_names_out if c not in prep.numeric_columns]
    rows = P.as_vector(P.as_vector(prepared, prep.numeric_columns, "_num"), rest, "_rest")
    model = P.polynomial(3, prep.numeric_columns, rest, "price").fit(rows.filter("partition = 'train'"))
    return _line_scores(model, rows)


def sql_two_terms(one: str, two: str) -> str:
    """Least squares of price on two terms over the training rows, in closed form."""
    return (
        "WITH " + PRICED + ", assigned AS (" + sql_split("priced", "row_key") + f"), t AS (SELECT {one} AS u, {two} AS v, price AS y FROM assigned "
        "WHERE partition = 'train'), c AS (SELECT var_pop(u) AS uu, var_pop(v) AS vv, covar_pop(u, v) AS uv, covar_pop(u, y) AS uy, covar_pop(v, y) AS vy, "
        "avg(u) AS mu, avg(v) AS mv, avg(y) AS my FROM t), b AS (SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS bu, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS bv FROM c) "
        "SELECT round(bu, 2) AS first_coefficient, round(bv, 2) AS second_coefficient, round(my - bu * mu - bv * mv, 1) AS intercept FROM b"
    )


def _two_terms(spark, folder, expand):
    """The same by `pyspark.ml`; `expand` makes the vector column `features`."""
    rows = assign_partitions(priced_lines(spark, folder), "row_key").filter("partition = 'train'")
    model = P.LinearRegression(labelCol="price", solver="normal", regParam=0.0).fit(expand(rows))
    first, second = model.coefficients
    found = (round(float(first), 2), round(float(second), 2), round(float(model.intercept), 1))
    return spark.createDataFrame([found], "first_coefficient double, second_coefficient double, intercept double")


@query("m7_linear_in_two_columns", sql_two_terms("quantity", "size"))
def m7_two(spark, folder):
    return _two_terms(spark, folder, lambda rows: P.as_vector(rows, ["quantity", "size"]))


@query("m8_quadratic_in_one_column", sql_two_terms("quantity", "quantity * quantity"))
def m8_two(spark, folder):
    def expand(rows):
        one = P.as_vector(rows, ["quantity"], "_one")
        return P.PolynomialExpansion(degree=2, inputCol="_one", outputCol="features").transform(one)

    return _two_terms(spark, folder, expand)


@query("m9_rbf_regression")
def m9(spark, folder):
    prep, prepared = _prepared_lines(spark, folder)
    model = P.FourierSVR().fit(prepared.filter("partition = 'train'"), prep.feature_names_out, "price")
    return M.regression_scores(model.predict(prepared), "price", "prediction", ["partition"])


@query("m13_tree_and_forest_regressors")
def m13(spark, folder):
    prep, prepared = _prepared_lines(spark, folder)
    rows = P.as_vector(prepared, prep.feature_names_out).select("partition", "price", "features")
    train = rows.filter("partition = 'train'")
    tree = P.ExactTrees(0, label="price", seed=P.SEED).fit(train)
    forest = P.ExactTrees(0, P.TREES, label="price", seed=P.SEED).fit(train)
    return _line_scores(tree, rows).withColumn("model", F.lit("tree")).unionByName(
        _line_scores(forest, rows).withColumn("model", F.lit("forest"))
    )


@query("a29_design_diagnostics")
def a29(spark, folder):
    rows = priced_lines(spark, folder).select("row_key", "price", "quantity", "discount", "size", "flag", "type")
    split = split_rows(rows, "row_key", target="price")
    out = None
    for name, drop_first in (("all levels", False), ("first level dropped", True)):
        prep = Preparation(drop_first=drop_first).fit(split.train)
        matrix = prep.transform(split.train.X)
        found = M.design_diagnostics(matrix, prep.feature_names_out).withColumn("design", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out
