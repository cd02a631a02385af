"""Scores of classifiers and regressors as grouped aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import quantiles, running_sums

# Upper limits of the first four price bands.
PRICE_BANDS = (500_000, 1_000_000, 1_500_000, 3_000_000)


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp of a 0/1 task; cells without rows are 0."""
    a, p = F.col(actual).cast("int"), F.col(predicted).cast("int")
    return df.groupBy(*by).agg(
        F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 1) & (p == 1)).alias("tp"),
    )


def classification_scores(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of class 1 (0 where undefined) and accuracy."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion(df, actual, predicted, by).select(
        *by,
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class scores with support, then macro and weighted averages."""
    sides = df.select(
        F.explode(
            F.array(
                F.struct(F.col(actual).cast("string").alias("label"), F.lit(1).alias("is_a"), F.lit(0).alias("is_p"), F.lit(0).alias("hit")),
                F.struct(
                    F.col(predicted).cast("string").alias("label"), F.lit(0).alias("is_a"), F.lit(1).alias("is_p"),
                    (F.col(actual) == F.col(predicted)).cast("int").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("label").agg(
        F.sum("hit").alias("tp"), F.sum("is_a").alias("support"), F.sum("is_p").alias("flagged")
    ).select(
        "label",
        _ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("flagged") + F.col("support")).alias("f1"),
        "support",
    )
    scores = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in scores], F.sum("support").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in scores],
        F.sum("support").alias("support"),
    )
    return per.unionByName(macro).unionByName(weighted)


def pr_curve(df: DataFrame, actual: str, score: str, **ordering) -> DataFrame:
    """Precision and recall at every distinct score, highest first."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(actual).cast("long")).alias("pos")
    )
    walked = running_sums(counts, [], "threshold", ["n", "pos"], descending=True, **ordering)
    return walked.select(
        "threshold",
        _ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
        _ratio(F.col("cum_pos"), F.col("tot_pos")).alias("recall"),
        _ratio(F.col("pos"), F.col("tot_pos")).alias("recall_step"),
        _ratio(F.col("tot_pos"), F.col("tot_n")).alias("prevalence"),
    )


def pr_summary(curve: DataFrame, at: float = 0.5) -> DataFrame:
    """Average precision (step-wise sum), the point nearest to a threshold (the lower
    one on ties), and the prevalence as baseline."""
    near = F.min(
        F.struct(
            F.round(F.abs(F.col("threshold") - at), 12).alias("gap"), "threshold", "precision", "recall"
        )
    ).alias("p")
    row = curve.agg(
        F.sum(F.col("recall_step") * F.col("precision")).alias("average_precision"),
        near,
        F.max("prevalence").alias("prevalence"),
    )
    return row.select(
        "average_precision",
        F.col("p.threshold").alias("near_threshold"),
        F.col("p.precision").alias("near_precision"),
        F.col("p.recall").alias("near_recall"),
        "prevalence",
    )


def regression_scores(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """R2 and RMSE per group; a constant target scores 1 if met exactly, else 0."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    sums = df.groupBy(*by).agg(
        F.avg((y - p) * (y - p)).alias("_mse"), F.var_pop(y).alias("_var"), F.count(y).alias("n")
    )
    r2 = F.when(F.col("_var") == 0, F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)).otherwise(
        1 - F.try_divide(F.col("_mse"), F.col("_var"))
    )
    return sums.select(*by, r2.alias("r2"), F.sqrt("_mse").alias("rmse"), "n")


def regression_table(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Train and test scores side by side with the R2 gap, best test R2 first."""
    scores = regression_scores(df, actual, predicted, [*by, "partition"])
    pick = [
        F.max(F.when(F.col("partition") == p, F.col(c))).alias(f"{p}_{c}")
        for p in ("train", "test")
        for c in ("r2", "rmse")
    ]
    wide = scores.groupBy(*by).agg(*pick)
    return wide.withColumn("r2_gap", F.col("train_r2") - F.col("test_r2")).orderBy(F.col("test_r2").desc())


def residual_summary(df: DataFrame, actual: str, predicted: str, tolerance: float = 0.10) -> DataFrame:
    """Median absolute error and the share of rows within the tolerance."""
    y = F.col(actual).cast("double")
    gaps = df.select(F.abs(F.col(predicted) - y).alias("gap"), y.alias("y"))
    share = gaps.agg(
        F.avg((F.try_divide(F.col("gap"), F.col("y")) < tolerance).cast("double")).alias("within_share"),
        F.lit(1).alias("_one"),
    )
    middle = quantiles(gaps, [], "gap", {"median_abs_error": 0.5}, sketch=True).withColumn("_one", F.lit(1))
    return middle.join(share, "_one").drop("_one")


def residuals_by_band(
    df: DataFrame, actual: str, predicted: str, limits: Sequence[float] = PRICE_BANDS
) -> DataFrame:
    """Rows and mean signed residual (predicted minus actual) per band of the target."""
    y = F.col(actual).cast("double")
    band = F.lit(len(limits))
    for i, limit in reversed(list(enumerate(limits))):
        band = F.when(y < limit, F.lit(i)).otherwise(band)
    return df.groupBy(band.cast("long").alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(predicted) - y).alias("mean_residual")
    )


def leak_check(assigned: DataFrame, columns: Sequence[str], fitted_means: dict[str, float]) -> DataFrame:
    """Fitted mean against the means of the training rows and of all rows."""
    in_train = F.col("partition") == "train"
    row = assigned.agg(
        *[F.avg(F.when(in_train, F.col(c))).alias(f"{c}__train_mean") for c in columns],
        *[F.avg(c).alias(f"{c}__full_mean") for c in columns],
        *[F.lit(float(fitted_means[c])).alias(f"{c}__fitted_mean") for c in columns],
    )
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"{c}__{p}").alias(p) for p in ("fitted_mean", "train_mean", "full_mean")],
        )
        for c in columns
    ]
    tall = row.select(F.inline(F.array(*entries)))
    near = F.abs(F.col("fitted_mean") - F.col("train_mean")) <= 1e-8 + 1e-5 * F.abs("train_mean")
    return tall.withColumn("fitted_on_train", near)


def best_and_worst(table: DataFrame, name: str, score: str) -> DataFrame:
    return table.agg(
        F.max_by(name, score).alias("best"),
        F.max(score).alias("best_score"),
        F.min_by(name, score).alias("worst"),
        F.min(score).alias("worst_score"),
    )


def rank_with_running_share(table: DataFrame, name: str, value: str) -> DataFrame:
    """Rank a short result table and add the running total of its values."""
    order = Window.orderBy(F.col(value).desc(), name)
    return table.select(
        F.row_number().over(order).alias("rank"),
        name,
        value,
        F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("running_share"),
    )


def _packed(rows: np.ndarray) -> list[list[float]]:
    return [list(map(float, r)) for r in rows]


def triangular_factor(df: DataFrame, columns: Sequence[str], intercept: bool, fan_in: int = 256) -> np.ndarray:
    """R of a QR decomposition of the whole table, reduced in a two-level tree.

    Each task folds its Arrow batches into one p x p factor, `fan_in` groups fold
    those, and the driver folds the last `fan_in` factors. R has the singular
    values of the table itself, without squaring the condition number.
    """
    width = len(columns) + int(intercept)

    def merge(r: np.ndarray, block: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([r, block]), mode="r")

    def per_task(batches):
        r = np.zeros((0, width))
        for batch in batches:
            block = batch.to_numpy(dtype=float)
            r = merge(r, np.hstack([block, np.ones((len(block), 1))]) if intercept else block)
        if len(r):
            part = TaskContext.get().partitionId() % fan_in
            yield pd.DataFrame({"part": [part], "r": [_packed(r)]})

    def per_group(group: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((0, width))
        for rows in group["r"]:
            r = merge(r, np.vstack(list(rows)))
        return pd.DataFrame({"part": group["part"].iloc[:1], "r": [_packed(r)]})

    schema = "part long, r array<array<double>>"
    factors = df.select(*columns).mapInPandas(per_task, schema)
    merged = factors.groupBy("part").applyInPandas(per_group, schema)
    r = np.zeros((0, width))
    for row in merged.toLocalIterator():
        r = merge(r, np.asarray(row["r"]))
    return r


def design_diagnostics(df: DataFrame, columns: Sequence[str], coefficients: Sequence[float] | None = None) -> DataFrame:
    """Shape, rank with intercept, condition number and largest coefficient."""
    spark = df.sparkSession
    r = triangular_factor(df, columns, True)
    n_rows = df.count()
    with_one = np.linalg.svd(r, compute_uv=False)
    # The constant is the last column, so the rest of R is the factor without it.
    plain = np.linalg.svd(r[:, :-1], compute_uv=False)
    width = len(columns) + 1
    tolerance = with_one.max() * max(n_rows, width) * np.finfo(float).eps
    condition = float(plain.max() / plain.min()) if plain.min() > 0 else float("inf")
    largest = max((abs(float(c)) for c in coefficients), default=0.0) if coefficients is not None else None
    return spark.createDataFrame(
        [(n_rows, len(columns), int((with_one > tolerance).sum()), width, condition, largest)],
        "n_rows long, n_columns int, rank_with_intercept int, full_rank int, condition_number double, max_abs_coefficient double",
    )
