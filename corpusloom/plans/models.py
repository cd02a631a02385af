"""Classifier and regressor comparisons, sweeps and learning curves on pyspark.ml.

Every experiment prepares its data once, writes it to the shared folder and lets
all fits read it; independent fits are submitted side by side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.redact import redact
from corpusloom.functions.text import char_length, digit_count
from corpusloom.operators.audit import step_gain
from corpusloom.operators.metrics import classification_scores, regression_scores
from corpusloom.operators.ordered import first_by_hash, group_counts
from corpusloom.operators.prep import prepare_split
from corpusloom.operators.resample import balanced_weights, over_sample, smote, under_sample
from corpusloom.operators.split import stratified_quotas
from corpusloom.operators.stats import strongest
from corpusloom.plans.exact_trees import ExactModel, ExactTrees
from corpusloom.plans.kernel_svr import FourierSVR
from corpusloom.workspace import materialise

# Forest size, seed, the single-feature model's column, curve points.
TREES = 200
SEED = 42
SIMPLE_FEATURE = "max_power"
FRACTIONS = (0.05, 0.10, 0.25, 0.50, 0.75, 1.00)
PARALLEL_FITS = 4


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def as_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.array(*[quoted(c).cast("double") for c in columns])))


def side_by_side(jobs: Sequence[Callable], parallel: int = PARALLEL_FITS) -> list:
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(lambda job: job(), jobs))


# -- classifiers -----------------------------------------------------------
def tree_classifier(max_depth: int | None = None, **params):
    """Unpruned with exact split points; with `max_depth`, Spark's own binned tree."""
    if max_depth is None:
        return ExactTrees(2, label=params.get("labelCol", "label"), weight=params.get("weightCol"), seed=SEED)
    return DecisionTreeClassifier(maxDepth=max_depth, maxBins=256, impurity="gini", seed=SEED, **params)


def forest_classifier(trees: int = TREES, max_depth: int | None = None, **params):
    """Unpruned with exact split points; with `max_depth`, Spark's own binned forest."""
    if max_depth is None:
        return ExactTrees(2, trees, "sqrt", params.get("labelCol", "label"), weight=params.get("weightCol"), seed=SEED)
    return RandomForestClassifier(
        numTrees=trees, maxDepth=max_depth, maxBins=256, featureSubsetStrategy="sqrt", seed=SEED,
        maxMemoryInMB=1024, **params,
    )


def score_rows(model, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`keep` columns with `predicted` (0/1) and `p`, the probability of class 1."""
    scored = model.transform(rows)
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("p"),
    )


def majority_prediction(train: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """The most frequent training class for every row (the smaller one on ties)."""
    sizes = group_counts(train, label)
    top = min(sizes, key=lambda g: (-sizes[g], g))
    return rows.withColumn("predicted", F.lit(int(top))).withColumn("p", F.lit(float(top)))


def importances(model, columns: Sequence[str], spark) -> DataFrame:
    """Impurity importances; they favour features with many distinct values."""
    found = model.importances() if isinstance(model, ExactModel) else model.featureImportances.toArray()
    values = [(c, float(v)) for c, v in zip(columns, found)]
    return spark.createDataFrame(values, "feature string, importance double")


def compare_classifiers(
    prepared: DataFrame, columns: Sequence[str], label: str, *, trees: int = TREES, max_depth: int | None = None
) -> tuple[DataFrame, dict]:
    """Majority baseline, unpruned tree and forest: test scores and training F1."""
    rows = materialise(as_vector(prepared, columns).select(label, "partition", "features"), "prepared")
    train = rows.filter("partition = 'train'")
    fits = {
        "Decision tree": tree_classifier(max_depth, labelCol=label),
        f"Random forest ({trees} trees)": forest_classifier(trees, max_depth, labelCol=label),
    }
    models = dict(zip(fits, side_by_side([lambda e=e: e.fit(train) for e in fits.values()])))
    scored = {"Baseline (most frequent)": majority_prediction(train, rows, label).drop("p")}
    scored |= {n: score_rows(m, rows, [label, "partition"]) for n, m in models.items()}
    table = None
    for name, frame in scored.items():
        part = frame.select(F.lit(name).alias("model"), label, "partition", "predicted")
        table = part if table is None else table.unionByName(part)
    by_half = classification_scores(table, label, "predicted", ["model", "partition"])
    test = by_half.filter("partition = 'test'").drop("partition")
    fitted = by_half.filter("partition = 'train'").select("model", F.col("f1").alias("train_f1"))
    return test.join(fitted, "model"), models


def error_listing(
    scored: DataFrame, actual: str, text: str, n: int = 4, max_chars: int = 58
) -> DataFrame:
    """The surest mistakes of both kinds with redacted text: missed positives with
    the lowest and misfiled negatives with the highest probability."""
    def pick(kind: str, wanted: Column, order: Column) -> DataFrame:
        return scored.filter(wanted).orderBy(order, "row_key").limit(n).select(
            F.lit(kind).alias("error"),
            "row_key",
            "p",
            char_length(F.col(text)).cast("long").alias("n_chars"),
            digit_count(F.col(text)).cast("long").alias("n_digits"),
            redact(F.col(text), max_chars=max_chars).alias("shown"),
        )

    a, p = F.col(actual), F.col("predicted")
    missed = pick("missed", (a == 1) & (p == 0), F.col("p").asc())
    return missed.unionByName(pick("misfiled", (a == 0) & (p == 1), F.col("p").desc()))


def learning_curve(
    prepared: DataFrame,
    key: str,
    columns: Sequence[str],
    label: str,
    *,
    fractions: Sequence[float] = FRACTIONS,
    seeds: int = 5,
    estimator_factory: Callable[[], object] | None = None,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """Test F1 against the share of training rows, each share a stratified
    hash-order subsample drawn with several seeds; all rows are fitted once."""
    make = estimator_factory or (lambda: forest_classifier(labelCol=label))
    rows = materialise(as_vector(prepared, columns).select(key, label, "partition", "features"), "prepared")
    train, test = rows.filter("partition = 'train'"), rows.filter("partition = 'test'")
    sizes = group_counts(train, label)
    n = sum(sizes.values())

    def one(fraction: float, seed: int):
        subset, size = train, n
        if fraction < 1:
            size = math.floor(n * fraction + 1e-9)
            subset = first_by_hash(train, key, seed, stratified_quotas(sizes, size), label)
        model = make().fit(subset)
        scored = model.transform(test).select(label, F.col("prediction").cast("int").alias("predicted"))
        f1 = classification_scores(scored, label, "predicted").first()["f1"]
        return fraction, seed, size, f1

    jobs = [
        lambda f=f, s=s: one(f, s) for f in fractions for s in range(1 if f >= 1 else seeds)
    ]
    runs = train.sparkSession.createDataFrame(
        side_by_side(jobs, parallel), "fraction double, seed int, n_rows long, f1 double"
    )
    curve = runs.groupBy("fraction").agg(
        F.max("n_rows").alias("n_rows"), F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std")
    )
    return step_gain(curve, "fraction", "f1_mean").orderBy("fraction")


def compare_resampling(
    prepared: DataFrame,
    key: str,
    columns: Sequence[str],
    label: str,
    *,
    estimator_factory: Callable[..., object] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Ways of balancing the training half, all scored on one untouched test half."""
    make = estimator_factory or (lambda **p: forest_classifier(labelCol=label, **p))
    rows = materialise(prepared.select(key, label, "partition", *[quoted(c) for c in columns]), "prepared")
    train, test = rows.filter("partition = 'train'").drop("partition"), as_vector(
        rows.filter("partition = 'test'"), columns
    )
    variants: Mapping[str, Callable[[], DataFrame]] = {
        "none": lambda: train,
        "balanced weights": lambda: balanced_weights(train, label),
        "random over-sampling": lambda: over_sample(train, key, label, seed),
        "SMOTE (k=5)": lambda: smote(train, key, label, columns, k=5, seed=seed),
        "SMOTE (k=1)": lambda: smote(train, key, label, columns, k=1, seed=seed),
        "random under-sampling": lambda: under_sample(train, key, label, seed),
    }

    def one(position: int, name: str):
        data = materialise(as_vector(variants[name](), columns), "resampled")
        sizes = group_counts(data, label)
        params = {"weightCol": "weight"} if "weight" in data.columns else {}
        model = make(**params).fit(data)
        scored = model.transform(test).select(label, F.col("prediction").cast("int").alias("predicted"))
        s = classification_scores(scored, label, "predicted").first()
        n = sum(sizes.values())
        return position, name, n, sizes.get(1, 0) / n, s["precision"], s["recall"], s["f1"]

    found = side_by_side([lambda i=i, v=v: one(i, v) for i, v in enumerate(variants)], 2)
    base = found[0][-1]
    return train.sparkSession.createDataFrame(
        [(*r, r[-1] - base) for r in found],
        "position int, strategy string, train_rows long, train_positive_share double, "
        "precision double, recall double, f1 double, f1_gain double",
    )


# -- regressors ------------------------------------------------------------
def polynomial(degree: int, numeric: Sequence[str], others: Sequence[str], target: str) -> Pipeline:
    """All monomials of the numeric columns up to `degree`, without a constant; the
    0/1 columns enter as they are, since their powers repeat them."""
    expand = PolynomialExpansion(degree=degree, inputCol="_num", outputCol="_poly")
    join = VectorAssembler(inputCols=["_poly", "_rest"] if others else ["_poly"], outputCol="_all")
    line = LinearRegression(featuresCol="_all", labelCol=target, solver="auto", regParam=0.0)
    return Pipeline(stages=[expand, join, line])


def run_comparison(
    df: DataFrame,
    key: str,
    target: str,
    *,
    simple_feature: str = SIMPLE_FEATURE,
    seed: int = SEED,
    max_categories: int = 20,
    trees: int = TREES,
    max_depth: int | None = None,
    max_bins: int = 1024,
    fourier_components: int = 200,
) -> tuple[DataFrame, dict]:
    """Six regression families on one split and one preparation, best test R2 first."""
    _, prep, prepared = prepare_split(df, key, target, seed=seed, max_categories=max_categories)
    names, numeric = prep.feature_names_out, prep.numeric_columns
    if simple_feature not in names:
        raise KeyError(f"{simple_feature!r} is not among the prepared columns: {names[:10]}.")
    rest = [c for c in names if c not in numeric]
    wide = as_vector(as_vector(as_vector(prepared, names), numeric, "_num"), rest, "_rest")
    wide = materialise(as_vector(wide, [simple_feature], "_one"), "prepared")
    train = wide.filter("partition = 'train'")
    line = {"labelCol": target, "solver": "auto", "regParam": 0.0}

    def grown(n: int):
        """Unpruned with exact split points, unless a depth is given."""
        if max_depth is None:
            return ExactTrees(0, n, label=target, seed=seed)
        binned = {"labelCol": target, "maxDepth": max_depth, "maxBins": max_bins, "seed": seed}
        if n == 1:
            return DecisionTreeRegressor(**binned)
        return RandomForestRegressor(numTrees=n, featureSubsetStrategy="all", maxMemoryInMB=1024, **binned)

    fits: dict[str, Callable] = {
        "Simple linear (1 feature)": lambda: LinearRegression(featuresCol="_one", **line).fit(train),
        "Multiple linear": lambda: LinearRegression(**line).fit(train),
        "Polynomial (degree 3)": lambda: polynomial(3, numeric, rest, target).fit(train),
        "RBF (random Fourier features)": lambda: FourierSVR(fourier_components, seed=seed).fit(train, names, target),
        "Decision tree": lambda: grown(1).fit(train),
        f"Random forest ({trees} trees)": lambda: grown(trees).fit(train),
    }
    models = dict(zip(fits, side_by_side(list(fits.values()))))
    scored = None
    for name, model in models.items():
        predicted = model.predict(wide) if isinstance(model, FourierSVR) else model.transform(wide)
        part = predicted.select(F.lit(name).alias("model"), "partition", target, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    width = F.when(F.col("model").startswith("Simple"), 1).otherwise(len(names)).alias("n_features")
    return _two_sided(scored, target, ["model"], [width]).orderBy(F.col("test_r2").desc()), models


def _two_sided(scored: DataFrame, target: str, by: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    scores = regression_scores(scored, target, "prediction", [*by, "partition"])
    wide = scores.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("partition") == p, F.col(c))).alias(f"{p}_{c}")
            for c in ("r2", "rmse")
            for p in ("test", "train")
        ]
    )
    return wide.select(*by, *extra, "test_r2", "test_rmse", "train_r2", "train_rmse", (F.col("train_r2") - F.col("test_r2")).alias("r2_gap"))


def degree_sweep(
    df: DataFrame,
    key: str,
    target: str,
    *,
    degrees: Sequence[int] = (1, 2, 3, 4),
    seed: int = SEED,
    n_features: int = 6,
    max_categories: int = 20,
) -> DataFrame:
    """Train and test R2 per polynomial degree on the most correlated numeric
    columns, with the change from degree to degree and the degree of the best test R2."""
    _, prep, prepared = prepare_split(df, key, target, seed=seed, max_categories=max_categories)
    train = prepared.filter("partition = 'train'")
    columns = [r["feature"] for r in strongest(train, prep.numeric_columns, target, n_features).collect()]
    wide = materialise(as_vector(prepared, columns, "_num").select("partition", target, "_num"), "prepared")
    train = wide.filter("partition = 'train'")
    models = side_by_side([lambda d=d: polynomial(d, columns, [], target).fit(train) for d in degrees])
    scored = None
    terms = F.lit(None).cast("int")
    for degree, model in zip(degrees, models):
        terms = F.when(F.col("degree") == degree, F.lit(int(model.stages[-1].numFeatures))).otherwise(terms)
        part = model.transform(wide).select(F.lit(degree).alias("degree"), "partition", target, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    table = _two_sided(scored, target, ["degree"], [terms.alias("n_terms")])
    steps, everything = Window.orderBy("degree"), Window.partitionBy()
    best = F.max_by("degree", "test_r2").over(everything)
    return table.select(
        "*",
        (F.col("train_r2") - F.lag("train_r2").over(steps)).alias("train_r2_change"),
        (F.col("test_r2") - F.lag("test_r2").over(steps)).alias("test_r2_change"),
        (F.col("degree") == best).alias("is_test_peak"),
    ).orderBy("degree")


def simple_line(df: DataFrame, x: str, y: str) -> tuple[float, float, float]:
    """Slope, intercept and r2 of a one-feature fit, from one aggregate."""
    row = df.agg(F.regr_slope(y, x).alias("a"), F.regr_intercept(y, x).alias("b"), F.regr_r2(y, x).alias("r")).first()
    return row["a"], row["b"], row["r"]


