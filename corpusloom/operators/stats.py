"""Descriptive statistics and class separation, each in one fused pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

from .ordered import join_groups, quantiles, quantiles_of_counts, running_sums, value_counts


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, feature, value) rows with `value` as double and NaN as null."""
    casted = df.select(*ids, *[clean_double(F.col(c)).alias(c) for c in columns])
    return casted.unpivot(list(ids), list(columns), "feature", "value")


def clean_double(col: Column) -> Column:
    value = col.cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def stack_columns(df: DataFrame, keep: Sequence[str], columns: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Turn `<column>__<part>` aggregates of one row into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{p}").alias(p) for p in parts])
        for c in columns
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def class_balance(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def _summary_of_counts(counts: DataFrame, by: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """count, mean, std, min, max and quantiles per group from written value counts,
    so that the rows themselves are read once."""
    v, n = F.col(value).cast("double"), F.col("n")
    total = F.sum("n")
    basic = counts.groupBy(*by).agg(
        total.alias("count"),
        (F.sum(v * n) / total).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    means = basic.select(*by, F.col("mean").alias("_mean"))
    gap = v - F.col("_mean")
    # Null groups are groups like others.
    spread = join_groups(counts, means, by).groupBy(*by).agg(
        F.sqrt(F.try_divide(F.sum(gap * gap * n), F.nullif(total - 1, F.lit(0)))).alias("std")
    )
    return join_groups(join_groups(basic, spread, by), quantiles_of_counts(counts, by, value, shares), by)


def grouped_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """count, mean, median, sample std, min, max per group."""
    counts = materialise(value_counts(df.filter(F.col(value).isNotNull()), by, value), "counts")
    return _summary_of_counts(counts, by, value, {"median": 0.5})


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, mean, std, min, quartiles, max.

    One aggregate for the moments; the quartiles by narrowing, so values are told apart only where a quartile lies.
    """
    rows = melt(df, columns).filter(F.col("value").isNotNull())
    basic = rows.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    return basic.join(quantiles(rows, ["feature"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, sketch=True), "feature")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, their count, and whether nothing else is there."""
    columns = list(columns or df.columns)
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()

    counted = df.agg(
        *[F.count_if(missing(c)).alias(f"{c}__n_missing") for c in columns],
        *[(F.count_if(missing(c)) == F.count(F.lit(1))).alias(f"{c}__all_missing") for c in columns],
    )
    return stack_columns(counted, [], columns, ["n_missing", "all_missing"]).filter("n_missing > 0")


def class_moments(df: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per column: count, mean and sample variance in each class, in one scan."""
    per_class = df.groupBy(*by, label).agg(
        *[
            agg(clean_double(F.col(c))).alias(f"{c}__{part}")
            for c in columns
            for part, agg in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
        ]
    )
    tall = stack_columns(per_class, [*by, label], columns, ["n", "mean", "var"])
    pick = [
        F.max(F.when(F.col(label) == y, F.col(part))).alias(f"{part}_{y}")
        for y in (0, 1)
        for part in ("n", "mean", "var")
    ]
    return tall.groupBy(*by, "feature").agg(*pick)


def cohens_d_of(n0: Column, m0: Column, v0: Column, n1: Column, m1: Column, v1: Column) -> Column:
    """Standardised mean difference. No spread at all means 0 for equal means and
    plus or minus infinity otherwise; fewer than two rows in a class means 0."""
    pooled = F.sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / F.greatest(n1 + n0 - 2, F.lit(1)))
    gap = m1 - m0
    infinite = F.when(gap > 0, F.lit(math.inf)).otherwise(F.lit(-math.inf))
    spread = F.when(pooled == 0, F.when(gap == 0, F.lit(0.0)).otherwise(infinite)).otherwise(
        F.try_divide(gap, pooled)
    )
    enough = (F.coalesce(n0, F.lit(0)) >= 2) & (F.coalesce(n1, F.lit(0)) >= 2)
    return F.when(enough, spread).otherwise(F.lit(0.0))


def cohens_d(df: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    m = class_moments(df, columns, label, by)
    d = cohens_d_of(*[F.col(c) for c in ("n_0", "mean_0", "var_0", "n_1", "mean_1", "var_1")])
    return m.select(*by, "feature", d.alias("cohens_d"), "mean_0", "mean_1")


def class_counts(df: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, value, n, pos): rows and positives per distinct value, written."""
    long = melt(df, columns, [*by, label]).filter(F.col("value").isNotNull())
    counts = long.groupBy(*by, "feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    return materialise(counts, "counts")


def stumps(df: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = (), **ordering) -> DataFrame:
    """Best one-threshold rule per feature (Gini) and the F1 of its predictions."""
    return stumps_of_counts(class_counts(df, columns, label, by), by, **ordering)


def stumps_of_counts(counts: DataFrame, by: Sequence[str] = (), **ordering) -> DataFrame:
    """The same from class counts per distinct value: running sums along the values
    give both leaves of every possible threshold. Ties go to the smallest threshold;
    a leaf without a strict majority predicts 0."""
    keys = [*by, "feature"]
    walked = running_sums(counts, keys, "value", ["n", "pos"], written=True, **ordering)
    nl, pl = F.col("cum_n"), F.col("cum_pos")
    nr, pr = F.col("tot_n") - nl, F.col("tot_pos") - pl

    def purity(n: Column, p: Column) -> Column:
        return F.coalesce(F.try_divide((p * p + (n - p) * (n - p)).cast("double"), n), F.lit(0.0))

    # The last value is "no split": it wins only where the feature is constant
    # or one class is absent.
    mixed = (F.col("tot_pos") > 0) & (F.col("tot_pos") < F.col("tot_n"))
    score = F.when((nr > 0) & mixed, purity(nl, pl) + purity(nr, pr)).otherwise(F.lit(-1.0))
    best = walked.groupBy(*keys).agg(
        F.max(
            F.struct(
                score.alias("score"),
                (-F.col("value")).alias("neg"),
                nl.alias("nl"),
                pl.alias("pl"),
                nr.alias("nr"),
                pr.alias("pr"),
            )
        ).alias("b")
    )
    split = F.col("b.score") >= 0
    pos, tot = F.col("b.pl") + F.col("b.pr"), F.col("b.nl") + F.col("b.nr")
    root_one = pos * 2 > tot
    left_one = F.when(split, F.col("b.pl") * 2 > F.col("b.nl")).otherwise(root_one)
    right_one = F.when(split, F.col("b.pr") * 2 > F.col("b.nr")).otherwise(root_one)
    tp = F.when(left_one, F.col("b.pl")).otherwise(0) + F.when(right_one, F.col("b.pr")).otherwise(0)
    flagged = F.when(left_one, F.col("b.nl")).otherwise(0) + F.when(right_one, F.col("b.nr")).otherwise(0)
    return best.select(
        *keys,
        F.when(split, -F.col("b.neg")).alias("split_value"),
        left_one.cast("int").alias("left_class"),
        right_one.cast("int").alias("right_class"),
        F.coalesce(F.try_divide(2.0 * tp, flagged + pos), F.lit(0.0)).alias("stump_f1"),
    )


def class_separation(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Effect size, stump F1 and class means per feature, strongest first. All of it
    comes from one set of class counts, i.e. one pass over the rows."""
    counts = class_counts(df, columns, label)
    rows = {0: F.col("n") - F.col("pos"), 1: F.col("pos")}
    sizes = counts.groupBy("feature").agg(
        *[F.sum(r).alias(f"n_{y}") for y, r in rows.items()],
        *[F.try_divide(F.sum(F.col("value") * r), F.sum(r)).alias(f"mean_{y}") for y, r in rows.items()],
    )
    gaps = {y: F.col("value") - F.col(f"mean_{y}") for y in rows}
    spread = counts.join(F.broadcast(sizes), "feature").groupBy("feature").agg(
        *[
            F.try_divide(F.sum(gaps[y] * gaps[y] * r), F.nullif(F.sum(r) - 1, F.lit(0))).alias(f"var_{y}")
            for y, r in rows.items()
        ]
    )
    d = cohens_d_of(*[F.col(c) for c in ("n_0", "mean_0", "var_0", "n_1", "mean_1", "var_1")])
    effect = sizes.join(spread, "feature").select("feature", d.alias("cohens_d"), "mean_0", "mean_1")
    rule = stumps_of_counts(counts).select("feature", "stump_f1")
    return effect.join(rule, "feature").orderBy(F.abs("cohens_d").desc(), "feature")


def pearson(x: Column, y: Column) -> Column:
    """r over complete pairs; null for a column without spread, where `corr` fails."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each column with the target, pairwise complete, in one scan."""
    y = clean_double(F.col(target))
    row = df.agg(*[pearson(clean_double(F.col(c)), y).alias(f"{c}__r") for c in columns])
    return stack_columns(row, [], columns, ["r"])


def strongest(df: DataFrame, columns: Sequence[str], target: str, n: int) -> DataFrame:
    ranked = correlations(df, columns, target)
    return ranked.orderBy(F.abs("r").desc_nulls_last(), "feature").limit(n)


def skew_summary(df: DataFrame, value: str) -> DataFrame:
    """Bias-corrected skewness with median, mean and maximum."""
    n = F.count(value).cast("double")
    row = df.agg(
        F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))).alias(
            "skewness"
        ),
        F.avg(value).alias("mean"),
        F.max(value).cast("double").alias("max"),
        F.lit(1).alias("_one"),
    )
    middle = quantiles(df, [], value, {"median": 0.5}, sketch=True).withColumn("_one", F.lit(1))
    return row.join(middle, "_one").drop("_one")


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per equal-width bin on [low, high]; the top edge belongs to the last bin."""
    v = F.col(value).cast("double")
    bin_no = F.least(F.width_bucket(v, F.lit(float(low)), F.lit(float(high)), F.lit(bins)), F.lit(bins))
    inside = df.filter((v >= low) & (v <= high))
    width = (high - low) / bins
    return (
        inside.groupBy(*by, bin_no.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(float(low)) + (F.col("bin") - 1) * F.lit(width))
    )


def histogram_over_range(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Histogram between the smallest and the largest value; equal values fill the first bin, no value none."""
    ends = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).first()
    if ends["lo"] is None:
        return histogram(df, value, 0.0, 1.0, bins)
    if ends["lo"] == ends["hi"]:
        return histogram(df, value, ends["lo"], ends["lo"] + 1.0, bins).withColumn("bin_start", F.lit(ends["lo"]))
    return histogram(df, value, ends["lo"], ends["hi"], bins)


def density(
    df: DataFrame, value: str, by: Sequence[str], low: float, high: float, points: int = 71
) -> DataFrame:
    """Gaussian density estimate on an even grid, with Scott's bandwidth per group.

    Values are counted first, so the sum per grid point runs over distinct values;
    the grid is expanded in the same stage as the partial sums.
    """
    by = list(by)
    clipped = df.filter(F.col(value).isNotNull()).withColumn("x", F.least(F.col(value).cast("double"), F.lit(float(high))))
    counts = clipped.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("n"))
    fitted = clipped.groupBy(*by).agg(
        (F.stddev_samp("x") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("h"),
        F.count(F.lit(1)).alias("total"),
    )
    step = (high - low) / (points - 1)
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(float(low)) + i * F.lit(step)))
    spread = join_groups(counts, fitted, by).select(*by, "x", "n", "h", "total", grid.alias("at"))
    z = F.try_divide(F.col("at") - F.col("x"), F.col("h"))  # null without any spread
    summed = spread.groupBy(*by, "at").agg(
        F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("s"),
        F.max("h").alias("h"),
        F.max("total").alias("total"),
    )
    return summed.select(
        *by, "at", F.try_divide("s", F.col("total") * F.col("h") * F.lit(math.sqrt(2 * math.pi))).alias("density")
    )




def binned_density(
    df: DataFrame, value: str, by: Sequence[str], low: float, high: float, points: int = 71, fineness: int = 32
) -> DataFrame:
    """`density` for columns with very many values: a row is shared out between the two nearest points of a fine even
    grid, and the kernel runs over that grid.

    The fine step is at most the smallest bandwidth divided by `fineness`, so the density is off by at most
    1 / (8 fineness^2 sqrt(2 pi) h): with 32 by about 0.00012 times the height of one kernel at its middle. A task hands on one
    row per occupied grid point, however many values there are. Without any spread in a group its density is null.
    """
    by = list(by)
    x = F.least(F.col(value).cast("double"), F.lit(float(high)))
    clipped = df.filter(F.col(value).isNotNull()).select(*by, x.alias("x"))
    fitted = materialise(
        clipped.groupBy(*by).agg(
            (F.stddev_samp("x") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("h"), F.count(F.lit(1)).alias("total"), F.min("x").alias("first"), F.max("x").alias("last")
        ),
        "bandwidths",
    )
    ends = fitted.agg(F.min("first"), F.max("last"), F.min(F.when(F.col("h") > 0, F.col("h")))).first()
    first, finest = (ends[0] or 0.0), ends[2]
    step = finest / fineness if finest else 1.0
    place = (F.col("x") - F.lit(first)) / F.lit(step)
    cell = F.floor(place)
    shares = F.array(
        F.struct(cell.alias("cell"), (1 - (place - cell)).alias("w")), F.struct((cell + 1).alias("cell"), (place - cell).alias("w"))
    )
    fine = clipped.select(*by, F.inline(shares)).groupBy(*by, "cell").agg(F.sum("w").alias("w"))
    apart = (high - low) / (points - 1)
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(float(low)) + i * F.lit(apart)))
    spread = join_groups(fine, fitted, by).select(*by, (F.lit(first) + F.col("cell") * F.lit(step)).alias("x"), "w", "h", "total", grid.alias("at"))
    z = F.try_divide(F.col("at") - F.col("x"), F.col("h"))
    summed = spread.groupBy(*by, "at").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("s"), F.max("h").alias("h"), F.max("total").alias("total"))
    return summed.select(*by, "at", F.try_divide("s", F.col("total") * F.col("h") * F.lit(math.sqrt(2 * math.pi))).alias("density"))
