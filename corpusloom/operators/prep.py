"""Impute, encode and scale with statistics of the training rows only.

Fitting is a handful of aggregates over the training half; the fitted state is a
small struct on the driver (bounded by columns x levels), and applying it is one
projection of literals, on any DataFrame, streaming included.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from corpusloom.functions.listings import to_number

from corpusloom.workspace import materialise

from .ordered import bounded_rows, quantiles
from .split import Split, TrainingPartition, split_rows
from .stats import clean_double, melt, stack_columns

MAX_LEVELS = 10_000
# Fixed value: the name of the column that rare levels are folded into.
RARE = "infrequent_sklearn"
NUMERIC_STRATEGIES = ("median", "mean", "most_frequent", "constant")
CATEGORICAL_STRATEGIES = ("most_frequent", "constant")


class NotFittedError(RuntimeError):
    pass


class AlreadyFittedError(RuntimeError):
    pass


@dataclass
class Level:
    """One output column of a categorical input: the values it stands for."""

    name: str
    values: tuple[str, ...]
    n: int
    mean: float = 0.0
    scale: float = 1.0
    in_table: bool = False  # too many values for literals: looked up in the level table


@dataclass
class ColumnState:
    column: str
    kind: str
    fill: float | str | None = None
    mean: float = 0.0
    scale: float = 1.0
    n_levels: int = 0
    levels: list[Level] = field(default_factory=list)


def column_kinds(df: DataFrame) -> dict[str, str]:
    """Numbers and booleans are numeric, everything else is categorical."""
    return {
        f.name: "numeric" if isinstance(f.dataType, (NumericType, BooleanType)) else "categorical"
        for f in df.schema.fields
    }


def level_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, level, n) for all categorical columns in one shuffle."""
    tall = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "feature", "level"
    )
    return tall.filter("level IS NOT NULL").groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))


def modes(counts: DataFrame) -> DataFrame:
    """The most frequent level per feature, the smallest one on ties."""
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("neg"), "level")).alias("b"))
    return best.select("feature", F.col("b.level").alias("mode"), (-F.col("b.neg")).alias("n"))


def numeric_moments(df: DataFrame, columns: list[str], fills: dict[str, float]) -> DataFrame:
    """Mean and population deviation after imputation."""
    filled = {c: F.coalesce(_number(df, c), F.lit(float(fills[c]))) for c in columns}
    row = df.agg(
        *[F.avg(v).alias(f"{c}__mean") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"{c}__std") for c, v in filled.items()],
    )
    return stack_columns(row, [], columns, ["mean", "std"])


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (NumericType, BooleanType)):
        return clean_double(F.col(column))
    return to_number(F.col(column))


def fold_levels(
    counts: DataFrame, max_categories: int | None, min_frequency: int | float | None, n_rows: int
) -> DataFrame:
    """Mark rare levels.

    `min_frequency` is a row count or a share of rows. `max_categories` caps the
    output columns including the folded one: the most frequent `max - 1` levels
    are kept (on equal counts the last in sort order), and only a feature with
    fewer levels than the cap is left as it is.
    """
    floor = 0.0
    if min_frequency is not None:
        floor = float(min_frequency) if isinstance(min_frequency, int) else min_frequency * n_rows
    flagged = counts.withColumn("rare", F.col("n") < F.lit(floor))
    if max_categories is None:
        return flagged
    frequent = flagged.filter(~F.col("rare"))
    order = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("level").desc())
    # A rank filter: every task keeps its own best rows before the shuffle.
    top = frequent.withColumn("_place", F.row_number().over(order)).filter(
        F.col("_place") <= max_categories - 1
    )
    kept = top.select(F.col("feature").alias("_f"), F.col("level").alias("_l"), F.lit(True).alias("_kept"))
    sizes = frequent.groupBy(F.col("feature").alias("_sf")).agg(F.count(F.lit(1)).alias("_size"))
    # Both sides are bounded by features x max_categories.
    joined = flagged.join(
        F.broadcast(kept), (F.col("feature") == F.col("_f")) & (F.col("level") == F.col("_l")), "left"
    ).join(F.broadcast(sizes), F.col("feature") == F.col("_sf"), "left")
    over_cap = (F.coalesce("_size", F.lit(0)) + 1 > max_categories) & F.col("_kept").isNull()
    return joined.select(*counts.columns, (F.col("rare") | over_cap).alias("rare"))


@dataclass
class Preparation:
    numeric_strategy: str = "median"
    categorical_strategy: str = "most_frequent"
    scale: bool = True
    scale_encoded: bool = False
    max_categories: int | None = None
    min_frequency: int | float | None = None
    drop_first: bool = False
    states: list[ColumnState] = field(default_factory=list, init=False)
    n_rows_seen: int = field(default=0, init=False)
    level_table: DataFrame | None = field(default=None, init=False)

    # -- fit ---------------------------------------------------------------
    def fit(self, partition: TrainingPartition) -> Preparation:
        if not isinstance(partition, TrainingPartition):
            raise TypeError(
                f"fit() takes the training half of a split, not {type(partition).__name__}: "
                "statistics of held-out rows must not reach the model."
            )
        if self.is_fitted:
            raise AlreadyFittedError("Already fitted; use clone_unfitted().")
        if self.numeric_strategy not in NUMERIC_STRATEGIES:
            raise ValueError(f"numeric_strategy must be one of {NUMERIC_STRATEGIES}.")
        if self.categorical_strategy not in CATEGORICAL_STRATEGIES:
            raise ValueError(f"categorical_strategy must be one of {CATEGORICAL_STRATEGIES}.")
        train = partition.X
        n_rows = train.count()
        if n_rows == 0:
            raise ValueError("The training half is empty.")
        kinds = column_kinds(train)
        numeric = [c for c, k in kinds.items() if k == "numeric"]
        categorical = [c for c, k in kinds.items() if k == "categorical"]
        states: list[ColumnState] = []
        if numeric:
            states += self._fit_numeric(train, numeric)
        if categorical:
            states += self._fit_categorical(train, categorical, n_rows)
        self.states, self.n_rows_seen = states, n_rows
        return self

    def _fit_numeric(self, train: DataFrame, columns: list[str]) -> list[ColumnState]:
        fills = dict.fromkeys(columns, 0.0)
        fills.update(self._numeric_fills(train, columns))
        moments = {r["feature"]: r for r in numeric_moments(train, columns, fills).collect()}
        states = []
        for c in columns:
            state = ColumnState(c, "numeric", fill=fills[c])
            if self.scale:
                state.mean = moments[c]["mean"]
                state.scale = moments[c]["std"] or 1.0
            states.append(state)
        return states

    def _numeric_fills(self, train: DataFrame, columns: list[str]) -> dict[str, float]:
        if self.numeric_strategy == "constant":
            return {}
        if self.numeric_strategy == "mean":
            row = train.agg(*[F.avg(clean_double(F.col(c))).alias(c) for c in columns]).first()
            return {c: row[c] for c in columns if row[c] is not None}
        tall = melt(train, columns).filter("value IS NOT NULL")
        if self.numeric_strategy == "median":
            rows = quantiles(tall, ["feature"], "value", {"fill": 0.5}, sketch=True).collect()
        else:
            counts = tall.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
            best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("b"))
            rows = best.select("feature", F.col("b.value").alias("fill")).collect()
        return {r["feature"]: r["fill"] for r in rows}

    def _fit_categorical(self, train: DataFrame, columns: list[str], n_rows: int) -> list[ColumnState]:
        # An all-missing column gets the constant "0", like a constant imputer.
        fills = dict.fromkeys(columns, "0" if self.categorical_strategy == "most_frequent" else "missing_value")
        counts = materialise(level_counts(train, columns), "levels")
        if self.categorical_strategy == "most_frequent":
            fills.update({r["feature"]: r["mode"] for r in modes(counts).collect()})
        present = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
        # Imputed rows join the counts of their fill, without reading the rows again.
        imputed = [(c, fills[c], n_rows - present.get(c, 0)) for c in columns if present.get(c, 0) < n_rows]
        extra = train.sparkSession.createDataFrame(imputed, "feature string, level string, n long")
        filled = counts.unionByName(extra).groupBy("feature", "level").agg(F.sum("n").alias("n"))
        folded = fold_levels(filled, self.max_categories, self.min_frequency, n_rows)
        self.level_table = materialise(folded, "levels")
        frequent = bounded_rows(
            self.level_table.filter(~F.col("rare")), MAX_LEVELS, "category levels; set max_categories"
        )
        folds = {
            r["feature"]: r
            for r in self.level_table.filter("rare")
            .groupBy("feature")
            .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("levels"))
            .collect()
        }
        named = {c for c, r in folds.items() if r["levels"] <= MAX_LEVELS}
        rare_rows = self.level_table.filter(F.col("rare") & F.col("feature").isin(*named)).collect() if named else []
        states = []
        for c in columns:
            mine = sorted((r["level"], r["n"]) for r in frequent if r["feature"] == c)
            kept = [Level(f"{c}_{v}", (v,), n) for v, n in mine]
            if c in folds:
                values = tuple(sorted(r["level"] for r in rare_rows if r["feature"] == c))
                kept.append(Level(f"{c}_{RARE}", values, folds[c]["rows"], in_table=c not in named))
            n_levels = len(mine) + (folds[c]["levels"] if c in folds else 0)
            if self.drop_first:
                kept = kept[1:]
            if self.scale_encoded:
                for level in kept:
                    level.mean = level.n / n_rows
                    level.scale = (level.mean * (1 - level.mean)) ** 0.5 or 1.0
            states.append(ColumnState(c, "categorical", fill=fills[c], n_levels=n_levels, levels=kept))
        return states

    # -- apply -------------------------------------------------------------
    def transform(self, df: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
        """`keep` columns, then the fitted output columns; one projection."""
        self._check()
        if isinstance(df, TrainingPartition):
            raise TypeError("transform() takes a DataFrame; pass partition.rows.")
        if not isinstance(df, DataFrame):
            raise TypeError(f"transform() takes a DataFrame, got {type(df).__name__}.")
        expected = [s.column for s in self.states]
        missing = [c for c in expected if c not in df.columns]
        if missing:
            raise KeyError(f"Columns seen at fit time are missing: {missing}.")
        extra = [c for c in df.columns if c not in expected and c not in keep]
        if extra:
            warnings.warn(f"Leaving out {len(extra)} column(s) not seen at fit time: {extra[:8]}", stacklevel=2)
        out: list[Column] = []
        for s in self.states:
            if s.kind == "numeric":
                value = F.coalesce(_number(df, s.column), F.lit(float(s.fill)))
                out.append(((value - s.mean) / s.scale if self.scale else value).alias(s.column))
                continue
            level = F.coalesce(F.col(s.column).cast("string"), F.lit(s.fill))
            for target in s.levels:
                if target.in_table:
                    df, known = self._look_up(df, s.column, level)
                else:
                    known = level.isin(*target.values)
                hit = F.when(known, 1.0).otherwise(0.0)
                if self.scale_encoded:
                    hit = (hit - target.mean) / target.scale
                out.append(hit.alias(target.name))
        return df.select(*keep, *out)

    def fit_transform(self, partition: TrainingPartition, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
        return self.fit(partition).transform(partition.rows.select(*keep, *partition.columns), keep)

    def fit_on_split(self, split: Split) -> DataFrame:
        """Fit on the training half and transform both: key, target and `partition`
        followed by the output columns."""
        keep = [split.key, *([split.target] if split.target else []), "partition"]
        self.fit(split.train)
        return self.transform(split.assigned.select(*keep, *split.model_columns), keep)

    def unseen_categories(self, df: DataFrame) -> DataFrame:
        """(feature, level) pairs of `df` that the fit never saw; nulls ignored."""
        self._check()
        columns = [s.column for s in self.states if s.kind == "categorical" and s.column in df.columns]
        if not columns:
            return df.sparkSession.createDataFrame([], "feature string, level string")
        found = level_counts(df, columns).select("feature", "level")
        return found.join(self.level_table, ["feature", "level"], "left_anti").orderBy("feature", "level")

    def _look_up(self, df: DataFrame, column: str, level: Column) -> tuple[DataFrame, Column]:
        rare = self.level_table.filter(F.col("rare") & (F.col("feature") == column)).select(
            F.col("level").alias(f"_rare_{column}")
        )
        joined = df.join(rare, level == F.col(f"_rare_{column}"), "left")
        return joined, F.col(f"_rare_{column}").isNotNull()

    def clone_unfitted(self) -> Preparation:
        return Preparation(
            self.numeric_strategy, self.categorical_strategy, self.scale, self.scale_encoded,
            self.max_categories, self.min_frequency, self.drop_first,
        )

    @property
    def is_fitted(self) -> bool:
        return bool(self.states)

    @property
    def numeric_columns(self) -> list[str]:
        return [s.column for s in self.states if s.kind == "numeric"]

    @property
    def feature_names_out(self) -> list[str]:
        self._check()
        return [
            name
            for s in self.states
            for name in ([s.column] if s.kind == "numeric" else [level.name for level in s.levels])
        ]

    def summary(self, spark) -> DataFrame:
        self._check()
        rows = [
            (s.column, s.kind, str(s.fill), float(s.mean), float(s.scale), s.n_levels, self.n_rows_seen)
            for s in self.states
        ]
        return spark.createDataFrame(
            rows,
            "column string, kind string, fill string, mean double, scale double, n_levels int, n_rows_seen long",
        )

    def _check(self) -> None:
        if not self.is_fitted:
            raise NotFittedError("Call fit() with the training half of a split first.")


def train_against_full(split: Split, columns: list[str]) -> DataFrame:
    """Mean and deviation per numeric column over the training half, which a fit sees, and over all rows, which it must not see."""
    rows = split.assigned.select("partition", *columns)
    tall = melt(rows, columns, ["partition"])
    train = F.when(F.col("partition") == "train", F.col("value"))
    return tall.groupBy("feature").agg(
        F.avg(train).alias("train_mean"), F.avg("value").alias("full_mean"), F.stddev_pop(train).alias("train_std"), F.stddev_pop("value").alias("full_std")
    )


def prepare_split(
    df: DataFrame,
    key: str,
    target: str,
    *,
    test_size: float = 0.2,
    seed: int = 42,
    max_categories: int = 20,
) -> tuple[Split, Preparation, DataFrame]:
    """Rows with a target, de-duplicated on the whole row, split, prepared."""
    if target not in df.columns:
        raise KeyError(f"Target {target!r} is not a column; columns are {df.columns}.")
    split = split_rows(df.dropna(subset=[target]), key, target=target, test_size=test_size, seed=seed)
    prep = Preparation(max_categories=max_categories, drop_first=True)
    return split, prep, prep.fit_on_split(split)
