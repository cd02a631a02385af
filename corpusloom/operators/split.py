"""De-duplicate, then split: the only way to obtain a training partition."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

from .dedupe import drop_duplicates
from .ordered import flag_first_by_hash, global_rank, group_sizes, hash_key
from .stats import class_balance

#: Strata of at most so many rows are sorted by the task that holds them.
RANKED_ROWS = 100_000


class TrainingPartition:
    """The training half of a split: what a fit may learn from. It is a view of a `Split`."""

    def __init__(self, split: Split):
        if not isinstance(split, Split):
            raise TypeError(f"The training half of a split is taken from a Split, not from {type(split).__name__}.")
        self.rows = split.assigned.filter("partition = 'train'")
        self.columns, self.key, self.target = split.model_columns, split.key, split.target

    @property
    def X(self) -> DataFrame:
        return self.rows.select(*self.columns)


@dataclass(frozen=True)
class Split:
    """Both halves of a split. `assigned` holds all rows with a `partition` column;
    model columns, key, target and meta columns stay on the same row."""

    assigned: DataFrame
    key: str
    model_columns: tuple[str, ...]
    meta_columns: tuple[str, ...]
    target: str | None
    n_rows_before: int
    n_rows_after: int

    @property
    def train(self) -> TrainingPartition:
        return TrainingPartition(self)

    @property
    def n_duplicates_dropped(self) -> int:
        return self.n_rows_before - self.n_rows_after

    @property
    def test_rows(self) -> DataFrame:
        return self.assigned.filter("partition = 'test'")

    @property
    def test_X(self) -> DataFrame:
        return self.test_rows.select(*self.model_columns)

    def meta(self, partition: str) -> DataFrame | None:
        """Columns held out of the model, keyed by row; None when there are none."""
        if not self.meta_columns:
            return None
        half = self.assigned.filter(F.col("partition") == partition)
        return half.select(self.key, *self.meta_columns)

    def describe(self) -> DataFrame:
        """Class balance per partition, one row per label."""
        if self.target is None:
            raise ValueError("The split has no target to describe.")
        return balance_by_partition(self.assigned, self.target)


def balance_by_partition(assigned: DataFrame, target: str) -> DataFrame:
    shares = class_balance(assigned.select("partition", F.col(target).alias("_label")), "_label", ["partition"])
    return shares.groupBy(F.col("_label").alias(target)).agg(
        *[
            F.coalesce(F.max(F.when(F.col("partition") == p, F.col(c))), F.lit(zero)).alias(f"{p}_{c}")
            for p in ("train", "test")
            for c, zero in (("n", 0), ("share", 0.0))
        ]
    )


def test_quota(n: int, test_size: float) -> int:
    return math.ceil(n * test_size - 1e-9)


def stratified_quotas(sizes: Mapping, total: int) -> dict:
    """Share `total` among groups in proportion to size, by largest remainder."""
    n = sum(sizes.values())
    exact = {g: total * s / n for g, s in sizes.items()}
    quotas = {g: math.floor(e + 1e-9) for g, e in exact.items()}
    short = total - sum(quotas.values())
    by_rest = sorted(sizes, key=lambda g: (-(round(exact[g] - quotas[g], 9)), str(g)))
    for g in by_rest[:short]:
        quotas[g] += 1
    return quotas


def quota_table(sizes: DataFrame, group: str, total: int, range_rows: int | None = None) -> DataFrame:
    """The same as a table: `group` and `quota` from a written table of `group` and `n`.

    Strata may be as many as rows: two sums are taken over them, and the remainders are ranked in range partitions.
    """
    n = sizes.agg(F.sum("n")).first()[0]
    exact = F.lit(total) * F.col("n") / F.lit(n)
    floors = sizes.select(group, "n", exact.alias("_exact")).withColumn("_floor", F.floor(F.col("_exact") + 1e-9))
    short = total - (floors.agg(F.sum("_floor")).first()[0] or 0)
    if not short:
        return floors.select(group, F.col("_floor").alias("quota"))
    rest = F.round(F.col("_exact") - F.col("_floor"), 9)
    named = floors.select(group, "_floor", rest.alias("_rest"), F.coalesce(F.col(group).cast("string"), F.lit("None")).alias("_name"))
    ranked = global_rank(named, [F.col("_rest").desc(), "_name"], "_place", range_rows)
    return ranked.select(group, (F.col("_floor") + (F.col("_place") < short).cast("long")).alias("quota"))


def _ranked_in_strata(df: DataFrame, key: str, seed: int, stratify: str, quotas: DataFrame) -> DataFrame:
    """The same rows as by cuts, for strata that a task can sort: the rows are shuffled once, without their hashes."""
    null_quota = quotas.filter(F.col(stratify).isNull()).select("quota").first()
    quotas = quotas.filter(F.col(stratify).isNotNull()).select(F.col(stratify).alias("_stratum"), F.col("quota").alias("_quota"))
    dealt = df.repartition(F.col(stratify)).withColumn("_h", hash_key(key, seed))
    # Equal hashes are on the same side, as with a cut.
    placed = dealt.withColumn("_place", F.rank().over(Window.partitionBy(stratify).orderBy("_h")))
    met = placed.join(quotas, F.col(stratify) == F.col("_stratum"), "left")
    quota = F.when(F.col(stratify).isNull(), F.lit(null_quota["quota"] if null_quota else 0)).otherwise(F.col("_quota"))
    return met.withColumn("partition", F.when(F.col("_place") <= quota, "test").otherwise("train")).select(*df.columns, "partition")


def assign_partitions(
    df: DataFrame,
    key: str,
    *,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: str | None = None,
) -> DataFrame:
    """Add `partition`. Rows are ordered by a hash of seed and key and cut exactly at
    the quota: no sort or window of the rows. Strata may be as many as there are rows."""
    if stratify is None:
        quotas = test_quota(df.count(), test_size)
    else:
        sizes = materialise(group_sizes(df, stratify), "strata")
        n, largest = sizes.agg(F.sum("n"), F.max("n")).first()
        quotas = quota_table(sizes, stratify, test_quota(n or 0, test_size))
        if (largest or 0) <= RANKED_ROWS:
            return _ranked_in_strata(df, key, seed, stratify, quotas)
    taken = flag_first_by_hash(df, key, seed, quotas, stratify, "_test")
    return taken.withColumn("partition", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def split_rows(
    df: DataFrame,
    key: str,
    *,
    target: str | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool | str = False,
    dedupe: bool = True,
    duplicate_subset: Sequence[str] | None = None,
    keep_columns: Sequence[str] | None = None,
) -> Split:
    """Drop exact duplicates, then split once for features, target and meta columns.

    The duplicate check covers every column but the key, the target included, so
    equal features with different targets stay two observations.
    """
    for column in [key, *([target] if target else []), *(duplicate_subset or [])]:
        if column not in df.columns:
            raise KeyError(f"No column {column!r}; columns are {df.columns}.")
    if stratify is True:
        if target is None:
            raise ValueError("stratify=True needs a target.")
        stratify = target
    if stratify and stratify not in df.columns:
        raise ValueError("Stratify on a column of the same table.")
    feature_columns = [c for c in df.columns if c not in (key, target)]
    if keep_columns is None:
        model, meta = feature_columns, []
    else:
        missing = [c for c in keep_columns if c not in df.columns]
        if missing:
            raise KeyError(f"keep_columns names unknown columns: {missing}.")
        model = list(keep_columns)
        meta = [c for c in feature_columns if c not in model]

    before = df.count()
    unique = drop_duplicates(df, key, duplicate_subset) if dedupe else df
    # Counted, hashed and read again by every later step, hence written once.
    unique = materialise(unique, "unique")
    assigned = assign_partitions(
        unique, key, test_size=test_size, seed=seed, stratify=stratify or None
    )
    return Split(assigned, key, tuple(model), tuple(meta), target, before, unique.count())
