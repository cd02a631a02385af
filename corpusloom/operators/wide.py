"""One-hot encoding of categories with very many levels: a level table that is joined, and one sparse vector per row.

`Preparation` gives every level a column of its own, which is what a reader wants up to some thousands of levels. Beyond that a
plan with a column per level cannot be held, so here levels are numbered in a table and never reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

from .ordered import global_rank
from .prep import NotFittedError, level_counts, modes
from .split import TrainingPartition


class WideEncoder:
    """Levels of the training half, numbered in sort order per column; a missing value counts as the column's mode.

    A level that the fit never saw has no number and gives zeros. Columns may have any number of levels; a vector
    has as many entries that are not zero as there are columns.
    """

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.levels: DataFrame | None = None
        self.sizes: dict[str, int] = {}
        self.fills: dict[str, str] = {}

    def fit(self, partition: TrainingPartition) -> WideEncoder:
        if not isinstance(partition, TrainingPartition):
            raise TypeError(f"fit() takes the training half of a split, not {type(partition).__name__}.")
        counts = materialise(level_counts(partition.X, self.columns), "wide-levels")
        self.fills = {r["feature"]: r["mode"] for r in modes(counts).collect()}  # one row per column
        per_column = {r["feature"]: (r["n"], r["least"]) for r in self._numbered(counts).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("least")).collect()}
        self.sizes = {c: per_column.get(c, (0, 0))[0] for c in self.columns}
        first = F.coalesce(*[F.when(F.col("feature") == c, F.lit(least)) for c, (_, least) in per_column.items()], F.lit(0))
        self.levels = self.numbered.select("feature", "level", "n", (F.col("_rank") - first).alias("index"))
        return self

    def _numbered(self, counts: DataFrame) -> DataFrame:
        self.numbered = materialise(global_rank(counts, ["feature", "level"]), "wide-index")
        return self.numbered

    def indexed(self, df: DataFrame) -> DataFrame:
        """`df` with a column `<column>__index` for each column; null for a level that the fit never saw."""
        if self.levels is None:
            raise NotFittedError("Call fit() with the training half of a split first.")
        out = df
        for c in self.columns:
            known = self.levels.filter(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("index").alias(f"{c}__index"))
            level = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.fills.get(c)))
            out = out.withColumn("_value", level).join(known, F.col("_value") == F.col("_level"), "left").drop("_value", "_level")
        return out

    def transform(self, df: DataFrame, numeric: Sequence[str] = (), name: str = "features") -> DataFrame:
        """`df` with one vector column: the numeric columns, then the one-hot entries of every category column."""
        placed = self.indexed(df)
        used = [c for c in self.columns if self.sizes[c]]
        starts = np.cumsum([len(numeric), *[self.sizes[c] for c in used]]).tolist()
        size = starts[-1]

        @F.udf(VectorUDT())
        def sparse(numbers, places):
            entries = [(i, math.nan if v is None else v) for i, v in enumerate(numbers) if v != 0]
            entries += [(p, 1.0) for p in places if p is not None]
            return SparseVector(size, [i for i, _ in entries], [v for _, v in entries])

        # The vector is put together here: Spark's encoder names every column in the metadata, which the driver would have to hold.
        numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in numeric]).cast("array<double>")
        places = F.array(*[(F.col(f"`{c}__index`") + F.lit(start)).cast("int") for c, start in zip(used, starts)]).cast("array<int>")
        return placed.withColumn(name, sparse(numbers, places)).select(*df.columns, name)


def column_sums(df: DataFrame, vector: str = "features") -> DataFrame:
    """(place, n): the sum of every column of a sparse vector column that has entries, in one shuffle of the entries' sums."""
    parts = F.unwrap_udt(F.col(vector))
    entries = df.select(F.explode(F.arrays_zip(parts["indices"].alias("place"), parts["values"].alias("n"))).alias("e"))
    return entries.groupBy(F.col("e.place").alias("place")).agg(F.sum("e.n").alias("n"))
