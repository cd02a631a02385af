"""Exact duplicates: drop, list, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as it must be written to be taken literally, dots included."""
    return "`" + name.replace("`", "``") + "`"



DIGEST = ["_d0", "_d1", "_d2"]


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Fixed-width stand-in for a row: two 64-bit hashes and which columns are null.

    Equal rows agree in all three; that unequal ones do is beyond chance (128 bits). Grouping and
    joining on it keeps long texts out of sorts and shuffles.
    """
    cells = [F.col(quoted(c)) for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cells])
    return [F.xxhash64(*cells).alias("_d0"), F.xxhash64(F.lit(7919), *cells, F.lit(104729)).alias("_d1"), nulls.alias("_d2")]


def drop_duplicates(df: DataFrame, key: str, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the smallest `key` of every group of equal rows; `key` is unique.

    Digests are grouped, combined before the shuffle, so a value that fills a third of the
    table costs one row per task; the winning keys then pick their rows.
    """
    subset = [c for c in (subset or df.columns) if c != key]
    narrow = df.select(F.col(quoted(key)).alias("_key"), *row_digest(subset))
    winners = narrow.groupBy(*DIGEST).agg(F.min("_key").alias("_first")).select("_first")
    return df.join(winners, F.col(quoted(key)).eqNullSafe(F.col("_first")), "left_semi")


def one_of_each(marked: DataFrame, columns: Sequence[str], *others: str) -> DataFrame:
    """One row per digest with its values; those of `others` are equal within a digest."""
    values = [F.first(quoted(c)).alias(c) for c in [*columns, *others]]
    return marked.groupBy(*DIGEST).agg(*values).drop(*DIGEST)


def duplicate_groups(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their row count `n`. Digests are counted; only
    repeated rows are read for their values, and not even those if just `n` is asked for."""
    counts = df.select(*row_digest(subset)).groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = df.select(*[quoted(c) for c in subset], *row_digest(subset)).join(counts, DIGEST)
    return one_of_each(marked, subset, "_n").withColumnRenamed("_n", "n")


def duplicate_members(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Every row of every duplicate group. The key side has one row per repeated
    digest, and a hot one on the row side is split by the adaptive skew join."""
    repeated = df.select(*row_digest(subset)).groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    marked = df.select("*", *row_digest(subset))
    return marked.join(repeated, DIGEST, "left_semi").select(*[quoted(c) for c in df.columns])


def duplicate_summary(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, surplus copies and their share; an empty table gives zeros."""
    counts = df.select(*row_digest(list(subset or df.columns))).groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")
    )
    surplus = F.col("n_rows") - F.col("n_distinct")
    return totals.select(
        "n_rows",
        surplus.alias("n_duplicates"),
        F.coalesce(F.try_divide(surplus, F.col("n_rows")), F.lit(0.0)).alias("duplicate_share"),
    )


def overlap(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows found on both sides (nulls equal): digests are grouped in one pass, the values of those met are read from `left`."""
    names = [quoted(c) for c in columns]
    # Both sides in the types a union of them has, so that equal values hash alike.
    typed = left.select(*names).limit(0).unionByName(right.select(*names).limit(0)).schema
    narrow = [side.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in typed]) for side in (left, right)]
    both = None
    for i, side in enumerate(narrow):
        part = side.select(*row_digest(columns), F.lit(i).alias("_side"))
        both = part if both is None else both.unionByName(part)
    sides = both.groupBy(*DIGEST).agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    shared = sides.filter("_lo = 0 AND _hi = 1").select(*DIGEST)
    marked = narrow[0].select(*names, *row_digest(columns))
    return one_of_each(marked.join(shared, DIGEST, "left_semi"), columns)
