"""Redacted samples and the check that redaction leaves no long number readable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.redact import keeps_digit_run, redact

from .ordered import hash_key


def redact_column(df: DataFrame, column: str, *, max_chars: int = 70, names: bool = True) -> DataFrame:
    if column not in df.columns:
        raise KeyError(f"No column {column!r}; columns are {df.columns}.")
    return df.withColumn(column, redact(F.col(column), max_chars=max_chars, names=names))


def safe_sample(
    df: DataFrame,
    key: str,
    column: str,
    *,
    n: int = 5,
    seed: int = 42,
    max_chars: int = 70,
    group: str | None = None,
) -> DataFrame:
    """`n` rows, or `n` per group, in hash order, with the text column redacted.

    Both forms keep only the best `n` per task before the shuffle, and only the
    sampled rows are redacted.
    """
    hashed = df.withColumn("_h", hash_key(key, seed))
    if group is None:
        sampled = hashed.orderBy("_h", key).limit(n)
    else:
        place = F.row_number().over(Window.partitionBy(group).orderBy("_h", key))
        sampled = hashed.withColumn("_p", place).filter(F.col("_p") <= n).drop("_p")
    return redact_column(sampled.drop("_h"), column, max_chars=max_chars)


def leak_share(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per group whose redacted text still shows three digits in a row."""
    shown = df.select(*by, keeps_digit_run(redact(F.col(column))).alias("leaks"))
    return shown.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("leaks").alias("n_leaks"),
        F.avg(F.col("leaks").cast("double")).alias("leak_share"),
    )
