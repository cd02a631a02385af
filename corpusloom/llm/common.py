"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

#: Stands for a null id inside the operators: it sorts behind every other id.
NO_ID = (1 << 63) - 1
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE = r"[\x20\x09-\x0D]+"


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Within it, a written table's shuffle files go as soon as the table stands."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """`df` as a table in the shared folder; its shuffle files do not outlive the write."""
    with shuffle_files_removed(df.sparkSession):
        return materialise(df, label, **options)


def internal_key(column: Column | str) -> Column:
    """A document id that is never null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def external_key(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != F.lit(NO_ID), column)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keyed_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """key (never null) and text (null counts as empty); other columns are left unread."""
    return docs.select(
        internal_key(F.col(quoted(id_column))).alias("key"), F.coalesce(F.col(quoted(text_column)), F.lit("")).alias("text")
    )


def row_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As `keyed_texts`, and row: a 64-bit hash of id and text. Rows without an id, or with one id in common, have
    rows of their own; only rows equal in both share one, and their answers are the same."""
    return keyed_texts(docs, id_column, text_column).select(F.xxhash64("key", "text").alias("row"), "key", "text")


def power_of_two(n: float, least: int = 1) -> int:
    out = least
    while out < n:
        out *= 2
    return out


def text_bytes(texts: DataFrame) -> int:
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
