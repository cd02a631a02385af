"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition gives a sorted run of (digest, smallest id, count). Runs are
merged in rounds: in each, `FAN_IN` neighbouring runs exchange their entries by digest
and become one run, in which an entry keeps the smallest id and the summed count. A
digest always travels with the text's length and a second hash, and entries are only
merged when all three agree. The last run is read back down the tree: first to
the entries of the first runs, then to the rows of each run, so that a digest shared by a
third of all rows is spread over as many join keys as there are runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import NO_ID, SPACE, external_key, internal_key, quoted, unused, written

FAN_IN_BITS = 4
DIGEST = ["digest", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    """Every run of white space as one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """key, digest, n_bytes, check, run, row: one narrow row per document, written once."""
    clean = docs.select(internal_key(F.col(quoted(id_column))).alias("key"), normalised(F.col(quoted(text_column))).alias("clean"))
    rows = clean.select(
        "key", F.unhex(F.sha2("clean", 256)).alias("digest"), F.octet_length("clean").alias("n_bytes"), F.xxhash64("clean").alias("check"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"),
    )
    return written(rows, "digest-runs")


def merge_runs(runs: DataFrame, last_run: int) -> DataFrame:
    """The one run that all runs merge into."""
    while True:
        runs = runs.groupBy("run", *DIGEST).agg(F.min("first").alias("first"), F.sum("size").alias("size"))
        if last_run == 0:
            return runs.drop("run")
        last_run >>= FAN_IN_BITS
        runs = runs.withColumn("run", F.shiftright("run", FAN_IN_BITS))


def find_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the smallest id stays; ids that are null count as
    the largest, and of rows with the same id and text exactly one stays. Null and
    white-space-only texts are ordinary texts (`''` and `' '`). An empty table gives no rows; other columns
    are not read.
    """
    rows = digest_runs(docs, id_column, text_column)
    last_run = rows.agg(F.max("run")).first()[0] or 0
    entry = F.struct("key", "row")
    first_runs = written(rows.groupBy("run", *DIGEST).agg(F.min(entry).alias("first"), F.count("*").alias("size")), "first-runs")
    merged = merge_runs(first_runs, last_run).select(
        *DIGEST, F.col("first.key").alias("keep_key"), F.col("first.row").alias("keep_row"), F.col("size").alias("group_size")
    )
    resolved = first_runs.select("run", *DIGEST).join(merged, DIGEST)
    return rows.join(resolved, ["run", *DIGEST]).select(
        external_key("key").alias("doc_id"), external_key("keep_key").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Rows that repeat an id and its text but differ elsewhere keep the one whose other columns hash lowest.
    """
    key, digest, place = unused(docs, "key"), unused(docs, "digest"), unused(docs, "place")
    stay = find_copies(docs, id_column, text_column).filter("kept").select(internal_key("doc_id").alias(key), F.col("text_sha256").alias(digest))
    marked = docs.withColumns({key: internal_key(F.col(quoted(id_column))), digest: F.sha2(normalised(F.col(quoted(text_column))), 256)})
    plain = [F.col(quoted(f.name)) for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    once = Window.partitionBy(key, digest).orderBy(F.xxhash64(*plain))
    joined = marked.join(stay, [key, digest], "left_semi")
    return joined.withColumn(place, F.row_number().over(once)).filter(F.col(place) == 1).select(*[quoted(c) for c in docs.columns])


__all__ = ["NO_ID", "digest_runs", "drop_copies", "find_copies", "merge_runs", "normalised"]
