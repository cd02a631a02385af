"""Class balancing and the neighbour search behind synthetic sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.text import FEATURE_NAMES
from corpusloom.operators import resample as R
from corpusloom.operators.features import feature_frame

from .base import LABELLED, labelled, query, rounded, sql_features, sql_hash, table

FEATS = "WITH " + LABELLED + ", feats AS (" + sql_features("labelled", "doc_id, y") + "), small AS (SELECT * FROM feats WHERE y = 1)"
_SQUARES = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURE_NAMES)
NEAR = FEATS + (
    f", pairs AS (SELECT a.doc_id AS base, b.doc_id AS neighbour, sqrt({_SQUARES}) AS distance FROM small a JOIN small b ON a.doc_id <> b.doc_id), "
    "near AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY distance, neighbour) AS place FROM pairs)"
)


def featured(spark, folder):
    return feature_frame(labelled(spark, folder), "text", ["doc_id", "y"])


@query("j6_nearest_neighbours", NEAR + " SELECT base AS doc_id, neighbour, round(distance, 6) AS distance, CAST(place AS INTEGER) AS place FROM near WHERE place <= 5")
def j6(spark, folder):
    small = featured(spark, folder).filter("y = 1")
    return rounded(R.nearest_neighbours(small, "doc_id", FEATURE_NAMES, 5), "distance")


def _uniform(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE)"


_SIZES = (
    ", sizes AS (SELECT max(n) AS big, min(n) AS few FROM (SELECT count(*) AS n FROM {t} GROUP BY {y}))"
    ", draws AS (SELECT i AS draw, CAST(floor(" + _uniform("'42'", "CAST(i AS VARCHAR)", "'pick'") + " * few) AS BIGINT) AS idx "
    "FROM sizes, range((SELECT CAST(big - few AS BIGINT) FROM sizes)) t(i))"
    ", pool AS (SELECT *, row_number() OVER (ORDER BY " + sql_hash("doc_id", 42) + ") - 1 AS idx FROM {small})"
)


@query(
    "m10_smote",
    NEAR + _SIZES.format(t="feats", y="y", small="small")
    + ", wanted AS (SELECT draw, idx, CAST(floor(" + _uniform("'42'", "CAST(draw AS VARCHAR)", "'place'") + " * 5) AS BIGINT) + 1 AS place, "
    + _uniform("'42'", "CAST(draw AS VARCHAR)", "'step'") + " AS u FROM draws), made AS (SELECT 1 AS y, "
    + ", ".join(f"p.{c} + u * (o.{c} - p.{c}) AS {c}" for c in FEATURE_NAMES)
    + " FROM wanted w JOIN pool p ON w.idx = p.idx JOIN near n ON n.base = p.doc_id AND n.place = w.place JOIN small o ON o.doc_id = n.neighbour) "
    "SELECT y, " + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_NAMES) + " FROM (SELECT y, " + ", ".join(FEATURE_NAMES)
    + " FROM feats UNION ALL SELECT y, " + ", ".join(FEATURE_NAMES) + " FROM made)",
)
def m10(spark, folder):
    made = R.smote(featured(spark, folder), "doc_id", "y", FEATURE_NAMES, k=5)
    return rounded(made.withColumn("y", F.col("y").cast("int")), *FEATURE_NAMES)


@query(
    "m11_random_over_sampling",
    "WITH small AS (SELECT doc_id, toxic FROM labels WHERE toxic = 1)" + _SIZES.format(t="labels", y="toxic", small="small")
    + " SELECT doc_id, toxic FROM labels UNION ALL SELECT p.doc_id, p.toxic FROM draws d JOIN pool p ON d.idx = p.idx",
)
def m11(spark, folder):
    return R.over_sample(table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id", "toxic")


@query(
    "m12_random_under_sampling",
    "SELECT doc_id, toxic FROM (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY " + sql_hash("doc_id", 42)
    + ") AS place FROM labels) WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))",
)
def m12(spark, folder):
    return R.under_sample(table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id", "toxic")
