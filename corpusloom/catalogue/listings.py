"""Listing parsers and cleaning, row predicates, label coding."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusloom.functions import listings as L
from corpusloom.operators.listings import clean_listings
from corpusloom.sources import corpora as C

from .base import RAW_LISTINGS, query, raw_listings, rounded, table

_NUM = r"[-+]?\d*\.?\d+"


def _sql_leading(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '^\\s*({_NUM})', 1), '') AS DOUBLE)"


_SQL_TORQUE = (
    f"CASE WHEN regexp_extract(lower(torque), '({_NUM})\\s*(nm|kgm)?', 2) = 'kgm' "
    "OR (contains(lower(torque), 'kgm') AND NOT contains(lower(torque), 'nm')) "
    f"OR (regexp_extract(lower(torque), '({_NUM})\\s*(nm|kgm)?', 2) = '' AND "
    f"TRY_CAST(nullif(regexp_extract(lower(torque), '({_NUM})', 1), '') AS DOUBLE) < 50) THEN 9.80665::DOUBLE ELSE 1.0::DOUBLE END "
    f"* TRY_CAST(nullif(regexp_extract(torque, '({_NUM})', 1), '') AS DOUBLE)"
)
_SQL_OWNER = (
    "CASE lower(trim(owner)) WHEN 'test drive car' THEN 0.0::DOUBLE WHEN 'first owner' THEN 1.0 WHEN 'second owner' THEN 2.0 "
    "WHEN 'third owner' THEN 3.0 WHEN 'fourth & above owner' THEN 4.0 END"
)
_SQL_MAKE = (
    "array_to_string(list_transform(regexp_extract_all(regexp_extract(name, '^\\s*(\\S+)', 1), '\\p{L}+|[^\\p{L}]+'), "
    "lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')"
)
CLEANED = (
    "WITH " + RAW_LISTINGS + f", cleaned AS (SELECT listing_id, selling_price, km_driven, fuel, seller_type, transmission, "
    f"{_sql_leading('mileage')} AS mileage, {_sql_leading('engine')} AS engine, {_sql_leading('max_power')} AS max_power, "
    f"{_SQL_TORQUE} AS torque, seats, {_SQL_OWNER} AS owner_rank, CAST(2021 - year AS INTEGER) AS age, "
    f"CASE WHEN name IS NOT NULL THEN {_SQL_MAKE} END AS make FROM raw_listings)"
)


def cleaned(spark, folder):
    return clean_listings(raw_listings(spark, folder))


@query(
    "f1_leading_number",
    "WITH " + RAW_LISTINGS + f" SELECT listing_id, {_sql_leading('mileage')} AS mileage, {_sql_leading('engine')} AS engine, "
    f"{_sql_leading('max_power')} AS max_power FROM raw_listings",
)
def f1(spark, folder):
    names = ("mileage", "engine", "max_power")
    return raw_listings(spark, folder).select("listing_id", *[L.leading_number(F.col(c)).alias(c) for c in names])


@query("f2_torque_in_nm", "WITH " + RAW_LISTINGS + f" SELECT listing_id, round({_SQL_TORQUE}, 6) AS torque FROM raw_listings")
def f2(spark, folder):
    return raw_listings(spark, folder).select("listing_id", F.round(L.torque_in_nm(F.col("torque")), 6).alias("torque"))


@query("f3_owner_rank", "WITH " + RAW_LISTINGS + f" SELECT listing_id, {_SQL_OWNER} AS owner_rank FROM raw_listings")
def f3(spark, folder):
    return raw_listings(spark, folder).select("listing_id", L.owner_rank(F.col("owner")).alias("owner_rank"))


@query("p11_clean_listings", CLEANED + " SELECT * REPLACE (round(torque, 6) AS torque) FROM cleaned")
def p11(spark, folder):
    return rounded(cleaned(spark, folder), "torque")


_TYPED = "documents d JOIN labels l ON d.doc_id = l.doc_id"


def _labelled_rows(spark, folder):
    """documents with label codes 0, 1 and, for some, 2 (an unusable label)."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels")
    code = F.when(F.col("doc_id") % 7 == 3, 2).otherwise(F.col("toxic")).alias("label")
    return docs.join(labels, "doc_id").select("doc_id", "text", code)


_SQL_LABELLED_ROWS = (
    f"WITH r AS (SELECT d.doc_id, d.text, CASE WHEN d.doc_id % 7 = 3 THEN 2 ELSE l.toxic END AS label FROM {_TYPED})"
)


@query(
    "p3_corpus_hygiene",
    _SQL_LABELLED_ROWS + " SELECT min(doc_id) AS doc_id, label AS y, length(text) AS n_chars FROM r "
    "WHERE length(text) BETWEEN 5 AND 20000 AND label IN (0, 1) GROUP BY label, text",
)
def p3(spark, folder):
    kept = C.hygiene(_labelled_rows(spark, folder), "doc_id")
    return kept.select("doc_id", F.col("label").alias("y"), F.length("text").cast("long").alias("n_chars"))


@query(
    "p4_null_safe_concat",
    "SELECT conv_id, turn, md5(coalesce(CASE WHEN turn % 3 = 0 THEN NULL ELSE role END, '') || ' ' || coalesce(text, '')) AS digest, "
    "CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS y FROM conversations",
)
def p4(spark, folder):
    talks = table(spark, folder, "conversations")
    subject = F.when(F.col("turn") % 3 != 0, F.col("role"))
    return talks.select(
        "conv_id", "turn", F.md5(C.email_text(subject, F.col("text"))).alias("digest"), C.is_class(F.col("role"), "assistant").alias("y")
    )


@query(
    "p5_drop_null_text",
    "SELECT listing_id, CASE WHEN transmission = 'Automatic' THEN 1 ELSE 0 END AS y FROM (SELECT * FROM (WITH " + RAW_LISTINGS
    + " SELECT * FROM raw_listings)) WHERE mileage IS NOT NULL",
)
def p5(spark, folder):
    rows = raw_listings(spark, folder).dropna(subset=["mileage"])
    return rows.select("listing_id", C.is_class(F.col("transmission"), "Automatic").alias("y"))


@query("p6_drop_null_target", "WITH " + RAW_LISTINGS + " SELECT listing_id, selling_price FROM raw_listings WHERE selling_price IS NOT NULL")
def p6(spark, folder):
    return raw_listings(spark, folder).dropna(subset=["selling_price"]).select("listing_id", "selling_price")


_SQL_NUMBER = (
    "CASE WHEN regexp_matches(v, '^\\s*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\s*$') THEN TRY_CAST(trim(v) AS DOUBLE) END"
)
_RAW_NUMBER = (
    "CASE event_id % 8 WHEN 0 THEN 'n/a' WHEN 1 THEN ' ' || CAST(user_id AS STRING) || ' ' WHEN 2 THEN CAST(user_id AS STRING) || 'd' "
    "WHEN 3 THEN 'NaN' WHEN 4 THEN '-' || CAST(user_id AS STRING) || '.25' WHEN 5 THEN CAST(user_id AS STRING) || 'e2' WHEN 6 THEN '' "
    "ELSE '.5' END"
)


@query("p9_numeric_coercion", f"SELECT event_id, {_SQL_NUMBER} AS number FROM (SELECT event_id, {_RAW_NUMBER} AS v FROM events)")
def p9(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.expr(_RAW_NUMBER).alias("v"))
    return rows.select("event_id", L.to_number(F.col("v")).alias("number"))


@query(
    "p12_label_encoding",
    "SELECT event_id, event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS code FROM events",
)
def p12(spark, folder):
    """Codes follow the sorted labels; there are only as many rows to rank as labels."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    labels = events.select("event_type").distinct()
    codes = labels.select("event_type", (F.row_number().over(Window.orderBy("event_type")) - 1).alias("code"))
    return events.join(codes, "event_type")
