"""Corpus audit: markers, contamination, viability, overview and verdict."""

from __future__ import annotations

from pyspark.sql import functions as F


from corpusloom.operators import audit


from .base import CORPORA, LABELLED, corpora, labelled, query, rounded, sql_features, sql_hash, sql_melt

_HITS = {
    "has a raw digit": r"regexp_matches(t, '\p{Nd}')",
    "has any uppercase": "regexp_matches(t, '[A-Z]')",
    "has 'escapenumber'": "contains(lower(t), 'escapenumber')",
    "has http/www": r"regexp_matches(t, '(?i)http|www\.')",
    "has '!'": "contains(t, '!')",
    "has a currency symbol": "regexp_matches(t, '[£$€¥₹]')",
}


def sql_audit(source: str, by: str) -> str:
    hits = " UNION ALL ".join(
        f"SELECT {by}, y, '{name.replace(chr(39), chr(39) * 2)}' AS marker, CAST({test} AS DOUBLE) AS hit "
        f"FROM (SELECT *, coalesce(text, '') AS t FROM {source})"
        for name, test in _HITS.items()
    )
    return (
        f"hits AS ({hits}), shares AS (SELECT {by}, marker, avg(hit) FILTER (WHERE y = 0) AS neg, avg(hit) FILTER (WHERE y = 1) AS pos "
        f"FROM hits GROUP BY {by}, marker), audit AS (SELECT {by}, marker, neg AS negative_share, pos AS positive_share, "
        "0.5 + (pos - neg) / 2 AS auc, (neg = 0) <> (pos = 0) AS exact_zero, abs(0.5 + (pos - neg) / 2 - 0.5) AS auc_distance FROM shares)"
    )


_AUDIT = "WITH " + CORPORA + ", " + sql_audit("corpora", "corpus")
_OUT = (
    "corpus, marker, round(negative_share, 6) AS negative_share, round(positive_share, 6) AS positive_share, round(auc, 6) AS auc, exact_zero"
)
_ROUND = ("negative_share", "positive_share", "auc")


@query("a11_marker_audit", _AUDIT + f" SELECT {_OUT}, round(auc_distance, 6) AS auc_distance FROM audit")
def a11(spark, folder):
    found = audit.marker_audit(corpora(spark, folder), "text", "y", by=["corpus"])
    return rounded(found, *_ROUND, "auc_distance")


@query(
    "a12_contaminated_markers",
    "WITH planted AS (SELECT doc_id, CASE WHEN y = 0 THEN text || ' EscapeNumber' ELSE text END AS text, y, 'planted' AS corpus FROM "
    "(SELECT d.doc_id, d.text, l.toxic AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id)), " + sql_audit("planted", "corpus")
    + f" SELECT {_OUT}, round(auc_distance, 6) AS auc_distance FROM audit WHERE exact_zero AND auc_distance >= 0.2",
)
def a12(spark, folder):
    planted = labelled(spark, folder).select(
        F.lit("planted").alias("corpus"),
        F.when(F.col("y") == 0, F.concat("text", F.lit(" EscapeNumber"))).otherwise(F.col("text")).alias("text"),
        "y",
    )
    found = audit.marker_audit(planted, "text", "y", by=["corpus"])
    return rounded(audit.suspicious_zero_cells(found), *_ROUND, "auc_distance")


def sql_viability(source: str, by: str) -> str:
    return (
        f"vf AS ({sql_features(source, by)}), vt AS ({sql_melt('vf', by)}), viability AS (SELECT {by}, feature, avg(value) AS mean, "
        "avg(CASE WHEN value <> 0 THEN 1.0 ELSE 0.0 END) AS nonzero_share, CASE WHEN avg(CASE WHEN value <> 0 THEN 1.0 ELSE 0.0 END) < 0.01 "
        "THEN 'dead' WHEN avg(CASE WHEN value <> 0 THEN 1.0 ELSE 0.0 END) < 0.05 THEN 'weak' ELSE 'ok' END AS status "
        f"FROM vt GROUP BY {by}, feature)"
    )


_VIABLE = "corpus, feature, round(mean, 6) AS mean, round(nonzero_share, 6) AS nonzero_share, status"


@query("a13_feature_viability", "WITH " + CORPORA + ", " + sql_viability("corpora", "corpus") + f" SELECT {_VIABLE} FROM viability")
def a13(spark, folder):
    found = audit.feature_viability(corpora(spark, folder), "text", "row_key", by="corpus", sample=None)
    return rounded(found, "mean", "nonzero_share")


@query(
    "a13_feature_viability_sampled",
    "WITH " + CORPORA + ", picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY "
    + sql_hash("row_key", 42) + ") AS place FROM corpora) WHERE place <= 300), " + sql_viability("picked", "corpus")
    + f" SELECT {_VIABLE} FROM viability",
)
def a13_sampled(spark, folder):
    found = audit.feature_viability(corpora(spark, folder), "text", "row_key", by="corpus", sample=300)
    return rounded(found, "mean", "nonzero_share")


_OVERVIEW = (
    "overview AS (SELECT corpus, count(*) AS n_rows, avg(y) AS positive_share, median(length(coalesce(text, ''))) AS median_chars, "
    "quantile_cont(length(coalesce(text, '')), 0.99) AS p99_chars FROM corpora GROUP BY corpus)"
)


@query(
    "a14_corpus_overview",
    "WITH " + CORPORA + ", " + _OVERVIEW + " SELECT corpus, n_rows, round(positive_share, 6) AS positive_share, "
    "round(median_chars, 6) AS median_chars, round(p99_chars, 6) AS p99_chars FROM overview",
)
def a14(spark, folder):
    found = audit.corpus_overview(corpora(spark, folder), "corpus", "text", "y")
    return rounded(found, "positive_share", "median_chars", "p99_chars")


@query(
    "a15_corpus_verdict",
    _AUDIT + ", " + sql_viability("corpora", "corpus") + ", " + _OVERVIEW
    + ", marks AS (SELECT corpus, max(CASE WHEN exact_zero AND auc_distance >= 0.2 THEN 1 ELSE 0 END) AS bad, max(auc_distance) + 0.5 AS worst "
    "FROM audit GROUP BY corpus), gone AS (SELECT corpus, count(*) FILTER (WHERE status = 'dead') AS dead_features, count(*) AS f FROM viability "
    "GROUP BY corpus) SELECT o.corpus, n_rows, round(positive_share, 6) AS positive_share, dead_features, f AS n_features, round(worst, 6) AS worst_marker_auc, "
    "CASE WHEN bad = 1 THEN 'rejected' WHEN dead_features >= 3 THEN 'dead_features' ELSE 'clean' END AS verdict FROM overview o JOIN marks m ON o.corpus = m.corpus JOIN gone g ON o.corpus = g.corpus",
)
def a15(spark, folder):
    found = audit.audit_corpora(corpora(spark, folder), "corpus", "text", "y", "row_key")
    return rounded(found.verdicts, "positive_share", "worst_marker_auc")


@query(
    "a16_marker_comparison",
    _AUDIT + f" SELECT {_OUT} FROM audit WHERE marker IN ('has a raw digit', 'has ''escapenumber''')",
)
def a16(spark, folder):
    found = audit.marker_audit(corpora(spark, folder), "text", "y", by=["corpus"])
    picked = audit.compare_markers(found, "corpus", ["documents", "conversations"], ["has a raw digit", "has 'escapenumber'"])
    return rounded(picked, *_ROUND)


@query(
    "j3_text_marker_hits",
    "WITH " + LABELLED + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT doc_id, '{n.replace(chr(39), chr(39) * 2)}' AS marker FROM (SELECT doc_id, text AS t FROM documents) WHERE {test}"
        for n, test in _HITS.items()
    ) + ")",
)
def j3(spark, folder):
    return audit.marker_hits(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")


@query(
    "j7_status_grid",
    "WITH " + CORPORA + ", " + sql_viability("corpora", "corpus") + " SELECT feature, max(status) FILTER (WHERE corpus = 'documents') AS documents, "
    "max(status) FILTER (WHERE corpus = 'conversations') AS conversations FROM viability GROUP BY feature",
)
def j7(spark, folder):
    viable = audit.feature_viability(corpora(spark, folder), "text", "row_key", by="corpus", sample=None)
    return audit.status_grid(viable, "corpus", ["documents", "conversations"])
