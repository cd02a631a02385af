"""Text-shape features, redaction and character checks over `documents`."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.redact import COMMON_WORDS, mask_names, redact
from corpusloom.functions.text import FEATURES, has_non_ascii, has_replacement_char
from corpusloom.operators.features import feature_frame
from corpusloom.operators.samples import leak_share, safe_sample

from .base import SQL_FEATURES, SQL_SPACE, SQL_WORD, query, quote, rounded, sql_features, sql_hash, table, texts


def _feature_query(number: int, name: str) -> None:
    @query(
        f"x{number}_{name}",
        f"SELECT doc_id, round({name}, 6) AS {name} FROM ({sql_features('documents', 'doc_id', (name,))})",
    )
    def run(spark, folder):
        docs = texts(spark, folder, "documents", "doc_id", "text")
        return rounded(feature_frame(docs, "text", ["doc_id"], {name: FEATURES[name]}), name)


for _number, _name in enumerate(FEATURES, 1):
    _feature_query(_number, _name)


@query(
    "x13_feature_frame",
    "SELECT doc_id, " + ", ".join(f"round({n}, 6) AS {n}" for n in SQL_FEATURES)
    + f" FROM ({sql_features('documents', 'doc_id')})",
)
def x13(spark, folder):
    docs = texts(spark, folder, "documents", "doc_id", "text")
    return rounded(feature_frame(docs, "text", ["doc_id"]), *FEATURES)


@query(
    "p1_non_ascii_rows",
    "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7F]')",
)
def p1(spark, folder):
    return table(spark, folder, "documents").filter(has_non_ascii(F.col("text"))).select("doc_id", "lang")


@query(
    "p2_replacement_char_rows",
    "SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE contains(text, chr(65533))) AS n_damaged FROM documents GROUP BY source",
)
def p2(spark, folder):
    return table(spark, folder, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(has_replacement_char(F.col("text"))).alias("n_damaged")
    )


# -- redaction in DuckDB: word runs as tokens instead of look-around ---------
_TOKENS = quote(f"[{SQL_WORD}]+|[^{SQL_WORD}]+")
_ALLOWED = ", ".join(quote(w) for w in COMMON_WORDS)


def sql_mask_names(t: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({t}, {_TOKENS}), lambda w: CASE WHEN "
        f"regexp_full_match(w, '[A-Z][a-z]{{2,}}') AND w NOT IN ({_ALLOWED}) THEN '<NAME>' ELSE w END), '')"
    )


def _sql_mask_numbers(t: str) -> str:
    return (
        f"regexp_replace(array_to_string(list_transform(regexp_extract_all({t}, {_TOKENS}), lambda w: CASE WHEN "
        "regexp_full_match(w, '\\p{Nd}+') THEN chr(1) ELSE w END), ''), '\\x01(?:[.,]\\x01)?', '<NUM>', 'g')"
    )


def sql_redacted(source: str, columns: str, max_chars: int = 70) -> str:
    """`columns` of `source` plus `shown`, the redacted text."""
    steps = [
        (rf"[{SQL_WORD}.+-]+@[{SQL_WORD}-]+\.[{SQL_WORD}.]+", "<EMAIL>"),
        (rf"(?i)https?://[^{SQL_SPACE}]+|www\.[^{SQL_SPACE}]+", "<URL>"),
        (rf"\+?\p{{Nd}}[\p{{Nd}}{SQL_SPACE}-]{{4,}}\p{{Nd}}", "<PHONE>"),
        (rf"[£$€¥₹][{SQL_SPACE}]?\p{{Nd}}+(?:[.,]\p{{Nd}}+)?", "<MONEY>"),
    ]
    inner = f"SELECT *, coalesce(text, '') AS t FROM {source}"
    for pattern, placeholder in steps:
        inner = f"SELECT * REPLACE (regexp_replace(t, {quote(pattern)}, '{placeholder}', 'g') AS t) FROM ({inner})"
    for step in (_sql_mask_numbers, sql_mask_names):
        inner = f"SELECT * REPLACE ({step('t')} AS t) FROM ({inner})"
    inner = f"SELECT * REPLACE (trim(regexp_replace(t, {quote(f'[{SQL_SPACE}]+')}, ' ', 'g')) AS t) FROM ({inner})"
    cut = f"CASE WHEN length(t) > {max_chars} THEN rtrim(substr(t, 1, {max_chars - 1})) || '…' ELSE t END"
    return f"SELECT {columns}, {cut} AS shown FROM ({inner})"


@query("r1_redact", sql_redacted("documents", "doc_id", 200))
def r1(spark, folder):
    docs = texts(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", redact(F.col("text"), max_chars=200).alias("shown"))


@query(
    "r1_redact_whole_text",
    f"SELECT doc_id, length(shown) AS n_chars, md5(shown) AS digest FROM ({sql_redacted('documents', 'doc_id', 10**9)})",
)
def r1_whole(spark, folder):
    docs = texts(spark, folder, "documents", "doc_id", "text")
    shown = docs.select("doc_id", redact(F.col("text"), max_chars=10**9).alias("shown"))
    return shown.select("doc_id", F.length("shown").cast("long").alias("n_chars"), F.md5("shown").alias("digest"))


@query("r2_mask_names", "SELECT doc_id, md5(masked) AS digest FROM (SELECT doc_id, " + sql_mask_names("text") + " AS masked FROM documents)")
def r2(spark, folder):
    docs = texts(spark, folder, "documents", "doc_id", "text").select("doc_id", mask_names(F.col("text")).alias("masked"))
    return docs.select("doc_id", F.md5("masked").alias("digest"))


@query(
    "r3_safe_sample_per_group",
    "WITH picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY "
    + sql_hash("doc_id", 42) + ", doc_id) AS place FROM documents) WHERE place <= 5) "
    + sql_redacted("picked", "doc_id, lang"),
)
def r3(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return safe_sample(docs, "doc_id", "text", n=5, group="lang").withColumnRenamed("text", "shown")


@query(
    "r3_safe_sample",
    f"WITH picked AS (SELECT * FROM documents ORDER BY {sql_hash('doc_id', 42)}, doc_id LIMIT 5) "
    + sql_redacted("picked", "doc_id, lang"),
)
def r3_overall(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return safe_sample(docs, "doc_id", "text", n=5).withColumnRenamed("text", "shown")


@query(
    "r4_redaction_leaks",
    "SELECT lang, count(*) AS n_rows, count(*) FILTER (WHERE leaks) AS n_leaks, "
    "round(avg(CAST(leaks AS DOUBLE)), 6) AS leak_share FROM (SELECT lang, regexp_matches(shown, '\\p{Nd}{3,}') AS leaks "
    f"FROM ({sql_redacted('documents', 'lang')})) GROUP BY lang",
)
def r4(spark, folder):
    return rounded(leak_share(texts(spark, folder, "documents", "lang", "text"), "text", ["lang"]), "leak_share")
