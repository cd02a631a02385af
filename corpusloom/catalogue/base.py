"""Registration and the shared bindings to the given tables.

Tables without the shape an operator needs (log lines, listings) are rendered from
the given ones by SQL expressions that both engines understand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.charclasses import ALL_DIGITS
from corpusloom.functions.text import FEATURE_NAMES, URL_ENDINGS
from corpusloom.workspace import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The given columns of a text table, spread over the cores if it is small."""
    return spread(table(spark, folder, name).select(*columns))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# -- labelled text ---------------------------------------------------------
def labelled(spark: SparkSession, folder: str, label: str = "toxic") -> DataFrame:
    """documents with their label: doc_id, text, y."""
    docs = texts(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col(label).alias("y"))
    return docs.join(labels, "doc_id")


LABELLED = "labelled AS (SELECT d.doc_id, d.text, l.toxic AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def corpora(spark: SparkSession, folder: str) -> DataFrame:
    """Two labelled corpora: documents by toxicity, conversations by speaker."""
    docs = labelled(spark, folder).select(
        F.lit("documents").alias("corpus"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("row_key"), "text", "y"
    )
    talks = texts(spark, folder, "conversations", "conv_id", "turn", "role", "text").filter(F.col("role").isin("user", "assistant")).select(
        F.lit("conversations").alias("corpus"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("row_key"),
        "text",
        (F.col("role") == "assistant").cast("int").alias("y"),
    )
    return docs.unionByName(talks)


CORPORA = LABELLED + """, corpora AS (
 SELECT 'documents' AS corpus, 'd' || CAST(doc_id AS VARCHAR) AS row_key, text, y FROM labelled
 UNION ALL
 SELECT 'conversations', 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text,
        CASE WHEN role = 'assistant' THEN 1 ELSE 0 END
 FROM conversations WHERE role IN ('user', 'assistant'))"""

# -- text features in DuckDB -----------------------------------------------
SQL_SPACE = r"\t\n\v\f\r \x1c-\x1f\x{85}\p{Z}"
SQL_WORD = r"\p{L}\p{N}_"


def _n(pattern: str) -> str:
    return f"len(regexp_extract_all(t, {quote(pattern)}))"


_ENDINGS = "|".join(e.replace(".", r"\.") for e in URL_ENDINGS)
_LETTERS = f"regexp_replace(w, {quote('[^' + chr(92) + 'p{L}]')}, '', 'g')"
SQL_FEATURES = {
    "char_length": "length(t)",
    "word_count": _n(f"[^{SQL_SPACE}]+"),
    "mean_word_length": "CASE WHEN {w} = 0 THEN 0.0 ELSE {c} / {w} END".format(
        w=_n(f"[^{SQL_SPACE}]+"), c=f"CAST({_n(f'[^{SQL_SPACE}]')} AS DOUBLE)"
    ),
    "digit_count": _n(f"[{ALL_DIGITS}]"),
    "digit_ratio": f"CASE WHEN length(t) = 0 THEN 0.0 ELSE CAST({_n(f'[{ALL_DIGITS}]')} AS DOUBLE) / length(t) END",
    "uppercase_ratio": "CASE WHEN {l} = 0 THEN 0.0 ELSE CAST({u} AS DOUBLE) / {l} END".format(
        l=_n(r"\p{L}"), u=_n(r"\p{Lu}")
    ),
    "all_caps_word_count": (
        f"len(list_filter(regexp_extract_all(t, {quote(f'[^{SQL_SPACE}]+')}), lambda w: length({_LETTERS}) >= 2 "
        f"AND NOT regexp_matches({_LETTERS}, {quote('[^' + chr(92) + 'p{Lu}]')})))"
    ),
    "exclamation_count": _n("!"),
    "currency_symbol_count": _n("[$£€¥₹¢₩₽₪₦฿]"),
    "non_alnum_count": _n(rf"[^\p{{L}}\p{{N}}{SQL_SPACE}]"),
    "has_url_like": "CAST(regexp_matches(t, {p}) AS INTEGER)".format(
        p=quote(rf"(?i)https?://|www\.|[{SQL_WORD}][{SQL_WORD}-]*\.(?:{_ENDINGS})(?:$|[^{SQL_WORD}])")
    ),
    "has_long_digit_run": rf"CAST(regexp_matches(t, '\p{{Nd}}{{8}}') AS INTEGER)",
}


def sql_features(source: str, ids: str, names: tuple[str, ...] = FEATURE_NAMES, text: str = "text") -> str:
    columns = ", ".join(f"CAST({SQL_FEATURES[n]} AS DOUBLE) AS {n}" for n in names)
    return f"SELECT {ids}, {columns} FROM (SELECT *, coalesce({text}, '') AS t FROM {source})"


def sql_melt(source: str, ids: str, names=FEATURE_NAMES) -> str:
    return f"SELECT {ids}, feature, value FROM {source} UNPIVOT (value FOR feature IN ({', '.join(names)}))"


# -- log lines rendered from events ----------------------------------------
def _log_line(stamp: str) -> str:
    number = "CAST({} AS STRING)".format
    level = (
        "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'INFO' "
        "WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'WARN' ELSE 'WARNING' END "
        "ELSE CASE WHEN event_id % 3 = 0 THEN 'CRITICAL' ELSE 'FATAL' END END"
    )
    message = (
        f"CASE event_id % 4 WHEN 0 THEN 'timeout connecting to 10.0.' || {number('user_id % 256')} || '.' || "
        f"{number('event_id % 256')} || ':5432 after ' || {number('event_id % 9000')} || 'ms' "
        f"WHEN 1 THEN 'job-' || {number('event_id')} || ' failed for user u' || {number('user_id')} || "
        f"' code 0xdeadbeef' || {number('event_id')} "
        f"WHEN 2 THEN 'cannot open ' || chr(39) || '/data/file_' || {number('event_id')} || '.txt' || chr(39) || "
        f"' since 2024-01-01 10:00:00,123' "
        f"ELSE 'queue length ' || {number('event_id % 100')} || '.5 above ERRORS \"limit ' || {number('user_id')} || '\"' END"
    )
    return (
        "CASE WHEN event_id % 47 = 0 THEN CASE WHEN event_id % 2 = 0 THEN '' ELSE '   ' END "
        f"WHEN event_type = 'signup' THEN '    at app.signup.Handler(line ' || {number('user_id')} || ')' "
        f"ELSE {stamp} || ' [' || {level} || '] app.' || event_type || '.worker - ' || {message} END"
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """event_id (the line number) and line."""
    line = _log_line("date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
    events = texts(spark, folder, "events", "event_id", "ts", "user_id", "event_type")
    return events.select("event_id", F.expr(line).alias("line"))


LOG_LINES = f"""lines AS (SELECT event_id, {_log_line("strftime(ts, '%Y-%m-%d %H:%M:%S')")} AS line FROM events)"""

# -- listings rendered from part -------------------------------------------
_PRICE = (
    "50000.0 + p_size * 8000 + (p_partkey % 21) * 5000 + (p_partkey % 97) * 300 "
    "+ (CASE WHEN p_size > 30 THEN p_size * 2500 ELSE 0 END)"
)
LISTING_COLUMNS = f"""p_partkey AS listing_id,
 CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 'mercedes-benz ' || p_name
      ELSE p_brand || ' ' || p_name END AS name,
 CAST(2000 + p_partkey % 21 AS INT) AS year,
 CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST({_PRICE} AS DOUBLE) END AS selling_price,
 CAST(p_size * 1000 + p_partkey % 7 AS INT) AS km_driven,
 p_type AS fuel,
 CASE WHEN p_partkey % 5 = 0 THEN 'Dealer' ELSE 'Individual' END AS seller_type,
 CASE WHEN p_size > 35 THEN 'Automatic' ELSE 'Manual' END AS transmission,
 CASE p_partkey % 6 WHEN 0 THEN 'First Owner' WHEN 1 THEN ' Second owner' WHEN 2 THEN 'Third Owner'
      WHEN 3 THEN 'Fourth & Above Owner' WHEN 4 THEN 'Test Drive Car' ELSE 'unknown' END AS owner,
 CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN ''
      ELSE CAST(p_size AS STRING) || '.4 kmpl' END AS mileage,
 CAST(800 + p_size * 10 AS STRING) || ' CC' AS engine,
 CASE WHEN p_partkey % 19 = 0 THEN 'bhp' ELSE CAST(40 + p_size AS STRING) || ' bhp' END AS max_power,
 CASE p_partkey % 7 WHEN 0 THEN CAST(100 + p_size AS STRING) || 'Nm@ 2000rpm'
      WHEN 1 THEN CAST(p_size AS STRING) || '.7@ 2,700(kgm@ rpm)'
      WHEN 2 THEN CAST(p_size AS STRING) || ' KGM (235 Nm)' WHEN 3 THEN CAST(p_size * 9 AS STRING) || '@ 2000'
      WHEN 4 THEN '11.5@ 4,500(rpm)' WHEN 5 THEN '' ELSE NULL END AS torque,
 CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(4 + p_partkey % 4 AS DOUBLE) END AS seats"""


def raw_listings(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return parts.selectExpr(*[c.strip() for c in _split_columns(LISTING_COLUMNS)])


def _split_columns(text: str) -> list[str]:
    return text.split(",\n")


RAW_LISTINGS = f"raw_listings AS (SELECT {LISTING_COLUMNS} FROM part)"


# -- regression rows from lineitem and part --------------------------------
def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their part; row_key is unique, target is the price."""
    items = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        key.alias("row_key"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("retail"),
        F.col("l_returnflag").alias("flag"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
    )


PRICED = """priced AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
 || '-' || CAST(l_linenumber AS VARCHAR) AS row_key, l_extendedprice AS price, l_quantity AS quantity, l_discount AS discount,
 l_tax AS tax, CAST(p_size AS DOUBLE) AS size, p_retailprice AS retail, l_returnflag AS flag, p_brand AS brand, p_type AS type
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def sql_hash(key: str, seed: int | str) -> str:
    return f"md5('{seed}|' || CAST({key} AS VARCHAR))"
