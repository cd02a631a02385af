"""Descriptive statistics, class separation, duplicates and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.text import FEATURE_NAMES, char_length, digit_ratio, uppercase_ratio
from corpusloom.operators import dedupe, stats
from corpusloom.operators.features import feature_frame

from .base import LABELLED, PRICED, RAW_LISTINGS, labelled, priced_lines, query, raw_listings, rounded, sql_features, sql_melt, table, texts

FEATURED = "WITH " + LABELLED + ", feats AS (" + sql_features("labelled", "doc_id, y") + ")"
LONG = FEATURED + ", tall AS (" + sql_melt("feats", "doc_id, y") + ")"


def featured(spark, folder):
    return feature_frame(labelled(spark, folder), "text", ["doc_id", "y"])


@query(
    "a1_class_balance",
    "SELECT toxic AS y, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY toxic",
)
def a1(spark, folder):
    labels = table(spark, folder, "labels").withColumnRenamed("toxic", "y")
    return rounded(stats.class_balance(labels, "y"), "share")


@query(
    "a3_grouped_length_stats",
    "SELECT lang, count(*) AS count, round(avg(length(text)), 6) AS mean, round(median(length(text)), 6) AS median, "
    "round(stddev_samp(length(text)), 6) AS std, CAST(min(length(text)) AS DOUBLE) AS min, CAST(max(length(text)) AS DOUBLE) AS max "
    "FROM documents GROUP BY lang",
)
def a3(spark, folder):
    sized = table(spark, folder, "documents").select("lang", char_length(F.col("text")).alias("n_chars"))
    return rounded(stats.grouped_stats(sized, ["lang"], "n_chars"), "mean", "median", "std")


@query(
    "a3_quantities_by_order",
    "SELECT l_orderkey, count(*) AS count, round(avg(l_quantity), 6) AS mean, round(median(l_quantity), 6) AS median, round(stddev_samp(l_quantity), 6) AS std, "
    "min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem GROUP BY l_orderkey",
)
def a3_orders(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    return rounded(stats.grouped_stats(rows, ["l_orderkey"], "l_quantity"), "mean", "median", "std")


@query(
    "a3_ratio_means_and_medians",
    FEATURED + " SELECT y, round(avg(digit_ratio), 6) AS digit_ratio_mean, round(median(digit_ratio), 6) AS digit_ratio_median, "
    "round(avg(uppercase_ratio), 6) AS uppercase_ratio_mean, round(median(uppercase_ratio), 6) AS uppercase_ratio_median FROM feats GROUP BY y",
)
def a3_ratios(spark, folder):
    text = F.col("text")
    rows = labelled(spark, folder).select("y", digit_ratio(text).alias("digit_ratio"), uppercase_ratio(text).alias("uppercase_ratio"))
    out = None
    for name in ("digit_ratio", "uppercase_ratio"):
        part = stats.grouped_stats(rows, ["y"], name).select(
            "y", F.round("mean", 6).alias(f"{name}_mean"), F.round("median", 6).alias(f"{name}_median")
        )
        out = part if out is None else out.join(part, "y")
    return out


@query(
    "a4_describe_features",
    LONG + " SELECT feature, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, "
    "round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, "
    "round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM tall GROUP BY feature",
)
def a4(spark, folder):
    return rounded(stats.describe(featured(spark, folder), FEATURE_NAMES), "mean", "std", "p25", "p50", "p75")


_LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a4_describe_line_items",
    "WITH tall AS (SELECT feature, value FROM lineitem UNPIVOT (value FOR feature IN (" + ", ".join(_LINE_COLUMNS) + "))) "
    "SELECT feature, count(*) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min, "
    "round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, "
    "round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM tall GROUP BY feature",
)
def a4_lines(spark, folder):
    described = stats.describe(table(spark, folder, "lineitem"), _LINE_COLUMNS)
    return rounded(rounded(described, "mean", "std", digits=4), "p25", "p50", "p75")


_LISTING_FIELDS = "name year selling_price km_driven fuel seller_type transmission owner mileage engine max_power torque seats".split()


@query(
    "a5_null_counts",
    "WITH " + RAW_LISTINGS + " SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
        f"count({c}) = 0 AS all_missing FROM raw_listings" for c in _LISTING_FIELDS
    ) + ") WHERE n_missing > 0",
)
def a5(spark, folder):
    return stats.null_counts(raw_listings(spark, folder), _LISTING_FIELDS)


@query(
    "a6_duplicate_summary",
    "WITH s AS (SELECT 'text' AS scope, count(*) AS n_rows, count(DISTINCT text) AS d FROM documents "
    "UNION ALL SELECT 'lang and text', count(*), count(DISTINCT (lang, text)) FROM documents) "
    "SELECT scope, n_rows, n_rows - d AS n_duplicates, round((n_rows - d) / n_rows, 6) AS duplicate_share FROM s",
)
def a6(spark, folder):
    docs = table(spark, folder, "documents")
    return rounded(
        dedupe.duplicate_summary(docs, ["text"]).withColumn("scope", F.lit("text")).unionByName(
            dedupe.duplicate_summary(docs, ["lang", "text"]).withColumn("scope", F.lit("lang and text"))
        ),
        "duplicate_share",
    )


@query(
    "a7_duplicate_group_totals",
    "WITH g AS (SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1) "
    "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved, count(*) AS distinct_values FROM g",
)
def a7(spark, folder):
    groups = dedupe.duplicate_groups(table(spark, folder, "documents"), ["text"])
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_involved"), F.count(F.lit(1)).alias("distinct_values"))


@query(
    "a7_most_repeated",
    "SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1 ORDER BY n DESC, digest LIMIT 5",
)
def a7_top(spark, folder):
    groups = dedupe.duplicate_groups(table(spark, folder, "documents"), ["text"])
    return groups.select(F.md5("text").alias("digest"), "n").orderBy(F.col("n").desc(), "digest").limit(5)


_D = (
    "CASE WHEN coalesce(n1, 0) < 2 OR coalesce(n0, 0) < 2 THEN 0.0 WHEN sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)) = 0 "
    "THEN CASE WHEN m1 = m0 THEN 0.0 WHEN m1 > m0 THEN CAST('inf' AS DOUBLE) ELSE CAST('-inf' AS DOUBLE) END "
    "ELSE (m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)) END"
)
_MOMENTS = (
    ", m AS (SELECT feature, " + ", ".join(
        f"{agg}(value) FILTER (WHERE y = {y}) AS {short}{y}"
        for y in (0, 1) for agg, short in (("count", "n"), ("avg", "m"), ("var_samp", "v"))
    ) + " FROM tall GROUP BY feature)"
)
COHENS_D = LONG + _MOMENTS + f" SELECT feature, round({_D}, 6) AS cohens_d, round(m0, 6) AS mean_0, round(m1, 6) AS mean_1 FROM m"


@query("a8_cohens_d", COHENS_D)
def a8(spark, folder):
    found = stats.cohens_d(featured(spark, folder), FEATURE_NAMES, "y")
    return rounded(found, "cohens_d", "mean_0", "mean_1").orderBy(F.abs("cohens_d").desc(), "feature")


def sql_stumps(tall: str, extra: str = "") -> str:
    """Best threshold per feature from window sums over distinct values."""
    k = f"{extra}feature"
    return f"""c AS (SELECT {k}, value, count(*) AS n, sum(y) AS pos FROM {tall} GROUP BY {k}, value),
 w AS (SELECT {k}, value, sum(n) OVER o AS nl, sum(pos) OVER o AS pl, sum(n) OVER (PARTITION BY {k}) AS tn,
       sum(pos) OVER (PARTITION BY {k}) AS tp FROM c WINDOW o AS (PARTITION BY {k} ORDER BY value)),
 s AS (SELECT *, tn - nl AS nr, tp - pl AS pr, CASE WHEN tn > nl AND tp > 0 AND tp < tn THEN
       CAST(pl * pl + (nl - pl) * (nl - pl) AS DOUBLE) / nl
       + CAST((tp - pl) * (tp - pl) + (tn - nl - tp + pl) * (tn - nl - tp + pl) AS DOUBLE) / (tn - nl) ELSE -1.0 END AS score FROM w),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY score DESC, value) AS place FROM s) WHERE place = 1),
 leaves AS (SELECT {k}, CASE WHEN score >= 0 THEN value END AS split_value, nl, pl, nr, pr, tn, tp,
       CASE WHEN score >= 0 THEN pl * 2 > nl ELSE tp * 2 > tn END AS l1, CASE WHEN score >= 0 THEN pr * 2 > nr ELSE tp * 2 > tn END AS r1 FROM b),
 stump AS (SELECT {k}, split_value, CAST(l1 AS INTEGER) AS left_class, CAST(r1 AS INTEGER) AS right_class,
       CASE WHEN (CASE WHEN l1 THEN nl ELSE 0 END) + (CASE WHEN r1 THEN nr ELSE 0 END) + tp = 0 THEN 0.0 ELSE
       2.0 * ((CASE WHEN l1 THEN pl ELSE 0 END) + (CASE WHEN r1 THEN pr ELSE 0 END))
       / CAST((CASE WHEN l1 THEN nl ELSE 0 END) + (CASE WHEN r1 THEN nr ELSE 0 END) + tp AS DOUBLE) END AS stump_f1 FROM leaves)"""


@query(
    "a9_class_separation",
    LONG + _MOMENTS + ", " + sql_stumps("tall") + f" SELECT m.feature, round({_D}, 6) AS cohens_d, round(m0, 6) AS mean_0, "
    "round(m1, 6) AS mean_1, round(stump_f1, 6) AS stump_f1 FROM m JOIN stump ON m.feature = stump.feature",
)
def a9(spark, folder):
    found = stats.class_separation(featured(spark, folder), FEATURE_NAMES, "y")
    return rounded(found, "cohens_d", "mean_0", "mean_1", "stump_f1")


_TALKS = (
    "WITH talks AS (SELECT text, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS y FROM conversations WHERE role IN ('user', 'assistant')), "
    "feats AS (" + sql_features("talks", "y") + "), tall AS (" + sql_melt("feats", "y") + ")"
)


@query(
    "a10_decision_stumps",
    _TALKS + ", " + sql_stumps("tall") + " SELECT feature, round(split_value, 6) AS split_value, left_class, right_class, "
    "round(stump_f1, 6) AS stump_f1 FROM stump",
)
def a10(spark, folder):
    talks = texts(spark, folder, "conversations", "role", "text").filter(F.col("role").isin("user", "assistant"))
    rows = talks.select("text", (F.col("role") == "assistant").cast("int").alias("y"))
    found = stats.stumps(feature_frame(rows, "text", ["y"]), FEATURE_NAMES, "y")
    return rounded(found, "split_value", "stump_f1")


_NUMERIC = ("quantity", "discount", "tax", "size", "retail")


@query(
    "a17_correlation_with_target",
    "WITH " + PRICED + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, price), 6) AS r FROM priced" for c in _NUMERIC
    ) + ")",
)
def a17(spark, folder):
    return rounded(stats.correlations(priced_lines(spark, folder), _NUMERIC, "price").orderBy("r"), "r")


@query(
    "a17_strongest_correlates",
    "WITH " + PRICED + " SELECT feature, r FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, price), 6) AS r FROM priced" for c in _NUMERIC
    ) + ") ORDER BY abs(r) DESC, feature LIMIT 3",
)
def a17_top(spark, folder):
    return rounded(stats.strongest(priced_lines(spark, folder), _NUMERIC, "price", 3), "r")


@query(
    "a18_skewness",
    "SELECT round(skewness(l_extendedprice), 6) AS skewness, round(median(l_extendedprice), 6) AS median, "
    "round(avg(l_extendedprice), 4) AS mean, max(l_extendedprice) AS max FROM lineitem",
)
def a18(spark, folder):
    found = stats.skew_summary(table(spark, folder, "lineitem"), "l_extendedprice")
    return rounded(rounded(found, "skewness", "median"), "mean", digits=4)


_BIN = "least(CAST(floor(x / (350.0 / 45)) AS BIGINT) + 1, 45)"


@query(
    "a19_length_histogram_by_class",
    "WITH " + LABELLED + ", v AS (SELECT y, CAST(least(length(text), 350) AS DOUBLE) AS x FROM labelled) "
    f"SELECT y, {_BIN} AS bin, count(*) AS n, round(({_BIN} - 1) * (350.0 / 45), 6) AS bin_start FROM v GROUP BY y, {_BIN}",
)
def a19(spark, folder):
    clipped = labelled(spark, folder).select("y", F.least(char_length(F.col("text")), F.lit(350)).alias("x"))
    return rounded(stats.histogram(clipped, "x", 0, 350, 45, ["y"]), "bin_start")


def _sql_range_histogram(value: str, source: str) -> str:
    at = "least(CAST(floor((x - lo) / ((hi - lo) / 60)) AS BIGINT) + 1, 60)"
    return (
        f"WITH v AS (SELECT {value} AS x FROM {source}), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v), "
        f"p AS (SELECT {at} AS bin, lo, hi FROM v, e WHERE x IS NOT NULL) "
        "SELECT bin, count(*) AS n, round(any_value(lo) + (bin - 1) * ((any_value(hi) - any_value(lo)) / 60), 4) AS bin_start FROM p GROUP BY bin"
    )


@query("a19_price_histogram", _sql_range_histogram("o_totalprice", "orders"))
def a19_price(spark, folder):
    return rounded(stats.histogram_over_range(table(spark, folder, "orders"), "o_totalprice", 60), "bin_start", digits=4)


@query("a19_log_price_histogram", _sql_range_histogram("log10(o_totalprice)", "orders"))
def a19_log(spark, folder):
    orders = table(spark, folder, "orders").select(F.log10("o_totalprice").alias("x"))
    return rounded(stats.histogram_over_range(orders, "x", 60), "bin_start", digits=4)


@query(
    "a20_length_density_by_class",
    "WITH " + LABELLED + ", v AS (SELECT y, CAST(least(length(text), 350) AS DOUBLE) AS x FROM labelled), "
    "h AS (SELECT y, stddev_samp(x) * power(count(*), -0.2) AS h, count(*) AS total FROM v GROUP BY y), "
    "c AS (SELECT y, x, count(*) AS n FROM v GROUP BY y, x), g AS (SELECT 5.0::DOUBLE * i AS at FROM range(71) t(i)) "
    "SELECT c.y, g.at, round(sum(n * exp(-0.5 * power((g.at - x) / nullif(h, 0), 2))) / (any_value(total) * nullif(any_value(h), 0) * sqrt(2 * pi())), 8) AS density "
    "FROM c JOIN h ON c.y = h.y CROSS JOIN g GROUP BY c.y, g.at",
)
def a20(spark, folder):
    rows = labelled(spark, folder).select("y", char_length(F.col("text")).alias("n_chars"))
    return rounded(stats.density(rows, "n_chars", ["y"], 0, 350, 71), "density", digits=8)


@query(
    "a20_binned_price_density",
    "WITH v AS (SELECT l_returnflag, least(l_extendedprice, 60000.0::DOUBLE) AS x FROM lineitem), "
    "h AS (SELECT l_returnflag, stddev_samp(x) * power(count(*), -0.2) AS h, count(*) AS total, min(x) AS lo FROM v GROUP BY l_returnflag), "
    "e AS (SELECT min(lo) AS lo, min(h) / 32 AS step FROM h), p AS (SELECT l_returnflag, (x - lo) / step AS place, lo, step FROM v, e), "
    "c AS (SELECT l_returnflag, cell, sum(w) AS w, any_value(lo) + cell * any_value(step) AS x FROM (SELECT l_returnflag, floor(place) AS cell, 1 - (place - floor(place)) AS w, lo, step FROM p "
    "UNION ALL SELECT l_returnflag, floor(place) + 1, place - floor(place), lo, step FROM p) GROUP BY l_returnflag, cell), g AS (SELECT 1000.0::DOUBLE * i AS at FROM range(61) t(i)) "
    "SELECT c.l_returnflag, g.at, round(sum(w * exp(-0.5 * power((g.at - x) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 11) AS density "
    "FROM c JOIN h ON c.l_returnflag = h.l_returnflag CROSS JOIN g GROUP BY c.l_returnflag, g.at",
)
def a20_binned(spark, folder):
    """A column of nearly as many values as rows."""
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(stats.binned_density(rows, "l_extendedprice", ["l_returnflag"], 0, 60_000, 61), "density", digits=11)


@query(
    "w1_drop_duplicates_keep_first",
    "SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place FROM documents) WHERE place = 1",
)
def w1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    return dedupe.drop_duplicates(docs, "doc_id", ["text"]).select("doc_id", "lang", "source")


@query(
    "w1_drop_duplicate_rows",
    "SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type",
)
def w1_rows(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return dedupe.drop_duplicates(events, "event_id")


@query(
    "w2_duplicate_members",
    "SELECT doc_id, lang FROM (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1",
)
def w2(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return dedupe.duplicate_members(docs, ["text"]).select("doc_id", "lang")


@query(
    "w3_step_gain",
    "SELECT n_turns, n, n - lag(n) OVER (ORDER BY n_turns) AS gain FROM (SELECT n_turns, count(*) AS n FROM "
    "(SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id) GROUP BY n_turns)",
)
def w3(spark, folder):
    from corpusloom.operators.audit import step_gain

    turns = table(spark, folder, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return step_gain(turns.groupBy("n_turns").agg(F.count(F.lit(1)).alias("n")), "n_turns", "n")


@query(
    "w6_top_k",
    "SELECT source, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY source ORDER BY n_chars DESC, source LIMIT 7",
)
def w6(spark, folder):
    sizes = table(spark, folder, "documents").groupBy("source").agg(F.sum(F.length("text")).alias("n_chars"))
    return sizes.orderBy(F.col("n_chars").desc(), "source").limit(7)


@query(
    "w7_union_of_samples",
    "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('7|' || CAST(doc_id AS VARCHAR)), doc_id) AS place "
    "FROM documents) WHERE place <= 3 UNION ALL SELECT role, conv_id FROM (SELECT role, conv_id, row_number() OVER (PARTITION BY role ORDER BY "
    "md5('7|' || CAST(conv_id AS VARCHAR) || '|' || CAST(turn AS VARCHAR)), conv_id) AS place FROM conversations) WHERE place <= 3",
)
def w7(spark, folder):
    from pyspark.sql import Window

    from corpusloom.operators.ordered import hash_key

    def pick(df, group, key, hashed):
        place = F.row_number().over(Window.partitionBy(group).orderBy(hash_key(hashed, 7), key))
        kept = df.select(group, key, place.alias("place")).filter("place <= 3")
        return kept.select(F.col(group).alias("lang"), F.col(key).alias("doc_id"))

    docs = pick(table(spark, folder, "documents"), "lang", "doc_id", "doc_id")
    talks = pick(table(spark, folder, "conversations"), "role", "conv_id", ["conv_id", "turn"])
    return docs.unionByName(talks)


@query(
    "j1_features_beside_source",
    "WITH " + LABELLED + ", feats AS (" + sql_features("labelled", "doc_id, y", ("char_length", "digit_count")) + ") SELECT * FROM feats",
)
def j1(spark, folder):
    frame = feature_frame(labelled(spark, folder), "text", ["doc_id", "y"])
    return frame.select("doc_id", "y", "char_length", "digit_count")


@query("p14_clip", "SELECT doc_id, least(length(text), 350) AS clipped FROM documents")
def p14(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.least(F.length("text"), F.lit(350)).cast("long").alias("clipped"))


@query("p15_log10", "SELECT o_orderkey, round(log10(o_totalprice), 6) AS log_price FROM orders")
def p15(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.round(F.log10("o_totalprice"), 6).alias("log_price"))
