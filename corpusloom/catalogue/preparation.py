"""Splitting, and preparation fitted on the training half."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import prep as P
from corpusloom.operators.dedupe import duplicate_summary, overlap
from corpusloom.operators.metrics import leak_check
from corpusloom.operators.split import assign_partitions, split_rows
from corpusloom.operators.stats import melt
from corpusloom.operators.wide import WideEncoder, column_sums
from corpusloom.plans.models import simple_line
from corpusloom.workspace import materialise

from .base import LABELLED, PRICED, labelled, priced_lines, query, rounded, sql_hash, table
from .listings import CLEANED, cleaned


def sql_split(source: str, key: str, test_size: float = 0.2, seed: int = 42) -> str:
    """Rows of `source` with `partition`: the first ceil(share * n) in hash order test."""
    return (
        f"SELECT * EXCLUDE (place, total), CASE WHEN place <= ceil({test_size} * total - 1e-9) THEN 'test' ELSE 'train' END AS partition FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {sql_hash(key, seed)}) AS place, count(*) OVER () AS total FROM {source})"
    )


def sql_stratified(source: str, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> str:
    return (
        f"WITH sizes AS (SELECT {label}, count(*) AS s, sum(count(*)) OVER () AS total FROM {source} GROUP BY {label}), "
        f"shares AS (SELECT *, ceil({test_size} * total - 1e-9) * s / total AS exact, floor(ceil({test_size} * total - 1e-9) * s / total + 1e-9) AS low FROM sizes), "
        f"quotas AS (SELECT {label}, low + CASE WHEN row_number() OVER (ORDER BY round(exact - low, 9) DESC, CAST({label} AS VARCHAR)) "
        f"<= ceil({test_size} * total - 1e-9) - sum(low) OVER () THEN 1 ELSE 0 END AS quota FROM shares) "
        f"SELECT r.* EXCLUDE (place), CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS partition FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {label} ORDER BY {sql_hash(key, seed)}) AS place FROM {source}) r JOIN quotas q ON r.{label} = q.{label}"
    )


@query(
    "t1_dedupe_then_split",
    "WITH firsts AS (SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text) SELECT doc_id, partition FROM ("
    + sql_split("firsts", "doc_id") + ")",
)
def t1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return split_rows(docs, "doc_id", duplicate_subset=["text"]).assigned.select("doc_id", "partition")


@query("t1_split_orders", "SELECT o_orderkey, partition FROM (" + sql_split("orders", "o_orderkey") + ")")
def t1_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return assign_partitions(orders, "o_orderkey")


@query("t2_stratified_split", "SELECT c_custkey, c_mktsegment, partition FROM (" + sql_stratified("customer", "c_custkey", "c_mktsegment") + ")")
def t2(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return assign_partitions(rows, "c_custkey", stratify="c_mktsegment")


_LINE_KEY = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
_LINES = f"(SELECT DISTINCT {_LINE_KEY} AS row_key, l_orderkey FROM lineitem)"


@query("t2_stratified_by_order", sql_stratified(_LINES, "row_key", "l_orderkey"))
def t2_many(spark, folder):
    """As many strata as there are orders: 15,000 at the small scale."""
    # Dealt by order, equal lines meet in one task; the key is made behind the shuffle.
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").repartition("l_orderkey")
    rows = materialise(lines.selectExpr(f"{_LINE_KEY} AS row_key", "l_orderkey").distinct(), "lines")
    return assign_partitions(rows, "row_key", stratify="l_orderkey")


_UNIQUE = LABELLED + ", firsts AS (SELECT min(doc_id) AS doc_id, text, y FROM labelled GROUP BY text, y)"
_SPLIT_LABELS = "WITH " + _UNIQUE + ", assigned AS (" + sql_stratified("firsts", "doc_id", "y") + ")"


def _labelled_split(spark, folder, **options):
    return split_rows(labelled(spark, folder), "doc_id", target="y", stratify=True, **options)


@query(
    "a2_balance_per_partition",
    _SPLIT_LABELS + " SELECT y, " + ", ".join(
        f"count(*) FILTER (WHERE partition = '{p}') AS {p}_n, round(count(*) FILTER (WHERE partition = '{p}') / "
        f"any_value(t.{p}), 6) AS {p}_share" for p in ("train", "test")
    ) + " FROM assigned CROSS JOIN (SELECT " + ", ".join(
        f"count(*) FILTER (WHERE partition = '{p}') AS {p}" for p in ("train", "test")
    ) + " FROM assigned) t GROUP BY y",
)
def a2(spark, folder):
    return rounded(_labelled_split(spark, folder).describe(), "train_share", "test_share")


@query(
    "p7_model_and_meta_columns",
    _SPLIT_LABELS + " SELECT doc_id, md5(text) AS digest FROM assigned WHERE partition = 'test'",
)
def p7(spark, folder):
    split = split_rows(
        labelled(spark, folder).withColumn("n_chars", F.length("text")), "doc_id", target="y", stratify=True, keep_columns=["n_chars"]
    )
    return split.meta("test").select("doc_id", F.md5("text").alias("digest"))


@query(
    "j5_overlap_after_dedupe",
    "SELECT 'deduped' AS run, CAST(0 AS BIGINT) AS n_overlap UNION ALL SELECT 'as is', count(*) FROM (SELECT text FROM ("
    + sql_split("documents", "doc_id") + ") WHERE partition = 'train' INTERSECT SELECT text FROM ("
    + sql_split("documents", "doc_id") + ") WHERE partition = 'test')",
)
def j5(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = None
    for name, dedupe in (("deduped", True), ("as is", False)):
        split = split_rows(docs, "doc_id", dedupe=dedupe)
        shared = overlap(split.train.X, split.test_X, ["text"]).agg(F.count(F.lit(1)).alias("n_overlap"))
        part = shared.select(F.lit(name).alias("run"), "n_overlap")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "j2_predictions_with_meta",
    _SPLIT_LABELS + " SELECT doc_id, md5(text) AS digest, y, CAST(length(text) AS BIGINT) AS n_chars FROM assigned WHERE partition = 'test'",
)
def j2(spark, folder):
    split = split_rows(
        labelled(spark, folder).withColumn("n_chars", F.length("text").cast("long")), "doc_id", target="y", stratify=True, keep_columns=["n_chars"]
    )
    scored = split.test_rows.select("doc_id", "y", "n_chars")
    return scored.join(split.meta("test"), "doc_id", "left").select("doc_id", F.md5("text").alias("digest"), "y", "n_chars")


@query(
    "j2_predicted_classes_with_meta",
    _SPLIT_LABELS + ", line AS (SELECT regr_slope(y, length(text)) AS a, regr_intercept(y, length(text)) AS b, avg(y) AS rate FROM assigned WHERE partition = 'train') "
    "SELECT doc_id, md5(text) AS digest, y, round(a * length(text) + b, 6) AS p, CAST(round(a * length(text) + b, 6) >= round(rate, 6) AS INTEGER) AS predicted "
    "FROM assigned, line WHERE partition = 'test'",
)
def j2_predicted(spark, folder):
    """A line through the training half gives each held-out row its score and class; the texts come from the meta columns."""
    split = split_rows(
        labelled(spark, folder).withColumn("n_chars", F.length("text").cast("double")), "doc_id", target="y", stratify=True, keep_columns=["n_chars"]
    )
    train = split.assigned.filter("partition = 'train'")
    slope, intercept, _ = simple_line(train, "n_chars", "y")
    rate = train.agg(F.avg("y")).first()[0]
    p = F.round(F.lit(slope) * F.col("n_chars") + F.lit(intercept), 6)
    scored = split.test_rows.select("doc_id", "y", p.alias("p")).withColumn("predicted", (F.col("p") >= round(rate, 6)).cast("int"))
    return scored.join(split.meta("test"), "doc_id", "left").select("doc_id", F.md5("text").alias("digest"), "y", "p", "predicted")


@query(
    "a28_duplicates_with_and_without_target",
    "WITH n AS (SELECT count(*) AS n_rows FROM lineitem) SELECT 'features' AS scope, n_rows, n_rows - (SELECT count(*) FROM "
    "(SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem)) AS n_duplicates FROM n UNION ALL SELECT 'features and target', n_rows, n_rows - "
    "(SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem)) FROM n",
)
def a28(spark, folder):
    rows = table(spark, folder, "lineitem")
    features = ["l_quantity", "l_discount", "l_tax"]
    out = duplicate_summary(rows, features).withColumn("scope", F.lit("features"))
    both = duplicate_summary(rows, [*features, "l_extendedprice"]).withColumn("scope", F.lit("features and target"))
    return out.unionByName(both).drop("duplicate_share")


# -- fitted statistics on the cleaned listings ------------------------------
_NUMERIC = ("km_driven", "mileage", "engine", "max_power", "torque", "seats", "owner_rank", "age")
_CATEGORICAL = ("fuel", "seller_type", "transmission", "make")
_FIELDS = ", ".join(("selling_price", *_NUMERIC, *_CATEGORICAL))
SPLIT_LISTINGS = (
    CLEANED + f", usable AS (SELECT min(listing_id) AS listing_id, {_FIELDS} FROM cleaned WHERE selling_price IS NOT NULL GROUP BY {_FIELDS}), "
    "assigned AS (" + sql_split("usable", "listing_id") + "), train AS (SELECT * FROM assigned WHERE partition = 'train')"
)
_TALL_NUMERIC = ", tall AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM train" for c in _NUMERIC
) + ")"
_FILLS = ", fills AS (SELECT feature, coalesce(median(value), 0.0) AS fill FROM tall GROUP BY feature)"
_MOMENTS = (
    ", moments AS (SELECT tall.feature, any_value(fill) AS fill, avg(coalesce(value, fill)) AS mean, stddev_pop(coalesce(value, fill)) AS std "
    "FROM tall JOIN fills ON tall.feature = fills.feature GROUP BY tall.feature)"
)
_TALL_LEVELS = ", levels AS (SELECT feature, level, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM train" for c in _CATEGORICAL
) + ") WHERE level IS NOT NULL GROUP BY feature, level)"
_MODES = ", modes AS (SELECT feature, level AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, level) AS place FROM levels) WHERE place = 1)"
PREPARED = SPLIT_LISTINGS + _TALL_NUMERIC + _FILLS + _MOMENTS + _TALL_LEVELS + _MODES


def listing_split(spark, folder):
    rows = cleaned(spark, folder).dropna(subset=["selling_price"])
    return split_rows(rows, "listing_id", target="selling_price")


def fitted(spark, folder, **options):
    split = listing_split(spark, folder)
    return split, P.Preparation(**options).fit(split.train)


@query("t3_train_only_statistics", SPLIT_LISTINGS + " SELECT partition, count(*) AS n FROM assigned GROUP BY partition")
def t3(spark, folder):
    return listing_split(spark, folder).assigned.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t3_fitted_against_full_medians",
    PREPARED + ", tall_full AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM assigned" for c in _NUMERIC) + ") "
    "SELECT fills.feature, round(any_value(fill), 6) AS fitted, round(coalesce(median(value), 0.0), 6) AS full_median, true AS full_table_rejected, "
    "true AS test_half_rejected FROM fills JOIN tall_full ON fills.feature = tall_full.feature GROUP BY fills.feature",
)
def t3_fitted(spark, folder):
    """What was learnt from the training half beside the same statistic of all rows, and the fits that are refused."""
    split, prep = fitted(spark, folder)

    def refused(rows):
        try:
            P.Preparation().fit(rows)
        except TypeError:
            return True
        return False

    full = split.assigned.select(*[F.col(c).cast("double").alias(c) for c in _NUMERIC])
    tall = full.unpivot([], list(_NUMERIC), "feature", "value")
    medians = tall.groupBy("feature").agg(F.round(F.coalesce(F.median("value"), F.lit(0.0)), 6).alias("full_median"))
    learnt = prep.summary(spark).filter("kind = 'numeric'").select(F.col("column").alias("feature"), F.round(F.col("fill").cast("double"), 6).alias("fitted"))
    return learnt.join(medians, "feature").select(
        "*", F.lit(refused(split.assigned)).alias("full_table_rejected"), F.lit(refused(split.test_X)).alias("test_half_rejected")
    )


@query("t4_numeric_imputation", PREPARED + " SELECT feature, round(fill, 6) AS fill FROM fills")
def t4(spark, folder):
    _, prep = fitted(spark, folder)
    found = prep.summary(spark).filter("kind = 'numeric'")
    return found.select(F.col("column").alias("feature"), F.round(F.col("fill").cast("double"), 6).alias("fill"))


@query("t5_categorical_mode", PREPARED + " SELECT feature, mode, n FROM modes")
def t5(spark, folder):
    train = listing_split(spark, folder).train.X
    return P.modes(P.level_counts(train, list(_CATEGORICAL)))


@query(
    "t6_one_hot_encoding",
    PREPARED + " SELECT listing_id, feature, column_name, 1.0::DOUBLE AS value FROM (" + " UNION ALL ".join(
        f"SELECT a.listing_id, '{c}' AS feature, '{c}_' || coalesce(a.{c}, m.mode) AS column_name, coalesce(a.{c}, m.mode) AS level "
        f"FROM assigned a JOIN modes m ON m.feature = '{c}'" for c in _CATEGORICAL
    ) + ") x WHERE EXISTS (SELECT 1 FROM levels l WHERE l.feature = x.feature AND l.level = x.level)",
)
def t6(spark, folder):
    """The non-zero cells of the encoded matrix, one row per cell."""
    split, prep = fitted(spark, folder)
    encoded = prep.transform(split.assigned.select("listing_id", *split.model_columns), ["listing_id"])
    names = [n for s in prep.states if s.kind == "categorical" for n in (level.name for level in s.levels)]
    return _cells(encoded, names)


@query(
    "t6_wide_encoding",
    "WITH rows AS " + _LINES + ", assigned AS (" + sql_split("rows", "row_key") + "), levels AS (SELECT CAST(l_orderkey AS VARCHAR) AS level, "
    "row_number() OVER (ORDER BY CAST(l_orderkey AS VARCHAR)) - 1 AS place FROM (SELECT DISTINCT l_orderkey FROM assigned WHERE partition = 'train')) "
    "SELECT level, place, CAST(count(*) AS DOUBLE) AS n FROM levels JOIN assigned ON level = CAST(l_orderkey AS VARCHAR) GROUP BY level, place",
)
def t6_wide(spark, folder):
    """Column sums of the sparse matrix of one column per order number: 15,000 at the small scale."""
    rows = table(spark, folder, "lineitem").selectExpr(f"{_LINE_KEY} AS row_key", "l_orderkey").distinct()
    split = split_rows(rows, "row_key", dedupe=False)
    encoder = WideEncoder(["l_orderkey"]).fit(split.train)
    cells = column_sums(encoder.transform(split.assigned))
    return cells.join(encoder.levels, cells["place"] == encoder.levels["index"]).select("level", F.col("place").cast("long"), cells["n"])


@query(
    "t3_train_only_against_full",
    SPLIT_LISTINGS + " SELECT feature, round(avg(value) FILTER (WHERE partition = 'train'), 6) AS train_mean, round(avg(value), 6) AS full_mean, "
    "round(stddev_pop(value) FILTER (WHERE partition = 'train'), 6) AS train_std, round(stddev_pop(value), 6) AS full_std FROM ("
    + " UNION ALL ".join(f"SELECT partition, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM assigned" for c in _NUMERIC) + ") GROUP BY feature",
)
def t3_against_full(spark, folder):
    """What the fit sees beside what it must not see."""
    found = P.train_against_full(listing_split(spark, folder), list(_NUMERIC))
    return rounded(found, "train_mean", "full_mean", "train_std", "full_std")


@query("t3_rejected_fits", SPLIT_LISTINGS + " SELECT input, accepted, CASE WHEN accepted THEN (SELECT count(*) FROM train) END AS n_rows_seen FROM "
       "(VALUES ('training half', true), ('test half', false), ('whole table', false), ('training rows as a table', false)) t(input, accepted)")  # fmt: skip
def t3_rejected(spark, folder):
    """Which inputs a fit accepts: only the training half that a split hands out."""
    split = listing_split(spark, folder)
    inputs = {"training half": split.train, "test half": split.test_X, "whole table": split.assigned, "training rows as a table": split.train.X}
    seen = []
    for name, part in inputs.items():
        prep = P.Preparation()
        try:
            prep.fit(part)
        except TypeError:
            pass
        seen.append((name, prep.is_fitted, prep.n_rows_seen if prep.is_fitted else None))
    return spark.createDataFrame(seen, "input string, accepted boolean, n_rows_seen long")


def _cells(encoded, names):
    cells = F.filter(
        F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("value")) for n in names]),
        lambda c: c["value"] != 0,
    )
    tall = encoded.select("listing_id", F.inline(cells))
    feature = F.regexp_extract("column_name", f"^({'|'.join(_CATEGORICAL)})_", 1)
    return tall.select("listing_id", feature.alias("feature"), "column_name", "value")


_CAP = 10
_FOLDED = (
    ", filled AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(t.{c}, m.mode) AS level FROM train t JOIN modes m ON m.feature = '{c}'" for c in _CATEGORICAL
    ) + f"), filled_counts AS (SELECT feature, level, count(*) AS n FROM filled GROUP BY feature, level), "
    f"folded AS (SELECT feature, level, n, (count(*) OVER (PARTITION BY feature) + 1 > {_CAP}) AND row_number() OVER (PARTITION BY feature ORDER BY n DESC, level DESC) "
    f"> {_CAP - 1} AS rare FROM filled_counts)"
)


@query("t7_rare_level_folding", PREPARED + _FOLDED + " SELECT feature, level, n, rare FROM folded")
def t7(spark, folder):
    _, prep = fitted(spark, folder, max_categories=_CAP)
    return prep.level_table.select("feature", "level", "n", "rare")


@query(
    "t8_drop_first_level",
    PREPARED + _FOLDED + ", named AS (SELECT DISTINCT feature, CASE WHEN rare THEN feature || '_infrequent_sklearn' ELSE feature || '_' || level END AS column_name, "
    "rare, CASE WHEN rare THEN NULL ELSE level END AS level FROM folded) SELECT feature, column_name FROM (SELECT *, row_number() OVER (PARTITION BY feature "
    "ORDER BY rare, level) AS place FROM named) WHERE place > 1",
)
def t8(spark, folder):
    _, prep = fitted(spark, folder, max_categories=_CAP, drop_first=True)
    rows = [(s.column, level.name) for s in prep.states if s.kind == "categorical" for level in s.levels]
    return spark.createDataFrame(rows, "feature string, column_name string")


def _sql_scaled(where: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT a.listing_id, '{c}' AS feature, (coalesce(CAST(a.{c} AS DOUBLE), m.fill) - m.mean) / CASE WHEN m.std = 0 THEN 1.0 ELSE m.std END AS value "
        f"FROM assigned a JOIN moments m ON m.feature = '{c}' {where}" for c in _NUMERIC
    )
    return f" SELECT listing_id, feature, round(value, 6) AS value FROM ({parts})"


@query("t9_standardise", PREPARED + _sql_scaled(""))
def t9(spark, folder):
    split, prep = fitted(spark, folder)
    scaled = prep.transform(split.assigned.select("listing_id", *split.model_columns), ["listing_id"])
    return rounded(melt(scaled, list(_NUMERIC), ["listing_id"]), "value")


@query(
    "t10_standardise_one_hot",
    PREPARED + _FOLDED + ", total AS (SELECT count(*) AS n_rows FROM train) SELECT feature, feature || '_' || level AS column_name, "
    "round(n / n_rows, 6) AS mean, round(sqrt((n / n_rows) * (1 - n / n_rows)), 6) AS scale FROM filled_counts, total",
)
def t10(spark, folder):
    _, prep = fitted(spark, folder, scale_encoded=True)
    rows = [
        (s.column, level.name, round(level.mean, 6), round(level.scale, 6))
        for s in prep.states if s.kind == "categorical" for level in s.levels
    ]
    return spark.createDataFrame(rows, "feature string, column_name string, mean double, scale double")


@query("t11_transform_test_half", PREPARED + _sql_scaled("WHERE a.partition = 'test'"))
def t11(spark, folder):
    split, prep = fitted(spark, folder)
    scaled = prep.transform(split.test_rows.select("listing_id", *split.model_columns), ["listing_id"])
    return rounded(melt(scaled, list(_NUMERIC), ["listing_id"]), "value")


@query(
    "t12_preparation_summary",
    PREPARED + ", total AS (SELECT count(*) AS n_rows_seen FROM train) SELECT feature AS column, 'numeric' AS kind, round(mean, 6) AS mean, "
    "round(CASE WHEN std = 0 THEN 1.0 ELSE std END, 6) AS scale, CAST(0 AS INTEGER) AS n_levels, n_rows_seen FROM moments, total "
    "UNION ALL SELECT feature, 'categorical', 0.0, 1.0, CAST(count(*) AS INTEGER), any_value(n_rows_seen) FROM levels, total GROUP BY feature",
)
def t12(spark, folder):
    _, prep = fitted(spark, folder)
    return rounded(prep.summary(spark).drop("fill"), "mean", "scale")


_WIDE = 20
_LISTED = (
    ", filled AS (" + " UNION ALL ".join(
        f"SELECT a.listing_id, a.partition, '{c}' AS feature, coalesce(a.{c}, m.mode) AS level FROM assigned a JOIN modes m ON m.feature = '{c}'"
        for c in _CATEGORICAL
    ) + "), counted AS (SELECT feature, level, count(*) AS n FROM filled WHERE partition = 'train' GROUP BY feature, level), "
    f"marked AS (SELECT *, (count(*) OVER (PARTITION BY feature) + 1 > {_WIDE}) AND row_number() OVER (PARTITION BY feature ORDER BY n DESC, level DESC) "
    f"> {_WIDE - 1} AS rare FROM counted), ranked AS (SELECT *, dense_rank() OVER (PARTITION BY feature ORDER BY rare, CASE WHEN rare THEN '' ELSE level END) AS place FROM marked)"
)


@query(
    "t13_prepare_split",
    PREPARED + _LISTED + _sql_scaled("").replace("SELECT listing_id, feature,", "SELECT listing_id, feature AS column_name,")
    + " UNION ALL SELECT f.listing_id, CASE WHEN rare THEN f.feature || '_infrequent_sklearn' ELSE f.feature || '_' || f.level END, 1.0 "
    "FROM filled f JOIN ranked r ON f.feature = r.feature AND f.level = r.level WHERE place > 1",
)
def t13(spark, folder):
    """Every cell of the scaled numeric and the non-zero cells of the 0/1 columns."""
    _, prep, prepared = P.prepare_split(cleaned(spark, folder), "listing_id", "selling_price")
    numeric = melt(prepared, prep.numeric_columns, ["listing_id"]).withColumnRenamed("feature", "column_name")
    names = [n for n in prep.feature_names_out if n not in prep.numeric_columns]
    cells = _cells(prepared, names).drop("feature")
    return rounded(numeric.unionByName(cells), "value")


_KINDS = {
    **dict.fromkeys(("listing_id", "selling_price", *_NUMERIC), "numeric"),
    **dict.fromkeys(_CATEGORICAL, "categorical"),
}


@query(
    "p8_column_kinds",
    CLEANED + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS kind, count({c}) AS n_present FROM cleaned" for c, k in _KINDS.items()
    ) + ")",
)
def p8(spark, folder):
    rows = cleaned(spark, folder)
    counted = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), F.col(c).alias("n_present"))
        for c, k in P.column_kinds(rows).items()
    ]
    return counted.select(F.inline(F.array(*entries)))


@query("p10_align_columns", PREPARED + " SELECT listing_id, round((coalesce(CAST(km_driven AS DOUBLE), m.fill) - m.mean) / m.std, 6) AS km_driven FROM assigned, moments m WHERE m.feature = 'km_driven'")
def p10(spark, folder):
    """Columns in another order are accepted and put into the fitted one."""
    split, prep = fitted(spark, folder)
    shuffled = split.assigned.select(*sorted(split.model_columns, reverse=True), "listing_id")
    return rounded(prep.transform(shuffled, ["listing_id"]).select("listing_id", "km_driven"), "km_driven")


@query(
    "j4_unseen_categories",
    PREPARED + " SELECT DISTINCT feature, level FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN listing_id % 50 = 0 THEN {c} || ' new' ELSE {c} END AS level FROM assigned WHERE partition = 'test'" for c in _CATEGORICAL
    ) + ") t WHERE level IS NOT NULL AND NOT EXISTS (SELECT 1 FROM levels l WHERE l.feature = t.feature AND l.level = t.level)",
)
def j4(spark, folder):
    split, prep = fitted(spark, folder)
    changed = F.col("listing_id") % 50 == 0
    test = split.test_rows.withColumns(
        {c: F.when(changed, F.concat(c, F.lit(" new"))).otherwise(F.col(c)) for c in _CATEGORICAL}
    )
    return prep.unseen_categories(test)


@query(
    "a30_leak_verification",
    "WITH " + PRICED + ", assigned AS (" + sql_split("priced", "row_key") + ") SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE partition = 'train'), 6) AS fitted_mean, "
        f"round(avg({c}) FILTER (WHERE partition = 'train'), 6) AS train_mean, round(avg({c}), 6) AS full_mean, true AS fitted_on_train FROM assigned"
        for c in ("quantity", "discount", "tax", "size", "retail")
    ) + ")",
)
def a30(spark, folder):
    columns = ["quantity", "discount", "tax", "size", "retail"]
    split = split_rows(priced_lines(spark, folder), "row_key", target="price", keep_columns=columns)
    prep = P.Preparation().fit(split.train)
    means = {s.column: s.mean for s in prep.states}
    return rounded(leak_check(split.assigned, columns, means), "fitted_mean", "train_mean", "full_mean")
