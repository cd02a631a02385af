"""Order-dependent building blocks that never sort a whole group in one task.

* `running_sums`: exact prefix sums along a sorted column. Large groups are cut
  into value ranges; each range is summed by its own task and shifted by the
  total of the ranges before it.
* `quantiles`: exact interpolated quantiles on top of it, or by `select_ranks`, which
  narrows the span of values that holds a rank.
* `global_rank`: row numbers along an order, from range partitions.
* `hash_cutoffs`: the exact hash value below which `quota` rows of a group lie,
  found from counts of hash prefixes, so that "the first n in hash order" is a
  comparison with one value per group.
* `dense_index`: a gap-free row number in hash order.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

MAX_GROUPS = 10_000
RANGE_ROWS = 1_000_000
MAX_RANGES = 2_000
HASH_STEP = 4
SKETCH_ACCURACY = 10_000


def hash_key(key: str | Sequence[str], seed: int | str) -> Column:
    """md5 over seed and key: the same order on every run and every cluster."""
    parts = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in parts]))


def bounded_rows(df: DataFrame, limit: int = MAX_GROUPS, what: str = "groups") -> list:
    """Rows for the driver, refused when there are more than `limit`."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"More than {limit} {what}: too many to hold on the driver.")
    return rows


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    *,
    descending: bool = False,
    range_rows: int | None = None,
    written: bool = False,
) -> DataFrame:
    """Add `cum_<s>` (inclusive) and `tot_<s>` for each column of `sums`.

    `df` must hold one row per (`by`, `order`), i.e. be pre-aggregated by value; it
    is read several times and therefore written first, unless the caller has.
    """
    by = list(by)
    range_rows = range_rows or RANGE_ROWS
    table = df if written else materialise(df, "ordered")
    sizes = table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    largest = sizes.agg(F.max("rows")).first()[0] or 1
    # Groups above one range get cut points from a mergeable sketch; the cut points
    # only balance the work, the sums stay exact wherever they fall.
    ranges = min(MAX_RANGES, -(-largest // range_rows))
    sign = -1 if descending else 1
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = (
            table.groupBy(*by)
            .agg(F.percentile_approx(order, shares, 10 * MAX_RANGES).alias("_cuts"), F.count(F.lit(1)).alias("_size"))
            .filter(F.col("_size") > range_rows)
            .drop("_size")
        )
        keyed = join_groups(table, materialise(cuts, "cuts"), by, "left")
        below = F.size(F.filter("_cuts", lambda c: c < F.col(order)))
        table = keyed.withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(below * sign)).drop("_cuts")
    else:
        table = table.withColumn("_range", F.lit(0))

    per_range = table.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_r_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    shifts = per_range.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_r_{s}").over(before), F.lit(0)).alias(f"_b_{s}") for s in sums],
        *[F.sum(f"_r_{s}").over(whole).alias(f"tot_{s}") for s in sums],
    )
    position = F.col(order).desc() if descending else F.col(order).asc()
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = table.select("*", *[F.sum(s).over(inside).alias(f"_l_{s}") for s in sums])
    return join_groups(local, shifts, [*by, "_range"]).select(
        *df.columns,
        *[(F.col(f"_l_{s}") + F.col(f"_b_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"tot_{s}") for s in sums],
    )


def join_groups(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns in which nulls are equal; Spark broadcasts the smaller side only if it is small."""
    if not on:
        on = ["_one"]
        df, small = df.withColumn("_one", F.lit(1)), small.withColumn("_one", F.lit(1))
    renamed = small.withColumnsRenamed({c: f"_k_{c}" for c in on})
    match = None
    for c in on:
        term = same(df[c], renamed[f"_k_{c}"])
        match = term if match is None else match & term
    return df.join(renamed, match, how).drop(*[f"_k_{c}" for c in on], "_one")


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per distinct value; combined on the map side before the shuffle."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    *,
    range_rows: int | None = None,
    sketch: bool = False,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per group, one column per share.

    Rows are counted per distinct value first, which suits discrete columns and
    values that are costly to compute. `sketch` is for stored columns with very many
    distinct values: the ranks are found by `select_ranks`, which tells few values apart.
    """
    by = list(by)
    if sketch:
        return _selected_quantiles(df, by, value, shares, range_rows or RANGE_ROWS, accuracy)
    counts = materialise(value_counts(df, by, value), "counts")
    return quantiles_of_counts(counts, by, value, shares, range_rows=range_rows)


def _selected_quantiles(df: DataFrame, by: list[str], value: str, shares: Mapping[str, float], few: int, accuracy: int) -> DataFrame:
    v = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(v)).select(*by, v.alias("_v"))
    sizes = materialise(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.approx_count_distinct("_v").alias("_apart")), "sizes")
    wanted = F.array(*[F.struct(F.lit(n).alias("_name"), F.lit(float(s)).alias("_share")) for n, s in shares.items()])
    places = sizes.select(*by, "_n", "_apart", F.inline(wanted)).withColumn("_place", F.greatest((F.col("_n") - 1) * F.col("_share"), F.lit(0.0)))
    ends = places.select("*", F.floor("_place").cast("long").alias("_low"), F.ceil("_place").cast("long").alias("_high"))
    ranks = ends.filter("_n > 0").select(*by, "_n", "_apart", F.explode(F.array("_low", "_high")).alias("_rank")).distinct()
    found = materialise(select_ranks(rows, by, ranks, few, accuracy), "ranks")

    def at(side: str) -> DataFrame:
        return found.select(*by, F.col("_rank").alias(f"_{side}"), F.col("_value").alias(f"_{side}_value"))

    both = join_groups(join_groups(ends, at("low"), [*by, "_low"], "left"), at("high"), [*by, "_high"], "left")
    step = (F.col("_high_value") - F.col("_low_value")) * (F.col("_place") - F.col("_low"))
    between = F.when(F.col("_low_value") == F.col("_high_value"), F.col("_low_value")).otherwise(F.col("_low_value") + step)
    return both.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, between)).alias(n) for n in shares])


def select_ranks(rows: DataFrame, by: Sequence[str], ranks: DataFrame, few: int = RANGE_ROWS, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """(by, _rank, _value): the exact `_v` of the given 0-based ranks in each group; `ranks` is (by, _n, _rank), `_n` the rows of the group.

    Count, narrow, repeat. A span of values holds the wanted rank; a sketch cuts the span in 64 parts, each part and each cut is counted exactly, and
    the one with the rank is the next span. Spans of at most `few` rows are counted value by value, and so are groups with few values in many rows
    (`_apart`, if `ranks` has it, is about how many values a group has). The sketch only decides how
    fast spans shrink, so any error of it costs a turn at worst. Groups and ranks are tables of any size.
    """
    by = list(by)
    span = [*by, "_lo", "_hi"]
    infinite = F.lit(math.inf)
    apart = F.least("_n", "_apart") if "_apart" in ranks.columns else F.col("_n")
    targets = materialise(ranks.select(*by, "_rank", (-infinite).alias("_lo"), infinite.alias("_hi"), F.lit(0).cast("long").alias("_below"), apart.alias("_apart")), "targets")
    found = None
    while True:
        known = targets.filter("_lo = _hi").select(*by, "_rank", F.col("_lo").alias("_value"))
        small = targets.filter((F.col("_lo") < F.col("_hi")) & (F.col("_apart") <= few))
        large = targets.filter((F.col("_lo") < F.col("_hi")) & (F.col("_apart") > few))
        counts = _in_spans(rows, small, by).groupBy(*span, "_v").agg(F.count(F.lit(1)).alias("_k"))
        upto = Window.partitionBy(*span).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        told = join_groups(small, counts.withColumn("_cum", F.sum("_k").over(upto)), span)
        hit = (F.col("_below") + F.col("_cum") > F.col("_rank")) & (F.col("_below") + F.col("_cum") - F.col("_k") <= F.col("_rank"))
        part = known.unionByName(told.filter(hit).select(*by, "_rank", F.col("_v").alias("_value")))
        found = part if found is None else found.unionByName(part)
        if large.isEmpty():
            return found
        inside = _in_spans(rows, large, by)
        cuts = inside.groupBy(*span).agg(F.percentile_approx("_v", [i / 64 for i in range(65)], accuracy).alias("_cuts"))
        cut = join_groups(inside, materialise(cuts, "cuts"), span)
        # Even numbers are the open parts between cuts, odd ones the cuts themselves.
        place = 2 * F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) + F.array_contains("_cuts", F.col("_v")).cast("int")
        parts = cut.groupBy(*span, place.alias("_place")).agg(F.count(F.lit(1)).alias("_k"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        order = Window.partitionBy(*span).orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # 131 rows at most
        summed = join_groups(large, parts.withColumn("_cum", F.sum("_k").over(order)), span).withColumn("_from", F.col("_below") + F.col("_cum") - F.col("_k"))
        next_ones = summed.filter((F.col("_from") <= F.col("_rank")) & (F.col("_rank") < F.col("_from") + F.col("_k")))
        targets = materialise(
            next_ones.select(*by, "_rank", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), F.col("_from").alias("_below"), F.col("_k").alias("_apart")), "targets"
        )
        rows = materialise(_in_spans(rows, targets.filter("_lo < _hi"), by).select(*by, "_v"), "narrowed")


def _in_spans(rows: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Rows that lie in a span of their group, with the span; the spans of a group are disjoint."""
    spans = targets.select(*by, "_lo", "_hi").distinct()
    return join_groups(rows, spans, by).filter((F.col("_lo") <= F.col("_v")) & (F.col("_v") <= F.col("_hi")))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "_rank", range_rows: int | None = None) -> DataFrame:
    """Add 0, 1, 2, ... along `order`, whose values are unique: ranks inside range partitions, shifted by the partitions before."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = max(1, -(-df.count() // (range_rows or RANGE_ROWS)))
    table = materialise(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_k"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    shifts = sizes.select("_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return join_groups(table.withColumn("_in", inside), shifts, ["_part"]).select(*df.columns, (F.col("_in") - 1 + F.col("_shift")).cast("long").alias(name))


def quantiles_of_counts(
    counts: DataFrame,
    by: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    *,
    range_rows: int | None = None,
) -> DataFrame:
    """The same from written (by, value, n) counts."""
    by = list(by)
    ordered = running_sums(counts, by, value, ["n"], range_rows=range_rows, written=True)

    def at(index: Column) -> Column:
        covered = (F.col("cum_n") > index) & (F.col("cum_n") - F.col("n") <= index)
        return F.max(F.when(covered, F.col(value).cast("double")))

    picks = []
    for name, share in shares.items():
        place = (F.col("tot_n") - 1) * F.lit(float(share))
        picks += [
            at(F.floor(place)).alias(f"_lo_{name}"),
            at(F.ceil(place)).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_w_{name}"),
        ]
    picked = ordered.groupBy(*by).agg(*picks)
    return picked.select(
        *by,
        *[
            (
                F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")
            ).alias(n)
            for n in shares
        ],
    )


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def group_counts(df: DataFrame, group: str | None) -> dict:
    """Rows per class on the driver; refused beyond MAX_GROUPS, which no label has."""
    if group is None:
        return {None: df.count()}
    return {r[group]: r["n"] for r in bounded_rows(group_sizes(df, group))}


def hash_cutoffs(hashed: DataFrame, by: Sequence[str], quotas: DataFrame) -> DataFrame:
    """(by, _cut): the largest hash `_h` to take in each group for exactly `quota` rows.

    Counts of hash prefixes find the bucket that holds each group's cut, and the rows of that
    one bucket in 65,536 are ranked. All of it is aggregates and joins: groups may be many or hot.
    """
    prefixed = hashed.select(*by, "_h").withColumn("_prefix", F.substring("_h", 1, HASH_STEP))
    counts = prefixed.groupBy(*by, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = join_groups(counts.withColumn("_cum", F.sum("_n").over(upto)), quotas, by)
    passed = F.col("_cum") - F.col("_n")
    hit = summed.filter((F.col("_cum") >= F.col("quota")) & (passed < F.col("quota"))).select(*by, "_prefix", (F.col("quota") - passed).alias("_need"))
    ranked = join_groups(prefixed, materialise(hit, "hits"), [*by, "_prefix"])
    place = F.row_number().over(Window.partitionBy(*by, "_prefix").orderBy("_h"))
    found = ranked.withColumn("_place", place).filter("_place = _need").select(*by, F.col("_h").alias("_found"))
    # "g" lies above every hex digit: a group without a hit has no more rows than its quota.
    cut = F.when(F.col("quota") <= 0, "").otherwise(F.coalesce("_found", F.lit("g")))
    return materialise(join_groups(quotas, found, by, "left").select(*by, cut.alias("_cut")), "cutoffs")


def flag_first_by_hash(
    df: DataFrame, key: str | Sequence[str], seed: int, quotas: Mapping | DataFrame | int, group: str | None = None, name: str = "_taken"
) -> DataFrame:
    """Add `name`: whether a row is among the first `quota` rows of its group in hash order.

    `quotas` is a table (group, quota), a mapping, or one number for each group.
    """
    by, spark = ([group] if group else []), df.sparkSession
    if isinstance(quotas, int) and group:
        quotas = group_sizes(df, group).select(group, F.lit(quotas).cast("long").alias("quota"))
    elif isinstance(quotas, int):
        quotas = spark.range(1).select(F.lit(quotas).cast("long").alias("quota"))
    elif isinstance(quotas, Mapping):
        kind = df.schema[group].dataType.simpleString()
        quotas = spark.createDataFrame([(g, int(q)) for g, q in quotas.items()], f"`{group}` {kind}, quota long")
    hashed = df.withColumn("_h", hash_key(key, seed))
    flagged = join_groups(hashed, hash_cutoffs(hashed, by, quotas), by, "left")
    return flagged.withColumn(name, F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))).drop("_h", "_cut")


def first_by_hash(
    df: DataFrame, key: str | Sequence[str], seed: int, quotas: Mapping | DataFrame | int, group: str | None = None
) -> DataFrame:
    """The first `quota` rows of each group in hash order."""
    return flag_first_by_hash(df, key, seed, quotas, group).filter("_taken").drop("_taken")


def dense_index(df: DataFrame, key: str | Sequence[str], seed: int | str, name: str = "idx") -> DataFrame:
    """Number rows 0..n-1 in hash order: ranks inside 65,536 even buckets, shifted
    by the bucket totals."""
    table = df.withColumn("_h", hash_key(key, seed)).withColumn("_b", F.substring("_h", 1, HASH_STEP))
    per_bucket = table.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_bucket.select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    ranked = table.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_b").orderBy("_h"))
    )
    return join_groups(ranked, shifts, ["_b"]).select(
        *df.columns, (F.col("_rank") - 1 + F.col("_shift")).cast("long").alias(name)
    )
