"""Balancing the classes of a training half: over, under and synthetic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

from .neighbours import exact_nearest, hashed_nearest
from .ordered import dense_index, first_by_hash, group_counts, group_sizes, join_groups


def _sizes(df: DataFrame, label: str) -> tuple[dict, object, int, int]:
    sizes = group_counts(df, label)
    if len(sizes) < 2:
        raise ValueError("Resampling needs at least two classes.")
    minority = min(sizes, key=lambda g: (sizes[g], str(g)))
    return sizes, minority, sizes[minority], max(sizes.values())


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes x rows of the class), as a column for weighted fits."""
    sizes = group_sizes(df, label)
    whole = Window.partitionBy()  # one row per class
    weights = sizes.select(label, (F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight"))
    return join_groups(df, weights, [label])


def under_sample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest, in hash order: a filter."""
    sizes, _, smallest, _ = _sizes(df, label)
    return first_by_hash(df, key, seed, dict.fromkeys(sizes, smallest), label)


def hash_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash: 13 hex digits fit a double exactly."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def draws(df: DataFrame, n: int, pool: int, seed: int) -> DataFrame:
    """`n` numbered draws with replacement from 0..pool-1, by hash of seed and number."""
    spark = df.sparkSession
    i = F.col("id")
    pick = F.floor(hash_uniform(F.lit(seed), i, F.lit("pick")) * F.lit(pool)).cast("long")
    return spark.range(n).select(i.alias("draw"), pick.alias("idx"))


def over_sample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """All rows plus copies of smaller-class rows, drawn with replacement, to parity."""
    sizes, _, _, largest = _sizes(df, label)
    out = df
    for g, rows in sorted(sizes.items(), key=lambda e: str(e[0])):
        if rows == largest:
            continue
        pool = dense_index(df.filter(F.col(label) == g), key, seed)
        copies = draws(df, largest - rows, rows, seed).join(pool, "idx").select(*df.columns)
        out = out.unionByName(copies)
    return out


def nearest_neighbours(df: DataFrame, key: str, features: Sequence[str], k: int, seed: int = 42, approximate: bool = False) -> DataFrame:
    """The k nearest other rows of every row: (key, neighbour, distance, place); exact, unless `approximate`.

    Equal vectors are searched once: each distinct vector stands for its rows and
    remembers its k + 1 smallest keys, which is all a row can need from it. Ties in
    distance go to the smaller key.
    """
    points = df.select(F.col(key).alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("v"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = points.withColumn("p", place).filter(F.col("p") <= k + 1)
    vectors = materialise(
        few.groupBy("v").agg(F.min("id").alias("gid"), F.sort_array(F.collect_list("id")).alias("ids")), "vectors"
    )
    n_vectors = vectors.count()
    own = vectors.select("gid", F.col("gid").alias("neighbour"), F.lit(0.0).alias("distance"))
    if n_vectors > 1:
        distinct = vectors.select(F.col("gid").alias("id"), "v")
        search = hashed_nearest if approximate else exact_nearest
        found = search(distinct, min(k, n_vectors - 1), seed)
        own = own.unionByName(found.withColumnRenamed("id", "gid"))
    rank = F.row_number().over(Window.partitionBy("gid").orderBy("distance", "cid"))
    candidates = (
        own.join(vectors.select(F.col("gid").alias("neighbour"), "ids"), "neighbour")
        .select("gid", "distance", F.explode("ids").alias("cid"))
        .withColumn("r", rank)
        .filter(F.col("r") <= k + 1)
        .groupBy("gid")
        .agg(F.sort_array(F.collect_list(F.struct("distance", "cid"))).alias("near"))
    )
    # One row per distinct vector on the right; a vector shared by very many rows is
    # split on the left by the adaptive skew join.
    per_vector = vectors.select("gid", "v").join(candidates, "gid").select("v", "near")
    others = F.slice(F.filter("near", lambda e: e["cid"] != F.col("id")), 1, k)
    return points.join(per_vector, "v").select("id", F.posexplode(others)).select(
        F.col("id").alias(key),
        F.col("col.cid").alias("neighbour"),
        F.col("col.distance").alias("distance"),
        (F.col("pos") + 1).alias("place"),
    )


def smote(
    df: DataFrame, key: str, label: str, features: Sequence[str], *, k: int = 5, seed: int = 42, approximate: bool = False
) -> DataFrame:
    """Smaller-class rows plus synthetic ones to parity: base + u (neighbour - base).
    `approximate` searches the neighbours by hashing, for classes too large to be searched exactly.

    Base row, neighbour place and u come from hashes of (seed, draw number). Only
    label and features are returned, since a synthetic row has no key.
    """
    sizes, _, _, largest = _sizes(df, label)
    lone = [g for g, n in sizes.items() if n < 2 < largest]
    if k < 1 or lone:
        raise ValueError(f"Synthetic rows need a neighbour: k is {k}, classes with one row are {lone}.")
    out = df.select(label, *features)
    for g, rows in sorted(sizes.items(), key=lambda e: str(e[0])):
        if rows < largest:
            out = out.unionByName(_synthetic(df, key, label, features, g, rows, largest, min(k, rows - 1), seed, approximate))
    return out


def _synthetic(df: DataFrame, key: str, label: str, features: Sequence[str], group, rows: int, largest: int, k: int, seed: int, approximate: bool = False) -> DataFrame:
    small = materialise(df.filter(F.col(label).eqNullSafe(F.lit(group))).select(key, *features), "minority")
    pairs = nearest_neighbours(small, key, features, k, seed, approximate).select(
        F.col(key).alias("base"), "neighbour", "place"
    )
    pool = dense_index(small, key, seed)
    i = F.col("draw")
    wanted = draws(df, largest - rows, rows, seed).select(
        "idx",
        (F.floor(hash_uniform(F.lit(seed), i, F.lit("place")) * F.lit(k)) + 1).cast("int").alias("place"),
        hash_uniform(F.lit(seed), i, F.lit("step")).alias("u"),
    )
    based = wanted.join(pool, "idx").withColumnRenamed(key, "base")
    matched = based.join(pairs, ["base", "place"])
    other = small.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"_n_{c}") for c in features])
    return matched.join(other, "neighbour").select(
        F.lit(group).cast(df.schema[label].dataType).alias(label),
        *[(F.col(c) + F.col("u") * (F.col(f"_n_{c}") - F.col(c))).alias(c) for c in features],
    )
