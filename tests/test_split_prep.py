from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import prep as P
from corpusloom.operators.dedupe import duplicate_groups, overlap
from corpusloom.operators.metrics import leak_check
from corpusloom.operators.split import TrainingPartition, split_rows, stratified_quotas, test_quota as quota_of


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(11)
    rows = [
        (
            i,
            None if 5 <= i < 15 else rng.gauss(100, 25),
            float(rng.randint(0, 9)),
            None if 20 <= i < 25 else rng.choice(["red", "green", "blue"]),
            rng.choice("SML"),
            int(rng.random() < 0.15),
        )
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "id int, length double, n double, colour string, size string, label int")


FEATURES = ["length", "n", "colour", "size"]


def test_quotas():
    assert quota_of(5171, 0.2) == 1035 and quota_of(6907, 0.2) == 1382 and quota_of(10, 0.2) == 2
    quotas = stratified_quotas({"a": 7, "b": 2, "c": 1}, 4)
    assert sum(quotas.values()) == 4 and quotas == {"a": 3, "b": 1, "c": 0}


def test_copies_never_straddle_the_split(mixed):
    doubled = mixed.unionByName(mixed.withColumn("id", F.col("id") + 1000))
    split = split_rows(doubled, "id", target="label")
    assert split.n_rows_before == 600 and split.n_duplicates_dropped == 300
    assert overlap(split.train.X, split.test_X, FEATURES).count() == 0
    assert split.train.rows.count() + split.test_rows.count() == 300
    assert split.test_rows.count() == math.ceil(60)
    loose = split_rows(doubled, "id", target="label", dedupe=False)
    assert loose.n_duplicates_dropped == 0 and overlap(loose.train.X, loose.test_X, FEATURES).count() > 0


def test_split_is_repeatable_and_seeded(mixed):
    ids = lambda **o: {r.id for r in split_rows(mixed, "id", target="label", **o).test_rows.select("id").collect()}
    assert ids() == ids() and ids() != ids(seed=7) and len(ids(test_size=0.5)) == 150


def test_stratified_shares(mixed):
    split = split_rows(mixed, "id", target="label", stratify=True)
    rows = {r.label: r for r in split.describe().collect()}
    for r in rows.values():
        assert r.train_share == pytest.approx(r.test_share, abs=0.01)
    assert sum(r.test_n for r in rows.values()) == 60
    many = split_rows(mixed, "id", target="n").describe()
    assert many.count() == 10
    each = split_rows(mixed.withColumn("t", F.col("id")), "id", target="t").describe()
    assert each.count() == mixed.count()


def test_ten_thousand_strata(spark):
    rows = spark.range(30_000).select(F.col("id"), (F.col("id") % 10_000).alias("g"))
    from corpusloom.operators.split import assign_partitions

    taken = assign_partitions(rows, "id", test_size=0.3334, stratify="g").filter("partition = 'test'")
    per = taken.groupBy("g").count().agg(F.min("count"), F.max("count"), F.sum("count")).first()
    assert tuple(per) == (1, 2, 10_002)


def test_subset_and_meta_columns(mixed):
    texts = mixed.select("id", F.concat(F.lit("m"), F.col("id") % 30).alias("message"), "label", "length", "n")
    split = split_rows(texts, "id", target="label", duplicate_subset=["message"], keep_columns=["length", "n"])
    assert split.n_rows_after == 30 and split.train.columns == ("length", "n") and split.meta_columns == ("message",)
    test = split.test_rows.select("id", "length").join(split.meta("test"), "id")
    source = texts.join(test.select("id", F.col("length").alias("l2"), F.col("message").alias("m2")), "id")
    assert source.filter("message = m2 AND length <=> l2").count() == test.count() == 6
    assert min(r.id for r in split.assigned.collect()) == 0 and max(r.id for r in split.assigned.collect()) == 29
    assert split_rows(texts, "id", target="label", keep_columns=["message", "length", "n"]).meta("test") is None


def test_split_errors(mixed):
    with pytest.raises(KeyError):
        split_rows(mixed, "id", target="label", keep_columns=["absent"])
    with pytest.raises(KeyError):
        split_rows(mixed, "id", target="absent")
    with pytest.raises(ValueError):
        split_rows(mixed, "id", stratify=True)
    with pytest.raises(ValueError):
        split_rows(mixed, "id", stratify="absent")


@pytest.fixture(scope="module")
def split(mixed):
    return split_rows(mixed, "id", target="label", stratify=True)


def test_only_a_training_half_can_be_fitted(mixed, split):
    for wrong in (mixed, split.test_X, split.assigned):
        with pytest.raises(TypeError):
            P.Preparation().fit(wrong)
    with pytest.raises(TypeError):
        TrainingPartition(mixed, ("length",), "id")
    with pytest.raises(P.NotFittedError):
        P.Preparation().transform(mixed)
    prep = P.Preparation().fit(split.train)
    with pytest.raises(P.AlreadyFittedError):
        prep.fit(split.train)
    with pytest.raises(TypeError):
        prep.transform(split.train)
    assert not prep.clone_unfitted().is_fitted
    with pytest.raises(ValueError):
        P.Preparation(numeric_strategy="guess").fit(split.train)


def test_fitted_statistics_come_from_training_rows(mixed, split):
    prep = P.Preparation().fit(split.train)
    train = split.train.X.toPandas()
    state = {s.column: s for s in prep.states}
    filled = train["length"].fillna(train["length"].median())
    assert state["length"].fill == pytest.approx(train["length"].median())
    assert (state["length"].mean, state["length"].scale) == pytest.approx((filled.mean(), filled.std(ddof=0)))
    assert state["colour"].fill == train["colour"].mode().min()
    out = prep.transform(split.train.X).toPandas()
    assert out[["length", "n"]].mean().abs().max() < 1e-9
    assert np.allclose(out[["length", "n"]].std(ddof=0), 1)
    test = prep.transform(split.test_X).toPandas()
    assert test[["length", "n"]].mean().abs().max() > 1e-3
    assert not test.isna().any().any()
    means = {"n": state["n"].mean}
    check = leak_check(split.assigned, ["n"], means).first()
    assert check.fitted_on_train and check.full_mean != check.train_mean


def test_encoding(split, spark):
    prep = P.Preparation().fit(split.train)
    assert prep.feature_names_out == ["length", "n", "colour_blue", "colour_green", "colour_red", "size_L", "size_M", "size_S"]
    odd = spark.createDataFrame(
        [(1.0, 1.0, "ultraviolet", "S"), (None, None, None, "XXL")], "length double, n double, colour string, size string"
    )
    rows = prep.transform(odd).collect()
    assert [rows[0][c] for c in ("colour_blue", "colour_green", "colour_red", "size_S")] == [0.0, 0.0, 0.0, 1.0]
    assert sum(rows[1][f"size_{s}"] for s in "SML") == 0.0
    assert sum(rows[1][f"colour_{c}"] for c in ("blue", "green", "red")) == 1.0
    unseen = [(r.feature, r.level) for r in prep.unseen_categories(odd).collect()]
    assert unseen == [("colour", "ultraviolet"), ("size", "XXL")]
    dropped = P.Preparation(drop_first=True).fit(split.train)
    assert dropped.feature_names_out == ["length", "n", "colour_green", "colour_red", "size_M", "size_S"]
    empty = prep.transform(odd.limit(0))
    assert empty.columns == prep.feature_names_out and empty.count() == 0


def test_alignment(split, spark):
    prep = P.Preparation().fit(split.train)
    with pytest.raises(KeyError):
        prep.transform(split.test_X.drop("size"))
    with pytest.warns(UserWarning, match="extra"):
        out = prep.transform(split.test_X.withColumn("extra", F.lit(1)))
    assert out.columns == prep.feature_names_out
    texts = split.test_X.withColumn("length", F.when(F.col("n") > 4, "n/a").otherwise(F.col("length").cast("string")))
    fill = next(s for s in prep.states if s.column == "length")
    got = prep.transform(texts.select("size", "colour", "n", "length")).filter("n > 0.6").first()
    assert got["length"] == pytest.approx((fill.fill - fill.mean) / fill.scale)


@pytest.mark.parametrize("levels_in_literals", [10_000, 5])
def test_rare_levels(spark, monkeypatch, levels_in_literals):
    monkeypatch.setattr(P, "MAX_LEVELS", levels_in_literals)
    rows = [(i, float(i), "a" if i % 2 else f"v{i % 40:02d}", "x") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, n double, c string, d string")
    split = split_rows(df, "id")
    prep = P.Preparation(max_categories=4).fit(split.train)
    train = split.train.X.toPandas()["c"].value_counts()
    names = [n for n in prep.feature_names_out if n.startswith("c_")]
    assert len(names) == 4 and names[0] == "c_a" and names[-1] == f"c_{P.RARE}"
    out = prep.transform(split.train.rows.select("id", *split.train.columns), ["id"]).toPandas()
    assert out[names].sum(axis=1).eq(1).all()
    assert out[names[-1]].sum() == sum(n for v, n in train.items() if f"c_{v}" not in names)
    assert sorted(n for n in prep.feature_names_out if n.startswith("d_")) == ["d_x"]
    unseen = spark.createDataFrame([(1.0, "never", "x")], "n double, c string, d string")
    assert sum(prep.transform(unseen).select(*names).first()) == 0.0
    by_share = P.Preparation(min_frequency=0.2).fit(split.train)
    assert [n for n in by_share.feature_names_out if n.startswith("c_")] == ["c_a", f"c_{P.RARE}"]


def test_level_cap_counts_the_folded_column(spark):
    counts = spark.createDataFrame([("c", v, n) for v, n in (("a", 5), ("b", 3), ("c", 3), ("d", 1))], "feature string, level string, n long")
    rare = lambda cap, floor=None: {r.level for r in P.fold_levels(counts, cap, floor, 12).collect() if r.rare}
    assert rare(5) == set() and rare(4) == {"d"} and rare(3) == {"b", "d"} and rare(1) == {"a", "b", "c", "d"}
    assert rare(None, 3) == {"d"} and rare(None, 0.3) == {"b", "c", "d"}


def test_all_missing_columns_are_kept(spark):
    df = spark.createDataFrame([(i, None, None, float(i)) for i in range(20)], "id int, a double, b string, n double")
    split = split_rows(df, "id")
    out = P.Preparation().fit_on_split(split)
    assert out.columns == ["id", "partition", "a", "n", "b_0"]
    assert {(r.a, r.b_0) for r in out.collect()} == {(0.0, 1.0)}


@pytest.mark.parametrize("strategy, fill", [("mean", 4.0), ("most_frequent", 1.0), ("constant", 0.0), ("median", 2.5)])
def test_numeric_strategies(spark, strategy, fill):
    values = [1.0, 1.0, 4.0, 10.0, None]
    df = spark.createDataFrame([(i, v, str(i)) for i, v in enumerate(values)], "id int, v double, s string")
    split = split_rows(df, "id", test_size=0.0, keep_columns=["v"])
    prep = P.Preparation(numeric_strategy=strategy, scale=False).fit(split.train)
    assert prep.states[0].fill == fill
    assert sorted(r.v for r in prep.transform(split.train.X).collect()) == sorted([*values[:4], fill])


def test_scaled_one_hot(split):
    prep = P.Preparation(scale_encoded=True).fit(split.train)
    out = prep.transform(split.train.X).toPandas()
    encoded = [c for c in out if "_" in c]
    assert out[encoded].mean().abs().max() < 1e-9 and np.allclose(out[encoded].std(ddof=0), 1)


def test_prepare_split(mixed):
    with pytest.raises(KeyError):
        P.prepare_split(mixed, "id", "absent")
    holes = mixed.withColumn("label", F.when(F.col("id") >= 10, F.col("label")))
    split, prep, prepared = P.prepare_split(holes, "id", "label")
    assert prepared.count() == 290 and prepared.columns[:3] == ["id", "label", "partition"]
    assert "colour_blue" not in prep.feature_names_out
    summary = {r.column: r for r in prep.summary(mixed.sparkSession).collect()}
    assert summary["colour"].n_levels == 3 and summary["n"].kind == "numeric"


def test_overlap_and_groups_by_digest(spark):
    left = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", 0.0), (3, None, 1.0), (4, "", 2.0)], "`i.d` int, t string, x double")
    right = spark.createDataFrame([(1, "a", None), (2, "b", -0.0), (3, None, 1.0), (4, None, 2.0)], "`i.d` long, t string, x double")
    got = sorted(map(tuple, overlap(left, right, ["i.d", "t", "x"]).collect()), key=str)
    assert got == [(1, "a", None), (2, "b", 0.0), (3, None, 1.0)]
    assert overlap(left.limit(0), right, ["i.d", "t", "x"]).count() == 0
    assert [tuple(r) for r in duplicate_groups(left, ["i.d", "t", "x"]).collect()] == [(1, "a", None, 2)]
    assert duplicate_groups(left.limit(0), ["t"]).columns == ["t", "n"]


def test_strata_ranked_in_their_tasks_are_those_of_the_cuts(spark, monkeypatch):
    """t2_stratified_by_order: small strata, a null one and equal keys give the same halves either way."""
    from corpusloom.operators import split as S

    rows = spark.range(600).selectExpr("concat('k', id - id % 3 * (id % 2)) AS key", "IF(id % 13 = 0, NULL, id % 97) AS g", "id AS other")
    ranked = S.assign_partitions(rows, "key", stratify="g")
    assert "Window" in ranked._jdf.queryExecution().toString()  # one shuffle of the rows, no table of cuts
    monkeypatch.setattr(S, "RANKED_ROWS", 0)
    by_cuts = S.assign_partitions(rows, "key", stratify="g")
    assert ranked.columns == by_cuts.columns
    assert sorted(map(tuple, ranked.collect()), key=str) == sorted(map(tuple, by_cuts.collect()), key=str)
