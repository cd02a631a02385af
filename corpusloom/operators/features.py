"""The feature frame: every message-shape feature in one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import FEATURES

FeatureBuilder = Callable[[Column], Column]


def feature_frame(
    df: DataFrame,
    text: str,
    keep: Sequence[str] = (),
    features: Mapping[str, FeatureBuilder] = FEATURES,
) -> DataFrame:
    """`keep` columns followed by the features as double, in registry order.

    A row-wise projection without shuffle; it also runs on a streaming DataFrame.
    """
    if text not in df.columns:
        raise KeyError(f"No column {text!r}; columns are {df.columns}.")
    source = F.col(text)
    if df.schema[text].dataType.typeName() in ("double", "float"):
        source = F.when(~F.isnan(source), source)
    return df.select(*keep, *[build(source).cast("double").alias(n) for n, build in features.items()])


def from_python(function: Callable[[object], float]) -> FeatureBuilder:
    """Wrap a user's per-message Python function; batches travel through Arrow."""

    @F.pandas_udf("double")
    def apply(values: pd.Series) -> pd.Series:
        return values.map(function).astype("float64")

    return lambda col: apply(col)
