"""Cleaning of raw listings: parsed units, ordinal owner, age and make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.listings import leading_number, make_of, owner_rank, torque_in_nm

TARGET = "selling_price"


def clean_listings(df: DataFrame, *, reference_year: int = 2021) -> DataFrame:
    """One projection. Columns that are absent are skipped; a missing name gives a
    missing make."""
    parsed = {c: leading_number(F.col(c)) for c in ("mileage", "engine", "max_power")}
    parsed["torque"] = torque_in_nm(F.col("torque"))
    derived = {
        "owner": ("owner_rank", owner_rank(F.col("owner"))),
        "year": ("age", F.lit(reference_year) - F.col("year")),
        "name": ("make", make_of(F.col("name"))),
    }
    kept = [
        parsed[c].alias(c) if c in parsed else F.col(c) for c in df.columns if c not in derived
    ]
    added = [column.alias(name) for raw, (name, column) in derived.items() if raw in df.columns]
    return df.select(*kept, *added)
