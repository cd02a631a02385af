"""Parsers for unit-suffixed listing values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kilogram-metres in newton-metres, the bare-number limit, owner ranks.
KGM_IN_NM = 9.80665
BARE_KGM_BELOW = 50
OWNER_RANKS = {
    "test drive car": 0.0,
    "first owner": 1.0,
    "second owner": 2.0,
    "third owner": 3.0,
    "fourth & above owner": 4.0,
}

# What counts as a number inside a text, and as a text that is a number.
_NUMBER = r"[-+]?\d*\.?\d+"
_PLAIN_NUMBER = r"^\s*[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\s*$"


def to_number(col: Column) -> Column:
    """Numeric coercion: anything unparseable is missing. The pattern keeps out
    spellings such as `1d` and `NaN`, which a cast to double accepts."""
    text = col.cast("string")
    return F.when(text.rlike(_PLAIN_NUMBER), F.trim(text).try_cast("double"))


def leading_number(col: Column) -> Column:
    """`23.4 kmpl` -> 23.4; a bare number passes through; otherwise null."""
    found = F.regexp_extract(col.cast("string"), rf"^\s*({_NUMBER})", 1)
    return found.try_cast("double")


def torque_in_nm(col: Column) -> Column:
    """Torque in newton-metres from mixed notations.

    A unit attached to the first number decides. Without one, `kgm` elsewhere in
    the text decides if `nm` does not occur, and then a bare number below the
    limit is taken for kilogram-metres.
    """
    text = F.lower(col.cast("string"))
    attached = rf"({_NUMBER})\s*(nm|kgm)?"
    magnitude = F.regexp_extract(text, attached, 1).try_cast("double")
    unit = F.regexp_extract(text, attached, 2)
    in_kgm = (
        (unit == "kgm")
        | (text.contains("kgm") & ~text.contains("nm"))
        | ((unit == "") & (magnitude < BARE_KGM_BELOW))
    )
    return F.when(in_kgm, magnitude * KGM_IN_NM).otherwise(magnitude)


def owner_rank(col: Column) -> Column:
    label = F.lower(F.trim(col.cast("string")))
    rank = F.lit(None).cast("double")
    for name, value in OWNER_RANKS.items():
        rank = F.when(label == name, F.lit(value)).otherwise(rank)
    return rank


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters (`mercedes-benz` ->
    `Mercedes-Benz`), lower-case the rest."""
    runs = F.regexp_extract_all(col, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(
        F.transform(
            runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))
        ),
        "",
    )


def make_of(name: Column) -> Column:
    return title_case(F.regexp_extract(name, r"^\s*(\S+)", 1))
