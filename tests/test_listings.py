from __future__ import annotations

import pytest

from corpusloom.functions import listings as L
from corpusloom.operators.listings import clean_listings


def test_leading_number(column):
    values = ["23.4 kmpl", "1248 CC", " 74 bhp", "-5x", ".5 l", "", None, "bhp", "n/a"]
    assert column(L.leading_number, values) == [23.4, 1248.0, 74.0, -5.0, 0.5, None, None, None, None]
    assert column(L.leading_number, [42.0, None], "double") == [42.0, None]


def test_torque(column):
    k = L.KGM_IN_NM
    cases = {
        "200Nm@ 1750rpm": 200.0,
        "22.4 kgm at 1750-2750rpm": 22.4 * k,
        "12.5@ 2,500(kgm@ rpm)": 12.5 * k,
        "11.4@ 4,000(rpm)": 11.4 * k,
        "380@ 2000": 380.0,
        "24 KGM (235 Nm)": 24 * k,
        "145 NM": 145.0,
        "30Nm": 30.0,
        "": None,
        None: None,
        "none": None,
    }
    got = column(L.torque_in_nm, list(cases))
    assert got == [pytest.approx(v) if v is not None else None for v in cases.values()]


def test_owner_rank(column):
    got = column(L.owner_rank, ["First Owner", " SECOND owner ", "Third Owner", "Fourth & Above Owner", "Test Drive Car", "x", None])
    assert got == [1.0, 2.0, 3.0, 4.0, 0.0, None, None]


def test_numeric_coercion(column):
    values = ["12", " 1.5 ", "-2e3", "+.5", "3.", "1d", "NaN", "inf", "n/a", "", None, "0x10", "1_000"]
    assert column(L.to_number, values) == [12.0, 1.5, -2000.0, 0.5, 3.0] + [None] * 8


def test_make(column):
    got = column(L.make_of, ["maruti swift", "MERCEDES-BENZ e", "  land rover", "bmw", None])
    assert got == ["Maruti", "Mercedes-Benz", "Land", "Bmw", None]


def test_cleaning(spark):
    df = spark.createDataFrame(
        [("Honda City", 2015, "18 kmpl", "110Nm@ 4800rpm", "First Owner", 7.5), (None, 2020, None, None, None, None)],
        "name string, year int, mileage string, torque string, owner string, selling_price double",
    )
    rows = clean_listings(df).collect()
    assert rows[0].asDict() == {
        "mileage": 18.0, "torque": 110.0, "selling_price": 7.5, "owner_rank": 1.0, "age": 6, "make": "Honda",
    }
    assert rows[1].make is None and rows[1].age == 1
    assert clean_listings(df, reference_year=2022).first().age == 7
    assert clean_listings(df.select("year")).columns == ["age"]
