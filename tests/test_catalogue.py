"""Every registered query that SQL can state gives the same rows in DuckDB."""

from __future__ import annotations

import math

import pytest
from conftest import DATA

from corpusloom.catalogue import ORACLES, QUERIES


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v + 0.0 if isinstance(v, float) else v)
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_names_are_consistent():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(DATA))
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(ORACLES[name])
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want
