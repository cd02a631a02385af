"""Small tables with the odd cases every operator must stand: see `odd_docs`."""

from __future__ import annotations

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def passage(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ta", "mo", "ri", "sel", "une", "ké"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows() -> list[tuple]:
    shared = passage(60, 1)
    near = passage(120, 2).split()
    texts = [
        None, "", " \n\t ", "a", "one two three", shared, shared, shared.replace(" ", "\n"), passage(30, 3) + " " + shared + " " + passage(30, 4),
        " ".join(near), " ".join([*near[:60], "other", *near[61:]]), " ".join([*near[:30], "x", *near[31:90], "y", *near[91:]]), " ".join(near).upper(),
        "la " * 300, "x" * 5_000, "\n".join(["same line here"] * 30), passage(4_000, 5), "emoji 🎉 naïve ﬁ 日本語 <|endoftext|> '" + "s " * 3,
        passage(13, 6), passage(13, 6) + " tail",
    ]
    rows = [(i, t, f"src{i % 3}", len(t or ""), f"key{i}", None if i % 4 else i) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((9, "another text under an id that is taken " + passage(20, 7), "src9", 5, "k", 0))
    rows.append((None, shared, "src0", 1, "k", 0))
    rows.append((None, "no id and a text of its own " + passage(20, 8), None, None, None, None))
    return rows


#: Extra columns carry names that operators use inside.
ODD_SCHEMA = "doc_id long, text string, source string, n_chars long, key string, kept long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def odd():
    return odd_rows()
