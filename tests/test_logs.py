from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import logs as L
from corpusloom.operators import logs as ops
from corpusloom.sources.sinks import write_json_lines
from corpusloom.sources.text_files import read_lines

LEVELS = [
    ("2024-05-01 10:00:00 [ERROR] db - down", "ERROR"),
    ("WARN: low disk", "WARNING"),
    ("FATAL out of memory", "CRITICAL"),
    ("INFO then ERROR", "INFO"),
    ("no ERRORS found in /api/errors", None),
    ("error in lower case", None),
    ("xERROR ERROR_1 (DEBUG)", "DEBUG"),
    ("", None),
]


def test_levels(column):
    lines, wanted = zip(*LEVELS)
    assert column(L.level_of, lines) == list(wanted)


MESSAGES = [
    ("2024-05-01 10:00:00 [ERROR] app.db.pool - Timeout after 5s", "Timeout after 5s"),
    ("ERROR: plain text", "plain text"),
    ("10:00 FATAL - disk gone", "disk gone"),
    ("/ERRORS seen ERROR real one", "real one"),
    ("[ERROR]", "[ERROR]"),
    ("ERROR app.db-x-  tail", "tail"),
    ("  ERROR   spaced out  ", "spaced out"),
]


def test_prefix_is_stripped_at_the_matched_token(column):
    lines, wanted = zip(*MESSAGES)
    assert column(L.message_of, lines) == list(wanted)


SAME_TEMPLATE = [
    ("timeout to 10.0.0.4:5432 after 30000ms", "timeout to 10.1.22.9:80 after 7ms", "timeout to <IP>:<N> after <N>ms"),
    ("pool db-4 full", "pool db-91 full", "pool db-<N> full"),
    ("user u12 gone", "user u7 gone", "user u<N> gone"),
    ("at 2024-01-01 10:00:00 id 0xdeadbeef", "at 2023-12-31T09:59:59.123 id cafebabe99", "at <TS> id <HEX>"),
    ("open '/a/b' failed", 'open "/c" failed', "open <STR> failed"),
    ("took 1.5  s", "took 22 s", "took <N> s"),
]


@pytest.mark.parametrize("one, two, template", SAME_TEMPLATE)
def test_templates(column, one, two, template):
    assert column(L.template_of, [one, two]) == [template, template]


LINES = [
    "2024-01-01 10:00:00 [ERROR] app.db - connect 10.0.0.1 failed",
    "2024-01-01 10:00:01 [INFO] app.web - ok",
    "",
    "    at trace(line 5)",
    "2024-01-01 10:00:02 [ERROR] app.api - connect 10.0.0.2 failed",
    "2024-01-01 10:00:03 [FATAL] app.db - disk 7 gone",
    "2024-01-01 10:00:04 [WARN] app.db - slow",
]


@pytest.fixture
def parsed(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "n int, line string")
    return ops.parse(df, "line", ["n"])


def test_summary(parsed):
    summary = ops.summarise(parsed, "n")
    t = summary.totals.first()
    assert (t.total_lines, t.blank_lines, t.unlevelled_lines, t.error_lines) == (7, 1, 1, 3)
    levels = [(r.level, r.n) for r in summary.levels.collect()]
    assert levels == [("CRITICAL", 1), ("ERROR", 2), ("WARNING", 1), ("INFO", 1)]
    assert sum(n for _, n in levels) + t.blank_lines + t.unlevelled_lines == t.total_lines
    top = summary.top_errors.collect()
    assert [(r.template, r.n, r.example) for r in top] == [
        ("connect <IP> failed", 2, "connect 10.0.0.1 failed"),
        ("disk <N> gone", 1, "disk 7 gone"),
    ]
    assert sum(r.n for r in ops.error_groups(parsed, "n").collect()) == t.error_lines
    assert len(ops.top_errors(parsed, "n", 1).collect()) == 1
    with pytest.raises(ValueError):
        ops.top_errors(parsed, "n", 0)


def test_ties_go_to_the_first_line(spark):
    rows = [(3, "ERROR b"), (1, "ERROR c"), (2, "ERROR a")]
    top = ops.top_errors(ops.parse(spark.createDataFrame(rows, "n int, line string"), "line", ["n"]), "n")
    assert [r.template for r in top.collect()] == ["c", "a", "b"]


def test_json_summary(parsed, tmp_path, spark):
    rows = ops.summarise(parsed, "n").as_json()
    payload = json.loads(rows.first().summary)
    assert list(payload["level_counts"]) == ["CRITICAL", "ERROR", "WARNING", "INFO"]
    assert payload["top_errors"][0] == {"pattern": "connect <IP> failed", "count": 2, "example": "connect 10.0.0.1 failed"}
    assert payload["error_lines"] == 3
    write_json_lines(rows, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first().value) == payload


def test_log_without_levels(spark):
    parsed = ops.parse(spark.createDataFrame([(1, "x")], "n int, line string"), "line", ["n"])
    payload = json.loads(ops.summarise(parsed, "n").as_json().first().summary)
    assert payload["total_lines"] == 1 and payload["level_counts"] == {} and payload["top_errors"] == []


def test_latin1_log_file(spark, tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes("\n".join([*LINES, "ERROR caf\xe9 closed"]).encode("latin-1"))
    lines = read_lines(spark, str(path))
    assert {r.encoding for r in lines.select("encoding").distinct().collect()} == {"latin-1"}
    parsed = ops.parse(lines, "line", ["position"])
    assert ops.totals(parsed).first().error_lines == 4
    assert ops.error_groups(parsed, "position").filter(F.col("template") == "café closed").count() == 1
    assert [r.example for r in ops.top_errors(parsed, "position", 1).collect()] == ["connect 10.0.0.1 failed"]
