"""Log analytics over lines rendered from `events`."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.logs import level_of, message_of, template_of
from corpusloom.operators import logs as ops
from corpusloom.sources.text_files import read_lines
from corpusloom.workspace import fresh_path

from .base import LOG_LINES, log_lines, query

_LEVELS = "CRITICAL|FATAL|ERROR|WARNING|WARN|INFO|DEBUG|TRACE|NOTSET"
_TOKEN = f"regexp_extract(line, '(^|[^A-Za-z0-9_])({_LEVELS})([^A-Za-z0-9_]|$)', 2)"
_LEVEL = (
    f"CASE {_TOKEN} WHEN '' THEN NULL WHEN 'WARN' THEN 'WARNING' WHEN 'FATAL' THEN 'CRITICAL' ELSE {_TOKEN} END"
)
_AFTER = (
    f"regexp_replace(regexp_replace(trim(line), '^.*?(?:^|[^A-Za-z0-9_])(?:{_LEVELS})([^A-Za-z0-9_]|$)', '\\1'), "
    "'^[ \\t:|\\-\\]}>]+', '')"
)
_TAIL = f"regexp_replace({_AFTER}, '^[A-Za-z_][A-Za-z0-9_.$-]*(?:\\.[A-Za-z0-9_.$-]+)+\\s*[-:|]\\s+', '')"
_MESSAGE = f"CASE WHEN {_TAIL} = '' THEN trim(line) ELSE trim({_TAIL}) END"


def _template(text: str) -> str:
    rules = (
        (r"\b\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:[.,]\d+)?\b", "<TS>"),
        (r"\b(?:0x)?[0-9a-fA-F]{8,}\b", "<HEX>"),
        (r"\b\d+(?:\.\d+){3}\b", "<IP>"),
        (r"\b([A-Za-z_]+)\d+\b", r"\1<N>"),
        (r"(^|[^A-Za-z_0-9])\d+(?:\.\d+)?", r"\1<N>"),
        (r"[''\"][^''\"]{0,80}[''\"]", "<STR>"),
        (r"\s+", " "),
    )
    for pattern, placeholder in rules:
        text = f"regexp_replace({text}, '{pattern}', '{placeholder}', 'g')"
    return f"trim({text})"


_ERRORS = "('CRITICAL', 'FATAL', 'ERROR')"
PARSED = (
    "WITH " + LOG_LINES + f", levelled AS (SELECT event_id, line, {_LEVEL} AS level, trim(line) = '' AS blank FROM lines), "
    f"messages AS (SELECT *, CASE WHEN level IN {_ERRORS} THEN {_MESSAGE} END AS message FROM levelled), "
    f"parsed AS (SELECT *, {_template('message')} AS template FROM messages) "
)


def parsed(spark, folder):
    return ops.parse(log_lines(spark, folder), "line", ["event_id"])


@query("l1_level", PARSED + "SELECT event_id, level FROM parsed")
def l1(spark, folder):
    return log_lines(spark, folder).select("event_id", level_of(F.col("line")).alias("level"))


@query(
    "l2_strip_prefix",
    "WITH " + LOG_LINES + f" SELECT event_id, {_MESSAGE} AS message FROM lines WHERE {_LEVEL} IS NOT NULL",
)
def l2(spark, folder):
    lines = log_lines(spark, folder).filter(level_of(F.col("line")).isNotNull())
    return lines.select("event_id", message_of(F.col("line")).alias("message"))


@query("l3_message_template", "WITH " + LOG_LINES + f" SELECT event_id, {_template('trim(line)')} AS template FROM lines")
def l3(spark, folder):
    return log_lines(spark, folder).select("event_id", template_of(F.col("line")).alias("template"))


@query(
    "l4_line_totals",
    PARSED + "SELECT count(*) AS total_lines, count(*) FILTER (WHERE blank) AS blank_lines, "
    "count(*) FILTER (WHERE level IS NULL AND NOT blank) AS unlevelled_lines FROM parsed",
)
def l4(spark, folder):
    return ops.totals(parsed(spark, folder)).drop("error_lines")


@query(
    "l5_level_counts",
    PARSED + "SELECT level, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share "
    "FROM parsed WHERE level IS NOT NULL GROUP BY level",
)
def l5(spark, folder):
    counts = ops.level_counts(parsed(spark, folder))
    return counts.select("level", "n", F.round("share", 6).alias("share"))


@query(
    "l6_top_errors",
    PARSED + "SELECT template, count(*) AS n, arg_min(message, event_id) AS example, min(event_id) AS first_line "
    "FROM parsed WHERE template <> '' GROUP BY template ORDER BY n DESC, first_line LIMIT 10",
)
def l6(spark, folder):
    return ops.top_errors(parsed(spark, folder), "event_id", 10)


@query(
    "l7_error_lines",
    PARSED + f"SELECT count(*) FILTER (WHERE level IN {_ERRORS}) AS error_lines, "
    "count(*) FILTER (WHERE template <> '') AS grouped_lines FROM parsed",
)
def l7(spark, folder):
    rows = parsed(spark, folder)
    groups = ops.error_groups(rows, "event_id").agg(F.sum("n").alias("grouped_lines"), F.lit(1).alias("one"))
    return ops.totals(rows).select("error_lines", F.lit(1).alias("one")).join(groups, "one").drop("one")


def _from_files(spark, folder):
    """The rendered lines written as text files and read back with the ladder."""
    path = fresh_path(spark, "log")
    log_lines(spark, folder).select("line").write.text(path)
    lines = read_lines(spark, path)
    return ops.parse(lines, "line", ["position", "encoding"])


@query(
    "l8_log_summary",
    PARSED + ", total AS (SELECT count(*) AS total_lines, count(*) FILTER (WHERE blank) AS blank_lines, "
    f"count(*) FILTER (WHERE level IS NULL AND NOT blank) AS unlevelled_lines, count(*) FILTER (WHERE level IN {_ERRORS}) "
    "AS error_lines FROM parsed), per_level AS (SELECT level, count(*) AS n FROM parsed WHERE level IS NOT NULL GROUP BY level) "
    "SELECT level, n, total_lines, blank_lines, unlevelled_lines, error_lines FROM per_level CROSS JOIN total",
)
def l8(spark, folder):
    summary = ops.summarise(_from_files(spark, folder), "position")
    one = F.lit(1)
    levels = summary.levels.select("level", "n", one.alias("one"))
    return levels.join(summary.totals.withColumn("one", one), "one").drop("one")


@query(
    "s6_log_summary_json",
    PARSED + ", total AS (SELECT count(*) AS total_lines, count(*) FILTER (WHERE blank) AS blank_lines, "
    f"count(*) FILTER (WHERE level IS NULL AND NOT blank) AS unlevelled_lines, count(*) FILTER (WHERE level IN {_ERRORS}) "
    "AS error_lines FROM parsed), per_level AS (SELECT level, count(*) AS n FROM parsed WHERE level IS NOT NULL GROUP BY level), "
    "ranked AS (SELECT *, list_position(['CRITICAL', 'FATAL', 'ERROR', 'WARNING', 'WARN', 'INFO', 'DEBUG', 'TRACE', 'NOTSET'], level) AS place FROM per_level), "
    "top AS (SELECT template, count(*) AS n, arg_min(message, event_id) AS example, min(event_id) AS first_line "
    "FROM parsed WHERE template <> '' GROUP BY template ORDER BY n DESC, first_line LIMIT 10) "
    "SELECT CAST(to_json({'total_lines': total_lines, 'blank_lines': blank_lines, 'unlevelled_lines': unlevelled_lines, 'error_lines': error_lines, "
    "'level_counts': (SELECT map(list(level ORDER BY place), list(n ORDER BY place)) FROM ranked), "
    "'top_errors': (SELECT list({'pattern': template, 'count': n, 'example': example} ORDER BY n DESC, first_line) FROM top)}) AS VARCHAR) AS summary FROM total",
)
def s6(spark, folder):
    return ops.summarise(parsed(spark, folder), "event_id").as_json()
