"""Log-line parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charclasses import NOT_AFTER_WORD, NOT_BEFORE_WORD, SPACE, WORD

# Levels by falling severity, their aliases, and the error levels.
LEVELS = ("CRITICAL", "FATAL", "ERROR", "WARNING", "WARN", "INFO", "DEBUG", "TRACE", "NOTSET")
LEVEL_ALIASES = {"WARN": "WARNING", "FATAL": "CRITICAL"}
ERROR_LEVELS = ("CRITICAL", "FATAL", "ERROR")

# A level as a whole token, a dotted logger name with its separator.
_LEVEL_TOKEN = rf"(?<![A-Za-z0-9_])({'|'.join(LEVELS)})(?![A-Za-z0-9_])"
_LOGGER = rf"[A-Za-z_][{WORD}.$-]*\.[{WORD}.$-]+[{SPACE}]*[-:|][{SPACE}]+"
# Through the first level token, the separators after it and one dotted logger name.
# Something must remain: otherwise nothing matches and the line stays whole.
_PREFIX = rf"(?s)^(?>.*?{_LEVEL_TOKEN})[ \t:|\-\]}}>]*+(?:{_LOGGER})?+(?=.)"

# Masking rules for the variable parts of a message, in order.
MASKS = (
    (
        rf"{NOT_AFTER_WORD}\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}:\d{{2}}(?:[.,]\d+)?{NOT_BEFORE_WORD}",
        "<TS>",
    ),
    (rf"{NOT_AFTER_WORD}(?:0x)?[0-9a-fA-F]{{8,}}{NOT_BEFORE_WORD}", "<HEX>"),
    (rf"{NOT_AFTER_WORD}\d+(?:\.\d+){{3}}{NOT_BEFORE_WORD}", "<IP>"),
    (rf"{NOT_AFTER_WORD}([A-Za-z_]+)\d+{NOT_BEFORE_WORD}", "$1<N>"),
    (r"(?<![A-Za-z_0-9])\d+(?:\.\d+)?", "<N>"),
    (r"['\"][^'\"]{0,80}['\"]", "<STR>"),
    (rf"[{SPACE}]+", " "),
)


def strip_space(col: Column) -> Column:
    return F.regexp_replace(col, rf"^[{SPACE}]+|(?<![{SPACE}])[{SPACE}]++$", "")


def is_blank(line: Column) -> Column:
    return ~line.rlike(f"[^{SPACE}]")


def level_of(line: Column) -> Column:
    """First whole-token level with aliases folded; null when there is none."""
    names = F.create_map(*[F.lit(x) for level in LEVELS for x in (level, LEVEL_ALIASES.get(level, level))])
    return F.try_element_at(names, F.regexp_extract(line, _LEVEL_TOKEN, 1))


def message_of(line: Column) -> Column:
    """Text after the level token that matched, minus separators and one dotted
    logger name; the whole line if nothing is left."""
    return strip_space(F.regexp_replace(strip_space(line), _PREFIX, ""))


def template_of(message: Column) -> Column:
    out = strip_space(message)
    for pattern, placeholder in MASKS:
        out = F.regexp_replace(out, pattern, placeholder)
    return strip_space(out)


def severity_rank(level: Column) -> Column:
    rank = F.lit(len(LEVELS))
    for position, name in enumerate(LEVELS):
        rank = F.when(level == name, F.lit(position)).otherwise(rank)
    return rank
