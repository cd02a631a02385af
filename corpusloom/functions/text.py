"""Message-shape features as Column expressions.

Every builder takes a text column and returns a number that is never null: a
missing message counts as the empty one. Character classes are counted by
deleting the class and comparing lengths, which avoids building an array of
matches per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charclasses import ALNUM, DECIMAL, DIGIT, LETTER, NOT_BEFORE_WORD, SPACE, UPPER, WORD

# Currency symbols, URL endings and the shortest digit run of interest.
CURRENCY_SYMBOLS = "$£€¥₹¢₩₽₪₦฿"
URL_ENDINGS = ("com", "net", "org", "co.uk", "uk", "tv", "info", "biz", "ru", "de")
LONG_DIGIT_RUN = 8

_ENDINGS = "|".join(e.replace(".", r"\.") for e in URL_ENDINGS)
# Every alternative starts at a rare character and looks back from there. A bare
# domain needs one word character in the hyphenated run before the dot.
URL_LIKE = (
    rf"://(?<=(?iu:https?)://)|\.(?<=(?iu:www)\.)|\.(?<=[{WORD}]\.)(?iu:{_ENDINGS}){NOT_BEFORE_WORD}"
    rf"|-(?<=[{WORD}]-)-*\.(?iu:{_ENDINGS}){NOT_BEFORE_WORD}"
)

# A token without any letter but capitals, and with two of them at least.
_NO_LETTER = rf"[^\p{{L}}{SPACE}]"
_ALL_CAPS_TOKEN = (
    rf"(?<![^{SPACE}])(?:{_NO_LETTER}*+\p{{Lu}}){{2}}(?:\p{{Lu}}|{_NO_LETTER})*+(?![^{SPACE}])"
)


def as_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def _shape(col: Column) -> Column:
    """The text with every run of a-z shortened to one letter. Word borders and all
    other characters survive, so most counts can be taken from this shorter string,
    which the projection works out once."""
    return F.regexp_replace(as_text(col), "[a-z]+", "a")


def _without(col: Column, class_body: str) -> Column:
    return F.regexp_replace(_shape(col), f"[{class_body}]+", "")


def _count_of(col: Column, class_body: str) -> Column:
    return F.length(_shape(col)) - F.length(_without(col, class_body))


def _shortened_by(col: Column) -> Column:
    return F.length(as_text(col)) - F.length(_shape(col))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def char_length(col: Column) -> Column:
    return F.length(as_text(col))


def word_count(col: Column) -> Column:
    marked = F.regexp_replace(_shape(col), f"[^{SPACE}]+", "x")
    return F.length(marked) - _count_of(col, SPACE)


def mean_word_length(col: Column) -> Column:
    return _share(F.length(as_text(col)) - _count_of(col, SPACE), word_count(col))


def digit_count(col: Column) -> Column:
    return _count_of(col, DIGIT)


def digit_ratio(col: Column) -> Column:
    return _share(digit_count(col), char_length(col))


def uppercase_ratio(col: Column) -> Column:
    return _share(_count_of(col, UPPER), _count_of(col, LETTER) + _shortened_by(col))


def all_caps_word_count(col: Column) -> Column:
    return F.regexp_count(_shape(col), F.lit(_ALL_CAPS_TOKEN))


def exclamation_count(col: Column) -> Column:
    return F.length(_shape(col)) - F.length(F.replace(_shape(col), F.lit("!"), F.lit("")))


def currency_symbol_count(col: Column) -> Column:
    return F.length(_shape(col)) - F.length(F.translate(_shape(col), CURRENCY_SYMBOLS, ""))


def non_alnum_count(col: Column) -> Column:
    return F.length(_without(col, SPACE + ALNUM))


def has_url_like(col: Column) -> Column:
    return as_text(col).rlike(URL_LIKE).cast("int")


def has_long_digit_run(col: Column) -> Column:
    return _shape(col).rlike(f"[{DECIMAL}]{{{LONG_DIGIT_RUN}}}").cast("int")


# The order is part of the contract: it is the column order of the feature frame.
FEATURES: dict[str, Callable[[Column], Column]] = {
    f.__name__: f
    for f in (
        char_length,
        word_count,
        mean_word_length,
        digit_count,
        digit_ratio,
        uppercase_ratio,
        all_caps_word_count,
        exclamation_count,
        currency_symbol_count,
        non_alnum_count,
        has_url_like,
        has_long_digit_run,
    )
}
FEATURE_NAMES = tuple(FEATURES)


def has_non_ascii(col: Column) -> Column:
    return F.coalesce(col.rlike(r"[^\x00-\x7F]"), F.lit(False))


def has_replacement_char(col: Column) -> Column:
    return F.coalesce(col.contains("�"), F.lit(False))
