"""Several labelled corpora of different layouts as one (corpus, text, y, note) table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.dedupe import drop_duplicates

# Accepted text length of the large corpus.
MIN_CHARS, MAX_CHARS = 5, 20_000


@dataclass(frozen=True)
class Corpus:
    rows: DataFrame
    text: Column
    y: Column
    note: str = ""


def hygiene(df: DataFrame, key: str, text: str = "text", label: str = "label") -> DataFrame:
    """One row per (label, text), texts of a sensible length, labels 0 or 1 only.
    The cheap filters run before the shuffle; equal rows pass or fail them together."""
    typed = df.withColumn(text, F.col(text).cast("string"))
    usable = typed.filter(F.length(text).between(MIN_CHARS, MAX_CHARS) & F.col(label).isin(0, 1))
    return drop_duplicates(usable, key, [label, text])


def large_corpus(df: DataFrame, key: str) -> Corpus:
    return Corpus(hygiene(df, key), F.col("text"), (F.col("label") == 1).cast("int"), "cleaned")


def email_text(subject: Column, message: Column) -> Column:
    blank = F.lit("")
    return F.concat(F.coalesce(subject.cast("string"), blank), F.lit(" "), F.coalesce(message.cast("string"), blank))


def is_class(label: Column, positive: str) -> Column:
    return F.coalesce(label == positive, F.lit(False)).cast("int")


def email_corpus(df: DataFrame) -> Corpus:
    text = email_text(F.col("Subject"), F.col("Message"))
    return Corpus(df, text, is_class(F.col("`Spam/Ham`"), "spam"), "subject and message")


def phishing_corpus(df: DataFrame) -> Corpus:
    kept = df.dropna(subset=["Email Text"])
    return Corpus(kept, F.col("`Email Text`"), is_class(F.col("`Email Type`"), "Phishing Email"), "raw text")


def union_corpora(corpora: Mapping[str, Corpus | None]) -> DataFrame:
    """Stack the corpora that are present, each under its name."""
    stacked = None
    for name, corpus in corpora.items():
        if corpus is None:
            continue
        part = corpus.rows.select(
            F.lit(name).alias("corpus"), corpus.text.alias("text"), corpus.y.alias("y"), F.lit(corpus.note).alias("note")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        raise ValueError("None of the corpora is present.")
    return stacked


def optional(load: Callable[[], Corpus]) -> Corpus | None:
    """The corpus, or None where its files are missing."""
    try:
        return load()
    except FileNotFoundError:
        return None
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
