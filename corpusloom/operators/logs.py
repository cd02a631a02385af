"""Log summaries: level counts and the most frequent error templates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import logs as L


def parse(df: DataFrame, line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """`keep` columns plus level, blank flag, message and template of each line.

    Message and template are only worked out for error lines. Row-wise, so it also
    runs on a streaming DataFrame.
    """
    text = F.coalesce(F.col(line), F.lit(""))
    levelled = df.select(*keep, text.alias(line), L.level_of(text).alias("level"), L.is_blank(text).alias("blank"))
    is_error = F.col("level").isin(*L.ERROR_LEVELS)
    with_message = levelled.withColumn("message", F.when(is_error, L.message_of(F.col(line))))
    return with_message.withColumn("template", F.when(is_error, L.template_of(F.col("message"))))


def totals(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    none = F.col("level").isNull()
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if("blank").alias("blank_lines"),
        F.count_if(none & ~F.col("blank")).alias("unlevelled_lines"),
        F.count_if(F.col("level").isin(*L.ERROR_LEVELS)).alias("error_lines"),
    )


def level_counts(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lines per level with their share, most severe first."""
    counts = parsed.filter("level IS NOT NULL").groupBy(*by, "level").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("share", share).orderBy(*by, L.severity_rank(F.col("level")))


def error_groups(parsed: DataFrame, order: str, line: str = "line") -> DataFrame:
    """Templates of error lines: count, first line and the message seen there.
    Counted on the map side, so one flooding error does not load one task."""
    return with_examples(parsed, counted_errors(parsed, order), order, line)


def counted_errors(parsed: DataFrame, order: str) -> DataFrame:
    """template, n, first_line: fixed-width sums, combined in hash tables before the shuffle."""
    errors = parsed.filter(F.col("level").isin(*L.ERROR_LEVELS))
    return errors.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_line"))


def with_examples(parsed: DataFrame, counted: DataFrame, order: str, line: str = "line") -> DataFrame:
    """The message of each template's first line. The bare lines are joined by their number, and only
    those that were found are taken apart again."""
    bare = parsed.filter(F.col("level").isin(*L.ERROR_LEVELS)).select(F.col(order).alias("first_line"), F.col(line).alias("_text"))
    found = counted.join(bare, "first_line").withColumn("example", L.message_of(F.col("_text")))
    return found.filter(L.template_of(F.col("example")) == F.col("template")).select("template", "n", "example", "first_line")


def top_errors(parsed: DataFrame, order: str, top: int = 10, line: str = "line") -> DataFrame:
    if top < 1:
        raise ValueError("top must be at least 1.")
    most = counted_errors(parsed, order).orderBy(F.col("n").desc(), "first_line").limit(top)
    return with_examples(parsed, most, order, line).orderBy(F.col("n").desc(), "first_line").limit(top)


@dataclass(frozen=True)
class LogSummary:
    totals: DataFrame
    levels: DataFrame
    top_errors: DataFrame

    def as_json(self) -> DataFrame:
        """One row, one JSON object: totals, levels in severity order, top errors.
        Only finished, bounded reports (9 levels, `top` errors) are gathered."""
        rank: Column = L.severity_rank(F.col("level"))
        levels = self.levels.agg(
            F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "level", "n"))).alias("l")
        ).select(
            F.map_from_entries(F.transform("l", lambda e: F.struct(e["level"], e["n"]))).alias("level_counts")
        )
        errors = self.top_errors.agg(
            F.sort_array(
                F.collect_list(F.struct((-F.col("n")).alias("neg"), "first_line", "template", "n", "example"))
            ).alias("e")
        ).select(
            F.transform(
                "e",
                lambda e: F.struct(
                    e["template"].alias("pattern"), e["n"].alias("count"), e["example"].alias("example")
                ),
            ).alias("top_errors")
        )
        one = F.lit(1)
        row = (
            self.totals.withColumn("_one", one)
            .join(levels.withColumn("_one", one), "_one")
            .join(errors.withColumn("_one", one), "_one")
        )
        fields = [c for c in row.columns if c != "_one"]
        return row.select(F.to_json(F.struct(*fields)).alias("summary"))


def summarise(parsed: DataFrame, order: str, top: int = 10) -> LogSummary:
    return LogSummary(totals(parsed), level_counts(parsed), top_errors(parsed, order, top))
