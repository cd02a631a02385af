"""Row-wise operators on a stream of text: features, redaction and log parsing.

They keep no state, so the batch projections are applied unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.redact import redact
from corpusloom.operators.features import feature_frame
from corpusloom.operators.logs import parse


def text_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the files that arrive in a folder."""
    return spark.readStream.text(folder)


def featurise(stream: DataFrame, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    return feature_frame(stream, text, keep)


def redact_stream(stream: DataFrame, text: str = "value", max_chars: int = 70) -> DataFrame:
    return stream.withColumn(text, redact(F.col(text), max_chars=max_chars))


def parse_log_stream(stream: DataFrame, line: str = "value") -> DataFrame:
    return parse(stream, line)
