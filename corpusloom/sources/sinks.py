"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json_lines(json_rows: DataFrame, path: str) -> None:
    """Write a single string column of JSON objects, one object per line."""
    json_rows.write.text(path)
