"""The registered queries, each with its DuckDB counterpart where SQL can state it."""

from . import audit, eda, listings, logs, modelling, preparation, resampling, sources, text
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
