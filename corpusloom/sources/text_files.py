"""Delimited and plain text files read with an encoding ladder and provenance.

A first pass over the raw lines decides, per file, which encoding of the ladder is
the first that fits; the read itself is then an ordinary Spark read per encoding.
Spark's readers never fail on a wrong charset, they put U+FFFD in, so the check has
to come first. A UTF-8 byte-order mark is always dropped.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Encoding ladders, strictest first.
DEFAULT_ENCODINGS = ("utf-8", "latin-1")
EXTENDED_ENCODINGS = ("utf-8", "utf-8-sig", "cp1252", "latin-1")

_CHARSETS = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "cp1252": "ISO-8859-1", "latin-1": "ISO-8859-1"}
MAX_BROADCAST_FILES = 100_000


class EncodingDetectionError(RuntimeError):
    """No encoding of the ladder fits a file."""


def _cp1252_pairs() -> tuple[str, str, str]:
    """Latin-1 spelling, Windows spelling, and the bytes Windows-1252 leaves undefined."""
    seen, meant, undefined = "", "", ""
    for byte in range(0x80, 0xA0):
        try:
            meant += bytes([byte]).decode("cp1252")
            seen += chr(byte)
        except UnicodeDecodeError:
            undefined += chr(byte)
    return seen, meant, undefined


_SEEN, _MEANT, _UNDEFINED = _cp1252_pairs()


def _latin(raw: Column) -> Column:
    return F.decode(raw.cast("binary"), "ISO-8859-1")


def _fits(encoding: str, raw: Column) -> Column:
    if encoding in ("utf-8", "utf-8-sig"):
        return F.is_valid_utf8(raw)
    if encoding == "cp1252":
        return ~_latin(raw).rlike(f"[{_UNDEFINED}]")
    if encoding == "ascii":
        return ~_latin(raw).rlike(r"[^\x00-\x7F]")
    return F.lit(True)


def _decoded(encoding: Column, raw: Column, ladder: Sequence[str]) -> Column:
    text = raw
    if "cp1252" in ladder:
        text = F.when(encoding == "cp1252", F.translate(_latin(raw), _SEEN, _MEANT)).otherwise(text)
    if "latin-1" in ladder:
        text = F.when(encoding == "latin-1", _latin(raw)).otherwise(text)
    return text


def _ladder(encodings: Sequence[str]) -> tuple[str, ...]:
    ladder = tuple(encodings)
    if not ladder:
        raise ValueError("At least one encoding is needed.")
    unknown = [e for e in ladder if e not in _CHARSETS]
    if unknown:
        raise ValueError(f"Unsupported encodings {unknown}; choose from {sorted(_CHARSETS)}.")
    return ladder


def _raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No such file: {path}") from error
        raise
    return lines.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def detect_encodings(
    spark: SparkSession, path: str | list[str], encodings: Sequence[str] = DEFAULT_ENCODINGS
) -> DataFrame:
    """(file, encoding, attempted, used_fallback); encoding is null if none fits."""
    ladder = _ladder(encodings)
    raw = _raw_lines(spark, path)
    checks = raw.groupBy("file").agg(
        *[F.bool_and(_fits(e, F.col("value"))).alias(f"fits_{i}") for i, e in enumerate(ladder)]
    )
    encoding, attempted = F.lit(None).cast("string"), F.array(*[F.lit(e) for e in ladder])
    for i, e in reversed(list(enumerate(ladder))):
        encoding = F.when(F.col(f"fits_{i}"), F.lit(e)).otherwise(encoding)
        attempted = F.when(F.col(f"fits_{i}"), F.array(*[F.lit(x) for x in ladder[: i + 1]])).otherwise(attempted)
    found = checks.select(
        "file",
        encoding.alias("encoding"),
        attempted.alias("attempted"),
        (~F.col("fits_0")).alias("used_fallback"),
    )
    # A file without a line fits the first encoding; only the file listing knows of it.
    listing = [(re.sub("^file:/+", "file:///", f),) for f in raw.inputFiles()]
    listed = spark.createDataFrame(listing, "file string").alias("l").join(found, F.col("l.file") == F.regexp_replace(found["file"], "^file:/+", "file:///"), "left_anti")
    first = [F.lit(ladder[0]).alias("encoding"), F.array(F.lit(ladder[0])).alias("attempted"), F.lit(False).alias("used_fallback")]
    return found.unionByName(listed.select("file", *first))


def _checked(spark: SparkSession, path, encodings) -> list:
    # One row per file: no more than the file listing the driver holds for any read.
    found = detect_encodings(spark, path, encodings).collect()
    failed = sorted(r["file"] for r in found if r["encoding"] is None)
    if failed:
        raise EncodingDetectionError(
            f"{len(failed)} file(s) fit none of {tuple(encodings)}: {failed[:20]}"
        )
    return found


def read_lines(
    spark: SparkSession, path: str | list[str], encodings: Sequence[str] = DEFAULT_ENCODINGS
) -> DataFrame:
    """(file, encoding, position, line). `position` sorts lines in file order within
    and across files: a struct of file, block offset and place in the block. Lines
    end at \\n, \\r or \\r\\n."""
    found = _checked(spark, path, encodings)
    raw = _raw_lines(spark, path).withColumn("place", F.monotonically_increasing_id())
    used = {r["encoding"] for r in found}
    if len(used) <= 1:
        tagged = raw.withColumn("encoding", F.lit(next(iter(used), encodings[0])))
    else:
        names = spark.createDataFrame([(r["file"], r["encoding"]) for r in found], "file string, encoding string")
        small = F.broadcast(names) if len(found) <= MAX_BROADCAST_FILES else names
        tagged = raw.join(small, "file")
    return tagged.select(
        "file",
        "encoding",
        F.struct("file", "block", "place").alias("position"),
        _decoded(F.col("encoding"), F.col("value"), encodings).alias("line"),
    )


@dataclass(frozen=True)
class LoadResult:
    data: DataFrame
    provenance: DataFrame


_NUMBERS = ("int", "bigint", "double")


def common_schema(schemas: Sequence[StructType]) -> StructType:
    """One schema for files inferred apart: the wider number, else text; names must agree."""
    names = schemas[0].names
    for other in schemas[1:]:
        if other.names != names:
            raise ValueError(f"The files' headers differ: {names} and {other.names}.")
    out = StructType()
    for i, name in enumerate(names):
        kinds = {s[i].dataType.simpleString(): s[i].dataType for s in schemas}
        if len(kinds) == 1:
            kind = schemas[0][i].dataType
        elif all(k in _NUMBERS for k in kinds):
            kind = kinds[max(kinds, key=_NUMBERS.index)]
        else:
            kind = StringType()
        out.add(name, kind)
    return out


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    encodings: Sequence[str] = DEFAULT_ENCODINGS,
    *,
    schema: StructType | str | None = None,
    **options,
) -> LoadResult:
    """Read delimited files, each with the first encoding of the ladder that fits it.

    `options` are those of Spark's CSV reader (`sep`, `header`, `quote=""` to switch
    quoting off, `multiLine`, ...). Without a schema the types are inferred from all
    files: a column takes the widest type that any encoding group needs, text if nothing
    else fits. Groups whose headers differ are an error.
    """
    if "encoding" in options or "charset" in options:
        raise ValueError("Pass encodings=(...) instead of encoding=: the encoding is detected.")
    found = _checked(spark, path, encodings)
    groups: dict[str, list[str]] = {}
    for r in found:
        groups.setdefault(r["encoding"], []).append(r["file"])
    if schema is None:
        options = {"header": True, **options}
    parts, counts = None, None
    paths = {encoding: path if len(groups) == 1 else files for encoding, files in groups.items()}
    reader_of = lambda encoding: spark.read.options(**options).option("encoding", _CHARSETS[encoding])
    if schema is None and groups:
        schema = common_schema([reader_of(e).option("inferSchema", True).csv(paths[e]).schema for e in sorted(groups)])
    for encoding in sorted(groups):
        part = reader_of(encoding).schema(schema).csv(paths[encoding])
        per_file = part.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
        if encoding == "cp1252":
            part = part.select(
                *[
                    F.translate(f.name, _SEEN, _MEANT).alias(f.name) if isinstance(f.dataType, StringType) else f.name
                    for f in part.schema.fields
                ]
            )
        parts = part if parts is None else parts.unionByName(part)
        counts = per_file if counts is None else counts.unionByName(per_file)
    if parts is None:
        raise ValueError(f"No lines in {path}.")
    return LoadResult(parts, _provenance(spark, found, counts, len(parts.columns)))


def _provenance(spark: SparkSession, found: list, counts: DataFrame, width: int) -> DataFrame:
    seen = spark.createDataFrame(
        [(r["file"], r["encoding"], r["attempted"], r["used_fallback"]) for r in found],
        "file string, encoding string, attempted array<string>, used_fallback boolean",
    )
    rows = F.coalesce("n_rows", F.lit(0))
    return seen.join(counts, "file", "left").select(
        "file",
        rows.alias("n_rows"),
        F.lit(width).alias("n_columns"),
        "encoding",
        "attempted",
        "used_fallback",
    )


def read_messages(spark: SparkSession, path: str | list[str], encodings: Sequence[str] = DEFAULT_ENCODINGS) -> LoadResult:
    """Headerless tab-separated label and message; a bare quote is an ordinary character."""
    return read_delimited(spark, path, encodings, schema="label string, message string", sep="\t", header=False, quote="")
