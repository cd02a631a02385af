"""Sources: files written by Spark from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.sources import corpora as C
from corpusloom.sources.text_files import DEFAULT_ENCODINGS, EXTENDED_ENCODINGS, detect_encodings, read_delimited, read_lines, read_messages
from corpusloom.workspace import fresh_path

from .base import CORPORA, labelled, query, table

# A text goes into a Latin-1 file if that charset holds all of its characters.
_BEYOND_LATIN = r"[^\x00-\x{ff}]"
_ONE_LINE = r"[\r\n\t\x{85}]+"
# Texts with line breaks cannot be split by a reader, which takes whole files; so no file may grow with the table.
FILE_ROWS = 5_000
_CSV = {"header": True, "escape": '"'}
_SCHEMA = "doc_id long, lang string, text string"


def _two_encodings(spark, folder):
    """The documents as Latin-1 files where possible and as UTF-8 files otherwise."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    beyond = F.col("text").rlike(_BEYOND_LATIN)
    path = fresh_path(spark, "documents")
    for part, charset in ((docs.filter(beyond), "UTF-8"), (docs.filter(~beyond), "ISO-8859-1")):
        writer = part.write.options(**_CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxRecordsPerFile=FILE_ROWS)
        writer.option("encoding", charset).csv(f"{path}/{charset}")
    return [f"{path}/UTF-8", f"{path}/ISO-8859-1"]


@query("s1_read_delimited", "SELECT doc_id, lang, md5(text) AS digest FROM documents")
def s1(spark, folder):
    paths = _two_encodings(spark, folder)
    loaded = read_delimited(spark, paths, DEFAULT_ENCODINGS, schema=_SCHEMA, multiLine=True, **_CSV)
    return loaded.data.select("doc_id", "lang", F.md5("text").alias("digest"))


@query(
    "s1_types_of_all_files",
    "SELECT CASE WHEN regexp_matches(text, '[^\\x{00}-\\x{ff}]') THEN 'k' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS id, lang, md5(text) AS digest FROM documents",
)
def s1_types(spark, folder):
    """Numbers in the files of one encoding, other ids in those of the other: no value may be lost."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    beyond = F.col("text").rlike(_BEYOND_LATIN)
    path = fresh_path(spark, "documents")
    key = F.col("doc_id").cast("string")
    for part, charset in ((docs.filter(beyond).withColumn("doc_id", F.concat(F.lit("k"), key)), "UTF-8"), (docs.filter(~beyond), "ISO-8859-1")):
        writer = part.write.options(**_CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxRecordsPerFile=FILE_ROWS)
        writer.option("encoding", charset).csv(f"{path}/{charset}")
    loaded = read_delimited(spark, [f"{path}/UTF-8", f"{path}/ISO-8859-1"], DEFAULT_ENCODINGS, multiLine=True, **_CSV)
    return loaded.data.select(F.col("doc_id").cast("string").alias("id"), "lang", F.md5("text").alias("digest"))


@query("s4_provenance")
def s4(spark, folder):
    paths = _two_encodings(spark, folder)
    return read_delimited(spark, paths, EXTENDED_ENCODINGS, schema=_SCHEMA, multiLine=True, **_CSV).provenance


@query(
    "s2_read_lines",
    "SELECT md5(line) AS digest, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10))) AS line FROM documents) GROUP BY line",
)
def s2(spark, folder):
    path = fresh_path(spark, "lines")
    table(spark, folder, "documents").select("text").write.text(path)
    lines = read_lines(spark, path)
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).select(F.md5("line").alias("digest"), "n")


@query(
    "s4_provenance_by_encoding",
    "SELECT encoding, used_fallback, count(*) AS n_rows, 3::INTEGER AS n_columns FROM (SELECT CASE WHEN beyond THEN 'utf-8' ELSE 'latin-1' END AS encoding, "
    "NOT beyond AS used_fallback FROM (SELECT regexp_matches(text, '[^\\x{00}-\\x{ff}]') AS beyond FROM documents)) GROUP BY encoding, used_fallback",
)
def s4_by_encoding(spark, folder):
    paths = _two_encodings(spark, folder)
    files = read_delimited(spark, paths, DEFAULT_ENCODINGS, schema=_SCHEMA, multiLine=True, **_CSV).provenance
    rows = files.groupBy("encoding", "used_fallback", "n_columns").agg(F.sum("n_rows").alias("n_rows"))
    return rows.filter("n_rows > 0")  # an encoding may have a file with nothing but a header


@query("s2_detect_encodings")
def s2_detect(spark, folder):
    return detect_encodings(spark, _two_encodings(spark, folder), EXTENDED_ENCODINGS)


@query(
    "s3_headerless_messages",
    "SELECT CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END AS label, md5('\"' || trim(regexp_replace(text, '[\\r\\n\\t\\x{85}]+', ' ', 'g'))) AS digest "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def s3(spark, folder):
    rows = labelled(spark, folder)
    label = F.when(F.col("y") == 1, "spam").otherwise("ham")
    line = F.concat(label, F.lit('\t"'), F.trim(F.regexp_replace("text", _ONE_LINE, " ")))
    path = fresh_path(spark, "messages")
    rows.select(line.alias("value")).write.text(path)
    data = read_messages(spark, path).data
    return data.select("label", F.md5("message").alias("digest"))


@query(
    "s5_harmonised_corpora",
    "WITH " + CORPORA + " SELECT corpus, y, md5(text) AS digest, count(*) AS n FROM corpora GROUP BY corpus, y, text",
)
def s5(spark, folder):
    talks = table(spark, folder, "conversations").filter(F.col("role").isin("user", "assistant"))
    parts = {
        "documents": C.Corpus(labelled(spark, folder), F.col("text"), F.col("y"), "documents by toxicity"),
        "conversations": C.Corpus(talks, F.col("text"), C.is_class(F.col("role"), "assistant"), "turns by speaker"),
        "absent": C.optional(lambda: C.Corpus(table(spark, folder, "no_such_corpus"), F.col("text"), F.col("y"))),
    }
    stacked = C.union_corpora(parts)
    counted = stacked.groupBy("corpus", "y", "text").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("corpus", "y", F.md5("text").alias("digest"), "n")
