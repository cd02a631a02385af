"""The registered queries of this subpackage, each with its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_files")
def op1_token_files(spark, folder):
    from corpusloom.llm.token_files import token_digests, write_token_files

    where, manifest = write_token_files(documents(spark, folder), vocabulary("byte_bpe_50k.json"), keeps_space=True, plain_specials=False)
    return token_digests(spark, where, manifest)


OP3_SQL = r"""WITH n AS (
 SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
 doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n"""


@query("op3_exact_dedup", OP3_SQL)
def op3_exact_dedup(spark, folder):
    from corpusloom.llm.exact_dedup import find_copies

    return find_copies(documents(spark, folder))


@query("op4_substring_dedup")
def op4_substring_dedup(spark, folder):
    from corpusloom.llm.substring_dedup import remove_repeats

    return remove_repeats(documents(spark, folder))


@query("op5_quality_rules")
def op5_quality_rules(spark, folder):
    from corpusloom.llm.quality_rules import judge

    return judge(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, folder):
    from corpusloom.llm.suffix_dedup import remove_repeated_bytes

    return remove_repeated_bytes(documents(spark, folder))


@query("op9_cost_balanced_packing")
def op9_cost_balanced_packing(spark, folder):
    from corpusloom.llm.packing import pack

    return pack(documents(spark, folder), vocabulary("word_bpe_49k.json"), keeps_space=False, plain_specials=False)


@query("op10_jaccard_join")
def op10_jaccard_join(spark, folder):
    from corpusloom.llm.jaccard_join import link_documents

    return link_documents(documents(spark, folder))


@query("op6_secret_scan")
def op6_secret_scan(spark, folder):
    from corpusloom.llm.secret_scan import scan

    return scan(documents(spark, folder))


@query("op2_sentencepiece")
def op2_sentencepiece(spark, folder):
    """Ids of every document, their checksum, and the digest of the text they decode to."""
    from pyspark.sql import functions as F

    from corpusloom.llm.sentencepiece_lattice import decode_documents, encode_documents

    model = vocabulary("piece_bpe_32k.model")
    decoded = decode_documents(encode_documents(documents(spark, folder), model), model)
    return decoded.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_license_scan")
def op8_license_scan(spark, folder):
    from corpusloom.llm.license_scan import scan

    return scan(documents(spark, folder))


def _clustering_sql() -> str:
    from corpusloom.llm.centroid_clustering import clustering_sql

    return clustering_sql()


@query("op13_centroid_clustering", _clustering_sql())
def op13_centroid_clustering(spark, folder):
    from corpusloom.llm.centroid_clustering import cluster_vectors

    return cluster_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op11_html_text")
def op11_html_text(spark, folder):
    from corpusloom.llm.html_text import extract_text

    return extract_text(spark.read.parquet(f"{folder}/pages.parquet"))


@query("op12_token_alignment")
def op12_token_alignment(spark, folder):
    from corpusloom.llm.token_alignment import align_documents

    return align_documents(documents(spark, folder), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
