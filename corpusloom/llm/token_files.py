"""Token ids in flat binary files, with 64-bit offsets, for memory-mapped reading.

A corpus is a folder of numbered shards in ascending document order. Each shard is
`<name>.ids`, a flat array of unsigned 16-bit little-endian ids, and `<name>.docs`, a flat array of
signed 64-bit integers: per document its id and the corpus-wide offset of its first
token. The bases of the shards are prefix sums of the shards' token counts.

Three Spark jobs make it. The first range-partitions the document ids alone, to find where each shard begins; the second encodes the texts where
they are read, sends the ids, each document's compressed by itself, to their shards and writes each shard's file, so texts are never
shuffled and ids stand nowhere but in the shuffle and the shards; the third adds the bases to the offsets. Every attempt of
a task writes files of its own, and only those named in the written manifest
count, so a lost executor or a speculative task leaves the corpus right.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import NO_ID, external_key, keyed_texts, written
from corpusloom.llm.encoding import encoder
from corpusloom.llm.grams import chunks
from corpusloom.workspace import fresh_path

SHARD_TEXT_BYTES = 64 << 20
MANIFEST = "shard long, name string, n_docs long, n_tokens long, first_key long"
READ_TOKENS = 1 << 22
CODEC = ("zstd", 1)
ENCODED = "shard int, key long, hash long, n long, ids binary"


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _open(folder: fs.FileSystem, path: str):
    """A memory map where the file is local, else a seekable stream."""
    if isinstance(folder, fs.LocalFileSystem):
        return pa.memory_map(path)
    return folder.open_input_file(path)


def shard_bounds(rows: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Key and text hash of the first row of each shard, in order; shards are of about as many rows each."""
    dealt = rows.select("key", "hash").repartitionByRange(shards, "key", "hash")
    firsts = dealt.groupBy(F.spark_partition_id().alias("shard")).agg(F.min(F.struct("key", "hash")).alias("first")).orderBy("shard").select("first.*").collect()
    return np.array([r.key for r in firsts], np.int64), np.array([r.hash for r in firsts], np.int64)


def shard_of(keys: np.ndarray, hashes: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shard of each row of key and hash: how many bounds behind the first do not lie behind the row."""
    first_keys, first_hashes = (b[1:] for b in bounds)
    low, high = (np.searchsorted(first_keys, keys, side=side) for side in ("left", "right"))
    out = low.copy()
    for a, b in np.unique(np.stack([low, high], axis=1)[low < high], axis=0).tolist():  # keys that several shards share
        which = np.flatnonzero((low == a) & (high == b))
        out[which] = a + np.searchsorted(first_hashes[a:b], hashes[which], side="right")
    return out


def encoded_texts(texts: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, plain_specials: bool, bounds: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row of key, hash and text: its shard, key, hash, the number of its ids with the end id, and these as 16-bit integers, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, packed = encoder(tokenizer, keeps_space, plain_specials).encode, pa.Codec(*CODEC)
        for batch in batches:
            for part, _ in chunks(batch):
                ids = encode_all(part.column("text").to_pylist(), end_id)
                shard = shard_of(part.column("key").to_numpy(), part.column("hash").to_numpy(), bounds)
                sent = pa.array([packed.compress(i.tobytes(), asbytes=True) for i in ids], pa.binary())
                yield pa.record_batch(
                    [pa.array(shard, pa.int32()), part.column("key"), part.column("hash"), pa.array([len(i) for i in ids], pa.int64()), sent], names=["shard", "key", "hash", "n", "ids"]
                )

    return texts.mapInArrow(run, ENCODED)


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    keeps_space: bool,
    end_id: int = 2,
    folder: str | None = None,
    shard_text_bytes: int = SHARD_TEXT_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
    plain_specials: bool = True,
) -> tuple[str, DataFrame]:
    """Write the corpus; returns its folder and the manifest, one row per shard with its base.

    A null or empty text is a document of the end id alone. Documents without an id come
    last. Rows that repeat an id are separate documents, ordered by a hash of their texts
    and then their ids (equal ids make equal files in either order). An empty table gives an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")
    texts = keyed_texts(docs, id_column, text_column).select("key", F.xxhash64("text").alias("hash"), "text")
    rows = written(texts.select("key", "hash", F.octet_length("text").alias("size")), "document-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_text_bytes), spark.sparkContext.defaultParallelism)
    encoded = encoded_texts(texts, tokenizer, keeps_space, end_id, plain_specials, shard_bounds(rows, shards))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = pa.Codec(*CODEC)
        name, total, keys, starts = uuid.uuid4().hex, 0, [], []
        target, path = _folder(folder)
        target.create_dir(path, recursive=True)
        with target.open_output_stream(f"{path}/{name}.ids") as out:
            for batch in batches:
                n = batch.column("n").to_numpy()
                keys.append(batch.column("key").to_numpy())
                starts.append(total + np.cumsum(n) - n)
                total += int(n.sum())
                for ids, m in zip(batch.column("ids"), n.tolist(), strict=True):
                    out.write(packed.decompress(ids.as_buffer(), 2 * m))
        if sum(map(len, keys)):
            index = np.stack([np.concatenate(keys), np.concatenate(starts)], axis=1).astype("<i8")
            with target.open_output_stream(f"{path}/{name}.local") as out:
                out.write(index.tobytes())
            row = [[0], [name], [len(index)], [total], [int(index[0, 0])]]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.string(), *[pa.int64()] * 3), strict=True)], names=["shard", "name", "n_docs", "n_tokens", "first_key"])

    parts = encoded.repartitionById(shards, "shard").sortWithinPartitions("key", "hash", "ids")
    manifest = written(parts.mapInArrow(write, MANIFEST).withColumn("shard", F.spark_partition_id().cast("long")), "token-manifest")
    # One row per shard: prefix sums over them are a small window.
    in_order = Window.partitionBy(F.lit(0)).orderBy("shard")
    based = manifest.select(
        F.row_number().over(in_order).cast("long").alias("shard"), "name", "n_docs", "n_tokens",
        F.coalesce(F.sum("n_tokens").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n_docs").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first_doc"),
    )

    def rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                target, path = _folder(folder)
                with _open(target, f"{path}/{row['name']}.local") as source:
                    index = np.frombuffer(source.read(), "<i8").reshape(-1, 2).copy()
                index[:, 1] += row["base"]
                made = f"{path}/{row['name']}.{uuid.uuid4().hex}"
                with target.open_output_stream(made) as out:
                    out.write(index.tobytes())
                target.move(made, f"{path}/{row['name']}.docs")
            yield batch

    final = written(based.repartition(shards, "shard").mapInArrow(rebase, based.schema), "token-bases")
    return folder, final


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids (array of int), ids_crc32."""
    return _read(manifest, folder, with_ids=True)


def token_digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids)."""
    return _read(manifest, folder, with_ids=False)


def _read(manifest: DataFrame, folder: str, with_ids: bool) -> DataFrame:
    schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                target, path = _folder(folder)
                with _open(target, f"{path}/{row['name']}.docs") as source:
                    index = np.frombuffer(source.read(), "<i8").reshape(-1, 2)
                bounds = np.append(index[:, 1], row["base"] + row["n_tokens"]) - row["base"]
                with _open(target, f"{path}/{row['name']}.ids") as source:
                    begin = 0
                    while begin < len(index):
                        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + READ_TOKENS, side="right")) - 1)
                        end = min(end, len(index))
                        source.seek(int(bounds[begin]) * 2)
                        ids = np.frombuffer(source.read(int(bounds[end] - bounds[begin]) * 2), "<u2")
                        cuts = bounds[begin : end + 1] - bounds[begin]
                        crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                        columns = [pa.array(index[begin:end, 0]), pa.array(index[begin:end, 1]), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32))))
                        yield pa.record_batch(columns, names=["key", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
                        begin = end

    found = manifest.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "name").mapInArrow(read, schema)
    return found.select(external_key("key").alias("doc_id"), *[c for c in found.columns if c != "key"])


__all__ = ["NO_ID", "read_token_files", "token_digests", "write_token_files"]
