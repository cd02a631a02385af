"""SentencePiece ids of texts by a relational lattice, and texts of ids.

Texts are cut at places that no piece spans, and each distinct word is encoded once: its
substrings of bounded length are exploded, an equi-join with the piece table keeps those that are pieces,
and the edges are grouped by word again. A fold over each word's edges (Spark's
higher-order `aggregate`) finds its segmentation:

* `unigram` vocabularies: Viterbi, the segmentation of the largest sum of scores;
* `bpe` vocabularies: the merges in order of score, which is what their scores mean. A largest sum
  would be another segmentation than the model's.

Characters that are no piece become the pieces of their UTF-8 bytes. The folds take time that grows with the
square of a word's length, so the rare words beyond LONG_UNIT characters (unbroken runs of one letter, say) are
segmented one by one instead, to the same result. Documents are dealt into blocks of
bounded text; a block's distinct words meet the encoded words by bucket and come back to it.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import external_key, keyed_texts, quoted, text_bytes, written
from corpusloom.llm.packed_exchange import buckets_for, lists

BLANK = "▁"
UNITS = re.compile(f"{BLANK}+[^{BLANK}\n\t]*|[^{BLANK}\n\t]+|[\n\t]")
BLOCK_TEXT_BYTES = 12 << 20
LONG_UNIT = 48


class Vocabulary:
    """Pieces of a model file: what they are, their ids and scores, and the first byte piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)}
        self.pieces = [(model.id_to_piece(i), i, model.get_score(i)) for i in ids if i not in special]
        self.first_byte = next((i for i in ids if model.is_byte(i)), model.unk_id())
        self.longest = max(len(p) for p, _, _ in self.pieces)
        self.inner = frozenset(p[k : k + 2] for p, _, _ in self.pieces for k in range(len(p) - 1))
        self.texts = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else b"" if i in special else model.id_to_piece(i).replace(BLANK, " ").encode() for i in ids
        ]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pd.DataFrame(self.pieces, columns=["piece", "id", "score"]), "piece string, id int, score double")


def units_of(text: str, inner: frozenset[str]) -> list[str]:
    """The text's words as the model sees them, cut where no piece reaches across."""
    if not text:
        return []
    out = []
    for unit in UNITS.findall(BLANK + text.replace(" ", BLANK)):
        if len(unit) <= LONG_UNIT:
            out.append(unit)
            continue
        begin = 0
        for k in range(1, len(unit)):
            if unit[k - 1 : k + 1] not in inner:
                out.append(unit[begin:k])
                begin = k
        out.append(unit[begin:])
    return out


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """word, n (its length) and edges: the pieces found in it as structs of start, stop, id, score."""
    at = F.explode(F.sequence(F.lit(0), F.length("word") - 1))
    spans = words.select("word", at.alias("start"))
    spans = spans.select("word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("start")))).alias("size"))
    spans = spans.withColumn("piece", F.expr("substring(word, start + 1, size)"))
    # The piece table is bounded by the vocabulary.
    edges = spans.join(F.broadcast(pieces), "piece", "left").filter("id IS NOT NULL OR size = 1")
    edge = F.struct("start", (F.col("start") + F.col("size")).alias("stop"), "id", "score")
    return edges.groupBy("word").agg(F.collect_list(edge).alias("edges")).withColumn("n", F.length("word"))


def merge_fold() -> Column:
    """Places at which the word's pieces begin, and its end: neighbours merge, best score first, then leftmost."""
    best_first = F.array_sort(
        F.filter("edges", lambda e: e["stop"] > e["start"] + 1),
        lambda a, b: F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1)).otherwise(a["start"] - b["start"]),
    )

    def step(places: Column, _: Column) -> Column:
        def middle(e):
            first = F.array_position(places, e["start"])
            return (first > 0) & (F.array_position(places, e["stop"]) == first + 2)

        found = F.slice(F.filter(F.col("merges"), middle), 1, 1)
        gone = F.transform(found, lambda e: F.element_at(places, (F.array_position(places, e["start"]) + 1).cast("int")))
        return F.array_except(places, gone)

    every = F.sequence(F.lit(0), F.col("n"))
    return best_first, F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.size("merges") + 1)), every, step)


def viterbi_fold() -> Column:
    """The same places by the largest sum of scores; a character that is no piece costs more than any piece."""
    state = "array<struct<score: double, back: int>>"
    start = F.transform(F.sequence(F.lit(0), F.col("n")), lambda i: F.struct(F.when(i == 0, 0.0).otherwise(F.lit(float("-inf"))).alias("score"), F.lit(-1).alias("back")))
    by_stop = F.array_sort("edges", lambda a, b: F.when(a["stop"] != b["stop"], a["stop"] - b["stop"]).otherwise(a["start"] - b["start"]))

    def relax(best: Column, e: Column) -> Column:
        sum_ = F.get(best, e["start"])["score"] + F.coalesce(e["score"], F.lit(-1e6))
        better = F.struct(sum_.alias("score"), e["start"].alias("back"))
        return F.transform(best, lambda x, i: F.when((i == e["stop"]) & (sum_ > x["score"]), better).otherwise(x))

    best = F.aggregate(by_stop, start.cast(state), relax)

    def back(places: Column, _: Column) -> Column:
        first = F.get(places, F.lit(0))
        return F.when(first > 0, F.concat(F.array(F.get(F.col("best"), first)["back"]), places)).otherwise(places)

    return best, F.aggregate(F.sequence(F.lit(1), F.col("n")), F.array(F.col("n")), back)


def segmented(grid: DataFrame, kind: str, first_byte: int) -> DataFrame:
    """word and ids."""
    if kind == "bpe":
        merges, places = merge_fold()
        grid = grid.withColumn("merges", merges).withColumn("places", places)
    elif kind == "unigram":
        best, places = viterbi_fold()
        grid = grid.withColumn("best", best).withColumn("places", places)
    else:
        raise ValueError("kind must be 'bpe' or 'unigram'")

    def ids(stop: Column, i: Column) -> Column:
        start = F.get(F.col("places"), i)
        known = F.get(F.filter("edges", lambda e: (e["start"] == start) & (e["stop"] == stop)), F.lit(0))["id"]
        code = F.hex(F.encode(F.substring(F.col("word"), start + 1, F.lit(1)), "UTF-8"))
        spelled = F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda k: F.lit(first_byte) + F.conv(F.substring(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int"))
        return F.when(known.isNotNull(), F.array(known)).otherwise(spelled)

    return grid.select("word", F.flatten(F.transform(F.slice("places", F.lit(2), F.size("places")), ids)).alias("ids"))


def segment_long(word: str, known: dict[str, tuple[float, int]], longest: int, kind: str) -> list[str]:
    """The pieces of one word in time that grows with its length: a heap of merges, or a walk for the largest sum."""
    n = len(word)
    if kind == "unigram":
        best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        for stop in range(1, n + 1):
            for start in range(max(0, stop - longest), stop):
                score = known[word[start:stop]][0] if word[start:stop] in known else -1e6 if stop - start == 1 else None
                if score is not None and best[start] + score > best[stop]:
                    best[stop], back[stop] = best[start] + score, start
        places = [n]
        while places[-1]:
            places.append(back[places[-1]])
        places.reverse()
    else:
        stop_of, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(start: int) -> None:
            middle = stop_of[start] if start >= 0 else n
            if middle < n and (found := known.get(word[start : stop_of[middle]])):
                heapq.heappush(heap, (-found[0], start, middle, stop_of[middle]))

        for i in range(n):
            offer(i)
        while heap:
            _, start, middle, stop = heapq.heappop(heap)
            if stop_of[start] != middle or stop_of[middle] != stop:
                continue
            stop_of[start], stop_of[middle] = stop, -1
            if stop < n:
                before[stop] = start
            offer(start)
            offer(before[start])
        places = [0]
        while places[-1] < n:
            places.append(stop_of[places[-1]])
    return [word[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]


def segmented_long(words: DataFrame, vocabulary: Vocabulary, kind: str) -> DataFrame:
    known = {p: (score, i) for p, i, score in vocabulary.pieces}
    longest, first_byte = vocabulary.longest, vocabulary.first_byte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():
                pieces = segment_long(word, known, longest, kind)
                out.append([i for p in pieces for i in ([known[p][1]] if p in known else [first_byte + b for b in p.encode()])])
            yield pa.record_batch([batch.column("word"), pa.array(out, pa.list_(pa.int32()))], names=["word", "ids"])

    return words.mapInArrow(run, "word string, ids array<int>")


def encode_documents(docs: DataFrame, model_path: str, kind: str = "bpe", id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_TEXT_BYTES) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, as the SentencePiece library gives them.

    Null and empty texts have no ids. A blank character U+2581 in a text counts as a blank. Rows that
    repeat an id are encoded one by one; a null id stays null; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(model_path)
    inner, longest, first_byte = vocabulary.inner, vocabulary.longest, vocabulary.first_byte
    texts = keyed_texts(docs, id_column, text_column)
    total = text_bytes(texts)
    blocks, buckets = max(1, -(-total // block_bytes), spark.sparkContext.defaultParallelism), buckets_for(spark, total)
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))

    def distinct_units(table: pa.Table) -> pa.Table:
        met = {u for text in table.column("text") for u in units_of(text.as_py(), inner)}
        by: dict[int, list[str]] = {}
        for unit in met:
            by.setdefault(zlib.crc32(unit.encode()) % buckets, []).append(unit)
        block = table.column("block")[0].as_py()
        return pa.table([pa.array([block] * len(by), pa.int64()), pa.array(list(by), pa.int64()), pa.array(list(by.values()), pa.list_(pa.string()))], names=["block", "bucket", "words"])

    met = written(dealt.groupBy("block").applyInArrow(distinct_units, "block long, bucket long, words array<string>"), "block-words")
    words = met.select(F.explode("words").alias("word")).distinct()
    grid = lattice(words.filter(F.length("word") <= LONG_UNIT), vocabulary.table(spark), longest)
    ids = segmented(grid, kind, first_byte).union(segmented_long(words.filter(F.length("word") > LONG_UNIT), vocabulary, kind))
    encoded = written(ids.withColumn("bucket", F.pmod(F.crc32(F.encode("word", "UTF-8")), F.lit(buckets))), "encoded-words")

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        ids = dict(zip(known.column("word").to_pylist(), known.column("ids").to_pylist(), strict=True))
        rows = asked.column("words").to_pylist()
        return pa.table(
            [asked.column("block"), asked.column("words"), pa.array([[i for w in ws for i in ids[w]] for ws in rows], pa.list_(pa.int32())), pa.array([[len(ids[w]) for w in ws] for ws in rows], pa.list_(pa.int32()))],
            names=["block", "words", "ids", "sizes"],
        )

    known = met.groupBy("bucket").cogroup(encoded.groupBy("bucket")).applyInArrow(answer, "block long, words array<string>, ids array<int>, sizes array<int>")

    def recompose(texts: pa.Table, known: pa.Table) -> pa.Table:
        table: dict[str, bytes] = {}
        for words, ids, sizes in zip(known.column("words"), known.column("ids"), known.column("sizes"), strict=True):
            flat, cuts = ids.values.to_numpy().astype("<i4"), np.concatenate([[0], np.cumsum(sizes.values.to_numpy())])
            for k, word in enumerate(words.as_py()):
                table[word] = flat[cuts[k] : cuts[k + 1]].tobytes()
        out = [b"".join([table[u] for u in units_of(t.as_py(), inner)]) for t in texts.column("text")]
        cuts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in out])])
        ids = lists(np.frombuffer(b"".join(out), "<i4"), cuts)
        return pa.table([texts.column("key"), pa.array(np.diff(cuts), pa.int64()), ids], names=["key", "n_tokens", "ids"])

    got = dealt.groupBy("block").cogroup(written(known, "answered-words").groupBy("block")).applyInArrow(recompose, "key long, n_tokens long, ids array<int>")
    return got.select(external_key("key").alias("doc_id"), "n_tokens", "ids")


def decode_documents(encoded: DataFrame, model_path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """`encoded` with the texts of its ids: the pieces' bytes in turn, less the blank put before a text. Null stays null."""
    texts = Vocabulary(model_path).texts
    at = encoded.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            flat, cuts = column.values.to_numpy(), column.offsets.to_numpy()
            out = [b"".join([texts[i] for i in flat[a:b].tolist()])[1:].decode(errors="replace") if ok else None for a, b, ok in zip(cuts[:-1], cuts[1:], column.is_valid().to_pylist(), strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, text_column])

    from pyspark.sql import types as T

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(text_column, T.StringType())]))


__all__ = ["Vocabulary", "decode_documents", "encode_documents", "lattice", "quoted", "segmented", "units_of"]
