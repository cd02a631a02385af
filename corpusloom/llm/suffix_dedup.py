"""Removal of every 200-byte string that occurs twice, by a partitioned suffix array.

Only suffixes that can have a partner are sorted. Each document is sampled at its minimizers
(positions whose 64-byte gram has the smallest fingerprint among 32 neighbours):
equal 200-byte strings have equal minimizers inside, so a suffix can have a partner only if all of
its inner minimizers occur elsewhere too. Of the suffixes between two neighbouring minimizers, those of a
stretch that another place has byte for byte need no sorting of their own: they have a partner, and the stretch's
first place stands for all. The others, and the first places', are dealt out by
sampled splitters of their leading bytes (and, where many begin alike, of the fingerprint of their 200
bytes). A bucket sorts its suffixes by leading bytes and then by
fingerprint and compares neighbours. Splitters are values of the full sort key, so equal suffixes never lie
on both sides of a bucket's end: the comparison across boundaries is decided by the splitter.

Copies of a whole document take no part beyond their first: they are known from their digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import external_key, row_texts, text_bytes, written
from corpusloom.llm.grams import Texts, byte_windows, chunks, covered, mixed, owners, span_prints
from corpusloom.llm.packed_exchange import ENTRIES, FOUND, LED_ENTRIES, NARROW_ENTRIES, Bucket, Packer, buckets_for, cut_to_sent, meet, per_owner, top_bits
from corpusloom.llm.substring_dedup import merged

LENGTH, GRAM, NEIGHBOURS = 200, 64, 32
SEVERAL, OPEN = np.uint8(2), np.uint8(4)
#: Documents and suffixes in the sample that the splitters come from.
SAMPLE_TEXTS, SAMPLE_SUFFIXES = 2_000, 100_000
RESULT = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def subset(texts: Texts, keep: np.ndarray) -> tuple[Texts, np.ndarray]:
    """The texts marked in `keep`, and which they are."""
    sizes = np.diff(texts.offsets)
    which = np.flatnonzero(keep)
    data = texts.data[np.repeat(keep, sizes)]
    return Texts(data, np.concatenate([[0], np.cumsum(sizes[which])])), which


def long_enough(texts: Texts, length: int) -> tuple[Texts, np.ndarray]:
    """The texts of at least `length` bytes, and which they are."""
    return subset(texts, np.diff(texts.offsets) >= length)


def _sliding(values: np.ndarray, n: int, choose) -> np.ndarray:
    """Of every n (a power of two) values in a row, the least or greatest."""
    step = 1
    while step < n:
        values = choose(values[:-step], values[step:])
        step *= 2
    return values


def minimizers(texts: Texts, gram: int, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and place of every gram that is the least of some `neighbours` grams in a row of its own text,
    so that a text has the same ones whatever texts stand beside it."""
    prints, at = byte_windows(texts, gram)
    if len(prints) < neighbours:
        return prints[:0], at[:0]
    least = _sliding(prints, neighbours, np.minimum)
    least[at[neighbours - 1 :] - at[: len(at) - neighbours + 1] != neighbours - 1] = 0
    edge = np.zeros(neighbours - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), neighbours, np.maximum)
    chosen = most == prints
    return mixed(prints[chosen], 5), at[chosen]


def anchors(texts: DataFrame, buckets: int, shape: tuple[int, int, int]) -> DataFrame:
    (length, gram, neighbours), (bucket_of, bits) = shape, top_bits(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bucket_of, bits)
        for batch in batches:
            for part, every in chunks(batch):
                own, which = long_enough(every, length)
                prints, at = minimizers(own, gram, neighbours)
                of = which[owners(at, own.offsets)] if len(at) else at
                yield from packer.add(part.column("row").to_numpy()[of], cut_to_sent(prints, bits), np.zeros(len(of), np.uint8))
        yield from packer.flush()

    return texts.mapInArrow(run, NARROW_ENTRIES)


def _met_again(bucket: Bucket, group: np.ndarray, n: int) -> np.ndarray:
    again = np.bincount(group, minlength=n) > 1
    again[group[(bucket.marks & SEVERAL) > 0]] = True
    return again[group]


def hits(entries: DataFrame, buckets: int) -> DataFrame:
    """row, prints: per document the minimizers that occur in another place too."""
    _, bits = top_bits(buckets)

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        values, group = np.unique(bucket.prints, return_inverse=True)
        yield from bucket.answers(_met_again(bucket, group, len(values)))

    return merged(per_owner(meet(entries, judge, narrow_bits=bits)))


def sort_keys(data: np.ndarray, starts: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The first five bytes of each suffix, then bits of its fingerprint."""
    key = np.zeros(len(starts), np.uint64)
    for k in range(5):
        key = (key << np.uint64(8)) | data[starts + k].astype(np.uint64)
    return (key << np.uint64(24)) | (prints >> np.uint64(40))


def splitters(texts: DataFrame, n_texts: int, buckets: int, length: int) -> np.ndarray:
    """Sort keys that cut a bounded sample of suffixes into equal parts; they decide the balance, never the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, every in chunks(batch):
                own, _ = long_enough(every, length)
                prints, at = byte_windows(own, length)
                some = slice(0, None, max(1, len(at) * SAMPLE_TEXTS // (SAMPLE_SUFFIXES * max(1, own.count)) or 1))
                yield pa.record_batch([pa.array(sort_keys(own.data, at[some], prints[some]).view(np.int64))], names=["lead"])

    some = texts.sample(min(1.0, SAMPLE_TEXTS / max(1, n_texts)), seed=11)
    got = some.mapInArrow(run, "lead long").limit(2 * SAMPLE_SUFFIXES).toPandas()["lead"].to_numpy().view(np.uint64)
    return np.unique(np.sort(got)[np.linspace(0, len(got) - 1, buckets + 1)[1:-1].astype(int)]) if len(got) else got


def range_of(cuts: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    return lambda leads: np.searchsorted(cuts, leads, side="right").astype(np.int64)


@dataclass
class Suffixes:
    """The suffixes of a chunk's texts: fingerprint, place, and whether each may have a partner; and the
    stretches between neighbouring minimizers: fingerprint, text, first and last suffix."""

    prints: np.ndarray
    at: np.ndarray
    near: np.ndarray
    stretch: np.ndarray
    stretch_of: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def inside(self, chosen: np.ndarray) -> np.ndarray:
        """Which suffixes lie in one of the chosen stretches."""
        change = np.zeros(len(self.at) + 1, np.int32)
        np.add.at(change, self.first[chosen], 1)
        np.add.at(change, self.last[chosen] + 1, -1)
        return np.cumsum(change[:-1]) > 0


def suffixes(own: Texts, shape: tuple[int, int, int], bits: int, useful: list[np.ndarray] | None = None) -> Suffixes:
    """`useful`: per text the minimizers known to occur elsewhere; without them every suffix may have a partner."""
    length, gram, neighbours = shape
    prints, at = minimizers(own, gram, neighbours)
    whole, begin = byte_windows(own, length)
    near = np.ones(len(begin), bool)
    if useful is not None:
        sent = cut_to_sent(prints, bits)
        cuts = np.searchsorted(at, own.offsets)
        lone = np.zeros(len(own.data) + 1, np.int32)
        for i, known in enumerate(useful):
            a, b = cuts[i], cuts[i + 1]
            lone[at[a:b][~np.isin(sent[a:b], known)]] = 1
        before = np.concatenate([[0], np.cumsum(lone)])
        # A gram chosen among these places was chosen by bytes of the suffix alone.
        near = before[begin + length - gram - neighbours + 2] == before[begin + neighbours - 1]
    of = owners(at, own.offsets) if len(at) else at
    pair = np.flatnonzero((of[1:] == of[:-1]) & (at[1:] + length <= own.offsets[of[1:] + 1])) if len(at) else at
    first, last = np.searchsorted(begin, at[pair]), np.searchsorted(begin, at[pair + 1])
    far = np.concatenate([[0], np.cumsum(~near)])
    full = far[last + 1] == far[first]
    pair, first, last = pair[full], first[full], last[full]
    stop = at[pair + 1] + length
    stretch = mixed(span_prints(own, at[pair], stop) + (stop - at[pair]).astype(np.uint64), 9)
    return Suffixes(whole, begin, near, stretch, of[pair], first, last)


def known_of(column: pa.Array, which: np.ndarray) -> list[np.ndarray]:
    return [column[int(i)].values.to_numpy().view(np.uint64) if column[int(i)].is_valid else np.zeros(0, np.uint64) for i in which]


def among(prints: np.ndarray, of: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """Which prints their text knows; `of` ascends."""
    cuts = np.searchsorted(of, np.arange(len(known) + 1))
    out = np.zeros(len(prints), bool)
    for i, mine in enumerate(known):
        if len(mine) and cuts[i + 1] > cuts[i]:
            out[cuts[i] : cuts[i + 1]] = np.isin(prints[cuts[i] : cuts[i + 1]], mine)
    return out


def repeated_stretches(texts: DataFrame, buckets: int, shape: tuple[int, int, int]) -> DataFrame:
    """row, stretches (those that occur in another place too) and leading (those of them that this text stands for)."""
    bucket_of, bits = top_bits(buckets)
    length = shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bucket_of)
        for batch in batches:
            for part, every in chunks(batch):
                own, which = long_enough(every, length)
                got = suffixes(own, shape, bits, known_of(part.column("prints"), which))
                of = which[got.stretch_of]
                yield from packer.add(part.column("row").to_numpy()[of], got.stretch, np.zeros(len(of), np.uint8))
        yield from packer.flush()

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        values, group = np.unique(bucket.prints, return_inverse=True)
        least = np.full(len(values), np.iinfo(np.int64).max)
        np.minimum.at(least, group, bucket.owner)
        yield from bucket.answers(_met_again(bucket, group, len(values)), (bucket.owner == least[group]).astype(np.int64))

    found = per_owner(meet(texts.mapInArrow(run, ENTRIES), judge))
    both = found.groupBy(F.col("key").alias("row")).agg(F.flatten(F.collect_list("prints")).alias("stretches"), F.flatten(F.collect_list("values")).alias("first"))
    return both.select("row", "stretches", F.filter("stretches", lambda _, i: F.get("first", i) == 1).alias("leading"))


def repeated(texts: DataFrame, buckets: int, cuts: np.ndarray, shape: tuple[int, int, int]) -> DataFrame:
    """row, prints: per text the suffixes outside repeated stretches that occur in another place too."""
    _, bits = top_bits(buckets)
    length = shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(range_of(cuts))
        for batch in batches:
            for part, every in chunks(batch):
                own, which = long_enough(every, length)
                got = suffixes(own, shape, bits, known_of(part.column("prints"), which))
                settled = got.inside(among(got.stretch, got.stretch_of, known_of(part.column("stretches"), which)))
                leading = got.inside(among(got.stretch, got.stretch_of, known_of(part.column("leading"), which)))
                sent = (got.near & ~settled) | leading
                prints, at = got.prints[sent], got.at[sent]
                of = which[owners(at, own.offsets)] if len(at) else at
                marks = np.where(leading[sent], SEVERAL, 0).astype(np.uint8) | np.where(settled[sent], 0, OPEN).astype(np.uint8)
                yield from packer.add(part.column("row").to_numpy()[of], prints, marks, sort_keys(own.data, at, prints))
        yield from packer.flush()

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((bucket.prints, bucket.leads))
        lead, whole = bucket.leads[order], bucket.prints[order]
        new = np.ones(len(order), bool)
        new[1:] = (lead[1:] != lead[:-1]) | (whole[1:] != whole[:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        yield from bucket.answers(_met_again(bucket, group, int(new.sum())) & ((bucket.marks & OPEN) > 0))

    return merged(per_owner(meet(texts.mapInArrow(run, LED_ENTRIES), judge, FOUND)))


def strip(texts: DataFrame, shape: tuple[int, int, int], with_text: bool) -> DataFrame:
    length = shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, every in chunks(batch):
                sizes = np.diff(every.offsets)
                shared = part.column("shared").to_numpy(zero_copy_only=False).astype(bool) & (sizes >= length)
                out = np.repeat(shared, sizes)
                known = part.column("prints").is_valid().to_numpy(zero_copy_only=False) | part.column("stretches").is_valid().to_numpy(zero_copy_only=False)
                open_ones = known & ~shared & (sizes >= length)
                if open_ones.any():
                    own, which = subset(every, open_ones)
                    windows, stretches = known_of(part.column("prints"), which), known_of(part.column("stretches"), which)
                    got = suffixes(own, shape, 0)
                    gone = got.inside(among(got.stretch, got.stretch_of, stretches)) | among(got.prints, owners(got.at, own.offsets), windows)
                    out[np.repeat(open_ones, sizes)] = covered(got.at[gone], length, len(own.data))
                removed, spans, digests, texts_left = [], [], [], []
                for i in range(every.count):
                    mine = out[every.offsets[i] : every.offsets[i + 1]]
                    left = every.data[every.offsets[i] : every.offsets[i + 1]][~mine].tobytes()
                    removed.append(int(mine.sum()))
                    spans.append(int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum()))
                    digests.append(hashlib.sha256(left).hexdigest())
                    texts_left.append(left.decode(errors="replace") if with_text else None)
                columns = [part.column("key"), pa.array(np.diff(every.offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests), pa.array(texts_left, pa.string())]
                yield pa.record_batch(columns, names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.mapInArrow(run, RESULT)


def remove_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, neighbours: int = NEIGHBOURS, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the text left, on request).

    A byte goes if a string of `length` bytes over it also begins anywhere else, in the same document
    or another; strings never reach across documents. Null and empty texts have no bytes. Rows that
    repeat an id count as different places. In `kept` a character that was cut in half shows
    as the replacement character. An empty table gives no rows; other columns are not read.
    """
    if gram + 2 * neighbours > length or neighbours & (neighbours - 1):
        raise ValueError("neighbours must be a power of two, and gram + 2 * neighbours at most length")
    shape = (length, gram, neighbours)
    texts = row_texts(docs, id_column, text_column)
    spark = docs.sparkSession
    total = text_bytes(texts)
    buckets = buckets_for(spark, total)
    # Whole documents that occur again; of each, the least row is searched and the others are its later copies.
    digests = written(texts.select("row", F.sha2("text", 256).alias("digest")), "whole-digests")
    first = digests.groupBy("digest").agg(F.min("row").alias("first"), F.count("*").alias("size")).filter("size > 1")
    shared = written(digests.distinct().join(first, "digest").select("row", (F.col("row") > F.col("first")).alias("later")), "whole-copies")
    found = hits(anchors(texts.select("row", "text"), buckets, shape), buckets).join(shared, "row", "left")
    found = written(found.filter(~F.coalesce("later", F.lit(False))).select("row", "prints"), "minimizer-hits")
    # Texts that may repeat something, without later copies of whole documents.
    open_texts = texts.select("row", "text").join(found, "row")
    stretches = written(repeated_stretches(open_texts, buckets, shape), "repeated-stretches")
    cuts = splitters(texts, digests.count(), buckets, length)
    rest = written(repeated(open_texts.join(stretches, "row", "left"), buckets, cuts, shape), "repeated-suffixes")
    removable = rest.join(stretches.select("row", "stretches"), "row", "full").join(shared.select("row", F.lit(True).alias("shared")), "row", "full")
    every = texts.join(removable, "row", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))
    out = strip(every, shape, with_text)
    return out.select(external_key("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text)
