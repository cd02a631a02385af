"""Removal of passages of 13 or more words that an earlier document has as well.

Fixed-block anchors: every document's non-overlapping blocks of 7 words are indexed, and
every rolling window of 7 words probes the index. A shared passage of 13 words holds
at least one whole block of either document, so both sides of it find a hit. Hits are
extended to the 13-word windows around them; windows are compared exactly, by 64-bit
fingerprints over all documents with the smallest document of each, and what is left
is the union of windows that an earlier document has: the maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import external_key, row_texts, text_bytes, written
from corpusloom.llm.grams import Texts, chunks, covered, owners, texts_of, word_prints, word_windows, words_of
from corpusloom.llm.packed_exchange import NAMED_ENTRIES, NARROW_ENTRIES, Bucket, Packer, buckets_for, cut_to_sent, meet, per_owner, top_bits

WINDOW = 13
ALIGNED, SEVERAL = np.uint8(1), np.uint8(2)
RESULT = "key long, n_words long, n_removed long, kept_sha256 string, kept string"


def block_words(window: int) -> int:
    """The longest block of which any window holds a whole one, wherever it begins."""
    return max(1, (window + 1) // 2)


def anchors(texts: DataFrame, buckets: int, window: int) -> DataFrame:
    """Every rolling block-sized window of each document, marked where it is a block of the index."""
    n, (bucket_of, bits) = block_words(window), top_bits(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bucket_of, bits)
        for batch in batches:
            for part, own in chunks(batch):
                words = words_of(own)
                prints, at = word_windows(word_prints(own, words), words.offsets, n)
                of = owners(at, words.offsets)
                aligned = ((at - words.offsets[of]) % n == 0).astype(np.uint8)
                yield from packer.add(part.column("row").to_numpy()[of], cut_to_sent(prints, bits), aligned)
        yield from packer.flush()

    return texts.mapInArrow(run, NARROW_ENTRIES)


def hits(entries: DataFrame, buckets: int) -> DataFrame:
    """row, prints: per document the anchors that occur in another document too, in the index at least once."""
    _, bits = top_bits(buckets)

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        values, group = np.unique(bucket.prints, return_inverse=True)
        aligned = np.zeros(len(values), bool)
        aligned[group[(bucket.marks & ALIGNED) > 0]] = True
        yield from bucket.answers((aligned & (np.bincount(group, minlength=len(values)) > 1))[group])

    return merged(per_owner(meet(entries, judge, narrow_bits=bits)))


def merged(found: DataFrame) -> DataFrame:
    """One row per row hash: its prints come from several blocks if rows of the input are equal, but each from one of them."""
    return found.groupBy(F.col("key").alias("row")).agg(F.flatten(F.collect_list("prints")).alias("prints"))


def candidate_windows(own: Texts, prints: list[np.ndarray], window: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that hold a hit at one of their first places: fingerprint and document."""
    n, words = block_words(window), words_of(own)
    plain = word_prints(own, words)
    grams, at = word_windows(plain, words.offsets, n)
    of = owners(at, words.offsets)
    grams = cut_to_sent(grams, bits)
    hit = np.zeros(len(plain) + 1, np.int32)
    cuts = np.searchsorted(of, np.arange(own.count + 1))
    for i, useful in enumerate(prints):
        a, b = cuts[i], cuts[i + 1]
        hit[at[a:b][np.isin(grams[a:b], useful)]] = 1
    before = np.concatenate([[0], np.cumsum(hit)])
    full, begin = word_windows(plain, words.offsets, window, seed=1)
    reach = window - n + 1
    near = before[np.minimum(begin + reach, len(before) - 1)] > before[begin]
    return full[near], owners(begin[near], words.offsets)


def repeated(texts: DataFrame, found: DataFrame, buckets: int, window: int) -> DataFrame:
    """row, prints: per document its windows that a document with a smaller key has as well."""
    bucket_of, bits = top_bits(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bucket_of, with_ids=True)
        for batch in batches:
            for part, own in chunks(batch):
                useful = part.column("prints")
                each = [useful[i].values.to_numpy().view(np.uint64) for i in range(len(useful))]
                prints, of = candidate_windows(own, each, window, bits)
                rows, keys = (part.column(c).to_numpy()[of] for c in ("row", "key"))
                yield from packer.add(rows, prints, np.zeros(len(of), np.uint8), keys)
        yield from packer.flush()

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        values, group = np.unique(bucket.prints, return_inverse=True)
        least = np.full(len(values), np.iinfo(np.int64).max)
        np.minimum.at(least, group, bucket.ids)
        yield from bucket.answers(least[group] < bucket.ids)

    candidates = texts.join(found, "row").mapInArrow(run, NAMED_ENTRIES)
    return merged(per_owner(meet(candidates, judge)))


def strip(texts: DataFrame, removable: DataFrame, window: int, with_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in chunks(batch):
                known = part.column("prints")
                count, removed, digests, texts_left = [], [], [], []
                for i in range(own.count):
                    words = own.text(i).split()
                    gone = 0
                    if known[i].is_valid:
                        one = Texts(own.data[own.offsets[i] : own.offsets[i + 1]], np.array([0, own.offsets[i + 1] - own.offsets[i]]))
                        cut = words_of(one)
                        prints, at = word_windows(word_prints(one, cut), cut.offsets, window, seed=1)
                        out = covered(at[np.isin(prints, known[i].values.to_numpy().view(np.uint64))], window, len(words))
                        gone = int(out.sum())
                        left = b" ".join([w for w, x in zip(words, out.tolist(), strict=True) if not x])
                    else:
                        left = b" ".join(words)
                    count.append(len(words))
                    removed.append(gone)
                    digests.append(hashlib.sha256(left).hexdigest())
                    texts_left.append(left.decode() if with_text else None)
                columns = [part.column("key"), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(texts_left, pa.string())]
                yield pa.record_batch(columns, names=["key", "n_words", "n_removed", "kept_sha256", "kept"])

    return texts.join(removable, "row", "left").mapInArrow(run, RESULT)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept, the text that is left, on request).

    Words are runs of anything but ASCII white space. A word goes if a window of `window` words
    over it also begins in a document with a smaller id; rows without an id count as the largest, and
    rows of one id never remove each other's words. Null and empty texts have no words. An
    empty table gives no rows; other columns are not read.
    """
    texts = row_texts(docs, id_column, text_column)
    buckets = buckets_for(docs.sparkSession, text_bytes(texts))
    found = written(hits(anchors(texts, buckets, window), buckets), "anchor-hits")
    removable = written(repeated(texts, found, buckets, window), "repeated-windows")
    out = strip(texts, removable, window, with_text)
    return out.select(external_key("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256", *["kept"] * with_text)


__all__ = ["remove_repeats", "texts_of"]
