"""Fingerprints of many documents met by value, packed as arrays.

A row per fingerprint would cost more than the text itself. Here every task packs what it has
read into one row per bucket of the fingerprint space: the fingerprints as an array of
integers, and for each of them which of the row's owners (documents, groups) it belongs to.
A fingerprint occurs once per owner and row, so a passage copied thousands of
times costs one entry per document. Buckets are as many as the text needs to keep each at a few megabytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.common import power_of_two
from corpusloom.llm.grams import mixed

ENTRIES = "bucket long, block long, owners array<long>, owner_at array<int>, prints array<long>, marks array<byte>"
LED_ENTRIES = ENTRIES + ", leads array<int>"
NAMED_ENTRIES = ENTRIES + ", ids array<long>"
NARROW_ENTRIES = ENTRIES.replace("prints array<long>", "prints array<int>")
FOUND = "block long, owners array<long>, owner_at array<int>, prints array<long>, values array<long>"
PER_OWNER = "key long, prints array<long>, values array<long>"
BUCKET_BYTES = 8 << 20
BLOCK_ENTRIES = 4 << 20


def buckets_for(spark: SparkSession, n_bytes: int) -> int:
    """A power of two: one bucket per few megabytes of text, and enough to keep every core busy."""
    return power_of_two(max(n_bytes / BUCKET_BYTES, spark.sparkContext.defaultParallelism * 4), 16)


def lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))


class Packer:
    """Gathers (owner, print, mark) of one task and gives a row per bucket, block by block.

    `bucket_of` maps prints (or the leads, where they are given) to buckets. With `narrow_bits` the bucket is the print's top bits and only the 32 bits below
    them travel. Equal (owner, print) pairs of a block become one entry whose mark is the bitwise or of theirs, with bit 1
    (value 2) set when there was more than one. With `with_ids` the further column of `add` is no lead but a
    number of the owner (or a row of numbers), sent once per owner and row.
    """

    def __init__(
        self, bucket_of: Callable[[np.ndarray], np.ndarray], narrow_bits: int | None = None, block_entries: int = BLOCK_ENTRIES, with_ids: bool = False
    ):
        self.bucket_of, self.narrow_bits, self.block_entries, self.with_ids = bucket_of, narrow_bits, block_entries, with_ids
        self.block = TaskContext.get().partitionId() << 20
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, owners: np.ndarray, prints: np.ndarray, marks: np.ndarray, *leads: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((owners, prints, marks, *leads))
        self.size += len(prints)
        if self.size >= self.block_entries:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        owners, prints, marks, *leads = (np.concatenate(parts) for parts in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        names, begin, owner = np.unique(owners, return_index=True, return_inverse=True)
        ids = leads.pop()[begin] if self.with_ids else None
        order = np.lexsort((owner, prints))
        owner, prints, marks = owner[order], prints[order], marks[order]
        first = np.ones(len(prints), bool)
        first[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(first)
        more = np.diff(np.append(at, len(prints))) > 1
        marks = np.bitwise_or.reduceat(marks, at) | (more.astype(np.uint8) << 1)
        lead = leads[0][order][at] if leads else None
        owner, prints = owner[at], prints[at]
        bucket = self.bucket_of(prints if lead is None else lead)
        order = np.argsort(bucket, kind="stable")
        bucket, owner, prints, marks = bucket[order], owner[order], prints[order], marks[order]
        lead = None if lead is None else lead[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        block, self.block = self.block, self.block + 1
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine, where = np.unique(owner[a:b], return_inverse=True)
            sent = prints[a:b]
            if self.narrow_bits is not None:
                sent = (sent >> np.uint64(32 - self.narrow_bits)).astype(np.uint32).view(np.int32)
            else:
                sent = sent.view(np.int64)
            extra = [lists(ids[mine].ravel(), np.array([0, ids[mine].size]), pa.int64())] if self.with_ids else [] if lead is None else [lists((lead[a:b] >> np.uint64(32)).astype(np.uint32).view(np.int32), np.array([0, b - a]))]
            yield pa.record_batch(
                [
                    pa.array([int(bucket[a])], pa.int64()), pa.array([block], pa.int64()),
                    lists(names[mine], np.array([0, len(mine)]), pa.int64()), lists(where.astype(np.int32), np.array([0, b - a])),
                    lists(sent, np.array([0, b - a])), lists(marks[a:b].view(np.int8), np.array([0, b - a])), *extra,
                ],
                names=["bucket", "block", "owners", "owner_at", "prints", "marks", *["ids" if self.with_ids else "leads"] * len(extra)],
            )


class Bucket:
    """All entries of one bucket: row, owner, print and mark of each, and the rows' blocks."""

    def __init__(self, table: pa.Table, narrow_bits: int | None = None):
        column = lambda name: table.column(name).combine_chunks()
        self.blocks = column("block").to_numpy()
        self.bucket = int(column("bucket")[0].as_py())
        owners, owner_at, prints, marks = (column(c) for c in ("owners", "owner_at", "prints", "marks"))
        sizes = np.diff(owner_at.offsets.to_numpy())
        self.row = np.repeat(np.arange(len(self.blocks)), sizes)
        base = owners.offsets.to_numpy()
        self.names = owners.values.to_numpy()
        place = owner_at.flatten().to_numpy() + base[:-1][self.row]
        self.owner = self.names[place]
        ids = column("ids").values.to_numpy() if "ids" in table.column_names else None
        if ids is not None and len(ids) > len(self.names):
            ids = ids.reshape(len(self.names), -1)
        self.ids = None if ids is None else ids[place]
        raw = prints.flatten().to_numpy()
        if narrow_bits is None:
            self.prints = raw.view(np.uint64)
        else:
            top = np.uint64(self.bucket << (64 - narrow_bits)) if narrow_bits else np.uint64(0)
            self.prints = top | (raw.view(np.uint32).astype(np.uint64) << np.uint64(32 - narrow_bits))
        self.marks = marks.flatten().to_numpy().view(np.uint8)
        self.leads = column("leads").flatten().to_numpy().view(np.uint32) if "leads" in table.column_names else None

    def answers(self, chosen: np.ndarray, values: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """The chosen entries, a row for each block they came from. An owner that came from several blocks (equal
        rows of the input) is answered in the first of them, so that its answers are never more than its own prints."""
        if not chosen.any():
            return
        if len(np.unique(self.names)) < len(self.names):
            at = np.flatnonzero(chosen)
            at = at[np.lexsort((self.prints[at], self.owner[at]))]
            again = (self.prints[at[1:]] == self.prints[at[:-1]]) & (self.owner[at[1:]] == self.owner[at[:-1]])
            chosen = chosen.copy()
            chosen[at[1:][again]] = False
        row, owner, prints = self.row[chosen], self.owner[chosen], self.prints[chosen]
        values = np.zeros(0, np.int64) if values is None else values[chosen]
        cuts = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine, where = np.unique(owner[a:b], return_inverse=True)
            yield pa.record_batch(
                [
                    pa.array([int(self.blocks[row[a]])], pa.int64()), lists(mine, np.array([0, len(mine)])), lists(where.astype(np.int32), np.array([0, b - a])),
                    lists(prints[a:b].view(np.int64), np.array([0, b - a])), lists(values[a:b], np.array([0, len(values[a:b])]), pa.int64()),
                ],
                names=["block", "owners", "owner_at", "prints", "values"],
            )


def top_bits(buckets: int) -> tuple[Callable[[np.ndarray], np.ndarray], int]:
    bits = buckets.bit_length() - 1
    return (lambda prints: (prints >> np.uint64(64 - bits)).astype(np.int64)) if bits else (lambda prints: np.zeros(len(prints), np.int64)), bits


def cut_to_sent(prints: np.ndarray, bits: int) -> np.ndarray:
    """What of a fingerprint survives a narrow exchange: its top bits and the 32 below."""
    return prints & np.uint64((1 << 64) - (1 << (32 - bits)))


def meet(entries: DataFrame, judge: Callable[[Bucket], Iterator[pa.RecordBatch]], schema: str = FOUND, narrow_bits: int | None = None) -> DataFrame:
    """`judge` sees each bucket whole."""

    def run(table: pa.Table) -> pa.Table:
        got = list(judge(Bucket(table, narrow_bits)))
        return pa.Table.from_batches(got) if got else empty

    empty = _empty(entries.sparkSession, schema)
    return entries.groupBy("bucket").applyInArrow(run, schema)


def _empty(spark: SparkSession, schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema)).empty_table()


def per_owner(found: DataFrame) -> DataFrame:
    """key, prints, values: the answers of a block's buckets, put together for each owner."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).combine_chunks()
        owners, owner_at, prints, values = (column(c) for c in ("owners", "owner_at", "prints", "values"))
        row = np.repeat(np.arange(table.num_rows), np.diff(owner_at.offsets.to_numpy()))
        owner = owners.values.to_numpy()[owner_at.flatten().to_numpy() + owners.offsets.to_numpy()[:-1][row]]
        order = np.argsort(owner, kind="stable")
        owner, sent = owner[order], prints.flatten().to_numpy()[order]
        extra = values.flatten().to_numpy()
        extra = extra[order] if len(extra) else extra
        cuts = np.append(np.flatnonzero(np.diff(owner, prepend=owner[:1] - 1)), len(owner))
        return pa.table([pa.array(owner[cuts[:-1]]), lists(sent, cuts), lists(extra, cuts if len(extra) else cuts * 0, pa.int64())], names=["key", "prints", "values"])

    return found.groupBy("block").applyInArrow(run, PER_OWNER)


__all__ = ["Bucket", "ENTRIES", "FOUND", "LED_ENTRIES", "NAMED_ENTRIES", "NARROW_ENTRIES", "Packer", "buckets_for", "cut_to_sent", "lists", "meet", "mixed", "per_owner", "top_bits"]
