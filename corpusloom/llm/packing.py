"""Cost-balanced packing of documents into sequences of bounded length.

A document of n tokens costs `linear * n + quadratic * n * n` to attend to. Documents
are taken in descending length; each goes to the cheapest sequence of its block that
has room for the whole of it. Documents longer than a sequence are first cut into full
sequences and a rest. A document that no sequence of the block can hold whole is cut
over the cheapest ones, so every sequence of a block but the last few is full.

Blocks bound the memory: a task packs the rows of its own split in blocks of at most
`block_tokens` ids, so nothing is shuffled, no group can be hot, and a repeated task
gives the same sequences.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corpusloom.llm.common import external_key, keyed_texts
from corpusloom.llm.encoding import encoder
from corpusloom.llm.grams import chunks

SEQUENCE_TOKENS = 4096
BLOCK_TOKENS = 1 << 24
#: Attention's share: at 4,096 tokens the quadratic part is about as dear as the linear one.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
PIECES = "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Piece:
    document: int
    start: int
    length: int
    sequence: int
    offset: int


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[Piece]:
    """Pieces of documents of the given lengths in sequences 0, 1, ... of at most `capacity` tokens."""
    pieces: list[Piece] = []
    rests: list[tuple[int, int, int]] = []  # length, document, start
    sequence = 0
    for document, length in enumerate(lengths.tolist()):
        start = 0
        while length - start >= capacity:
            pieces.append(Piece(document, start, capacity, sequence, 0))
            sequence, start = sequence + 1, start + capacity
        if start < length:
            rests.append((length - start, document, start))
    rests.sort(key=lambda r: (-r[0], r[1]))
    many = -(-sum(r[0] for r in rests) // capacity)
    cost = np.zeros(many)
    room = np.full(many, capacity, np.int64)
    # Waiting documents by descending length; the rest of a cut one comes back.
    waiting = [(-length, document, start) for length, document, start in rests]
    heapq.heapify(waiting)
    while waiting:
        length, document, start = heapq.heappop(waiting)
        length = -length
        fits = np.flatnonzero(room >= length)
        open_ones = fits if len(fits) else np.flatnonzero(room > 0)
        at = int(open_ones[np.argmin(cost[open_ones])])
        taken = min(length, int(room[at]))
        pieces.append(Piece(document, start, taken, sequence + at, capacity - int(room[at])))
        room[at] -= taken
        cost[at] += linear * taken + quadratic * taken * taken
        if taken < length:
            heapq.heappush(waiting, (taken - length, document, start + taken))
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    keeps_space: bool,
    end_id: int = 2,
    capacity: int = SEQUENCE_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    id_column: str = "doc_id",
    text_column: str = "text",
    plain_specials: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `start` counts the document's ids before the piece, `offset` the ids before it in its
    sequence, `ids_crc32` covers the piece's ids as little-endian unsigned 32-bit integers.
    A null or empty text is one piece of the end id. Rows repeating an id, or without one,
    are documents of their own. An empty table gives no row; other columns are not read.
    A sequence id holds the input partition, the block and the sequence in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keeps_space, plain_specials).encode
        partition = TaskContext.get().partitionId()
        block, keys, ids, held = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in ids], np.int64)
            got = assign(lengths, capacity, linear, quadratic)
            crc = [zlib.crc32(ids[p.document][p.start : p.start + p.length].astype("<u4").tobytes()) for p in got]
            base = (partition << 40) + (block << 20)
            columns = (
                [keys[p.document] for p in got], [p.start for p in got], [p.length for p in got], crc,
                [int(lengths[p.document]) for p in got], [base + p.sequence for p in got], [p.offset for p in got],
            )
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for part, _ in chunks(batch):
                for key, got in zip(part.column("key").to_pylist(), encode(part.column("text").to_pylist(), end_id), strict=True):
                    if ids and held + len(got) > block_tokens:
                        yield flush()
                        block, keys, ids, held = block + 1, [], [], 0
                    keys.append(key)
                    ids.append(got)
                    held += len(got)
        if ids:
            yield flush()

    packed = keyed_texts(docs, id_column, text_column).mapInArrow(run, PIECES)
    return packed.select(external_key("key").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
