"""Which ids of two tokenizers stand for the same bytes, by inverted pair bitmaps.

Both tokenizers cut the same bytes; where both end a token, a group ends, and all ids of a group are linked.
Two questions need the whole corpus: in how many documents is a pair of ids linked, and which
pairs are the most frequent ones of their first id.

Documents stand in blocks, numbered from 0 in each. A block has, for every linked pair, a bitmap of
its documents, and further planes with the bits of (links - 1) in them. Bitmaps are stored the smaller way, as bits or as steps
between members. Rows carry the pairs of one hash bucket; those of a slice of blocks are merged
(blocks number their documents apart, so a merged bitmap is the blocks' bitmaps side by side), and counted by their members.
Counts are summed up over slices, some at a time. Each merged row then meets the counts
of its bucket and returns, block by block, what its pairs add to the scores of their documents.

A pair that every document holds is spread over as many rows as there are slices, and no row grows with the
corpus: slices have a fixed number of blocks, blocks a fixed number of text bytes, and pairs are bounded by the two vocabularies.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import external_key, keyed_texts, power_of_two, text_bytes, written
from corpusloom.llm.encoding import WITH_SPACE, _byte_letters, encoder
from corpusloom.llm.grams import chunks, mixed

BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 1 << 16
SLICE_BLOCKS = 64
#: Text bytes for each bucket of pairs. A document has a row of scores in every bucket with a pair of its own, so buckets stop growing;
#: slices do not.
BUCKET_BYTES = 32 << 20
MOST_BUCKETS = 128
#: A worker starts anew with its known units when it has met so many.
KNOWN_UNITS = 400_000
#: The places where `encoding` cuts for the byte-level vocabulary: before a blank or line end behind a visible character, between a
#: letter and a stop or comma, and behind a line end. No piece of the other vocabulary may reach across one (`_checked`).
UNITS = WITH_SPACE
PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
ACROSS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ][.,]|\n|[^▁]▁")
FAR = 255


# Arrays in one binary value.


def packed(*arrays: np.ndarray) -> bytes:
    parts = [struct.pack("<i", len(arrays))]
    for a in arrays:
        parts += [struct.pack("<4sq", a.dtype.str.encode()[:4].ljust(4), a.nbytes), a.tobytes()]
    return b"".join(parts)


def unpacked(value: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<i", value), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<4sq", value, at)
        at += 12
        dtype = np.dtype(kind.decode().strip())
        out.append(np.frombuffer(value, dtype, size // dtype.itemsize, at))
        at += size
    return out


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the length behind the last."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    values = np.sort(values)
    cuts = runs(values)
    return values[cuts[:-1]], np.diff(cuts)


def spread_out(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start .. start + size - 1 of every stretch, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


# Units: text that both tokenizers cut alike, its tokens and links.


class Aligner:
    """Aligns units of text; a unit met before is looked up."""

    def __init__(self, bytes_path: str, pieces_path: str):
        import sentencepiece

        self.encoder = encoder(bytes_path, True, True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        back = {c: b for b, c in _byte_letters().items()}
        vocabulary = self.encoder.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in back for c in token):
                self.a_bytes[number] = bytes(back[c] for c in token)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        if any(ACROSS.search(name) for name in names):
            raise ValueError("a piece of this vocabulary reaches across the places where texts are cut")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.b_count = len(names)
        self.written = np.array([str(i) for i in range(max(len(self.a_bytes), self.b_count))], object)
        self.blank = self.pieces.piece_to_id("▁")
        self.skipped = len(self.pieces.encode("\n"))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.strings: list[str] = []
        #: Per unit: tokens of A and B, groups, links, and whether its bytes came back.
        self.facts = np.zeros((0, 5), np.int64)
        self.pairs, self.links, self.cuts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _a_ids(self, units: list[str]) -> list[list[int]]:
        """One word of plain letters goes straight to the library's model."""
        tokenize, letters, plain = self.encoder.tokenizer.model.tokenize, self.encoder.written, PLAIN.fullmatch
        out = [[t.id for t in tokenize(unit.translate(letters))] if plain(unit) else None for unit in units]
        others = [i for i, ids in enumerate(out) if ids is None]
        for at in range(0, len(others), 20_000):
            part = others[at : at + 20_000]
            for i, got in zip(part, self.encoder.tokenizer.encode_batch_fast([units[i] for i in part], add_special_tokens=False), strict=True):
                out[i] = got.ids
        return out

    def _b_ids(self, units: list[str]) -> list[list[int]]:
        """The model puts a blank before its text, which stands for that of the unit; a unit without one follows a line end, whose ids go."""
        ids = self.pieces.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        return [[self.blank] if u == " " else i if u[0] == " " else i[self.skipped :] for u, i in zip(units, ids, strict=True)]

    def learn(self, units: list[str]) -> None:
        """Adds units that are not known yet."""
        n = len(units)
        raw = [u.encode() for u in units]
        a_ids, b_ids = self._a_ids(units), self._b_ids(units)
        (a, a_n), (b, b_n) = (
            (np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, n)) for ids in (a_ids, b_ids)
        )
        good = self._came_back(raw, a, a_n, b, b_n)
        a, b = a[np.repeat(good, a_n)], b[np.repeat(good, b_n)]
        a_n, b_n = a_n * good, b_n * good
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = b_end[a_end[np.minimum(np.searchsorted(a_end, b_end), max(len(a_end) - 1, 0))] == b_end] if len(a_end) else b_end
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        unit_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, n) * good)
        unit_of_group = np.searchsorted(unit_ends, ends)
        # Equal ids of a group count together before they are paired.
        (a_key, a_times), (b_key, b_times) = (counted(g << 17 | ids) for g, ids in ((a_group, a), (b_group, b)))
        b_cuts = np.searchsorted(b_key >> 17, np.arange(len(ends) + 1))
        group = a_key >> 17
        partners = (b_cuts[1:] - b_cuts[:-1])[group]
        mates = spread_out(b_cuts[group], partners)
        left = np.repeat(np.arange(len(a_key)), partners)
        key = unit_of_group[group[left]] << 32 | (a_key[left] & 0x1FFFF) * self.b_count + (b_key[mates] & 0x1FFFF)
        times = a_times[left] * b_times[mates]
        order = np.argsort(key)
        key, times = key[order], times[order]
        cuts = runs(key)[:-1] if len(key) else np.zeros(0, np.int64)
        pairs, owner, links = key[cuts] & 0xFFFFFFFF, key[cuts] >> 32, np.add.reduceat(times, cuts) if len(cuts) else times
        facts = np.stack([a_n, b_n, np.bincount(unit_of_group, minlength=n), np.bincount(owner, links, minlength=n).astype(np.int64), good], axis=1)
        self.known.update(zip(units, range(len(self.strings), len(self.strings) + n), strict=True))
        self.strings += self._group_strings(a, a_group, b, b_group, facts)
        self.facts = np.concatenate([self.facts, facts])
        self.cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(np.bincount(owner, minlength=n))])
        self.pairs, self.links = np.concatenate([self.pairs, pairs]), np.concatenate([self.links, links])

    def _came_back(self, raw: list[bytes], a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> np.ndarray:
        """Per unit: do the tokens of both tokenizers join to its bytes?"""
        good = np.ones(len(raw), bool)
        sizes = np.array([len(r) for r in raw])
        for ids, counts, table, table_sizes in ((a, a_n, self.a_bytes, self.a_sizes), (b, b_n, self.b_bytes, self.b_sizes)):
            ends = np.concatenate([[0], np.cumsum(counts)])
            got = np.concatenate([[0], np.cumsum(table_sizes[ids])])[ends]
            if (np.diff(got) == sizes).all() and b"".join(map(table.__getitem__, ids.tolist())) == b"".join(raw):
                continue
            for i, unit in enumerate(raw):
                good[i] &= b"".join(map(table.__getitem__, ids[ends[i] : ends[i + 1]].tolist())) == unit
        return good

    def _group_strings(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, facts: np.ndarray) -> list[str]:
        """Per unit `a1,a2|b1;a3|b2;`."""
        side = np.concatenate([a_group * 2, b_group * 2 + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        last = np.append(np.diff(side) != 0, True) if len(side) else np.zeros(0, bool)
        mark = np.where(~last, 0, 1 + side % 2)
        text = np.empty(2 * len(order), object)
        text[::2] = self.written[np.concatenate([a, b])[order]]
        text[1::2] = np.array([",", "|", ";"], object)[mark]
        parts = text.tolist()
        ends = np.cumsum(2 * (facts[:, 0] + facts[:, 1])).tolist()
        return ["".join(parts[begin:end]) for begin, end in zip([0, *ends[:-1]], ends, strict=True)]

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The units of every text (with a blank before it) by number, and how many each text has; an empty text has none."""
        cut = [UNITS.findall(" " + t) if t else [] for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        if len(self.known) > KNOWN_UNITS:
            self.clear()
        units = list(chain.from_iterable(cut))
        found = list(map(self.known.get, units))
        unmet = [i for i, number in enumerate(found) if number is None]
        if unmet:
            new = list({units[i]: None for i in unmet})
            for at in range(0, len(new), 100_000):
                self.learn(new[at : at + 100_000])
            for i in unmet:
                found[i] = self.known[units[i]]
        return np.array(found, np.int64), counts


@lru_cache(maxsize=1)
def aligner(bytes_path: str, pieces_path: str) -> Aligner:
    return Aligner(bytes_path, pieces_path)


# Bitmaps of the documents of a block.


def stored_bitmaps(members: np.ndarray, cuts: np.ndarray, docs: int) -> tuple[np.ndarray, ...]:
    """Ascending document numbers of many bitmaps, bitmap i from cuts[i] to cuts[i + 1], as (sizes, steps, far, bits).

    A bitmap of more than an eighth of the documents is stored as bits, any other as one byte per step between members; a step of 255 or
    more stands in `far`.
    """
    sizes = np.diff(cuts)
    dense = sizes * 8 > docs
    of = np.repeat(np.arange(len(sizes)), sizes)
    grid = np.zeros((int(dense.sum()), docs), bool)
    in_dense = dense[of]
    grid[(np.cumsum(dense) - 1)[of[in_dense]], members[in_dense]] = True
    steps = np.diff(members, prepend=0)
    steps[cuts[:-1][sizes > 0]] = members[cuts[:-1][sizes > 0]]
    steps = steps[~in_dense]
    return sizes.astype("<u4"), np.minimum(steps, FAR).astype("u1"), steps[steps >= FAR].astype("<u2"), np.packbits(grid, axis=1).ravel()


def read_bitmaps(docs: int, sizes: np.ndarray, steps: np.ndarray, far: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The members of all bitmaps, in order."""
    sizes = sizes.astype(np.int64)
    dense = sizes * 8 > docs
    of = np.repeat(np.arange(len(sizes)), sizes)
    out = np.empty(len(of), np.int64)
    in_dense = dense[of]
    if dense.any():
        out[in_dense] = np.nonzero(np.unpackbits(bits.reshape(int(dense.sum()), -1), axis=1, count=docs))[1]
    walk = steps.astype(np.int64)
    walk[walk == FAR] = far
    total = np.cumsum(walk)
    sparse = sizes * ~dense
    first = np.cumsum(sparse) - sparse
    has = sparse > 0
    base = np.zeros(len(sizes), np.int64)
    base[has] = total[first[has]] - walk[first[has]]
    out[~in_dense] = total - np.repeat(base, sparse)
    return out


def planes_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (pair * 32 + plane) and documents: plane 0 has every entry, plane i + 1 those with bit i in times - 1."""
    keys, docs, rest, bit = [pair * 32], [doc], times - 1, 1
    some = np.flatnonzero(rest)
    pair, doc, rest = pair[some], doc[some], rest[some]
    while len(rest):
        on = (rest & 1) == 1
        keys.append(pair[on] * 32 + bit)
        docs.append(doc[on])
        keep = rest > 1
        pair, doc, rest, bit = pair[keep], doc[keep], rest[keep] >> 1, bit + 1
    return np.concatenate(keys), np.concatenate(docs)


def linked(units: np.ndarray, docs: np.ndarray, known: Aligner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, document, links) of the documents' units, ordered; a unit that repeats in a document is opened once."""
    seen, often = counted(docs << 32 | units)
    docs, units = seen >> 32, seen & 0xFFFFFFFF
    n_pairs = known.cuts[units + 1] - known.cuts[units]
    places = spread_out(known.cuts[units], n_pairs)
    key, times = known.pairs[places] << 16 | np.repeat(docs, n_pairs), known.links[places] * np.repeat(often, n_pairs)
    if times.max(initial=0) < 1 << 16:  # key and links fit one integer
        both = np.sort(key << 16 | times)
        key, times = both >> 16, both & 0xFFFF
    else:
        order = np.argsort(key)
        key, times = key[order], times[order]
    cuts = runs(key)[:-1] if len(key) else np.zeros(0, np.int64)
    key, times = key[cuts], np.add.reduceat(times, cuts) if len(cuts) else times
    return key >> 16, key & 0xFFFF, times


def block_rows(keys: np.ndarray, docs: np.ndarray, n_docs: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Per bucket of pairs its bitmaps."""
    whole = bucket_of(keys >> 5, buckets).astype(np.uint64) << np.uint64(52) | keys.astype(np.uint64) << np.uint64(16) | docs.astype(np.uint64)
    whole.sort()
    bucket, keys, docs = (whole >> np.uint64(52)).astype(np.int64), (whole >> np.uint64(16) & np.uint64((1 << 36) - 1)).astype(np.int64), (whole & np.uint64(0xFFFF)).astype(np.int64)
    cuts = runs(bucket) if len(bucket) else [0]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        inner = runs(keys[begin:end])
        yield int(bucket[begin]), packed(keys[begin:end][inner[:-1]], *stored_bitmaps(docs[begin:end], inner, n_docs))


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(pairs.astype(np.uint64), 12) % np.uint64(buckets)).astype(np.int64)


# The jobs.

ROWS = "block long, bucket long, docs long, payload binary"


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _sliced(rows: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in rows:
        for i in range(batch.num_rows):  # one row at a time: rows are large
            yield batch.slice(i, 1).to_pylist()[0]


def _grouped(rows: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows that arrive sorted, by key; a group is read while it arrives."""
    return groupby(_sliced(rows), key=lambda row: tuple(row[n] for n in names))


def _posted(texts: DataFrame, bytes_path: str, pieces_path: str, buckets: int, block_bytes: int) -> DataFrame:
    """Per block one row (bucket -1) with facts of its documents, and one row per bucket with its bitmaps."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                for part, _ in chunks(whole.slice(at, BLOCK_DOCS), "text", block_bytes):
                    units = aligner(bytes_path, pieces_path)
                    number, counts = units.numbers(part.column("text").to_pylist())
                    n_docs, doc = len(counts), np.repeat(np.arange(len(counts)), counts)
                    bad = np.bincount(doc, units.facts[number, 4] == 0, minlength=n_docs) > 0
                    usable = ~bad[doc]
                    number, doc = number[usable], doc[usable]
                    sums = [np.bincount(doc, units.facts[number, i], minlength=n_docs).astype(np.int64) for i in range(4)]
                    ends = np.searchsorted(doc, np.arange(n_docs + 1)).tolist()
                    strings = list(map(units.strings.__getitem__, number.tolist()))
                    prints = b"".join(
                        hashlib.sha256("".join(strings[b:e])[:-1].encode()).digest() if e > b else bytes(32) for b, e in zip(ends[:-1], ends[1:], strict=True)
                    )
                    facts = packed(part.column("key").to_numpy(zero_copy_only=False), *sums, np.frombuffer(prints, "u1"))
                    yield _batch([[block], [-1], [n_docs], [facts]], ROWS)
                    rows = list(block_rows(*planes_of(*linked(number, doc, units)), n_docs, buckets))
                    if rows:
                        n = len(rows)
                        yield _batch([[block] * n, [r[0] for r in rows], [n_docs] * n, [r[1] for r in rows]], ROWS)
                    block += 1

    posted = texts.mapInArrow(post, ROWS)
    return posted.withColumn("block", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("block"))


MERGED = "block long, bucket long, slice long, docs long, counts binary, payload binary"


def _merged(posted: DataFrame, slices: int, parts: int) -> DataFrame:
    """Facts rows as they are; else one row per bucket and slice: counts of its pairs, and its blocks' bitmaps side by side."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, part), rows in _grouped(batches, "bucket", "slice"):
            if bucket < 0:
                for row in rows:
                    yield _batch([[row["block"]], [-1], [part], [row["docs"]], [None], [row["payload"]]], MERGED)
                continue
            held = list(rows)  # at most the blocks of one slice
            pairs, sizes = [], []
            for row in held:
                keys, size, *_ = unpacked(row["payload"])
                pairs.append(keys[keys % 32 == 0] >> 5)
                sizes.append(size[keys % 32 == 0])
            merged, place = np.unique(np.concatenate(pairs), return_inverse=True)
            counts = np.bincount(place, np.concatenate(sizes)).astype("<i8")
            index = packed(np.array([r["block"] for r in held], "<i8"), np.array([r["docs"] for r in held], "<i8"), np.array([len(r["payload"]) for r in held], "<i8"))
            payload = struct.pack("<q", len(index)) + index + b"".join(r["payload"] for r in held)
            yield _batch([[0], [bucket], [part], [0], [packed(merged, counts)], [payload]], MERGED)

    sliced = posted.withColumn("slice", F.when(F.col("bucket") < 0, F.col("block")).otherwise(F.pmod(F.xxhash64("block"), F.lit(slices))))
    dealt = sliced.repartition(parts, "bucket", "slice").sortWithinPartitions("bucket", "slice", "block")
    return dealt.mapInArrow(merge, MERGED)


def _total_counts(merged: DataFrame, slices: int, parts: int) -> DataFrame:
    """bucket, counts (pairs and in how many documents each is linked): slices are added up, so many at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, part), rows in _grouped(batches, "bucket", "slice"):
            pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for row in rows:  # never more than the distinct pairs of the bucket
                more, times = unpacked(row["counts"])
                pairs, place = np.unique(np.concatenate([pairs, more]), return_inverse=True)
                both, counts = np.concatenate([counts, times]), np.zeros(len(pairs), np.int64)
                np.add.at(counts, place, both)
            yield _batch([[bucket], [part], [packed(pairs, counts)]], "bucket long, slice long, counts binary")

    rows = merged.filter("bucket >= 0").select("bucket", "slice", "counts")
    while True:
        slices = -(-slices // SLICE_BLOCKS)
        rows = rows.withColumn("slice", F.floor(F.col("slice") / SLICE_BLOCKS)).repartition(parts, "bucket", "slice").sortWithinPartitions("bucket", "slice")
        rows = written(rows.mapInArrow(add, "bucket long, slice long, counts binary"), "pair-counts")
        if slices == 1:
            return rows.select("bucket", "counts")


def _highest(counts: DataFrame, a_ids: int, b_count: int) -> np.ndarray:
    """Per first id the highest count of its pairs; as many numbers as the vocabulary has ids."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(a_ids, np.int64)
        for row in _sliced(batches):
            pairs, times = unpacked(row["counts"])
            np.maximum.at(top, pairs // b_count, times)
        ids = np.flatnonzero(top)
        yield _batch([ids, top[ids]], "a long, n long")

    out = np.zeros(a_ids, np.int64)
    for row in counts.mapInArrow(best, "a long, n long").groupBy("a").agg(F.max("n").alias("n")).collect():
        out[row.a] = row.n
    return out


def narrowed(values: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _scores(merged: DataFrame, counts: DataFrame, highest: np.ndarray, b_count: int) -> DataFrame:
    """Per row and block: which documents gain how much (sum of counts, links of the highest count)."""
    schema = "block long, payload binary"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _sliced(batches):
            pairs, totals = unpacked(row["totals"])
            top = totals == highest[pairs // b_count]
            payload = row["payload"]
            (head,) = struct.unpack_from("<q", payload)
            blocks, docs, sizes = unpacked(payload[8 : 8 + head])
            at = 8 + head
            for block, n_docs, size in zip(blocks.tolist(), docs.tolist(), sizes.tolist(), strict=True):
                keys, *bitmap = unpacked(payload[at : at + size])
                at += size
                members, cards = read_bitmaps(n_docs, *bitmap), bitmap[0].astype(np.int64)
                place = np.searchsorted(pairs, keys >> 5)
                plane = keys & 31
                weight = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
                order = np.argsort(members.astype("u2"), kind="stable")
                cuts = runs(members[order])[:-1]
                gain, best = (np.add.reduceat(np.repeat(w, cards)[order], cuts) for w in (weight * totals[place], weight * top[place]))
                yield _batch([[block], [packed(members[order][cuts].astype("<u2"), narrowed(gain), narrowed(best))]], schema)

    both = merged.filter("bucket >= 0").select("bucket", "payload").join(counts.withColumnRenamed("counts", "totals"), "bucket")
    return both.mapInArrow(score, schema)


OUTPUT = "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(
    docs: DataFrame, bytes_path: str, pieces_path: str, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A text that is null or empty, or that either tokenizer does not give back byte by byte, has zeros and an empty
    digest. Every row is a document of its own, also when it repeats an id or a whole row; a null id stays null. An
    empty table gives no rows. Texts are read whole. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = keyed_texts(docs, id_column, text_column)
    size = text_bytes(texts)
    buckets = min(MOST_BUCKETS, power_of_two(size / BUCKET_BYTES, 16))
    slices = max(1, -(-size // (block_bytes * SLICE_BLOCKS)))
    parts = max(spark.sparkContext.defaultParallelism, -(-size // (32 << 20)))
    merged = written(_merged(_posted(texts, bytes_path, pieces_path, buckets, block_bytes), slices, parts), "pair-bitmaps")
    counts = _total_counts(merged, slices, parts)
    import sentencepiece

    b_count = sentencepiece.SentencePieceProcessor(model_file=pieces_path).vocab_size()
    a_ids = encoder(bytes_path, True, True).tokenizer.get_vocab_size()
    scores = _scores(merged, counts, _highest(counts, a_ids, b_count), b_count)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "block"):
            facts, gain, best = None, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
            for row in rows:
                if row["kind"] == 0:
                    facts = unpacked(row["payload"])
                else:
                    places, more, tops = unpacked(row["payload"])
                    gain[places] += more.astype(np.int64)
                    best[places] += tops.astype(np.int64)
            key, n_a, n_b, n_groups, n_links, prints = facts
            n = len(key)
            hexes = prints.tobytes().hex()
            shown = [hexes[64 * i : 64 * i + 64] if has else "" for i, has in enumerate((n_a > 0).tolist())]
            yield _batch([key, n_a, n_b, n_groups, n_links, best[:n], gain[:n], shown], OUTPUT)

    known = merged.filter("bucket < 0").select("block", F.lit(0).alias("kind"), "payload")
    both = known.unionByName(scores.select("block", F.lit(1).alias("kind"), "payload"))
    done = both.repartition(parts, "block").sortWithinPartitions("block", "kind").mapInArrow(finish, OUTPUT)
    return done.select(external_key("key").alias("doc_id"), *[c.split()[0] for c in OUTPUT.split(", ")[1:]])


