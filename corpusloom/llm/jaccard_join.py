"""Exact self-join of documents by the Jaccard similarity of their word shingles.

Token-group matrix: documents are partitioned into groups of likely partners, and each group is known by the union of
its members' tokens, as far as they can lead to a link: the first tokens of a document, in the order of how many documents have them.
Two linked documents have one of these in common, so a document none of whose first tokens occurs elsewhere links with nothing and leaves
at once. The others fall into the group of the first such token that is shared; near copies of a text
have nearly all of them in common and so make few groups. A group is opened for another only if their unions meet at a token that can be the
first one two linked documents have in common: the tokens a document has left from there on limit the size of a partner, and that limit must
reach the other group's smallest document at that token, in both directions. Inside an
opened pair a document is compared only if the tokens it has in common with the
other side's union reach the share that a link needs.

Everything is keyed by rows and sets, never by ids, which may be missing or repeated: a row is known by a 64-bit hash of its
id and text, and one row stands for all that have the same set.

Near copies in great number still make many small groups, all of which meet. So groups are gathered into families
first: each names, of the groups of about its size that have one of its tokens, the one with the lowest number, and those that name
the same one are a family. Families, and groups with many members, are cut into slices of bounded size, whole groups
staying together where they are small, and it is slices that are opened for each other, where any of their groups meet. Families decide how much is compared, never
the result. Every slice is first searched by itself, together with a few members of the family that all its slices share; slices whose members
are by then all connected need no further comparison, as more links would not change a
component. All others are compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import external_key, internal_key, keyed_texts, quoted, text_bytes, unused, written
from corpusloom.llm.components import components
from corpusloom.llm.grams import Texts, chunks, lowered, mixed, owners, word_prints, word_windows, words_of
from corpusloom.llm.packed_exchange import NARROW_ENTRIES, PER_OWNER, Bucket, Packer, buckets_for, cut_to_sent, lists, meet, top_bits

SHINGLE_WORDS, PERCENT = 5, 75
SLICE_MEMBERS, SHARED_MEMBERS = 512, 8
PROFILE = "row long, key long, n long, d1 long, d2 long"
#: Entries that a task holds before it hands on a block.
HELD_ENTRIES = 2 << 20
MATRIX = NARROW_ENTRIES + ", ids array<long>"
ASKED = "bucket long, block long, owners array<long>, steps binary, prints array<int>"
ANSWERED = ASKED + ", values array<int>"
#: A document's limit at a token is sent as one of eight steps of its own size: so many of these bits, from the lowest on (bit 1 is the packer's).
#: Marks that are merged by "or" so keep the largest limit.
_STEP_BITS = np.array([1, 4, 8, 16, 32, 64, 128], np.uint8)
_STEP_MARKS = np.concatenate([np.zeros(1, np.uint8), np.bitwise_or.accumulate(_STEP_BITS)])
_STEPS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None] & 253, axis=1).sum(axis=1)
#: Groups whose documents' sizes lie between two neighbouring powers of it are of about the same size.
SIZE_STEP = 1.1
#: Pairs that are looked at together.
PAIRS_HELD = 1 << 20


def shingles(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of each text, ascending: fingerprint and text index.

    A text of fewer words than a shingle has its whole word sequence as the only one.
    """
    texts = lowered(texts)
    words = words_of(texts)
    plain = word_prints(texts, words)
    prints, at = word_windows(plain, words.offsets, n)
    of = owners(at, words.offsets)
    count = words.per_text
    for m in range(1, n):
        which = np.flatnonzero(count == m)
        if len(which):
            begin = words.offsets[which]
            rows = np.concatenate([plain[begin + k] for k in range(m)]).reshape(m, -1).T.ravel()
            short, _ = word_windows(rows, np.arange(0, len(rows) + 1, m), m)
            prints, of = np.concatenate([prints, short]), np.concatenate([of, which])
    order = np.lexsort((prints, of))
    prints, of = prints[order], of[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (of[1:] != of[:-1])
    return prints[new], of[new]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Of n tokens in global order, so many that two linked sets share one of them."""
    return n - -(-percent * n // 100) + 1


def partner_limits(n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """The largest set that can link with one of n tokens if the first common token is the one at `place`.

    Of linked sets x and y, 100 * common >= percent * (x + y - common), and no more than n - place tokens are common.
    """
    return np.minimum((n - place) * (100 + percent) // percent - n, 100 * n // percent)


def limit_steps(percent: int) -> np.ndarray:
    """The upper ends of the steps, as shares of the document's own size: from the least a partner can have to the most."""
    least = percent / 100
    return np.concatenate([least + (1 - least) * np.array([0.2, 0.4, 0.6, 0.8, 0.98]), 1 + (1 / least - 1) * np.array([0.3, 0.65, 1.0])])


def profiles(texts: DataFrame, n: int) -> DataFrame:
    """Per document the size and digest of its set; per block the tokens that several of its documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in chunks(batch):
                prints, of = shingles(own, n)
                count = np.bincount(of, minlength=own.count)
                cuts = np.concatenate([[0], np.cumsum(count)])
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(prints, seed))]) for seed in (11, 12)]
                digests = [pa.array((s[cuts[1:]] - s[cuts[:-1]]).view(np.int64)) for s in sums]
                yield pa.record_batch([part.column("row"), part.column("key"), pa.array(count, pa.int64()), *digests], names=["row", "key", "n", "d1", "d2"])

    return texts.mapInArrow(run, PROFILE)


def _steps(places: np.ndarray) -> bytes:
    """Ascending numbers as their differences, each in as few bytes as the largest needs."""
    step = np.diff(places, prepend=0)
    most = int(step.max(initial=0))
    return step.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def _places(steps: bytes, count: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, f"<u{len(steps) // count}"), dtype=np.int64) if count else np.zeros(0, np.int64)


def _asked(block: int, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """A row per bucket of the block's tokens, document by document: the tokens, and whose they are as steps from one document to the next.

    The documents' keys go with the first row alone, so that a token costs the same in however many buckets.
    """
    keys, of, prints = zip(*held, strict=True)
    base = np.cumsum([0, *(len(k) for k in keys)])
    owner, prints = np.concatenate([o + at for o, at in zip(of, base[:-1], strict=True)]), np.concatenate(prints)
    bucket = top_bits(1 << bits)[0](prints)
    order = np.argsort(bucket, kind="stable")
    owner, bucket = owner[order], bucket[order]
    sent = (prints[order] >> np.uint64(32 - bits)).astype(np.uint32).view(np.int32)
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    rows = len(cuts) - 1
    return pa.record_batch(
        [
            pa.array(bucket[cuts[:-1]], pa.int64()), pa.array(np.full(rows, block), pa.int64()), lists(np.concatenate(keys), np.append(0, np.full(rows, base[-1])), pa.int64()),
            pa.array([_steps(owner[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), lists(sent, cuts),
        ],
        names=["bucket", "block", "owners", "steps", "prints"],
    )


def shared_tokens(texts: DataFrame, buckets: int, n: int) -> DataFrame:
    """key, prints, values: per document (keys are unique) the tokens that others have too, and how many documents have each.

    The global order goes by these counts; tokens count as one where what is sent of their fingerprints agrees.
    """
    _, bits = top_bits(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 20, [], 0
        for batch in batches:
            for part, own in chunks(batch):
                prints, of = shingles(own, n)
                held.append((part.column("key").to_numpy(), of, prints))
                size += len(of)
                if size >= HELD_ENTRIES:
                    yield _asked(block, held, bits)
                    block, held, size = block + 1, [], 0
        if size:
            yield _asked(block, held, bits)

    def judge(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).combine_chunks()
        prints, steps = column("prints"), column("steps").to_pylist()
        flat = prints.flatten().to_numpy()
        cuts = np.concatenate([[0], np.cumsum(np.diff(prints.offsets.to_numpy()))])
        _, group = np.unique(flat, return_inverse=True)
        count = np.bincount(group)[group]
        shared = count > 1
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        found = pa.table(
            [
                column("bucket"), column("block"), column("owners"), pa.array([_steps(_places(s, b - a)[shared[a:b]]) for s, (a, b) in zip(steps, spans, strict=True)], pa.binary()),
                lists(flat[shared], np.concatenate([[0], np.cumsum(shared)])[cuts]), lists(count[shared], np.concatenate([[0], np.cumsum(shared)])[cuts], pa.int32()),
            ],
            names=["bucket", "block", "owners", "steps", "prints", "values"],
        )
        return found.filter(pc.or_(pc.greater(pc.list_value_length(found.column("prints")), 0), pc.greater(pc.list_value_length(found.column("owners")), 0)))

    def gathered(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).combine_chunks()
        prints, size = column("prints"), pc.list_value_length(column("prints")).to_numpy()
        owner = np.concatenate([_places(s, k) for s, k in zip(column("steps").to_pylist(), size.tolist(), strict=True)])
        top = np.repeat(column("bucket").to_numpy().astype(np.uint64), size)
        top = top << np.uint64(64 - bits) if bits else top * np.uint64(0)
        full = top | (prints.flatten().to_numpy().view(np.uint32).astype(np.uint64) << np.uint64(32 - bits))
        order = np.argsort(owner, kind="stable")
        owner, cuts = owner[order], np.append(np.flatnonzero(np.diff(owner[order], prepend=-1)), len(owner))
        keys = column("owners").flatten().to_numpy()
        return pa.table(
            [pa.array(keys[owner[cuts[:-1]]], pa.int64()), lists(full[order].view(np.int64), cuts), lists(column("values").flatten().to_numpy()[order], cuts, pa.int64())], names=["key", "prints", "values"]
        )

    asked = texts.mapInArrow(run, ASKED)
    return asked.groupBy("bucket").applyInArrow(judge, ANSWERED).groupBy("block").applyInArrow(gathered, PER_OWNER)


def _ordered(part: pa.RecordBatch, own: Texts, bits: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text in global order (rare first, then by fingerprint), how many texts have each, their texts, and where each text's begin."""
    prints, of = shingles(own, n)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=own.count))])
    weight = np.ones(len(prints), np.int64)
    sent = cut_to_sent(prints, bits)
    known, counts = part.column("prints"), part.column("values")
    for i in np.flatnonzero(part.column("prints").is_valid().to_numpy(zero_copy_only=False)).tolist():
        a, b = cuts[i], cuts[i + 1]
        mine = known[i].values.to_numpy().view(np.uint64)
        by = np.argsort(mine)
        mine = mine[by]
        at = np.minimum(np.searchsorted(mine, sent[a:b]), len(mine) - 1)
        weight[a:b] = np.where(mine[at] == sent[a:b], counts[i].values.to_numpy()[by][at], 1)
    order = np.lexsort((prints, weight, of))
    return prints[order], weight[order], of, cuts


def matrix(weighed: DataFrame, buckets: int, n: int, percent: int) -> DataFrame:
    """The token-group matrix: the shared prefix tokens of each group, packed by token, with the sizes and limits of the documents that have them;
    and in rows of bucket -1 the members: keys, groups, set sizes, and as ids the tokens of each that others have too, from owner_at on."""
    bucket_of, bits = top_bits(buckets)
    steps = limit_steps(percent)[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bucket_of, bits, HELD_ENTRIES, with_ids=True)
        for batch in batches:
            for part, own in chunks(batch):
                prints, weight, of, cuts = _ordered(part, own, bits, n)
                size = np.diff(cuts)
                place = np.arange(len(of)) - cuts[:-1][of]
                useful = (place < prefix_length(size, percent)[of]) & (weight > 1)
                shared = prints[weight > 1], of[weight > 1]
                prints, of, place = prints[useful], of[useful], place[useful]
                some, at = np.unique(of, return_index=True)  # tokens are in order: the first one names the group
                if not len(some):
                    continue
                named = np.zeros(len(size), np.int64)
                named[some] = prints[at].view(np.int64)
                members = np.concatenate([part.column("key").to_numpy()[some], named[some], size[some]])
                known = np.isin(shared[1], some)
                ends = np.concatenate([[0], np.cumsum(np.bincount(shared[1], minlength=len(size))[some])])
                none = np.array([0, 0])
                yield pa.record_batch(
                    [pa.array([-1], pa.int64()), pa.array([0], pa.int64()), lists(members, np.array([0, len(members)]), pa.int64()), lists(ends.astype(np.int32), np.array([0, len(ends)])),
                     lists(np.zeros(0, np.int32), none), lists(np.zeros(0, np.int8), none), lists(shared[0][known].view(np.int64), np.array([0, ends[-1]]))],
                    names=["bucket", "block", "owners", "owner_at", "prints", "marks", "ids"],
                )
                # Documents of one group and size are one owner, so that near copies do not multiply the entries.
                owner = mixed(named.view(np.uint64) ^ mixed(size.astype(np.uint64), 21)).view(np.int64)
                step = np.searchsorted(steps, partner_limits(size[of], place, percent) / size[of], side="left")
                yield from packer.add(owner[of], cut_to_sent(prints, bits), _STEP_MARKS[step], np.stack([named, size], axis=1)[of])
        yield from packer.flush()

    return weighed.mapInArrow(run, MATRIX)


def group_members(packed: DataFrame) -> DataFrame:
    """key, group, n from the member rows of `matrix`."""
    third = F.floor(F.size("owners") / 3).cast("int")
    entry = F.transform(F.sequence(F.lit(0), third - 1), lambda i: F.struct(F.get("owners", i).alias("key"), F.get("owners", i + third).alias("group"), F.get("owners", i + 2 * third).alias("n")))
    return packed.filter("bucket < 0").select(F.inline(entry))


def near_enough(token: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of one token where each one's smallest set is within the other's limit, some at a time."""
    order = np.lexsort((least, token))
    least, most = least[order], most[order]
    span = int(max(least.max(initial=0), most.max(initial=0))) + 2
    base = token[order].astype(np.int64) * span
    count = np.maximum(np.searchsorted(base + least, base + most, side="right") - np.arange(len(order)) - 1, 0)
    total = np.cumsum(count)
    begin = 0
    while begin < len(order):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS_HELD, side="right")))
        many = count[begin:end]
        i = np.repeat(np.arange(begin, end), many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        fits = least[i] <= most[j]
        yield order[i[fits]], order[j[fits]]
        begin = end


def centres(entries: DataFrame, buckets: int, percent: int = PERCENT) -> DataFrame:
    """bucket, group, centre: per bucket its groups, and the lowest of the groups of about the same size that share a token with
    each (itself, if none does). Only tokens that a partner of the same size may have first count."""
    _, bits = top_bits(buckets)
    ends = limit_steps(percent)

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        group, n = bucket.ids[:, 0], bucket.ids[:, 1]
        close = ends[_STEPS_OF[bucket.marks]] >= 1
        cell = np.floor(np.log(n) / np.log(SIZE_STEP)).astype(np.int64)
        order = np.lexsort((group, cell, bucket.prints, ~close))[: int(close.sum())]
        prints, cell, mine = bucket.prints[order], cell[order], group[order]
        first = np.ones(len(order), bool)
        first[1:] = (prints[1:] != prints[:-1]) | (cell[1:] != cell[:-1])
        named = mine[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(order) else mine
        names, at = np.unique(group, return_inverse=True)
        least = names.copy()
        np.minimum.at(least, at[order], named)
        yield pa.record_batch([pa.array(np.full(len(names), bucket.bucket)), pa.array(names), pa.array(least)], names=["bucket", "group", "centre"])

    return meet(entries, judge, "bucket long, group long, centre long", bits)


def families(found: DataFrame, members: DataFrame, slice_members: int) -> DataFrame:
    """group, tile, family, slices, slice, from `centres` and `group_members`.

    A group of more than `slice_members` documents is a family and a tile by itself, in several slices (slice -1: each document has its own);
    the others are dealt whole to the slices of the family of their lowest centre, and each slice is a tile.
    """
    sizes = members.groupBy("group").agg(F.count("*").alias("size"))
    named = written(found.groupBy("group").agg(F.min("centre").alias("centre")).join(sizes, "group"), "group-centres")
    large = F.col("size") > slice_members
    slices = lambda size: F.ceil(F.col(size) / slice_members).cast("int")
    alone = named.filter(large).select("group", F.col("group").alias("tile"), F.col("group").alias("family"), slices("size").alias("slices"), F.lit(-1).alias("slice"))
    small = named.filter(~large)
    whole = small.groupBy("centre").agg(F.sum("size").alias("whole"))
    dealt = small.join(whole, "centre").select("group", F.xxhash64("centre", F.lit("family")).alias("family"), slices("whole").alias("slices"))
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("group"), "slices").cast("int"))
    return alone.union(dealt.select("group", F.xxhash64("family", "slice").alias("tile"), "family", "slices", "slice"))


def group_pairs(entries: DataFrame, buckets: int, percent: int = PERCENT, places: DataFrame | None = None) -> DataFrame:
    """g <= h: groups that share a prefix token within the limits of both; g = h for groups of more than one document.

    `places` (bucket, group, tile): pairs of tiles that hold such groups; g = h then only for some.
    """
    _, bits = top_bits(buckets)
    ends = limit_steps(percent)

    def judge(bucket: Bucket) -> Iterator[pa.RecordBatch]:
        by = np.lexsort((bucket.ids[:, 0], bucket.prints))
        prints, marks = bucket.prints[by], bucket.marks[by]
        group, n = bucket.ids[by, 0], bucket.ids[by, 1]
        limit = np.ceil(n * ends[_STEPS_OF[marks]] + 1e-6).astype(np.int64)
        new = np.ones(len(prints), bool)
        new[1:] = (prints[1:] != prints[:-1]) | (group[1:] != group[:-1])
        at = np.flatnonzero(new)
        several = (np.diff(np.append(at, len(prints))) > 1) | (np.bitwise_or.reduceat(marks, at) & 2 > 0)
        least, most = np.minimum.reduceat(n, at), np.maximum.reduceat(limit, at)
        prints, group = prints[at], group[at]
        own = several & (cut_to_sent(group.view(np.uint64), bits) == prints)
        pairs, held = [np.stack([group[own], group[own]], axis=1)], 0
        token = np.cumsum(np.append(False, prints[1:] != prints[:-1]))
        for i, j in near_enough(token, least, most):
            pairs.append(np.sort(np.stack([group[i], group[j]], axis=1), axis=1))
            held += len(i)
            if held > PAIRS_HELD:
                pairs, held = [np.unique(np.concatenate(pairs), axis=0)], 0
        found = np.unique(np.concatenate(pairs), axis=0)
        yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["g", "h"])

    if places is None:
        return meet(entries, judge, "g long, h long", bits).distinct()

    def run(table: pa.Table, placed: pa.Table) -> pa.Table:
        bucket = Bucket(table, bits)
        group, tile = (placed.column(c).to_numpy() for c in ("group", "tile"))
        by = np.argsort(group)
        bucket.ids = np.stack([tile[by][np.searchsorted(group[by], bucket.ids[:, 0])], bucket.ids[:, 1]], axis=1)
        return pa.Table.from_batches(list(judge(bucket)))

    return entries.groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(run, "g long, h long").distinct()


def token_sets(packed: DataFrame) -> DataFrame:
    """key, n, tokens from the member rows of `matrix`: a set's size, and those of its tokens that other sets have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owners, cuts, tokens in zip(*(batch.column(c) for c in ("owners", "owner_at", "ids")), strict=True):
                members = owners.values.to_numpy().reshape(3, -1)
                yield pa.record_batch([pa.array(members[0]), pa.array(members[2]), lists(tokens.values.to_numpy(), cuts.values.to_numpy(), pa.int64())], names=["key", "n", "tokens"])

    return packed.filter("bucket < 0").select("owners", "owner_at", "ids").mapInArrow(run, "key long, n long, tokens array<long>")


def links(sets: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """Labels after joining every left set with the right sets it links to; equal labels are connected already.

    `sizes` also counts the tokens that no other set has, which `sets` leave out.
    """
    given = np.array([len(s) for s in sets])
    cuts = np.concatenate([[0], np.cumsum(given)])
    tokens, token_at = np.unique(np.concatenate(sets), return_inverse=True)
    by = np.argsort(token_at, kind="stable")
    posting = np.repeat(np.arange(len(sets)), given)[by]
    begin = np.concatenate([[0], np.cumsum(np.bincount(token_at, minlength=len(tokens)))])
    right_df = np.bincount(token_at, weights=np.repeat(right, given), minlength=len(tokens))
    label = label.copy()
    for x in np.flatnonzero(left).tolist():
        fits = right & (label != label[x]) & (100 * sizes >= percent * sizes[x]) & (percent * sizes <= 100 * sizes[x])
        if not fits.any():
            continue
        mine = token_at[cuts[x] : cuts[x + 1]]
        mine = mine[right_df[mine] > (1 if right[x] else 0)]
        if 100 * len(mine) < percent * sizes[x]:  # the bound: the other side's union has too few of its tokens
            continue
        a, b = begin[mine], begin[mine + 1]
        size = b - a
        entries = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        shared = np.bincount(posting[entries], minlength=len(sets))
        for y in np.flatnonzero(fits & (100 * shared >= percent * (sizes[x] + sizes - shared))).tolist():
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
    return label


def search(members: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) found in each task of `members`: task, side (0: all against all), component, n, tokens. Edges may come from several tasks."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).combine_chunks()
        side, known, sizes = (column(c).to_numpy() for c in ("side", "component", "n"))
        tokens = column("tokens")
        flat, cuts = tokens.values.to_numpy().view(np.uint64), tokens.offsets.to_numpy()
        sets = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        label = np.unique(known, return_inverse=True)[1]
        got = links(sets, sizes, side <= 1, side != 1, label, percent)
        least = np.full(int(got.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, got, known)
        edge = known != least[got]
        return pa.table([pa.array(known[edge]), pa.array(least[got][edge])], names=["a", "b"])

    return members.groupBy("task").applyInArrow(run, "a long, b long")


def linked_rows(texts0: DataFrame, n: int, percent: int, slice_members: int) -> DataFrame:
    """row, key, n, component, least for every row of `texts0` (row, key, text): the component of the row's set and the smallest key in it."""
    buckets = buckets_for(texts0.sparkSession, text_bytes(texts0))
    documents = written(profiles(texts0, n), "set-profiles")
    classes = written(documents.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("row").alias("first"), F.min("key").alias("least")), "set-classes")
    # One text for each set; rows that are equal throughout combine before they are shuffled.
    chosen = texts0.join(classes.select(F.col("first").alias("row")), "row", "left_semi")
    texts = written(chosen.groupBy("row").agg(F.first("text").alias("text")).select(F.col("row").alias("key"), "text"), "one-of-each-set", compression="zstd")
    # Without a shared token there is no link: such texts are not read again.
    weighed = texts.join(written(shared_tokens(texts, buckets, n), "token-counts"), "key")
    packed = written(matrix(weighed, buckets, n, percent), "token-group-matrix")
    entries = packed.filter("bucket >= 0")
    every = written(group_members(packed), "group-members")
    around = written(centres(entries, buckets, percent), "groups-around")
    placed = written(families(around, every, slice_members), "families")
    met = written(group_pairs(entries, buckets, percent, around.join(placed, "group").select("bucket", "group", "tile")), "tile-pairs")
    # Tiles of unlike size cannot link, nor can a tile's only member with itself.
    where = every.join(placed, "group")
    bounds = where.groupBy("tile").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("size"))
    of = lambda side: bounds.toDF(*[f"{c}_{side}" for c in ("tile", "least", "most", "size")])
    pairs = (
        met.filter("g <> h").join(of("g"), F.col("g") == F.col("tile_g")).join(of("h"), F.col("h") == F.col("tile_h"))
        .filter((100 * F.col("most_g") >= percent * F.col("least_h")) & (100 * F.col("most_h") >= percent * F.col("least_g"))).select("g", "h")
    )
    pairs = written(pairs.union(bounds.filter("size > 1").select(F.col("tile").alias("g"), F.col("tile").alias("h"))), "open-pairs")
    opened = pairs.select(F.col("g").alias("tile")).union(pairs.select("h")).distinct()
    slice_of = F.when(F.col("slice") < 0, F.pmod(F.xxhash64("key"), "slices")).otherwise(F.col("slice")).cast("int")
    members = written(where.join(opened, "tile").select("key", F.col("family").alias("group"), slice_of.alias("slice"), "slices"), "open-members")
    sets = written(members.join(token_sets(packed), "key").select("key", "group", "slice", "slices", "n", "tokens"), "token-sets")

    # Each slice by itself, with the members that all slices of a family share.
    key_of = lambda *c: F.xxhash64(*c)
    cut = members.filter("slices > 1")
    chosen = cut.join(cut.groupBy("group").agg(F.count("*").alias("size")), "group").filter(F.pmod(F.xxhash64("key", F.lit(1)), "size") < SHARED_MEMBERS).select("key", "group")
    guests = sets.join(chosen, ["key", "group"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    alone = sets.union(guests.select(sets.columns)).select(
        key_of("group", "slice").alias("task"), F.lit(0).alias("side"), F.col("key").alias("component"), "n", "tokens"
    )
    first_edges = written(search(alone, percent), "edges-within")
    known = written(components(first_edges), "components-within")

    # Then slices against each other, where not all are connected yet.
    labelled = sets.select("key", "group", "slice").join(known, F.col("key") == F.col("node"), "left")
    labelled = written(labelled.select("key", "group", "slice", F.coalesce("component", "key").alias("component")), "labelled-members")
    spans = labelled.groupBy("group", "slice").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    tiles = placed.select("tile", "family", F.explode(F.when(F.col("slice") < 0, F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array("slice"))).alias("slice")).distinct()
    spots = written(tiles.join(spans.withColumnRenamed("group", "family"), ["family", "slice"]), "open-slices")
    left, right = (spots.select(*[F.col(c).alias(f"{c}_{s}") for c in ("tile", "family", "slice", "low", "high")]) for s in "gh")
    open_pairs = (
        pairs.join(left, F.col("g") == F.col("tile_g")).join(right, F.col("h") == F.col("tile_h"))
        .filter("(g <> h OR slice_g < slice_h) AND NOT (low_g = high_g AND low_h = high_h AND low_g = low_h)")
        .select(key_of("family_g", "slice_g", "family_h", "slice_h").alias("task"), F.col("family_g").alias("g"), "slice_g", F.col("family_h").alias("h"), "slice_h")
    )
    sides = open_pairs.select("task", F.lit(1).alias("side"), F.col("g").alias("group"), F.col("slice_g").alias("slice")).union(
        open_pairs.select("task", F.lit(2).alias("side"), "h", "slice_h")
    )
    across = sets.join(sides, ["group", "slice"]).join(labelled.select("key", "group", "component"), ["key", "group"])
    more = search(across.select("task", "side", "component", "n", "tokens"), percent)
    final = components(first_edges.union(more))

    nodes = written(
        classes.join(final, F.col("first") == F.col("node"), "left").select("n", "d1", "d2", "least", F.coalesce("component", "first").alias("component")), "set-components"
    )
    least = nodes.groupBy("component").agg(F.min("least").alias("least"))
    placed = nodes.drop("least").join(least, "component")
    return documents.join(placed, ["n", "d1", "d2"], "left").select("row", "key", "n", "component", "least")


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return keyed_texts(docs, id_column, text_column).select(F.xxhash64("key", "text").alias("row"), "key", "text")


def link_documents(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT, slice_members: int = SLICE_MEMBERS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when the intersection of their shingle sets is at least `percent` hundredths
    of the union; component_id is the smallest id that links lead to. Null texts
    and texts without words have no shingles and link with nothing. Every row is a document of its own, also
    without an id (which counts as the largest: a component without any id has a null one) or with an id that others have.
    An empty table gives no rows; other columns are not read.
    """
    found = linked_rows(_rows(docs, id_column, text_column), n, percent, slice_members)
    return found.select(external_key("key").alias("doc_id"), F.col("n").alias("n_shingles"), external_key(F.coalesce("least", "key")).alias("component_id"))


def keep_one_of_each(
    docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT, slice_members: int = SLICE_MEMBERS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One document of every component, that with the smallest id, with all its columns; every document without words.

    Of rows that repeat the id and the text of the one that stays, the row whose other columns hash lowest does.
    """
    found = written(linked_rows(_rows(docs, id_column, text_column), n, percent, slice_members), "linked-rows")
    stay = found.filter("n > 0").groupBy("component").agg(F.min(F.struct("key", "row")).alias("m")).select(F.col("m.row").alias("row"))
    often = found.groupBy("row").agg(F.count(F.lit(1)).alias("times"))
    name = unused(docs, "kept_row")
    stay = written(stay.join(often, "row").select(F.col("row").alias(name), "times"), "kept-rows")
    text = F.coalesce(F.col(quoted(text_column)), F.lit(""))
    marked = docs.withColumn(name, F.xxhash64(internal_key(F.col(quoted(id_column))), text))
    columns = [F.col(quoted(c)) for c in docs.columns]
    plain = [F.col(quoted(f.name)) for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    once = marked.join(stay.filter("times = 1").select(name), name, "left_semi").select(*columns)
    repeated = marked.join(stay.filter("times > 1").select(name), name, "left_semi")
    best = repeated.groupBy(name).agg(F.min_by(F.struct(*columns), F.xxhash64(*plain)).alias("best")).select("best.*")
    wordless = docs.filter(~text.rlike(r"[^\x20\x09-\x0D]"))
    return once.unionByName(best).unionByName(wordless)
