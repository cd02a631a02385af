"""Exact k-means over integer vectors, with the vectors of a cluster in a heap of bounds.

Every vector keeps one number: by how much its lower bound (distance to the second nearest
centroid) exceeded its upper bound (distance to its own) when it was last scanned. A round moves centroids; a
vector's gap then shrinks by at most the move of its own centroid plus the largest move of the others. These moves are summed per
cluster, and a gap is stored with the sum of that time added, so nothing stored changes while centroids
move: a heap per cluster has the vectors in the order in which their gaps expire. A round pops those whose gap is
used up, scans them against all centroids in exact integers, and pushes them into the heap of their nearest one.

Spark holds the vectors in blocks (rows of packed integers) with the heaps beside them. A round is one
row-wise pass over the blocks, which also gives the sums that moved from cluster to cluster; tasks add
theirs up before the sums are grouped. The driver sees centroids and sums only: clusters x components numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import quoted, written

BLOCK_VECTORS = 4_096
#: Larger components could push a squared distance of 64 components beyond 64 bits.
MOST = 1 << 27
#: Bounds are doubles; a gap below this share of the distances counts as used up.
SLACK = 1e-9
STATE = "ids binary, vectors binary, wide boolean, clusters binary, keys binary, heaps binary, sizes binary, moved array<long>"
_TYPES = (pa.binary(), pa.binary(), pa.bool_(), *[pa.binary()] * 4, pa.list_(pa.int64()))
_NAMES = [part.split()[0] for part in STATE.split(", ")]


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", size: int = 64, scale: int = 256) -> DataFrame:
    """vec_id and v (array of long, floor(scale * x)) of every vector of `size` finite components; all others go."""
    v = F.col(quoted(vector_column))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(v.isNotNull() & (F.size(v) == size) & finite).select(
        F.col(quoted(id_column)).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: str = "2") -> np.ndarray:
    """The vectors with the smallest sha256 of `seed:vec_id`; equal hashes (repeated ids) go by their components."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"), "v")
    return np.array([r.v for r in hashed.orderBy("h", "v").limit(clusters).collect()], np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors x centroids."""
    most = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if float(most) ** 2 * 4 * max(1, vectors.shape[1]) < 2**53:  # every partial sum is an integer that a double holds
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return np.rint((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for k, centroid in enumerate(centroids):
        out[:, k] = ((vectors - centroid) ** 2).sum(1)
    return out


def scan(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector its nearest centroid (ties: the smaller number) and the gap to the second nearest one."""
    squared = distances(vectors, centroids)
    nearest = squared.argmin(1)
    rows = np.arange(len(vectors))
    upper = np.sqrt(squared[rows, nearest].astype(np.float64))
    if len(centroids) == 1:
        return nearest, np.full(len(vectors), np.inf)
    others = squared.astype(np.float64)
    others[rows, nearest] = np.inf
    lower = np.sqrt(others.min(1))
    return nearest, lower - upper - SLACK * (lower + upper + 1)


class Block:
    """Vectors of one row with their clusters and the heaps of their gaps."""

    def __init__(self, row: dict, size: int, clusters: int):
        self.ids, self.wide = row["ids"], row["wide"]
        self.packed = row["vectors"]
        self.vectors = np.frombuffer(self.packed, "<i4" if self.wide else "<i2").reshape(-1, size).astype(np.int64)
        self.k = clusters
        self.clusters = np.frombuffer(row["clusters"], "<i4").copy()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(clusters)]
        if row["sizes"]:
            entries = list(zip(np.frombuffer(row["keys"], "<f8").tolist(), np.frombuffer(row["heaps"], "<i4").tolist(), strict=True))
            at = 0
            for cluster, n in enumerate(np.frombuffer(row["sizes"], "<i4").tolist()):
                self.heaps[cluster] = entries[at : at + n]
                at += n

    def expired(self, spent: np.ndarray) -> np.ndarray:
        """Pops every vector whose gap is used up; before the first round that is every vector."""
        if (self.clusters < 0).all():
            return np.arange(len(self.clusters))
        out = []
        for heap, limit in zip(self.heaps, spent.tolist(), strict=True):
            while heap and heap[0][0] <= limit:
                out.append(heappop(heap)[1])
        return np.array(out, np.int64)

    def round(self, centroids: np.ndarray, spent: np.ndarray) -> np.ndarray:
        """Rescans the expired; returns count and component sums that each cluster gained."""
        gained = np.zeros((self.k, 1 + self.vectors.shape[1]), np.int64)
        popped = self.expired(spent)
        if not len(popped):
            return gained
        before = self.clusters[popped]
        nearest, gap = scan(self.vectors[popped], centroids)
        for cluster, key, place in zip(nearest.tolist(), (gap + spent[nearest]).tolist(), popped.tolist(), strict=True):
            heappush(self.heaps[cluster], (key, place))
        self.clusters[popped] = nearest
        changed = np.flatnonzero(before != nearest)
        rows = self.vectors[popped[changed]]
        counted = np.concatenate([np.ones((len(rows), 1), np.int64), rows], axis=1)
        np.add.at(gained, nearest[changed], counted)
        left = before[changed] >= 0
        np.subtract.at(gained, before[changed][left], counted[left])
        return gained

    def row(self, gained: np.ndarray) -> list:
        entries = [e for heap in self.heaps for e in heap]
        keys, places = np.array([e[0] for e in entries], "<f8"), np.array([e[1] for e in entries], "<i4")
        sizes = np.array([len(heap) for heap in self.heaps], "<i4")
        return [self.ids, self.packed, self.wide, self.clusters.tobytes(), keys.tobytes(), places.tobytes(), sizes.tobytes(), gained.ravel()]


def _state_batch(rows: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(column), t) for column, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


def packed_blocks(vectors: DataFrame, block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """Rows of up to `block_vectors` vectors: 16-bit components where all of them fit, else 32-bit."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, block_vectors):
                batch = whole.slice(at, block_vectors)
                values = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                most = np.abs(values).max(initial=0)
                if most > MOST or most < 0:
                    raise ValueError(f"a component beyond {MOST} has squared distances beyond 64 bits")
                wide = bool(most > 32_767)
                given = batch.column("vec_id")
                ids = np.stack([given.fill_null(0).to_numpy(zero_copy_only=False), given.is_valid().to_numpy(zero_copy_only=False)], axis=1).astype("<i8")
                yield _state_batch([[ids.tobytes(), values.astype("<i4" if wide else "<i2").tobytes(), wide, np.full(len(ids), -1, "<i4").tobytes(), b"", b"", b"", []]])

    return vectors.mapInArrow(pack, STATE)


def _gains(state: DataFrame, clusters: int, size: int) -> np.ndarray:
    """Per cluster the count and sums that the last round brought, added up in tasks first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(clusters * (size + 1), np.int64)
        for batch in batches:
            total += batch.column("moved").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(total)).sum(0)
        places = np.flatnonzero(total)
        yield pa.record_batch([pa.array(places), pa.array(total[places])], names=["place", "n"])

    out = np.zeros(clusters * (size + 1), np.int64)
    summed = state.select("moved").mapInArrow(add, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # clusters x (components + 1) numbers at most
        out[row.place] = row.n
    return out.reshape(clusters, size + 1)


def cluster_vectors(
    vectors: DataFrame, clusters: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: str = "2",
    id_column: str = "vec_id", vector_column: str = "embedding", block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Null vectors, other lengths, and vectors with a null or non-finite component go. Rows without an id count
    as the id '' in the hash that picks the first centroids; rows that repeat an id are separate vectors. With
    fewer vectors than clusters, there are as many clusters as vectors. No vectors at all give no rows. Other columns are not read.
    A component beyond 2^27 after scaling is an error, since its distances would not fit 64 bits.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, id_column, vector_column, size, scale)
    centroids = first_centroids(whole, clusters, seed)
    k = len(centroids)
    output = "vec_id long, cluster int, distance long"
    if not k:
        empty = spark.createDataFrame([], output + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    state = packed_blocks(whole, block_vectors)
    spent, totals = np.zeros(k), np.zeros((k, size + 1), np.int64)

    def pass_over(now: np.ndarray, used: np.ndarray):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    block = Block(row, size, k)
                    yield _state_batch([block.row(block.round(now, used))])

        return step

    for turn in range(rounds + 1):
        state = written(state.mapInArrow(pass_over(centroids, spent), STATE), f"clusters-{turn}")
        if turn == rounds:
            break
        totals += _gains(state, k, size)
        filled = totals[:, 0] > 0
        moved = np.where(filled[:, None], totals[:, 1:] // np.maximum(totals[:, :1], 1), centroids)
        drift = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        order = np.sort(drift)
        # The largest move among the other clusters.
        others = np.where(drift == order[-1], order[-2] if k > 1 and (drift == order[-1]).sum() == 1 else order[-1], order[-1])
        spent, centroids = spent + drift + others, moved

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block({**row, "sizes": b""}, size, k)
                ids = np.frombuffer(row["ids"], "<i8").reshape(-1, 2)
                squared = ((block.vectors - centroids[block.clusters]) ** 2).sum(1)
                columns = [pa.array(ids[:, 0], mask=ids[:, 1] == 0), pa.array(block.clusters), pa.array(squared)]
                yield pa.record_batch(columns, names=["vec_id", "cluster", "distance"])

    rows = state.select("ids", "vectors", "wide", "clusters", "keys", "heaps", "sizes").mapInArrow(assigned, output)
    inertias = {r.cluster: r.n for r in rows.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = [(c, int(inertias.get(c, 0)), int(sum(inertias.values())), prints[c]) for c in range(k)]
    known = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each cluster: as small as the number of clusters asked for.
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clustering_sql(clusters: int = 40, rounds: int = 5) -> str:
    """The same result in plain SQL: every round scans all vectors against all centroids."""
    parts = [
        """v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
 FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS z
 FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM v ORDER BY h, v LIMIT {clusters}))""",
    ]
    nearest = "SELECT rid, arg_min(c, d * 1000 + c)::INT AS c, min(d)::BIGINT AS d FROM (SELECT rid, c, list_sum(list_transform(list_zip(v, z), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{at}) GROUP BY rid"
    for at in range(rounds):
        parts.append(f"a{at} AS MATERIALIZED ({nearest.format(at=at)})")
        parts.append(f"""c{at + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.z, o.z) AS z FROM c{at} o LEFT JOIN (
 SELECT c, list(s ORDER BY i) AS z FROM (SELECT c, i, floor(sum(v[i]::HUGEINT) / count(*)) AS s
 FROM (SELECT c, v, unnest(range(1, 65)) AS i FROM a{at} JOIN v USING (rid)) GROUP BY c, i) GROUP BY c) n ON o.c = n.c)""")
    parts.append(f"a{rounds} AS MATERIALIZED ({nearest.format(at=rounds)})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, a.c AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
 sha256(array_to_string(list_transform(z, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} f ON f.c = a.c"""
