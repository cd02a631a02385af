"""Nearest neighbours of every point: exact over a tree of pivots, approximate over hashed projections.

Points are rows (id, v) with distinct vectors. Neither search holds anything on the driver that grows with the data:
pivots, radii and thresholds are tables, and a group that one task works on is bounded in rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.workspace import materialise

from .ordered import hash_key

#: Rows of a leaf cell: one task compares a leaf with a chunk of visitors at a time.
LEAF_ROWS = 2_048
#: Rows of a chunk that is compared with a leaf or with the pivots of a cell.
CHUNK_ROWS = 16_384
#: Children of a cell that is split.
FANOUT = 32
#: Room for the rounding of distances.
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed feature by feature for exact zeros and ties."""
    total = np.zeros((len(a), len(b)))
    for f in range(a.shape[1]):
        gap = a[:, f, None] - b[None, :, f]
        total += gap * gap
    return np.sqrt(total)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest_in(ids: np.ndarray, v: np.ndarray, other_ids: np.ndarray, other_v: np.ndarray, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, neighbour, distance) of the k nearest others of every row, ties to the smaller id, none farther than `reach`."""
    by_id = np.argsort(other_ids, kind="stable")
    other_ids, other_v = other_ids[by_id], other_v[by_id]
    rows, found, far = [], [], []
    step = max(1, (1 << 21) // max(1, len(other_ids)))
    for s in range(0, len(ids), step):
        d = distances(v[s : s + step], other_v)
        d[ids[s : s + step, None] == other_ids[None, :]] = np.inf
        if k < d.shape[1]:  # rows at the k-th distance or nearer, so that ties can be told by id
            near = d <= np.partition(d, k - 1, axis=1)[:, k - 1 : k]
        else:
            near = np.ones(d.shape, bool)
        near &= np.isfinite(d)
        if reach is not None:
            near &= d <= reach[s : s + step, None]
        row, other = np.nonzero(near)
        dist = d[row, other]
        order = np.lexsort((other, dist, row))
        row, other, dist = row[order], other[order], dist[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        rows.append(row[keep] + s)
        found.append(other_ids[other[keep]])
        far.append(dist[keep])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(far)


def _salted(rows: DataFrame, small: DataFrame, by: str, chunk: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt, so that a group of `by` has at most about `chunk` rows of `rows` beside all of `small`'s."""
    sizes = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("_salts"))
    spread = F.pmod(F.xxhash64("id", F.lit(by)), F.col("_salts")).cast("int")
    left = rows.join(sizes, by).withColumn("salt", spread).drop("_salts")
    right = small.join(sizes, by).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return left, right


class PivotTree:
    """Cells around pivots, split until every cell is small; `home` has each point with its leaf, `levels` the cells' children.

    A cell is a number: child j of cell c is c * fanout + j + 1, the root is 0. Cells that hold very many points are split further than others, so
    skewed data makes a deeper tree and no larger group.
    """

    def __init__(self, points: DataFrame, seed: int, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT):
        self.id_type = points.schema["id"].dataType.simpleString()
        self.leaf_rows, self.fanout = leaf_rows, fanout
        first = points.orderBy(hash_key("id", f"{seed}|root"), "id").limit(1).select(F.lit(0).cast("long").alias("cell"), F.col("v").alias("pivot"), F.lit(-1).alias("place"))
        start, root = _salted(points.withColumn("cell", F.lit(0).cast("long")).withColumn("ds", F.array().cast("array<double>")), first, "cell")
        rows = materialise(self._assigned(start, root, keep_cell=True), "pivot-root")
        self.levels: list[DataFrame] = []
        #: (cell, ds): distances of the cell's points to its pivot, the smallest few of each.
        self.members = rows.select("cell", F.element_at("ds", -1).alias("d"))
        leaves = None
        while True:
            sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf_rows)
            sizes = materialise(sizes.withColumn("wanted", F.least(F.lit(fanout), F.ceil(2 * F.col("n") / leaf_rows))), "pivot-cells")
            done = rows.join(sizes, "cell", "left_anti")
            leaves = done if leaves is None else leaves.unionByName(done)
            if sizes.isEmpty():
                break
            big = rows.join(sizes, "cell")
            place = F.row_number().over(Window.partitionBy("cell").orderBy(hash_key("id", f"{seed}|{len(self.levels)}"), "id"))
            drawn = big.select("cell", "wanted", F.col("v").alias("pivot"), (place - 1).alias("place")).filter(F.col("place") < fanout)
            pivots = materialise(drawn.filter(F.col("place") < F.col("wanted")).drop("wanted"), "pivots")
            left, right = _salted(big.drop("n", "wanted"), pivots, "cell")
            rows = materialise(self._assigned(left, right), "pivot-level")
            reached = rows.groupBy("cell").agg(F.max(F.element_at("ds", -1)).alias("radius"))
            child = pivots.withColumn("child", F.col("cell") * fanout + F.col("place") + 1)
            level = child.join(reached.withColumnRenamed("cell", "child"), "child").select("cell", "child", "pivot", "radius")
            self.levels.append(materialise(level, "pivot-children"))
            self.members = self.members.unionByName(rows.select("cell", F.element_at("ds", -1).alias("d")))
        self.home = materialise(leaves, "pivot-leaves")

    def _assigned(self, rows: DataFrame, pivots: DataFrame, keep_cell: bool = False) -> DataFrame:
        """Every row in the cell of its nearest pivot, the distance appended to `ds`."""
        fanout = self.fanout

        def assign(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            right = right.sort_by("place")
            pivot, place = _vectors(right["pivot"]), right["place"].to_numpy()
            out, ds, v = [], left["ds"].to_pylist(), _vectors(left["v"])
            for s in range(0, left.num_rows, 4_096):
                d = distances(v[s : s + 4_096], pivot)
                nearest = d.argmin(1)
                out.append(np.stack([place[nearest], d[np.arange(len(d)), nearest]], axis=1))
            found = np.concatenate(out) if out else np.zeros((0, 2))
            cell = left["cell"].to_numpy()
            cell = cell if keep_cell else cell * fanout + found[:, 0].astype(np.int64) + 1
            ds = [[*old, new] for old, new in zip(ds, found[:, 1].tolist(), strict=True)]
            return pa.table([left["id"], left["v"], pa.array(cell), pa.array(ds, pa.list_(pa.float64()))], names=["id", "v", "cell", "ds"])

        by = ("cell", "salt")
        return rows.groupBy(*by).cogroup(pivots.groupBy(*by)).applyInArrow(assign, f"id {self.id_type}, v array<double>, cell long, ds array<double>")

    def reach(self, k: int) -> DataFrame:
        """(cell, far): within `far` of a cell's pivot lie k + 1 of its points; cells with fewer are left out."""
        place = F.row_number().over(Window.partitionBy("cell").orderBy("d"))
        return self.members.withColumn("p", place).filter(F.col("p") <= k + 1).groupBy("cell").agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > k).select("cell", "far")

    def nearest(self, k: int) -> DataFrame:
        """(id, neighbour, distance): the k nearest other points of every point, ties to the smaller id."""
        found = f"id {self.id_type}, neighbour {self.id_type}, distance double"
        schema = f"id {self.id_type}, v array<double>, cell long, ds array<double>, near array<struct<neighbour:{self.id_type},distance:double>>"

        def own(key: tuple, cell: pa.Table) -> pa.Table:
            ids = cell["id"].to_numpy()
            row, other, dist = nearest_in(ids, _vectors(cell["v"]), ids, _vectors(cell["v"]), k)
            cuts = np.searchsorted(row, np.arange(len(ids) + 1)).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(other), pa.array(dist)], names=["neighbour", "distance"])
            return cell.select(["id", "v", "cell", "ds"]).append_column("near", pa.ListArray.from_arrays(pa.array(cuts), structs))

        at_home = materialise(self.home.groupBy("cell").applyInArrow(own, schema), "near-home")
        first = at_home.select("id", F.explode("near").alias("e")).select("id", "e.*")
        if not self.levels:
            return first
        enough = at_home.filter(F.size("near") >= k).withColumn("tau", F.element_at("near", -1)["distance"])
        visits = self._visits(enough.unionByName(self._bounded(at_home.filter(F.size("near") < k), k)).select("id", "v", "tau", F.col("cell").alias("own")))
        left, right = _salted(visits, self.home.select("cell", "id", "v"), "cell", CHUNK_ROWS)

        def elsewhere(key: tuple, rows: pa.Table, cell: pa.Table) -> pa.Table:
            ids = rows["id"].to_numpy()
            row, other, dist = nearest_in(ids, _vectors(rows["v"]), cell["id"].to_numpy(), _vectors(cell["v"]), k, rows["tau"].to_numpy() * (1 + SLACK) + SLACK)
            return pa.table([pa.array(ids[row]), pa.array(other), pa.array(dist)], names=["id", "neighbour", "distance"])

        by = ("cell", "salt")
        more = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(elsewhere, found)
        place = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
        return first.unionByName(more).withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")

    def _bounded(self, few: DataFrame, k: int) -> DataFrame:
        """Points whose leaf has too few others: bounded by the pivots of the cells above it, by the triangle inequality."""
        paths = few.select("id", F.col("cell").alias("leaf"), F.posexplode("ds").alias("depth", "d"), F.size("ds").alias("size"))
        # The cell at `depth` is found by going up from the leaf.
        up = F.aggregate(F.sequence(F.lit(1), F.col("size") - F.col("depth")), F.col("leaf") * self.fanout + 1, lambda c, _: F.floor((c - 1) / self.fanout))
        bounds = paths.withColumn("cell", up.cast("long")).join(self.reach(k), "cell").groupBy("id").agg(F.min(F.col("d") + F.col("far")).alias("tau"))
        return few.join(bounds, "id").select(*few.columns, "tau")

    def _visits(self, rows: DataFrame) -> DataFrame:
        """(id, v, tau, cell) for every leaf but its own that can hold a point within tau."""
        schema = f"id {self.id_type}, v array<double>, tau double, own long, cell long"

        def descend(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            pivot, child, radius = _vectors(right["pivot"]), right["child"].to_numpy(), right["radius"].to_numpy()
            v, tau = _vectors(left["v"]), left["tau"].to_numpy()
            rows, to = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s in range(0, left.num_rows, 4_096):
                d = distances(v[s : s + 4_096], pivot)
                row, j = np.nonzero(d - radius[None, :] <= tau[s : s + 4_096, None] * (1 + SLACK) + SLACK)
                rows.append(row + s)
                to.append(child[j])
            at = pa.array(np.concatenate(rows))
            picked = left.select(["id", "v", "tau", "own"]).take(at)
            return picked.append_column("cell", pa.array(np.concatenate(to)))

        out, going = None, rows.withColumn("cell", F.lit(0).cast("long"))
        for depth, level in enumerate(self.levels):
            left, right = _salted(going, level, "cell")
            by = ("cell", "salt")
            reached = materialise(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(descend, schema), "visits")
            if depth + 1 < len(self.levels):
                inner = self.levels[depth + 1].select("cell").distinct()
                ended, going = reached.join(inner, "cell", "left_anti").select(*reached.columns), reached.join(inner, "cell", "left_semi").select(*reached.columns)
            else:
                ended = reached
            out = ended if out is None else out.unionByName(ended)
        return materialise(out.filter(F.col("cell") != F.col("own")).drop("own"), "visits")


def exact_nearest(points: DataFrame, k: int, seed: int, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> DataFrame:
    """(id, neighbour, distance) of the k nearest among distinct vectors.

    Cells around pivots form a tree as deep as the data need. A point first meets its own leaf, which bounds how far its k-th neighbour
    can be; then it goes down the tree to every cell whose pivot and radius allow a nearer one (triangle inequality), and meets those leaves.
    Data without any cluster structure makes a point visit many leaves: that is the price of exactness.
    """
    return PivotTree(points, seed, leaf_rows, fanout).nearest(k)


def hashed_nearest(points: DataFrame, k: int, seed: int, tables: int = 12, leaf_rows: int = 512, probe_share: float = 0.15) -> DataFrame:
    """(id, neighbour, distance) of nearly always the k nearest: multi-probe locality-sensitive hashing.

    In each table a point has a code of signs: on which side of a threshold its random projections lie. A bucket is a prefix of the code, as long as
    its size demands (an LSH forest), and the threshold is the median of the bucket, so buckets stay bounded whatever
    the data look like. Beside its own bucket a point probes one more per table: the one across the first threshold that it lies within `probe_share` of
    the spread of. Points are compared with those of their buckets only, by exact distance.
    """
    id_type = points.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, v array<double>, tab int, cell long, guest boolean, p double"
    width = points.select(F.size("v").alias("w")).first()
    if width is None:
        return points.sparkSession.createDataFrame([], f"id {id_type}, neighbour {id_type}, distance double")
    directions = np.random.default_rng(seed).normal(size=(64, tables, width["w"]))

    def project(level: int):
        def run(batches):
            for batch in batches:
                v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                table = batch.column("tab").to_numpy(zero_copy_only=False)
                p = np.einsum("ij,ij->i", v, directions[level, table])
                yield pa.record_batch([*batch.columns, pa.array(p)], names=[*batch.schema.names, "p"])

        return run

    rows = points.withColumn("tab", F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))).withColumn("cell", F.lit(1).cast("long")).withColumn("guest", F.lit(False))
    leaves = None
    for level in range(60):
        sizes = rows.filter(~F.col("guest")).groupBy("tab", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf_rows).select("tab", "cell")
        sizes = materialise(sizes, "lsh-cells")
        done = rows.join(sizes, ["tab", "cell"], "left_anti").select(*rows.columns)
        leaves = done if leaves is None else leaves.unionByName(done)
        if sizes.isEmpty():
            break
        big = materialise(rows.join(sizes, ["tab", "cell"], "left_semi").select("id", "v", "tab", "cell", "guest").mapInArrow(project(level), schema), "lsh-level")
        cuts = big.filter(~F.col("guest")).groupBy("tab", "cell").agg(F.percentile_approx("p", 0.5).alias("at"), F.stddev_pop("p").alias("spread"))
        sided = big.join(cuts, ["tab", "cell"])
        side = (F.col("p") > F.col("at")).cast("int")
        close = ~F.col("guest") & (F.abs(F.col("p") - F.col("at")) <= probe_share * F.col("spread"))
        # The home copy, and a guest on the other side; a home copy near several thresholds has several guests.
        copies = F.array(F.struct(side.alias("side"), F.col("guest").alias("g")), F.struct((1 - side).alias("side"), F.lit(True).alias("g")))
        both = sided.withColumn("e", F.explode(F.when(close, copies).otherwise(F.slice(copies, 1, 1))))
        rows = materialise(both.select("id", "v", "tab", (F.col("cell") * 2 + F.col("e.side")).alias("cell"), F.col("e.g").alias("guest")), "lsh-rows")
    found = f"id {id_type}, neighbour {id_type}, distance double"
    placed = leaves.select(F.concat_ws("-", "tab", "cell").alias("bucket"), "id", "v", "guest")
    asked, homes = materialise(placed.drop("guest"), "lsh-asked"), materialise(placed.filter(~F.col("guest")).drop("guest"), "lsh-homes")
    left, right = _salted(asked, homes, "bucket", 4 * leaf_rows)

    def compare(key: tuple, asked: pa.Table, cell: pa.Table) -> pa.Table:
        ids = asked["id"].to_numpy()
        if not cell.num_rows:
            return pa.table([pa.array(ids[:0]), pa.array(ids[:0]), pa.array(np.zeros(0))], names=["id", "neighbour", "distance"])
        row, other, dist = nearest_in(ids, _vectors(asked["v"]), cell["id"].to_numpy(), _vectors(cell["v"]), k)
        return pa.table([pa.array(ids[row]), pa.array(other), pa.array(dist)], names=["id", "neighbour", "distance"])

    by = ("bucket", "salt")
    pairs = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, found).groupBy("id", "neighbour").agg(F.min("distance").alias("distance"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    return pairs.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


