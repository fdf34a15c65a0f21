"""Lloyd's clustering by dual-tree traversal: cover trees over blocks of vectors, built once, against a cover tree over the centroids of each round.

A node of either tree covers its rows within its radius of its centre, which is one of them.  From a vector node at distance d of a
centroid node, no row is nearer to any of its centroids than d less both radii, and each row is within d plus the vector node's radius of the
centroid node's centre, a centroid itself.  Pairs whose lower bound exceeds the least upper bound of their vector node are pruned, with a
margin for rounding, so that ties stay.  A vector node with one centroid left joins it as a whole, by the running sums of its rows; leaf
pairs are compared exactly.

Vectors are cut into blocks where they are read, so nothing is shuffled but k sums a task; a round's centroids are k vectors.  Components are
floor(scale * x), whole numbers; sums of any size are exact, being added in limbs of 40 bits, and a mean is rounded down.

Vectors that are null, have another dimension or hold null or non-finite components take no part.  Repeated rows count each.  A null id is
clustered as any other but starts no centroid.  With fewer rows than centroids there are fewer centroids; an empty table gives no rows.  Ties
go to the smaller centroid number; an empty cluster keeps its centroid.  Distances beyond 64 bits are compared as they are and reported as the largest
64-bit number.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, written

#: Vectors of a block, rows of a leaf, and how much nearer a child's rows are than its parent's.
BLOCK, LEAF, BASE = 2048, 12, 1.3
#: Components below this have exact squared distances in doubles, for some 64 dimensions.
EXACT = 1 << 22
LIMB = 40
LARGEST = (1 << 63) - 1


class Tree:
    """A cover tree in arrays.  Rows lie in node order; a node's children are adjacent."""

    fields = ("centre", "radius", "lo", "hi", "child", "children")

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(points))
        nodes = [[0, 0.0, 0, len(points), 0, 0]]
        at = 0
        while at < len(nodes):
            centre, _, lo, hi, _, _ = nodes[at]
            rows = self.order[lo:hi]
            x = points[rows]
            if not at:
                centre = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))  # the row that covers the rest with a small radius
            away = np.sqrt(((x - points[centre]) ** 2).sum(1))
            reach = float(away.max())
            nodes[at][:2] = [centre, reach * (1 + 1e-9)]
            if hi - lo > leaf and reach > 0:
                picks, nearest = [centre], np.zeros(hi - lo, np.int64)
                while away.max() > reach / BASE:  # the farthest row is the next centre
                    far = int(np.argmax(away))
                    d = np.sqrt(((x - x[far]) ** 2).sum(1))
                    closer = d < away
                    away[closer], nearest[closer] = d[closer], len(picks)
                    picks.append(int(rows[far]))
                self.order[lo:hi] = rows[np.argsort(nearest, kind="stable")]
                nodes[at][4:] = [len(nodes), len(picks)]
                ends = lo + np.cumsum(np.bincount(nearest, minlength=len(picks)))
                nodes += [[p, 0.0, int(b - s), int(b), 0, 0] for p, s, b in zip(picks, np.diff(ends, prepend=lo), ends)]
            at += 1
        place = np.empty(len(points), np.int64)
        place[self.order] = np.arange(len(points))
        table = np.array(nodes, float)
        self.centre, self.radius = place[table[:, 0].astype(np.int64)], table[:, 1]
        self.lo, self.hi, self.child, self.children = (table[:, k].astype(np.int64) for k in range(2, 6))


class Block:
    """Vectors in tree order with their ids and tree, as one row of a table."""

    columns = ("ids", "vectors", *Tree.fields)
    schema = "ids array<long>, vectors binary, centre binary, radius binary, lo binary, hi binary, child binary, children binary"

    def __init__(self, ids: pa.Array, vectors: np.ndarray, tree: Tree) -> None:
        self.ids, self.vectors, self.tree = ids, vectors, tree

    @classmethod
    def built(cls, ids: pa.Array, vectors: np.ndarray) -> Block:
        tree = Tree(vectors)
        return cls(ids.take(pa.array(tree.order)), vectors[tree.order], tree)

    def row(self) -> list:
        return [self.ids, self.vectors.tobytes(), *(getattr(self.tree, f).tobytes() for f in Tree.fields)]

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int) -> Block:
        tree = Tree.__new__(Tree)
        for k, f in enumerate(Tree.fields):
            setattr(tree, f, np.frombuffer(batch.column(k + 2)[i].as_buffer(), float if f == "radius" else np.int64))
        ids = batch.column(0)[i].values
        return cls(ids, np.frombuffer(batch.column(1)[i].as_buffer(), float).reshape(len(ids), -1), tree)


def expanded(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, item) for ``count[i]`` items from ``first[i]`` on."""
    index = np.repeat(np.arange(len(first)), count)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count) + first[index]


class DualTree:
    """The nearest centroid of each row of a block.  ``whole``: (node, centroid) decided together; ``met`` and ``pruned`` count pairs of nodes, ``scored`` those of leaf rows and centroids."""

    def __init__(self, block: Block, centroids: np.ndarray) -> None:
        self.block, self.centroids = block, centroids
        self.labels = np.zeros(len(block.vectors), np.int64)
        self.whole: list[tuple[int, int]] = []
        self.single = np.ones(len(block.vectors), bool)
        self.met = self.pruned = self.scored = 0
        if len(block.vectors):
            self._walk()

    def _walk(self) -> None:
        a, x, b = self.block.tree, self.block.vectors, Tree(self.centroids, leaf=1)
        own = self.centroids[b.order]
        v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
        limit = np.full(len(a.lo), np.inf)  # what no row's nearest centroid is farther than
        rows, against = [], []
        while len(v):
            d = np.sqrt(((x[a.centre[v]] - own[b.centre[c]]) ** 2).sum(1))
            np.minimum.at(limit, v, (d + a.radius[v]) * (1 + 1e-9))
            keep = (d - a.radius[v] - b.radius[c]) * (1 - 1e-9) - 1e-6 <= limit[v]
            self.met += len(v)
            self.pruned += int(len(v) - keep.sum())
            v, c = v[keep], c[keep]
            left = np.bincount(v, minlength=len(a.lo))
            wide = np.zeros(len(a.lo))
            np.maximum.at(wide, v, b.radius[c])
            split = b.children[c] > 0
            # the wider side goes down, for all pairs of a vector node alike
            down_c = split & ((wide[v] >= a.radius[v]) | (a.children[v] == 0) | (left[v] == 1))
            stay = (wide[v] > 0) & ((wide[v] >= a.radius[v]) | (a.children[v] == 0)) & ~split
            done = ~split & (left[v] == 1)
            down_v = ~down_c & ~stay & ~done & (a.children[v] > 0)
            leaf = ~(down_c | stay | done | down_v)
            for node, group in zip(v[done].tolist(), c[done].tolist()):
                label = int(b.order[b.lo[group] : b.hi[group]].min())
                self.whole.append((node, label))
                self.labels[a.lo[node] : a.hi[node]] = label
                self.single[a.lo[node] : a.hi[node]] = False
            rows.append(v[leaf]), against.append(c[leaf])
            i, below = expanded(b.child[c[down_c]], b.children[c[down_c]])
            j, under = expanded(a.child[v[down_v]], a.children[v[down_v]])
            np.minimum.at(limit, under, limit[v[down_v][j]])
            v, c = np.concatenate([v[down_c][i], v[stay], under]), np.concatenate([below, c[stay], c[down_v][j]])
        self._compare(np.concatenate(rows), np.concatenate(against), b)

    def _compare(self, v: np.ndarray, c: np.ndarray, b: Tree) -> None:
        a, x = self.block.tree, self.block.vectors
        if not len(v):
            return
        open_ = np.zeros((len(x), len(self.centroids)), bool)
        i, row = expanded(a.lo[v], a.hi[v] - a.lo[v])
        j, place = expanded(b.lo[c[i]], b.hi[c[i]] - b.lo[c[i]])
        open_[row[j], b.order[place]] = True
        at = np.flatnonzero(open_.any(1))
        d = (x[at] ** 2).sum(1)[:, None] - 2 * (x[at] @ self.centroids.T) + (self.centroids**2).sum(1)[None]
        self.scored += int(open_.sum())
        self.labels[at] = np.argmin(np.where(open_[at], d, np.inf), axis=1)


def whole_numbers(x: np.ndarray) -> list[list[int]]:
    return [[int(c) for c in row] for row in x.tolist()]


def nearest(block: Block, centroids: list[list[int]]) -> tuple[np.ndarray, DualTree | None]:
    """Labels of a block's rows, and the walk that found them; None where components are too large for doubles and every pair is compared in whole numbers."""
    large = max(abs(c) for row in centroids for c in row)
    if max(large, np.abs(block.vectors).max(initial=0)) * max(1, block.vectors.shape[1] / 64) ** 0.5 < EXACT:
        walk = DualTree(block, np.array(centroids, float))
        return walk.labels, walk
    return np.array([min(range(len(centroids)), key=lambda j: sum((a - b) ** 2 for a, b in zip(row, centroids[j]))) for row in whole_numbers(block.vectors)], np.int64), None


def cluster_sums(block: Block, centroids: list[list[int]]) -> list[tuple[int, list[int]]]:
    """Of each cluster the rows of a block and their componentwise sums."""
    labels, walk = nearest(block, centroids)
    out = []
    if walk is None:
        exact = whole_numbers(block.vectors)
        for j in range(len(centroids)):
            at = np.flatnonzero(labels == j).tolist()
            out.append((len(at), [sum(exact[i][d] for i in at) for d in range(len(centroids[0]))]))
        return out
    n, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), len(centroids[0])))
    if walk.whole:
        running = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(block.vectors, axis=0)])
        for node, j in walk.whole:
            lo, hi = block.tree.lo[node], block.tree.hi[node]
            n[j] += hi - lo
            sums[j] += running[hi] - running[lo]
    at = np.flatnonzero(walk.single)
    n += np.bincount(labels[at], minlength=len(n))
    np.add.at(sums, labels[at], block.vectors[at])
    return [(int(n[j]), [int(s) for s in sums[j].tolist()]) for j in range(len(n))]


def blocks_of(rows: DataFrame, scale: float, dims: int) -> DataFrame:
    """Rows (id, v) of ``dims`` components each, as blocks with their trees; a task makes its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, held = [], [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, vectors, held
            i, x = pa.concat_arrays(ids), np.concatenate(vectors)
            while held >= BLOCK or last and held:
                made = Block.built(i[:BLOCK], x[:BLOCK]).row()
                own = pa.ListArray.from_arrays(pa.array([0, len(made[0])], pa.int32()), made[0])
                yield pa.RecordBatch.from_arrays([own, *(pa.array([m], pa.binary()) for m in made[1:])], list(Block.columns))
                i, x, held = i[BLOCK:], x[BLOCK:], max(0, held - BLOCK)
            ids, vectors = [i], [x]

        for batch in batches:
            ids.append(batch.column(0))
            vectors.append(np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)).reshape(-1, dims))
            held += batch.num_rows
            if held >= BLOCK:
                yield from flush(False)
        if held:
            yield from flush(True)

    return rows.mapInArrow(run, Block.schema)


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[tuple[int, list[int]]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                own = cluster_sums(Block.read(batch, i), centroids)
                total = [(n + m, [s + t for s, t in zip(a, b)]) for (n, a), (m, b) in zip(total, own)] if total else own
        out = []
        for j, (n, sums) in enumerate(total):
            for d, s in enumerate([n, *sums]):
                k = 0
                while n and (s or not k):
                    # the last limb has the sign
                    low = s if -(1 << LIMB) < s < 1 << LIMB else s & ((1 << LIMB) - 1)
                    out.append((j, d, k, low))
                    s, k = (s - low) >> LIMB, k + 1
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["cluster", "dim", "limb", "value"])

    got = blocks.mapInArrow(run, "cluster int, dim int, limb int, value long").groupBy("cluster", "dim", "limb").agg(F.sum("value").alias("value")).collect()
    sums = [[0] * (len(centroids[0]) + 1) for _ in centroids]
    for r in got:
        sums[r.cluster][r.dim] += r.value << (LIMB * r.limb)
    return [[s // own[0] for s in own[1:]] if own[0] else list(was) for own, was in zip(sums, centroids)]


def assigned(blocks: DataFrame, centroids: list[list[int]], id_col: str) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.read(batch, i)
                labels, walk = nearest(block, centroids)
                if walk is None:
                    distance = [min(LARGEST, sum((a - b) ** 2 for a, b in zip(row, centroids[j]))) for row, j in zip(whole_numbers(block.vectors), labels.tolist())]
                else:
                    distance = ((block.vectors - walk.centroids[labels]) ** 2).sum(1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([block.ids, pa.array(labels, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    return blocks.mapInArrow(run, "id long, cluster int, distance long").withColumnRenamed("id", id_col)


def usable(vectors: DataFrame, vector_col: str, dims: int) -> DataFrame:
    """Rows with exactly ``dims`` components, none null or non-finite."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.filter((F.size(vector_col) == dims) & ~odd)


def lloyd(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: float = 1024.0, dims: int = 64, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of every vector, final centroids).  Centroids start as the k vectors whose hash of seed and id is smallest."""
    spark = vectors.sparkSession
    rows = usable(vectors, vector_col, dims).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    blocks = written(blocks_of(rows, scale, dims), "lloyd-blocks")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.filter(F.col("id").isNotNull()).select(order.alias("order"), F.transform("v", lambda x: x.cast("double")).alias("v")).orderBy("order", "v").limit(k).collect()
    centroids = [[int(c) for c in np.floor(scale * np.array(r.v)).tolist()] for r in first]
    if not centroids:
        return spark.createDataFrame([], f"{id_col} long, cluster int, distance long"), []
    for _ in range(rounds):
        new = moved(blocks, centroids)
        if new == centroids:  # so would all later rounds
            break
        centroids = new
    out = written(assigned(blocks, centroids, id_col), "lloyd-assigned")
    drop(blocks)
    return out, centroids


def centroid_digest(centroids: list[list[int]], cluster_col: str = "cluster"):
    """The digest of a cluster's centroid, its components in decimal joined by commas."""
    texts = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    return F.element_at(F.array(*map(F.lit, texts)), F.col(cluster_col) + 1)


def inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds the distances' sums, of each cluster and of all; there are as many clusters as centroids, so these can go to every task."""
    wide = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r.cluster: int(r.s) for r in wide}
    total = min(LARGEST, sum(sums.values()))
    clusters = found.sparkSession.createDataFrame([(j, min(LARGEST, s), total) for j, s in sums.items()] or [(-1, 0, 0)], "cluster int, cluster_inertia long, inertia long")
    return found.join(F.broadcast(clusters), "cluster")
