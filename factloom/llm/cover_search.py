"""Exact top-k inner-product search by dual-tree traversal of cover trees.

In a cover tree, a node covers all its rows within its radius of its centre, which is one of them; its children's centres are a net: farther than a half of that radius from each other, or than 1 / 1.3 of it where the rows are too spread
for that, and covering the rest within it; one of them has the node's own centre.  A node with few rows is a leaf and is scored as one matrix product; so is one whose rows are
so far from each other that any net would take more than a NET-th of them as centres, as such children could be told apart only by what is scored anyway.

The top level is shared: landmarks, a greedy net of a bounded sample, and every query and candidate belongs to the nearest one's group.  Two
nodes' rows can have no better product than ``<q, c> + |q| r_c + |c| r_q + r_q r_c`` with their centres and covering radii.  So a pair of
groups is met only if that reaches the worst k-th score of the query group's rows, which a first pass over each query group's most promising groups has
found.  Inside a pair of blocks both trees are walked together, best bound first, and a pair of nodes is pruned by the same rule as scores
rise.  Each query's best of every block are merged to its best k overall.

Vectors are floor(scale * x) with x as double.  A vector that is null, empty or holds a null or non-finite component takes
no part, nor does a pair of different dimensions.  Repeated rows (same id and vector) are each a candidate; rows with the query's own id are not.
Null ids take no part.  Ties go to the smaller id.  Scores beyond 64 bits are ranked as they are and reported as the nearest 64-bit number.
Other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import written

#: Rows of a leaf, the part of a node's rows that a net may have as centres, and how much nearer than their node children cover their rows, tried in turn.
LEAF, NET, STEPS = 64, 16, (2.0, 1.3)
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: The sample that landmarks are chosen from, landmarks, and groups that each query group meets in the first pass.
SAMPLE, LANDMARKS, FIRST_GROUPS = 8192, 1024, 2


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(1))


class CoverTree:
    """Rows in node order; per node: centre row, covering radius, row range and children."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, net: int = NET) -> None:
        self.points, self.leaf, self.net = points, leaf, net
        self.order = np.arange(len(points))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(points):
            # the row that is nearest to the mean covers the rest with a small radius
            self._build(0, len(points), int(np.argmin(distances(points, points.mean(0)))))
        self.c = points[np.array(self.centre, np.int64)]
        self.r = np.array(self.radius)
        self.n = np.sqrt((self.c**2).sum(1))

    def _build(self, lo: int, hi: int, centre: int) -> int:
        rows = self.order[lo:hi]
        x = self.points[rows]
        away = distances(x, self.points[centre])
        node, reach = len(self.centre), float(away.max())
        self.centre.append(centre), self.range.append((lo, hi)), self.children.append([])
        self.radius.append(reach * (1 + 1e-12))
        if hi - lo <= self.leaf or reach == 0:
            return node
        nets = (self._net(x, rows, centre, away, reach / step) for step in STEPS)
        found = next((n for n in nets if n is not None), None)
        if found is None:
            return node
        picks, nearest = found
        self.order[lo:hi] = rows[np.argsort(nearest, kind="stable")]
        at = lo
        for pick, size in zip(picks, np.bincount(nearest, minlength=len(picks)).tolist()):
            self.children[node].append(self._build(at, at + size, pick))
            at += size
        return node

    def _net(self, x: np.ndarray, rows: np.ndarray, centre: int, away: np.ndarray, least: float) -> tuple[list[int], np.ndarray] | None:
        """Centres that cover all rows within a distance, the farthest row next, and each row's; None if they are too many."""
        picks, nearest, near, squares = [centre], np.zeros(len(rows), np.int64), away.copy(), (x**2).sum(1)
        while near.max() > least:
            if len(picks) > max(self.leaf, len(rows) // self.net):
                return None
            far = int(np.argmax(near))
            # by products, as a net may be off by rounding; each child's radius is measured anew
            d = np.sqrt(np.maximum(squares - 2 * (x @ x[far]) + squares[far], 0))
            d[far] = 0
            closer = d < near
            near[closer], nearest[closer] = d[closer], len(picks)
            picks.append(int(rows[far]))
        return picks, nearest


class DualSearch:
    """For each query row its k best (score, candidate row) among rows with another id; scores must be exact in doubles, and ids ascend with the rows.

    ``floors``: scores that a query's k-th best is known to reach.  ``pruned`` and ``scored`` count pairs of nodes, and of rows.
    """

    def __init__(self, queries: CoverTree, query_ids: np.ndarray, candidates: CoverTree, candidate_ids: np.ndarray, k: int, floors: np.ndarray | None = None) -> None:
        self.q, self.c, self.k = queries, candidates, k
        self.query_ids, self.candidate_ids = query_ids, candidate_ids
        n = len(queries.points)
        self.floors = np.full(n, -np.inf) if floors is None else floors
        self.best = [(np.full(0, -np.inf), np.zeros(0, np.int64))] * n
        self.kth = self.floors.copy()
        self.worst = np.array([self.kth[queries.order[a:b]].min() for a, b in queries.range])
        self.parent = {c: p for p, cs in enumerate(queries.children) for c in cs}
        self.pruned = self.scored = 0
        if n and len(candidates.points):
            self._walk()

    def bound(self, q: int, c: np.ndarray) -> np.ndarray:
        a, b = self.q, self.c
        value = b.c[c] @ a.c[q] + a.n[q] * b.r[c] + a.r[q] * b.n[c] + a.r[q] * b.r[c]
        return value + 1e-9 * (1 + np.abs(value))  # a bound may never be too low by rounding

    def _walk(self) -> None:
        a, b = self.q, self.c
        heap = [(-float(self.bound(0, np.array([0]))[0]), 0, 0)]
        while heap:
            value, q, c = heapq.heappop(heap)
            if -value < self.worst[q]:
                self.pruned += 1
                continue
            wide = b.children[c] and (b.r[c] >= a.r[q] or not a.children[q])
            if wide:
                pairs = [(q, np.array(b.children[c]))]
            elif a.children[q]:
                pairs = [(x, np.array([c])) for x in a.children[q]]
            else:
                self._score(q, c)
                continue
            for x, below in pairs:
                for bound, y in zip(self.bound(x, below).tolist(), below.tolist()):
                    if bound < self.worst[x]:
                        self.pruned += 1
                    else:
                        heapq.heappush(heap, (-bound, x, y))

    def _score(self, q: int, c: int) -> None:
        (lo, hi), (x, y) = self.q.range[q], self.c.range[c]
        rows, cols = self.q.order[lo:hi], self.c.order[x:y]
        s = self.q.points[rows] @ self.c.points[cols].T
        self.scored += s.size
        s[self.query_ids[rows][:, None] == self.candidate_ids[cols][None]] = -np.inf
        for r in np.flatnonzero(s.max(1) >= self.kth[rows]):
            row, own = rows[r], s[r]
            # all that reach the k-th score, so that ties are settled by place
            take = np.flatnonzero((own >= self.kth[row]) & (own > -np.inf))
            if len(take) > self.k:
                take = take[own[take] >= np.partition(own[take], len(take) - self.k)[len(take) - self.k]]
            score, ids = np.concatenate([self.best[row][0], own[take]]), np.concatenate([self.best[row][1], cols[take]])
            top = np.lexsort((ids, -score))[: self.k]
            self.best[row] = score[top], ids[top]
            if len(top) == self.k:
                self.kth[row] = max(self.floors[row], score[top[-1]])
        self.worst[q] = self.kth[rows].min()
        while q in self.parent:
            q = self.parent[q]
            self.worst[q] = min(self.worst[x] for x in self.q.children[q])


def exact_products(queries, query_ids, candidates, candidate_ids, k: int) -> list[list[tuple[int, int]]]:
    """The same for components too large for doubles: every pair, in whole numbers."""
    out = []
    for q, own in zip(queries, query_ids):
        scored = ((-sum(a * b for a, b in zip(q, c)), row) for row, (c, i) in enumerate(zip(candidates, candidate_ids)) if i != own)
        out.append([(-s, i) for s, i in heapq.nsmallest(k, scored)])
    return out


def landmarks_of(sample: list, most: int) -> dict[int, np.ndarray]:
    """By dimension, a greedy net of the sampled vectors: each next landmark is the row farthest from those before it."""
    out = {}
    for dim in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == dim])
        picks = [int(np.argmin(distances(x, x.mean(0))))]
        near = distances(x, x[picks[0]])
        while len(picks) < min(most, len(x)) and near.max() > 0:
            picks.append(int(np.argmax(near)))
            near = np.minimum(near, distances(x, x[picks[-1]]))
        out[dim] = x[picks]
    return out


def grouped(rows: DataFrame, marks: dict[int, np.ndarray]) -> DataFrame:
    """Rows (id, v, q, times) with their dimension, nearest landmark (0, with a dimension that the sample lacks), distance from it and norm."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            begin = lists.offsets.to_numpy()[:-1]
            flat = lists.values.to_numpy()
            group, away, norm = np.zeros(len(size), np.int64), np.zeros(len(size)), np.zeros(len(size))
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                x = flat[begin[at][:, None] + np.arange(dim)]
                c = marks.get(dim, np.zeros((1, dim)))
                group[at] = np.argmin((c**2).sum(1)[None] - 2 * (x @ c.T), axis=1)
                away[at] = np.sqrt(((x - c[group[at]]) ** 2).sum(1))
                norm[at] = np.sqrt((x**2).sum(1))
            own = [pa.array(size.astype(np.int32)), pa.array(group), pa.array(away), pa.array(norm)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], ["id", "v", "q", "times", "dim", "mark", "away", "norm"])

    return rows.mapInArrow(run, "id long, v array<double>, q boolean, times long, dim int, mark long, away double, norm double")


def reach(rows: DataFrame) -> dict[tuple[int, int], tuple]:
    """(dimension, landmark): rows, covering radius, largest norm."""
    got = rows.groupBy("dim", "mark").agg(F.count("*"), F.max("away"), F.max("norm")).collect()
    return {(r[0], r[1]): (r[2], r[3] * (1 + 1e-9), r[4] * (1 + 1e-9)) for r in got}


def blocks(rows: DataFrame, sizes: dict, size: int, name: str) -> DataFrame:
    """(dim, mark, part, rows): the rows of a group packed in blocks of about ``size``, dealt by a hash of id and vector."""
    spark = rows.sparkSession
    parts = spark.createDataFrame([(d, m, math.ceil(s[0] / size)) for (d, m), s in sizes.items()] or [(0, 0, 1)], "dim int, mark long, parts int")
    dealt = rows.join(F.broadcast(parts), ["dim", "mark"]).withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int"))
    columns = [c for c in ("id", "v", "floor", "times") if c in rows.columns]
    packed = dealt.groupBy("dim", "mark", "part").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(f"{name}_rows"))
    return packed.withColumnsRenamed({"mark": f"{name}_mark", "part": f"{name}_part"})


def unpacked(column: pa.Array, i: int) -> list[np.ndarray]:
    """Ids, vectors and other numbers of a block; all its vectors have one dimension."""
    rows = column[i].values
    fields = [rows.field(k) for k in range(rows.type.num_fields)]
    ids = fields[0].to_numpy()
    flat = fields[1].flatten().to_numpy()
    return [ids, flat.reshape(len(ids), -1), *(f.to_numpy(zero_copy_only=False) for f in fields[2:])]


def met(pairs: DataFrame, candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, times): the best of each pair of blocks of the paired groups."""
    grid = pairs.join(candidates, ["dim", "c_mark"]).join(queries, ["dim", "q_mark"])

    def run(batches):
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(batch.column(j)[i].as_py() for j in range(3))
                if key != last:
                    ci, c, times = unpacked(batch.column(3), i)
                    last, tree = key, None
                qi, q, floors = unpacked(batch.column(4), i)
                if np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2**52:
                    tree = tree or CoverTree(c)
                    found = DualSearch(CoverTree(q), qi, tree, ci, k, floors).best
                    found = [list(zip(s.tolist(), ids.tolist())) for s, ids in found]
                else:
                    whole = lambda x: [[int(a) for a in r] for r in x.tolist()]
                    found = exact_products(whole(q), qi.tolist(), whole(c), ci.tolist(), k)
                out = [(j, int(ci[n]), min(max(int(s), -(1 << 63)), (1 << 63) - 1), int(times[n])) for j, best in zip(qi.tolist(), found) for s, n in best]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else [()] * 4)], ["query_id", "vec_id", "score", "times"])

    # a candidate block meets its query blocks one after another, so that its tree is built once
    grid = grid.select("dim", "c_mark", "c_part", "c_rows", "q_rows").sortWithinPartitions("dim", "c_mark", "c_part")
    return grid.mapInArrow(run, "query_id long, vec_id long, score long, times long")


def bounds(marks: dict, c_sizes: dict, q_sizes: dict) -> dict[tuple, dict[int, float]]:
    """For each query group (dimension, landmark), by candidate landmark, the product that no pair of rows exceeds."""
    out: dict[tuple, dict[int, float]] = {}
    for (dim, h), (_, rq, nq) in q_sizes.items():
        centres = marks.get(dim, np.zeros((1, dim)))
        for (other, g), (_, rc, nc) in c_sizes.items():
            if other == dim:
                a, b = centres[h], centres[g]
                value = min(float(a @ b) + float(np.sqrt(a @ a)) * rc + float(np.sqrt(b @ b)) * rq + rq * rc, nq * nc)
                out.setdefault((dim, h), {})[g] = value + 1e-6 * (1 + abs(value))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every query row its k best others by inner product of scaled floors."""
    spark = vectors.sparkSession
    v = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    usable = F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.filter(usable).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    # repeated rows are one candidate that counts several times
    rows = rows.groupBy("id", "v").agg(F.max("q").alias("q"), F.count("*").alias("times"))
    once = written(rows, "cover-rows")
    total = once.count()
    share = min(1.0, SAMPLE / max(1, total))
    sample = once.filter(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("v").limit(2 * SAMPLE).collect()
    marks = landmarks_of([r.v for r in sample], max(1, min(LANDMARKS, math.isqrt(total) // 8)))
    rows = written(grouped(once, marks), "cover-grouped")
    asked = rows.filter("q")
    c_sizes, q_sizes = reach(rows), reach(asked)
    limit = bounds(marks, c_sizes, q_sizes)
    candidates = written(blocks(rows, c_sizes, CANDIDATE_BLOCK, "c"), "cover-candidates")

    def paired(chosen: list[tuple]) -> DataFrame:
        return F.broadcast(spark.createDataFrame(chosen or [(-1, -1, -1)], "dim int, q_mark long, c_mark long"))

    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        # a candidate that stands in several rows takes as many ranks
        each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("times", F.lit(k)).cast("int"))))
        return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = [(d, h, g) for (d, h), of in limit.items() for g in sorted(of, key=of.get, reverse=True)[:FIRST_GROUPS]]
    asked = asked.drop("times")
    found = written(met(paired(first), candidates, blocks(asked.withColumn("floor", F.lit(float("-inf"))), q_sizes, QUERY_BLOCK, "q"), k), "cover-found")
    floors = best(found).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("known"))
    asked = written(asked.join(floors, "id", "left").withColumn("floor", F.coalesce("known", F.lit(float("-inf")))).drop("known"), "cover-queries")
    worst = {(r.dim, r.mark): r.floor for r in asked.groupBy("dim", "mark").agg(F.min("floor").alias("floor")).collect()}
    rest = sorted({(d, h, g) for (d, h), of in limit.items() for g, value in of.items() if value >= worst[d, h]} - set(first))
    more = met(paired(rest), candidates, blocks(asked, q_sizes, QUERY_BLOCK, "q"), k)
    return best(found.unionByName(more)).select("query_id", "rank", "vec_id", "score")
