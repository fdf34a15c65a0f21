"""Connected components over written edge tables.

Up to LOCAL_LINKS links, a checked bound, one executor task labels them with a vectorised union-find; beyond it, large-star and
small-star rounds do so over all tasks.  Either way the links stay on the executors and the labels are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: At 16 bytes a link, a task's share of memory holds this many several times over.
LOCAL_LINKS = 2_000_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, smallest vertex of each one's component) of an edge list."""
    vertices, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(vertices))
    while True:
        least = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, x, least)
        np.minimum.at(after, y, least)
        # roots follow too, then every vertex jumps to its label's label
        np.minimum.at(after, label[x], least)
        np.minimum.at(after, label[y], least)
        after = after[after]
        if (after == label).all():
            return vertices, vertices[label]
        label = after


def min_labels(links: DataFrame, a: str = "a", b: str = "b", local: int = LOCAL_LINKS) -> DataFrame:
    """(rep, label) for every linked vertex: label is the smallest vertex of its component."""
    if links.count() <= local:

        def run(batches):
            parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
            if parts:
                vertices, labels = union_find(*(np.concatenate(p) for p in zip(*parts)))
                yield pa.RecordBatch.from_arrays([pa.array(vertices, pa.int64()), pa.array(labels, pa.int64())], ["rep", "label"])

        return written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).coalesce(1).mapInArrow(run, "rep long, label long"), "component-labels")
    return star_labels(links, a, b)


def star_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The same by alternating large-star and small-star rounds.

    Each round points every vertex and its neighbours at the smallest neighbour; a vertex with many neighbours is
    aggregated before it is moved.  Rounds grow with the logarithm of the longest path.
    """
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        # large star: neighbours that are larger than the vertex go to the smallest vertex about it
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.filter("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: the vertex and its smaller neighbours go to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()
        edges = written(small, "component-edges")
        # settled: every larger end has one edge and is no smaller end
        ends = edges.select(F.explode(F.array(F.struct(F.col("hi").alias("v"), F.lit(1).alias("h")), F.struct(F.col("lo").alias("v"), F.lit(0).alias("h")))).alias("x")).select("x.*")
        if ends.groupBy("v").agg(F.sum("h").alias("h"), F.min("h").alias("l")).filter("h > 1 or (h = 1 and l = 0)").isEmpty():
            break
    roots = edges.select(F.col("lo").alias("rep"), F.col("lo").alias("label")).distinct()
    return written(edges.select(F.col("hi").alias("rep"), F.col("lo").alias("label")).unionByName(roots), "component-labels")
