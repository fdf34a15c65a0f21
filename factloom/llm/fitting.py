"""Shared parts of the trained operators: bounded labelled samples, Adam, temperature and score columns."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .textops import Words, doc_chunks


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal id, modulo ``modulus``; null ids have a null remainder."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, trains: Column, most: int, most_bytes: int) -> tuple[list[str], np.ndarray]:
    """Texts and 0/1 labels of at most about ``most`` training rows and ``most_bytes`` bytes, spread by id hash and collected.

    The share kept follows from the number of labelled rows and their mean length alone, so the draw is the same however the input
    is partitioned.  A document with several labels counts once, as 1 if any of them is 1.  Null labels and ids take no part.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y")).filter(trains)
    total = known.count()
    if not total:
        return [], np.zeros(0)
    share = lambda n: F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, n / total) * (1 << 30))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # the sampled ids have a bounded number, so they can go to every scan task
    drawn = rows.join(F.broadcast(known.filter(share(most))), "doc_id")
    size = drawn.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if size[1] and size[1] > most_bytes:
        drawn = drawn.filter(share(most * most_bytes / size[1]))
    got = sorted(drawn.select("doc_id", "y", "text").collect())
    return [r.text for r in got], np.array([r.y for r in got], float)


def word_chunks(texts: list[str]):
    """Words and offsets of runs of whole texts of about a chunk's size, so that training needs no more room than scoring."""
    for _, _, buf, offs in doc_chunks(pa.array(texts, pa.large_string())):
        yield Words(buf, offs), offs


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float) -> None:
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on held-back rows, from a fixed grid."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.mean(np.logaddexp(0, -(2 * y - 1) * logits / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def with_scores(docs: DataFrame, score: Callable[[Words, np.ndarray], np.ndarray]) -> DataFrame:
    """All columns of the documents as c0, c1, ... and the score: ``score`` gets the words and offsets of each chunk of whole documents.

    Columns have names by place, so that none can clash.
    """
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, j, buf, offs in doc_chunks(batch.column(at)):
                with np.errstate(over="ignore"):
                    out[i:j] = score(Words(buf, offs), offs)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names)

    rows = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    names = [*rows.columns, "score"]
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("score", DoubleType())]))


def scored(docs: DataFrame, score: Callable[[Words, np.ndarray], np.ndarray], *carry: str) -> DataFrame:
    """(doc_id, carried columns, score)."""
    rows = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry), score)
    return rows.select(F.col("c0").alias("doc_id"), *(F.col(f"c{k + 2}").alias(c) for k, c in enumerate(carry)), "score")
