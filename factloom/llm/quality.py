"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network in numpy.

Every hashed word has a sparse ternary index vector that follows from its hash.  Over all documents, a word's
context vector sums the index vectors of its neighbours; it is scaled to unit length.  A document pools, over its words,
the mean context vector and the mean index vector of word shapes (letter case, digits, punctuation, length), with the spread of its words.  A
hidden layer and a logistic output are trained with Adam; a temperature fitted on held-back rows makes the
outputs probabilities.

A score depends on the text alone.  Null, empty and blank texts have zero pooled features and get the network's
score for those.  Repeated rows count in the contexts once each and get equal scores; null and repeated ids are passed on, and labels of null ids
are not read; other columns may have any name.  A text of any length is scored whole.  Without training rows of both classes every score is the share of label 1 (1, if there are none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fitting import Adam, labelled_sample, scored, sigmoid, temperature, word_chunks
from .textops import U64, Words, doc_chunks, mix

BUCKETS, DIMS, HIDDEN, WINDOW, SHAPES, SLICES = 1 << 14, 64, 24, 2, 256, 64
MOST_ROWS, MOST_BYTES = 6000, 14_000_000
EXTRAS = 6
#: Pairs of neighbours that are counted at once.
HELD = 2_000_000

#: Byte classes of word shapes: 0 lower, 1 upper, 2 digit, 3 other ASCII, 4 beyond ASCII.
_KIND = np.full(256, 3, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 4


#: Signs of the entries of an index vector.
SIGNS = np.array([1, 1, 1, 1, -1, -1, -1, -1], np.float32)


def index_places(n: int, dims: int, seed: int) -> np.ndarray:
    """Where the entries of n sparse ternary vectors are."""
    rng = np.random.default_rng(seed)
    return np.argsort(rng.random((n, dims)), axis=1)[:, : len(SIGNS)]


def index_vectors(places: np.ndarray, dims: int) -> np.ndarray:
    out = np.zeros((len(places), dims), np.float32)
    np.put_along_axis(out, places, SIGNS[None], 1)
    return out


class Model:
    def __init__(self, seed: int = 6) -> None:
        self.places = index_places(BUCKETS, DIMS, seed)
        self.index = index_vectors(self.places, DIMS)
        self.shape_index = index_vectors(index_places(SHAPES, DIMS, seed + 1), DIMS)
        self.context = self.index.copy()
        rng = np.random.default_rng(seed)
        width = 2 * DIMS + EXTRAS
        self.w1 = rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)
        self.mean, self.spread, self.temperature = np.zeros(width), np.ones(width), 1.0
        self.constant: float | None = None

    @staticmethod
    def buckets(words: Words) -> np.ndarray:
        return (words.hashes & U64(BUCKETS - 1)).astype(np.int64)

    @staticmethod
    def shapes(words: Words, raw: np.ndarray) -> np.ndarray:
        """A shape bucket per word: the first and last byte's class, which classes occur, and a length class."""
        kind = _KIND[raw]
        sums = [np.concatenate([[0], np.cumsum(kind == k)]) for k in (1, 2, 3)]
        bits = sum((s[words.ends] > s[words.starts]).astype(np.int64) << k for k, s in enumerate(sums))
        size = np.minimum(np.log2(words.ends - words.starts).astype(np.int64), 5)
        code = ((kind[words.starts] * 5 + kind[words.ends - 1]) * 8 + bits) * 6 + size
        return (mix(code.astype(U64)) & U64(SHAPES - 1)).astype(np.int64)

    def neighbours(self, words: Words) -> np.ndarray:
        """Every pair of neighbouring words' buckets as one number."""
        b, out = self.buckets(words), [np.zeros(0, np.int64)]
        for gap in range(1, WINDOW + 1):
            same = words.doc[:-gap] == words.doc[gap:]
            out.append((b[:-gap] * BUCKETS + b[gap:])[same])
        return np.concatenate(out)

    def add_contexts(self, pairs: np.ndarray, total: np.ndarray) -> None:
        """Add to each bucket the index vectors of its neighbours.  Each distinct pair is added once, entry by entry of the sparse vectors."""
        pairs = np.sort(pairs)
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
        n = np.diff(np.append(first, len(pairs))).astype(float)
        x, y = pairs[first] // BUCKETS, pairs[first] % BUCKETS
        flat = total.reshape(-1)
        for at, other in ((x, y), (y, x)):
            for k, sign in enumerate(SIGNS.tolist()):
                flat += np.bincount(at * DIMS + self.places[other, k], weights=sign * n, minlength=BUCKETS * DIMS)

    def set_contexts(self, total: np.ndarray) -> None:
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        self.context = np.where(norm > 0, total / np.maximum(norm, 1e-9), self.index / np.sqrt(8)).astype(np.float32)

    def features(self, words: Words, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        out = np.zeros((n, 2 * DIMS + EXTRAS))
        b, sh = self.buckets(words), self.shapes(words, raw)
        docs = np.flatnonzero(words.counts)
        if not len(docs):
            return out
        m = words.counts[docs][:, None]
        # counts of distinct (document, bucket) pairs: repeated words are gathered once
        pair, times = np.unique(words.doc * BUCKETS + b, return_counts=True)
        own = pair // BUCKETS
        first = np.searchsorted(own, docs)
        for s in range(0, len(docs), 64):
            d = docs[s : s + 64]
            a, z = first[s], first[s + 64] if s + 64 < len(docs) else len(pair)
            out[d, :DIMS] = np.add.reduceat(self.context[pair[a:z] % BUCKETS] * times[a:z][:, None], first[s : s + 64] - a) / m[s : s + 64]
        hist = np.bincount(words.doc * SHAPES + sh, minlength=n * SHAPES).reshape(n, SHAPES)[docs]
        out[docs, DIMS : 2 * DIMS] = hist @ self.shape_index / m
        distinct = np.diff(np.append(first, len(pair)))
        size = np.diff(offs)[docs]
        most = np.maximum.reduceat(times, first)
        lines = np.add.reduceat(raw == 10, offs[docs])
        again = np.bincount(words.doc[1:][(b[1:] == b[:-1]) & (words.doc[1:] == words.doc[:-1])], minlength=n)[docs]
        m = m[:, 0]
        out[docs, 2 * DIMS :] = np.stack([np.log1p(m) / 4, distinct / m, most / m, size / m / 8, lines / m * 4, again / m], 1)
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def scores_raw(self, words: Words, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offs) - 1, self.constant)
        return sigmoid(self.logits(self.features(words, raw, offs)) / self.temperature)

    def scores(self, words: Words, offs: np.ndarray) -> np.ndarray:
        return self.scores_raw(words, words.raw, offs)


def contexts(docs: DataFrame, seed: int = 6) -> np.ndarray:
    """Summed context vectors of every word bucket, over all documents.  Tasks' sums are added up in slices; their size does not depend on the documents."""

    def run(batches):
        model, total = Model(seed), np.zeros((BUCKETS, DIMS))
        held, size = [np.zeros(0, np.int64)], 0
        for batch in batches:
            with np.errstate(over="ignore"):
                for _, _, buf, offs in doc_chunks(batch.column(0)):
                    held.append(model.neighbours(Words(buf, offs)))
                    size += len(held[-1])
                    if size >= HELD:
                        model.add_contexts(np.concatenate(held), total)
                        held, size = [np.zeros(0, np.int64)], 0
        model.add_contexts(np.concatenate(held), total)
        yield sliced(dict(enumerate(np.split(total.astype(np.float32), SLICES))))

    def sliced(sums):
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "sums"])

    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[k] = sums.get(k, 0) + np.frombuffer(x.as_buffer(), np.float32).astype(float)
        yield sliced(sums)

    parts = docs.select("text").mapInArrow(run, "slice int, sums binary")
    got = parts.repartition(SLICES, "slice").mapInArrow(added, "slice int, sums binary").collect()
    out = np.zeros((SLICES, BUCKETS // SLICES, DIMS))
    for r in got:
        out[r["slice"]] = np.frombuffer(r["sums"]).reshape(out.shape[1:])
    return out.reshape(BUCKETS, DIMS).astype(np.float32)


def fit(texts: list[str], y: np.ndarray, total: np.ndarray | None = None, epochs: int = 60, batch: int = 64, seed: int = 6) -> Model:
    """``total``: summed context vectors; without them, those of the texts."""
    model = Model(seed)
    if not len(y) or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 1.0
        return model
    rng = np.random.default_rng(seed)
    with np.errstate(over="ignore"):
        if total is None:
            total = np.zeros((BUCKETS, DIMS))
            for words, _ in word_chunks(texts):
                model.add_contexts(model.neighbours(words), total)
        model.set_contexts(total)
        x = np.concatenate([model.features(words, words.raw, offs) for words, offs in word_chunks(texts)])
    held = np.zeros(len(y), bool)
    held[rng.permutation(len(y))[: len(y) // 5]] = True
    model.mean, model.spread = x[~held].mean(0), x[~held].std(0) + 1e-3
    train = np.flatnonzero(~held)
    adam = Adam([model.w1, model.b1, model.w2, model.b2], 0.003)
    for _ in range(epochs):
        rng.shuffle(train)
        for s in range(0, len(train), batch):
            rows = train[s : s + batch]
            v = (x[rows] - model.mean) / model.spread
            h = np.tanh(v @ model.w1 + model.b1)
            g = (sigmoid(h @ model.w2 + model.b2[0]) - y[rows]) / len(rows)
            dh = g[:, None] * model.w2 * (1 - h * h)
            adam.step([v.T @ dh + 1e-3 * model.w1, dh.sum(0), h.T @ g + 1e-3 * model.w2, np.array([g.sum()])])
    model.temperature = temperature(model.logits(x[held]), y[held])
    return model


def trained(docs: DataFrame, labels: DataFrame, trains: Column | None = None) -> Model:
    texts, y = labelled_sample(docs, labels, "quality", F.lit(True) if trains is None else trains, MOST_ROWS, MOST_BYTES)
    return fit(texts, y, contexts(docs))


def score(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """(doc_id, carried columns, score) for every document."""
    return scored(docs, model.scores, *carry)
