"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of the hashed embeddings of the whole word and of its first four and five bytes, so inflected
forms share what their stem has taught.  Filters of several widths slide over the words of a document; each filter's maximum
over the document feeds a logistic output, calibrated by a temperature on held-back training rows.  The first embedding
dimension starts from the log ratio of document frequencies in the two classes, the rest at random; everything is then
trained by back-propagation through the maxima.

A score depends on the text alone.  ``thresholds`` are calibrated by language on labelled rows afterwards: the least score at
which at least ``precision`` of the flagged rows of that language are toxic.

Null, empty and blank texts have no words: their pooled features are zero and their score is the output's bias.  Repeated rows get equal scores; null
and repeated ids are passed on, and labels of null ids are not read; other columns may have any name.  A text of any length is scored whole.
Without training rows of both classes every score is the share of label 1 (0, if there are none).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fitting import Adam, labelled_sample, scored, sigmoid, temperature, with_scores, word_chunks
from .textops import U64, Words, mix

BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
PREFIXES = (4, 5)
MOST_ROWS, MOST_BYTES = 6000, 14_000_000
#: Bounds of thresholds: none is lower than FLOOR, and with too few toxic rows it is CAUTIOUS, so that clean documents stay.
FLOOR, CAUTIOUS = 0.5, 0.95
#: Scores from 0 to 1 that thresholds tell apart; all below FLOOR are one.
SCORE_BINS = 4096


class Network:
    """Embeddings, one filter bank per width, output weights; ``bias`` only if ``constant`` is set."""

    def __init__(self, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.05, (BUCKETS, DIMS)).astype(np.float32)
        self.filters = [rng.normal(0, 0.3, (w * DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for w, f in zip(WIDTHS, self.filters):
            f[np.arange(w) * DIMS] = np.abs(f[np.arange(w) * DIMS]) + 0.2  # the first dimension begins as evidence for label 1
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
        self.bias = np.zeros(1, np.float32)
        self.temperature = 1.0
        self.constant: float | None = None

    @staticmethod
    def features(words: Words) -> np.ndarray:
        """Hash buckets of each word and its prefixes: (words, 1 + prefixes)."""
        ends = [np.minimum(words.starts + p, words.ends) for p in PREFIXES]
        hashes = [words.hashes, *(words.hash_spans(words.starts, e) for e in ends)]
        return np.stack([(mix(h + U64(k)) & U64(BUCKETS - 1)).astype(np.int32) for k, h in enumerate(hashes)], 1)

    def vectors(self, feats: np.ndarray) -> np.ndarray:
        return self.emb[feats[:, 0]] + self.emb[feats[:, 1]] + self.emb[feats[:, 2]]

    def pooled(self, vec: np.ndarray, first: np.ndarray, counts: np.ndarray, argmax: bool = False):
        """Per document and filter the greatest activation (at least 0), and where it is, if asked for."""
        docs = np.flatnonzero(counts)
        pool = np.zeros((len(counts), FILTERS * len(WIDTHS)), np.float32)
        places = []
        for k, (w, f, s) in enumerate(zip(WIDTHS, self.filters, self.shift)):
            # windows may run over a document's end: there, words count as zero
            act = vec @ f[:DIMS] + s
            for j in range(1, w):
                part = vec[j:] @ f[j * DIMS : (j + 1) * DIMS]
                inside = self._left[: len(part)] > j
                act[: len(part)] += part * inside[:, None]
            if len(docs):
                top = np.maximum.reduceat(act, first[docs])
                pool[docs, k * FILTERS : (k + 1) * FILTERS] = np.maximum(top, 0)
            if argmax:
                at = np.zeros((len(counts), FILTERS), np.int64)
                for d in docs:
                    at[d] = first[d] + act[first[d] : first[d] + counts[d]].argmax(0)
                places.append(at)
        return (pool, places) if argmax else pool

    def prepare(self, first: np.ndarray, counts: np.ndarray) -> None:
        """How many words of its document each word has from itself on."""
        total = int(counts.sum())
        self._left = np.repeat(first[:-1] + counts, counts) - np.arange(total)

    def logits(self, words: Words) -> np.ndarray:
        self.prepare(words.first, words.counts)
        pool = self.pooled(self.vectors(self.features(words)), words.first, words.counts)
        return (pool @ self.out + self.bias[0]) / self.temperature

    def scores(self, words: Words, offs: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offs) - 1, self.constant)
        return sigmoid(self.logits(words).astype(float))


def fit(texts: list[str], y: np.ndarray, steps: int = 600, batch: int = 48, seed: int = 2) -> Network:
    net = Network(seed)
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    rng = np.random.default_rng(seed)
    with np.errstate(over="ignore"):
        parts = [(w.counts, net.features(w)) for w, _ in word_chunks(texts)]
    counts, feats = np.concatenate([c for c, _ in parts]), np.concatenate([f for _, f in parts])
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(y)), counts)
    held = np.zeros(len(y), bool)
    held[rng.permutation(len(y))[: len(y) // 5]] = True
    # evidence: log ratio of document frequencies per bucket, over the rows that are trained on
    df = []
    for label in (1, 0):
        count = np.zeros(BUCKETS)
        for k in range(feats.shape[1]):
            use = (y[owner] == label) & ~held[owner]
            pairs = np.unique(owner[use] * BUCKETS + feats[use, k])
            count += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        df.append(count)
    n1, n0 = (y[~held] == 1).sum(), (y[~held] == 0).sum()
    ratio = np.log((df[0] + 0.5) / (n1 + 1)) - np.log((df[1] + 0.5) / (n0 + 1))
    # rare buckets are evidence of nothing yet
    seen = df[0] + df[1]
    net.emb[:, 0] = np.clip(ratio, -3, 3) / 3 * seen**2 / (seen**2 + 25)
    train = np.flatnonzero(~held)
    dense = Adam([*net.filters, *net.shift, net.out, net.bias], 0.01)
    weight = np.where(y == 1, 0.5 / max(n1, 1), 0.5 / max(n0, 1)) * len(train)
    weight = np.sqrt(weight)
    for _ in range(int(np.clip(steps * batch / max(1, len(train)), 4, 120))):
        rng.shuffle(train)
        for b in range(0, len(train), batch):
            rows = train[b : b + batch]
            size = counts[rows]
            begin = np.concatenate([[0], np.cumsum(size)])
            take = np.concatenate([np.arange(first[r], first[r + 1]) for r in rows])
            f = feats[take]
            vec = net.vectors(f)
            net.prepare(begin, size)
            pool, places = net.pooled(vec, begin, size, argmax=True)
            z = pool @ net.out + net.bias[0]
            g = ((sigmoid(z) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            d_out = pool.T @ g + 1e-4 * net.out
            d_pool = g[:, None] * net.out[None] * (pool > 0)
            d_filters, d_shift = [np.zeros_like(x) for x in net.filters], [np.zeros_like(x) for x in net.shift]
            for k, w in enumerate(WIDTHS):
                dk = d_pool[:, k * FILTERS : (k + 1) * FILTERS]
                d_shift[k] = dk.sum(0)
                for q in range(FILTERS):
                    act = np.flatnonzero(dk[:, q])
                    if not len(act):
                        continue
                    for j in range(w):
                        at = places[k][act, q]
                        ok = net._left[at] > j
                        at, gg = at[ok] + j, dk[act[ok], q]
                        d_filters[k][j * DIMS : (j + 1) * DIMS, q] += vec[at].T @ gg
                        move = gg[:, None] * net.filters[k][j * DIMS : (j + 1) * DIMS, q][None]
                        for c in range(f.shape[1]):
                            np.add.at(net.emb, f[at, c], -2.0 * move)
            dense.step([*d_filters, *d_shift, d_out, np.array([g.sum()], np.float32)])
    rows = np.flatnonzero(held)
    z = np.zeros(len(y))
    for b in range(0, len(rows), batch):
        some = rows[b : b + batch]
        size = counts[some]
        begin = np.concatenate([[0], np.cumsum(size)])
        net.prepare(begin, size)
        take = np.concatenate([np.arange(first[r], first[r + 1]) for r in some])
        z[some] = net.pooled(net.vectors(feats[take]), begin, size) @ net.out + net.bias[0]
    net.temperature = temperature(z[held].astype(float), y[held])
    return net


def thresholds(rows: list, precision: float = 0.98, least: int = 20) -> dict:
    """By language, the least score of at least FLOOR at which ``precision`` of flagged rows are toxic.

    A row holds the lang, number, toxic number, least and greatest score of a bin of scores of a language.
    The key None holds the threshold of all rows together, for languages with fewer than ``least`` toxic rows; where even those are too
    few, it is CAUTIOUS.
    """
    out = {None: CAUTIOUS}
    bins: dict = {None: {}}
    for lang, k, *row in rows:
        for key in {None, lang}:
            old = bins.setdefault(key, {}).get(k, (0, 0, 1.0, 0.0))
            bins[key][k] = (old[0] + row[0], old[1] + row[1], min(old[2], row[2]), max(old[3], row[3]))
    for lang, own in bins.items():
        n, toxic, low, high = (np.array(x) for x in zip(*(own[k] for k in sorted(own, reverse=True)))) if own else [np.zeros(0)] * 4
        if toxic.sum() < least:
            continue
        last = np.flatnonzero(np.cumsum(toxic) >= precision * np.cumsum(n))
        if len(last):
            below = high[last[-1] + 1] if last[-1] + 1 < len(n) else 0.0
            out[lang] = max(FLOOR, float((low[last[-1]] + below) / 2))
    return out


def trained(docs: DataFrame, labels: DataFrame, trains: Column | None = None) -> Network:
    texts, y = labelled_sample(docs, labels, "toxic", F.lit(True) if trains is None else trains, MOST_ROWS, MOST_BYTES)
    return fit(texts, y)


def score(docs: DataFrame, net: Network, *carry: str) -> DataFrame:
    """(doc_id, carried columns, score) for every document."""
    return scored(docs, net.scores, *carry)


def language_thresholds(docs: DataFrame, labels: DataFrame, net: Network, trains: Column) -> dict:
    """Thresholds from the scores of all labelled rows that the network may learn from, counted by language and bin of scores."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("y")).filter(trains)
    # scored before the join, so that no text is shuffled
    rows = score(docs.select("doc_id", "text", "lang"), net, "lang").join(known, "doc_id")
    k = F.when(F.col("score") < FLOOR, -1).otherwise(F.floor(F.col("score") * SCORE_BINS)).alias("bin")
    got = rows.groupBy("lang", k).agg(F.count("*"), F.sum("y"), F.min("score"), F.max("score")).collect()
    return thresholds([tuple(r) for r in got])


def limit_of(limits: dict, language: Column) -> Column:
    limit = F.lit(limits[None])
    for lang, value in limits.items():
        if lang is not None:
            limit = F.when(language == lang, value).otherwise(limit)
    return limit


def flagged(docs: DataFrame, net: Network, limits: dict) -> DataFrame:
    """(doc_id, score, toxic): toxic where the score reaches the threshold of the document's language."""
    return score(docs, net, "lang").select("doc_id", "score", (F.col("score") >= limit_of(limits, F.col("lang"))).alias("toxic"))


def accepted(docs: DataFrame, net: Network, limits: dict) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    lang = F.col(f"c{docs.columns.index('lang')}")
    return with_scores(docs, net.scores).filter(F.col("score") < limit_of(limits, lang)).drop("score").toDF(*docs.columns)
