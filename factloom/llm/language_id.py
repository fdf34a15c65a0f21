"""Language identification by hyperdimensional n-gram profiles.

Each letter has a random vector of +1 and -1.  A trigram's vector binds (multiplies) its letters' vectors, each permuted
by its place in the trigram; a text's vector bundles (adds) the vectors of its trigrams, and a language's prototype bundles
those of its training texts.  The language whose prototype has the largest cosine with the text is predicted.

Letters are lower-cased; a-z have a vector each, all other letters share 37 by code point.  Anything else ends a word; words are
set between blanks, which count as a letter.  A text that is null or has no letter gives ``und`` with score 0.  A tie goes to the language that sorts
first.  Without training rows every text gives ``und``.  A text of any
length is read whole; repeated rows get equal results; ids may be null or repeated and are passed on; other columns are not read.  The score is the softmax share of the chosen cosine.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS, SYMBOLS = 1024, 64
SHARPNESS = 20.0

_table: np.ndarray | None = None


def symbols() -> np.ndarray:
    """For each code point its symbol: 0 blank, 1-26 letters a-z, 27-63 other letters."""
    global _table
    if _table is None:
        table = np.zeros(sys.maxunicode + 1, np.uint8)
        for cp in range(sys.maxunicode + 1):
            c = chr(cp)
            if c.isalpha():
                low = ord(c.lower()[0])
                table[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 40503 >> 4) % 37
        _table = table
    return _table


def letter_vectors(seed: int = 9) -> list[np.ndarray]:
    """The letters' vectors, permuted by place: three tables of (symbols, dims) with entries +1 and -1."""
    rng = np.random.default_rng(seed)
    base = rng.choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMS))
    order = rng.permutation(DIMS)
    once = base[:, order]
    return [base, once, once[:, order]]


LETTERS = letter_vectors()


def trigrams(text: str) -> np.ndarray:
    """Trigram codes (three symbols of six bits) of a text; runs of blanks are one blank, with one at each end."""
    s = symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not s.any():
        return np.zeros(0, np.int32)
    s = np.concatenate([[0], s, [0]]).astype(np.int32)
    s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))]
    return (s[:-2] << 12 | s[1:-1] << 6 | s[2:])[s[1:-1] != 0]


def bundle(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sum of the vectors of distinct trigrams, each so many times."""
    out = np.zeros(DIMS)
    for k in range(0, len(codes), 4096):
        c = codes[k : k + 4096]
        bound = LETTERS[0][c >> 12] * LETTERS[1][c >> 6 & 63] * LETTERS[2][c & 63]
        out += n[k : k + 4096].astype(np.float32) @ bound.astype(np.float32)
    return out


def learn(docs: DataFrame, trains: Column) -> tuple[list[str], np.ndarray]:
    """(languages, unit prototypes) from all training rows.

    Bundling is a sum, so trigrams are counted by language first, and each distinct one is bound once; the driver gets one vector for
    each language.
    """
    rows = docs.select("text", F.col("lang").cast("string").alias("lang"), trains.alias("trains")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("trains"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(SYMBOLS**3, np.int64)
                codes, n = np.unique(trigrams(text), return_counts=True)
                sums[lang][codes] += n
        for lang, n in sums.items():
            codes = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n[codes])], ["lang", "code", "n"])

    def bind(batches):
        for batch in batches:
            lang, codes, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for one in set(lang):
                own = lang == one
                yield pa.RecordBatch.from_arrays([pa.array([one], pa.string()), pa.array([bundle(codes[own], n[own]).astype(float).tolist()], pa.list_(pa.float64()))], ["lang", "v"])

    counts = rows.select("lang", "text").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    parts = counts.mapInArrow(bind, "lang string, v array<double>")
    summed = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    got = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    langs = sorted(r.lang for r in got)
    vectors = {r.lang: np.array([p.x for p in r.v]) for r in got}
    if not langs:
        return [], np.zeros((0, DIMS), np.float32)
    protos = np.stack([vectors[x] for x in langs])
    norm = np.linalg.norm(protos, axis=1, keepdims=True)
    return langs, (protos / np.maximum(norm, 1e-9)).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], protos: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) for every document."""

    def run(batches):
        for batch in batches:
            pred, score = [], []
            for text in batch.column(1):
                codes = trigrams(text.as_py() or "")
                if not len(codes) or not langs:
                    pred.append("und"), score.append(0.0)
                    continue
                v = bundle(*np.unique(codes, return_counts=True))
                cos = (protos @ v).astype(float) / max(1e-9, float(np.linalg.norm(v)))
                best = int(np.argmax(cos))
                pred.append(langs[best])
                score.append(float(1 / np.exp(SHARPNESS * (cos - cos[best])).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
