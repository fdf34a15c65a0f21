"""Vectorised byte-level helpers shared by the text operators.

Texts reach Python as Arrow batches.  ``doc_chunks`` turns a string column into runs of whole documents
over one contiguous byte buffer, so that hashing, word splitting and window scans are numpy passes over
many documents at once, with memory bounded by the chunk size (or by one document, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: ASCII white space as the word operators define it: space and bytes 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: A little less than a power of two, so that tables by byte of a chunk have that size.
CHUNK_BYTES = (1 << 19) - 16


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: two rounds of multiply and xor-shift."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xCA5A826395121157)
    x ^= x >> U64(32)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n+1 offsets of its rows; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def doc_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole documents of about ``limit`` bytes."""
    buf, offs = text_bytes(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


class Words:
    """Words of a chunk: start and end byte, document index, 64-bit hash, and words per document."""

    _letters = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
    _power = np.ones(1, U64)
    _inverse = np.ones(1, U64)
    _base = 0x5851F42D4C957F2D

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool = True) -> None:
        self.raw, n = buf, len(buf)
        inside = ~SPACE[buf]
        begins = np.zeros(n + 1, bool)
        begins[offs] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | begins[:n]))
        self.ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
        self.doc = np.searchsorted(offs, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=len(offs) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.buf = LOWER[buf] if lower else buf
        self._n = n

    @classmethod
    def _powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._power) < n:
            size = 1 << max(19, int(n - 1).bit_length())
            with np.errstate(over="ignore"):
                cls._power = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, U64(cls._base))]), dtype=U64)
                cls._inverse = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, U64(pow(cls._base, -1, 1 << 64)))]), dtype=U64)
        return cls._power, cls._inverse

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans: a polynomial over random letter codes, then a finaliser with the length."""
        if not hasattr(self, "_sums"):
            power, _ = self._powers(self._n + 1)
            self._sums = np.zeros(self._n + 1, U64)
            np.cumsum(self._letters[self.buf] * power[: self._n], out=self._sums[1:])
        inverse = self._powers(self._n + 1)[1]
        return mix((self._sums[ends] - self._sums[starts]) * inverse[starts] + (ends - starts).astype(U64))

    @property
    def hashes(self) -> np.ndarray:
        if not hasattr(self, "_hashes"):
            self._hashes = self.hash_spans(self.starts, self.ends)
        return self._hashes


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every run of ``width`` words; a shorter document gives its whole sequence."""
    h, m = words.hashes, len(words.hashes)
    step = U64(0x9E3779B97F4A7C15)
    docs, out = [], []
    if m >= width:
        s = h[: m - width + 1].copy()
        for k in range(1, width):
            s = mix(s * step + h[k : m - width + 1 + k])
        whole = words.doc[: m - width + 1] == words.doc[width - 1 :]
        docs.append(words.doc[: m - width + 1][whole])
        out.append(s[whole])
    for few in range(1, width):
        at = np.flatnonzero(words.counts == few)
        if len(at):
            first = words.first[at]
            s = h[first].copy()
            for k in range(1, few):
                s = mix(s * step + h[first + k])
            docs.append(at)
            out.append(mix(s + U64(few)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    doc, s = np.concatenate(docs), np.concatenate(out)
    order = np.argsort(doc, kind="stable")
    return doc[order], s[order]


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of whole numbers, byte by byte of equal weight, so that high bytes compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes | memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").ravel()


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
