"""Packing of tokenised documents into fixed-length sequences by the online sum-of-squares rule.

Each document is its token ids and an end id.  Whole windows of ``length`` ids become sequences of their
own; the rest is one item of an online packing problem.  A level array counts the open windows at each
fill level; an item goes to the level (or a new window) that makes the sum of squared counts of
partially filled windows least.  A partition packs its own documents as they stream by, so there is no
shuffle and a lost task is simply run again.  Open windows keep their ids; when a partition ends, items
of the emptiest windows are cut to fill the fullest, which leaves at most one partly filled window.

Null and empty texts are the end id alone; null ids stay null; repeated rows are packed once each.  A text of any length is cut into windows;
other columns are not read.  Ties go to the fuller level; equal levels fill the window opened last.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CHUNK, codec
from .textops import doc_chunks

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Sum-of-squares packing of one stream; ``out`` collects finished pieces."""

    def __init__(self, length: int, first_sequence: int) -> None:
        self.length, self.next_sequence = length, first_sequence
        self.levels = np.zeros(length + 1, np.int64)
        self.open: list[list] = [[] for _ in range(length + 1)]
        self.out: list[tuple] = []

    def _piece(self, item: tuple, sequence: int, offset: int) -> None:
        doc, start, ids, total = item
        self.out.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset))

    def _close(self, window: list) -> None:
        offset, sequence = 0, self.next_sequence
        self.next_sequence += 1
        for item in window:
            self._piece(item, sequence, offset)
            offset += len(item[2]) // 4

    def add(self, doc: int, ids: bytes) -> None:
        total, whole = len(ids) // 4, 4 * self.length
        at = 0
        while len(ids) - at >= whole:
            self._close([(doc, at // 4, ids[at : at + whole], total)])
            at += whole
        if at < len(ids):
            self._place((doc, at // 4, ids[at:], total))

    def choose(self, size: int) -> int:
        """The level whose use changes the sum of squares least: -2N(h)+1 for leaving h, 2N(h+size)+1 for reaching h+size."""
        n = self.levels
        stays = 2 * n[size:] + 1
        stays[-1] = 0  # a full window is no longer counted
        change = stays.copy()
        change[1:] -= 2 * n[1 : self.length + 1 - size] - 1
        change[1:][n[1 : self.length + 1 - size] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _place(self, item: tuple) -> None:
        size = len(item[2]) // 4
        level = self.choose(size)
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
        else:
            window = []
        window.append(item)
        if level + size == self.length:
            self._close(window)
        else:
            self.open[level + size].append(window)
            self.levels[level + size] += 1

    def finish(self) -> None:
        """Cut the items of the emptiest open windows to fill the fullest; only the last can stay partly filled."""
        windows = [(h, w) for h in range(self.length, 0, -1) for w in self.open[h]]
        self.open, self.levels = [[] for _ in range(self.length + 1)], np.zeros(self.length + 1, np.int64)
        lo, hi, spare = 0, len(windows), []
        while lo < hi:
            h, window = windows[lo]
            lo += 1
            gap = self.length - h
            while gap and (spare or lo < hi):
                if not spare:
                    hi -= 1
                    spare = list(windows[hi][1])
                doc, start, ids, total = spare.pop()
                take = min(gap, len(ids) // 4)
                window.append((doc, start, ids[: 4 * take], total))
                if 4 * take < len(ids):
                    spare.append((doc, start + take, ids[4 * take :], total))
                gap -= take
            self._close(window)
            if lo == hi and spare:
                windows.append((sum(len(x[2]) // 4 for x in spare), spare))
                spare, hi = [], hi + 1
                windows[lo:] = windows[-1:]
        self.open = [[] for _ in range(self.length + 1)]

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = zip(*rows) if rows else [()] * len(COLUMNS)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COLUMNS))


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence, with a checksum of its ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        packer = Packer(length, TaskContext.get().partitionId() << 32)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, _, buf, offs in doc_chunks(batch.column(1), CHUNK):
                for k, x in enumerate(c.encode_chunk(buf, offs)):
                    packer.add(ids[i + k], x.astype("<u4", copy=False).tobytes() + end)
                if packer.out:
                    yield packer.batch()
        packer.finish()
        yield packer.batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
