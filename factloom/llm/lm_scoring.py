"""Cross-entropy difference: per-token loss under a target model minus loss under a background model.

Both are word bigram models of one kind over one vocabulary, the distinct words of both corpora and one for all others.  A pair's
probability is ``(count + ADDED) / (count of its first word as a first word + ADDED * vocabulary)``.  So a document's loss is a sum of terms that each
need one count, of a pair or of a first word, and counts never have to meet.

Documents are cut into blocks of some megabytes.  A block sends its distinct pairs and first words, as 64-bit hashes with the documents that have them,
to buckets of hash ranges.  A bucket so sees all blocks' counts of its keys: it adds them up for both corpora and gives each block
back the loss sums of its documents.  Nothing is capped: counts grow with the corpora, and no task or driver holds them whole.  A key that very
many documents of a block have goes to its bucket as one number; its documents wait for the answer where the block's sums
are gathered, so a word or pair that every document has costs its bucket one number a block.

The score is mean over a document's tokens of ``loss_target - loss_background`` in nats: the lower, the more the document is like the
target.  A document that is null, empty or blank has no tokens and the score null.  Words are as in the shingle operators;
each document begins after a start symbol.  With two empty corpora every loss is 0.  Repeated rows count and are scored once each; ids may be null or
repeated; other columns are not read.  A text of any length is one block, so memory follows the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import input_bytes, released
from .textops import U64, Words, doc_chunks, mix, planes, unplanes

ADDED = 0.01
START = U64(0x1D8E4E27C47D124F)
#: Words that a task counts before it passes them on; bytes of a block of documents; buckets, and input bytes of one.
COUNTED, BLOCK_BYTES = 2_000_000, (1 << 21) - 16
LEAST_BUCKETS, BUCKET_BYTES = 48, 4 << 20
#: Documents of a block from which a key's documents are not sent to its bucket.
MANY = 64
PAIR, FIRST = range(2)
#: What a row is to the block that it belongs to, in the order that the block reads them.
HEAD, SUMS, ANSWER, WAITING = range(4)
#: Kind of rows that only pass a bucket on their way to their block.
PASSING = -1
#: side: 1 counts for the target, 2 for the background.
PACKED = "bucket int, kind int, side int, block long, n int, keys binary, total binary, many binary, doc binary, times binary, wide binary, role int, part long, ids array<long>"
#: x, y, z: HEAD: tokens of each document; SUMS: documents, loss sums of both models; ANSWER: terms of both models; WAITING: documents of each key, which, how often.
GATHERED = "block long, role int, part long, ids array<long>, x binary, y binary, z binary"


def keys_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per word: the key of its pair with the word before it (START at a document's start), and that of the word before it."""
    h = words.hashes
    start = np.append(True, words.doc[1:] != words.doc[:-1])[: len(h)]
    before = np.where(start, START, np.roll(h, 1))
    return mix(before * U64(0x9E3779B97F4A7C15) + h), mix(before + U64(0x632BE59BD9B4E019))


def squeezed(values: np.ndarray, width: int) -> bytes:
    """Whole numbers as byte planes, compressed, behind their number of bytes."""
    data = planes(values, width)
    return len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def loosened(data: bytes, width: int) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    raw = pa.decompress(data[4:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return unplanes(raw, size // width, width)


def vocabulary(*corpora: DataFrame) -> int:
    """How many distinct words the corpora have."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            with np.errstate(over="ignore"):
                for _, _, buf, offs in doc_chunks(batch.column(0)):
                    held.append(np.unique(Words(buf, offs).hashes))
                    size += len(held[-1])
                    if size >= COUNTED:
                        held = [np.unique(np.concatenate(held))]
                        size = len(held[0])
                        if size >= COUNTED // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64))], ["word"])
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)).view(np.int64))], ["word"])

    words = [c.mapInArrow(run, "word long") for c in corpora]
    total = words[0]
    for w in words[1:]:
        total = total.unionByName(w)
    return total.distinct().count()


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(c.split(" ") for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows) if rows else [()] * len(names), types)], list(names))


def packed(texts: DataFrame, buckets: int, side: int, scored: bool) -> DataFrame:
    """Of (id, text): each block's keys by bucket with their counts, for scored texts with the documents of each key, and a head with the block's ids."""

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j, buf, offs in doc_chunks(batch.column(1), BLOCK_BYTES):
                with np.errstate(over="ignore"):
                    w = Words(buf, offs)
                    both = keys_of(w)
                rows = [passing(HEAD, block, 0, batch.column(0).slice(i, j - i).to_pylist(), w.counts.astype(np.int64).tobytes())] if scored else []
                for kind, key in enumerate(both):
                    if len(key):
                        rows += packed_keys(kind, key, w.doc, block)
                yield _table(PACKED, rows)
                block += 1

    def packed_keys(kind, key, doc, block):
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        # one number for the key's rank and the document: sorted, its runs are the entries
        bits = int(doc.max()).bit_length()
        entry = np.sort((np.cumsum(new) - 1) << bits | doc[order])
        at = np.flatnonzero(np.append(True, entry[1:] != entry[:-1]))
        times = np.diff(np.append(at, len(entry)))
        entry = entry[at]
        rank, doc = entry >> bits, entry & ((1 << bits) - 1)
        begin = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        many, total, key = np.diff(np.append(begin, len(rank))), np.add.reduceat(times, begin), key[new]
        bucket = ((key >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(key))
        edge = np.append(begin, len(rank))
        wide = many >= MANY
        slow = np.repeat(wide, many)
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            e = slice(edge[a], edge[z])
            b, shown = int(bucket[a]), (None,) * 4
            if scored:
                quick = ~slow[e]
                shown = (squeezed(np.where(wide[a:z], 0, many[a:z]), 4), squeezed(doc[e][quick], 4), squeezed(times[e][quick], 4), np.packbits(wide[a:z]).tobytes())
                if wide[a:z].any():
                    yield passing(WAITING, block, 2 * b + kind, None, squeezed(many[a:z][wide[a:z]], 4), squeezed(doc[e][~quick], 4), squeezed(times[e][~quick], 4))
            yield (b, kind, side, block, z - a, squeezed(key[a:z], 8), squeezed(total[a:z], 8), *shown, None, None, None)

    def passing(role, block, part, ids, x, y=None, z=None):
        return ((block + part) % buckets, PASSING, 0, block, 0, None, None, x, y, z, None, role, part, ids)

    return texts.mapInArrow(run, PACKED)


def answered(batches, size: int):
    """Rows sorted by bucket and kind: the loss sums of each block's documents, and the terms of the keys that its documents wait for."""
    held: list[tuple] = []

    def settled():
        keys = [loosened(r[5], 8) for r in held]
        counts = [loosened(r[6], 8).astype(np.int64) for r in held]
        key, count = np.concatenate(keys), np.concatenate(counts)
        side = np.repeat([r[2] for r in held], [len(k) for k in keys])
        order = np.argsort(key)
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(np.append(True, key[order][1:] != key[order][:-1])) - 1
        terms = []
        for bit in (1, 2):
            n = np.bincount(group, weights=count * (side & bit > 0))
            terms.append(-np.log(n + ADDED) if held[0][1] == PAIR else np.log(n + ADDED * size))
        at = 0
        for r, k in zip(held, keys):
            own = group[at : at + len(k)]
            at += len(k)
            if r[7] is None:
                continue
            many = loosened(r[7], 4).astype(np.int64)
            entries = int(many.sum())
            if entries:
                doc, times = (loosened(x, 4).astype(np.int64) for x in r[8:10])
                which = np.repeat(own, many)
                who = np.flatnonzero(np.bincount(doc))
                yield (r[3], SUMS, 0, None, who.tobytes(), *(np.bincount(doc, weights=times * x[which])[who].tobytes() for x in terms))
            wide = np.unpackbits(np.frombuffer(r[10], np.uint8), count=len(k)).astype(bool)
            if wide.any():
                yield (r[3], ANSWER, 2 * r[0] + r[1], None, *(x[own[wide]].tobytes() for x in terms), None)

    now = None
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            r = tuple(c[i].as_py() for c in batch.columns)
            if r[:2] != now:
                if held:
                    out += settled()
                now, held = r[:2], []
            if r[1] == PASSING:
                out.append((r[3], r[11], r[12], r[13], *r[7:10]))
            else:
                held.append(r)
            if len(out) >= 64:
                yield _table(GATHERED, out)
                out = []
        yield _table(GATHERED, out)
    if held:
        yield _table(GATHERED, list(settled()))


def gathered(batches):
    """Rows sorted by block and role: the scores of the block's documents."""
    block = ids = tokens = sums = None
    answers: dict[int, list[np.ndarray]] = {}

    def scores():
        none = tokens == 0
        a, b = (x / np.maximum(tokens, 1) for x in sums)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tokens), *(pa.array(x, mask=none) for x in (a, b, a - b))], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    for batch in batches:
        for at, role, part, names, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
            if role == HEAD:
                if block is not None:
                    yield scores()
                block, ids, tokens, answers = at, names, np.frombuffer(blobs[0], np.int64), {}
                sums = np.zeros((2, len(tokens)))
            elif role == SUMS:
                who = np.frombuffer(blobs[0], np.int64)
                for x, y in zip(sums, blobs[1:]):
                    x[who] += np.frombuffer(y)
            elif role == ANSWER:
                answers[part] = [np.frombuffer(x) for x in blobs[:2]]
            else:
                many = loosened(blobs[0], 4).astype(np.int64)
                doc, times = (loosened(x, 4).astype(np.int64) for x in blobs[1:])
                for x, terms in zip(sums, answers[part]):
                    x += np.bincount(doc, weights=times * np.repeat(terms, many), minlength=len(tokens))
    if block is not None:
        yield scores()


def cross_entropy_difference(docs: DataFrame, target: DataFrame, background: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score): mean losses per token and their difference.

    ``target`` and ``background`` have a column of the text's name; without a background, the documents themselves are it.
    """
    text = F.col(text_col).alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    known = [target.select(F.lit(None).cast("long").alias("doc_id"), text)]
    known.append(rows if background is None else background.select(F.lit(None).cast("long").alias("doc_id"), text))
    size = vocabulary(*(c.select("text") for c in known)) + 1
    released(docs.sparkSession)
    total = input_bytes(docs, text_col) + (0 if background is None else input_bytes(background, text_col))
    buckets = max(LEAST_BUCKETS, total // BUCKET_BYTES)
    parts = packed(rows, buckets, 2 if background is None else 0, True).unionByName(packed(known[0], buckets, 1, False))
    if background is not None:
        parts = parts.unionByName(packed(known[1], buckets, 2, False))
    # as many tasks as buckets, so that none holds many
    back = parts.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(lambda b: answered(b, size), GATHERED)
    back = back.repartition("block").sortWithinPartitions("block", "role")
    return back.mapInArrow(gathered, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
