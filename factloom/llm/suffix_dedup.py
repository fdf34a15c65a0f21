"""Removal of long repeated byte strings with a run-length (r-) index over the repetitive part of the corpus.

A byte goes if it lies in a ``length``-byte string that also starts in a document with a smaller id.

1. Phrases.  Every window of ``length`` bytes has a minimiser: the gram with the least hash in it.  Consecutive windows with one
   minimiser are a cell, and its text a phrase: the parse of a prefix-free-parsing construction.  A task collapses equal
   phrases (by 80 bits of hashes of their windows and their minimiser, beside the bucket) to their smallest document.
2. Dictionary.  Phrases are dealt by the hash of their minimiser.  An occurrence of a phrase that a smaller document has is covered whole.
   Phrases whose minimiser no other document has are done.  What is left - each distinct phrase about a shared minimiser, in its
   smallest document - is the dictionary to be indexed.
3. Index.  Phrase texts are dealt by minimiser, in parts of bounded size.  Each part builds a run-compressed Burrows-Wheeler transform
   with sampled run ends, streams matching statistics off the samples and chains the suffixes that match in ``length``
   symbols or more; a window is marked if the least owner of its chain is smaller than its own.  Minimisers with very many
   distinct phrases (the edges of a passage that a large share of documents has) are dealt by window, not by minimiser, after equal
   windows have been collapsed in each task, so no part has to hold a hot minimiser.
4. Marks are joined to the documents and cut out.

Texts are dealt by row to a bucketed table once; what is told of a row meets its text there without a second shuffle of texts.
Nothing is broadcast or collected; each task holds a bounded run of documents or one bucket, and buckets follow the input's size.
Rows are numbered as they are read, so the input must give the same rows in the same order if a lost task reads it again (a file scan does).

Null text counts as empty; documents below ``length`` bytes lose nothing.  A null id sorts after all others.  Rows with equal
ids do not cover each other; matches inside a document do not count.
Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .run_index import RunIndex
from .scratch import input_bytes, released, written
from .textops import U64, doc_chunks, planes, unplanes

GRAM = 20
#: A row holds less than 2 ** 31 bytes.
POSITION_BITS = U64(31)
#: Routes of cells to be matched; they are dealt over the buckets.
ROUTES = (1 << 22) - 3
#: Distinct cells of a minimiser from which its windows are dealt one by one: in one flush of a task, and in a bucket.
HOT, HOT_BUCKET = 1024, 1 << 14
#: Documents whose texts are dealt at once.
DEALT = 1000
#: Cells that a task collects before it passes them on; input bytes of a bucket; bytes that are hashed and indexed at once.
FLUSH, BUCKET_BYTES, CHUNK, PART = 400_000, 4_000_000, 1 << 18, 600_000


def _joined(h: np.ndarray, gap: int, count: int) -> np.ndarray:
    """Hashes of byte runs from the hashes of their first and last parts."""
    x = h[:count] * U64(0xD6E8FEB86659FD93)
    x += h[gap : gap + count]
    x *= U64(0xCA5A826395121157)
    x ^= x >> U64(32)
    return x


def grams(buf: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all byte runs of the given sizes (8 or more), built by doubling from 8-byte loads."""
    n = len(buf)
    h = np.ndarray((n - 7,), np.dtype("<u8"), np.ascontiguousarray(buf), 0, (1,)) * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    levels, step = {8: h}, 8
    while 2 * step <= max(sizes):
        levels[2 * step] = _joined(levels[step], step, n - 2 * step + 1)
        step *= 2
    out = []
    for size in sizes:
        base = max(s for s in levels if s <= size)
        out.append(_joined(levels[base], size - base, n - size + 1))
    return out


def cells(buf: np.ndarray, offs: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, minimiser hash, content hash) of every cell of a chunk of documents."""
    none = (*(np.zeros(0, np.int64) for _ in range(3)), *(np.zeros(0, U64) for _ in range(2)))
    long_enough = np.flatnonzero(np.diff(offs) >= length)
    if not len(long_enough):
        return none
    g, whole = grams(buf, (gram, length))
    # the low bits tell places apart, so that the leftmost of equal grams is the minimiser
    key = g >> POSITION_BITS << POSITION_BITS
    key |= np.arange(len(g), dtype=U64)
    width = length - gram + 1
    least, reach = key, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: reach - width], least[width - reach :])
    inside = np.zeros(len(least) + 1, np.int8)
    inside[offs[long_enough]] += 1
    inside[offs[long_enough + 1] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    anchor = (least[at] & ((U64(1) << POSITION_BITS) - U64(1))).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    windows = np.diff(np.append(first, len(at)))
    content = _joined(np.concatenate([np.add.reduceat(whole[at], first), windows.astype(U64)]), len(first), len(first))
    begin = at[first]
    doc = np.searchsorted(offs, begin, "right") - 1
    return doc, begin - offs[doc], windows, g[anchor[first]], content


#: Columns of a blob and their bytes each.  Keys: a document's owner (its id) and row.
KEYS = (("owner", 8), ("row", 8))
#: Cells; h are the leading bytes of a minimiser's hash, whose rest its bucket partly tells, doc is a place in the keys.
ENTRY = (("h", 4), ("c", 6), ("doc", 4), ("at", 4), ("n", 1))
#: Texts to be matched; their bytes follow.
TEXTS = (("doc", 4), ("at", 4), ("n", 1), ("route", 4))


def blob(fields: dict[str, np.ndarray], spec: tuple) -> bytes:
    return b"".join(planes(fields[k], w) for k, w in spec)


def unblob(data: bytes, spec: tuple, n: int) -> dict[str, np.ndarray]:
    out, at, view = {}, 0, memoryview(data)
    for k, w in spec:
        out[k] = unplanes(view[at : at + n * w], n, w)
        at += n * w
    return out


def key_blob(owner: np.ndarray, row: np.ndarray) -> bytes:
    return blob({"owner": owner.view(U64), "row": row.view(U64)}, KEYS)


def unkey(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = unblob(data, KEYS, len(data) // 16)
    return k["owner"].view(np.int64), k["row"].view(np.int64)


#: A blob of a bucket (n entries), or what is told of one row: cells that are covered, and cells to be matched.
PARTS = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("entries", pa.binary()), ("row", pa.int64()), ("done", pa.list_(pa.int64())), ("late", pa.list_(pa.int64()))])
PARTS_SQL = "bucket int, n int, keys binary, entries binary, row long, done array<long>, late array<long>"
TOLD = pa.schema([PARTS.field(k) for k in ("row", "done", "late")])
TOLD_SQL = "row long, done array<long>, late array<long>"


def record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * len(PARTS), PARTS.types)], schema=PARTS)


def passed_on(told: pa.Table, buckets: int) -> pa.RecordBatch:
    """What is told already, dealt over the buckets."""
    n = told.num_rows
    bucket = pa.array(np.arange(n) % buckets, pa.int32())
    none = [pa.nulls(n, PARTS.field(k).type) for k in ("n", "keys", "entries")]
    return pa.RecordBatch.from_arrays([bucket, *none, *(c.combine_chunks() for c in told.columns)], schema=PARTS)


def coded(at: np.ndarray, n: np.ndarray, route: np.ndarray | int = 0) -> np.ndarray:
    """A told cell as one number: first window (31 bits), windows (9), route (23; 0: its windows go one by one)."""
    return at.astype(np.int64) << 32 | n.astype(np.int64) << 23 | route


def decoded(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return code >> 32, code >> 23 & 511, code & ((1 << 23) - 1)


def by_row(row: np.ndarray, code: np.ndarray, late: np.ndarray) -> pa.Table:
    """(row, done, late) of told cells."""
    order = np.lexsort((late, row))
    row, code, late = row[order], code[order], late[order]
    used, begin = np.unique(row, return_index=True)
    edges = np.append(begin, len(row))
    split = edges[1:] - np.add.reduceat(late, begin) if len(row) else begin
    lists = []
    for keep, lo, hi in ((~late, edges[:-1], split), (late, split, edges[1:])):
        size = hi - lo
        offsets = pa.array(np.append(0, np.cumsum(size)), pa.int32())
        lists.append(pa.ListArray.from_arrays(offsets, pa.array(code[keep], pa.int64()), mask=pa.array(size == 0)))
    return pa.Table.from_arrays([pa.array(used, pa.int64()), *lists], schema=TOLD)


class PhraseTask:
    """Collects the cells of a run of documents; ``flush`` gives blobs by bucket and what is known already."""

    def __init__(self, buckets: int, length: int, hot: int) -> None:
        self.buckets, self.length, self.hot = buckets, length, hot
        self.reset()

    def reset(self) -> None:
        self.parts, self.owners, self.rows, self.docs, self.size = [], [], [], 0, 0

    def add(self, owners: np.ndarray, rows: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> None:
        doc, *rest = cells(buf, offs, self.length, gram_of(self.length))
        self.parts.append((doc + self.docs, *rest))
        self.owners.append(owners)
        self.rows.append(rows)
        self.docs += len(rows)
        self.size += len(doc)

    def flush(self):
        """Record batches."""
        if not self.size:
            return self.reset()
        doc, at, n, h, c = (np.concatenate(x) for x in zip(*self.parts))
        owners, rows = np.concatenate(self.owners), np.concatenate(self.rows)
        self.reset()
        c &= (U64(1) << U64(48)) - U64(1)
        owner = owners[doc]
        order = np.lexsort((owner, c, h))
        doc, at, n, h, c, owner = (x[order] for x in (doc, at, n, h, c, owner))
        new_h = np.append(True, h[1:] != h[:-1])
        new_c = new_h | np.append(True, c[1:] != c[:-1])
        first = np.flatnonzero(new_c)
        covered = owner > np.repeat(owner[first], np.diff(np.append(first, len(h))))
        group = np.cumsum(new_h) - 1
        hot = (np.bincount(group[first]) >= self.hot)[group]
        # a hot minimiser is announced to its bucket (no windows); its cells are dealt by window
        mark = np.flatnonzero(new_h & hot)
        send = np.concatenate([np.flatnonzero(~covered & ~hot), mark])
        windows = n[send].copy()
        windows[len(send) - len(mark) :] = 0
        bucket = (h[send] % U64(self.buckets)).astype(np.int64)
        by = np.lexsort((at[send], doc[send], bucket))
        send, windows, bucket = send[by], windows[by], bucket[by]
        cut = np.searchsorted(bucket, np.arange(self.buckets + 1))
        blobs = []
        for b in np.flatnonzero(np.diff(cut)):
            s = slice(cut[b], cut[b + 1])
            used, local = np.unique(doc[send[s]], return_inverse=True)
            entries = blob({"h": h[send[s]] >> U64(32), "c": c[send[s]], "doc": local, "at": at[send[s]], "n": windows[s]}, ENTRY)
            blobs.append((int(b), len(local), key_blob(owners[used], rows[used]), entries, None, None, None))
        yield record(blobs)
        known = np.flatnonzero(covered | hot)
        yield passed_on(by_row(rows[doc[known]], coded(at[known], n[known]), ~covered[known]), self.buckets)


def gram_of(length: int) -> int:
    """Long enough that a cell has no more than 250 windows."""
    if length < 16:
        raise ValueError("length must be 16 or more")
    return min(max(GRAM, length - 250), length)


def known_rows(table: pa.Table) -> pa.Table:
    """What tasks have told already, passed on."""
    return table.filter(pc.is_valid(table.column("row"))).select(["row", "done", "late"]).cast(TOLD)


def unpacked(table: pa.Table, spec: tuple) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray], list[memoryview]]:
    """Owners and rows of all entries of a bucket's blobs, their columns, and what follows the columns in each blob."""
    rest = table.filter(pc.is_valid(table.column("entries")))
    width = sum(w for _, w in spec)
    owners, rows, parts, tails = [], [], [], []
    for n, keys, entries in zip(*(rest.column(c) for c in ("n", "keys", "entries"))):
        n, entries = n.as_py(), entries.as_py()
        o, r = unkey(keys.as_py())
        e = unblob(entries, spec, n)
        owners.append(o[e["doc"].astype(np.int64)])
        rows.append(r[e["doc"].astype(np.int64)])
        parts.append(e)
        tails.append(memoryview(entries)[n * width :])
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), {k: np.zeros(0, U64) for k, _ in spec}, []
    return np.concatenate(owners), np.concatenate(rows), {k: np.concatenate([p[k] for p in parts]) for k, _ in spec}, tails


def settle(table: pa.Table, hot_bucket: int) -> pa.Table:
    """One bucket: what its phrases' owners and neighbours say of each row's cells."""
    out = [known_rows(table)]
    owner, row, e, _ = unpacked(table, ENTRY)
    real = e["n"] > 0
    marked = np.unique(e["h"][~real])
    order = np.flatnonzero(real)
    order = order[np.lexsort((owner[order], e["c"][order], e["h"][order]))]
    owner, row, h, c, at, n = (x[order] for x in (owner, row, e["h"], e["c"], e["at"], e["n"]))
    if len(h):
        new_h = np.append(True, h[1:] != h[:-1])
        new_c = new_h | np.append(True, c[1:] != c[:-1])
        first = np.flatnonzero(new_c)
        covered = owner > np.repeat(owner[first], np.diff(np.append(first, len(h))))
        group = np.cumsum(new_h) - 1
        start = np.flatnonzero(new_h)
        lo, hi = np.minimum.reduceat(owner, start), np.maximum.reduceat(owner, start)
        distinct = np.bincount(group[first])
        hot = (distinct >= hot_bucket) | np.isin(h[start], marked)
        late = ~covered & (hot | ((distinct > 1) & (lo < hi)))[group]
        route = np.where(hot[group], 0, (h % U64(ROUTES)).astype(np.int64) + 1)
        tell = np.flatnonzero(covered | late)
        out.append(by_row(row[tell], coded(at[tell], n[tell], np.where(covered[tell], 0, route[tell])), late[tell]))
    return pa.concat_tables(out)


def deal(batches, buckets: int, length: int):
    """Texts of unsettled cells, by route; equal single windows are collapsed to their smallest owner first, in runs of some documents."""
    for batch in (b.slice(k, DEALT) for b in batches for k in range(0, max(1, b.num_rows), DEALT)):
        owners, ids = (batch.column(k).to_numpy() for k in range(2))
        texts: dict[int, list] = {}
        covered: list[tuple[int, int]] = []
        single: dict[bytes, tuple] = {}
        for r, (own, text, late) in enumerate(zip(owners.tolist(), batch.column(2), batch.column(3))):
            text = text.as_py()
            for at, n, route in zip(*(x.tolist() for x in decoded(late.values.to_numpy()))):
                if route:
                    texts.setdefault(route % buckets, []).append((r, at, n, route, text[at : at + n - 1 + length]))
                    continue
                for p in range(at, at + n):
                    w = text[p : p + length]
                    other = single.get(w)
                    if other is None or own < other[0]:
                        if other is not None:
                            covered.append(other[1:])
                        single[w] = (own, r, p)
                    elif own > other[0]:
                        covered.append((r, p))
                    else:  # the same document again: both stay to be judged
                        texts.setdefault(window_route(w) % buckets, []).append((r, p, 1, window_route(w), w))
        for w, (_, r, p) in single.items():
            texts.setdefault(window_route(w) % buckets, []).append((r, p, 1, window_route(w), w))
        out = []
        for b, some in texts.items():
            doc, at, n, route = (np.array(x, np.int64) for x in list(zip(*some))[:4])
            used, local = np.unique(doc, return_inverse=True)
            fields = {"doc": local, "at": at, "n": n, "route": route}
            out.append((b, len(some), key_blob(owners[used], ids[used]), blob(fields, TEXTS) + b"".join(x[4] for x in some), None, None, None))
        if covered:
            doc, at = np.array(covered, np.int64).T
            yield passed_on(by_row(ids[doc], coded(at, np.ones(len(at))), np.zeros(len(at), bool)), buckets)
        yield record(out)


def window_route(window: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(window) % ROUTES + 1


def marked_windows(index: RunIndex, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, first symbol) of every window that a segment of a smaller owner has, too."""
    at, least = index.least_owners(owners, length)
    segment = np.searchsorted(index.starts, at, "right") - 1
    gone = least < owners[segment]
    return segment[gone], (at - index.starts[segment])[gone]


def match(table: pa.Table, length: int, part: int) -> pa.Table:
    """One bucket of texts: index them, in parts of whole routes, and mark each window that also stands in a text of a smaller owner."""
    out = [known_rows(table)]
    owner, row, e, tails = unpacked(table, TEXTS)
    size = e["n"].astype(np.int64) + length - 1
    data = np.frombuffer(b"".join(tails), np.uint8)
    begin = np.cumsum(size) - size
    order = np.argsort(e["route"], kind="stable")
    route, total = e["route"][order], np.cumsum(size[order])
    k = 0
    while k < len(order):
        # as many routes as have so many bytes, one at least
        to = int(np.searchsorted(total, total[k] - size[order[k]] + part, "right"))
        to = int(np.searchsorted(route, route[max(k, to - 1)], "right"))
        some = order[k:to]
        lens = size[some]
        spot = np.repeat(begin[some] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
        segment, p = marked_windows(RunIndex(data[spot], lens), owner[some], length)
        if len(segment):
            # consecutive windows of one text are one run
            first = np.flatnonzero(np.append(True, (segment[1:] != segment[:-1]) | (p[1:] != p[:-1] + 1)))
            n = np.diff(np.append(first, len(p)))
            who = some[segment[first]]
            out.append(by_row(row[who], coded(e["at"][who].astype(np.int64) + p[first], n), np.zeros(len(first), bool)))
        k = to
    return pa.concat_tables(out)


def removed_runs(at: np.ndarray, n: np.ndarray, size: int, length: int) -> np.ndarray:
    """Maximal runs (start, end) of bytes covered by windows given as (first window, windows)."""
    if not len(at):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(at)
    lo = at[order]
    hi = np.maximum.accumulate(np.minimum(lo + n[order] - 1 + length, size))
    first = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return np.stack([lo[first], hi[np.append(first[1:], len(lo)) - 1]], 1)


def kept_bytes(text: bytes, runs: np.ndarray) -> bytes:
    if not len(runs):
        return text
    edges = [0, *runs.ravel().tolist(), len(text)]
    return b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))


def processed(docs: DataFrame, length: int, id_col: str, text_col: str, carry: list[str], emit: Callable[[bytes, np.ndarray], tuple], fields: StructType) -> DataFrame:
    """The carried columns and ``fields``: ``emit(text, runs)`` of every row, with the byte runs (start, end) to be removed.

    Null texts come to ``emit`` as empty.
    """
    size = input_bytes(docs, text_col)
    buckets = max(16, size // BUCKET_BYTES)
    own = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # carried columns get names of their own, so that any name may be among them
    columns = [F.col(f"`{c}`").alias(f"carried_{k}") for k, c in enumerate(carry)]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), own.alias("owner"), text.alias("text"), *columns)
    texts = written(rows, "suffix-texts", int(min(100_000, max(8, size // (4 * BUCKET_BYTES)))), ("row",))
    released(docs.sparkSession)

    def phrases(batches):
        task = PhraseTask(buckets, length, HOT)
        with np.errstate(over="ignore"):
            for batch in batches:
                owners, ids = (batch.column(k).to_numpy() for k in range(2))
                for i, j, buf, offs in doc_chunks(batch.column(2), CHUNK):
                    task.add(owners[i:j], ids[i:j], buf, offs)
                    if task.size >= FLUSH:
                        yield from task.flush()
            yield from task.flush()

    settled = written(texts.select("owner", "row", "text").mapInArrow(phrases, PARTS_SQL).groupBy("bucket").applyInArrow(lambda t: settle(t, HOT_BUCKET), TOLD_SQL), "suffix-settled")
    released(docs.sparkSession)
    flat = lambda rows, c: rows.filter(f"{c} is not null").groupBy("row").agg(F.flatten(F.collect_list(c)).alias(c))
    dealt = texts.join(flat(settled, "late"), "row").select("owner", "row", "text", "late").mapInArrow(lambda b: deal(b, buckets, length), PARTS_SQL)
    found = written(dealt.groupBy("bucket").applyInArrow(lambda t: match(t, length, PART), TOLD_SQL).select("row", "done"), "suffix-found")
    released(docs.sparkSession)
    told = flat(settled.select("row", "done").unionByName(found), "done")
    joined = texts.join(told, "row", "left").select("text", "done", *(f"carried_{k}" for k in range(len(carry))))
    schema = StructType([*(StructField(f"carried_{k}", docs.schema[c].dataType) for k, c in enumerate(carry)), *fields.fields])

    def finish(batches):
        for batch in batches:
            out = []
            for text, done in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                at, n, _ = decoded(done.values.to_numpy() if done.is_valid else np.zeros(0, np.int64))
                out.append(emit(text, removed_runs(at, n, len(text), length)))
            made = [pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *made], schema.names)

    kinds = [to_arrow_type(f.dataType) for f in fields.fields]
    cut = joined.mapInArrow(finish, schema)
    return cut.select(*(F.col(f"carried_{k}").alias(c) for k, c in enumerate(carry)), *fields.names)


def digests(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""

    def emit(text: bytes, runs: np.ndarray) -> tuple:
        return len(text), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), hashlib.sha256(kept_bytes(text, runs)).hexdigest()

    fields = StructType().add("n_bytes", LongType()).add("n_removed", LongType()).add("n_spans", LongType()).add("kept_sha256", StringType())
    return processed(docs, length, id_col, text_col, [id_col], emit, fields)


def repeated_spans(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the byte runs of each document that go, as array<struct<start, end>>."""
    emit = lambda text, runs: ([{"start": a, "end": z} for a, z in runs.tolist()],)
    spans = StructType().add("spans", ArrayType(StructType().add("start", LongType()).add("end", LongType())))
    return processed(docs, length, id_col, text_col, [id_col], emit, spans)


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated strings cut out of their texts; other columns, and a null text, as they are.

    A cut inside a UTF-8 character leaves broken bytes, which are dropped.
    """
    emit = lambda text, runs: (kept_bytes(text, runs) if not len(runs) else kept_bytes(text, runs).decode("utf-8", "ignore").encode(),)
    rest = [c for c in docs.columns if c != text_col]
    null = "is_null"
    while null in rest or null == text_col:
        null += "_"
    marked = docs.withColumn(null, F.col(text_col).isNull())
    kept = "kept"
    while kept in rest:
        kept += "_"
    cut = processed(marked, length, id_col, text_col, [*rest, null], emit, StructType([StructField(kept, BinaryType())]))
    text = F.when(~F.col(null), F.col(kept).cast("string")).alias(text_col)
    return cut.select(*(text if c == text_col else F.col(f"`{c}`") for c in docs.columns))
