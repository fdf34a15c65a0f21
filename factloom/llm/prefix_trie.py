"""Prefix trie of conversations by distributed MSD radix partitioning over dictionary-encoded turns.

Each distinct turn (role, text) has a dense id.  A conversation is the array of its turns' ids; conversations with the same array are one
path, with how many they are, the smallest id and a digest of all ids.  Paths that share a prefix form a bucket, at first all of them.  A bucket with more turns to come than ``LOCAL`` is partitioned: its
paths' longest common prefix is one chain of nodes, and the next turn id deals them to new buckets.  A smaller bucket is finished by one task: multikey quicksort splits its
paths by the id at a depth into smaller, equal and greater ones, and each descent into equal ones emits a node.  What a subtree holds is added up over its buckets, from the last round to the first.

A round sends rows by hash of their bucket's prefix only to finish small buckets; large ones are summed with partial sums, and their figures reach their rows by a broadcast of at most ``picking.HOT`` buckets,
or a join for the others.  So no task holds more of a bucket than ``LOCAL`` turns and one path, however many conversations share it.  A path is one row of 12 bytes a turn.

Turns are ordered by turn (null first), then by role and text; equal rows count each.  A null role or text is the empty string.  Rows with a null conv_id take no part; an empty table
gives no nodes.  A conversation may have any number of turns, or none after rebuilding; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .picking import looked_up
from .scratch import drop, written

#: Turns of a bucket that one task finishes, ids of a piece of a path's list, turns of a conversation that another may begin with.
LOCAL, PIECE, HEAD = 20_000, 50_000, 3
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
EMPTY = hashlib.sha256(b"").hexdigest()
FIELDS = [f.split()[0] for f in NODE.split(", ")]
TYPES = [pa.string() if f == "ends_sha256" else pa.int64() for f in FIELDS]


def ranked(turns: DataFrame) -> DataFrame:
    """(conv, pos, key, words): turns with their place from 0.  A conversation of any length is dealt by ranges, and what earlier ranges hold of it is added."""
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "key"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            begins = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            at = np.arange(len(conv)) - np.repeat(begins, np.diff(np.append(begins, len(conv))))
            if conv[0] == last:
                at[: begins[1] if len(begins) > 1 else len(conv)] += count
            last, count = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at), batch.column(1), batch.column(2)], ["conv", "at", "key", "words"])

    placed = dealt.select("conv", "key", "words").mapInArrow(run, "conv long, at long, key binary, words int").withColumn("part", F.spark_partition_id())
    placed = written(placed, "trie-placed")
    held = placed.groupBy("part", "conv").agg((F.max("at") + 1).alias("n"))
    ends = W.partitionBy("part")
    # only a range's first conversation began before it, and only its last one goes on after it
    edges = held.withColumns({"a": F.min("conv").over(ends), "b": F.max("conv").over(ends)}).filter("conv = a or conv = b").select("part", "conv", "n")
    cut = edges.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts")).filter("size(parts) > 1")
    before = cut.select("conv", F.explode(F.expr("transform(parts, (p, i) -> struct(p.part as part, aggregate(slice(parts, 1, i), 0L, (s, q) -> s + q.n) as before))")).alias("p")).select("conv", "p.*")
    shifted = placed.join(F.broadcast(before), ["part", "conv"], "left")  # two rows a range at most
    return shifted.select("conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "words")


def turn_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def rebuilt(conversations: DataFrame, share: int = 20) -> DataFrame:
    """(conv, pos, key, words): each conversation's first turns come from the first one of its ``share`` ids, crc32(conv) mod 4 of them, then its own."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), key.alias("key"), turn_words(text).alias("words"))
    own = written(ranked(turns), "trie-turns")
    head = lambda c: (F.crc32(c.cast("string").cast("binary")) % (HEAD + 1)).cast("long")
    first = own.filter((F.col("pos") < HEAD) & (F.col("conv") % share == 0)).withColumnRenamed("conv", "base")
    convs = own.filter("pos = 0").select("conv", (F.col("conv") - F.col("conv") % share).alias("base"), head(F.col("conv")).alias("h"))
    begun = convs.join(first, "base").filter("pos < h").select("conv", "pos", "key", "words")
    return begun.unionByName(own.filter(F.col("pos") >= head(F.col("conv"))))


def dictionary(turns: DataFrame) -> DataFrame:
    """(key, id, rows): a dense number for each distinct turn."""
    return written(turns.groupBy("key").agg(F.count("*").alias("rows")).withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")


def ends_of(convs: DataFrame) -> DataFrame:
    """(path, n, conv, ends) for rows (path, conv): how many, the smallest, and the digest of all ids in ascending order, read as a stream in pieces."""
    dealt = convs.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out, begin = [], 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or paths[i] != paths[begin] or i - begin == PIECE:
                    out.append((paths[begin], ids[begin], i - begin, ",".join(map(str, ids[begin:i]))))
                    begin = i
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string()))], ["path", "conv", "n", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, conv, n, digest = None, 0, 0, hashlib.sha256()
        done: list[tuple] = []
        for batch in batches:
            for p, c, m, ids in zip(*(col.to_pylist() for col in batch.columns)):
                if p != path:
                    if path is not None:
                        done.append((path, n, conv, digest.hexdigest()))
                    path, conv, n, digest = p, c, 0, hashlib.sha256()
                digest.update((("," if n else "") + ids).encode())
                n += m
            yield _batch(done, ["path", "n", "conv", "ends"])
            done = []
        if path is not None:
            yield _batch([(path, n, conv, digest.hexdigest())], ["path", "n", "conv", "ends"])

    parts = dealt.mapInArrow(pieces, "path binary, conv long, n long, ids string").repartition("path").sortWithinPartitions("path", "conv")
    return parts.mapInArrow(joined, "path binary, n long, conv long, ends string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = {"path": pa.binary(), "ends": pa.string(), "ends_sha256": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types.get(c, pa.int64())) for k, c in enumerate(names)], names)


def paths_of(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(path, seq, words, n, conv, ends): the distinct sequences of turn ids, words of each turn, and the conversations that have them."""
    table = dictionary(turns)
    coded = looked_up(turns, table, "key", "rows").select("conv", F.struct("pos", "id", "words").alias("t"))
    one = coded.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv", F.col("t.id").alias("seq"), F.col("t.words").alias("words"))
    none = conversations.select("conv").distinct().join(turns.select("conv"), "conv", "left_anti")
    one = one.unionByName(none.select("conv", F.expr("cast(array() as array<long>) as seq"), F.expr("cast(array() as array<int>) as words")))
    one = written(one.withColumn("path", F.unhex(F.sha2(F.array_join("seq", ","), 256))), "trie-sequences")
    drop(table)
    ends = written(ends_of(one.select("path", "conv")), "trie-ends")
    # the row of the smallest conversation has the path's sequence
    paths = written(one.join(ends, ["path", "conv"]), "trie-paths")
    drop(one, ends)
    return paths


def finished(rows: list[tuple], depth: int, parent: int | None) -> tuple[list[list], int, int]:
    """Nodes of a bucket's subtree (rows: ids, words, n, conv, ends) by multikey quicksort, with its leaves and saved tokens.  Its paths share their first ``depth`` ids."""
    words = rows[0][1][depth - 1] if depth else 0
    nodes: list[list] = []
    weights: list[int] = []
    above: list[int] = []

    def node(members: list[tuple], d: int, over: int, tokens: int) -> int:
        n = sum(r[2] for r in members)
        nodes.append([min(r[3] for r in members), d, nodes[over][0] if over >= 0 else parent, n, 0, 0, (n - 1) * tokens, EMPTY])
        above.append(over)
        return len(nodes) - 1

    todo = [(rows, depth, node(rows, depth, -1, words))]
    while todo:
        members, d, at = todo.pop()
        own = [r for r in members if len(r[0]) > d]
        if len(own) < len(members):
            nodes[at][7] = next(r[4] for r in members if len(r[0]) == d)
        if not own:
            continue
        pivot = own[len(own) // 2][0][d]
        less, equal, more = [], [], []
        for r in own:
            (equal if r[0][d] == pivot else less if r[0][d] < pivot else more).append(r)
        todo += [(part, d, at) for part in (less, more) if part]
        todo.append((equal, d + 1, node(equal, d + 1, at, equal[0][1][d])))
    for i in range(len(nodes) - 1, -1, -1):
        own = nodes[i]
        own[5] = own[5] or 1
        if above[i] >= 0:
            over = nodes[above[i]]
            over[4] += 1
            over[5] += own[5]
            over[6] += own[6]
    return nodes, nodes[0][5], nodes[0][6]


def local_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of all small buckets, and the bucket that each subtree's top stands for (``top``: the bucket before it, null below)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None

        def flush() -> pa.RecordBatch:
            (_, depth, parent, over, *_), members = held[0], [r[4:] for r in held]
            nodes, _, _ = finished(members, depth, parent)
            columns = [pa.array([n[k] for n in nodes], t) for k, t in enumerate(TYPES)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([over] + [None] * (len(nodes) - 1), pa.binary())], [*FIELDS, "top"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != bucket and held:
                    yield flush()
                    held = []
                bucket = row[0]
                held.append(row)
        if held:
            yield flush()

    dealt = rows.select("bucket", "depth", "parent", "over", "seq", "words", "n", "conv", "ends").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, f"{NODE}, top binary")


def chain_nodes(big: DataFrame) -> DataFrame:
    """Nodes of the chains of large buckets: from the bucket's depth to where its paths part, all with the same members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for depth, shared, parent, conv, n, words, children, leaves, saved, ends in zip(*(c.to_pylist() for c in batch.columns)):
                sums = (np.cumsum(np.array(words, np.int64)[::-1])[::-1] * (n - 1) + saved).tolist()
                last = len(sums) - 1
                rows = [(conv, depth + i, parent if not i else conv, n, 1 if i < last else children, leaves, sums[i], EMPTY if i < last else ends) for i in range(len(sums))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(TYPES)], FIELDS)

    return big.select("depth", "shared", "parent", "conv", "n", "words", "children", "leaves", "saved", "ends").mapInArrow(run, NODE)


def trie(paths: DataFrame, local: int | None = None) -> DataFrame:
    """All nodes of the trie over paths (path, seq, words, n, conv, ends)."""
    local = LOCAL if local is None else local
    root = F.unhex(F.lit("00"))
    active = paths.select(root.alias("bucket"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(None).cast("binary").alias("over"), "seq", "words", "n", "conv", "ends")
    bigs: list[DataFrame] = []
    tops: list[DataFrame] = []
    nodes: list[DataFrame] = []
    while True:
        figures = active.groupBy("bucket").agg(
            F.sum(F.size("seq") - F.col("depth") + 1).alias("turns"), F.count("*").alias("paths"), F.sum("n").alias("all_n"), F.min("conv").alias("first"), F.min("seq").alias("least"), F.max("seq").alias("most"))
        least = F.least(F.size("least"), F.size("most")).cast("int")
        differ = F.array_position(F.zip_with(F.slice("least", F.lit(1), least), F.slice("most", F.lit(1), least), lambda a, b: a == b), F.lit(False))
        shared = F.when(differ > 0, differ - 1).otherwise(least).cast("int")
        figures = written(figures.withColumn("large", F.col("turns") > local).select("bucket", "paths", "all_n", "first", "large", F.when(F.col("large"), shared).alias("shared")), "trie-figures")
        known = written(looked_up(active, figures, "bucket", "paths"), "trie-active")
        done = written(local_nodes(known.filter("not large")), "trie-nodes")
        nodes.append(done.select(*FIELDS))
        tops.append(done.filter("top is not null").select(F.col("top").alias("bucket"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
        large = known.filter("large")
        # the bucket's chain has the turns of any of its paths; the path that ends where they part gives the digest
        chain = F.slice("words", F.greatest("depth", F.lit(1)), F.col("shared") - F.greatest("depth", F.lit(1)) + 1)
        chain = F.when(F.col("depth") == 0, F.concat(F.array(F.lit(0)), chain)).otherwise(chain)
        top = large.filter("conv = first").select("bucket", "depth", "parent", "over", "shared", F.col("first").alias("conv"), F.col("all_n").alias("n"), chain.alias("words"))
        ended = large.filter("size(seq) = shared").select("bucket", "ends")
        big = written(top.join(ended, "bucket", "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY))), "trie-large")
        if big.isEmpty():
            break
        bigs.append(big)
        depth = F.col("shared") + 1
        below = large.filter("size(seq) > shared")
        prefix = F.unhex(F.sha2(F.array_join(F.slice("seq", F.lit(1), depth), ","), 256))
        active = below.select(prefix.alias("bucket"), depth.alias("depth"), F.col("first").alias("parent"), F.col("bucket").alias("over"), "seq", "words", "n", "conv", "ends")
    # what lies below a large bucket's chain, from the last round to the first
    carried = None
    for big, below in zip(reversed(bigs), reversed(tops[1:])):
        parts = below if carried is None else below.unionByName(carried)
        sums = parts.groupBy("bucket").agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        full = big.join(sums, "bucket", "left").withColumns({"children": F.coalesce("children", F.lit(0)), "leaves": F.coalesce("leaves", F.lit(1)), "saved": F.coalesce("saved", F.lit(0))})
        full = written(full, "trie-summed")
        nodes.append(chain_nodes(full))
        total = F.col("saved") + (F.col("n") - 1) * F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w)
        carried = full.filter("over is not null").select(F.col("over").alias("bucket"), "leaves", total.alias("saved"))
    out = nodes[0]
    for more in nodes[1:]:
        out = out.unionByName(more)
    return out


def conversation_trie(conversations: DataFrame, local: int | None = None) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations."""
    turns = written(rebuilt(conversations), "trie-rebuilt")
    convs = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"))
    return trie(paths_of(turns, convs), local)
