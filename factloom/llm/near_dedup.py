"""Near-duplicate detection: one-permutation MinHash with optimal densification and star-shaped candidate edges.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set is its distinct ``width``-word shingles
(the whole sequence, if it has fewer words).  Documents with equal sets are one class from the start.  Per class, one hash
pass fills BINS bins by the leading hash bits; an empty bin copies the first filled bin of its own random
permutation of the bins.  Runs of ROWS bins are banded buckets.

In small sets few hashes fill many bins, and a true link would be lost too often.  Sets of up to SMALL shingles, and those that one of these can be
linked with, have exact buckets instead: the rarest shingles of the set, so many that two linked sets have one of them in common, each with the set's class of size, in which or beside which all its
partners lie.  Shingles that no other small set has make no bucket.  Signatures say nothing about a pair with such a set.

A bucket with several classes gives a few stars:
a centre each and an edge to every other member, so pairs grow with the members and not with their square.  Edges
whose signatures agree far too little are dropped (by more than five standard deviations), the likeliest of each class are confirmed
on the full sets, and confirmed links are contracted to components.  Stars only make components large cheaply and may
leave links out.  A last pass closes every bucket that still holds several components: all its pairs across components
are compared by size and signature in blocks of bounded size.  No pairs come out of a block, only which parts of which component hold
a partner that a member could be linked with; the member's full set is then compared with those of all that part's members, in memory, and gives one link.
So each pair that shares a bucket is in one component or has been compared.

The last pass first counts the shingles that only one set of all mixed buckets has: they are in no intersection, so a set with too many of them
is left out and a pair is compared only if what both share could suffice.  That bound is exact.

Null, empty and blank texts have an empty set (n_shingles 0), link with nothing and stay.  Null ids sort after all others; of rows with one id
the first read is the smaller.  One row of a component is kept, whatever ids are repeated.  Other columns may have any name.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import min_labels
from .picking import looked_up, picked
from .scratch import drop, released, written
from .textops import U64, Words, doc_chunks, mix, shingles

BINS, ROWS = 128, 4
#: Signatures of sets with similarity 0.75 agree in fewer bins than this once in over a million cases.
LEAST_AGREEING = 0.55
#: Shingles up to which a set's buckets are exact and its signature is not asked.
SMALL = 64
#: In one round: stars of a bucket, and edges of a member that are tested.
STARS, EDGES_A_ROUND = 3, 4
#: Star rounds go on while each adds a link to so many; the last pass is cheaper for the rest.
WORTH = 50
#: Members of a bucket that a block of the last pass holds on either side, pairs compared at once, and members of a label whose sets are together.
BLOCK, AT_ONCE, CHUNK = 1000, 1 << 15, 1000

_rng = np.random.default_rng(20)
#: Row i: the order in which bin i looks for a filled bin, itself first.
PROBES = np.stack([np.concatenate([[i], _rng.permutation(np.delete(np.arange(BINS), i))]) for i in range(BINS)])
EDGES = np.arange(BINS, dtype=U64) << U64(64 - BINS.bit_length() + 1)


def signature(sorted_set: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of a sorted set of 64-bit hashes (one value per bin)."""
    at = np.searchsorted(sorted_set, EDGES)
    filled = np.diff(np.append(at, len(sorted_set))) > 0
    source = PROBES[np.arange(BINS), filled[PROBES].argmax(1)]
    return sorted_set[at[source]]


def bands(sig: np.ndarray) -> np.ndarray:
    key = np.arange(BINS // ROWS, dtype=U64) + U64(1)
    for k in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + sig[k::ROWS])
    return key.view(np.int64)


def shingle_sets(column: pa.Array, width: int):
    """Yields each row's sorted distinct shingle hashes."""
    for _, _, buf, offs in doc_chunks(column):
        doc, s = shingles(Words(buf, offs), width)
        cut = np.searchsorted(doc, np.arange(len(offs)))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield np.unique(s[a:b])


def set_ids(s: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set."""
    return int(mix(s).sum(dtype=U64).view(np.int64)), int(np.bitwise_xor.reduce(mix(s ^ U64(0xA0761D6478BD642F)), initial=U64(0)).view(np.int64))


def sketches(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(row, doc_id, content, n_shingles, set_a, set_b, sig, bands, items) of (doc_id, content, text).

    row is a number of the row's own; set_a and set_b identify the set; sig is null if it is empty, bands are if it is small, and items, the set's sorted hashes as packed bytes, are if neither it nor a set that it can be linked with is.
    """

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            n, a, b, sigs, keys, items = [], [], [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column(2), width):
                    n.append(len(s))
                    x, y = set_ids(s)
                    a.append(x), b.append(y)
                    items.append(s.tobytes() if 0 < len(s) * percent <= SMALL * 100 else None)
                    if not len(s):
                        sigs.append(None), keys.append(None)
                        continue
                    sig = signature(s)
                    sigs.append((mix(sig) & U64(255)).astype(np.uint8).tobytes())
                    keys.append(bands(sig) if len(s) > SMALL else None)
            rows = pa.array(np.arange(at, at + len(n)))
            at += len(n)
            made = [pa.array(x, t) for x, t in ((n, pa.int64()), (a, pa.int64()), (b, pa.int64()), (sigs, pa.binary()), (keys, pa.list_(pa.int64())), (items, pa.binary()))]
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), batch.column(1), *made], ["row", "doc_id", "content", "n_shingles", "set_a", "set_b", "sig", "bands", "items"])

    return docs.mapInArrow(run, "row long, doc_id long, content long, n_shingles long, set_a long, set_b long, sig binary, bands array<long>, items binary")


def exact_entries(reps: DataFrame, percent: int) -> DataFrame:
    """(rep, bucket) of small sets (rep, n_shingles, items), so that any two linked ones share a bucket.

    Linked sets share ``percent`` of either's items at least.  In the order of how many sets have an item, leave out one item less than that at the end of each: the first item that both have is among the rest of both.  An item that
    no other set has is counted at its place but makes no bucket.
    """

    def run(batches):
        for batch in batches:
            size = np.array([len(x.as_buffer()) // 8 for x in batch.column(2)], np.int64)
            flat = np.frombuffer(b"".join(x.as_buffer() for x in batch.column(2)), np.int64)
            rep, n = (np.repeat(batch.column(k).to_numpy(), size) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(n), pa.array(flat)], ["rep", "n_shingles", "item"])

    items = written(reps.filter("items is not null").select("rep", "n_shingles", "items").mapInArrow(run, "rep long, n_shingles long, item long"), "near-items")
    held = written(items.groupBy("item").agg(F.count("*").alias("sets")).filter("sets > 1"), "near-held")
    found = looked_up(items, held, "item", "sets")
    first = F.expr(f"cast(n_shingles - ceil({percent} * n_shingles / 100) + 1 - (n_shingles - size(own)) as int)")
    own = found.groupBy("rep", "n_shingles").agg(F.array_sort(F.collect_list(F.struct("sets", "item"))).alias("own"))
    own = own.withColumn("first", first).filter("first > 0").select("rep", "n_shingles", F.explode(F.slice("own", F.lit(1), F.col("first"))).alias("x"))
    # linked sets lie in one class of size or in neighbouring ones, and each has its own and the next
    step = F.floor(F.log("n_shingles") / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("n_shingles")
    classes = F.explode(F.array(step, step + 1)).alias("step")
    return own.select("rep", "x.item", classes).select("rep", F.xxhash64("item", "step", F.lit("exact")).alias("bucket"))


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(set_a, set_b, items) of (doc_id, content, text): the sorted distinct shingle hashes as packed bytes."""

    def run(batches):
        for batch in batches:
            out, size = [], 0
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column(2), width):
                    out.append((*set_ids(s), s.tobytes()))
                    size += len(s)
                    if size >= AT_ONCE:
                        yield packed(out)
                        out, size = [], 0
            yield packed(out)

    def packed(rows):
        a, b, items = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(items, pa.binary())], ["set_a", "set_b", "items"])

    return docs.mapInArrow(run, "set_a long, set_b long, items binary")


def single_items(sets: DataFrame) -> DataFrame:
    """(rep, single): of (rep, items), how many items of a set no other of the sets has, where there are any."""

    def run(batches):
        for batch in batches:
            size = np.array([len(x.as_buffer()) // 8 for x in batch.column(1)], np.int64)
            total = np.concatenate([[0], np.cumsum(size)])
            k = 0
            while k < len(size):
                # sets of some half a million items at once
                to = max(k + 1, int(np.searchsorted(total, total[k] + 16 * AT_ONCE, "right")) - 1)
                if total[to] > total[k]:
                    item = np.frombuffer(b"".join(x.as_buffer() for x in batch.column(1).slice(k, to - k)), np.int64)
                    rep = np.repeat(batch.column(0).slice(k, to - k).to_numpy(), size[k:to])
                    _, first, n = np.unique(item, return_index=True, return_counts=True)
                    # an item of several of these sets goes on as one row
                    yield pa.RecordBatch.from_arrays([pa.array(item[first]), pa.array(rep[first]), pa.array(n)], ["item", "rep", "n"])
                k = to

    items = sets.select("rep", "items").mapInArrow(run, "item long, rep long, n long").groupBy("item").agg(F.sum("n").alias("n"), F.min("rep").alias("rep"))
    return items.filter("n = 1").groupBy("rep").agg(F.count("*").alias("single"))


def agreeing(pairs: DataFrame, least: float) -> DataFrame:
    """Of (a, b, sig_a, sig_b), the (a, b) whose signatures agree in at least that share of bins."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(1) >= least))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """Of (a, b, items_a, items_b), the (a, b) with 100 * intersection >= percent * union."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_struct_array(batch.to_struct_array().filter(pa.array(keep, pa.bool_()))).select(["a", "b"])

    return pairs.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long")


def mixed_members(now: DataFrame) -> DataFrame:
    """(rep) of every member of a bucket that holds several labels."""
    mixed = now.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("bucket")
    return now.join(mixed, "bucket").select("rep").distinct()


def blocks(now: DataFrame, sigs: DataFrame) -> DataFrame:
    """Members of buckets that hold several labels, dealt to blocks (bucket, i, j).

    A bucket's pairs across labels have an end outside its most frequent label: such members are centres of one row of blocks,
    and every member is a partner in one column.
    """
    mixed = now.groupBy("bucket", "label").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.sum("n").alias("m"), F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("top")).filter("labels > 1")
    mixed = mixed.select("bucket", F.col("top.label").alias("top"), F.ceil((F.col("m") - F.col("top.n")) / BLOCK).alias("rows"), F.ceil(F.col("m") / BLOCK).alias("columns"))
    at = now.join(mixed, "bucket").withColumn("i", F.expr("pmod(xxhash64(rep, 1), rows)")).withColumn("j", F.expr("pmod(xxhash64(rep, 2), columns)")).withColumn("minor", F.expr("label <> top"))
    at = at.join(sigs, "rep")
    partner = F.expr("transform(sequence(0, rows - 1), x -> struct(x as i, j as j, false as centre))")
    centre = F.expr("if(minor, transform(sequence(0, columns - 1), x -> struct(i as i, x as j, true as centre)), array())")
    return at.select("bucket", "rep", "label", "part", "minor", "n_shingles", "shared", "sig", F.explode(F.concat(partner, centre)).alias("at")).select("bucket", "at.i", "at.j", "at.centre", "rep", "label", "part", "minor", "n_shingles", "shared", "sig")


def across(members: DataFrame, percent: int, least: float) -> DataFrame:
    """(a, label, part): centres and the parts of other labels that hold a partner whose size, shared shingles and signature allow a link.

    A set's shared shingles are those that some other set of a mixed bucket has: no pair can have more in common.
    """

    def pairs(rows: pa.RecordBatch):
        keys, (centre, rep, label, part, minor, size, shared) = (np.stack([rows.column(k).to_numpy() for k in range(3)]), (rows.column(k).to_numpy(zero_copy_only=False) for k in range(3, 10)))
        sig = np.frombuffer(b"".join(rows.column(10).to_pylist()), np.uint8).reshape(-1, BINS)
        first = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))
        begin = np.flatnonzero(first)
        partners = np.add.reduceat(~centre, begin)  # a block's partners are before its centres
        x = np.flatnonzero(centre)
        block = np.cumsum(first)[x] - 1
        begin, n = begin[block], partners[block]
        total = np.concatenate([[0], np.cumsum(n)])
        k, seen = 0, []
        while k < len(x):
            to = max(k + 1, int(np.searchsorted(total, total[k] + AT_ONCE, "right")) - 1)
            m = n[k:to]
            one = np.repeat(x[k:to], m)
            two = np.arange(len(one)) + np.repeat(begin[k:to] - (total[k:to] - total[k]), m)
            # with c in common: 100 c >= percent (m + n - c); c is at most what either set shares
            most, both = np.minimum(shared[one], shared[two]), size[one] + size[two]
            # two centres meet in two blocks
            ok = (label[one] != label[two]) & ~(minor[two] & (rep[one] > rep[two])) & ((100 + percent) * most >= percent * both)
            one, two = one[ok], two[ok]
            ok = (np.minimum(size[one], size[two]) <= SMALL) | ((sig[one] == sig[two]).mean(1) >= least)
            if ok.any():
                seen.append(np.unique(np.stack([rep[one[ok]], label[two[ok]], part[two[ok]]]), axis=1))
            k = to
        if seen:
            found = np.unique(np.concatenate(seen, 1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "label", "part"])

    def run(batches):
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            # the last block may go on in the next batch
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            at = int(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))[-1])
            if at:
                yield from pairs(batch.slice(0, at))
            rest = batch.slice(at)
        if rest is not None:
            yield from pairs(rest)

    dealt = members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "centre")
    return dealt.mapInArrow(run, "a long, label long, part long").distinct()


def linked(asks: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each of (a, label, part), a member b of that part that is linked with a, if there is one.

    Members of a label are one component, so one link is as good as all; it is looked for in the full sets of all the part's members, brought
    together once for up to CHUNK centres.
    """
    turns = asks.groupBy("label", "part").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("turns"))
    there = members.join(turns, ["label", "part"]).join(sets, "rep").select("label", "part", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(False).alias("asks"), "rep", "items")
    asking = asks.join(turns, ["label", "part"]).join(sets.withColumnRenamed("rep", "a"), "a")
    asking = asking.select("label", "part", F.expr("cast(pmod(xxhash64(a, 4), turns) as int)").alias("turn"), F.lit(True).alias("asks"), F.col("a").alias("rep"), "items")

    def run(batches):
        now, reps, items = None, [], []
        ready = None
        for batch in batches:
            out = []
            for *key, asks, rep, own in zip(*(batch.column(k).to_pylist() for k in range(5)), batch.column(5)):
                own = np.frombuffer(own.as_buffer(), U64)
                if key != now:
                    now, reps, items, ready = key, [], [], None
                if not asks:
                    reps.append(rep), items.append(own.copy())
                    continue
                if ready is None and reps:
                    sizes = np.array([len(x) for x in items])
                    every, code = np.unique(np.concatenate(items), return_inverse=True)
                    ready = every, code, np.cumsum(sizes) - sizes, sizes
                if reps:
                    every, code, begin, sizes = ready
                    at = np.minimum(np.searchsorted(every, own), len(every) - 1)
                    has = np.zeros(len(every), np.int64)
                    has[at[every[at] == own]] = 1
                    both = np.add.reduceat(has[code], begin)
                    hit = np.flatnonzero(100 * both >= percent * (sizes + len(own) - both))
                    if len(hit):
                        out.append((rep, reps[hit[0]]))
            a, b = np.array(out, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    dealt = there.unionByName(asking).repartition("label", "part", "turn").sortWithinPartitions("label", "part", "turn", "asks")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    rows = numbered_groups(docs, F.lit(0).cast("long"), id_col, text_col, width, percent)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def numbered_groups(docs: DataFrame, content, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(row, doc_id, content, n_shingles, component_id, kept): ``content`` is passed on, to tell rows with one id apart."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), content.alias("content"), F.col(text_col).alias("text"))
    sketch = written(sketches(docs, width, percent), "near-sketches")
    full = sketch.filter("n_shingles > 0")
    # the row that stands for each distinct set
    classes = written(full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("row").alias("rep")), "near-classes")
    reps = full.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").withColumnRenamed("row", "rep")
    entries = reps.select("rep", F.explode("bands").alias("bucket")).unionByName(exact_entries(reps, percent))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").select("bucket")
    # entries of buckets that hold several classes; the rest can never give an edge
    active = written(entries.join(shared, "bucket").select("bucket", "rep"), "near-entries")
    sigs = written(reps.select("rep", "doc_id", "set_a", "set_b", "n_shingles", "sig").join(active.select("rep").distinct(), "rep", "left_semi"), "near-signatures")
    released(docs.sparkSession)
    labels = tested = links = None
    total = 0

    def labelled() -> DataFrame:
        if labels is None:
            return active.withColumn("label", F.col("rep"))
        return written(active.join(labels, "rep", "left").select("bucket", "rep", F.coalesce("label", "rep").alias("label")), "near-entries")

    def sets_of(some: DataFrame) -> DataFrame:
        """(rep, items) for each of (rep)."""
        ends = written(some.join(sigs, "rep").select("rep", "doc_id", "set_a", "set_b"), "near-ends")
        ids = ends.select(F.col("doc_id").alias("end")).distinct()
        texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("end")), "left_semi")
        sets = full_sets(texts, width).join(ends.drop("doc_id"), ["set_a", "set_b"]).select("rep", "items")
        return written(sets.dropDuplicates(["rep"]), "near-sets")

    def verified(edges: DataFrame) -> DataFrame:
        # written, so that its true size decides whether texts have to be shuffled
        sets = sets_of(written(edges.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "near-ends"))
        pairs = edges.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b")), "b").join(sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a")), "a")
        out = written(confirmed(pairs, percent), "near-links")
        drop(sets)
        return out

    for turn in itertools.count():
        now = labelled()
        # the first centre is at first the smallest row; the others, and all later ones, are any member
        orders = [F.col("rep") if turn == 0 and k == 0 else F.xxhash64("rep", F.lit(STARS * turn + k)) for k in range(STARS)]
        centres = [F.min(F.struct(o.alias("o"), "rep", "label")).alias(f"c{k}") for k, o in enumerate(orders)]
        open_ = now.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), *centres).filter("lo < hi")
        star = now.join(open_.select("bucket", F.array(*(f"c{k}" for k in range(STARS))).alias("c")), "bucket").select("rep", "label", F.explode("c").alias("c"))
        # member b and centre a, with the number of buckets that make this edge
        star = star.filter("label <> c.label").groupBy(F.col("c.rep").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("n"))
        if tested is not None:
            star = star.join(tested, ["a", "b"], "left_anti")
        # a member needs one true link to get into its component: its likeliest edges go first, the others stay for later rounds and the last pass
        likely = F.slice(F.sort_array(F.collect_list(F.struct("n", "a")), False), 1, EDGES_A_ROUND).getField("a")
        star = written(star.groupBy("b").agg(F.explode(likely).alias("a")).select("a", "b"), "near-stars")
        pairs = star.join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b").join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
        edges = written(agreeing(pairs, LEAST_AGREEING), "near-edges")
        if edges.isEmpty():
            break
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tested = both if tested is None else tested.unionByName(both)
        found = verified(edges)
        n = found.count()
        if n:
            total += n
            links = found if links is None else links.unionByName(found)
            labels = min_labels(links)
        if n * WORTH <= total:
            break
    now = labelled()
    members = written(mixed_members(now), "near-mixed")
    sets = sets_of(members)
    rare = written(single_items(sets), "near-rare")
    of = now.join(members, "rep", "left_semi").select("rep", "label").distinct()
    of = of.join(of.groupBy("label").agg(F.ceil(F.count("*") / CHUNK).alias("parts")), "label").select("rep", "label", F.expr("pmod(xxhash64(rep, 3), parts)").alias("part"))
    of = written(of, "near-parts")
    able = sigs.join(of.select("rep", "part"), "rep").join(rare, "rep", "left").select("rep", "part", "n_shingles", "sig", (F.col("n_shingles") - F.coalesce("single", F.lit(0))).alias("shared"))
    # a set that shares too little can link with none
    able = able.filter(100 * F.col("shared") >= percent * F.col("n_shingles"))
    asks = written(across(blocks(now.join(able.select("rep"), "rep", "left_semi"), able), percent, LEAST_AGREEING), "near-asks")
    found = written(linked(asks, of, sets, percent), "near-links")
    drop(sets)
    if not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        labels = min_labels(links)
    classed = classes.select("set_a", "set_b", "n_shingles", "rep")
    if labels is not None:
        classed = classed.join(labels, "rep", "left")
    else:
        classed = classed.withColumn("label", F.col("rep"))
    classed = classed.select("set_a", "set_b", "n_shingles", F.coalesce("label", "rep").alias("label"))
    # nulls come after all ids, and of repeated ids the first row
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    by_set = full.groupBy("set_a", "set_b", "n_shingles").agg(least).join(classed, ["set_a", "set_b", "n_shingles"])
    groups = by_set.groupBy("label").agg(F.min("least").alias("least"))
    by_set = written(by_set.drop("least").join(groups, "label").select("set_a", "set_b", "n_shingles", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("keeper")), "near-groups")
    rows = full.join(by_set, ["set_a", "set_b", "n_shingles"]).select("row", "doc_id", "content", "n_shingles", "component_id", (F.col("row") == F.col("keeper")).alias("kept"))
    alone = sketch.filter("n_shingles = 0").select("row", "doc_id", "content", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return rows.unionByName(alone)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """The documents that stay, one of each component, with all their columns."""
    content = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull())
    groups = numbered_groups(docs, content, id_col, text_col, width, percent)
    groups = written(groups.select(F.col("doc_id").alias("id"), "content", "kept", "n_shingles"), "near-kept")
    # rows of one id and text are told apart by their columns; those without words all stay
    blank = groups.filter("n_shingles = 0").select("id", "content").distinct()
    worded = groups.filter("n_shingles > 0")
    kept = worded.filter("kept").select("id", "content")
    counts = worded.groupBy("id", "content").agg(F.count("*").alias("rows")).filter("rows > 1").select(F.col("id").alias("i"), F.col("content").alias("c"))
    again = written(kept.join(counts, kept["id"].eqNullSafe(F.col("i")) & (kept["content"] == F.col("c")), "left_semi"), "near-again")
    own = F.col(id_col).cast("long")
    stays = picked(docs, kept, again, own, content)
    return stays.unionByName(docs.join(blank, own.eqNullSafe(blank["id"]) & (content == blank["content"]), "left_semi"))
