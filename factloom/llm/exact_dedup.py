"""Exact deduplication with an extendible-hash index kept on shared files, in DataFrame operations only.

A text's key is the 64-bit hash of its normalised form (each run of ASCII white space is one space).  The
directory is addressed by leading key bits.  It begins as one bucket and doubles: a bucket that holds more distinct keys than its
capacity is split by one more bit, again and again until it fits or its keys have no more bits, and the others keep their smaller depth.
A bucket is a range of keys.  Texts are dealt to their bucket's owner task, which groups them by their bytes; its links - one row of each
distinct text, without the text - are the index that is written.  Different texts with one key form a chain of links, each
with its own keeper.

Keys with many rows are dealt over several owners by a salt, and what these have collapsed is brought together in a second step; so a
group of copies of any size is no task's alone.

Null counts as empty; empty texts are copies of each other.  Null ids sort after all others.  With repeated ids the group counts
every row, and ``exact_groups`` marks every row with the keeper's id as kept; ``deduplicate`` keeps one row of each text.  Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .picking import picked
from .scratch import input_bytes, written

#: Bits by which the directory's buckets are looked into at once.
STEP = 12
#: A bucket has this share of all keys at least, so the directory has some ten thousand buckets at most (a few more with keys that are no good hashes).
LEAST_SHARE = 1 / (1 << 13)
#: Rows of a key from which it is dealt by salt, and rows of one salt; and the share of all rows that is as much.
HOT, HOT_SHARE = 256, 1 / 4096


def normalised(text: Column) -> Column:
    """Null as empty, and each run of space or bytes 0x09-0x0D as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def prefix(key: Column, depth: Column | int) -> Column:
    """The leading ``depth`` bits of a key."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", key, (64 - depth).cast("int")))


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """(depth, prefix) of every bucket: of a key's prefixes that no more than ``capacity`` distinct keys share, the shortest."""
    buckets, full, base = None, None, 0
    while True:
        top = min(64, base + STEP)
        rows = keys
        if full is not None:
            rows = keys.withColumn("prefix", prefix(F.col("key"), base)).join(F.broadcast(full), "prefix").select("key")
        cells = rows.groupBy(prefix(F.col("key"), top).alias("cell")).agg(F.count("*").alias("keys"))
        depths = cells.select("cell", "keys", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth"))
        # the leading bits of a cell, which itself has ``top`` bits
        held = depths.groupBy("depth", F.expr(f"shiftrightunsigned(cell, {top} - depth)").alias("prefix")).agg(F.sum("keys").alias("keys"))
        held = held.withColumn("fits", (F.col("keys") <= capacity) | (F.col("depth") == 64))
        held = written(held, "exact-directory")
        # a bucket is there when it fits and the bucket that it was split from did not
        split = held.filter("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("half"))
        new = held.filter("fits").withColumn("half", F.expr("shiftrightunsigned(prefix, 1)")).join(split, ["depth", "half"], "left_semi")
        new = new.select("depth", "prefix").unionByName(held.filter("fits and depth = 0").select("depth", "prefix"))
        buckets = new if buckets is None else buckets.unionByName(new)
        full = held.filter(f"not fits and depth = {top}").select("prefix")
        if full.isEmpty():
            return written(buckets, "exact-directory")
        base = top


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, key: Callable[[Column], Column] = F.xxhash64, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(entries, links) as written tables.

    entries: one row per document - doc_id, key.  links: one row per distinct text - depth and prefix of its bucket, key, link (its place in
    the key's chain), links (the length of the chain), keep_id, group_size, text_sha256.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm")).withColumn("key", key(F.col("norm")))
    entries = written(rows.select("doc_id", "key"), "exact-entries")
    keys = written(entries.groupBy("key").agg(F.count("*").alias("rows")), "exact-keys")
    distinct, total = keys.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    if capacity is None:
        # about 4 MB to a bucket by the size of the input files
        capacity = max(256, int(distinct / max(1, input_bytes(docs, text_col) / 4e6)), int(distinct * LEAST_SHARE))
    hot = max(hot, int(total * HOT_SHARE))
    buckets = directory(keys.select("key"), capacity)
    depths = [r.depth for r in buckets.select("depth").distinct().collect()]
    # each key has a bucket at one of the depths that there are
    at = F.explode(F.array(*(F.struct(F.lit(d).cast("int").alias("depth"), prefix(F.col("key"), d).alias("prefix")) for d in depths))) if depths else F.lit(None)
    placed = lambda df: df.withColumn("at", at).select(*df.columns, "at.depth", "at.prefix").join(F.broadcast(buckets), ["depth", "prefix"])
    if not depths:  # no rows
        placed = lambda df: df.select("*", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))
    # keys with many rows: 1 / HOT_SHARE of them at most, so they can go to every task
    many = F.broadcast(keys.filter(F.col("rows") > hot).select("key", F.ceil(F.col("rows") / hot).cast("int").alias("salts")))
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.col("salts")), F.lit(-1)).cast("int")
    dealt = placed(rows).join(many, "key", "left").withColumn("salt", salt)
    owned = dealt.select("depth", "prefix", "salt", "key", "norm", "doc_id").repartition("depth", "prefix", "salt")
    # the owner's grouping needs no exchange of its own: its keys include those that rows were dealt by
    owned = owned.groupBy("depth", "prefix", "salt", "key", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    text = F.when(F.col("salt") >= 0, F.col("norm")).alias("norm")
    owned = written(owned.select("depth", "prefix", "salt", "key", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"), text), "exact-owned")
    shared = owned.filter("salt >= 0").groupBy("depth", "prefix", "key", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.first("text_sha256").alias("text_sha256"))
    links = owned.filter("salt < 0").drop("salt", "norm").unionByName(shared.drop("norm"))
    chain = W.partitionBy("depth", "prefix", "key")
    links = links.select("*", F.row_number().over(chain.orderBy("keep_id", "text_sha256")).alias("link"), F.count("*").over(chain).alias("links"))
    return entries, written(links, "exact-links")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, key: Callable[[Column], Column] = F.xxhash64, hot: int = HOT) -> DataFrame:
    """One row per document: its group's keeper, size and text digest, whether it stays, and depth and prefix of its bucket."""
    entries, links = build_index(docs, id_col, text_col, capacity, key, hot)
    return grouped(docs, entries, links, id_col, text_col, key)


def grouped(docs: DataFrame, entries: DataFrame, links: DataFrame, id_col: str, text_col: str, key: Callable[[Column], Column]) -> DataFrame:
    keep = ["keep_id", "group_size", "text_sha256"]
    found = entries.join(links.filter("links = 1").select("key", "depth", "prefix", *keep), "key").select("doc_id", "key", *keep, "depth", "prefix")
    chains = links.filter("links > 1").select("key", "depth", "prefix").distinct()
    if not chains.isEmpty():
        # different texts with one key: rows find their link by the bytes of their text
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm")).withColumn("key", key(F.col("norm"))).join(chains, "key")
        linked = rows.groupBy("key", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).withColumn("text_sha256", F.sha2("norm", 256))
        found = found.unionByName(rows.join(linked, ["key", "norm"]).select(*found.columns))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "key", "depth", "prefix")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One whole row of each text: one with the smallest id."""
    content = F.sha2(normalised(F.col(text_col)), 256)
    groups = exact_groups(docs, id_col, text_col).filter("kept").groupBy(F.col("doc_id").alias("id"), F.col("text_sha256").alias("content")).agg(F.count("*").alias("rows"))
    groups = written(groups, "exact-kept")
    return picked(docs, groups.select("id", "content"), groups.filter("rows > 1").select("id", "content"), F.col(id_col).cast("long"), content)
