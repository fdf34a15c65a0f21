"""The table store: Parquet tables with declared schemas, replaced key by key, read as snapshots.

A replacement appends a delta, its rows and the keys that they replace, and touches nothing else, so a batch costs what it holds.  A row is there
as long as no later delta has its key; a read finds that by one join with the keys, or none where a table is one delta.  Deltas are merged by size: when the younger ones together reach a share of an older one, they become one with it,
so a row is rewritten a number of times that grows with the logarithm of the table.

Which deltas there are is said by a manifest for all tables.  A transaction commits its deltas of all tables at once, by the next manifest; a reader sees one snapshot, and what a failed writer left is not part of any.
Of two transactions that write the same key the later commit wins.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .manifest import Conflict, Manifests
from .schemas import TABLES

#: A delta is merged with the younger ones when they hold this share of its bytes; commits that are tried before a writer gives up.
MERGE_SHARE, ATTEMPTS = 0.5, 20


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table is there."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


class Store:
    """Tables below one path of any file system that Spark can write.  With ``snapshot``, as they were after that commit, and read only."""

    def __init__(self, spark: SparkSession, path: str, snapshot: int | None = None, merges: bool = True) -> None:
        self.spark, self.path, self.merges = spark, path.rstrip("/"), merges
        self.manifests = Manifests(spark, f"{self.path}/_manifests")
        self.pinned = self.manifests.read(snapshot) if snapshot is not None else None
        self._own: dict[str, list[dict]] | None = None
        self._base: dict = {}

    # --- snapshots and transactions ---------------------------------------------------

    def version(self) -> int:
        """The number of the last commit; -1 before the first."""
        return self.manifests.latest()[0]

    def deltas(self, table: str) -> list[dict]:
        """A table's deltas, oldest first: of the snapshot, or in a transaction of its beginning and the transaction's own."""
        if table not in TABLES:
            raise KeyError(f"no table {table}")
        if self._own is not None:
            return self._base.get(table, []) + self._own.get(table, [])
        return (self.pinned if self.pinned is not None else self.manifests.latest()[1]).get(table, [])

    @contextmanager
    def transaction(self) -> Iterator[Store]:
        """What is replaced inside is committed together at the end, or not at all if an error leaves the block.  A transaction inside another is part of it."""
        if self.pinned is not None:
            raise PermissionError("a snapshot is read only")
        if self._own is not None:
            yield self
            return
        self._base, self._own = self.manifests.latest()[1], {}
        try:
            yield self
            own = self._own
        finally:
            self._base, self._own = {}, None
        if own:
            self._commit(lambda now: now | {t: now.get(t, []) + more for t, more in own.items()})
            if self.merges:
                for table in own:
                    self.merge(table)

    def _commit(self, change) -> None:
        """Commit a change of the last manifest, again on the new one if another writer was first.  A change that gives None is no longer possible and is left out."""
        for _ in range(ATTEMPTS):
            number, now = self.manifests.latest()
            taken = self.manifests.numbers()
            new = change(now)
            if new is None:
                return
            try:
                return self.manifests.commit(max([number, *taken[-1:]]) + 1, new)
            except Conflict:
                time.sleep(0.05)
        raise Conflict(f"{self.path}: no commit in {ATTEMPTS} attempts")

    # --- reading ----------------------------------------------------------------------

    def _schema(self, table: str) -> str:
        return TABLES[table][1]

    def _parts(self, table: str, kind: str, deltas: list[dict]) -> DataFrame | None:
        """Rows or keys of deltas with ``_at``, the delta's place."""
        base = f"{self.path}/{table}/{kind}"
        there = [d["id"] for d in deltas if d[kind]]
        if not there:
            return None
        schema = self._schema(table) if kind == "rows" else ", ".join(f"{k} string" for k in TABLES[table][0])
        rows = self.spark.read.schema(schema + ", delta string").option("basePath", base).parquet(*(f"{base}/delta={i}" for i in there))
        places = F.create_map(*(x for k, d in enumerate(deltas) for x in (F.lit(d["id"]), F.lit(k))))
        return rows.withColumn("_at", places[F.col("delta")]).drop("delta")

    def _resolved(self, table: str, deltas: list[dict]) -> DataFrame:
        rows = self._parts(table, "rows", deltas)
        if rows is None:
            return self.spark.createDataFrame([], self._schema(table))
        keys = self._parts(table, "keys", deltas[1:])
        if keys is not None:
            key = list(TABLES[table][0])
            # places count from the second delta in keys and from the first in rows
            last = keys.groupBy(*key).agg((F.max("_at") + 1).alias("_last"))
            same = F.lit(True)
            for k in key:
                same = same & F.col(f"_r_{k}").eqNullSafe(F.col(k))
            last = last.withColumnsRenamed({k: f"_r_{k}" for k in key})
            rows = rows.join(last, same, "left").filter(F.col("_last").isNull() | (F.col("_last") <= F.col("_at"))).drop("_last", *(f"_r_{k}" for k in key))
        return rows.drop("_at")

    def exists(self, table: str) -> bool:
        return bool(self.deltas(table))

    def read(self, table: str) -> DataFrame:
        """The table's rows; a table that was never written is empty."""
        return self._resolved(table, self.deltas(table))

    def conform(self, table: str, rows: DataFrame) -> DataFrame:
        """The declared columns in order and type; columns that the rows lack are null, others are left out."""
        fields = self.spark.createDataFrame([], self._schema(table)).schema
        return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))

    # --- writing ----------------------------------------------------------------------

    def _write(self, table: str, rows: DataFrame, keys: DataFrame | None) -> dict:
        delta = {"id": uuid.uuid4().hex, "rows": True, "keys": keys is not None}
        at = f"{self.path}/{table}/rows/delta={delta['id']}"
        rows.hint("rebalance").write.parquet(at)
        delta["bytes"] = self.manifests.bytes_below(at)
        if keys is not None:
            keys.write.parquet(f"{self.path}/{table}/keys/delta={delta['id']}")
        return delta

    def replace(self, table: str, rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """Put rows in place of all earlier rows of their keys, and of ``keys`` (which may have no rows now); returns the table's rows of ``keys``, or all of them.

        ``keys`` has the first columns of the table's key, or all of them.  A row of a null key is replaced by rows of a null key.
        """
        key = list(TABLES[table][0])
        delta = {"id": uuid.uuid4().hex, "rows": True, "keys": True}
        at = f"{self.path}/{table}/rows/delta={delta['id']}"
        self.conform(table, rows).hint("rebalance").write.parquet(at)
        delta["bytes"] = self.manifests.bytes_below(at)
        made = self.spark.read.schema(self._schema(table)).parquet(at)
        gone = made.select(*key).distinct()
        if keys is not None:
            rest = [k for k in key if k not in keys.columns]
            more = keys.select(*(k for k in key if k in keys.columns)).distinct()
            # further key columns: the combinations that are written now, a handful
            gone = gone.union(more.crossJoin(F.broadcast(made.select(*rest).distinct())).select(*key) if rest else more).distinct()
        gone.select(*(F.col(k).cast("string") for k in key)).write.parquet(f"{self.path}/{table}/keys/delta={delta['id']}")
        with self.transaction():
            self._own.setdefault(table, []).append(delta)
        written = self.read(table)
        if keys is not None:
            written = written.join(keys.select(key[0]).distinct(), key[0], "left_semi")
        return written

    def merge(self, table: str) -> None:
        """Make one delta of the youngest ones where they have grown enough; what they replace in older deltas stays replaced."""
        deltas = self.deltas(table)
        begin, young = len(deltas), 0
        for k in range(len(deltas) - 1, -1, -1):
            if k == len(deltas) - 1 or young >= MERGE_SHARE * deltas[k]["bytes"]:
                begin, young = k, young + deltas[k]["bytes"]
            else:
                break
        old = deltas[begin:]
        if len(old) < 2:
            return
        keys = self._parts(table, "keys", old)
        keys = keys.drop("_at").distinct() if begin and keys is not None else None
        new = self._write(table, self._resolved(table, old), keys)
        ids = [d["id"] for d in old]

        def change(now: dict) -> dict | None:
            have = now.get(table, [])
            at = [d["id"] for d in have].index(ids[0]) if ids[0] in [d["id"] for d in have] else -1
            if at < 0 or [d["id"] for d in have[at : at + len(ids)]] != ids:
                return None  # merged by another writer
            return now | {table: have[:at] + [new] + have[at + len(ids) :]}

        self._commit(change)

    def vacuum(self, keep: int = 1, seconds: float = 86_400) -> None:
        """Delete manifests but for the last ``keep``, and deltas that none of these names and that are older than any running transaction (``seconds``)."""
        numbers = self.manifests.numbers()
        kept = [self.manifests.read(n) for n in numbers[-keep:]]
        used = {d["id"] for m in kept if m for deltas in m.values() for d in deltas}
        for n in numbers[:-keep]:
            self.manifests.delete(f"{self.path}/_manifests/{n:012d}.json")
        oldest = (time.time() - seconds) * 1000
        for table in TABLES:
            for kind in ("rows", "keys"):
                for name, changed in self.manifests.children(f"{self.path}/{table}/{kind}"):
                    if name.removeprefix("delta=") not in used and changed <= oldest:
                        self.manifests.delete(f"{self.path}/{table}/{kind}/{name}")

    def missing(self, table: str, documents: DataFrame) -> DataFrame:
        """Documents that the table does not have."""
        return documents.join(self.read(table).select("document_id").distinct(), "document_id", "left_anti")


def archive_raw(spark: SparkSession, files: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Append raw files (pmid, name, content) with their SHA-256; a file that is there already is an error unless forced.

    A forced write adds a version; files that the new one lacks stay.
    """
    rows = files.withColumn("sha256", F.sha2("content", 256))
    if exists(spark, path) and not force:
        there = rows.join(spark.read.parquet(path).select("pmid", "name"), ["pmid", "name"], "left_semi")
        if not there.isEmpty():
            raise FileExistsError("raw files are immutable; use force to add a version")
    rows.write.mode("append").parquet(path)
    return rows.drop("content")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, name, sha256) of an archive's files."""
    return spark.read.parquet(path).select("pmid", "name", "sha256").distinct()


def has_raw(papers: DataFrame, archive: DataFrame) -> DataFrame:
    """Papers (pmid) with a flag whether the archive has files of them."""
    known = archive.select("pmid").distinct().withColumn("has_raw", F.lit(True))
    return papers.join(known, "pmid", "left").withColumn("has_raw", F.coalesce("has_raw", F.lit(False)))


def has_canonical(papers: DataFrame, store: Store) -> DataFrame:
    """Papers (document_id) with a flag whether the store has a canonical text of them."""
    known = store.read("paragraphs").select("document_id").distinct().withColumn("has_canonical", F.lit(True))
    return papers.join(known, "document_id", "left").withColumn("has_canonical", F.coalesce("has_canonical", F.lit(False)))


def save_metadata(rows: DataFrame, path: str) -> None:
    """Metadata (pmid and any columns) as JSON lines with fields in alphabetical order; a paper that is written again is read as it was written last."""
    stamped = rows.select("pmid", F.to_json(F.struct(*sorted(rows.columns))).alias("metadata"), F.lit(time.time_ns()).alias("written"))
    stamped.write.mode("append").json(path)


def read_metadata(spark: SparkSession, path: str, papers: DataFrame, schema: str) -> DataFrame:
    """Papers (pmid) with their metadata as a struct; null for a paper that has none."""
    try:
        rows = spark.read.schema("pmid string, metadata string, written long").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "pmid string, metadata string, written long")
    last = rows.groupBy("pmid").agg(F.max_by("metadata", "written").alias("metadata"))
    return papers.join(last, "pmid", "left").withColumn("metadata", F.from_json("metadata", schema))


def canonical_json(rows: DataFrame) -> DataFrame:
    """(json) of each row with its fields in alphabetical order."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("json"))


def read_json(rows: DataFrame, schema: str) -> DataFrame:
    """Rows back from (json); text that is no object of the schema gives nulls."""
    return rows.select(F.from_json("json", schema).alias("x")).select("x.*")


def pmid_list(lines: DataFrame) -> DataFrame:
    """Paper ids of a text source (position, line): blanks and comments out, prefixes off, the first of equal ones stays; anything else is an error."""
    from ..functions import text as T
    from ..operators.query import keep_first

    rows = lines.withColumn("pmid", F.trim(F.regexp_replace("line", "#.*$", ""))).filter("pmid <> ''")
    known = T.pmid(F.col("pmid"))
    rows = rows.withColumn("pmid", F.when(known.isNull(), F.raise_error(F.concat(F.lit("no paper id: "), "pmid"))).otherwise(known))
    return keep_first(rows, "pmid", "position").select("position", "pmid")
