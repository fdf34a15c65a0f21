"""Written intermediate tables in the folder that all executors share.

Tables are managed ones of a database that lies in that folder, so that dropping a table deletes its files and a table can be
bucketed for joins that need no shuffle.
"""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of the tables that this driver has written and not dropped, in order.
_live: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.  Only a local session may do without one and gets a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _database(spark: SparkSession) -> str:
    name = "factloom_" + re.sub(r"\W", "_", spark.sparkContext.applicationId.lower())
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def written(df: DataFrame, label: str, buckets: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors.

    With ``buckets``, rows are dealt by the columns ``by`` and joins on those columns read the table without a shuffle.
    """
    spark = df.sparkSession
    name = f"{_database(spark)}.{re.sub(r'\W', '_', label)}_{uuid.uuid4().hex}"
    if buckets:
        df = df.repartition(buckets, *by)
    out = df.write.format("parquet").option("compression", "zstd")
    if buckets:
        out = out.bucketBy(buckets, *by)
    out.saveAsTable(name)
    _live.append(name)
    table = spark.table(name)
    table._factloom_name = name
    return table


def drop(*tables: DataFrame) -> None:
    """Delete written tables whose rows are needed no more."""
    for t in tables:
        _drop_names(t.sparkSession, [t._factloom_name])


def _drop_names(spark: SparkSession, names: Iterable[str]) -> None:
    for name in list(names):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if name in _live:
            _live.remove(name)


def live() -> set[str]:
    """Names of the tables that are there, to be given to ``drop_named`` later."""
    return set(_live)


def drop_named(spark: SparkSession, names: Iterable[str]) -> None:
    _drop_names(spark, [n for n in names if n in _live])


def input_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes that a plan's tables take on disk, without a job; where that is unknown, the bytes of the text column."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if sum(sizes) < 1 << 60:
        return sum(sizes)
    return df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0] // 2


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs, whose results are written, before the next stage needs room.

    Spark deletes them when the driver's garbage is collected; by itself that may be half an hour later.  What Python let go counts as
    garbage only when a thread of Py4J, which looks once a second, has told the JVM.  One collection was seen to leave the last
    query's files and the next one to take them; so there are several.
    """
    gc.collect()
    untold = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    until = time.monotonic() + 5
    while untold and time.monotonic() < until:
        time.sleep(0.05)
    time.sleep(0.1)  # for the last one, which is on its way
    for _ in range(3):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
