"""Intermediate tables in the folder that all executors share: a plan that reads a step several times is cut there, and a lost executor loses nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Only a local session may do without one and gets a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to a table of their own and read back."""
    path = f"{shared_dir(rows.sparkSession)}/staged/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    out = rows.sparkSession.read.schema(rows.schema).parquet(path)
    out._staged_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(t._staged_at)
        at.getFileSystem(conf).delete(at, True)
