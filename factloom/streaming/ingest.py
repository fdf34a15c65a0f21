"""Incremental ingest: a stream of raw paragraphs, extracted and replaced in the store batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.persist import persist_extraction
from ..sources.store import Store


def ingest(spark: SparkSession, source: str, store: Store, checkpoint: str, schema: str = "document_id string, section_idx int, section_title string, paragraph_idx int, raw_text string", **options):
    """A query that reads new Parquet files of raw paragraphs; each file holds whole documents.

    ``options`` go to the extraction plan.  A batch replaces its documents' rows, so a batch that is run again after a failure leaves the same tables.
    """

    def batch(rows: DataFrame, _: int) -> None:
        persist_extraction(store, rows, rows.select("document_id").distinct(), **options)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
