"""Acquisition from recorded responses: a data source that plays what a literature service answered for each paper.

    register(spark)
    raw = spark.read.format("recorded_responses").option("path", folder).load().filter("id between 100 and 200")

The folder (any URI that pyarrow's file systems know) holds ``<pmid>/pubmed.xml``, and where the paper has a full text ``<pmid>/link.json`` with its ``pmcid`` and ``<pmid>/pmc.xml``.  A paper gives one row for each response, or one with status 404 and no
content, so that a paper that is missing stops no others.  Ids are dealt to partitions by range; conditions on ``id`` and ``pmid`` reach the source, so nothing else is listed or read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "id bigint, pmid string, pmcid string, name string, status int, content binary, source_url string, retrieved string"


class IdRange(InputPartition):
    def __init__(self, ids: list[int]) -> None:
        self.ids = ids


class RecordedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.parts = options["path"].rstrip("/"), int(options.get("partitions", 8))
        self.listed = [int(i) for i in options["ids"].split(",") if i.strip()] if "ids" in options else None
        self.stamp = options.get("retrieved", "")
        self.low, self.high, self.only = -(1 << 63), (1 << 63) - 1, None

    def _only(self, ids: Iterable[int]) -> None:
        self.only = set(ids) if self.only is None else self.only & set(ids)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("id",) and isinstance(f, EqualTo):
                self._only([f.value])
            elif column == ("id",) and isinstance(f, In):
                self._only(v for v in f.value if v is not None)
            elif column == ("id",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif column == ("id",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, f.value - isinstance(f, LessThan))
            elif column == ("pmid",) and isinstance(f, EqualTo):
                self._only([int(f.value)] if f.value.isdigit() else [])
            elif column == ("pmid",) and isinstance(f, In):
                self._only(int(v) for v in f.value if v is not None and v.isdigit())
            else:
                yield f
                continue
            if column == ("pmid",):  # "007" is no id of paper 7
                yield f

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def ids(self) -> list[int]:
        """Ids that are asked for: the listed ones, or those the folder has, within the pushed conditions."""
        if self.listed is not None:
            found = self.listed
        elif self.only is not None:
            found = list(self.only)
        else:
            from pyarrow import fs

            system, root = self._files()
            found = [int(x.base_name) for x in system.get_file_info(fs.FileSelector(root)) if x.base_name.isdigit()]
        return sorted({i for i in found if self.low <= i <= self.high and (self.only is None or i in self.only)})

    def partitions(self) -> list[InputPartition]:
        ids = self.ids()
        size = max(1, -(-len(ids) // self.parts))
        return [IdRange(ids[k : k + size]) for k in range(0, len(ids), size)] or [IdRange([])]

    def read(self, partition: IdRange) -> Iterator[tuple]:
        system, root = self._files()

        def content(pmid: int, name: str) -> bytes | None:
            try:
                with system.open_input_stream(f"{root}/{pmid}/{name}") as f:
                    return f.read()
            except FileNotFoundError:
                return None

        for i in partition.ids:
            pubmed, link = content(i, "pubmed.xml"), content(i, "link.json")
            try:
                pmcid = (json.loads(link) or {}).get("pmcid") if link else None
            except ValueError:
                pmcid = None
            answers = [("pubmed.xml", pubmed)]
            if pubmed is not None and pmcid:
                answers.append(("pmc.xml", content(i, "pmc.xml")))
            for name, body in answers:
                yield i, str(i), pmcid, name, 404 if body is None else 200, body, f"{self.path}/{i}/{name}", self.stamp


class RecordedResponses(DataSource):
    """options: path; ids (comma-separated, else all of the folder); partitions (8); retrieved (a timestamp to stamp rows with)."""

    @classmethod
    def name(cls) -> str:
        return "recorded_responses"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordedReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the source known, and let conditions reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordedResponses)


def raw_files(responses: DataFrame) -> DataFrame:
    """(pmid, name, content) of the responses that are there, as ``ingest`` takes them."""
    return responses.filter(F.col("status") == 200).select("pmid", "name", "content")


def failed(responses: DataFrame) -> DataFrame:
    """(pmid, name, status) of those that are not."""
    return responses.filter(F.col("status") != 200).select("pmid", "name", "status")
