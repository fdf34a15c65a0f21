"""The scanner, the readers of markup and a user's detector as table functions of SQL.

    register(spark)
    SELECT d.doc_id, s.* FROM documents d, LATERAL scan_spans(d.text, 'nd|er') s
    SELECT * FROM running_offsets(TABLE(SELECT doc_id, k, text FROM pieces) PARTITION BY doc_id ORDER BY k)

Columns' names and types are told by ``analyze``, which also refuses arguments of another kind before anything runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

SPAN = StructType().add("start_char", IntegerType()).add("end_char", IntegerType()).add("span_text", StringType())


def _strings(*arguments: AnalyzeArgument) -> None:
    for k, a in enumerate(arguments):
        if a.isTable or not isinstance(a.dataType, StringType):
            raise ValueError(f"argument {k + 1} has to be a string")


@udtf
class ScanSpans:
    """scan_spans(text, pattern): all matches of a pattern, which has to be a constant, in any case, with offsets in code points."""

    @staticmethod
    def analyze(text: AnalyzeArgument, pattern: AnalyzeArgument) -> AnalyzeResult:
        _strings(text, pattern)
        if not pattern.isConstantExpression or pattern.value is None:
            raise ValueError("the pattern has to be a constant")
        re.compile(pattern.value)
        return AnalyzeResult(SPAN)

    def __init__(self) -> None:
        self.compiled: dict[str, re.Pattern] = {}

    def eval(self, text: str, pattern: str) -> Iterable[tuple]:
        found = self.compiled.setdefault(pattern, re.compile(pattern, re.IGNORECASE))
        for m in found.finditer(text or ""):
            if m.end() > m.start():
                yield m.start(), m.end(), m[0]


@udtf
class MarkupSections:
    """markup_sections(content): sections of an article's body in reading order - index, title and paragraph text."""

    @staticmethod
    def analyze(content: AnalyzeArgument) -> AnalyzeResult:
        _strings(content)
        return AnalyzeResult(StructType().add("section_idx", IntegerType()).add("section_title", StringType()).add("paragraph_idx", IntegerType()).add("raw_text", StringType()))

    def eval(self, content: str) -> Iterable[tuple]:
        from ..sources.xml import body_paragraphs

        yield from body_paragraphs((content or "").encode())


@udtf
class RunningOffsets:
    """running_offsets(TABLE(SELECT id, k, text ...) PARTITION BY id ORDER BY k): where each piece of a text begins and ends when they are joined by ``gap`` (two characters unless told)."""

    @staticmethod
    def analyze(pieces: AnalyzeArgument, gap: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not pieces.isTable or len(pieces.dataType.fields) != 3:
            raise ValueError("the first argument has to be a table of id, place and text")
        key, place, text = pieces.dataType.fields
        schema = StructType().add("id", key.dataType).add("place", place.dataType).add("start_char", IntegerType()).add("end_char", IntegerType()).add("piece", StringType())
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.name)], orderBy=[OrderingColumn(place.name)])

    def __init__(self) -> None:
        self.at = 0

    def eval(self, row, gap: int = 2) -> Iterable[tuple]:
        text = row[2] or ""
        yield row[0], row[1], self.at, self.at + len(text), text
        self.at += len(text) + gap


def detector(detect: Callable[[str], Iterable[tuple[int, int, str, float]]]):
    """detect_spans(text) of a user's detector: start, end, label and score of each span."""

    @udtf(returnType="start_char int, end_char int, span_text string, label string, score double")
    class DetectSpans:
        def eval(self, text: str) -> Iterable[tuple]:
            for start, end, label, score in detect(text or ""):
                yield start, end, text[start:end], label, float(score)

    return DetectSpans


def register(spark: SparkSession, detect: Callable[[str], Iterable[tuple[int, int, str, float]]] | None = None) -> None:
    """Make scan_spans, markup_sections and running_offsets, and detect_spans of a detector, known to the session's SQL."""
    for name, function in (("scan_spans", ScanSpans), ("markup_sections", MarkupSections), ("running_offsets", RunningOffsets)):
        spark.udtf.register(name, function)
    if detect is not None:
        spark.udtf.register("detect_spans", detector(detect))
