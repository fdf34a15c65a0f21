"""Canonical documents: paragraphs to one offset-addressable text, sentences and clauses.

The contract of every span: the slice [start, end) of the document's canonical text is the span's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.scan import let, segments
from ..plans.rules import CLAUSE_MARKERS, CONTRASTIVE

#: Between two paragraphs of the canonical text.
PARAGRAPH_GAP = 2
#: Ends of sentences: closing marks and white space after . ! ? unless an abbreviation, an initial or a citation precedes.
SENTENCE_GAP = (
    r"(?U)(?<=[.!?]|[.!?][\"')\]])(?<!\b(?:e\.g|i\.e|et al|al|vs|cf|ca|approx|Fig|Figs|Eq|Ref|Dr|Mr|Mrs|Ms|Prof|St|No|Vol|pp|resp|incl|etc)\.)(?<!\b[A-Z]\.)\s+(?=[\"'(\[]?[\p{Lu}\p{N}])"
)


def canonical_paragraphs(raw: DataFrame) -> DataFrame:
    """Paragraphs with offsets and dense ids.

    raw: document_id, section_idx, section_title, paragraph_idx, raw_text.  Paragraphs without text are dropped, then
    sections without paragraphs; what stays is numbered without gaps, and offsets run on over the document.
    """
    rows = raw.withColumn("text", T.normalize_ws(F.col("raw_text"))).filter(F.length("text") > 0)
    by_doc = W.partitionBy("document_id").orderBy("section_idx", "paragraph_idx")
    before = by_doc.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({
        "start_char": F.coalesce(F.sum(F.length("text") + PARAGRAPH_GAP).over(before), F.lit(0)).cast("int"),
        "sec": F.dense_rank().over(W.partitionBy("document_id").orderBy("section_idx")) - 1,
        "par": F.row_number().over(W.partitionBy("document_id", "section_idx").orderBy("paragraph_idx")) - 1,
    })
    rows = rows.withColumn("section_id", T.section_id(F.col("document_id"), F.col("sec")))
    return rows.select(
        "document_id", "section_id", T.paragraph_id(F.col("section_id"), F.col("par")).alias("paragraph_id"), "section_title", F.col("sec").alias("section_index"),
        "start_char", (F.col("start_char") + F.length("text")).alias("end_char"), "text", "raw_text",
    )


def canonical_text(paragraphs: DataFrame) -> DataFrame:
    """(document_id, canonical_text)."""
    parts = paragraphs.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "text"))).alias("p"))
    return parts.select("document_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n" * PARAGRAPH_GAP).alias("canonical_text"))


def sections(paragraphs: DataFrame) -> DataFrame:
    """One row per section with its span and text."""
    grouped = paragraphs.groupBy("document_id", "section_id", "section_index").agg(
        F.min_by("section_title", "start_char").alias("title"), F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char"),
        F.array_sort(F.collect_list(F.struct("start_char", "text"))).alias("p"),
    )
    return grouped.withColumn("text", F.array_join(F.transform("p", lambda x: x["text"]), "\n" * PARAGRAPH_GAP)).drop("p")


def between(text: Column, pattern: str) -> Column:
    """The trimmed, non-empty spans between matches of a pattern: array<struct<s, e, t>>."""
    return F.filter(F.transform(segments(text, pattern), T.trimmed), lambda x: x["e"] > x["s"])


def sentences(paragraphs: DataFrame, pattern: str = SENTENCE_GAP) -> DataFrame:
    """Rule-based sentences of each paragraph, with document offsets."""
    spans = paragraphs.select("document_id", "section_id", "paragraph_id", "start_char", F.posexplode(between(F.col("text"), pattern)).alias("k", "x"))
    return spans.select(
        T.sentence_id(F.col("paragraph_id"), F.col("k")).alias("sentence_id"), "paragraph_id", "section_id", "document_id",
        (F.col("start_char") + F.col("x.s")).cast("int").alias("start_char"), (F.col("start_char") + F.col("x.e")).cast("int").alias("end_char"), F.col("x.t").alias("text"),
    )


def clauses(sents: DataFrame, markers: str = CLAUSE_MARKERS, contrastive: list[str] = CONTRASTIVE) -> DataFrame:
    """Clauses of each sentence: the text between markers, each with the marker that opens it.

    Segments without text vanish with their marker; the first clause that is kept is never contrastive.
    """
    marked = lambda found: F.transform(found, lambda x, k: F.struct(T.trimmed(x).alias("x"), F.lower(F.get(found, k - 1)["m"]).alias("m")))
    parts = let(segments(F.col("text"), "(?iU)" + markers), marked)
    rows = sents.select("document_id", "sentence_id", "start_char", F.posexplode(F.filter(parts, lambda p: p["x"]["e"] > p["x"]["s"])).alias("clause_index", "p"))
    return rows.select(
        T.clause_id(F.col("sentence_id"), F.col("clause_index")).alias("clause_id"), "sentence_id", "document_id", "clause_index",
        (F.col("start_char") + F.col("p.x.s")).cast("int").alias("start_char"), (F.col("start_char") + F.col("p.x.e")).cast("int").alias("end_char"), F.col("p.x.t").alias("text"),
        F.col("p.m").alias("marker"), F.coalesce((F.col("clause_index") > 0) & F.col("p.m").isin(contrastive), F.lit(False)).alias("contrastive"),
    )


def assemble(titles: DataFrame, abstracts: DataFrame, bodies: DataFrame) -> DataFrame:
    """Raw paragraphs of each paper: its title as a section of its own, then its body, or its abstract where it has no body.

    titles: document_id, title.  abstracts, bodies: document_id, section_idx, section_title, paragraph_idx, raw_text.
    """
    head = titles.filter(F.length(T.normalize_ws(F.col("title"))) > 0).select("document_id", F.lit(-1).alias("section_idx"), F.lit("Title").alias("section_title"), F.lit(0).alias("paragraph_idx"), F.col("title").alias("raw_text"))
    rest = abstracts.join(bodies.select("document_id").distinct(), "document_id", "left_anti")
    return head.unionByName(bodies).unionByName(rest)


def broken_spans(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans whose text is not the slice of their document's canonical text (none, if the contract holds)."""
    return spans.join(texts, "document_id").filter(F.substring(F.col("canonical_text"), F.col("start_char") + 1, F.col("end_char") - F.col("start_char")) != F.col("text"))


def containing_sentence(spans: DataFrame, sents: DataFrame) -> DataFrame:
    """Each span with the first sentence of its document that contains it (null, if none does)."""
    s = sents.select(F.col("document_id").alias("sd"), F.col("sentence_id").alias("in_sentence"), F.col("start_char").alias("ss"), F.col("end_char").alias("se"))
    hit = spans.join(s, (F.col("document_id") == F.col("sd")) & (F.col("ss") <= F.col("start_char")) & (F.col("end_char") <= F.col("se")), "left")
    first = F.row_number().over(W.partitionBy(*spans.columns).orderBy("ss"))
    return hit.withColumn("k", first).filter("k = 1").select(*spans.columns, F.col("in_sentence").alias("sentence_id"))
