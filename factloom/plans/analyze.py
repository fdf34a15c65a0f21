"""Batch analysis over stored tables: topic gate, cohesion, and conclusions across the papers that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analysis, query


def batch(papers: DataFrame, mentions: DataFrame, claims: DataFrame, core_fraction: float = 0.5, threshold: float = 0.2, strengths: DataFrame | None = None) -> dict[str, DataFrame]:
    """papers: document_id, title.  Off-topic titles are set apart, outliers of the shared core are excluded, the rest is synthesised."""
    gated = query.on_topic(papers)
    kept = gated.filter("on_topic").select("document_id")
    concepts = kept.join(mentions.filter("status = 'normalized'").select("document_id", "concept_id").distinct(), "document_id", "left")
    cohesion = analysis.cohesion(concepts, core_fraction, threshold)
    included = cohesion.filter("not is_outlier").select("document_id")
    mine = claims.join(included, "document_id", "left_semi").withColumn("modifier_sig", F.when((F.col("subject_sig") != "") | (F.col("object_sig") != ""), F.format_string("subj[%s]|obj[%s]", "subject_sig", "object_sig")).otherwise(""))
    conclusions = analysis.synthesize(mine, strengths)
    return {"excluded": gated.filter("not on_topic").select("document_id", "title"), "cohesion": cohesion, "claims": mine, "conclusions": analysis.ranked(conclusions)}
