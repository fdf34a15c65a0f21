"""Query layer: filtered claims and papers, listings, evidence, explanation and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .facts import INDUSTRY


def matches(concept: str, name: str, value: str) -> Column:
    """Whether an endpoint's id or name is the value, in any case."""
    return (F.lower(concept) == value.lower()) | (F.lower(name) == value.lower())


def independent(funding: DataFrame) -> DataFrame:
    """(document_id) of papers with funding of which none is industry; unknown funders count as not industry."""
    return funding.groupBy("document_id").agg(F.bool_and(~F.col("funder_type").isin(INDUSTRY)).alias("ok")).filter("ok").select("document_id")


def find_claims(claims: DataFrame, qualifiers: DataFrame | None = None, funding: DataFrame | None = None, *, subject: str | None = None, condition: str | None = None, predicate: str | None = None, polarity: str | None = None, disease_state: str | None = None, funder_type: str | None = None, require_independent_funding: bool = False) -> DataFrame:
    """Claims that pass every given filter; filters on columns reach the scan, the others are semi joins.

    The condition may be either endpoint.  qualifiers: claim_id, qualifier_type, value_concept_id, value_text.
    """
    rows = claims
    for column, value in (("predicate", predicate), ("polarity", polarity)):
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    if subject is not None:
        rows = rows.filter(matches("subject_concept_id", "subject_name", subject))
    if condition is not None:
        rows = rows.filter(matches("subject_concept_id", "subject_name", condition) | matches("object_concept_id", "object_name", condition))
    if disease_state is not None:
        hit = qualifiers.filter((F.col("qualifier_type") == "disease_state") & (F.coalesce(F.lower("value_concept_id") == disease_state.lower(), F.lit(False)) | F.coalesce(F.lower("value_text") == disease_state.lower(), F.lit(False))))
        rows = rows.join(hit.select("claim_id"), "claim_id", "left_semi")
    if funder_type is not None:
        rows = rows.join(funding.filter(F.col("funder_type") == funder_type).select("document_id"), "document_id", "left_semi")
    if require_independent_funding:
        rows = rows.join(independent(funding), "document_id", "left_semi")
    return rows


def find_papers(characteristics: DataFrame, funding: DataFrame | None = None, *, study_design: str | None = None, publication_year_from: int | None = None, funder_type: str | None = None, require_independent_funding: bool = False) -> DataFrame:
    """Papers with study characteristics, one column per field, that pass every given filter; a year that is no number fails."""
    fields = ["study_design", "publication_year", "sample_size", "follow_up", "country"]
    rows = characteristics.groupBy("document_id").pivot("field", fields).agg(F.max("value"))
    if study_design is not None:
        rows = rows.filter(F.col("study_design") == study_design)
    if publication_year_from is not None:
        rows = rows.filter(T.safe_int(F.col("publication_year")) >= publication_year_from)
    if funder_type is not None:
        rows = rows.join(funding.filter(F.col("funder_type") == funder_type).select("document_id"), "document_id", "left_semi")
    if require_independent_funding:
        rows = rows.join(independent(funding), "document_id", "left_semi")
    return rows


def latest_run(runs: DataFrame) -> DataFrame:
    """The run with the latest timestamp; of equal ones the greatest id.  One aggregate, no sort of all rows."""
    return runs.agg(F.max(F.struct("timestamp", "run_id")).alias("m")).select(F.col("m.run_id").alias("run_id"), F.col("m.timestamp").alias("timestamp"))


def for_document(rows: DataFrame, document_id: str, *order: str) -> DataFrame:
    """Rows of one document in a total order."""
    return rows.filter(F.col("document_id") == document_id).orderBy(*order)


def mentions_of(found: DataFrame, concept_id: str) -> DataFrame:
    return found.filter(F.col("concept_id") == concept_id).orderBy("document_id", "start_char", "end_char")


def find_evidence(evidence: DataFrame, texts: DataFrame) -> DataFrame:
    """Evidence with its text cut anew from the canonical text, and whether that is what was quoted."""
    rows = evidence.join(texts, "document_id")
    again = F.substring(F.col("canonical_text"), F.col("start_char") + 1, F.col("end_char") - F.col("start_char"))
    return rows.withColumn("reconstructed", again).withColumn("intact", F.col("reconstructed") == F.col("quoted_text")).drop("canonical_text")


def explain_claims(claims: DataFrame, evidence: DataFrame | Column, characteristics: DataFrame, funding: DataFrame, assessments: DataFrame) -> DataFrame:
    """Each claim with its evidence, its paper's facts, funders and grades; children are grouped before they are joined.  evidence: rows, or a column of the claims that holds each one's as a list."""
    children = {
        "facts": characteristics.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("field", "value"))).alias("facts")),
        "funders": funding.groupBy("document_id").agg(F.array_sort(F.collect_set(F.struct("funder", "funder_type"))).alias("funders")),
        "grades": assessments.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("criterion", "value"))).alias("grades")),
    }
    if isinstance(evidence, Column):
        rows = claims.withColumn("evidence", F.array_sort(evidence))
    else:
        rows = claims.join(evidence.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char", "quoted_text"))).alias("evidence")), "claim_id", "left")
    for child in children.values():
        rows = rows.join(child, "document_id", "left")
    return rows


def audit(explained: DataFrame) -> DataFrame:
    """(claim_id, report): a claim's text report."""
    part = lambda title, c, fmt: F.when(F.size(c) > 0, F.concat(F.lit(f"\n{title}: "), F.array_join(F.transform(c, fmt), "; "))).otherwise("")
    return explained.select("claim_id", F.concat(
        "subject_name", F.lit(" "), "predicate", F.lit(" "), "object_name", F.lit(" ["), "polarity", F.lit(", "), "certainty", F.lit("]"),
        part("evidence", "evidence", lambda x: x["quoted_text"]), part("facts", "facts", lambda x: F.concat_ws("=", x["field"], x["value"])),
        part("funding", "funders", lambda x: F.concat_ws(": ", x["funder"], x["funder_type"])), part("grades", "grades", lambda x: F.concat_ws("=", x["criterion"], x["value"])),
    ).alias("report"))


def in_span(spans: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of a span and a mention of its document that overlap it (an equi join on the document with a range)."""
    m = found.select(F.col("document_id").alias("d"), "mention_id", F.col("start_char").alias("m_start"), F.col("end_char").alias("m_end"))
    return spans.join(m, (spans["document_id"] == m["d"]) & (F.col("m_start") < F.col("end_char")) & (F.col("start_char") < F.col("m_end"))).drop("d")


def on_topic(papers: DataFrame) -> DataFrame:
    """Papers with a flag whether their title names the topic."""
    return papers.withColumn("on_topic", T.title_matches(F.col("title")))


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Request items without blanks, the first of equal ones, in order."""
    rows = rows.withColumn(key, F.trim(F.col(key))).filter(F.length(key) > 0)
    return rows.withColumn("__k", F.row_number().over(W.partitionBy(key).orderBy(order))).filter("__k = 1").drop("__k")


def run_id(documents: DataFrame, versions: list[str], extra: str = "") -> DataFrame:
    """(run_id): digest of versions and the set of document ids; times do not count.

    Ids are hashed one by one and summed as whole numbers, in whatever order they come, so no task holds them all.
    """
    digest = F.sha2("document_id", 256)
    part = lambda k: F.sum(F.conv(F.substring(digest, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)"))
    ids = documents.select("document_id").distinct().agg(F.count("*").alias("n"), *(F.coalesce(part(k), F.lit(0)).alias(f"s{k}") for k in range(3)))
    parts = [*(F.lit(v) for v in versions), *(F.col(c).cast("string") for c in ("n", "s0", "s1", "s2")), F.lit(extra)]
    return ids.select(F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, 16).alias("run_id"))


def texts_between(obs: DataFrame, texts: DataFrame) -> DataFrame:
    """Observations with the text between their endpoints, and its length (0, where they touch or overlap)."""
    lo, hi = F.least("subject_end_char", "object_end_char"), F.greatest("subject_start_char", "object_start_char")
    rows = obs.join(texts, "document_id")
    return rows.withColumn("between", F.substring("canonical_text", lo + 1, F.greatest(hi - lo, F.lit(0)))).withColumn("distance", F.greatest(hi - lo, F.lit(0))).drop("canonical_text")


def nested_documents(documents: DataFrame, sections: DataFrame, paragraphs: DataFrame, sentences: DataFrame) -> DataFrame:
    """Documents with sections > paragraphs > sentences as nested arrays in reading order; null for what has no children.

    sentences and paragraphs: with section_id.  All rows are dealt once, by document, and grouped there from the leaves up.
    """
    span = ("start_char", "end_char")
    rows = documents.select("document_id", F.struct(*documents.columns).alias("d")).filter("document_id is not null")
    for part, name, keys, columns in (
        (sections, "s", ["section_id"], ("section_id", "title")), (paragraphs, "p", ["section_id", "paragraph_id"], ("paragraph_id", "text")), (sentences, "x", ["section_id", "paragraph_id"], ("sentence_id", "text")),
    ):
        rows = rows.unionByName(part.select("document_id", *keys, F.struct(*span, *columns).alias(name)), allowMissingColumns=True)
    rows = rows.repartition("document_id")
    first = lambda *names: [F.first(c, ignorenulls=True).alias(c) for c in names]
    some = lambda c: F.when(F.size(c) > 0, F.array_sort(c))
    filled = lambda of, columns, child, name: F.when(F.col(of).isNotNull(), F.struct(*(F.col(f"{of}.{c}").alias(c) for c in (*span, *columns)), some(child).alias(name)))
    rows = rows.groupBy("document_id", "section_id", "paragraph_id").agg(*first("d", "s", "p"), F.collect_list("x").alias("x"))
    rows = rows.withColumn("p", filled("p", ("paragraph_id", "text"), "x", "sentences")).groupBy("document_id", "section_id").agg(*first("d", "s"), F.collect_list("p").alias("p"))
    rows = rows.withColumn("s", filled("s", ("section_id", "title"), "p", "paragraphs")).groupBy("document_id").agg(*first("d"), F.collect_list("s").alias("s"))
    return rows.filter("d is not null").select("d.*", some("s").alias("sections"))


def deconstruct(sents: DataFrame, clause_rows: DataFrame, found: DataFrame, obs: DataFrame) -> DataFrame:
    """A trace of each sentence: its clauses, mentions and observations in order, and why nothing is bound where that is so."""
    clauses_ = clause_rows.groupBy("sentence_id").agg(F.array_sort(F.collect_list(F.struct("clause_index", "text", "marker"))).alias("clauses"))
    mentions_ = found.filter("sentence_id is not null").groupBy("sentence_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "surface_text", "concept_id", "status"))).alias("mentions"))
    bound = obs.groupBy("sentence_id").agg(F.array_sort(F.collect_list(F.struct("subject_start_char", "object_start_char", "predicate", "rule_id", "polarity", "certainty"))).alias("observations"))
    rows = sents.select("document_id", "sentence_id", "start_char", "text")
    for child in (clauses_, mentions_, bound):
        rows = rows.join(child, "sentence_id", "left")
    n = F.coalesce(F.size("mentions"), F.lit(0))
    reason = F.when(F.col("observations").isNotNull(), "bound").when(n <= 0, "no_mentions").when(n == 1, "one_mention").otherwise("no_relation_between_mentions")
    return rows.withColumn("outcome", reason)


def explain_fully(claims: DataFrame, evidence: DataFrame | Column, characteristics: DataFrame, funding: DataFrame, assessments: DataFrame, documents: DataFrame, runs: DataFrame, obs: DataFrame | None = None) -> DataFrame:
    """``explain_claims`` with the paper, the latest run and the claim's observations, unless the claims bring these (see ``claims.fold``).  documents: document_id, title, journal, publication_date."""
    rows = explain_claims(claims, evidence, characteristics, funding, assessments)
    paper = documents.select("document_id", F.struct("title", "journal", "publication_date").alias("paper"))
    # the latest run is one row
    rows = rows.join(paper, "document_id", "left").crossJoin(F.broadcast(latest_run(runs).select("run_id")))
    if obs is None:
        return rows
    of = claims.select("claim_id", F.explode("observation_ids").alias("observation_id")).join(obs.select("observation_id", "sentence_id", "predicate", "rule_id", "context"), "observation_id")
    of = of.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("observation_id", "sentence_id", "predicate", "rule_id", "context"))).alias("observations"))
    return rows.join(of, "claim_id", "left")


def paper_report(documents: DataFrame, characteristics: DataFrame, funding: DataFrame, assessments: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per document: title, source, year, design and size (numbers, or null), its kinds of funders, its grade of independence, and how many claims it makes.  Children are grouped before they are joined."""
    wide = characteristics.groupBy("document_id").pivot("field", ["publication_year", "study_design", "sample_size"]).agg(F.min("value"))
    wide = wide.withColumns({c: T.safe_int(F.col(c)) for c in ("publication_year", "sample_size")})
    money = funding.groupBy("document_id").agg(F.array_sort(F.collect_set("funder_type")).alias("funder_types"))
    grade = assessments.filter("criterion = 'funding_independence'").groupBy("document_id").agg(F.max("value").alias("funding_independence"))
    made = claims.groupBy("document_id").agg(F.count("*").alias("n_claims"))
    rows = documents.select("document_id", "title", "source_type")
    for child in (wide, money, grade, made):
        rows = rows.join(child, "document_id", "left")
    return rows.withColumns({"funder_types": F.coalesce("funder_types", F.array().cast("array<string>")), "n_claims": F.coalesce("n_claims", F.lit(0))})


def author_institutions(authors: DataFrame, links: DataFrame, affiliations: DataFrame, institutions: DataFrame) -> DataFrame:
    """Authors with their affiliations and the institutions of these; an author may have none, and an affiliation an institution that is not listed."""
    rows = authors.join(links.select("author_id", "affiliation_id"), "author_id", "left").join(affiliations.select("affiliation_id", "raw_text", "institution_id"), "affiliation_id", "left")
    return rows.join(institutions.select("institution_id", "institution_name", "institution_type"), "institution_id", "left").select("document_id", "author_id", "position", "name", "affiliation_id", "raw_text", "institution_id", "institution_name", "institution_type")


def distinct_in_order(messages: Column) -> Column:
    """The first of each of equal messages of a list."""
    return F.array_distinct(messages)


#: Tables that are listed by document, with their order.
LISTS = {
    "documents": ("document_id",), "sentences": ("start_char",), "entity_mentions": ("start_char", "end_char", "entity_type"), "entity_modifiers": ("owner_id", "relation", "value_text"), "claims": ("subject_name", "predicate", "object_name", "claim_id"),
    "claim_evidence": ("claim_id", "start_char"), "observations": ("subject_start_char", "object_start_char", "predicate", "observation_id"), "open_observations": ("start_char",),
}


def listed(store, table: str, document_id: str) -> DataFrame:
    """One document's rows of a stored table in its order; claims come with their qualifiers and modifiers."""
    rows = store.read(table).filter(F.col("document_id") == document_id)
    if table == "claims":
        from .claims import with_children

        rows = with_children(rows, *(store.read(t).filter(F.col("document_id") == document_id) for t in ("claim_qualifiers", "claim_modifiers")))
    if table == "open_observations":
        return rows.orderBy(F.desc("score"), "start_char", "open_observation_id")
    return rows.orderBy(*LISTS[table])
