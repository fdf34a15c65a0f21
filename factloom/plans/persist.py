"""Ingest: raw files or paragraphs to every stored table, each stage written once and read back for the next."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import __version__
from ..functions import text as T
from ..operators import claims as C
from ..operators import documents, facts, mentions, query
from ..sources import vocabulary, xml
from ..sources.staging import release, staged
from ..sources.store import Store
from . import rules as R
from .extract import extract

#: Stage of the extraction plan: the table that holds it.
STAGES = {"paragraphs": "paragraphs", "sections": "sections", "sentences": "sentences", "mentions": "entity_mentions", "modifiers": "entity_modifiers", "observations": "observations", "claims": "claims"}


def normalize(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, raw paragraphs) of raw files (pmid, name, content): ``pubmed.xml`` and, where there is one, ``pmc.xml``."""
    files = raw.withColumn("document_id", T.document_id(F.col("pmid")))
    pubmed, pmc = files.filter("name like 'pubmed%'"), files.filter("name like 'pmc%'")
    records = xml.pubmed_records(pubmed)
    return records, documents.assemble(records.select("document_id", "title"), xml.abstract_sections(pubmed), xml.jats_sections(pmc))


def rule_registry(spark) -> DataFrame:
    """(rule_id, rule_version, kind, pattern, predicate) of all rules, once each."""
    rows = [(r[0], R.RULESET_VERSION, "relation", r[4], r[1]) for r in R.RELATION_RULES] + [(q[0], R.RULESET_VERSION, "qualifier", "".join(q[2:]), q[1]) for q in R.QUALIFIER_RULES]
    return spark.createDataFrame(rows, "rule_id string, rule_version string, kind string, pattern string, predicate string").dropDuplicates(["rule_id"])


def persist_extraction(store: Store, paragraphs: DataFrame, ids: DataFrame, detect: Callable[[str], Iterable[tuple]] | None = None, **options) -> dict[str, DataFrame]:
    """The tables of the extraction plan for the documents ``ids``, and their children: evidence, qualifiers, modifiers, open observations; committed together."""
    with store.transaction():
        return _persist_extraction(store, paragraphs, ids, detect, **options)


def _persist_extraction(store: Store, paragraphs: DataFrame, ids: DataFrame, detect: Callable[[str], Iterable[tuple]] | None, **options) -> dict[str, DataFrame]:
    stored: dict[str, DataFrame] = {}
    held: dict[str, DataFrame] = {}  # steps that no table has, of which several are made

    def keep(name: str, rows: DataFrame) -> DataFrame:
        if name not in STAGES:
            held[name] = staged(rows, name)
            return held[name]
        if name == "claims":
            rows = rows.join(C.parents(C.linked(rows, stored["observations"])), "claim_id", "left")
        stored[name] = store.replace(STAGES[name], rows, ids)
        return stored[name]

    found = extract(paragraphs, keep=keep, **options)
    spark = store.spark
    obs, claim_rows, texts = found["observations"], found["claims"], found["texts"]
    concepts = options.get("concepts") if options.get("concepts") is not None else vocabulary.concepts(spark)
    used = found["mentions"].filter("concept_id is not null").select("concept_id").distinct()
    store.replace("entities", concepts.join(used, "concept_id", "left_semi"))
    store.replace("extraction_rules", rule_registry(spark))
    quals = found["qualifiers"]
    store.replace("observation_qualifiers", obs.select("document_id", "observation_id", "clause_id").join(quals, "clause_id"), ids)
    evidence = C.evidence_rows(claim_rows).join(texts, "document_id")
    evidence = evidence.withColumn("quoted_text", F.substring("canonical_text", F.col("start_char") + 1, F.col("end_char") - F.col("start_char")))
    store.replace("claim_evidence", evidence, ids)
    owner = claim_rows.select("claim_id", "document_id")
    store.replace("claim_qualifiers", C.qualifiers_of(claim_rows, obs, quals).join(owner, "claim_id"), ids)
    store.replace("claim_modifiers", C.modifiers_of(claim_rows, obs, found["modifiers"]).join(owner, "claim_id"), ids)
    detected = mentions.open_observations(found["sentences"], detect) if detect is not None else spark.createDataFrame([], "document_id string")
    store.replace("open_observations", detected, ids)
    release(*held.values())
    return {name: rows for name, rows in found.items() if name not in held}


def persist_papers(store: Store, raw: DataFrame, records: DataFrame, paragraphs: DataFrame) -> None:
    """Study characteristics, funding, authors with affiliations and institutions, and assessments of the papers."""
    spark, ids = store.spark, records.select("document_id")
    files = raw.withColumn("document_id", T.document_id(F.col("pmid")))
    people = xml.author_affiliations(files.filter("name like 'pubmed%'"))
    places = people.filter("affiliation_id is not null").select("affiliation_id", "document_id", "raw_text").dropDuplicates(["affiliation_id"])
    known = facts.institutions(places, vocabulary.institutions(spark))
    store.replace("institutions", known.select("institution_id", "institution_name", "institution_type").dropDuplicates(["institution_id"]))
    affiliations = store.replace("affiliations", known, ids)
    store.replace("authors", people.select("author_id", "document_id", "position", "name").dropDuplicates(["author_id"]), ids)
    store.replace("author_affiliations", people.filter("affiliation_id is not null").select("document_id", "author_id", "affiliation_id").distinct(), ids)
    types = records.select("document_id", F.posexplode("publication_types").alias("pos", "publication_type"))
    whole = documents.canonical_text(paragraphs).select("document_id", F.col("canonical_text").alias("text"))
    papers = records.select("document_id", "publication_date").join(whole, "document_id", "left")
    study = facts.study_characteristics(papers, types, vocabulary.countries(spark), affiliations.select("document_id", F.col("raw_text").alias("text")))
    study = store.replace("study_characteristics", study, ids)
    statements = xml.statements(files.filter("name like 'pmc%'"))
    funders = vocabulary.funders(spark)
    money = store.replace("funding_relationships", facts.funding_relationships(statements, funders), ids)
    store.replace("funders", funders.select("funder_id", "canonical_name", "funder_type").dropDuplicates(["funder_id"]).join(money.select("funder_id").distinct(), "funder_id", "left_semi"))
    grades = store.replace("assessments", facts.assess(facts.paper_facts(study, money)), ids)
    framework = ["framework_id", "framework_version"]
    store.replace("assessment_frameworks", grades.select(*framework).distinct())
    store.replace("assessment_criteria", grades.select(*framework, "criterion").distinct())


def source_version() -> str | None:
    """The commit that this code was checked out at; None where it is no checkout."""
    root = Path(__file__).resolve().parents[2] / ".git"
    try:
        head = (root / "HEAD").read_text().strip()
        if not head.startswith("ref: "):
            return head or None
        name = head.removeprefix("ref: ")
        if (root / name).exists():
            return (root / name).read_text().strip()
        packed = (root / "packed-refs").read_text().splitlines()
        return next((line.split()[0] for line in packed if line.endswith(f" {name}")), None)
    except OSError:
        return None


def versions(documents_: DataFrame, timestamp: str | None = None) -> DataFrame:
    """One run (run_id and what it was made with) over documents; times do not count in its id."""
    made = [__version__, R.RULESET_VERSION, vocabulary.digest()]
    stamp = timestamp or datetime.now(timezone.utc).isoformat(timespec="seconds")
    run = query.run_id(documents_, made).crossJoin(documents_.agg(F.count_distinct("document_id").alias("documents")))
    return run.select("run_id", F.lit(stamp).alias("timestamp"), F.lit(__version__).alias("tool_version"), F.lit(source_version()).cast("string").alias("source_version"), F.lit(made[1]).alias("ruleset_version"), F.lit(made[2]).alias("lexicon_digest"), "documents")


def ingest(store: Store, raw: DataFrame, detect: Callable[[str], Iterable[tuple]] | None = None, timestamp: str | None = None, **options) -> DataFrame:
    """All tables of raw files (pmid, name, content), replaced paper by paper and committed together; returns the run."""
    with store.transaction():
        return _ingest(store, raw, detect, timestamp, **options)


def _ingest(store: Store, raw: DataFrame, detect: Callable[[str], Iterable[tuple]] | None, timestamp: str | None, **options) -> DataFrame:
    records, paragraphs = normalize(raw)
    records = store.replace("documents", records.withColumn("source_type", F.lit("xml")))
    ids = records.select("document_id")
    found = persist_extraction(store, paragraphs, ids, detect, **options)
    persist_papers(store, raw, records, found["paragraphs"])
    run = store.replace("extraction_runs", versions(ids, timestamp))
    texts = found["texts"].crossJoin(F.broadcast(run.select("run_id")))
    version = F.concat_ws(":", "document_id", "run_id").alias("version_id")
    store.replace("document_versions", texts.select(version, "document_id", "run_id", F.sha2("canonical_text", 256).alias("text_sha256"), F.length("canonical_text").alias("n_chars")), ids)
    return run


def summary(obs: DataFrame, claim_rows: DataFrame, found: DataFrame) -> DataFrame:
    """(document_id, mentions, normalized, observations, claims, dropped): what extraction made of each document."""
    counts = [
        found.groupBy("document_id").agg(F.count("*").alias("mentions"), F.count_if(F.col("status") == "normalized").alias("normalized")),
        obs.groupBy("document_id").agg(F.count("*").alias("observations")), claim_rows.groupBy("document_id").agg(F.count("*").alias("claims")), C.dropped(obs),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.join(c, "document_id", "full")
    return out.na.fill(0)
