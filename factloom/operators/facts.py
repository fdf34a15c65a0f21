"""Paper facts: study characteristics, funding, affiliations and assessments."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.scan import scan
from ..plans.rules import literal_map

# Publication types, their designs, and the designs' ranks.
PUBTYPE_DESIGN = {
    "systematic review": "systematic_review", "meta-analysis": "meta_analysis", "randomized controlled trial": "randomized_controlled_trial",
    "controlled clinical trial": "controlled_trial", "clinical trial": "controlled_trial", "observational study": "cohort", "case reports": "case_report",
    "case report": "case_report", "comparative study": "controlled_trial", "practice guideline": "guideline", "guideline": "guideline",
    "review": "review", "editorial": "editorial", "letter": "letter",
}
DESIGN_RANK = {
    "systematic_review": 100, "meta_analysis": 95, "randomized_controlled_trial": 90, "controlled_trial": 70, "cohort": 60, "case_control": 55,
    "cross_sectional": 50, "case_series": 40, "case_report": 35, "guideline": 30, "review": 20, "editorial": 10, "letter": 5, "animal": 15, "in_vitro": 15,
}
# Design cues in text, in order, and patterns of sizes and follow-up.
TEXT_DESIGN = [
    (r"\bsystematic review\b", "systematic_review"), (r"\bmeta-?analys[ie]s\b", "meta_analysis"), (r"\brandomi[sz]ed controlled trial\b|\brct\b", "randomized_controlled_trial"),
    (r"\bcase-control study\b", "case_control"), (r"\bcross-sectional\b", "cross_sectional"), (r"\bcohort study\b|\bprospective cohort\b|\bretrospective cohort\b", "cohort"),
    (r"\bcase series\b", "case_series"), (r"\bcase report\b", "case_report"), (r"\bin vitro\b", "in_vitro"), (r"\banimal (?:study|model)\b|\bin vivo\b|\bmurine\b|\bmouse model\b", "animal"),
]
SAMPLE_SIZE = (
    r"\b(?:n\s*=\s*|enrolled|recruited|included|randomi[sz]ed)\s*([0-9][0-9,]{1,6})\b"
    r"|\b([0-9][0-9,]{2,6})\s+(?:participants|patients|subjects|individuals|women|men|adults|children)\b"
)
FOLLOW_UP = r"\bfollow(?:ed)?[-\s]?up\b[^.]{0,40}?\b((?:\d+(?:\.\d+)?|one|two|three|four|five|six|seven|eight|nine|ten)\s+(?:years?|months?|weeks?|days?))\b"
# Assessment groups and thresholds.
INDUSTRY = ["pharmaceutical", "biotechnology", "medical_device", "food_industry", "private_company"]
HIGH, MODERATE = ["systematic_review", "meta_analysis", "randomized_controlled_trial"], ["controlled_trial", "cohort", "case_control"]
RECENT_FROM, ADEQUATE_FROM = 2015, 100
FRAMEWORK, FRAMEWORK_VERSION = "evidence_v1", "1.0.0"


def design_of_types(types: DataFrame) -> DataFrame:
    """(document_id, value, publication_type): the best-ranked design; of equal ranks the first type.  types: document_id, pos, publication_type."""
    rows = types.withColumn("value", literal_map(PUBTYPE_DESIGN)[F.lower(F.trim("publication_type"))]).filter("value is not null")
    rank = F.create_map(*(F.lit(x) for p in DESIGN_RANK.items() for x in p))[F.col("value")]
    return rows.groupBy("document_id").agg(F.min_by(F.struct("value", "publication_type"), F.struct((-rank).alias("r"), "pos")).alias("b")).select("document_id", "b.value", "b.publication_type")


def design_of_text(text: Column) -> Column:
    """The first design whose cue occurs, in order of the cues."""
    return F.coalesce(*(F.when(text.rlike("(?iU)" + p), F.lit(d)) for p, d in TEXT_DESIGN))


def sample_size(text: Column) -> Column:
    """The number of the first size cue, with its commas."""
    m = F.nullif(F.regexp_extract(text, "(?iU)" + SAMPLE_SIZE, 0), F.lit(""))
    return F.nullif(F.regexp_extract(m, r"([0-9][0-9,]+)", 1), F.lit(""))


def follow_up(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, "(?iU)" + FOLLOW_UP, 1), F.lit(""))


def first_span(text: Column, pattern: str) -> Column:
    """struct<s, e, t> of the first match, or null."""
    return F.get(scan(text, "(?iU)" + pattern), F.lit(0))


#: Surfaces of a lexicon that are searched as one pattern; a larger one is no lexicon of names.
MOST_SURFACES = 100_000


def nested(surfaces: list[str]) -> list[tuple[str, str]]:
    """(found, surface): every surface, and the shorter ones that a found one begins with as whole words."""
    known = {s.lower(): s for s in surfaces}
    out = []
    for s in known:
        ends = [k for k in range(1, len(s) + 1) if k == len(s) or not (s[k].isalnum() or s[k] == "_")]
        out += [(s, known[s[:k]]) for k in ends if s[:k] in known]
    return out


def surface_hits(texts: DataFrame, vocabulary: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of texts joined with every vocabulary surface that stands in them as a word, in any case.  vocabulary: surface and its columns; a bounded lexicon.

    One pattern finds, at every place where a word begins, the longest surface that begins there; its shorter beginnings are known beforehand.  What is
    found meets the lexicon by its key.  A surface that stands alone and begins a longer one comes twice.
    """
    spark = texts.sparkSession
    names = [r.surface for r in vocabulary.select("surface").distinct().limit(MOST_SURFACES + 1).collect()]
    if len(names) > MOST_SURFACES:
        raise ValueError(f"a lexicon may have {MOST_SURFACES} surfaces")
    if not names:
        return texts.join(vocabulary, F.lit(False))
    ordered = sorted(set(names), key=lambda s: (-len(s), s))
    pattern = r"(?iU)(?<!\w)(?=(" + "|".join(re.escape(s).replace(r"\ ", " ") for s in ordered) + r")(?!\w))"
    keys = spark.createDataFrame(nested(names), "hit_key string, surface string")
    found = F.array_distinct(F.transform(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(1)), F.lower))
    # the lexicon has MOST_SURFACES rows at most
    lexicon = F.broadcast(keys.join(vocabulary, "surface").select("hit_key", *vocabulary.columns))
    return texts.withColumn("hit_key", F.explode(found)).join(lexicon, "hit_key").drop("hit_key")


def country(texts: DataFrame, countries: DataFrame) -> DataFrame:
    """(document_id, value): by country order, then surface order, then text before affiliations.

    texts: document_id, in_text, text; countries: country_order, surface_order, canonical_name, surface.
    """
    hits = surface_hits(texts, countries)
    return hits.groupBy("document_id").agg(F.min_by("canonical_name", F.struct("country_order", "surface_order", (~F.col("in_text")).alias("o"))).alias("value"))


def study_characteristics(papers: DataFrame, types: DataFrame, countries: DataFrame, affiliations: DataFrame) -> DataFrame:
    """Long rows (document_id, field, value, classification_source).  papers: document_id, text, publication_date; affiliations: document_id, text."""
    by_type = papers.select("document_id", "text").join(design_of_types(types), "document_id", "left")
    by_text = design_of_text(F.col("text"))
    design = by_type.select("document_id", F.lit("study_design").alias("field"), F.coalesce("value", by_text, F.lit("unknown")).alias("value"), F.when(F.col("value").isNotNull(), "pubmed_publication_type").otherwise("text_rule").alias("classification_source"))
    one = lambda field, value, source: papers.select("document_id", F.lit(field).alias("field"), value.alias("value"), F.lit(source).alias("classification_source"))
    year = F.nullif(F.regexp_extract("publication_date", r"^(\d{4})", 1), F.lit(""))
    rows = design.unionByName(one("publication_year", year, "metadata")).unionByName(one("sample_size", F.regexp_replace(sample_size(F.col("text")), ",", ""), "text_rule")).unionByName(one("follow_up", follow_up(F.col("text")), "text_rule"))
    texts = papers.select("document_id", F.lit(True).alias("in_text"), "text").unionByName(affiliations.select("document_id", F.lit(False).alias("in_text"), "text"))
    place = country(texts, countries).select("document_id", F.lit("country").alias("field"), "value", F.lit("text_rule").alias("classification_source"))
    return rows.unionByName(place).filter("value is not null")


def funding_relationships(statements: DataFrame, funders: DataFrame) -> DataFrame:
    """Funders of each paper.

    statements: statement_id, document_id, funder, text, source; funders: funder_id, canonical_name, funder_type, surface.  A named funder is taken as it is, a free text is
    searched for every funder; each name is resolved by its longest known surface, else its type is unknown.
    """
    named = statements.filter(F.coalesce("funder", F.lit("")) != "").select("document_id", "source", F.col("funder").alias("name"))
    free = surface_hits(statements.filter(F.coalesce("funder", F.lit("")) == ""), funders.select("surface", "canonical_name")).select("document_id", "source", F.col("canonical_name").alias("name"))
    names = named.unionByName(free).distinct()
    known = surface_hits(names, funders, "name")
    best = known.groupBy("document_id", "source", "name").agg(F.min_by(F.struct("funder_id", "canonical_name", "funder_type"), F.struct((-F.length("surface")).alias("l"), "surface")).alias("b"))
    rows = names.join(best, ["document_id", "source", "name"], "left").select("document_id", F.coalesce("b.canonical_name", "name").alias("funder"), "b.funder_id", F.coalesce("b.funder_type", F.lit("unknown")).alias("funder_type"), "source")
    return rows.dropDuplicates(["document_id", "funder", "funder_type", "source"])


def institutions(affiliations: DataFrame, known: DataFrame) -> DataFrame:
    """Affiliations (document_id, affiliation_id, raw_text) with an institution: a known one by its longest surface, else an id from the text."""
    hits = surface_hits(affiliations, known, "raw_text").groupBy("affiliation_id").agg(F.min_by(F.struct("institution_id", "canonical_name", "institution_type"), F.struct((-F.length("surface")).alias("l"), "surface")).alias("b"))
    own = F.concat(F.lit("inst_"), F.substring(F.sha2(T.surface_key(F.col("raw_text")), 256), 1, 12))
    return affiliations.join(hits, "affiliation_id", "left").select("affiliation_id", "document_id", "raw_text", F.coalesce("b.institution_id", own).alias("institution_id"), F.coalesce("b.canonical_name", "raw_text").alias("institution_name"), F.coalesce("b.institution_type", F.lit("unknown")).alias("institution_type"))


def paper_facts(characteristics: DataFrame, funding: DataFrame) -> DataFrame:
    """One row per paper: design, year, size, funder types, and whether any is industry (null without funding)."""
    wide = characteristics.groupBy("document_id").pivot("field", ["study_design", "publication_year", "sample_size"]).agg(F.first("value"))
    money = funding.groupBy("document_id").agg(F.array_sort(F.collect_set("funder_type")).alias("funder_types"), F.bool_or(F.col("funder_type").isin(INDUSTRY)).alias("industry_funding"))
    return wide.select("document_id", "study_design", T.safe_int(F.col("publication_year")).alias("publication_year"), T.safe_int(F.col("sample_size")).alias("sample_size")).join(money, "document_id", "left")


def assess(facts: DataFrame) -> DataFrame:
    """Four criteria rows per paper: document_id, criterion, value, rationale."""
    d, y, n, i = (F.col(c) for c in ("study_design", "publication_year", "sample_size", "industry_funding"))
    kinds = F.array_join(F.coalesce("funder_types", F.array().cast("array<string>")), ", ")
    s = lambda c, v, r: F.struct(F.lit(c).alias("criterion"), v.alias("value"), r.alias("rationale"))
    strength = F.when(d.isNull() | (d == "unknown"), "unknown").when(d.isin(HIGH), "high").when(d.isin(MODERATE), "moderate").otherwise("low")
    words = literal_map({"high": " is a high-strength design.", "moderate": " is a moderate-strength design.", "low": " is a lower-strength design."})
    rows = F.array(
        s("study_design_strength", strength, F.when(strength == "unknown", "No study design could be determined.").otherwise(F.concat(d, words[strength]))),
        s("recency", F.when(y.isNull(), "unknown").when(y >= RECENT_FROM, "recent").otherwise("older"), F.when(y.isNull(), "No publication year available.").when(y >= RECENT_FROM, F.format_string("Published in %d (>= 2015).", y)).otherwise(F.format_string("Published in %d (< 2015).", y))),
        s("sample_size_adequacy", F.when(n.isNull(), "unknown").when(n >= ADEQUATE_FROM, "adequate").otherwise("small"), F.when(n.isNull(), "No sample size reported.").when(n >= ADEQUATE_FROM, F.format_string("Sample size %d (>= 100).", n)).otherwise(F.format_string("Sample size %d (< 100).", n))),
        s("funding_independence", F.when(i.isNull(), "unknown").when(i, "industry_funded").otherwise("independent"), F.when(i.isNull(), "No funding information; independence cannot be assumed.").when(i, F.concat(F.lit("Industry funding present ("), kinds, F.lit(")."))).otherwise("No industry funding among the recorded funders.")),
    )
    return facts.select("document_id", F.inline(rows)).withColumns({"framework_id": F.lit(FRAMEWORK), "framework_version": F.lit(FRAMEWORK_VERSION)})

