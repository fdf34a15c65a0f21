"""Declared schemas of the stored tables, and the columns by which their rows are replaced."""

from __future__ import annotations

EVIDENCE = "array<struct<start_char:int,sentence_id:string,rule_id:string,end_char:int>>"
SPANS = "array<struct<start_char:int,end_char:int>>"

#: By table: the key of a replacement, then the columns.  Rows of one key are written again as a whole.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "extraction_runs": (("run_id",), "run_id string, timestamp string, tool_version string, source_version string, ruleset_version string, lexicon_digest string, documents bigint"),
    "documents": (("document_id",), "document_id string, pmid string, pmcid string, doi string, title string, journal string, publication_date string, authors array<string>, publication_types array<string>, source_type string"),
    "document_versions": (("document_id",), "version_id string, document_id string, run_id string, text_sha256 string, n_chars int"),
    "sections": (("document_id",), "section_id string, document_id string, section_index int, title string, start_char int, end_char int, text string"),
    "paragraphs": (("document_id",), "paragraph_id string, section_id string, document_id string, section_title string, section_index int, start_char int, end_char int, text string, raw_text string"),
    "sentences": (("document_id",), "sentence_id string, paragraph_id string, section_id string, document_id string, start_char int, end_char int, text string"),
    "entities": (("concept_id",), "concept_id string, canonical_name string, entity_type string"),
    "entity_mentions": (("document_id",), "mention_id string, document_id string, sentence_id string, concept_id string, canonical_name string, surface_text string, normalized_text string, entity_type string, start_char int, end_char int, source string, status string"),
    "entity_modifiers": (("document_id",), "document_id string, sentence_id string, owner_id string, relation string, preposition string, value_concept_id string, value_text string, value_type string, status string"),
    "extraction_rules": (("rule_id",), "rule_id string, rule_version string, kind string, pattern string, predicate string"),
    "observations": (("document_id",), "observation_id string, document_id string, sentence_id string, clause_id string, subject_mention_id string, subject_text string, subject_concept_id string, subject_start_char int, subject_end_char int, object_mention_id string, object_text string, object_concept_id string, object_start_char int, object_end_char int, predicate string, rule_id string, rule_version string, polarity string, certainty string, context string, parent_observation_id string, evidence_start int, evidence_end int, qualifier_sig string, subject_sig string, object_sig string"),
    "observation_qualifiers": (("document_id",), f"document_id string, observation_id string, qualifier_type string, value string, value_concept_id string, value_text string, rule_id string, spans {SPANS}"),
    "claims": (("document_id",), f"claim_id string, document_id string, subject_concept_id string, predicate string, object_concept_id string, polarity string, certainty string, qualifier_sig string, subject_sig string, object_sig string, subject_name string, object_name string, context string, observation_ids array<string>, evidence {EVIDENCE}, parent_claim_id string"),
    "claim_evidence": (("document_id",), "claim_id string, document_id string, start_char int, end_char int, sentence_id string, rule_id string, quoted_text string"),
    "claim_qualifiers": (("document_id",), f"document_id string, claim_id string, qualifier_type string, value string, value_concept_id string, value_text string, spans {SPANS}"),
    "claim_modifiers": (("document_id",), "document_id string, claim_id string, endpoint string, relation string, value_concept_id string, value_text string"),
    "open_observations": (("document_id",), "open_observation_id string, document_id string, sentence_id string, start_char int, end_char int, text string, label string, score double"),
    "study_characteristics": (("document_id",), "document_id string, field string, value string, classification_source string"),
    "funders": (("funder_id",), "funder_id string, canonical_name string, funder_type string"),
    "funding_relationships": (("document_id",), "document_id string, funder string, funder_id string, funder_type string, source string"),
    "institutions": (("institution_id",), "institution_id string, institution_name string, institution_type string"),
    "authors": (("document_id",), "author_id string, document_id string, position int, name string"),
    "affiliations": (("document_id",), "affiliation_id string, document_id string, raw_text string, institution_id string"),
    "author_affiliations": (("document_id",), "document_id string, author_id string, affiliation_id string"),
    "assessment_frameworks": (("framework_id", "framework_version"), "framework_id string, framework_version string"),
    "assessment_criteria": (("framework_id", "framework_version"), "framework_id string, framework_version string, criterion string"),
    "assessments": (("document_id", "framework_id", "framework_version"), "document_id string, framework_id string, framework_version string, criterion string, value string, rationale string"),
}
