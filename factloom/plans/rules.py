"""Relation, modality, clause, qualifier and valence rules: fixed values as data, and the columns built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RULESET_VERSION = "0.13.0"
_I = "(?iU)"

# Relation cues in order of priority - (rule, predicate, polarity, flips under negation, pattern).
RELATION_RULES = [
    ("rel_no_association", "no_association", "negative", False, r"\bno (?:significant )?association\b|\bnot associated\b|\bno (?:significant )?correlation\b"),
    ("rel_no_effect", "no_effect", "neutral", False, r"\bno (?:significant )?effect\b|\bno (?:significant )?impact\b|\bhad no effect\b"),
    ("rel_contraindicated", "contraindicated", "positive", True, r"\bcontraindicat\w*\b"),
    ("rel_adverse_event", "associated_with_adverse_event", "positive", True, r"\badverse (?:event|effect|reaction|outcome)s?\b"),
    ("rel_reduces_risk", "reduces_risk", "positive", True, r"\b(?:reduc\w+|low\w*|decreas\w+|diminish\w+|declin\w+|lessen\w+|smaller|fewer) (?:the |a )?risk\b"),
    ("rel_increases_risk", "increases_risk", "positive", True, r"\b(?:increas\w+|rais\w+|elevat\w+|high\w*|greater|larger|more) (?:the |a )?risk\b"),
    ("rel_associated_with_reduced", "associated_with_reduced", "positive", True, r"\b(?:associat\w+ with|correlat\w+ with|linked to|related to|association between)\b.*\b(?:reduc\w*|lower\w*|low|decreas\w*|diminish\w*|declin\w*|lessen\w*|less|fewer|smaller)\b"),
    ("rel_associated_with_increased", "associated_with_increased", "positive", True, r"\b(?:associat\w+ with|correlat\w+ with|linked to|related to|association between)\b.*\b(?:increas\w*|higher|high|elevat\w*|greater|rais\w*|more|larger)\b"),
    ("rel_associated_with", "associated_with", "positive", True, r"\bassociat\w+ with\b|\bassociation between\b|\bcorrelat\w+ with\b|\blinked to\b|\brelated to\b"),
    ("rel_characterized_by", "characterized_by", "neutral", False, r"\bcharacteri[sz]\w* by\b"),
    ("rel_prevents", "prevents", "positive", True, r"\bprevent\w*\b|\bprotect\w*(?:\s+\w+){0,2}\s+against\b"),
    ("rel_causes", "causes", "positive", True, r"\bcaus\w+\b|\binduc\w+\b|\bleads? to\b|\bled to\b|\bresult\w* in\b"),
    ("rel_achieves", "achieves", "positive", True, r"\bachiev\w+\b|\battain\w+\b|\bmaintain\w+\b|\bsustain\w+\b"),
    ("rel_improves", "improves", "positive", True, r"\bimprov\w+\b|\benhanc\w+\b|\bameliorat\w+\b"),
    ("rel_worsens", "worsens", "positive", True, r"\bworsen\w+\b|\baggravat\w+\b|\bexacerbat\w+\b"),
    ("rel_has_decreased_abundance_of", "has_decreased_abundance_of", "neutral", False, r"\b(?:decreas\w+|reduc\w+|lower\w+|diminish\w+|depleti\w+|loss)\b(?:\s+\w+){0,3}?\s+(?:abundance|level|levels|proportion|number|population)s?\s+(?:of|in)\b"),
    ("rel_has_increased_abundance_of", "has_increased_abundance_of", "neutral", False, r"\b(?:increas\w+|rais\w+|elevat\w+|higher|expansi\w+|overgrow\w+|bloom)\b(?:\s+\w+){0,3}?\s+(?:abundance|level|levels|proportion|number|population)s?\s+(?:of|in)\b"),
    ("rel_increases", "increases", "positive", True, r"\bincreas\w+\b|\brais\w+\b|\belevat\w+\b"),
    ("rel_decreases", "decreases", "positive", True, r"\bdecreas\w+\b|\breduc\w+\b|\blower\w+\b"),
]

# Modality cues.
INSUFFICIENT = r"\b(?:insufficient|inadequate|no|lack of|limited|weak|inconclusive) evidence\b|\binconclusive\b"
HYPOTHETICAL = r"\bhypothesi[sz]\w*\b|\bin theory\b|\btheoretically\b|\bspeculat\w+\b"
NEGATION = r"\b(?:not|no|without|never|neither|nor|failed to|does not|do not|did not|was not|were not|is not|are not|cannot|absence of|lack of)\b"
UNCERTAINTY = r"\b(?:may|might|could|suggest\w*|indicat\w*|possibl\w*|potential\w*|appears? to|seems? to|likely|unclear|uncertain)\b"

# Clause markers and whether each reverses the assertion.
CLAUSE_MARKERS = r"\b(?:but|whereas|however|although|while)\b|;"
CONTRASTIVE = ["but", "whereas", "however", "although", "while"]

# Adjectives and nouns of disease states.
_ADJ = r"active|acute|clinical|chronic|inactive|severe|mild|moderate|quiescent"
_HEAD = r"flare-ups?|flareups?|flares?|remission|relapse|quiescence|inflammation|diseases?"
# Qualifier cues in order - (rule, type, text before the core, core, what may not follow).
QUALIFIER_RULES = [
    ("qual_disease_state_context", "disease_state", r"\b(?:during|in|under)\s+(?:the\s+|a\s+|an\s+|patients?\s+with\s+|periods?\s+of\s+|phases?\s+of\s+|states?\s+of\s+)?", rf"(?:(?:{_ADJ})\s+)?(?:{_HEAD})", ""),
    ("qual_disease_state_adjective", "disease_state", r"\b", r"quiescent", ""),
    ("qual_population", "population", r"\b(?:in|among|for)\s+", r"children|infants|adults|adolescents|neonates|elderly", ""),
    ("qual_dose", "dose", r"\b", r"high[- ]dose|low[- ]dose|standard[- ]dose|(?:≥\s*|>\s*)?\d+(?:\.\d+)?\s*(?:mg|g|mcg|iu|units?)(?:\s*/\s*(?:day|kg|d))?", ""),
    ("qual_duration", "duration", r"\b", r"for\s+\d+\s+(?:days?|weeks?|months?|years?)|long[- ]term|short[- ]term", ""),
    ("qual_route", "route", r"\b", r"orally|oral|intravenous(?:ly)?|topical(?:ly)?|subcutaneous(?:ly)?|intramuscular(?:ly)?", ""),
    ("qual_severity", "severity", r"\b", r"mild|moderate|severe", r"(?!\s+(?:flare|flares|flare-ups?|disease|remission|relapse|inflammation|colitis))"),
]

# Entity modifiers - the gap between two neighbours, cue prepositions and site concepts.
MODIFIER_GAP = r"(?iU)^\s+(of|in|within)(?:\s+(?:the|a|an))?\s+$"
LOCALIZING, ATTRIBUTIVE, SITES = ["of", "in", "within"], ["of", "within"], ["BIOM:gut_microbiota"]

# Title keywords.
TITLE_KEYWORDS = ["nutritional", "nutrition", "dietary", "diet", "food-based", "food", "meal", "body mass index", "metabolic", "lifestyle", "plant-based", "plant", "protein", "vegetarian"]

# Verb lemmas with their predicates, and promotions under a risk object or a directed object.
VERB_PREDICATES = {
    "associate": "associated_with", "correlate": "associated_with", "link": "associated_with", "relate": "associated_with",
    "reduce": "decreases", "lower": "decreases", "decrease": "decreases", "increase": "increases", "raise": "increases", "elevate": "increases",
    "cause": "causes", "induce": "causes", "lead": "causes", "prevent": "prevents", "protect": "prevents",
    "improve": "improves", "enhance": "improves", "ameliorate": "improves", "worsen": "worsens", "aggravate": "worsens", "exacerbate": "worsens",
    "achieve": "achieves", "attain": "achieves", "maintain": "achieves", "sustain": "achieves", "characterize": "characterized_by",
}
RISK_PROMOTION = {"decreases": "reduces_risk", "increases": "increases_risk"}
DIRECTED_RISK = {"reduced": "reduces_risk", "increased": "increases_risk"}
DIRECTED_ASSOCIATION = {"reduced": "associated_with_reduced", "increased": "associated_with_increased"}
ABUNDANCE = {"decreases": "has_decreased_abundance_of", "increases": "has_increased_abundance_of"}

# Desirability of objects and predicate groups.
DESIRABLE = ["BIOM:hdl", "BIOM:albumin", "BIOM:hemoglobin", "BIOM:ferritin", "BIOM:vitamin_d_level"]
UNDESIRABLE = [
    "OUT:hospitalization", "OUT:surgery", "BIOM:crp", "BIOM:esr", "BIOM:fecal_calprotectin", "BIOM:hba1c", "BIOM:ldl", "BIOM:triglycerides",
    "BIOM:fasting_glucose", "BIOM:insulin", "BIOM:homa_ir", "BIOM:blood_pressure", "BIOM:bmi", "BIOM:tnf_alpha", "BIOM:il6", "BIOM:waist_circumference",
    "CHEM:cholesterol", "CHEM:glucose", "CHEM:tmao", "CHEM:lps",
]
CAUTION, NULL_EFFECT = ["associated_with_adverse_event", "contraindicated"], ["no_effect", "no_association"]
LOWERING = ["decreases", "reduces_risk", "prevents", "associated_with_reduced"]
RAISING = ["increases", "increases_risk", "causes", "achieves", "associated_with_increased"]
PREFIX_TYPES = {"DIS": "disease", "SYMP": "symptom", "OUT": "outcome", "BIOM": "biomarker", "CHEM": "chemical", "NUTR": "nutrient", "FOOD": "food", "INT": "intervention"}

# A longer connecting text is a long window; connecting text of separators and conjunctions alone is a list.
LONG_WINDOW = 80
LIST_LIKE = r"(?iU)^[\s,;/&()\[\]-]*(?:\b(?:and|or|as well as|versus|vs)\b[\s,;/&()\[\]-]*)*$"


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def match_relation(text: Column, rules: list[tuple] = RELATION_RULES) -> Column:
    """struct<rule_id, predicate, base_polarity, flips> of the first rule whose cue occurs, else null."""
    hit = F.lit(None).cast("struct<rule_id:string,predicate:string,base_polarity:string,flips:boolean>")
    for rule, predicate, polarity, flips, pattern in reversed(rules):
        value = F.struct(F.lit(rule).alias("rule_id"), F.lit(predicate).alias("predicate"), F.lit(polarity).alias("base_polarity"), F.lit(flips).alias("flips"))
        hit = F.when(text.rlike(_I + pattern), value).otherwise(hit)
    return hit


def verb_predicate(lemma: Column, object_is_risk: Column, direction: Column) -> Column:
    """The predicate of a verb lemma; a risk object or a directed object promotes it."""
    base = literal_map(VERB_PREDICATES)[lemma]
    association = base == "associated_with"
    risk = F.when(association, F.coalesce(literal_map(DIRECTED_RISK)[direction], base)).otherwise(F.coalesce(literal_map(RISK_PROMOTION)[base], base))
    plain = F.when(association, F.coalesce(literal_map(DIRECTED_ASSOCIATION)[direction], base)).otherwise(base)
    return F.when(object_is_risk, risk).otherwise(plain)


def _cue(region: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(region, _I + pattern, 0), F.lit(""))


def modality(region: Column, base: Column, flips: Column) -> Column:
    """struct<polarity, certainty, cue>: insufficient evidence dominates, then hypothesis, negation and hedging."""
    none, hyp, neg, hedge = (_cue(region, p) for p in (INSUFFICIENT, HYPOTHETICAL, NEGATION, UNCERTAINTY))
    neg = F.when(flips, neg)
    hedge = F.when(hyp.isNull(), hedge)
    turned = F.when(base == "positive", "negative").when(base == "negative", "positive").otherwise(base)
    told = F.struct(
        F.when(none.isNotNull(), "neutral").when(neg.isNotNull(), turned).otherwise(base).alias("polarity"),
        F.when(none.isNotNull(), "insufficient_evidence").when(hyp.isNotNull(), "hypothetical").when(hedge.isNotNull(), "possible").otherwise("asserted").alias("certainty"),
        F.coalesce(none, F.nullif(F.concat_ws("; ", hyp, neg, hedge), F.lit(""))).alias("cue"),
    )
    # most regions have no cue, which one pattern of all tells
    plain = F.struct(base.alias("polarity"), F.lit("asserted").alias("certainty"), F.lit(None).cast("string").alias("cue"))
    some = _I + "|".join(f"(?:{p})" for p in (INSUFFICIENT, HYPOTHETICAL, NEGATION, UNCERTAINTY))
    return F.when(region.rlike(some), told).otherwise(plain)


def entity_type_of(concept: Column) -> Column:
    return literal_map(PREFIX_TYPES)[F.split(concept, ":")[0]]


def desirability(concept: Column, entity_type: Column | None = None) -> Column:
    kind = entity_type_of(concept) if entity_type is None else F.coalesce(entity_type, entity_type_of(concept))
    return (
        F.when(concept.isin(DESIRABLE), "desirable").when(concept.isin(UNDESIRABLE), "undesirable")
        .when(kind.isin("disease", "symptom"), "undesirable").when(kind == "outcome", "desirable").otherwise("neutral")
    )


def clinical_direction(predicate: Column, concept: Column, entity_type: Column | None = None) -> Column:
    """beneficial, harmful, neutral or caution, for a positively asserted relation on this object."""
    want = desirability(concept, entity_type)
    raising = predicate.isin([*RAISING, "associated_with"])
    return (
        F.when(predicate.isin(CAUTION), "caution").when(predicate.isin(NULL_EFFECT), "neutral")
        .when(predicate == "improves", "beneficial").when(predicate == "worsens", "harmful")
        .when((predicate.isin(LOWERING) & (want == "undesirable")) | (raising & (want == "desirable")), "beneficial")
        .when((predicate.isin(LOWERING) & (want == "desirable")) | (raising & (want == "undesirable")), "harmful")
        .otherwise("neutral")
    )


def mechanism(subject_text: Column, object_text: Column, distance: Column, between: Column) -> Column:
    """Why a relation joins a concept with itself."""
    return (
        F.when(F.lower(F.trim(subject_text)) != F.lower(F.trim(object_text)), "sub_phrase")
        .when(between.rlike(LIST_LIKE), "list_like").when(distance > LONG_WINDOW, "long_window").otherwise("topic_repeat")
    )
