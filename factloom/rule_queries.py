"""Built-in rules, readers and scores laid on all rows of a table.

The synthetic tables hold no papers, so each row of ``part`` (or ``lineitem``) is written out as a sentence, a title, a study or a paper's XML by one of a few templates, its own brand and size among the words.  What
each template has to give is stated by hand below it and joined to the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import analysis, documents, facts, mentions, query
from .plans import rules as R
from .plans.extract import extract, one_sentence_papers
from .sources import vocabulary, xml
from .sources.staging import staged

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def filled(text: str | None) -> Column:
    """A template with a row's brand ({b}) and size ({n})."""
    return F.lit(None).cast("string") if text is None else F.replace(F.replace(F.lit(text), F.lit("{b}"), F.col("p_brand")), F.lit("{n}"), F.col("p_size").cast("string"))


def laid(spark: SparkSession, sf_dir: str, texts: list) -> DataFrame:
    """(id, k, p_brand, p_size, text): the row's template is told by its size."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_size")
    k = (F.col("p_size") % len(texts)).cast("int")
    return part.select(F.concat(F.lit("pmid_"), "p_partkey").alias("id"), k.alias("k"), "p_brand", "p_size", F.element_at(F.array(*map(filled, texts)), k + 1).alias("text"))


def sql_lit(x) -> str:
    return "NULL" if x is None else str(x).upper() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"


def expected(templates: int, columns: str, *rows: tuple) -> str:
    """``e``: by hand-made rows (template, values ...) the rows that each row of ``part`` has to give, with ``id``."""
    names = columns.split()
    values = ", ".join("(" + ", ".join(map(sql_lit, r)) + ")" for r in rows)
    fill = lambda c, j: f"replace(replace({c}, '{{b}}', p_brand), '{{n}}', p_size::VARCHAR) AS {c}" if any(isinstance(r[j + 1], str) for r in rows) else c
    return f"e AS (SELECT 'pmid_' || p_partkey AS id, {', '.join(fill(c, j) for j, c in enumerate(names))}, length(p_brand) AS len FROM part JOIN (VALUES {values}) AS t(k, {', '.join(names)}) ON p_size % {templates} = k)"


# --- text rules -----------------------------------------------------------------------

SENTENCES = ["{b} rose 2.5 fold (n = {n}). Dr. Smith agreed.", 'Levels of {b}, e.g. iron, rose. "Good" they said.', "See Fig. 2 for {b}. Next"]


@register("WITH " + expected(3, "text", (0, "{b} rose 2.5 fold (n = {n})."), (0, "Dr. Smith agreed."), (1, "Levels of {b}, e.g. iron, rose."), (1, '"Good" they said.'), (2, "See Fig. 2 for {b}."), (2, "Next")) + " SELECT id AS document_id, text FROM e")
def rule_sentences(spark, sf_dir):
    """Sentence boundaries with abbreviations, decimals and quotes."""
    rows = laid(spark, sf_dir, SENTENCES).select(F.col("id").alias("document_id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("sentence"))
    return documents.sentences(documents.canonical_paragraphs(one_sentence_papers(rows))).select("document_id", "text")


SURFACES = ["Both Dietary fiber! {b} fibers éfiber", "gut microbiome gut; gut {b}", "{b} fiber"]


@register("WITH " + expected(3, "a after size surface_text", (0, 5, 0, 13, "Dietary fiber"), (1, 0, 0, 18, "gut microbiome gut"), (1, 20, 0, 3, "gut"), (2, 1, 1, 5, "fiber")) + """
SELECT id AS document_id, (a + after * len)::INTEGER AS start_char, (a + after * len + size)::INTEGER AS end_char, surface_text FROM e""")  # fmt: skip
def longest_match(spark, sf_dir):
    """Longest surfaces first, bounded by non-word characters, not overlapping."""
    p = laid(spark, sf_dir, SURFACES).select(F.col("id").alias("document_id"), F.col("id").alias("paragraph_id"), F.lit(0).alias("start_char"), "text")
    return mentions.dictionary_spans(p, ["fiber", "dietary fiber", "gut", "gut microbiome", "gut microbiome gut"]).drop("paragraph_id")


TITLES = ["Dietary fiber and {b}", "Diets of {b}", "Proteins in {b}", "A study of {b}", "Plant-based {b}", "Implant surgery {b}", None, "BODY MASS INDEX {b}"]


@register("WITH " + expected(8, "on_topic", (0, True), (1, True), (2, True), (3, False), (4, True), (5, False), (6, False), (7, True)) + " SELECT id, on_topic FROM e")
def title_keywords(spark, sf_dir):
    """The built-in title keywords, in the singular and plural."""
    return query.on_topic(laid(spark, sf_dir, TITLES).withColumnRenamed("text", "title")).select("id", "on_topic")


QUALIFIED = ["{b} during remission reduces pain.", "High-dose {b} in children for {n} weeks caused mild nausea.", "{b} was harmful in severe flare and in quiescent disease", "{b} oral {n} mg/day, taken orally, under clinical flare"]


@register("WITH " + expected(
    4, "qualifier_type value_concept_id value_text", (0, "disease_state", "DS:remission", "remission"), (1, "dose", None, "High-dose"), (1, "population", None, "children"), (1, "duration", None, "for {n} weeks"), (1, "severity", None, "mild"),
    (2, "disease_state", None, "severe flare"), (2, "disease_state", "DS:remission", "quiescent disease"), (3, "route", None, "oral"), (3, "route", None, "orally"), (3, "dose", None, "{n} mg/day"), (3, "disease_state", "DS:flare", "clinical flare"),
) + " SELECT id AS clause_id, qualifier_type, value_concept_id, value_text FROM e")
def qualifiers(spark, sf_dir):
    """Conditions of every kind, with disease states resolved where they are known."""
    rows = laid(spark, sf_dir, QUALIFIED).select(F.col("id").alias("clause_id"), "text", F.lit(0).alias("start_char"))
    return mentions.qualifiers(rows, "clause_id", mentions.surface_index(vocabulary.disease_states(spark))).select("clause_id", "qualifier_type", "value_concept_id", "value_text")


MODIFIED = ["dysbiosis of the gut microbiome {b}", "pain within a colon {b}", "iron in fish {b}"]
#: By template the two mentions: start, end, concept.
ENDS = [((0, 9, "DIS:dysbiosis"), (17, 31, "BIOM:gut_microbiota")), ((0, 4, "SYMP:pain"), (14, 19, None)), ((0, 4, "NUTR:iron"), (8, 12, "FOOD:fish"))]


@register("WITH " + expected(3, "relation preposition value_concept_id", (0, "localized_in", "of", "BIOM:gut_microbiota"), (1, "qualified_by", "within", None)) + " SELECT id || '_0' AS owner_id, relation, preposition, value_concept_id FROM e")
def modifier_floor(spark, sf_dir):
    """``head of the object`` between neighbouring mentions, typed by the object."""
    rows = laid(spark, sf_dir, MODIFIED)
    end = lambda e, j: F.struct(F.lit(j).alias("j"), F.lit(e[0]).alias("start_char"), F.lit(e[1]).alias("end_char"), F.lit(e[2]).cast("string").alias("concept_id"))
    both = F.element_at(F.array(*(F.array(*(end(e, j) for j, e in enumerate(two))) for two in ENDS)), F.col("k") + 1)
    found = rows.select(F.col("id").alias("document_id"), F.col("id").alias("sentence_id"), F.explode(both).alias("m"))
    found = found.select("document_id", "sentence_id", F.concat_ws("_", "document_id", "m.j").alias("mention_id"), "m.start_char", "m.end_char", "m.concept_id", F.lit("x").alias("surface_text"), F.lit("t").alias("entity_type"))
    texts = rows.select(F.col("id").alias("document_id"), F.col("text").alias("canonical_text"))
    return mentions.modifiers(found, texts).select("owner_id", "relation", "preposition", "value_concept_id")


#: Connecting texts with the rule that each has to find.
CUES = [
    ("was associated with", "rel_associated_with"), ("had no association with", "rel_no_association"), ("is not associated with", "rel_no_association"), ("had no effect on", "rel_no_effect"), ("is contraindicated in", "rel_contraindicated"),
    ("showed adverse events of", "rel_adverse_event"), ("reduced the risk of", "rel_reduces_risk"), ("higher risk of", "rel_increases_risk"), ("was linked to lower levels of", "rel_associated_with_reduced"),
    ("correlated with increased", "rel_associated_with_increased"), ("characterised by", "rel_characterized_by"), ("protective factors against", "rel_prevents"), ("induces", "rel_causes"), ("maintained", "rel_achieves"), ("improved", "rel_improves"),
    ("worsened", "rel_worsens"), ("decreased the relative abundance of", "rel_has_decreased_abundance_of"), ("bloom in numbers of", "rel_has_increased_abundance_of"), ("raised", "rel_increases"), ("lowered", "rel_decreases"), ("and", None),
]


@register("WITH " + expected(len(CUES), "rule_id", *((k, r) for k, (_, r) in enumerate(CUES))) + " SELECT id, rule_id FROM e")
def relation_match(spark, sf_dir):
    """The first of the built-in relation rules whose cue stands in a text."""
    return laid(spark, sf_dir, [f"{{b}} {c} {{n}}" for c, _ in CUES]).select("id", R.match_relation(F.col("text"))["rule_id"].alias("rule_id"))


REGIONS = ["{b} improved", "may reduce {b}", "did not improve {b}", "it is hypothesized that {b}", "insufficient evidence that {b}", "possibly without {b}", "cannot prevent {b}", "it was hypothesized that {b} may"]


@register("WITH " + expected(
    8, "none hyp neg hedge certainty", (0, None, None, None, None, "asserted"), (1, None, None, None, "may", "possible"), (2, None, None, "did not", None, "asserted"), (3, None, "hypothesized", None, None, "hypothetical"),
    (4, "insufficient evidence", None, None, None, "insufficient_evidence"), (5, None, None, "without", "possibly", "possible"), (6, None, None, "cannot", None, "asserted"), (7, None, "hypothesized", None, None, "hypothetical"),
) + """, b AS (SELECT * FROM (VALUES ('positive', true), ('negative', true), ('neutral', false)) AS t(base, flips)), f AS (SELECT *, CASE WHEN flips THEN neg END AS turned FROM e, b)
SELECT id, base, CASE WHEN none IS NOT NULL THEN 'neutral' WHEN turned IS NULL THEN base WHEN base = 'positive' THEN 'negative' ELSE 'positive' END AS polarity, certainty, coalesce(none, nullif(concat_ws('; ', hyp, turned, hedge), '')) AS note FROM f""")  # fmt: skip
def modality(spark, sf_dir):
    """Polarity, certainty and cue of a region, for rules of each base polarity."""
    bases = F.explode(F.array(*(F.struct(F.lit(b).alias("base"), F.lit(f).alias("flips")) for b, f in (("positive", True), ("negative", True), ("neutral", False)))))
    rows = laid(spark, sf_dir, REGIONS).select("id", "text", bases.alias("b")).select("id", "text", "b.*")
    return rows.withColumn("m", R.modality(F.col("text"), F.col("base"), F.col("flips"))).select("id", "base", "m.polarity", "m.certainty", F.col("m.cue").alias("note"))


LEMMAS = ["reduce", "increase", "associate", "link", "cause", "characterize", "walk"]


@register("""WITH v AS (SELECT p_partkey, ['reduce', 'increase', 'associate', 'link', 'cause', 'characterize', 'walk'][p_size % 7 + 1] AS lemma, p_partkey % 2 = 0 AS risk, CASE p_partkey % 3 WHEN 0 THEN 'reduced' WHEN 1 THEN 'increased' END AS way FROM part),
b AS (SELECT *, CASE lemma WHEN 'reduce' THEN 'decreases' WHEN 'increase' THEN 'increases' WHEN 'cause' THEN 'causes' WHEN 'characterize' THEN 'characterized_by' WHEN 'walk' THEN NULL ELSE 'associated_with' END AS base FROM v)
SELECT p_partkey, lemma, CASE WHEN base = 'associated_with' AND way = 'reduced' THEN CASE WHEN risk THEN 'reduces_risk' ELSE 'associated_with_reduced' END WHEN base = 'associated_with' AND way = 'increased' THEN CASE WHEN risk THEN 'increases_risk' ELSE 'associated_with_increased' END
WHEN risk AND base = 'decreases' THEN 'reduces_risk' WHEN risk AND base = 'increases' THEN 'increases_risk' ELSE base END AS predicate FROM b""")
def verb_predicates(spark, sf_dir):
    """Predicates of verbs, promoted by a risk object or a word of direction."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.element_at(F.array(*map(F.lit, LEMMAS)), (F.col("p_size") % 7 + 1).cast("int")).alias("lemma"))
    way = F.when(F.col("p_partkey") % 3 == 0, "reduced").when(F.col("p_partkey") % 3 == 1, "increased")
    return part.withColumn("predicate", R.verb_predicate(F.col("lemma"), F.col("p_partkey") % 2 == 0, way))


OBJECTS = ["DIS:cancer", "SYMP:pain", "OUT:remission", "OUT:surgery", "BIOM:hdl", "BIOM:crp", "CHEM:glucose", "FOOD:fish", "BIOM:gut_microbiota"]
PREDICATES = [
    "achieves", "associated_with", "associated_with_adverse_event", "associated_with_increased", "associated_with_reduced", "causes", "characterized_by", "contraindicated", "decreases", "has_decreased_abundance_of", "has_increased_abundance_of",
    "improves", "increases", "increases_risk", "no_association", "no_effect", "prevents", "reduces_risk", "worsens",
]


@register(f"""WITH c AS (SELECT DISTINCT {PREDICATES}[l_partkey % {len(PREDICATES)} + 1] AS predicate, {OBJECTS}[l_orderkey % {len(OBJECTS)} + 1] AS object FROM lineitem),
d AS (SELECT *, CASE WHEN object = 'BIOM:hdl' THEN 1 WHEN object IN ('OUT:surgery', 'BIOM:crp', 'CHEM:glucose') THEN -1 WHEN split_part(object, ':', 1) IN ('DIS', 'SYMP') THEN -1 WHEN split_part(object, ':', 1) = 'OUT' THEN 1 ELSE 0 END AS want,
CASE WHEN predicate IN ('decreases', 'reduces_risk', 'prevents', 'associated_with_reduced') THEN -1 WHEN predicate IN ('increases', 'increases_risk', 'causes', 'achieves', 'associated_with_increased', 'associated_with') THEN 1 ELSE 0 END AS move FROM c)
SELECT predicate, object, CASE WHEN predicate IN ('associated_with_adverse_event', 'contraindicated') THEN 'caution' WHEN predicate = 'improves' THEN 'beneficial' WHEN predicate = 'worsens' THEN 'harmful' WHEN want * move > 0 THEN 'beneficial' WHEN want * move < 0 THEN 'harmful' ELSE 'neutral' END AS direction FROM d""")
def clinical_direction(spark, sf_dir):
    """Whether a relation on an object is good or bad, for every pair that the rows of ``lineitem`` make."""
    pick = lambda values, c: F.element_at(F.array(*map(F.lit, values)), (F.col(c) % len(values) + 1).cast("int"))
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(pick(PREDICATES, "l_partkey").alias("predicate"), pick(OBJECTS, "l_orderkey").alias("object")).distinct()
    return rows.withColumn("direction", R.clinical_direction(F.col("predicate"), F.col("object")))


PAPERS = [
    "Dietary fiber was associated with remission.", "Dietary fiber did not improve remission.", "Dietary fiber improves remission during remission but may aggravate abdominal pain during active flare.", "Dietary fiber during remission reduces abdominal pain.",
    "There is insufficient evidence that curcumin improves bloating.", "Dysbiosis of the gut microbiome causes bloating; bloating causes fatigue.", "Fiber and iron.", "It is hypothesized that fibre prevents colorectal cancer.",
]


@register("WITH " + expected(
    8, "subject_concept_id predicate object_concept_id polarity certainty qualifier_sig",
    (0, "NUTR:dietary_fiber", "associated_with", "OUT:remission", "positive", "asserted", ""), (1, "NUTR:dietary_fiber", "improves", "OUT:remission", "negative", "asserted", ""),
    (2, "NUTR:dietary_fiber", "improves", "OUT:remission", "positive", "asserted", "disease_state=DS:remission"), (2, "NUTR:dietary_fiber", "worsens", "SYMP:abdominal_pain", "positive", "possible", "disease_state=DS:active_disease"),
    (3, "NUTR:dietary_fiber", "decreases", "SYMP:abdominal_pain", "positive", "asserted", "disease_state=DS:remission"), (4, "CHEM:curcumin", "improves", "SYMP:bloating", "neutral", "insufficient_evidence", ""),
    (5, "BIOM:gut_microbiota", "causes", "SYMP:bloating", "positive", "asserted", ""), (5, "SYMP:bloating", "causes", "SYMP:fatigue", "positive", "asserted", ""), (7, "NUTR:dietary_fiber", "prevents", "DIS:colorectal_cancer", "positive", "hypothetical", ""),
) + " SELECT id AS document_id, subject_concept_id, predicate, object_concept_id, polarity, certainty, qualifier_sig FROM e")
def flat_observations(spark, sf_dir):
    """The whole extraction plan with the built-in lexicon and rules over a paper for each row."""
    rows = laid(spark, sf_dir, PAPERS).select(F.col("id").alias("document_id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("sentence"))
    obs = extract(one_sentence_papers(rows), keep=lambda name, part: part if name in ("sections", "observations", "claims") else staged(part, name))["observations"]
    return obs.select("document_id", "subject_concept_id", "predicate", "object_concept_id", "polarity", "certainty", "qualifier_sig")


# --- facts ----------------------------------------------------------------------------

TYPES = [["Review", "Randomized Controlled Trial"], ["Clinical Trial", "Comparative Study"], ["Journal Article"], [" letter ", "Meta-Analysis"]]


@register("WITH " + expected(4, "value publication_type", (0, "randomized_controlled_trial", "Randomized Controlled Trial"), (1, "controlled_trial", "Clinical Trial"), (3, "meta_analysis", "Meta-Analysis")) + " SELECT id AS document_id, value, publication_type FROM e")
def study_design_rank(spark, sf_dir):
    """The strongest design among a paper's publication types."""
    kinds = F.element_at(F.array(*(F.array(*map(F.lit, t)) for t in TYPES)), F.col("k") + 1)
    return facts.design_of_types(laid(spark, sf_dir, [None] * 4).select(F.col("id").alias("document_id"), F.posexplode(kinds).alias("pos", "publication_type")))


STUDIES = ["We enrolled 1,250 patients with follow-up of two years in Germany.", "A prospective cohort of 99 people and 340 women; followed up for {n} months.", "In vitro work on {b}, n = 12, in the netherlands.", "Nothing."]


@register("WITH " + expected(
    4, "field value", (0, "study_design", "randomized_controlled_trial"), (0, "publication_year", "2016"), (0, "sample_size", "1250"), (0, "follow_up", "two years"), (0, "country", "Germany"),
    (1, "study_design", "cohort"), (1, "publication_year", "2016"), (1, "sample_size", "340"), (1, "follow_up", "{n} months"), (1, "country", "Japan"), (2, "study_design", "in_vitro"), (2, "publication_year", "2016"), (2, "sample_size", "12"),
    (2, "country", "Netherlands"), (3, "study_design", "unknown"), (3, "publication_year", "2016"),
) + " SELECT id AS document_id, field, value FROM e")
def study_text_facts(spark, sf_dir):
    """Design, year, sample size, follow-up and country of a paper's text, types and affiliations."""
    rows = laid(spark, sf_dir, STUDIES).withColumnRenamed("id", "document_id")
    papers = rows.select("document_id", "text", F.lit("2016-03").alias("publication_date"))
    types = rows.filter("k = 0").select("document_id", F.lit(0).alias("pos"), F.lit("Randomized Controlled Trial").alias("publication_type"))
    places = rows.filter("k = 1").select("document_id", F.lit("University of Tokyo, Japan").alias("text"))
    return facts.study_characteristics(papers, types, vocabulary.countries(spark), places).select("document_id", "field", "value")


#: By template: funder, text, source.
STATEMENTS = [
    [("NIH", "NIH grant", "pmc_award_group"), (None, "Paid by Pfizer and Pfizer Inc.", "coi_statement")], [("Acme Trust", "x", "pmc_award_group"), (None, "Thanks to the NSF and the MRC (not nihr2).", "acknowledgements")],
]


@register("WITH " + expected(
    2, "funder funder_id funder_type source", (0, "National Institutes of Health", "FUND:nih", "government", "pmc_award_group"), (0, "Pfizer", "FUND:pfizer", "pharmaceutical", "coi_statement"), (1, "Acme Trust", None, "unknown", "pmc_award_group"),
    (1, "National Science Foundation", "FUND:nsf", "government", "acknowledgements"), (1, "Medical Research Council", "FUND:mrc", "government", "acknowledgements"),
) + " SELECT id AS document_id, funder, funder_id, funder_type, source FROM e")
def funding_lookup(spark, sf_dir):
    """Funders named as such, and all that free text names."""
    one = lambda s: F.struct(*(F.lit(v).cast("string").alias(c) for c, v in zip(("funder", "text", "source"), s)))
    said = F.element_at(F.array(*(F.array(*map(one, two)) for two in STATEMENTS)), F.col("k") + 1)
    rows = laid(spark, sf_dir, [None] * 2).select(F.col("id").alias("document_id"), F.explode(said).alias("s")).select("document_id", "s.*")
    return facts.funding_relationships(rows, vocabulary.funders(spark)).select("document_id", "funder", "funder_id", "funder_type", "source")


@register("""WITH g AS (SELECT l_linenumber % 3 AS r, l_quantity::INTEGER % 2 = 0 AS in_vocab FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1)),
n AS (SELECT count(*) FILTER (r = 1) AS c, count(*) FILTER (r = 2) AS f, count(*) FILTER (r = 0) AS m, count(*) FILTER (r = 1 AND in_vocab) AS ac, count(*) FILTER (in_vocab) AS a FROM g), s AS (SELECT count(DISTINCT l_orderkey) AS s FROM lineitem)
SELECT c AS correct, f AS field_error, m AS missed, s AS spurious, c / (c + f + s) AS precision_strict, (c + f) / (c + f + m) AS recall_lenient, ac / a AS recall_achievable_strict FROM n, s""")
def gold_score(spark, sf_dir):
    """Expected observations, one for each line of an order, against produced ones: of every three lines one is right, one has another polarity and one is missing, and each order has one too many."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    first = F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")).alias("x")
    li = li.groupBy("l_orderkey", "l_linenumber").agg(first).select("l_orderkey", "l_linenumber", "x.l_quantity")
    fields = [
        F.col("l_orderkey").cast("string").alias("sentence_id"), F.col("l_linenumber").cast("int").alias("k"), F.concat(F.lit("subject "), "l_linenumber").alias("subject_text"), F.concat(F.lit("S:"), "l_linenumber").alias("subject_concept_id"),
        F.concat(F.lit("object "), "l_linenumber").alias("object_text"), F.concat(F.lit("O:"), "l_linenumber").alias("object_concept_id"), F.lit("improves").alias("predicate"),
    ]
    gold = li.select(*fields, F.lit("positive").alias("polarity"), F.lit("asserted").alias("certainty"), (F.col("l_quantity").cast("int") % 2 == 0).alias("in_vocab"), F.lit(None).cast("string").alias("failure_mode"))
    made = li.filter("l_linenumber % 3 <> 0").select(*fields, F.when(F.col("l_linenumber") % 3 == 1, "positive").otherwise("negative").alias("polarity"), F.lit("asserted").alias("certainty"))
    extra = li.select(F.col("l_orderkey").cast("string").alias("sentence_id")).distinct().select("sentence_id", F.lit(99).alias("k"), F.lit("nothing").alias("subject_text"), F.lit("S:none").alias("subject_concept_id"), F.lit("else").alias("object_text"), F.lit("O:none").alias("object_concept_id"), F.lit("causes").alias("predicate"), F.lit("positive").alias("polarity"), F.lit("asserted").alias("certainty"))
    return analysis.gold_scores(analysis.gold_alignment(gold, made.unionByName(extra))).select("correct", "field_error", "missed", "spurious", "precision_strict", "recall_lenient", "recall_achievable_strict")


@register("""WITH b AS (SELECT DISTINCT 'A:' || replace(p_brand, '#', '_') AS id, p_brand AS name FROM part), c AS (SELECT id, name || ' two' AS name FROM b WHERE id LIKE '%3' UNION ALL SELECT id || '_new', name || ' new' FROM b WHERE id LIKE '%1')
SELECT coalesce(c.id, b.id) AS concept_id, coalesce(c.name, b.name) AS canonical_name, CASE WHEN c.id IS NULL THEN 'builtin' WHEN b.id IS NULL THEN 'custom' ELSE 'overridden' END AS origin FROM b FULL JOIN c USING (id) WHERE coalesce(c.id, b.id) NOT LIKE '%5'""")
def vocab_overlay(spark, sf_dir):
    """A lexicon of all brands with an overlay that replaces some, adds some and hides some."""
    brands = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand").distinct()
    cid = F.concat(F.lit("A:"), F.replace("p_brand", F.lit("#"), F.lit("_")))
    made = lambda rows, i, name: rows.select(F.substring("p_brand", 7, 9).cast("int").alias("pos"), i.alias("concept_id"), name.alias("canonical_name"), F.lit("t").alias("entity_type"), F.array("p_brand").alias("surface_forms"))
    name = F.col("p_brand")
    custom = made(brands.filter("p_brand like '%3'"), cid, F.concat(name, F.lit(" two"))).unionByName(made(brands.filter("p_brand like '%1'"), F.concat(cid, F.lit("_new")), F.concat(name, F.lit(" new"))))
    removed = brands.filter("p_brand like '%5'").select(cid.alias("concept_id"))
    return vocabulary.with_overlay(made(brands, cid, name), custom, removed).select("concept_id", "canonical_name", "origin")


# --- markup ---------------------------------------------------------------------------

RECORD = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>{n}</PMID><Article><Journal><Title>Gut</Title><JournalIssue><PubDate><Year>2010</Year><Month>Mar</Month><Day>5</Day></PubDate></JournalIssue></Journal>
<ArticleTitle>Dietary <i>{b}</i> and remission</ArticleTitle><Abstract><AbstractText Label="BACKGROUND">{b} helps.</AbstractText><AbstractText Label="RESULTS">It was  associated with <b>{n}</b>.</AbstractText></Abstract>
<AuthorList><Author><LastName>Doe</LastName><ForeName>{b}</ForeName><AffiliationInfo><Affiliation>Harvard {n}</Affiliation></AffiliationInfo></Author><Author><CollectiveName>The Group</CollectiveName></Author></AuthorList>
<PublicationTypeList><PublicationType>Review</PublicationType></PublicationTypeList></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/{n}</ArticleId><ArticleId IdType="pmc">{n}</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""
ARTICLE = """<article><front><funding-group><award-group><funding-source>{b}</funding-source></award-group><funding-statement>Paid by {b}.</funding-statement></funding-group></front><body><p>Loose {n}.</p><sec><title>Methods</title><p>We did <b>{b}</b>.</p><sec><title>Statistics</title><p>Tests.</p></sec></sec><p>End.</p></body>
<back><ack>Thanks.</ack><fn fn-type="COI-statement"><p>None {n}.</p></fn></back></article>"""


def papers(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A paper's XML for every row; every second size's is broken off and gives nothing."""
    rows = laid(spark, sf_dir, [text, text[:200]])
    return rows.select(F.col("id").alias("document_id"), F.col("text").cast("binary").alias("content"))


@register("WITH " + expected(2, "pmid pmcid doi title authors", (0, "{n}", "PMC{n}", "10.1/{n}", "Dietary {b} and remission", "Doe {b}|The Group")) + " SELECT id AS document_id, pmid, pmcid, doi, title, 'Gut' AS journal, '2010-03-05' AS publication_date, authors, 'Review' AS types FROM e")
def pubmed_xml(spark, sf_dir):
    """Bibliographic records."""
    r = xml.pubmed_records(papers(spark, sf_dir, RECORD))
    return r.select("document_id", "pmid", "pmcid", "doi", "title", "journal", "publication_date", F.array_join("authors", "|").alias("authors"), F.array_join("publication_types", "|").alias("types"))


@register("WITH " + expected(2, "section_idx section_title raw_text", (0, 0, None, "Loose {n}."), (0, 1, "Methods", "We did {b}."), (0, 2, "Statistics", "Tests."), (0, 3, None, "End.")) + " SELECT id AS document_id, section_idx, section_title, raw_text FROM e")
def jats_xml(spark, sf_dir):
    """Body sections, nested and loose."""
    return xml.jats_sections(papers(spark, sf_dir, ARTICLE)).select("document_id", "section_idx", "section_title", "raw_text")


@register("WITH " + expected(2, "pos funder text source", (0, 0, "{b}", "{b}", "pmc_award_group"), (0, 1, None, "Paid by {b}.", "pmc_funding_statement"), (0, 2, None, "Thanks.", "acknowledgements"), (0, 3, None, "None {n}.", "coi_statement")) + " SELECT id AS document_id, pos, funder, text, source FROM e")
def jats_statements(spark, sf_dir):
    """Funding, conflict and acknowledgement statements."""
    return xml.statements(papers(spark, sf_dir, ARTICLE)).select("document_id", "pos", "funder", "text", "source")


@register("WITH " + expected(2, "section_idx section_title raw_text", (0, 0, "Background", "{b} helps."), (0, 1, "Results", "It was associated with {n}.")) + " SELECT id AS document_id, section_idx, section_title, raw_text FROM e")
def abstract_xml(spark, sf_dir):
    """Labelled abstract sections."""
    return xml.abstract_sections(papers(spark, sf_dir, RECORD)).select("document_id", "section_idx", "section_title", "raw_text")


@register("WITH " + expected(2, "who name place raw_text", (0, "_au000", "Doe {b}", "_aff000", "Harvard {n}"), (0, "_au001", "The Group", None, None)) + " SELECT id || who AS author_id, name, id || place AS affiliation_id, raw_text FROM e")
def authors_xml(spark, sf_dir):
    """Authors with their affiliations."""
    return xml.author_affiliations(papers(spark, sf_dir, RECORD)).select("author_id", "name", "affiliation_id", "raw_text")
