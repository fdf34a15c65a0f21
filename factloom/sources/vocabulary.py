"""Vocabularies: built-in lexicon, overlay, composition edges, funders, institutions, countries and disease states.

The lexicon here is a small authored one with the identifiers that rules and valences refer to; a larger one has the same columns.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .manifest import Conflict, Manifests

#: Fixed value: what a concept's id looks like.
CONCEPT_ID = r"^[A-Za-z][A-Za-z0-9]*:[A-Za-z0-9_]+$"
CONCEPT = "concept_id string, canonical_name string, entity_type string, surface_forms array<string>"
TYPES = {"NUTR": "nutrient", "OUT": "outcome", "DIS": "disease", "SYMP": "symptom", "BIOM": "biomarker", "CHEM": "chemical", "FOOD": "food", "INT": "intervention"}

# Identifiers of concepts; a name is its identifier's words unless other forms are given.
CONCEPTS = {
    "NUTR": "dietary_fiber vitamin_d calcium iron omega_3 omega_6 probiotics zinc magnesium folate vitamin_b12",
    "OUT": "remission disease_activity mucosal_healing hospitalization surgery symptoms quality_of_life bone_density",
    "DIS": "ibd ibs crohn_disease ulcerative_colitis dysbiosis cancer colorectal_cancer osteoporosis cardiovascular_disease malnutrition",
    "SYMP": "abdominal_pain bloating diarrhea fatigue nausea",
    "BIOM": "gut_microbiota crp esr hdl ldl albumin hemoglobin ferritin vitamin_d_level hba1c triglycerides fasting_glucose insulin homa_ir blood_pressure bmi tnf_alpha il6 waist_circumference fecal_calprotectin firmicutes bifidobacterium faecalibacterium_prausnitzii",
    "CHEM": "curcumin butyrate polyphenols cholesterol glucose tmao lps",
    "FOOD": "turmeric fish flaxseed walnuts kale kefir red_meat processed_meat vegetables tomato carrot capsicum spinach lettuce pumpkin stem_vegetables",
    "INT": "mediterranean_diet exclusive_enteral_nutrition high_fiber_diet",
}
FORMS = {
    "NUTR:dietary_fiber": ["fiber", "dietary fibre", "fibre"], "NUTR:omega_3": ["omega-3", "n-3 fatty acids"], "NUTR:omega_6": ["omega-6"], "NUTR:iron": ["dietary iron"],
    "DIS:ibd": ["inflammatory bowel disease"], "DIS:ibs": ["irritable bowel syndrome"], "DIS:crohn_disease": ["crohn's disease", "crohn’s disease", "crohns disease"],
    "BIOM:gut_microbiota": ["gut microbiome", "intestinal microbiota", "gut flora"], "BIOM:crp": ["c-reactive protein"], "BIOM:bmi": ["body mass index"],
    "BIOM:hdl": ["hdl cholesterol"], "BIOM:ldl": ["ldl cholesterol"], "OUT:remission": ["clinical remission"], "SYMP:abdominal_pain": ["stomach pain"],
    "CHEM:tmao": ["trimethylamine n-oxide"], "CHEM:lps": ["lipopolysaccharide"], "BIOM:il6": ["interleukin-6", "il-6"], "BIOM:tnf_alpha": ["tnf-alpha", "tnf"],
}
DISEASE_STATES = {
    "DS:remission": ("Remission", ["remission", "clinical remission", "quiescent", "quiescence", "quiescent disease", "inactive disease"]),
    "DS:active_disease": ("Active disease", ["active disease", "active diseases", "active inflammation", "clinically active", "active flare", "acute flare"]),
    "DS:flare": ("Flare", ["flare", "flares", "active flares", "flare-up", "flare-ups", "flareup", "clinical flare", "disease flare", "relapse"]),
}
FOUND_IN = {
    "CHEM:curcumin": ["FOOD:turmeric"], "NUTR:omega_3": ["FOOD:fish", "FOOD:flaxseed", "FOOD:walnuts"], "NUTR:calcium": ["FOOD:kale", "FOOD:kefir"],
    "NUTR:iron": ["FOOD:red_meat", "FOOD:spinach"], "NUTR:dietary_fiber": ["FOOD:vegetables", "FOOD:flaxseed", "FOOD:pumpkin"], "CHEM:polyphenols": ["FOOD:tomato", "FOOD:capsicum"],
    "NUTR:vitamin_d": ["FOOD:fish"], "NUTR:probiotics": ["FOOD:kefir"],
}
# Funders and countries with their forms.
FUNDERS = [
    ("FUND:nih", "National Institutes of Health", "government", ["national institutes of health", "nih", "u.s. national institutes of health"]),
    ("FUND:nihr", "National Institute for Health Research", "government", ["national institute for health research", "nihr"]),
    ("FUND:nsf", "National Science Foundation", "government", ["national science foundation", "nsf"]),
    ("FUND:mrc", "Medical Research Council", "government", ["medical research council", "mrc"]),
    ("FUND:pfizer", "Pfizer", "pharmaceutical", ["pfizer", "pfizer inc", "pfizer inc."]),
    ("FUND:nestle", "Nestlé", "food_industry", ["nestlé", "nestle"]),
]
COUNTRIES = [
    ("United States", ["united states", "usa", "u.s.a.", "u.s.", "united states of america"]), ("United Kingdom", ["united kingdom", "uk", "u.k.", "england", "scotland", "wales"]),
    *((c, [c.lower()]) for c in ("Canada", "Australia", "Germany", "France")), ("Netherlands", ["netherlands", "the netherlands"]),
    *((c, [c.lower()]) for c in ("Sweden", "Italy", "Spain", "China", "Japan", "Denmark", "Norway", "Switzerland")),
]


# Authored data: foods by group, and what each group is a source of.  An edge is made for every food and every source of its groups.
FOOD_GROUPS = {
    "leafy_greens": "kale spinach lettuce chard arugula collard_greens watercress endive",
    "brassicas": "broccoli cabbage cauliflower brussels_sprouts bok_choy radish turnip",
    "roots": "carrot beetroot sweet_potato parsnip celeriac potato",
    "fruiting_vegetables": "tomato capsicum pumpkin zucchini eggplant cucumber okra",
    "legumes": "lentils chickpeas black_beans kidney_beans soybeans peas peanuts",
    "whole_grains": "oats barley rye brown_rice quinoa buckwheat whole_wheat millet",
    "nuts_and_seeds": "walnuts almonds hazelnuts pistachios flaxseed chia_seeds sesame_seeds pumpkin_seeds sunflower_seeds",
    "berries": "blueberries strawberries raspberries blackberries cranberries",
    "orchard_fruit": "apples pears plums peaches cherries pomegranate grapes",
    "citrus": "oranges lemons grapefruit mandarins limes",
    "tropical_fruit": "bananas mango papaya pineapple kiwi avocado",
    "fermented_foods": "kefir yogurt sauerkraut kimchi miso tempeh",
    "dairy": "milk cheese butter whey",
    "oily_fish": "fish salmon mackerel sardines herring anchovies",
    "shellfish": "mussels oysters shrimp",
    "meats": "red_meat beef lamb pork liver",
    "poultry_and_eggs": "chicken turkey eggs",
    "herbs_and_spices": "turmeric ginger garlic cinnamon rosemary oregano",
    "alliums": "onions leeks shallots",
    "drinks": "green_tea black_tea coffee red_wine cocoa",
}
SOURCES_OF = {
    "leafy_greens": "NUTR:folate NUTR:iron NUTR:vitamin_k NUTR:vitamin_c NUTR:magnesium NUTR:dietary_fiber CHEM:lutein CHEM:nitrate",
    "brassicas": "NUTR:vitamin_c NUTR:vitamin_k NUTR:dietary_fiber NUTR:folate CHEM:sulforaphane CHEM:glucosinolates",
    "roots": "NUTR:dietary_fiber NUTR:potassium NUTR:vitamin_a CHEM:carotenoids",
    "fruiting_vegetables": "NUTR:vitamin_c NUTR:dietary_fiber CHEM:polyphenols CHEM:carotenoids",
    "legumes": "NUTR:dietary_fiber NUTR:protein NUTR:folate NUTR:iron NUTR:magnesium NUTR:zinc CHEM:saponins CHEM:phytosterols",
    "whole_grains": "NUTR:dietary_fiber NUTR:beta_glucan NUTR:magnesium NUTR:selenium NUTR:vitamin_b1 NUTR:vitamin_b3 CHEM:lignans CHEM:arabinoxylan",
    "nuts_and_seeds": "NUTR:omega_3 NUTR:omega_6 NUTR:vitamin_e NUTR:magnesium NUTR:zinc NUTR:protein CHEM:lignans CHEM:phytosterols",
    "berries": "CHEM:anthocyanins CHEM:polyphenols CHEM:ellagic_acid NUTR:vitamin_c NUTR:dietary_fiber",
    "orchard_fruit": "CHEM:quercetin CHEM:polyphenols NUTR:pectin NUTR:dietary_fiber",
    "citrus": "NUTR:vitamin_c NUTR:pectin CHEM:hesperidin CHEM:naringenin",
    "tropical_fruit": "NUTR:potassium NUTR:vitamin_c NUTR:dietary_fiber CHEM:carotenoids",
    "fermented_foods": "NUTR:probiotics NUTR:vitamin_b12 CHEM:lactic_acid",
    "dairy": "NUTR:calcium NUTR:protein NUTR:vitamin_b2 NUTR:vitamin_b12 NUTR:phosphorus",
    "oily_fish": "NUTR:omega_3 NUTR:vitamin_d NUTR:protein NUTR:selenium NUTR:vitamin_b12 NUTR:iodine",
    "shellfish": "NUTR:zinc NUTR:copper NUTR:selenium NUTR:vitamin_b12 NUTR:iodine",
    "meats": "NUTR:iron NUTR:protein NUTR:zinc NUTR:vitamin_b12 CHEM:carnitine CHEM:choline",
    "poultry_and_eggs": "NUTR:protein NUTR:vitamin_b6 NUTR:selenium CHEM:choline",
    "herbs_and_spices": "CHEM:polyphenols CHEM:essential_oils",
    "alliums": "NUTR:inulin CHEM:quercetin CHEM:allicin",
    "drinks": "CHEM:polyphenols CHEM:catechins CHEM:caffeine",
}
INSTITUTIONS = [
    ("INST:harvard", "Harvard University", "university", ["harvard university", "harvard medical school", "harvard t.h. chan school of public health"]),
    ("INST:oxford", "University of Oxford", "university", ["university of oxford", "oxford university"]),
    ("INST:cambridge", "University of Cambridge", "university", ["university of cambridge", "cambridge university"]),
    ("INST:tokyo", "University of Tokyo", "university", ["university of tokyo"]), ("INST:karolinska", "Karolinska Institutet", "university", ["karolinska institutet", "karolinska institute"]),
    ("INST:mayo", "Mayo Clinic", "hospital", ["mayo clinic"]), ("INST:charite", "Charité", "hospital", ["charité", "charite"]), ("INST:nih", "National Institutes of Health", "government", ["national institutes of health"]),
    ("INST:inserm", "Inserm", "research_institute", ["inserm"]), ("INST:max_planck", "Max Planck Society", "research_institute", ["max planck institute", "max planck society"]),
    ("INST:nestle_research", "Nestlé Research", "company", ["nestlé research", "nestle research"]),
]
MODIFIER_SITES = {"SITE:colon": ["colon", "colonic"], "SITE:ileum": ["ileum", "ileal"], "SITE:liver": ["hepatic"], "SITE:mucosa": ["mucosa", "mucosal"], "SITE:serum": ["serum"], "SITE:plasma": ["plasma"], "SITE:feces": ["feces", "stool", "fecal"]}


def found_in() -> list[tuple[str, str]]:
    """(source, food) of every edge, ordered: those given singly, and each group's foods with each of the group's sources."""
    single = {(s, f) for s, foods in FOUND_IN.items() for f in foods}
    return sorted(single | {(s, f"FOOD:{f}") for group, foods in FOOD_GROUPS.items() for f in foods.split() for s in SOURCES_OF[group].split()})


def concept_rows() -> list[tuple]:
    ids = [f"{prefix}:{n}" for prefix, names in CONCEPTS.items() for n in names.split()]
    ids += [f"FOOD:{f}" for foods in FOOD_GROUPS.values() for f in foods.split()] + [s for of in SOURCES_OF.values() for s in of.split()]
    out = []
    for cid in dict.fromkeys(ids):
        prefix, n = cid.split(":")
        plain = n.replace("_", " ")
        out.append((cid, plain.capitalize(), TYPES[prefix], list(dict.fromkeys([plain, *FORMS.get(cid, [])]))))
    return out


def digest(rows: list | None = None) -> str:
    """Twelve hex digits of a lexicon or an overlay; the built-in lexicon's without rows."""
    return hashlib.sha256(json.dumps(concept_rows() if rows is None else rows, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:12]


def entity_types(known: DataFrame) -> DataFrame:
    """(entity_type), each once, in order."""
    return known.select("entity_type").distinct().orderBy("entity_type")


def by_id(known: DataFrame, concept_id: str) -> DataFrame:
    return known.filter(F.col("concept_id") == concept_id)


def for_surface(known: DataFrame, surface: str) -> DataFrame:
    """Concepts that have the surface as one of their forms, in any case and spacing."""
    from ..functions import text as T

    return known.filter(F.exists("surface_forms", lambda s: T.surface_key(s) == T.surface_key(F.lit(surface)))).orderBy("concept_id")


def surfaces() -> list[str]:
    return sorted({s for r in concept_rows() for s in r[3]})


def concepts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(concept_rows(), CONCEPT)


def disease_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, n, "disease_state", s) for k, (n, s) in DISEASE_STATES.items()], CONCEPT)


def funders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, t, s) for i, n, t, ss in FUNDERS for s in ss], "funder_id string, canonical_name string, funder_type string, surface string")


def institutions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, t, s) for i, n, t, ss in INSTITUTIONS for s in ss], "institution_id string, canonical_name string, institution_type string, surface string")


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, j, n, s) for i, (n, ss) in enumerate(COUNTRIES) for j, s in enumerate(ss)], "country_order int, surface_order int, canonical_name string, surface string")


def edges(spark: SparkSession, known: DataFrame) -> DataFrame:
    """(source_concept_id, source_name, food_concept_id, food_name), ordered; an endpoint without a concept is an error."""
    rows = spark.createDataFrame(found_in(), "source_concept_id string, food_concept_id string")
    for side in ("source", "food"):
        rows = rows.join(known.select(F.col("concept_id").alias(f"{side}_concept_id"), F.col("canonical_name").alias(f"{side}_name")), f"{side}_concept_id", "left")
        rows = rows.withColumn(f"{side}_name", F.coalesce(f"{side}_name", F.raise_error(F.concat(F.lit("unknown concept "), f"{side}_concept_id"))))
    return rows.orderBy("source_concept_id", "food_concept_id")


def food_sources(edge_rows: DataFrame, source: str) -> DataFrame:
    return edge_rows.filter(F.col("source_concept_id") == source)


def compounds_in(edge_rows: DataFrame, food: str) -> DataFrame:
    return edge_rows.filter(F.col("food_concept_id") == food)


def with_overlay(builtin: DataFrame, custom: DataFrame, removed: DataFrame) -> DataFrame:
    """Built-in concepts with custom ones in their place or added, without removed ones; ``origin`` tells which.

    builtin, custom: pos and CONCEPT columns; removed: concept_id.  A built-in concept keeps its place when it is replaced.
    """
    b = builtin.select("concept_id", F.col("pos").alias("b_pos"), F.struct("canonical_name", "entity_type", "surface_forms").alias("b"))
    c = custom.select("concept_id", F.col("pos").alias("c_pos"), F.struct("canonical_name", "entity_type", "surface_forms").alias("c"))
    rows = b.join(c, "concept_id", "full").join(removed, "concept_id", "left_anti")
    origin = F.when(F.col("c").isNull(), "builtin").when(F.col("b").isNull(), "custom").otherwise("overridden")
    return rows.select("concept_id", F.coalesce("c", "b").alias("x"), origin.alias("origin"), F.struct(F.col("b_pos").isNull().alias("new"), F.coalesce("b_pos", "c_pos").alias("pos")).alias("place")).select("concept_id", "x.*", "origin", "place")


def upsert(custom: DataFrame, removed: DataFrame, concept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The overlay after adding or replacing a concept, which also takes it back from the removed ones."""
    rest = custom.join(concept.select("concept_id"), "concept_id", "left_anti")
    return rest.unionByName(concept), removed.join(concept.select("concept_id"), "concept_id", "left_anti")


def delete(custom: DataFrame, removed: DataFrame, builtin: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The overlay after deleting ids: custom concepts go, built-in ones are hidden."""
    hide = ids.join(builtin.select("concept_id"), "concept_id", "left_semi")
    return custom.join(ids, "concept_id", "left_anti"), removed.unionByName(hide.select("concept_id")).distinct()


def valid_concept(rows: DataFrame) -> DataFrame:
    """Concepts with trimmed surfaces, without those that differ in case only; flags ids that are not ``PREFIX:name``."""
    forms = F.filter(F.transform("surface_forms", lambda s: F.trim(s)), lambda s: s != "")
    firsts = F.filter(forms, lambda s, i: F.array_position(F.transform(forms, F.lower), F.lower(s)) == i + 1)
    return rows.withColumns({"surface_forms": firsts, "valid": F.col("concept_id").rlike(CONCEPT_ID) & (F.size(firsts) > 0)})


#: Stands for the digest of whatever version is the last when a change begins.
LATEST = "latest"


class Exists(ValueError):
    """The concept that was to be added is there."""


class Overlay:
    """A user's changes of a lexicon: versions of two tables, custom concepts and removed ids, of which a manifest names the last.

    A change is read, made and saved as a whole; ``save`` compares the digest that the change started from with the last one, and of two writers of the next version one gets a ``Conflict``, so no change is lost unseen.
    """

    CUSTOM, REMOVED = "pos int, " + CONCEPT, "concept_id string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = Manifests(spark, f"{self.path}/_manifests")

    def digest(self) -> str | None:
        """Twelve hex digits of the overlay's content; None while it is empty."""
        return self.manifests.latest()[1].get("digest")

    def tables(self) -> tuple[DataFrame, DataFrame]:
        """(custom, removed) of the last version."""
        now = self.manifests.latest()[1]
        if not now:
            return self.spark.createDataFrame([], self.CUSTOM), self.spark.createDataFrame([], self.REMOVED)
        return tuple(self.spark.read.schema(schema).parquet(f"{self.path}/{now['id']}/{name}") for name, schema in (("custom", self.CUSTOM), ("removed", self.REMOVED)))

    def save(self, custom: DataFrame, removed: DataFrame, expected: str | None) -> str | None:
        """Put a new version in place of the one with the digest ``expected``; returns its digest."""
        number, now = self.manifests.latest()
        if now.get("digest") != expected:
            raise Conflict(f"the overlay is no longer {expected}")
        version = uuid.uuid4().hex
        for name, rows, schema in (("custom", custom, self.CUSTOM), ("removed", removed, self.REMOVED)):
            fields = self.spark.createDataFrame([], schema).schema
            rows.select(*(F.col(f.name).cast(f.dataType) for f in fields)).write.parquet(f"{self.path}/{version}/{name}")
        made = self.spark.read.schema(self.CUSTOM).parquet(f"{self.path}/{version}/custom"), self.spark.read.schema(self.REMOVED).parquet(f"{self.path}/{version}/removed")
        # a sum of row digests, so that the order of rows does not count and no row has all of them
        rows = made[0].select(F.to_json(F.struct("pos", "concept_id", "canonical_name", "entity_type", "surface_forms")).alias("x")).unionByName(made[1].select("concept_id").withColumnRenamed("concept_id", "x"))
        n, total = rows.agg(F.count("*"), F.sum(F.conv(F.substring(F.sha2("x", 256), 1, 15), 16, 10).cast("decimal(38,0)"))).first()
        digest = hashlib.sha256(f"{n}:{total}".encode()).hexdigest()[:12] if n else None
        taken = self.manifests.numbers()
        self.manifests.commit(max([number, *taken[-1:]]) + 1, {"id": version, "digest": digest})
        return digest

    def effective(self, builtin: DataFrame) -> DataFrame:
        """The lexicon with the overlay applied, in order, each concept with its origin.  builtin: CONCEPT columns in the order of their ids, or with ``pos``."""
        return with_overlay(placed(builtin), *self.tables()).orderBy("place").drop("place")

    def _known(self, builtin: DataFrame, concept_id: str) -> bool:
        return not self.effective(builtin).filter(F.col("concept_id") == concept_id).isEmpty()

    def _put(self, concept_id: str, name: str, entity_type: str, forms: list[str], expected: str | None) -> str | None:
        one = self.spark.createDataFrame([(concept_id, name, entity_type, forms)], CONCEPT)
        one = valid_concept(one).first()
        if not one.valid or not name or not entity_type:
            raise ValueError(f"no concept: {concept_id}")
        expected = self.digest() if expected == LATEST else expected
        custom, removed = self.tables()
        last = custom.agg(F.max("pos")).first()[0]
        row = self.spark.createDataFrame([(0 if last is None else last + 1, concept_id, name, entity_type, one.surface_forms)], self.CUSTOM)
        return self.save(*upsert(custom, removed, row), expected)

    def add(self, builtin: DataFrame, concept_id: str, name: str, entity_type: str, forms: list[str], expected: str | None = LATEST) -> str | None:
        """A new concept; one that is there is an error."""
        if self._known(builtin, concept_id):
            raise Exists(concept_id)
        return self._put(concept_id, name, entity_type, forms, expected)

    def edit(self, builtin: DataFrame, concept_id: str, name: str, entity_type: str, forms: list[str], expected: str | None = LATEST) -> str | None:
        """New fields of a concept that is there."""
        if not self._known(builtin, concept_id):
            raise KeyError(concept_id)
        return self._put(concept_id, name, entity_type, forms, expected)

    def remove(self, builtin: DataFrame, concept_id: str, expected: str | None = LATEST) -> str | None:
        """Hide a built-in concept or drop a custom one."""
        if not self._known(builtin, concept_id):
            raise KeyError(concept_id)
        ids = self.spark.createDataFrame([(concept_id,)], "concept_id string")
        now = self.digest()
        return self.save(*delete(*self.tables(), builtin, ids), now if expected == LATEST else expected)


def placed(builtin: DataFrame) -> DataFrame:
    """Concepts with ``pos``, their place by id where none is given; a lexicon is numbered range by range."""
    if "pos" in builtin.columns:
        return builtin
    return builtin.orderBy("concept_id").withColumn("pos", F.monotonically_increasing_id())
