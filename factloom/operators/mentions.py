"""Entity mentions: lexicon, dictionary scan, detector hook, qualifiers and modifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.scan import scan, scan_cores, word_pattern
from ..plans.rules import ATTRIBUTIVE, LOCALIZING, MODIFIER_GAP, QUALIFIER_RULES, SITES


def surface_index(concepts: DataFrame) -> DataFrame:
    """(key, n_concepts, concept_id, canonical_name, entity_type, any_type) per surface key.

    concepts: concept_id, canonical_name, entity_type, surface_forms.  A key of several concepts is ambiguous: it has no concept, and the
    alphabetically first type.
    """
    rows = concepts.select("concept_id", "canonical_name", "entity_type", F.explode("surface_forms").alias("form"))
    rows = rows.withColumn("key", T.surface_key(F.col("form")))
    grouped = rows.groupBy("key").agg(F.count_distinct("concept_id").alias("n_concepts"), F.min("concept_id").alias("c"), F.min_by("canonical_name", "concept_id").alias("name"), F.min("entity_type").alias("any_type"))
    one = F.col("n_concepts") == 1
    return grouped.select("key", "n_concepts", F.when(one, F.col("c")).alias("concept_id"), F.when(one, F.col("name")).alias("canonical_name"), "any_type")


def normalize(surfaces: DataFrame, index: DataFrame, surface: str = "surface_text") -> DataFrame:
    """Surfaces with concept_id, canonical_name and status: unmatched, ambiguous or normalized.

    To narrow by type, give the index of that type's concepts: ``surface_index(concepts.filter(...))``.
    """
    joined = surfaces.withColumn("key", T.surface_key(F.col(surface))).join(F.broadcast(index.select("key", "n_concepts", "concept_id", "canonical_name")), "key", "left")
    status = F.when(F.col("n_concepts").isNull(), "unmatched").when(F.col("n_concepts") > 1, "ambiguous").otherwise("normalized")
    return joined.withColumn("status", status).drop("key", "n_concepts")


def dictionary_spans(paragraphs: DataFrame, surfaces: list[str]) -> DataFrame:
    """Longest-first, word-bounded, non-overlapping dictionary hits of each paragraph.

    The surfaces are a lexicon, of a bounded size; they are part of the plan as one pattern.
    """
    rows = paragraphs.select("document_id", "paragraph_id", F.col("start_char").alias("base"), F.explode(scan(F.col("text"), word_pattern(surfaces))).alias("x"))
    return rows.select("document_id", "paragraph_id", (F.col("base") + F.col("x.s")).cast("int").alias("start_char"), (F.col("base") + F.col("x.e")).cast("int").alias("end_char"), F.col("x.t").alias("surface_text"))


#: Sentences that a detector's worker holds as Python objects at once.
ROWS_AT_ONCE = 256


def detected_spans(sents: DataFrame, detect: Callable[[str], Iterable[tuple[int, int, str, float]]]) -> DataFrame:
    """Spans of a user's detector, called on each sentence's text: (start, end, label, score) relative to it."""

    def run(batches):
        for part in (batch.slice(at, ROWS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, ROWS_AT_ONCE)):
            out = []
            for doc, sent, base, text in zip(*(c.to_pylist() for c in part.columns)):
                out += [(doc, sent, base + s, base + e, text[s:e], label, float(score)) for s, e, label, score in detect(text)]
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64()]
            names = ["document_id", "sentence_id", "start_char", "end_char", "surface_text", "label", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 7, types)], names)

    schema = "document_id string, sentence_id string, start_char int, end_char int, surface_text string, label string, score double"
    return sents.select("document_id", "sentence_id", "start_char", "text").mapInArrow(run, schema)


def open_observation_id(document: Column, start: Column, end: Column, detector: Column | None = None) -> Column:
    """Digest of the span, and of the detector's name where it is told."""
    parts = [document, start.cast("string"), end.cast("string")]
    return T.digest(*parts, *([detector] if detector is not None else []), length=16, skip_empty=False, separator="|")


def open_observations(sents: DataFrame, detect: Callable[[str], Iterable[tuple[int, int, str, float]]], least: float = 0.0) -> DataFrame:
    """Relations of a user's detector with ids: of equal spans of a document the best-scored one, best first and then by place."""
    rows = detected_spans(sents, detect).filter(F.col("score") >= least)
    best = rows.groupBy("document_id", "start_char", "end_char").agg(F.max_by(F.struct("sentence_id", "surface_text", "label", "score"), F.struct("score", "label")).alias("b"))
    return best.select(open_observation_id(F.col("document_id"), F.col("start_char"), F.col("end_char")).alias("open_observation_id"), "document_id", "b.sentence_id", "start_char", "end_char", F.col("b.surface_text").alias("text"), "b.label", "b.score")


# Marks of a linearised relation (fixed values): ``<triplet> subject <subj> object <obj> relation``.
def decoded_triples(text: Column) -> Column:
    """array<struct<subject, relation, object>> of a model's linearised output: a new subject begins with ``<triplet>``, and further objects of it with ``<subj>``; parts that are blank, and repeated triples, are left out."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), r"</?s>|<pad>", "")
    parts = F.slice(F.split(clean, "<triplet>", -1), 2, F.size(F.split(clean, "<triplet>", -1)))
    trim = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))

    def of_subject(part: Column) -> Column:
        pieces = F.split(part, "<subj>", -1)
        tails = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda t: F.split(t, "<obj>", 2))
        return F.transform(F.filter(tails, lambda t: F.size(t) == 2), lambda t: F.struct(trim(pieces[0]).alias("subject"), trim(F.regexp_replace(t[1], "<.*$", "")).alias("relation"), trim(t[0]).alias("object")))

    found = F.flatten(F.transform(F.filter(parts, lambda x: x.contains("<subj>")), of_subject))
    return F.array_distinct(F.filter(found, lambda x: (x["subject"] != "") & (x["relation"] != "") & (x["object"] != "")))


def sequence_confidence(log_probabilities: Column) -> Column:
    """The mean log probability of a generated sequence's tokens as a probability in [0, 1]; 1 where the model gives none."""
    mean = F.aggregate(log_probabilities, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(log_probabilities)
    known = F.coalesce(F.size(log_probabilities) > 0, F.lit(False)) & ~F.coalesce(F.exists(log_probabilities, lambda x: x.isNull() | F.isnan(x.cast("double"))), F.lit(False))
    return F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(mean)))).otherwise(F.lit(1.0))


def generated_relations(sents: DataFrame, outputs: DataFrame, detector: str = "generated", version: str = "") -> DataFrame:
    """Sentences for which a generating model gave a relation, with its triples and confidence.

    outputs: sentence_id, generated (linearised), log_probabilities; of several outputs of a sentence the most confident one counts, of equal ones the first by text.
    """
    rows = outputs.select("sentence_id", "generated", sequence_confidence(F.col("log_probabilities")).alias("score")).filter(F.col("generated").contains("<triplet>"))
    best = rows.groupBy("sentence_id").agg(F.max("score").alias("score"), F.min_by("generated", F.struct(-F.col("score"), "generated")).alias("generated"))
    s = sents.select("document_id", "sentence_id", "start_char", "end_char", "text").join(best, "sentence_id")
    oid = open_observation_id(F.col("document_id"), F.col("start_char"), F.col("end_char"), F.lit(detector))
    return s.select(oid.alias("open_observation_id"), "document_id", "sentence_id", "start_char", "end_char", "text", F.lit("relation").alias("label"), "score", F.lit(detector).alias("detector_name"), F.lit(version).alias("detector_version"), decoded_triples(F.col("generated")).alias("triples"))


def placed_triples(relations: DataFrame, found: DataFrame) -> DataFrame:
    """One row per triple with its ends on mentions of its sentence: the first mention whose surface is the end's text, in any case and spacing; an end without one has no mention.

    relations: rows of ``generated_relations``; found: mentions.
    """
    rows = relations.select("open_observation_id", "document_id", "sentence_id", "score", F.posexplode("triples").alias("triple", "t")).select("*", "t.*").drop("t")
    named = found.filter("sentence_id is not null").groupBy("sentence_id", T.surface_key(F.col("surface_text")).alias("key")).agg(F.min_by(F.struct("mention_id", "concept_id"), F.struct("start_char", "end_char", "mention_id")).alias("m"))
    for side in ("subject", "object"):
        of = named.select(F.col("sentence_id").alias("s"), F.col("key").alias("k"), F.col("m.mention_id").alias(f"{side}_mention_id"), F.col("m.concept_id").alias(f"{side}_concept_id"))
        rows = rows.join(of, (F.col("sentence_id") == F.col("s")) & (T.surface_key(F.col(side)) == F.col("k")), "left").drop("s", "k")
    return rows


def best_first(rows: DataFrame) -> DataFrame:
    """Open observations of each document, best-scored first, then by place."""
    return rows.orderBy("document_id", F.desc("score"), "start_char", "end_char", "open_observation_id")


def overlap(a: DataFrame, b: DataFrame) -> Column:
    return (a["document_id"] == b["document_id"]) & (a["start_char"] < b["end_char"]) & (b["start_char"] < a["end_char"])


def without_overlaps(spans: DataFrame, winners: DataFrame) -> DataFrame:
    """Spans that overlap no winner; an overlapping span is dropped whole."""
    return spans.join(winners, overlap(spans, winners), "left_anti")


def mentions(sents: DataFrame, paragraphs: DataFrame, index: DataFrame, surfaces: list[str], model_spans: DataFrame | None = None) -> DataFrame:
    """Mentions with ids, concepts and the sentence that contains them; a model's spans win over dictionary hits."""
    found = dictionary_spans(paragraphs, surfaces).select("document_id", "start_char", "end_char", "surface_text", F.lit("dictionary").alias("source"), F.lit(None).cast("string").alias("label"))
    if model_spans is not None:
        model = model_spans.select("document_id", "start_char", "end_char", "surface_text", F.lit("model").alias("source"), "label")
        found = without_overlaps(found, model).unionByName(model)
    rows = found.withColumn("key", T.surface_key(F.col("surface_text"))).join(F.broadcast(index), "key", "left")
    status = F.when(F.col("n_concepts").isNull(), "unmatched").when(F.col("n_concepts") > 1, "ambiguous").otherwise("normalized")
    kind = F.coalesce("any_type", F.lower("label"), F.lit("unknown"))
    rows = rows.withColumn("status", status).withColumn("entity_type", kind).withColumn("mention_id", T.mention_id(F.col("document_id"), F.col("start_char"), F.col("end_char"), F.col("entity_type")))
    columns = ["mention_id", "document_id", "sentence_id", "concept_id", "canonical_name", "surface_text", "normalized_text", "entity_type", "start_char", "end_char", "source", "status"]
    return in_sentences(rows.withColumnRenamed("key", "normalized_text"), sents).select(columns).dropDuplicates(["document_id", "mention_id"])


def in_sentences(spans: DataFrame, sents: DataFrame) -> DataFrame:
    """Spans with the sentence that contains them, or null.  Sentences of a document do not overlap, so only the last one that begins no later may: one pass over a document's spans and sentences in order."""
    s = sents.select("document_id", "start_char", F.struct("sentence_id", "end_char").alias("at"), F.lit(0).alias("turn"))
    both = spans.withColumn("turn", F.lit(1)).unionByName(s, allowMissingColumns=True)
    so_far = W.partitionBy("document_id").orderBy("start_char", "turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = both.withColumn("at", F.last("at", ignorenulls=True).over(so_far)).filter("turn = 1")
    return rows.withColumn("sentence_id", F.when(F.col("document_id").isNotNull() & (F.col("end_char") <= F.col("at.end_char")), F.col("at.sentence_id"))).drop("at", "turn")


def qualifier_spans(spans: DataFrame, id_col: str, rules: list[tuple] = QUALIFIER_RULES) -> DataFrame:
    """Cue hits of every qualifier rule: id_col, rule order, rule, type, start, end, value_text.  spans: id_col, start_char, text."""
    told = lambda k, rule, kind: lambda x: F.struct(F.lit(k).alias("rule_order"), F.lit(rule).alias("rule_id"), F.lit(kind).alias("qualifier_type"), x.alias("x"))
    hits = [F.transform(scan_cores(F.col("text"), before, core, after), told(k, rule, kind)) for k, (rule, kind, before, core, after) in enumerate(rules)]
    rows = spans.select(id_col, "start_char", F.explode(F.flatten(F.array(*hits))).alias("h")).select(id_col, "start_char", "h.*")
    base = F.col("start_char")
    return rows.select(id_col, "rule_order", "rule_id", "qualifier_type", (base + F.col("x.s")).cast("int").alias("start_char"), (base + F.col("x.e")).cast("int").alias("end_char"), F.col("x.t").alias("value_text"))


def qualifiers(spans: DataFrame, id_col: str, states: DataFrame) -> DataFrame:
    """Typed qualifiers of each span, one for each condition: its first cue's text and rule, and the spans of all its cues.

    states: surface index of disease states (key, n_concepts, concept_id); a state that is not there, or ambiguous, keeps its text.
    """
    hits = qualifier_spans(spans, id_col).withColumn("key", T.surface_key(F.col("value_text")))
    known = F.broadcast(states.filter("n_concepts = 1").select("key", F.lit("disease_state").alias("qualifier_type"), F.col("concept_id").alias("value_concept_id")))
    hits = hits.join(known, ["key", "qualifier_type"], "left").withColumn("value", F.coalesce("value_concept_id", "key"))
    first = F.struct("rule_order", "start_char")
    return hits.groupBy(id_col, "qualifier_type", "value").agg(
        F.first("value_concept_id").alias("value_concept_id"), F.min_by("value_text", first).alias("value_text"), F.min_by("rule_id", first).alias("rule_id"),
        F.array_sort(F.collect_set(F.struct("start_char", "end_char"))).alias("spans"),
    )


def modifiers(found: DataFrame, paragraphs_text: DataFrame | None, sites: list[str] = SITES, sents: DataFrame | None = None) -> DataFrame:
    """``head of the object`` between neighbouring mentions of a sentence, typed by preposition and resolved object.

    found: mentions; paragraphs_text: document_id, canonical_text.  With ``sents`` (sentence_id, start_char, text) gaps are cut from the sentence and not from the whole text.
    """
    order = W.partitionBy("document_id", "sentence_id").orderBy("start_char", "end_char")
    if sents is not None:
        order = W.partitionBy("sentence_id").orderBy("start_char", "end_char")
    nxt = lambda c: F.lead(c).over(order)
    rows = found.filter(F.col("sentence_id").isNotNull()).select(
        "document_id", "sentence_id", "mention_id", "end_char", nxt("start_char").alias("o_start"), nxt("end_char").alias("o_end"), nxt("concept_id").alias("value_concept_id"), nxt("surface_text").alias("value_text"), nxt("entity_type").alias("value_type")
    )
    rows = rows.filter(F.col("o_start") >= F.col("end_char"))
    if sents is None:
        rows, text, base = rows.join(paragraphs_text, "document_id"), F.col("canonical_text"), F.lit(0)
    else:
        rows, text, base = rows.join(sents.select("sentence_id", F.col("start_char").alias("base"), "text"), "sentence_id"), F.col("text"), F.col("base")
    gap = F.substring(text, F.col("end_char") - base + 1, F.col("o_start") - F.col("end_char"))
    rows = rows.withColumn("preposition", F.lower(F.regexp_extract(gap, MODIFIER_GAP, 1))).filter(F.col("preposition") != "")
    relation = (
        F.when(F.col("value_concept_id").isin(sites) & F.col("preposition").isin(LOCALIZING), "localized_in")
        .when(F.col("preposition").isin(ATTRIBUTIVE), "qualified_by")
    )
    status = F.when(F.col("value_concept_id").isNotNull(), "normalized").otherwise("unmatched")
    return rows.withColumn("relation", relation).filter(F.col("relation").isNotNull()).select(
        "document_id", "sentence_id", F.col("mention_id").alias("owner_id"), "relation", "preposition", "value_concept_id", "value_text",
        F.when(F.col("value_concept_id").isNotNull(), F.col("value_type")).alias("value_type"), status.alias("status"),
    )


def p_alias(found: DataFrame) -> DataFrame:
    """One row: neighbour pairs of normalized mentions, those of one concept, and their share (null without pairs)."""
    order = W.partitionBy("sentence_id").orderBy("start_char", "end_char")
    rows = found.filter(F.col("sentence_id").isNotNull() & F.col("concept_id").isNotNull()).select("end_char", "concept_id", F.lead("start_char").over(order).alias("s"), F.lead("concept_id").over(order).alias("c"))
    rows = rows.filter(F.col("s") >= F.col("end_char"))
    return rows.agg(F.count("*").alias("pairs"), F.count_if(F.col("c") == F.col("concept_id")).alias("aliased")).withColumn("p_alias", F.expr("try_divide(aliased, pairs)"))
