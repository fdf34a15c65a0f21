"""The extraction plan: paragraphs to sentences, mentions, observations and claims, as composed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import binding, claims, documents, mentions, parse
from ..sources import vocabulary
from ..sources.staging import staged
from . import rules as R


def extract(
    raw_paragraphs: DataFrame, concepts: DataFrame | None = None, surfaces: list[str] | None = None, states: DataFrame | None = None, rule_rows: list[tuple] = R.RELATION_RULES, markers: str = R.CLAUSE_MARKERS,
    model_spans=None, parses: DataFrame | None = None, keep: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows,
) -> dict[str, DataFrame]:
    """Tables by name.  A lexicon other than the built-in one comes as concepts with its list of surfaces.

    ``parses`` are tokens of dependency parses of sentences (see ``operators.parse``): sentences with a parse are bound by it first, and by the flat binder only where the
    parse binds nothing and no predicate's subject is known to be no entity; modifiers come from the parse, and from neighbours where it gives none.  ``keep`` gets every table as it is made and returns the one to go on with, so a store can write each stage once.
    """
    spark = raw_paragraphs.sparkSession
    concepts = vocabulary.concepts(spark) if concepts is None else concepts
    surfaces = vocabulary.surfaces() if surfaces is None else surfaces
    states = vocabulary.disease_states(spark) if states is None else states
    paragraphs = keep("paragraphs", documents.canonical_paragraphs(raw_paragraphs))
    texts = documents.canonical_text(paragraphs)
    parts = keep("sections", documents.sections(paragraphs))
    sents = keep("sentences", documents.sentences(paragraphs))
    spans = model_spans(sents) if model_spans is not None else None
    found = keep("mentions", mentions.mentions(sents, paragraphs, mentions.surface_index(concepts), surfaces, spans))
    cut = keep("clauses", documents.clauses(sents, markers))
    quals = keep("qualifiers", mentions.qualifiers(cut, "clause_id", mentions.surface_index(states)))
    mods = keep("modifiers", mentions.modifiers(found, None, sents=sents))
    obs = binding.flat_bind(found, cut, quals, rule_rows)
    if parses is not None:
        index = mentions.surface_index(concepts)
        bound = parse.bind(parses, found, texts)
        parsed = parse.parse_observations(bound, sents, rule_rows)
        quals = quals.unionByName(parse.parse_qualifiers(bound, mentions.surface_index(states)))
        obs = binding.with_fallback(parsed, parse.blocked_sentences(bound), obs)
        mods = parse.modifiers_with_floor(parse.modifiers(staged(parse.parse_tree(parses), "parse-tree"), found, texts, index), mods)
    ends = sents.select("sentence_id", F.col("start_char").alias("evidence_start"), F.col("end_char").alias("evidence_end"))
    obs = keep("bound", obs.join(ends, "sentence_id"))
    obs = keep("observations", claims.with_signatures(binding.link_parents(obs), quals, mods))
    folded = keep("claims", claims.fold(obs, concepts))
    return {"paragraphs": paragraphs, "texts": texts, "sections": parts, "sentences": sents, "mentions": found, "clauses": cut, "qualifiers": quals, "modifiers": mods, "observations": obs, "claims": folded}


def one_sentence_papers(rows: DataFrame) -> DataFrame:
    """Raw paragraphs of papers that are a title and a sentence: document_id, title, sentence."""
    title = rows.select("document_id", F.lit(-1).alias("section_idx"), F.lit("Title").alias("section_title"), F.lit(0).alias("paragraph_idx"), F.col("title").alias("raw_text")).filter("raw_text is not null")
    body = rows.select("document_id", F.lit(0).alias("section_idx"), F.lit("Abstract").alias("section_title"), F.lit(0).alias("paragraph_idx"), F.col("sentence").alias("raw_text"))
    return title.unionByName(body)


def of_quotes(quotes: DataFrame, **options) -> DataFrame:
    """Observations of single sentences (sentence_id, quote) without a store, in reading order: sentence_id, k and the observation's columns.  Steps are staged, so that each is planned by itself."""
    rows = quotes.select(F.col("sentence_id").alias("document_id"), F.lit(None).cast("string").alias("title"), F.col("quote").alias("sentence"))
    obs = extract(one_sentence_papers(rows), **({"keep": lambda name, part: part if name in ("sections", "claims") else staged(part, name)} | options))["observations"].drop("sentence_id").withColumnRenamed("document_id", "sentence_id")
    return in_order(obs)


def in_order(obs: DataFrame) -> DataFrame:
    """Observations numbered (k) in each sentence: by subject, object, predicate, id."""
    from pyspark.sql import Window as W

    order = W.partitionBy("sentence_id").orderBy("subject_start_char", "object_start_char", "predicate", "observation_id")
    return obs.withColumn("k", (F.row_number().over(order) - 1).cast("int"))
