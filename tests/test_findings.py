"""What findings have shown: plans that carried whole texts along or read a step again for each use."""

import re

from pyspark.sql import functions as F

from factloom.functions.scan import scan, word_pattern
from factloom.operators import analysis, binding, mentions, query
from factloom.plans.extract import extract, one_sentence_papers


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_binder_carries_no_texts(spark):
    """pairs are cut from their clause, and each step is read once."""
    rows = spark.createDataFrame([("pmid_1", None, "Dietary fiber improves remission but fiber may aggravate abdominal pain.")], "document_id string, title string, sentence string")
    made = {}

    def keep(name, part):
        made[name] = plan(part)
        at = f"{spark.conf.get('spark.checkpoint.dir')}/findings-{name}"
        part.write.mode("overwrite").parquet(at)
        return spark.read.parquet(at)

    obs = extract(one_sentence_papers(rows), keep=keep)["observations"]
    assert sorted(r.predicate for r in obs.collect()) == ["improves", "worsens"]
    assert not any("canonical_text" in p for p in made.values())
    assert made["qualifiers"].count("Relation [") <= 1 + made["qualifiers"].count("n_concepts")  # one scan of the clauses, whatever the number of rules
    assert "Union" not in made["qualifiers"]


def test_factored_pattern_is_the_alternation(spark):
    surfaces = ["iron", "iron deficiency", "iron deficiency anaemia", "Iron", "crohn’s disease", "IL-6", "il-6 receptor", "a", "ab", "abc d", "Étoile", "étoile du nord"]
    texts = ["iron deficiency anaemias", "Iron  Deficiency", "IRON DEFICIENCY; iron", "ab abc d abcd", "Crohn’s disease, IL-6 receptors", "ÉTOILE DU NORD étoile du", "", None, "a" * 50, "iron\niron deficiency"]
    words = sorted(set(surfaces), key=lambda s: (-len(s), s))
    want = re.compile(r"(?i)(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)")
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scan(F.col("t"), word_pattern(surfaces)).alias("x")).collect()
    for r in got:
        assert [(x.s, x.e, x.t) for x in r.x] == [(m.start(), m.end(), m.group()) for m in want.finditer(r.t or "")]


def test_spans_in_sentences(spark):
    """Spans meet the sentence that contains them in one pass, not by a join of all pairs of a document."""
    sents = spark.createDataFrame([("d", "s0", 0, 10), ("d", "s1", 12, 20), ("e", "t", 0, 5)], "document_id string, sentence_id string, start_char int, end_char int")
    spans = spark.createDataFrame([("d", 0, 3), ("d", 8, 10), ("d", 8, 13), ("d", 11, 12), ("d", 12, 20), ("e", 4, 6), ("f", 0, 1), (None, 0, 1)], "document_id string, start_char int, end_char int")
    rows = mentions.in_sentences(spans, sents)
    assert "Join" not in plan(rows)
    assert sorted(((r.document_id, r.start_char, r.end_char, r.sentence_id) for r in rows.collect()), key=repr) == sorted([("d", 0, 3, "s0"), ("d", 8, 10, "s0"), ("d", 8, 13, None), ("d", 11, 12, None), ("d", 12, 20, "s1"), ("e", 4, 6, None), ("f", 0, 1, None), (None, 0, 1, None)], key=repr)


def test_gold_is_dealt_once(spark):
    """expected and produced observations meet in one grouping, and outcomes are made in one pass; the texts of a sentence without expected ones count for nothing."""
    fields = "sentence_id string, k int, subject_text string, subject_concept_id string, object_text string, object_concept_id string, predicate string, polarity string, certainty string"
    gold = spark.createDataFrame([("s", 0, "a", None, "b", None, "p", "positive", "asserted", True, None), ("s", 1, "a", None, "b", None, "p", "positive", "asserted", True, None), ("u", 0, "a", "A", "b", "B", "p", "positive", "asserted", False, "gap")], fields + ", in_vocab boolean, failure_mode string")
    made = spark.createDataFrame([("s", 5, "A a", None, "b", None, "q", "positive", "possible"), ("s", 7, "z", "Z", "b", None, "p", "positive", "asserted"), ("t", 0, "a", None, "b", None, "p", "positive", "asserted")], fields)
    rows = analysis.gold_alignment(gold, made)
    assert "Join" not in plan(rows) and plan(rows).count("Aggregate") == 1
    got = sorted(((r.sentence_id, r.k, r.outcome, r.failure_mode) for r in rows.collect()))
    assert got == [("s", 0, "field_error", "wrong_predicate_certainty"), ("s", 1, "missed", "missing"), ("s", 7, "spurious", "spurious"), ("u", 0, "missed", "gap")]


def test_nested_documents_are_dealt_once(spark):
    """all levels go by document in one shuffle; what has no children has null, and children without a parent are left out."""
    docs = spark.createDataFrame([("d",), ("e",)], "document_id string")
    secs = spark.createDataFrame([("d", "d_1", "One", 0, 9), ("d", "d_2", None, 11, 20)], "document_id string, section_id string, title string, start_char int, end_char int")
    pars = spark.createDataFrame([("d", "d_1", "p2", 5, 9, "b"), ("d", "d_1", "p1", 0, 3, "a"), ("x", "x_1", "p9", 0, 3, "a")], "document_id string, section_id string, paragraph_id string, start_char int, end_char int, text string")
    sents = spark.createDataFrame([("d", "d_1", "p1", "s1", 0, 1, "a"), ("d", "d_1", "p7", "s7", 0, 1, "a")], "document_id string, section_id string, paragraph_id string, sentence_id string, start_char int, end_char int, text string")
    rows = query.nested_documents(docs, secs, pars, sents)
    assert "Join" not in plan(rows)
    d, e = sorted(rows.collect())
    assert e.sections is None and [s.section_id for s in d.sections] == ["d_1", "d_2"] and d.sections[1].paragraphs is None
    assert [(p.paragraph_id, p.sentences and [x.sentence_id for x in p.sentences]) for p in d.sections[0].paragraphs] == [("p1", ["s1"]), ("p2", None)]


def test_traced_pairs_hold_places_only(spark):
    """F16: a pair brings along where its ends are, not their texts and concepts."""
    cm = spark.createDataFrame([("d", "s", "c", f"m{k}", "x", "C", 5 * k, 5 * k + 1, False) for k in range(3)], "document_id string, sentence_id string, clause_id string, mention_id string, surface_text string, concept_id string, start_char int, end_char int, is_q boolean")
    rows = binding.pair_trace(cm, spark.createDataFrame([("d", "x of x to x")], "document_id string, canonical_text string"), [("of", "p", "positive", True, "of"), ("to", "p", "positive", True, "to")])
    assert not any("surface_text" in line for line in plan(rows).splitlines() if "lead(" in line)
    assert sorted((r.subject_mention_id, r.object_mention_id, r.rule_trace[0].verdict, r.rule_trace[1].verdict) for r in rows.collect()) == [("m0", "m1", "chosen", "no_cue"), ("m1", "m2", "no_cue", "chosen")]


def test_detector_holds_few_rows(spark):
    """of a batch of any length a detector's worker has no more than a few hundred sentences as Python objects."""
    import sys

    sents = spark.range(0, 1000, 1, 1).select(F.lit("d").alias("document_id"), F.col("id").cast("string").alias("sentence_id"), F.col("id").cast("int").alias("start_char"), F.lit("text").alias("text"))
    rows = mentions.detected_spans(sents, lambda t: [(0, 1, "held", sys._getframe(1).f_locals["part"].num_rows)])
    got = rows.agg(F.count("*").alias("n"), F.max("score").alias("held"), F.count_distinct("start_char").alias("places")).first()
    assert (got.n, got.places) == (1000, 1000) and got.held <= 256
