"""Semantics on inline sentences and parses, the offset contract, the store and the stream."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.functions.scan import scan, word_pattern
from factloom.operators import analysis, binding, documents, mentions, parse
from factloom.plans.extract import extract, one_sentence_papers
from factloom.sources import store, vocabulary


def run(spark, *sentences):
    rows = spark.createDataFrame([(f"pmid_{k}", None, s) for k, s in enumerate(sentences)], "document_id string, title string, sentence string")
    return extract(one_sentence_papers(rows))


@pytest.mark.parametrize("cue, predicate, polarity, certainty", [
    ("was associated with", "associated_with", "positive", "asserted"), ("had no association with", "no_association", "negative", "asserted"), ("did not improve", "improves", "negative", "asserted"),
    ("may be associated with", "associated_with", "positive", "possible"),
])
def test_modality(spark, cue, predicate, polarity, certainty):
    rows = run(spark, f"Dietary fiber {cue} remission.")["claims"].collect()
    assert [(r.predicate, r.polarity, r.certainty) for r in rows] == [(predicate, polarity, certainty)]


def test_claim_is_reproducible(spark):
    a, b = (run(spark, "Dietary fiber was associated with remission.")["claims"].collect() for _ in range(2))
    assert a == b and a[0].subject_name == "Dietary fiber" and a[0].object_name == "Remission" and a[0].claim_id.startswith("pmid_0_claim_")


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aé😀 .; \nbut that", max_size=40), min_size=1, max_size=20))
def test_offsets(spark, texts):
    rows = spark.createDataFrame([(str(k), 0, "t", j, x) for k, t in enumerate(texts) for j, x in enumerate(t.split("\n"))], "document_id string, section_idx int, section_title string, paragraph_idx int, raw_text string")
    p = documents.canonical_paragraphs(rows)
    full, s = documents.canonical_text(p), documents.sentences(p)
    spans = [x.select("document_id", "start_char", "end_char", "text") for x in (p, s, documents.clauses(s))]
    for x in spans:
        assert documents.broken_spans(x, full).isEmpty()


def test_scan_counts_code_points(spark):
    import re

    texts = ["😀 fiber éfiber fiber, Dietary FIBER", "", None, "fiber" * 3]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(scan(F.col("t"), word_pattern(["fiber", "dietary fiber"])).alias("x")).collect()
    for t, r in zip(texts, got):
        want = [(m.start(), m.end(), m.group()) for m in re.finditer(r"(?i)(?<!\w)(?:dietary fiber|fiber)(?!\w)", t or "")]
        assert [(x.s, x.e, x.t) for x in r.x] == want


def test_model_span_wins(spark):
    def detect(text):
        at = text.find("fiber intake")
        return [(at, at + 12, "CHEMICAL", 1.0)] if at >= 0 else []

    rows = spark.createDataFrame([("pmid_1", None, "Dietary fiber intake and iron.")], "document_id string, title string, sentence string")
    found = extract(one_sentence_papers(rows), model_spans=lambda s: mentions.detected_spans(s, detect))["mentions"]
    assert sorted((r.surface_text, r.source) for r in found.collect()) == [("fiber intake", "model"), ("iron", "dictionary")]


def test_parse_binder(spark):
    """fiber reduced the risk of cancer and did not improve pain."""
    toks = [
        ("Fiber", "fiber", "NOUN", "nsubj", 1), ("reduced", "reduce", "VERB", "ROOT", 1), ("risk", "risk", "NOUN", "dobj", 1), ("of", "of", "ADP", "prep", 2), ("cancer", "cancer", "NOUN", "pobj", 3),
        ("and", "and", "CCONJ", "cc", 1), ("not", "not", "PART", "neg", 7), ("improve", "improve", "VERB", "conj", 1), ("pain", "pain", "NOUN", "dobj", 7),
    ]
    text, rows, at = " ".join(t[0] for t in toks), [], 0
    for k, (w, lemma, pos, dep, head) in enumerate(toks):
        rows.append(("d", "s", k, w, lemma, pos, dep, head, at))
        at += len(w) + 1
    tokens = spark.createDataFrame(rows, "document_id string, sentence_id string, i int, text string, lemma string, pos string, dep string, head int, idx int")
    spans = [("m1", "Fiber", "NUTR:dietary_fiber"), ("m2", "cancer", "DIS:cancer"), ("m3", "pain", "SYMP:abdominal_pain")]
    found = spark.createDataFrame([(m, "d", "s", c, w, text.index(w), text.index(w) + len(w)) for m, w, c in spans], "mention_id string, document_id string, sentence_id string, concept_id string, surface_text string, start_char int, end_char int")
    texts = spark.createDataFrame([("d", text)], "document_id string, canonical_text string")
    obs = parse.parse_observations(parse.bind(tokens, found, texts), texts.selectExpr("'s' as sentence_id", "0 as start_char"))
    assert sorted((r.subject_concept_id, r.predicate, r.object_concept_id, r.polarity) for r in obs.collect()) == [("NUTR:dietary_fiber", "improves", "SYMP:abdominal_pain", "negative"), ("NUTR:dietary_fiber", "reduces_risk", "DIS:cancer", "positive")]
    none = spark.createDataFrame([], "sentence_id string")
    assert binding.with_fallback(obs, none, obs).count() == obs.count()


def test_cohesion_without_core(spark):
    sets = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "document_id string, concept_id string")
    rows = {r.document_id: r for r in analysis.cohesion(sets).collect()}
    assert rows["a"].score is None and not rows["a"].is_outlier and rows["c"].reason == "no_extractable_concepts"
    alone = analysis.cohesion(spark.createDataFrame([("a", "x"), ("a", "y")], "document_id string, concept_id string")).first()
    assert alone.score == 1.0 and not alone.is_outlier


def test_edges(spark):
    known = vocabulary.concepts(spark)
    e = vocabulary.edges(spark, known)
    assert [r.food_concept_id for r in vocabulary.food_sources(e, "CHEM:curcumin").collect()] == ["FOOD:turmeric"]
    with pytest.raises(Exception, match="unknown concept"):
        vocabulary.edges(spark, known.filter("concept_id <> 'FOOD:fish'")).collect()


def test_store_replaces_documents(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "db"))
    schema = "claim_id string, document_id string"
    assert s.read("claims").count() == 0
    s.replace("claims", spark.createDataFrame([(f"{d}{k}", d) for d in "abcdef" for k in range(3)], schema))
    s.replace("claims", spark.createDataFrame([("a9", "a")], schema), spark.createDataFrame([("a",), ("b",)], "document_id string"))
    s.replace("claims", spark.createDataFrame([("a9", "a")], schema))
    assert sorted(r.claim_id for r in s.read("claims").collect()) == sorted(["a9", *(f"{d}{k}" for d in "cdef" for k in range(3))])
    everything = spark.createDataFrame([(d,) for d in "abcdef"], "document_id string")
    s.replace("claims", spark.createDataFrame([], schema), everything)
    assert s.read("claims").count() == 0
    grade = "document_id string, framework_id string, framework_version string, criterion string, value string"
    s.replace("assessments", spark.createDataFrame([("a", "f", v, "c", "x") for v in ("1", "2")], grade))
    s.replace("assessments", spark.createDataFrame([("a", "f", "2", "c", "y")], grade), everything)
    assert sorted((r.framework_version, r.value) for r in s.read("assessments").collect()) == [("1", "x"), ("2", "y")]
    files = spark.createDataFrame([("1", "x.xml", bytearray(b"x"))], "pmid string, name string, content binary")
    store.archive_raw(spark, files, str(tmp_path / "raw"))
    with pytest.raises(FileExistsError):
        store.archive_raw(spark, files, str(tmp_path / "raw"))


def test_stream(spark, tmp_path):
    from factloom.streaming.ingest import ingest

    rows = spark.createDataFrame([("pmid_1", None, "Dietary fiber was associated with remission.")], "document_id string, title string, sentence string")
    one_sentence_papers(rows).write.parquet(str(tmp_path / "in"))
    s = store.Store(spark, str(tmp_path / "db"))
    for _ in range(2):
        ingest(spark, str(tmp_path / "in"), s, str(tmp_path / "ck")).awaitTermination()
    assert s.read("claims").count() == 1 and s.read("sentences").count() == 1


def test_lexicon_is_wide(spark):
    rows, edges = vocabulary.concept_rows(), vocabulary.found_in()
    assert len({r[0] for r in rows}) == len(rows) >= 200
    assert len(edges) >= 300 and len({s for s, _ in edges}) >= 40
    assert vocabulary.edges(spark, vocabulary.concepts(spark)).count() == len(edges)
    assert vocabulary.valid_concept(vocabulary.concepts(spark)).filter("not valid").isEmpty()
    assert [r.concept_id for r in vocabulary.for_surface(vocabulary.concepts(spark), " Gut  MICROBIOME").collect()] == ["BIOM:gut_microbiota"]
    assert len(vocabulary.digest()) == 12 and vocabulary.digest([]) != vocabulary.digest()


def test_ingest_fills_every_table(spark, tmp_path):
    """Raw files to all tables; a run's id follows from its documents and versions alone."""
    from factloom.operators import query
    from factloom.plans import persist
    from factloom.queries import JATS, PUBMED
    from factloom.sources.schemas import TABLES

    text = b"Dietary fiber was associated with remission. Kale of the colon during remission reduces abdominal pain."
    raw = spark.createDataFrame([("12345678", "pubmed.xml", bytearray(PUBMED)), ("12345678", "pmc.xml", bytearray(JATS.replace(b"Tests.", text)))], "pmid string, name string, content binary")
    s = store.Store(spark, str(tmp_path / "db"))
    detect = lambda t: [(0, 4, "relation", 0.5)] if len(t) > 50 else []
    run_id = persist.ingest(s, raw, detect).first().run_id
    assert run_id == persist.versions(s.read("documents"), "2020-01-01").first().run_id
    counts = {t: s.read(t).count() for t in TABLES}
    assert not [t for t, n in counts.items() if n == 0 and t not in ("claim_modifiers", "entity_modifiers")], counts
    assert counts["claims"] == 2 and counts["open_observations"] == 1 and counts["assessments"] == counts["assessment_criteria"] == 4
    assert s.read("claim_evidence").join(s.read("sentences").select("sentence_id", "text"), "sentence_id").filter("text <> quoted_text").isEmpty()
    d = "pmid_12345678"
    assert [r.claim_id for r in query.listed(s, "claims", d).collect()] == [r.claim_id for r in s.read("claims").orderBy("subject_name", "predicate").collect()]
    full = query.explain_fully(*(s.read(t) for t in ("claims", "claim_evidence", "study_characteristics", "funding_relationships", "assessments", "documents", "extraction_runs", "observations"))).collect()
    assert len(full) == 2 and all(r.paper.title and r.run_id == run_id and len(r.observations) == 1 and r.evidence for r in full)
    one = persist.summary(s.read("observations"), s.read("claims"), s.read("entity_mentions")).first()
    assert (one.document_id, one.claims, one.observations) == (d, 2, 2)


def test_quotes_are_scored_without_a_store(spark, tmp_path):
    import json

    from factloom import cli

    end = lambda text, cid: {"text": text, "concept_id": cid, "in_vocab": True}
    row = {"subject": end("dietary fiber", "NUTR:dietary_fiber"), "object": end("remission", "OUT:remission"), "predicate": "associated_with", "polarity": "positive", "certainty": "asserted", "failure_mode": None}
    gold = {"sentences": [{"sentence_id": "s1", "quote": "Dietary fiber was associated with remission.", "expected": [row]}]}
    path = tmp_path / "gold.json"
    path.write_text(json.dumps(gold))
    r = cli.quote_scores(spark, str(path)).first()
    assert (r.correct, r.missed, r.spurious) == (1, 0, 0)
    gold["sentences"][0]["expected"][0]["certainty"] = "sure"
    path.write_text(json.dumps(gold))
    with pytest.raises(Exception, match="unknown certainty"):
        cli.quote_scores(spark, str(path)).collect()


def test_scans_of_long_texts_are_near_linear(spark):
    import time

    rows = spark.createDataFrame([("fiber " * 80_000,)], "text string")
    hits = rows.select(F.explode(scan(F.col("text"), word_pattern(["fiber", "iron"]))).alias("x"))
    began = time.perf_counter()
    last = hits.agg(F.count("*").alias("n"), F.max("x.e").alias("e")).first()
    assert (last.n, last.e) == (80_000, 479_999) and time.perf_counter() - began < 10
