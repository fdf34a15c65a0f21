"""Acquisition from recorded responses, generated relations, and table functions."""

import json

import pytest
from pyspark.sql import functions as F

from factloom.functions import udtf
from factloom.operators import mentions
from factloom.queries import JATS, PUBMED
from factloom.sources import recorded


@pytest.fixture
def folder(tmp_path):
    for pmid, link, full in (("7", None, False), ("12", {"pmcid": "PMC1"}, True), ("100", {"pmcid": "PMC2"}, False), ("205", "broken", False)):
        d = tmp_path / pmid
        d.mkdir()
        (d / "pubmed.xml").write_bytes(PUBMED)
        if link:
            (d / "link.json").write_text(json.dumps(link) if link != "broken" else "{")
        if full:
            (d / "pmc.xml").write_bytes(JATS)
    (tmp_path / "notes").mkdir()
    return str(tmp_path)


def read(spark, folder, **options):
    recorded.register(spark)
    return spark.read.format("recorded_responses").options(path=folder, **options).load()


def test_recorded_responses(spark, folder):
    rows = read(spark, folder, retrieved="2020-01-01")
    got = sorted((r.id, r.name, r.status, r.pmcid, r.content is not None) for r in rows.collect())
    assert got == [(7, "pubmed.xml", 200, None, True), (12, "pmc.xml", 200, "PMC1", True), (12, "pubmed.xml", 200, "PMC1", True), (100, "pmc.xml", 404, "PMC2", False), (100, "pubmed.xml", 200, "PMC2", True), (205, "pubmed.xml", 200, None, True)]
    assert {r.retrieved for r in rows.collect()} == {"2020-01-01"}
    assert recorded.raw_files(rows).count() == 5 and [r.pmid for r in recorded.failed(rows).collect()] == ["100"]


def test_a_missing_paper_stops_no_others(spark, folder):
    rows = read(spark, folder, ids="7, 8,12", partitions="2")
    assert sorted((r.id, r.name, r.status) for r in rows.collect()) == [(7, "pubmed.xml", 200), (8, "pubmed.xml", 404), (12, "pmc.xml", 200), (12, "pubmed.xml", 200)]


@pytest.mark.parametrize("condition, ids", [("id = 12", {12}), ("id in (7, 100, 9)", {7, 9, 100}), ("id > 7 and id <= 100", {12, 100}), ("id >= 12 and id < 205 and pmid <> '12'", {100}), ("pmid = '7'", {7}), ("pmid in ('007', '12')", {12}), ("pmid = 'x'", set()), ("status = 404", {100})])
def test_conditions_reach_the_source(spark, folder, condition, ids):
    assert {r.id for r in read(spark, folder).filter(condition).collect()} == ids


def test_pushed_conditions_narrow_what_is_listed(folder):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = recorded.RecordedReader({"path": folder})
    assert list(reader.pushFilters([GreaterThan(("id",), 7), EqualTo(("status",), 200)])) == [EqualTo(("status",), 200)]
    assert reader.ids() == [12, 100, 205]
    assert list(reader.pushFilters([In(("id",), (100, None, 7))])) == [] and reader.ids() == [100]
    assert [p.ids for p in recorded.RecordedReader({"path": folder, "partitions": "3"}).partitions()] == [[7, 12], [100, 205]]


def test_triples_are_decoded(spark):
    cases = {
        "<s><triplet> Fiber <subj> pain <obj> reduces</s>": [("Fiber", "reduces", "pain")],
        "<triplet> Fiber  rich <subj> pain <obj> reduces <subj> CRP <obj> lowers<triplet> iron <subj> pain <obj> causes": [("Fiber rich", "reduces", "pain"), ("Fiber rich", "lowers", "CRP"), ("iron", "causes", "pain")],
        "<triplet> a <subj> b <obj> c <triplet> a <subj> b <obj> c": [("a", "c", "b")],
        "<triplet> a <subj> b": [], "<triplet> a <subj> <obj> c": [], "no relation": [], "": [], None: [],
    }
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "k int, t string").select("k", mentions.decoded_triples(F.col("t")).alias("x")).collect()
    assert {r.k: [tuple(x) for x in r.x] for r in rows} == dict(enumerate(cases.values()))


def test_confidence_is_a_probability(spark):
    rows = [([-0.5, -1.5],), ([0.5],), ([-1000.0],), ([],), (None,), ([None, -1.0],), ([float("nan")],)]
    got = [r.c for r in spark.createDataFrame(rows, "p array<double>").select(mentions.sequence_confidence(F.col("p")).alias("c")).collect()]
    assert got[0] == pytest.approx(0.36787944) and got[1:] == [1.0, 0.0, 1.0, 1.0, 1.0, 1.0]


def test_relations_and_their_ends(spark):
    sents = spark.createDataFrame([("d", "s1", 0, 20, "Fiber reduces pain."), ("d", "s2", 20, 30, "Nothing.")], "document_id string, sentence_id string, start_char int, end_char int, text string")
    out = spark.createDataFrame([("s1", "<triplet> fiber <subj> Pain <obj> reduces", [-0.1]), ("s1", "<triplet> x <subj> y <obj> z", [-3.0]), ("s2", "nothing", [-0.1])], "sentence_id string, generated string, log_probabilities array<double>")
    found = spark.createDataFrame([("m1", "s1", "Fiber", "N:f", 0, 5), ("m2", "s1", "fiber", "N:g", 6, 9)], "mention_id string, sentence_id string, surface_text string, concept_id string, start_char int, end_char int")
    rel = mentions.generated_relations(sents, out, "model", "1")
    row = mentions.placed_triples(rel, found).collect()
    assert [(r.subject_mention_id, r.subject_concept_id, r.relation, r.object_mention_id) for r in row] == [("m1", "N:f", "reduces", None)]
    other = mentions.generated_relations(sents, out, "other", "1").first()
    assert rel.first().open_observation_id != other.open_observation_id and rel.count() == 1


def test_table_functions(spark):
    udtf.register(spark, lambda t: [(0, 2, "two", 0.5)] if len(t) > 2 else [])
    spark.createDataFrame([(1, "😀 Fiber fiber"), (2, None), (3, "")], "k int, t string").createOrReplaceTempView("udtf_texts")
    got = spark.sql("SELECT k, s.* FROM udtf_texts, LATERAL scan_spans(t, 'fiber') s").collect()
    assert [tuple(r) for r in got] == [(1, 2, 7, "Fiber"), (1, 8, 13, "fiber")]
    assert [tuple(r) for r in spark.sql("SELECT k, s.* FROM udtf_texts, LATERAL detect_spans(t) s").collect()] == [(1, 0, 2, "😀 ", "two", 0.5)]
    spark.createDataFrame([(JATS.decode(),), ("<broken",)], "x string").createOrReplaceTempView("udtf_articles")
    assert [(r.section_title, r.raw_text) for r in spark.sql("SELECT s.* FROM udtf_articles, LATERAL markup_sections(x) s").collect()] == [(None, "Loose."), ("Methods", "We did it."), ("Statistics", "Tests."), (None, "End.")]
    pieces = spark.sql("SELECT * FROM running_offsets(TABLE(SELECT * FROM VALUES ('a', 2, 'yy'), ('a', 1, 'x'), ('b', 1, 'z') AS t(id, k, text)), 1)")
    assert sorted(tuple(r) for r in pieces.collect()) == [("a", 1, 0, 1, "x"), ("a", 2, 2, 4, "yy"), ("b", 1, 0, 1, "z")]


@pytest.mark.parametrize("call", ["scan_spans(t, t)", "scan_spans(k, 'x')", "scan_spans(t, '(')"])
def test_wrong_arguments_are_refused_before_anything_runs(spark, call):
    udtf.register(spark)
    spark.createDataFrame([(1, "a")], "k int, t string").createOrReplaceTempView("udtf_texts")
    with pytest.raises(Exception):
        spark.sql(f"SELECT * FROM udtf_texts, LATERAL {call} s").schema
