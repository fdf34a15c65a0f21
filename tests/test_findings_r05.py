"""What the findings of round 5 have shown."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factloom.functions import scan, tree
from factloom.operators import documents, parse
from factloom.plans import rules as R
from factloom.queries import ORACLES, QUERIES, raw_lines


def against_sql(spark, name, folder):
    """(rows that only the query has, rows that only its SQL has), of a folder's documents."""
    got = QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    made, stated = sorted(map(tuple, got.select(columns).collect()), key=repr), sorted(want.fetchall(), key=repr)
    extra = lambda a, b: [r for r, n in counted(a).items() for _ in range(n - counted(b).get(r, 0))]
    return extra(made, stated), extra(stated, made)


def counted(rows):
    out = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out


def documents_of(spark, folder, *texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_paragraph_numbers_beyond_three_digits(spark, tmp_path):
    """the SQL cuts a number to three digits; the operator's own ids stay distinct."""
    folder = documents_of(spark, tmp_path, "\n".join(f"line {k}" for k in range(1012)), "one\ntwo")
    assert against_sql(spark, "canonical_paragraphs", folder) == ([], [])
    ids = documents.canonical_paragraphs(raw_lines(spark, str(folder))).agg(F.count("*").alias("n"), F.count_distinct("paragraph_id").alias("ids")).first()
    assert (ids.n, ids.ids) == (1014, 1014)


PARSE_QUERIES = ["parse_spans", "parse_arguments", "parse_blocked", "parse_observations", "parse_trace"]


@pytest.mark.parametrize("name", PARSE_QUERIES)
def test_sentences_are_dealt_as_their_words(spark, name):
    """F2 to F5, F7: what is dealt by sentence is its text; tokens are laid after that, and nothing is joined, staged or read twice."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    dealt = next(k for k, line in enumerate(lines) if "RepartitionByExpression" in line)
    columns = re.search(r"Project \[(.*)\]", lines[dealt + 1])[1]
    assert columns.count("#") <= 4 and "canonical_text" in columns and "struct" not in columns
    assert "Join" not in plan and plan.count("Relation [") == 1 and plan.count("MapInArrow") == 1 and "Sort" not in plan.split("MapInArrow")[1]


def test_walk_of_many_sentences_against_one():
    rng = random.Random(5)
    arcs = ["conj", "amod", "nsubj", "advcl", "acl:relcl", "dobj", "compound", "pobj", "prep", "agent", None]
    for pool in (arcs[:7], arcs):
        of, ids, heads, deps, want = [], [], [], [], {c: [] for c in tree.ADDED}
        for s in range(400):
            n = rng.randint(1, 14)
            own = sorted(rng.sample(range(-5, 40), n))
            h = [rng.choice([*own, None, 99]) for _ in own] if s % 4 == 0 else [rng.choice([*own[:k], own[k], None]) for k in range(n)]
            d = rng.choices(pool, k=n)
            begin = len(of)
            for c, values in zip(tree.ADDED, tree.numbered(own, h, d)):
                want[c] += values if c != "up" else [begin + own.index(u) if u is not None else -1 for u in values]
            of, ids, heads, deps = of + [s] * n, ids + own, heads + h, deps + d
        got, dep = tree.walked(np.array(of), np.array(ids), pa.array(heads, pa.int32()), pa.array(deps, pa.string()))
        assert dep.to_pylist() == want.pop("dep")
        for c, values in want.items():
            assert got[c].tolist() == values, c


def test_nested_sentences_are_the_dealt_ones(spark):
    """The same arrays from rows that hold a sentence as from tokens and mentions of their own, in any order, with cut cycles, roots of their own and sentences without mentions."""
    rng = random.Random(6)
    rows = []
    for s in range(60):
        n = rng.randint(0, 9)
        ids = rng.sample(range(12), n)
        tokens = [(i, f"W{i}", f"L{i}", rng.choice(["NOUN", "VERB", None]), rng.choice(["VBG", None]), rng.choice(["conj", "nsubj", "amod", "pobj", "prep", "acl"]), rng.choice([*ids, 99, None]), i * 5) for i in ids]
        found = [(f"m{k}", "x", rng.choice(["C", None]), a, a + rng.randint(1, 9)) for k, a in enumerate(rng.choices(range(50), k=rng.randint(0, 4)))]
        rows.append((f"d{s}", f"s{s}", tokens, found))
    rows.append(("e", None, [(0, "w", "l", "NOUN", "", "ROOT", 0, 0)], []))
    schema = "document_id string, sentence_id string, tokens array<struct<i:int,text:string,lemma:string,pos:string,tag:string,dep:string,head:int,idx:int>>, found array<struct<mention_id:string,surface_text:string,concept_id:string,start_char:int,end_char:int>>"
    nested = spark.createDataFrame(rows, schema)
    dealt = parse.sentences(nested.select("document_id", "sentence_id", F.inline("tokens")), nested.select("sentence_id", F.inline("found")))
    assert sorted(dealt.collect()) == sorted(parse.nested_sentences(nested).select(dealt.columns).collect())
    with_text = parse.nested_sentences(nested.withColumn("canonical_text", F.lit("x" * 100)))
    args = [parse.bound_predicates(parse.unplaced(parse.predicates(r, mapped=False)), *t).drop("canonical_text") for r, t in ((with_text, ()), (dealt, (nested.select("document_id", F.lit("x" * 100).alias("canonical_text")),)))]
    a, b = (sorted(x.select(sorted(x.columns)).collect(), key=repr) for x in args)
    assert a == b and any(r.objects for r in a)


def test_texts_are_scanned_in_one_pass(spark):
    """pieces and matches come from one pass of the pattern, also of texts that hold the mark that the pass sets; ends are trimmed once."""
    texts = ["a; b ;c", "", ";", ";;x", f"a{scan.MARK};b{scan.MARK}", "  a  ;\tb\n", None, "no match", "😀;é;", "$1\\;$0;\\$"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scan.segments(F.col("t"), ";").alias("x"), documents.between(F.col("t"), ";").alias("y"))
    for r in rows.collect():
        t = r.t or ""
        want, at = [], 0
        for m in [*re.finditer(";", t), None]:
            end = m.start() if m else len(t)
            want.append((at, end, t[at:end], m and m.group()))
            at = m.end() if m else end
        assert [tuple(x) for x in r.x] == want
        inner = [(s + len(p) - len(p.lstrip()), p.strip()) for s, _, p, _ in want]
        assert [tuple(x) for x in r.y] == [(s, s + len(p), p) for s, p in inner if p]
    plan = spark.createDataFrame([("a",)], "t string").select(F.explode(scan.segments(F.col("t"), "z;z")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan


def test_regions_without_a_cue_meet_one_pattern(spark):
    """what one pattern of all cues does not find has the rule's own polarity; every kind of cue still tells."""
    cases = {
        "fiber helps": ("positive", "asserted", None), "there is no evidence that": ("neutral", "insufficient_evidence", "no evidence"), "we Hypothesised it": ("positive", "hypothetical", "Hypothesised"),
        "did not": ("negative", "asserted", "did not"), "it may not": ("negative", "possible", "not; may"), "in theory it might": ("positive", "hypothetical", "in theory"), "": ("positive", "asserted", None), None: ("positive", "asserted", None),
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", R.modality(F.col("t"), F.lit("positive"), F.lit(True)).alias("m"))
    assert {r.t: tuple(r.m) for r in rows.collect()} == cases
    told = rows.select("m.polarity", "m.certainty", "m.cue")._jdf.queryExecution().optimizedPlan().toString()
    assert told.count("RLIKE") == 1  # once for the three fields
