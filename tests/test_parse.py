"""Numbered trees and grammatical binding on hand-made parses: one sentence to each case."""

import random

import pytest

from factloom.functions import tree
from factloom.operators import binding, mentions, parse
from factloom.sources import vocabulary

TOKENS = "document_id string, sentence_id string, i int, text string, lemma string, pos string, tag string, dep string, head int, idx int"
FOUND = "mention_id string, document_id string, sentence_id string, surface_text string, concept_id string, entity_type string, start_char int, end_char int"

#: word/lemma/pos/tag/arc/head - the words that are mentions (a star: without a concept) - expected (subject, predicate, object, polarity), and whether the sentence is blocked.
CASES = {
    "coordination": (
        "Fiber/fiber/NOUN/NN/nsubj/3 and/and/CCONJ/CC/cc/0 iron/iron/NOUN/NN/conj/0 reduced/reduce/VERB/VBD/ROOT/3 CRP/crp/NOUN/NN/dobj/3 and/and/CCONJ/CC/cc/4 pain/pain/NOUN/NN/conj/4",
        ["Fiber", "iron", "CRP", "pain"], [(s, "decreases", o, "positive") for s in ("Fiber", "iron") for o in ("CRP", "pain")], False),
    "apposition list": (
        "Fiber/fiber/NOUN/NN/nsubj/1 decreases/decrease/VERB/VBZ/ROOT/1 iron/iron/NOUN/NN/dobj/1 CRP/crp/NOUN/NN/appos/2 and/and/CCONJ/CC/cc/2 pain/pain/NOUN/NN/conj/2",
        ["Fiber", "iron", "CRP", "pain"], [("Fiber", "decreases", o, "positive") for o in ("iron", "CRP", "pain")], False),
    "lone apposition": (
        "Fiber/fiber/NOUN/NN/nsubj/1 decreases/decrease/VERB/VBZ/ROOT/1 iron/iron/NOUN/NN/dobj/1 CRP/crp/NOUN/NN/appos/2",
        ["Fiber", "iron", "CRP"], [("Fiber", "decreases", "iron", "positive")], False),
    "shared subject": (
        "Fiber/fiber/NOUN/NN/nsubj/1 reduced/reduce/VERB/VBD/ROOT/1 CRP/crp/NOUN/NN/dobj/1 but/but/CCONJ/CC/cc/1 increased/increase/VERB/VBD/conj/1 pain/pain/NOUN/NN/dobj/4",
        ["Fiber", "CRP", "pain"], [("Fiber", "decreases", "CRP", "positive"), ("Fiber", "increases", "pain", "positive")], False),
    "negation": (
        "Fiber/fiber/NOUN/NN/nsubj/3 did/do/AUX/VBD/aux/3 n't/n't/PART/RB/neg/3 reduce/reduce/VERB/VB/ROOT/3 CRP/crp/NOUN/NN/dobj/3",
        ["Fiber", "CRP"], [("Fiber", "decreases", "CRP", "negative")], False),
    "risk": (
        "Fiber/fiber/NOUN/NN/nsubj/1 reduced/reduce/VERB/VBD/ROOT/1 risk/risk/NOUN/NN/dobj/1 of/of/ADP/IN/case/4 cancer/cancer/NOUN/NN/nmod/2 and/and/CCONJ/CC/cc/4 pain/pain/NOUN/NN/conj/4",
        ["Fiber", "cancer", "pain"], [("Fiber", "reduces_risk", o, "positive") for o in ("cancer", "pain")], False),
    "risk by prepositions": (
        "Fiber/fiber/NOUN/NN/nsubj/1 reduced/reduce/VERB/VBD/ROOT/1 risk/risk/NOUN/NN/dobj/1 of/of/ADP/IN/prep/2 cancer/cancer/NOUN/NN/pobj/3",
        ["Fiber", "cancer"], [("Fiber", "reduces_risk", "cancer", "positive")], False),
    "lower risk": (
        "Fiber/fiber/NOUN/NN/nsubjpass/2 was/be/AUX/VBD/auxpass/2 associated/associate/VERB/VBN/ROOT/2 with/with/ADP/IN/case/5 lower/low/ADJ/JJR/amod/5 risk/risk/NOUN/NN/nmod/2 of/of/ADP/IN/case/7 cancer/cancer/NOUN/NN/nmod/5",
        ["Fiber", "cancer"], [("Fiber", "reduces_risk", "cancer", "positive")], False),
    "reduced object": (
        "Fiber/fiber/NOUN/NN/nsubjpass/2 was/be/AUX/VBD/auxpass/2 associated/associate/VERB/VBN/ROOT/2 with/with/ADP/IN/case/5 reduced/reduce/VERB/VBN/amod/5 CRP/crp/NOUN/NN/nmod/2",
        ["Fiber", "CRP"], [("Fiber", "associated_with_reduced", "CRP", "positive")], False),
    "measure nouns": (
        "Intake/intake/NOUN/NN/nsubj/3 of/of/ADP/IN/case/2 iron/iron/NOUN/NN/nmod/0 increased/increase/VERB/VBD/ROOT/3 levels/level/NOUN/NNS/dobj/3 of/of/ADP/IN/case/6 CRP/crp/NOUN/NN/nmod/4",
        ["iron", "CRP"], [("iron", "increases", "CRP", "positive")], False),
    "relative clause": (
        "Foods/food/NOUN/NNS/nsubj/6 that/that/PRON/WDT/nsubj/2 increase/increase/VERB/VBP/acl:relcl/0 CRP/crp/NOUN/NN/dobj/2 are/be/AUX/VBP/cop/6 often/often/ADV/RB/advmod/6 sweet/sweet/ADJ/JJ/ROOT/6",
        ["Foods", "CRP"], [("Foods", "increases", "CRP", "positive")], False),
    "participle of a noun": (
        "We/we/PRON/PRP/nsubj/1 saw/see/VERB/VBD/ROOT/1 fiber/fiber/NOUN/NN/dobj/1 associated/associate/VERB/VBN/acl/2 with/with/ADP/IN/case/5 pain/pain/NOUN/NN/nmod/3",
        ["fiber", "pain"], [("fiber", "associated_with", "pain", "positive")], False),
    "result participle": (
        "Inflammation/inflammation/NOUN/NN/nsubj/1 induces/induce/VERB/VBZ/ROOT/1 dysbiosis/dysbiosis/NOUN/NN/dobj/1 decreasing/decrease/VERB/VBG/advcl/1 iron/iron/NOUN/NN/dobj/3",
        ["Inflammation", "dysbiosis", "iron"], [("Inflammation", "causes", "dysbiosis", "positive"), ("dysbiosis", "has_decreased_abundance_of", "iron", "neutral")], False),
    "descriptor": (
        "Dysbiosis/dysbiosis/NOUN/NN/nsubjpass/2 is/be/AUX/VBZ/auxpass/2 characterized/characterize/VERB/VBN/ROOT/2 by/by/ADP/IN/case/4 changes/change/NOUN/NNS/nmod/2 in/in/ADP/IN/case/6 iron/iron/NOUN/NN/nmod/4",
        ["Dysbiosis", "iron"], [("Dysbiosis", "characterized_by", "changes in iron", "neutral")], False),
    "free text object": (
        "Fiber/fiber/NOUN/NN/nsubj/1 reduced/reduce/VERB/VBD/ROOT/1 disease/disease/NOUN/NN/compound/3 activity/activity/NOUN/NN/dobj/1 and/and/CCONJ/CC/cc/3 markers/marker/NOUN/NNS/conj/3 of/of/ADP/IN/case/7 pain/pain/NOUN/NN/nmod/5",
        ["Fiber", "pain"], [("Fiber", "decreases", "disease activity", "positive"), ("Fiber", "decreases", "markers", "positive")], False),
    "copular list": (
        "Foods/food/NOUN/NNS/nsubj/1 reported/report/VERB/VBN/ROOT/1 to/to/PART/TO/aux/3 reduce/reduce/VERB/VB/xcomp/1 pain/pain/NOUN/NN/dobj/3 were/be/AUX/VBD/cop/6 kale/kale/NOUN/NN/conj/1 and/and/CCONJ/CC/cc/6 tomato/tomato/NOUN/NN/conj/6",
        ["Foods", "pain", "kale", "tomato"], [(s, "decreases", "pain", "positive") for s in ("kale", "tomato")], False),
    "copular head": (
        "Foods/food/NOUN/NNS/nsubj/2 were/be/AUX/VBD/cop/2 kale/kale/NOUN/NN/ROOT/2 and/and/CCONJ/CC/cc/2 tomato/tomato/NOUN/NN/conj/2 and/and/CCONJ/CC/cc/2 reduced/reduce/VERB/VBD/conj/2 pain/pain/NOUN/NN/dobj/6",
        ["Foods", "pain", "kale", "tomato"], [(s, "decreases", "pain", "positive") for s in ("kale", "tomato")], False),
    "predicational copula": (
        "Diet/diet/NOUN/NN/nsubj/2 was/be/AUX/VBD/cop/2 safe/safe/ADJ/JJ/ROOT/2 and/and/CCONJ/CC/cc/2 reduced/reduce/VERB/VBD/conj/2 pain/pain/NOUN/NN/dobj/4",
        ["Diet", "pain"], [("Diet", "decreases", "pain", "positive")], False),
    "control": (
        "Diet/diet/NOUN/NN/nsubjpass/2 was/be/AUX/VBD/auxpass/2 shown/show/VERB/VBN/ROOT/2 in/in/ADP/IN/case/4 remission/remission/NOUN/NN/nmod/2 to/to/PART/TO/aux/6 reduce/reduce/VERB/VB/xcomp/2 pain/pain/NOUN/NN/dobj/6",
        ["Diet", "remission", "pain"], [("Diet", "decreases", "pain", "positive"), ("remission", "decreases", "pain", "positive")], False),
    "gerund subject": (
        "Eating/eat/VERB/VBG/csubj/3 of/of/ADP/IN/case/2 kefir/kefir/NOUN/NN/nmod/0 improves/improve/VERB/VBZ/ROOT/3 pain/pain/NOUN/NN/dobj/3",
        ["kefir", "pain"], [("kefir", "improves", "pain", "positive")], False),
    "subject is no entity": (
        "Care/care/NOUN/NN/nsubj/3 in/in/ADP/IN/case/2 IBD/ibd/NOUN/NN/nmod/0 reduces/reduce/VERB/VBZ/ROOT/3 pain/pain/NOUN/NN/dobj/3",
        ["IBD", "pain"], [], True),
    "modifier without a concept": (
        "Early/early/ADJ/JJ/amod/1 diet/diet/NOUN/NN/nsubj/2 reduces/reduce/VERB/VBZ/ROOT/2 pain/pain/NOUN/NN/dobj/2",
        ["Early*", "pain"], [], True),
    "modifier with a concept": (
        "Vegetable/vegetable/NOUN/NN/compound/1 meals/meal/NOUN/NNS/nsubj/2 reduce/reduce/VERB/VBP/ROOT/2 pain/pain/NOUN/NN/dobj/2",
        ["Vegetable", "pain"], [("Vegetable", "decreases", "pain", "positive")], False),
    "pronoun": ("They/they/PRON/PRP/nsubj/1 reduce/reduce/VERB/VBP/ROOT/1 pain/pain/NOUN/NN/dobj/1", ["pain"], [], False),
    "participle of no entity": (
        "We/we/PRON/PRP/nsubj/1 saw/see/VERB/VBD/ROOT/1 care/care/NOUN/NN/dobj/1 associated/associate/VERB/VBN/acl/2 with/with/ADP/IN/case/5 pain/pain/NOUN/NN/nmod/3",
        ["pain"], [], False),
    "no verb": ("Fiber/fiber/NOUN/NN/ROOT/0 and/and/CCONJ/CC/cc/0 pain/pain/NOUN/NN/conj/0", ["Fiber", "pain"], [], False),
}


def laid_out(spark):
    tokens, found, texts = [], [], []
    for name, (spec, held, _, _) in CASES.items():
        text = " ".join(w.split("/")[0] for w in spec.split())
        at = 0
        for k, w in enumerate(spec.split()):
            word, lemma, pos, tag, dep, head = w.split("/")
            tokens.append((name, name, k, word, lemma, pos, tag, dep, int(head), at))
            at += len(word) + 1
        for w in held:
            surface = w.rstrip("*")
            start = text.index(surface)
            found.append((f"{name}:{surface}", name, name, surface, None if "*" in w else f"C:{surface}", "x", start, start + len(surface)))
        texts.append((name, text))
    texts = spark.createDataFrame(texts, "document_id string, canonical_text string")
    sents = texts.selectExpr("document_id as sentence_id", "document_id", "0 as start_char", "length(canonical_text) as end_char", "canonical_text as text")
    return spark.createDataFrame(tokens, TOKENS).repartition(3), spark.createDataFrame(found, FOUND), texts, sents


@pytest.fixture(scope="module")
def bound(spark):
    tokens, found, texts, sents = laid_out(spark)
    rows = parse.bind(tokens, found, texts)
    return rows, parse.parse_observations(rows, sents).collect(), {r.sentence_id for r in parse.blocked_sentences(rows).collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_binding(bound, name):
    _, obs, blocked = bound
    got = sorted((r.subject_text, r.predicate, r.object_text, r.polarity) for r in obs if r.sentence_id == name)
    assert got == sorted(CASES[name][2])
    assert (name in blocked) == CASES[name][3]


def test_free_text_has_no_concept(bound):
    made = {r.object_text: r for r in bound[1] if r.sentence_id == "free text object"}
    assert all(r.object_concept_id is None and "descriptor" in r.object_mention_id for r in made.values())


def test_conditions_become_qualifiers(spark, bound):
    rows, obs, _ = bound
    quals = parse.parse_qualifiers(rows, mentions.surface_index(vocabulary.disease_states(spark))).collect()
    of = {r.clause_id for r in obs if r.sentence_id == "control"}
    assert [(q.qualifier_type, q.value_concept_id) for q in quals if q.clause_id in of] == [("disease_state", "DS:remission")]


def test_blocked_sentences_get_no_flat_observation(spark, bound):
    rows, _, blocked = bound
    _, _, _, sents = laid_out(spark)
    parsed = parse.parse_observations(rows, sents)
    flat = parsed.limit(1).selectExpr("'f1' as observation_id", "'x' as document_id", "'subject is no entity' as sentence_id", *parsed.columns[3:])
    more = parsed.limit(1).selectExpr("'f2' as observation_id", "'x' as document_id", "'pronoun' as sentence_id", *parsed.columns[3:])
    ids = {r.observation_id for r in binding.with_fallback(parsed, parse.blocked_sentences(rows), flat.unionByName(more)).collect()}
    assert "f2" in ids and "f1" not in ids and "subject is no entity" in blocked


def test_parse_modifiers(spark):
    specs = {
        "site": ("Dysbiosis/dysbiosis/NOUN/NN/nsubj/5 of/of/ADP/IN/case/4 the/the/DET/DT/det/4 gut/gut/NOUN/NN/compound/4 microbiome/microbiome/NOUN/NN/nmod/0 persists/persist/VERB/VBZ/ROOT/5", ["Dysbiosis"]),
        "unknown": ("Pain/pain/NOUN/NN/nsubj/4 within/within/ADP/IN/case/3 the/the/DET/DT/det/3 elbow/elbow/NOUN/NN/nmod/0 persists/persist/VERB/VBZ/ROOT/4", ["Pain"]),
        "condition": ("Pain/pain/NOUN/NN/nsubj/3 on/on/ADP/IN/case/2 Sundays/sunday/PROPN/NNP/nmod/0 persists/persist/VERB/VBZ/ROOT/3", ["Pain"]),
    }
    tokens, found, texts = [], [], []
    for name, (spec, held) in specs.items():
        text, at = " ".join(w.split("/")[0] for w in spec.split()), 0
        for k, w in enumerate(spec.split()):
            word, lemma, pos, tag, dep, head = w.split("/")
            tokens.append((name, name, k, word, lemma, pos, tag, dep, int(head), at))
            at += len(word) + 1
        found += [(f"{name}:{w}", name, name, w, f"C:{w}", "x", text.index(w), text.index(w) + len(w)) for w in held]
        texts.append((name, text))
    tree_rows = parse.parse_tree(spark.createDataFrame(tokens, TOKENS))
    index = mentions.surface_index(vocabulary.concepts(spark))
    mods = parse.modifiers(tree_rows, spark.createDataFrame(found, FOUND), spark.createDataFrame(texts, "document_id string, canonical_text string"), index)
    got = sorted((r.sentence_id, r.relation, r.preposition, r.value_concept_id, r.value_text, r.status) for r in mods.collect())
    assert got == [("site", "localized_in", "of", "BIOM:gut_microbiota", "gut microbiome", "normalized"), ("unknown", "qualified_by", "within", None, "elbow", "unmatched")]
    floor = mods.limit(0).unionByName(spark.createDataFrame([("condition", "condition", "o", "qualified_by", "of", None, "v", None, "unmatched"), ("site", "site", "o", "qualified_by", "of", None, "v", None, "unmatched")], mods.schema))
    assert sorted(r.sentence_id for r in parse.modifiers_with_floor(mods, floor).collect()) == ["condition", "site", "unknown"]


def brute_tree(heads):
    n = len(heads)
    up = [h if h is not None and 0 <= h < n and h != k else None for k, h in enumerate(heads)]
    below = [set() for _ in range(n)]
    for k in range(n):
        x, seen = k, set()
        while x is not None and x not in seen:
            below[x].add(k)
            seen.add(x)
            x = up[x]
    return up, below


def test_numbering_against_plain_walks():
    rng = random.Random(8)
    arcs = ["conj", "amod", "nsubj", "advcl", "acl:relcl", "dobj", "compound"]
    for _ in range(300):
        n = rng.randint(1, 14)
        order = rng.sample(range(n), n)
        heads = [None] * n
        for at, k in enumerate(order):  # heads come earlier in a random order: a forest
            heads[k] = rng.choice(order[:at] + [k, None, 99])
        deps = rng.choices(arcs, k=n)
        up, below = brute_tree(heads)
        got = dict(zip(tree.ADDED, tree.numbered(list(range(n)), heads, deps)))
        assert got["up"] == up
        for x in range(n):
            assert {y for y in range(n) if got["pre"][x] <= got["pre"][y] <= got["last"][x]} == below[x]
            for way, allowed in tree.WAYS.items():
                reached = {y for y in below[x] if got[f"off_{way}"][y] == got[f"off_{way}"][x]}
                want = set()
                for y in below[x]:
                    z, ok = y, True
                    while z != x:
                        ok &= (deps[z].split(":")[0] if way == "clause" else deps[z]) in allowed
                        z = up[z]
                    want |= {y} if ok else set()
                assert reached == want


def test_cycles_are_cut():
    got = dict(zip(tree.ADDED, tree.numbered([0, 1, 2], [1, 0, 1], ["a", "b", "c"])))
    assert got["up"].count(None) == 1 and sorted(got["pre"]) == [0, 1, 2]


def test_trees_across_batches(spark):
    rows = [(f"s{k // 7}", k % 7, (k % 7 - 1) // 2 if k % 7 else 0, "conj", f"w{k}") for k in range(7000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = tree.dependency_tree(spark.createDataFrame(rows, "sentence_id string, i int, head int, dep string, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 7000 and {(r.i, r.pre, r.last, r.depth) for r in got} == {(0, 0, 6, 0), (1, 1, 3, 1), (2, 4, 6, 1), (3, 2, 2, 2), (4, 3, 3, 2), (5, 5, 5, 2), (6, 6, 6, 2)}


@pytest.mark.parametrize("name, shuffles", [("parse_spans", 1), ("parse_arguments", 1), ("parse_blocked", 2), ("parse_trace", 5)])
def test_parses_are_dealt_once(spark, name, shuffles):
    from factloom.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("Exchange hashpartitioning") <= shuffles and "staged/" not in plan
