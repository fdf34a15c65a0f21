"""The store: snapshots, transactions, merges by size, concurrent writers; and the vocabulary's overlay."""

import os
import random

import pytest

from factloom.sources import vocabulary
from factloom.sources.manifest import Conflict, Manifests
from factloom.sources.store import Store

CLAIM = "claim_id string, document_id string"


def claims(spark, *rows):
    return spark.createDataFrame([(c, d) for c, d in rows], CLAIM)


def ids(store):
    return sorted(r.claim_id for r in store.read("claims").collect())


def test_random_replacements_against_a_dictionary(spark, tmp_path):
    rng, want = random.Random(1), {}
    s = Store(spark, str(tmp_path / "db"))
    for k in range(12):
        docs = rng.sample("abcdefgh", rng.randint(1, 4))
        gone = rng.sample("abcdefgh", rng.randint(0, 2))
        rows = [(f"{k}{d}{j}", d) for d in docs for j in range(rng.randint(0, 2))]
        s.replace("claims", claims(spark, *rows), spark.createDataFrame([(d,) for d in docs + gone], "document_id string"))
        for d in docs + gone:
            want[d] = [c for c, e in rows if e == d]
        assert ids(s) == sorted(c for v in want.values() for c in v)
    assert len(s.deltas("claims")) < 8  # merged by size


def test_a_batch_writes_what_it_holds(spark, tmp_path):
    s = Store(spark, str(tmp_path / "db"))
    s.replace("claims", claims(spark, *((f"c{k}" * 20, f"d{k}") for k in range(5000))))

    def size():
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tmp_path / "db" / "claims") for f in names if f.endswith(".parquet")}

    before = size()
    s.replace("claims", claims(spark, ("x", "d7")))
    more = {f: n for f, n in size().items() if f not in before}
    assert sum(more.values()) < 0.2 * sum(before.values()) and set(before) <= set(size())
    assert s.read("claims").count() == 5000 and s.read("claims").filter("document_id = 'd7'").first().claim_id == "x"


def test_a_failed_transaction_leaves_the_old_snapshot(spark, tmp_path):
    s = Store(spark, str(tmp_path / "db"))
    s.replace("claims", claims(spark, ("a", "d")))
    s.replace("entities", spark.createDataFrame([("C:a", "A", "t")], "concept_id string, canonical_name string, entity_type string"))
    at = s.version()
    with pytest.raises(ZeroDivisionError):
        with s.transaction():
            s.replace("claims", claims(spark, ("b", "d")))
            assert ids(s) == ["b"] and ids(Store(spark, s.path)) == ["a"]  # seen inside, and by nobody else
            raise ZeroDivisionError
    assert s.version() == at and ids(s) == ["a"]
    with s.transaction():
        s.replace("claims", claims(spark, ("c", "e")))
        s.replace("entities", spark.createDataFrame([("C:b", "B", "t")], "concept_id string, canonical_name string, entity_type string"))
    assert ids(s) == ["a", "c"] and s.read("entities").count() == 2
    old = Store(spark, s.path, snapshot=at)
    assert ids(old) == ["a"] and old.read("entities").count() == 1
    with pytest.raises(PermissionError):
        old.replace("claims", claims(spark, ("z", "z")))


def test_ingest_that_dies_between_tables(spark, tmp_path, monkeypatch):
    from factloom.plans import persist
    from factloom.queries import PUBMED

    raw = spark.createDataFrame([("12345678", "pubmed.xml", bytearray(PUBMED))], "pmid string, name string, content binary")
    s = Store(spark, str(tmp_path / "db"))
    monkeypatch.setattr(persist, "persist_extraction", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        persist.ingest(s, raw)
    assert s.version() == -1 and s.read("documents").count() == 0


def test_two_writers(spark, tmp_path):
    one, two = Store(spark, str(tmp_path / "db")), Store(spark, str(tmp_path / "db"))
    with one.transaction():
        one.replace("claims", claims(spark, ("a", "d")))
        two.replace("claims", claims(spark, ("b", "e")))
    assert ids(one) == ids(two) == ["a", "b"]


def test_vacuum_keeps_what_snapshots_need(spark, tmp_path):
    s = Store(spark, str(tmp_path / "db"), merges=False)
    for k in range(3):
        s.replace("claims", claims(spark, (f"c{k}", "d")))
    s.merges = True
    s.merge("claims")
    assert len(s.deltas("claims")) == 1 and ids(s) == ["c2"]
    with pytest.raises(ZeroDivisionError):
        with s.transaction():
            s.replace("claims", claims(spark, ("lost", "d")))
            raise ZeroDivisionError
    assert len(os.listdir(tmp_path / "db" / "claims" / "rows")) == 5
    s.vacuum()
    assert len(os.listdir(tmp_path / "db" / "claims" / "rows")) == 5  # younger than a day
    s.vacuum(seconds=-10)
    assert len(os.listdir(tmp_path / "db" / "claims" / "rows")) == 1 and ids(s) == ["c2"]


def test_merges_keep_what_is_replaced_in_older_deltas(spark, tmp_path):
    s = Store(spark, str(tmp_path / "db"))
    s.replace("claims", claims(spark, *((f"c{k}", f"d{k}") for k in range(2000))))
    for k in range(6):
        s.replace("claims", claims(spark), spark.createDataFrame([(f"d{k}",)], "document_id string"))
    assert s.read("claims").count() == 1994 and len(s.deltas("claims")) <= 4


def test_incomplete_manifests_are_skipped(spark, tmp_path):
    m = Manifests(spark, str(tmp_path / "m"))
    assert m.latest() == (-1, {})
    m.commit(0, {"a": 1})
    (tmp_path / "m" / "000000000001.json").write_text('{"a": ')
    assert m.latest() == (0, {"a": 1})
    with pytest.raises(Conflict):
        m.commit(1, {"a": 2})
    m.commit(2, {"a": 3})
    assert m.latest() == (2, {"a": 3})


def test_overlay_is_saved_whole_or_not_at_all(spark, tmp_path):
    built = vocabulary.concepts(spark)
    one, two = (vocabulary.Overlay(spark, str(tmp_path / "overlay")) for _ in range(2))
    assert one.digest() is None
    new = ("NUTR:boron", "Boron", "nutrient", ["boron", "Boron", " "])
    one.add(built, *new)
    assert one.digest() is not None and [r.concept_id for r in one.effective(built).filter("origin = 'custom'").collect()] == ["NUTR:boron"]
    assert one.effective(built).filter("concept_id = 'NUTR:boron'").first().surface_forms == ["boron"]
    with pytest.raises(vocabulary.Exists):
        two.add(built, *new)
    seen = two.digest()
    one.edit(built, "NUTR:iron", "Iron", "nutrient", ["iron", "ferrum"])
    with pytest.raises(Conflict):  # two has not seen that edit
        two.remove(built, "NUTR:boron", expected=seen)
    assert one.effective(built).filter("concept_id = 'NUTR:iron'").first().origin == "overridden"
    one.remove(built, "NUTR:iron")
    one.remove(built, "NUTR:boron")
    left = {r.concept_id for r in two.effective(built).collect()}
    assert "NUTR:iron" not in left and "NUTR:boron" not in left and len(left) == built.count() - 1
    for bad in (lambda: one.edit(built, "NUTR:none", "N", "t", ["n"]), lambda: one.remove(built, "NUTR:boron")):
        with pytest.raises(KeyError):
            bad()
    for form in (("boron", "B", "t", ["b"]), ("NUTR:x", "X", "t", [" "])):
        with pytest.raises(ValueError):
            one.add(built, *form)
