"""Each stage of the corpus pipeline on its own input, against brute force."""

import re

import corpus_pipeline
from test_against_brute_force import brute_near, brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic == 1}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "suffix-array dedup", "packing"]
    before = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            break
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            assert set(after) <= set(before) and len(after) > 0.8 * len(before)
            assert len(set(before) - set(after) - toxic) < 0.05 * len(before)
        elif name == "exact dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i] or ""), i)
            assert after == {i: before[i] for i in first.values()}
        elif name == "MinHash near-dedup":
            assert set(after) == {i for i, (_, c) in brute_near(before.items()).items() if i == c}
        else:
            want = brute_repeats(before.items())
            assert set(after) == set(before)
            assert all(after[i] == before[i] for i, w in want.items() if not w[1])
            assert all(len(after[i].encode()) <= w[0] - w[1] for i, w in want.items() if w[1])
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        before = after


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, rep long, bucket long, content string"


def through(spark, rows, tmp_path):
    """Every stage on its predecessor's output, written and read again."""
    docs, seen = spark.createDataFrame([(*r, "s", len(r[1] or ""), 0.5, 1, 2, 3, "c") for r in rows], ODD).repartition(3), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs)
    return seen


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    """Nulls in every column, empty, blank and very long texts, repeated ids and rows, and columns that have names of the operators' own."""
    long = " ".join(f"w{k}" for k in range(150_000))
    words = [f"v{k}" for k in range(120)]
    rows = [
        (1, None, "en"), (2, "", None), (3, "  ", "en"), (4, long, "de"), (5, long + " end", "de"), (6, "one two", None), (6, "one two", None), (6, "three four five", "fr"), (None, "nobody's own text", None), (None, "nobody's own text", "en"),
        (7, " ".join(words), "en"), (8, " ".join(words[:-1] + ["other"]), "en"), (9, "x " + " ".join(words[20:60]) + " y", "en"), (10, "😀 ünïcode", "es"),
    ]
    toxic, exact, near, cut, packed = through(spark, rows, tmp_path)
    assert toxic.count() >= len(rows) - 2
    left = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in exact.collect() if (r.text or "").strip())
    assert left == sorted({(-1 if i is None else i, t) for i, t, _ in rows if (t or "").strip() and toxic.filter(f"doc_id <=> {'null' if i is None else i}").count()})
    kept = {r.doc_id for r in near.collect()}
    assert not {5, 8} & kept and {4, 7, 9, 10} <= kept
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert len(texts[9]) < 40 and texts[7] == " ".join(words)
    assert {r.doc_id for r in packed.collect()} == kept


def test_empty_tables_stay_empty(spark, tmp_path):
    assert [d.count() for d in through(spark, [], tmp_path)] == [0] * 5
