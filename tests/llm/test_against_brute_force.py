"""Operators against plain Python versions of their contracts, on adversarial fixtures and the smallest tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from factloom.llm import bpe, cover_search, exact_dedup, language_id, lm_scoring, near_dedup, packing, suffix_dedup
from factloom.llm import queries as Q
from factloom.llm.scratch import released

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig string, label string, n int"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, None, "x", "y", 1) for i, t in zip(ids, texts)], DOCS).repartition(3)


def fixture_texts(seed=0):
    """Exact, near and passage copies, nulls, empties, blanks, repeats, a very long text and unusual characters."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéßñ", k=rng.randint(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choices(words, k=40))
    base = [rng.choices(words, k=rng.randint(1, 120)) for _ in range(25)]
    texts = [" ".join(b) for b in base]
    for b in base[:12]:
        for _ in range(4):
            c = list(b)
            for _ in range(rng.randint(0, 3)):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append((" " if rng.random() < 0.5 else "\t\n").join(c))
    for _ in range(12):
        texts.append(" ".join(rng.choices(words, k=20)) + " " + passage + " " + " ".join(rng.choices(words, k=20)))
    texts += [passage, passage * 2, None, "", " ", "\n", "a", "a a a a", "ab" * 200, "ab" * 210, "x" * 49, "x" * 50, "x" * 51, "x" * 500, "😀" * 30, "it's <|endoftext|> 12's  \n\n x y", "A B C D E F", "a b c d e f"]
    texts.append(" ".join(rng.choices(words, k=20000)))
    texts += rng.choices([t for t in texts if t], k=8)
    return texts


def brute_repeats(rows, length=50):
    docs = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in docs:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\x01" * length
        out[i] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def brute_near(rows, percent=75):
    lower = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("seed", [0, 1])
def test_suffix_dedup(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(suffix_dedup, "HOT", 3)
        monkeypatch.setattr(suffix_dedup, "HOT_BUCKET", 5)
        monkeypatch.setattr(suffix_dedup, "PART", 500)
    texts = fixture_texts(seed)
    ids = list(range(100, 100 + len(texts)))
    random.Random(seed).shuffle(ids)
    got = suffix_dedup.digests(frame(spark, texts, ids)).collect()
    want = brute_repeats(zip(ids, texts))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert sum(r.n_removed for r in got) > 10_000


def test_suffix_dedup_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in Q.op1_suffix_dedup(spark, SF).collect()}
    assert got == brute_repeats([(r.doc_id, r.text) for r in rows])


def test_suffix_dedup_texts(spark):
    texts = fixture_texts(3)
    docs = frame(spark, texts)
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    want = brute_repeats(enumerate(texts))
    assert suffix_dedup.remove_repeats(docs).columns == docs.columns
    for i, t in enumerate(texts):
        n, removed, spans, digest = want[i]
        if t is None or not removed:
            assert out[i].text == t
        elif t.isascii():
            assert hashlib.sha256(out[i].text.encode()).hexdigest() == digest


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_near_dedup(spark, seed):
    texts = fixture_texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(frame(spark, texts)).collect()}
    assert got == brute_near(enumerate(texts))


def test_near_dedup_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op5_minhash_near_dedup(spark, SF).collect()}
    assert got == brute_near([(r.doc_id, r.text) for r in rows])


@pytest.mark.parametrize("block", [1000, 7])
def test_near_dedup_hubs(spark, block, monkeypatch):
    """Hubs of middle ids link spokes that share buckets with each other but are no links; pairs hide among such spokes."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(11)
    texts = []
    for h in range(5):
        base = [f"w{h}x{k}" for k in range(400)]
        own = []
        for d in range(60):
            c = list(base)
            for k in rng.sample(range(5, 395, 6), 10 if h < 3 else 12):
                c[k] = f"s{d}y{k}"
            own.append(c)
        if h < 3:
            own.insert(30, base)
        else:
            own += [[*own[7][:-1], "z"], [*own[21][:-1], "z"]]
        texts += [" ".join(c) for c in own]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(frame(spark, texts)).collect()}
    assert got == brute_near(enumerate(texts))


@pytest.mark.parametrize("key", [None, "length"])
def test_exact_dedup(spark, key):
    """With the length as the key, most keys chain several texts."""
    from pyspark.sql import functions as F

    texts = fixture_texts(4)
    more = {} if key is None else {"key": lambda c: F.length(c).cast("long"), "capacity": 2}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(frame(spark, texts), **more).collect()}
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, t in enumerate(norm):
        groups[t].append(i)
    want = {i: (min(groups[t]), len(groups[t]), min(groups[t]) == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)}
    assert got == want
    kept = exact_dedup.deduplicate(frame(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, w in want.items() if w[2])


def test_directory_doubles(spark):
    """Buckets split until they fit, unevenly loaded prefixes to different depths, down to the last bit."""
    values = [k << 52 | k for k in range(64)] + [(1 << 62) + k for k in range(5)] + [-1, -2, -(1 << 63)]
    rows = [(r.depth, r.prefix) for r in exact_dedup.directory(spark.createDataFrame([(k,) for k in values], "key long"), 4).collect()]
    held = lambda d, p: sum((k & (1 << 64) - 1) >> (64 - d) == p & (1 << d) - 1 for k in values)
    assert len({d for d, _ in rows}) > 2 and max(d for d, _ in rows) > 60
    assert sum(held(d, p) for d, p in rows) == len(values) and len(set(rows)) == len(rows)
    assert all(0 < held(d, p) <= 4 < held(d - 1, p >> 1) for d, p in rows)


@pytest.mark.parametrize("hot", [2, 256])
def test_exact_dedup_salted(spark, hot, monkeypatch):
    """Groups of copies that several owners share; null and repeated ids; columns named like the operator's own."""
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 0)
    rows = [(i % 7 if i % 5 else None, "a b" if i % 2 else f"t {i % 3}") for i in range(60)]
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, id long, norm string").repartition(4)
    order = lambda i: (i is None, i or 0)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = Counter((i, min(groups[t], key=order), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    got = exact_dedup.exact_groups(docs, hot=hot).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text, r.doc_id) for r in kept.collect()) == sorted((t, min(g, key=order)) for t, g in groups.items())


def test_near_dedup_ids(spark):
    """Null, repeated and very large ids; columns named like the operator's own; rows without words."""
    base = " ".join(f"w{k}" for k in range(60))
    near = base.replace("w59", "z")
    big = (1 << 53) + 1
    rows = [(1, "a b"), (1, "a b"), (1, "zzz"), (0, "zzz"), (None, base), (big, near), (big + 1, base), (None, "q r"), (None, "q r"), (5, None), (5, ""), (None, " ")]
    docs = spark.createDataFrame([(i, t, k, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row long, kept long").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect())
    want = [(1, 1, 1), (1, 1, 1), (1, 1, 0), (0, 1, 0), (None, 56, big), (big, 56, big), (big + 1, 56, big), (None, 1, None), (None, 1, None), (5, 0, 5), (5, 0, 5), (None, 0, None)]
    assert got == Counter(want)
    out = near_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    assert kept == Counter([(1, "a b"), (0, "zzz"), (big, near), (None, "q r"), (5, None), (5, ""), (None, " ")])


def test_bpe(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer())
    rng = random.Random(8)
    pieces = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", " ", "1", "23", "'s", "'", "!", "?!", "<|endoftext|>", "。", "　", "😀", "\r\n", "\x0b", "\x7f", "\x1c", "\x85", "the", " of"]
    texts = fixture_texts(5) + ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(1500)]
    docs = frame(spark, texts)
    coded = bpe.encode(docs, bpe.default_tokenizer())
    back = {r.doc_id: r.text for r in bpe.decode(coded, bpe.default_tokenizer()).collect()}
    digests = {r.doc_id: r for r in bpe.round_trip(docs, bpe.default_tokenizer()).collect()}
    for r in coded.collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert back[r.doc_id] == library.decode(ids, skip_special_tokens=False)
        d = digests[r.doc_id]
        assert d.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256(back[r.doc_id].encode()).hexdigest()
    broken = spark.createDataFrame([(1, [447]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(broken, bpe.default_tokenizer()).collect()} == {1: library.decode([447], skip_special_tokens=False), 2: "", 3: ""}


def test_packing(spark):
    import zlib

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer())
    texts = fixture_texts(6)
    rows = packing.pack(frame(spark, texts), bpe.default_tokenizer()).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert sum(sum(r.length for r in s) < 1024 for s in sequences.values()) <= 3


def test_sum_of_squares_choice():
    """Each placement changes the sum of squared level counts least, by trying all levels."""
    rng = random.Random(1)
    p = packing.Packer(16, 0)
    for k in range(400):
        size = rng.randint(1, 15)
        n = p.levels.copy()

        def after(level):
            m = n.copy()
            if level:
                m[level] -= 1
            if level + size < 16:
                m[level + size] += 1
            return int((m[:16] ** 2).sum())

        options = [0] + [h for h in range(1, 17 - size) if n[h]]
        assert after(p.choose(size)) == min(map(after, options))
        p.add(k, b"\0\0\0\0" * size)
    p.finish()
    assert sum(x[2] for x in p.out) == sum(x[2] for x in p.out if x[2] <= 16)


@pytest.mark.parametrize("kind", ["random", "equal", "clusters", "large"])
def test_top_k(spark, kind):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    n, d = (400, 8) if kind != "large" else (60, 4)
    x = rng.normal(0, 0.3, (n, d))
    if kind == "equal":
        x[: n // 2] = x[0]
    if kind == "clusters":
        x = rng.normal(0, 1, (5, d))[rng.integers(0, 5, n)] + rng.normal(0, 0.01, (n, d))
    if kind == "large":
        x *= 1e6
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)] + [(n, None, 0), (n + 50, [], 0), (n + 100, [1.0, None] + [0.0] * (d - 2), 0), (n + 150, [float("nan")] * d, 0), (n + 200, [float("inf")] * d, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in cover_search.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ints = [[int(v) for v in np.floor(256 * r)] for r in x]
    for q in range(0, n, 10):
        s = sorted((-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in range(n) if c != q)[:5]
        assert sorted(got[q]) == [(k + 1, c, -v) for k, (v, c) in enumerate(s)]
    assert len(got) == len(range(0, n, 10))


def brute_losses(docs, *corpora):
    """(tokens, losses under a bigram model of each corpus) of every text, from plain counts of words."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    size = len({w for c in corpora for t in c for w in split(t)}) + 1
    models = []
    for corpus in corpora:
        firsts, pairs = Counter(), Counter()
        for t in corpus:
            w = split(t)
            firsts.update([None, *w[:-1]] if w else []), pairs.update(zip([None, *w[:-1]], w))
        models.append((firsts, pairs))
    out = []
    for t in docs:
        w = split(t)
        out.append((len(w), [-np.mean([np.log((pairs[x] + 0.01) / (firsts[x[0]] + 0.01 * size)) for x in zip([None, *w[:-1]], w)]) if w else None for firsts, pairs in models]))
    return out


def agree(got, want):
    for n, (one, two), r in zip(*zip(*want), got):
        assert r.n_tokens == n and (n > 0 or r.target_loss is r.background_loss is r.score is None)
        assert not n or (r.target_loss, r.background_loss, r.score) == pytest.approx((one, two, one - two), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("many", [64, 2])
def test_lm_scoring(spark, many, monkeypatch):
    """Every score is that of true counts of words, with blocks of few documents and keys whose documents wait for an answer."""
    monkeypatch.setattr(lm_scoring, "MANY", many)
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 3000)
    texts = [t if t is None else t.replace("\x00", "") for t in fixture_texts(7)]
    target = ["a b c a b", None, "b c", texts[3]]
    frames = frame(spark, texts), spark.createDataFrame([(t,) for t in target], "text string")
    got = lm_scoring.cross_entropy_difference(*frames).orderBy("doc_id").collect()
    agree(got, brute_losses(texts, target, texts))
    other = [texts[5], "x y z", ""]
    got = lm_scoring.cross_entropy_difference(*frames, spark.createDataFrame([(t,) for t in other], "text string")).orderBy("doc_id").collect()
    agree(got, brute_losses(texts, target, other))


def test_lm_scoring_table(spark):
    """The registered query on its whole table."""
    read = lambda name, key: [r.text for r in spark.read.parquet(f"{SF}/{name}.parquet").orderBy(key).collect()]
    texts = read("documents", "doc_id")
    agree(Q.op4_cross_entropy_difference(spark, SF).orderBy("doc_id").collect(), brute_losses(texts, read("benchmark", "item_id"), texts))


def test_lm_scoring_counts(spark, monkeypatch):
    """Very many distinct pairs, passed on in parts."""
    monkeypatch.setattr(lm_scoring, "COUNTED", 50_000)
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(200_000)}" for _ in range(5000)) for _ in range(60)]
    passages = [" ".join(t.split()[:300]) for t in texts[:5]]
    got = lm_scoring.cross_entropy_difference(frame(spark, texts), spark.createDataFrame([(t,) for t in passages], "text string")).orderBy("doc_id").collect()
    agree(got, brute_losses(texts, passages, texts))


def test_lm_scoring_releases(spark):
    """The vocabulary's shuffle files are gone before blocks are sent."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = lambda: {p for d in env.blockManager().diskBlockManager().localDirsString() for p in Path(d).rglob("shuffle_*.data")}
    docs = frame(spark, fixture_texts(7)).select("text")
    before = files()
    lm_scoring.vocabulary(docs, docs)
    made = files() - before
    released(spark)
    assert made and not made & files()


def test_language_id(spark):
    rows = {r.doc_id: r for r in Q.op9_language_id(spark, "/root/testdata/sf0.01").collect()}
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [i for i, r in rows.items() if r.held_out]
    assert np.mean([rows[i].lang_pred == docs[i].lang for i in held]) > 0.95
    odd = frame(spark, [None, "", "12 !", "😀"])
    assert {r.lang_pred for r in language_id.predict(odd, ["en"], np.ones((1, language_id.DIMS), np.float32)).collect()} == {"und"}


@pytest.mark.parametrize("name, label", [("op2_toxicity", "toxic"), ("op6_quality", "quality")])
def test_classifiers(spark, name, label):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in getattr(Q, name)(spark, sf).collect()}
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i, r in rows.items() if r.held_out and i in y]
    s, t = np.array([rows[i].score for i in held]), np.array([y[i] for i in held])
    auc = np.mean((s[t == 1][:, None] > s[t == 0]) + 0.5 * (s[t == 1][:, None] == s[t == 0]))
    assert len(rows) == 1000 and auc > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())


def test_toxicity_thresholds(spark):
    """A small language of a large table has its own threshold, from all its labelled rows; one with few toxic rows has the pooled one."""
    from pyspark.sql import functions as F

    from factloom.llm import toxicity

    class Net:
        def scores(self, words, offs):
            return words.counts / 100

    rows = spark.range(66_000).withColumn("lang", F.expr("if(id % 66 = 0, 'xx', if(id % 66 = 1, 'yy', 'en'))"))
    rows = rows.withColumn("toxic", F.expr("if(lang = 'xx', id div 66 % 25 = 0, if(lang = 'yy', id div 66 < 19, id % 3 = 0))").cast("int"))
    rows = rows.withColumn("n", F.expr("case lang when 'en' then if(toxic = 1, 95, 90) else if(toxic = 1, 70, 60) end"))
    docs = rows.select(F.col("id").alias("doc_id"), F.expr("repeat('w ', n)").alias("text"), "lang")
    limits = toxicity.language_thresholds(docs, rows.select(F.col("id").alias("doc_id"), "toxic"), Net(), F.lit(True))
    assert limits == {None: pytest.approx(0.925), "en": pytest.approx(0.925), "xx": pytest.approx(0.65)}
    none = toxicity.language_thresholds(docs, rows.select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic")), Net(), F.lit(True))
    assert none == {None: toxicity.CAUTIOUS}
    assert toxicity.language_thresholds(docs.limit(0), rows.select(F.col("id").alias("doc_id"), "toxic"), Net(), F.lit(True)) == {None: toxicity.CAUTIOUS}


def test_empty_tables(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, ["a"]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from factloom.llm import quality, toxicity

    assert suffix_dedup.digests(docs).count() == 0
    assert near_dedup.near_groups(docs).count() == 0
    assert exact_dedup.exact_groups(docs).count() == 0
    assert bpe.round_trip(docs, bpe.default_tokenizer()).count() == 0
    assert packing.pack(docs, bpe.default_tokenizer()).count() == 0
    assert toxicity.score(docs, toxicity.trained(docs, labels)).count() == 0
    assert quality.score(docs, quality.trained(docs, labels)).count() == 0
    assert language_id.predict(docs, *language_id.learn(docs, F.lit(True))).count() == 0
    assert quality.contexts(docs).shape == (quality.BUCKETS, quality.DIMS)
    assert lm_scoring.cross_entropy_difference(docs, docs).count() == 0
    assert cover_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


@pytest.mark.parametrize("spread", [1.0, 40.0])
def test_cover_tree(spread):
    """Covering, separation and nesting at every node; pairs are pruned as scores rise, and the best are those of all products."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, spread, (30, 8))
    points = np.floor(256 * (centres[rng.integers(0, 30, 3000)] + rng.normal(0, 0.05, (3000, 8))))
    tree = cover_search.CoverTree(points)
    away = lambda a, b: float(np.sqrt(((points[a] - points[b]) ** 2).sum()))
    assert sorted(tree.order.tolist()) == list(range(3000)) and len(tree.centre) > 10
    for node, below in enumerate(tree.children):
        lo, hi = tree.range[node]
        assert tree.centre[node] in tree.order[lo:hi]
        assert all(away(tree.centre[node], x) <= tree.radius[node] for x in tree.order[lo:hi])
        if below:
            assert [tree.range[c][0] for c in below] + [hi] == [lo] + [tree.range[c][1] for c in below]
            assert tree.centre[node] in {tree.centre[c] for c in below}
            step = next(s for s in cover_search.STEPS if all(tree.radius[c] <= tree.radius[node] / s * 1.001 for c in below))
            closest = min((away(tree.centre[c], tree.centre[d]) for c in below for d in below if c < d), default=np.inf)
            assert closest > tree.radius[node] / max(cover_search.STEPS) * 0.999 and step
    queries = points[::10]
    found = cover_search.DualSearch(cover_search.CoverTree(queries), np.arange(0, 3000, 10), tree, np.arange(3000), 5)
    products = queries @ points.T
    for i, (score, row) in enumerate(found.best):
        products[i, 10 * i] = -np.inf
        want = np.lexsort((np.arange(3000), -products[i]))[:5]
        assert row.tolist() == want.tolist() and score.tolist() == products[i, want].tolist()
    assert found.pruned > 0 and found.scored < 0.6 * products.size


def test_cover_trees_of_the_table_and_of_clusters():
    """The table's vectors make a tree of many nodes, though their spread lets none be pruned; clustered ones are mostly pruned."""
    import pyarrow.parquet as pq

    x = np.floor(256 * np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist(), float))
    tree = cover_search.CoverTree(x)
    assert len(tree.centre) > 20 and len(tree.children[0]) > 1
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 256, (40, 64))
    y = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 8, (4000, 64)))
    found = cover_search.DualSearch(cover_search.CoverTree(y[::50]), np.arange(4000)[::50], cover_search.CoverTree(y), np.arange(4000), 5)
    assert found.scored < 0.1 * len(y[::50]) * len(y) and found.pruned > 100


def test_top_k_copies(spark):
    """Repeated rows take a rank each; ids with several vectors, null ids, vectors of other lengths."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    rows = [(int(i), [float(v) for v in rng.normal(size=4)]) for i in rng.integers(0, 60, 200)]
    rows += rows[:40] * 3 + [(None, [9.0] * 4), (70, [1.0, 2.0]), (80, [3.0, 1.0]), (90, []), (100, None), (110, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = defaultdict(list)
    for r in cover_search.top_k(df, F.col("vec_id") % 10 == 0, k=7).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    usable = [(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows if i is not None and v and None not in v]
    for q in {i for i, _ in usable if i % 10 == 0}:
        scores = [(-sum(a * b for a, b in zip(x, y)), j) for i, x in set(usable) if i == q for j, y in usable if j != q and len(x) == len(y)]
        assert sorted(got[q]) == [(r + 1, -s, j) for r, (s, j) in enumerate(sorted(scores)[:7])]


def test_toxicity_forward(spark):
    """Scores against a plain loop over words, windows and filters; ids pass unchanged and columns may be named like the operator's."""
    from factloom.llm import toxicity
    from factloom.llm.textops import Words

    rng = random.Random(2)
    texts = [" ".join(rng.choices(["foul", "fine", "words", "more", "a"], k=rng.randint(0, 9))) for _ in range(120)]
    y = np.array([float("foul" in t) for t in texts])
    net = toxicity.fit(texts, y)
    odd = texts[:20] + [None, "", " \n", "Foul", "x" * 300_000 + " foul"]
    ids = [(1 << 53) + 1, None, *range(2, len(odd))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, odd)], "doc_id long, text string, lang string, score int").repartition(3)
    got = {(r.doc_id, r.text): r for r in toxicity.accepted(docs, net, {None: 2.0}).collect()}
    assert set(got) == set(zip(ids, odd)) and got[ids[0], odd[0]].asDict().keys() == {"doc_id", "text", "lang", "score"}
    scores = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}

    def embedded(word):
        b = np.frombuffer(word.encode(), np.uint8)
        with np.errstate(over="ignore"):
            return sum(net.emb[f] for f in toxicity.Network.features(Words(b, np.array([0, len(b)])))[0]).astype(float)

    for i, t in zip(ids, odd):
        vec, pooled = [embedded(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")], []
        for width, weights, shift in zip(toxicity.WIDTHS, net.filters, net.shift):
            for f in range(toxicity.FILTERS):
                sums = [shift[f] + sum(float(vec[k + j] @ weights[j * toxicity.DIMS : (j + 1) * toxicity.DIMS, f]) for j in range(width) if k + j < len(vec)) for k in range(len(vec))]
                pooled.append(max([0.0, *sums]))
        z = (float(np.dot(pooled, net.out)) + float(net.bias[0])) / net.temperature
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4, abs=1e-6)


def test_quality_forward(spark):
    """Contexts over all documents against a plain loop over neighbours; scores against pooled means of single words."""
    from factloom.llm import quality
    from factloom.llm.textops import Words

    rng = random.Random(4)
    texts = [" ".join(rng.choices(["good", "Bad", "so1", "é!", "plain", "words"], k=rng.randint(1, 12))) for _ in range(150)]
    docs = frame(spark, [*texts, None, "", texts[0]])
    total = quality.contexts(docs)
    fresh, want = quality.Model(), np.zeros((quality.BUCKETS, quality.DIMS))

    def one(word):
        b = np.frombuffer(word.encode(), np.uint8)
        with np.errstate(over="ignore"):
            w = Words(b, np.array([0, len(b)]))
            return int(fresh.buckets(w)[0]), int(fresh.shapes(w, w.raw)[0])

    for t in [*texts, texts[0]]:
        w = [one(x)[0] for x in t.split()]
        for k in range(len(w)):
            for j in range(max(0, k - quality.WINDOW), min(len(w), k + quality.WINDOW + 1)):
                if j != k:
                    want[w[k]] += fresh.index[w[j]]
    assert np.allclose(total, want, atol=1e-3)
    model = quality.fit(texts, np.array([float("good" in t) for t in texts]), total)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for i, t in enumerate(texts[:30]):
        w, raw = [one(x) for x in t.split()], np.frombuffer(t.encode(), np.uint8)
        with np.errstate(over="ignore"):
            extras = model.features(Words(raw, np.array([0, len(raw)])), raw, np.array([0, len(raw)]))[0, 2 * quality.DIMS :]
        x = np.concatenate([np.mean([model.context[b] for b, _ in w], 0), np.mean([model.shape_index[s] for _, s in w], 0), extras])
        z = np.tanh((x - model.mean) / model.spread @ model.w1 + model.b1) @ model.w2 + model.b2[0]
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-z / model.temperature)), rel=1e-4, abs=1e-6)


def test_language_vectors(spark):
    """Prototypes and cosines against letter-by-letter binding and bundling of whole texts."""
    texts = ["Ab ba, abba!", "zwei  Zebras ß", None, "12", "ab", "x" * 200_000]
    langs = ["p", "q", "p", "q", "p", None]
    docs = spark.createDataFrame([(i + (1 << 53), t, x) for i, (t, x) in enumerate(zip(texts, langs))] + [(None, "ba ab", "p")], "doc_id long, text string, lang string").repartition(3)
    names, protos = language_id.learn(docs, (docs["doc_id"] != 4 + (1 << 53)) | docs["doc_id"].isNull())

    def vector(text):
        s = [int(language_id.symbols()[ord(c)]) for c in f" {text or ''} "]
        s = [a for k, a in enumerate(s) if a or k == 0 or s[k - 1]]
        out = np.zeros(language_id.DIMS)
        for k in range(1, len(s) - 1):
            if s[k]:
                out += language_id.LETTERS[0][s[k - 1]].astype(float) * language_id.LETTERS[1][s[k]] * language_id.LETTERS[2][s[k + 1]]
        return out

    raw = {"p": vector(texts[0]) + vector("ba ab"), "q": vector(texts[1])}
    assert names == ["p", "q"] and np.allclose(protos, np.stack([raw[x] / np.linalg.norm(raw[x]) for x in names]), atol=1e-5)
    got = {r.doc_id: r for r in language_id.predict(docs, names, protos).collect()}
    for i, t in enumerate(texts):
        r, v = got[i + (1 << 53)], vector(t)
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cos = [float(v @ raw[x] / np.linalg.norm(v) / np.linalg.norm(raw[x])) for x in names]
        assert r.lang_pred == names[int(np.argmax(cos))]
        assert r.score == pytest.approx(1 / sum(np.exp(language_id.SHARPNESS * (c - max(cos))) for c in cos), rel=1e-4)


def test_untrained_scores(spark):
    from factloom.llm import quality, toxicity

    docs = frame(spark, [None, "", "a b"])
    labels = spark.createDataFrame([(0, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.trained(docs, labels)).collect()} == {0.0}
    assert {r.score for r in quality.score(docs, quality.trained(docs, labels)).collect()} == {1.0}


def test_components(spark):
    """Both ways of labelling against a plain union-find, on paths, stars and random graphs."""
    from factloom.llm.components import min_labels

    rng = random.Random(9)
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    links = [(min(x), max(x)) for x in links if x[0] != x[1]]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {v: find(v) for v in list(root)}
    df = spark.createDataFrame(links, "a long, b long")
    for local in (10**6, 0):
        assert {r.rep: r.label for r in min_labels(df, local=local).collect()} == want
