"""Prefix trie, dual-tree Lloyd and personal data against plain versions of their contracts."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from factloom.llm import prefix_trie, private_data, tree_lloyd
from factloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


def against_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(Q.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_dual_tree_lloyd"])
def test_sql(spark, name):
    against_sql(spark, name)


# --- prefix trie ----------------------------------------------------------------------


def brute_trie(rows):
    """rows: (conv, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), role, key, text))
    turns = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else c + (-c) % 20
        paths[c] = tuple(turns.get(base, [])[:h]) + tuple(mine[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def conversations_fixture(seed):
    rng = random.Random(seed)
    texts = ["a", "b c", "", None, " d\te  f ", "😀 g", "x" * 5000]
    rows = []
    for conv in [*range(0, 90), *range(200, 230), 1000, 1019, 5, -3, -20]:
        n = rng.choice((1, 2, 3, 4, 5, 6))
        for k in range(n):
            rows.append((conv, rng.choice((k, k, k, None)), rng.choice(("user", "assistant", None)), rng.choice(texts)))
    rows += [(c, 0, "user", "hot") for c in range(300, 400)] + [(c, 1, "bot", "same") for c in range(300, 360)]  # a hot first turn, many copies
    rows += [(500, k, "user", f"t{k % 7}") for k in range(400)] + [(520, k, "user", f"t{k % 7}") for k in range(399)] + [(540, k, "user", f"t{k % 7}") for k in range(400)]  # long ones that part at their end
    rows += [(501, None, "user", "a"), (None, 0, "user", "lost"), (None, None, None, None)]
    rows += rng.choices(rows, k=20)
    return rows


@pytest.mark.parametrize("local", [10**9, 200, 12])
def test_prefix_trie(spark, local):
    rows = conversations_fixture(local % 97)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, path int").repartition(5)
    got = prefix_trie.conversation_trie(df, local=local)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute_trie(rows), key=str)


def test_prefix_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(df).count() == 0
    df = spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(df).count() == 0


def test_multikey_quicksort_on_random_paths():
    rng = random.Random(5)
    for _ in range(200):
        seqs = sorted({tuple(rng.choices(range(3), k=rng.randint(0, 6))) for _ in range(rng.randint(1, 25))})
        rng.shuffle(seqs)
        rows = [(s, [x + 1 for x in s], rng.randint(1, 3), k, f"e{k}") for k, s in enumerate(seqs)]
        nodes, leaves, saved = prefix_trie.finished(rows, 0, None)
        prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
        assert len(nodes) == len(prefixes)
        held = {p: [r for r in rows if r[0][: len(p)] == p] for p in prefixes}
        assert sorted((n[0], n[1], n[3], n[4]) for n in nodes) == sorted((min(r[3] for r in held[p]), len(p), sum(r[2] for r in held[p]), len({q for q in prefixes if len(q) == len(p) + 1 and q[: len(p)] == p})) for p in prefixes)
        assert saved == sum((sum(r[2] for r in held[p]) - 1) * (p[-1] + 1) for p in prefixes if p)
        assert leaves == sum(1 for p in prefixes if not any(q[: len(p)] == p and len(q) > len(p) for q in prefixes))


# --- dual-tree Lloyd ------------------------------------------------------------------


def brute_lloyd(rows, k=8, rounds=10, scale=1024.0):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in order[:k]]
    near = lambda v: min(range(len(cs)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(v, cs[j])), j))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)].append(v)
        cs = [[sum(x) // len(own[j]) for x in zip(*own[j])] if own[j] else c for j, c in enumerate(cs)]
    return sorted(((i, j := near(v), sum((a - b) ** 2 for a, b in zip(v, cs[j]))) for i, v in kept), key=str), cs


@pytest.mark.parametrize("kind", ["clusters", "ties", "huge"])
def test_lloyd(spark, kind, monkeypatch):
    monkeypatch.setattr(tree_lloyd, "BLOCK", 50)
    rng = np.random.default_rng(4)
    if kind == "ties":
        x = rng.integers(-1, 2, (150, 64)) / 1024 * (rng.random((150, 1)) < 0.5)
    elif kind == "clusters":
        x = rng.normal(0, 1, (12, 64))[rng.integers(0, 12, 300)] + rng.normal(0, 0.01, (300, 64))
    else:
        x = rng.normal(0, 1e30, (60, 64))
    rows = [(int(i), [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63, [None] + [0.0] * 63]
    rows += [(1000 + k, v) for k, v in enumerate(odd)] + [(None, rows[0][1]), rows[1], (7, rows[2][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, cluster int").repartition(3)
    found, cs = tree_lloyd.lloyd(df)
    want, want_cs = brute_lloyd(rows)
    assert cs == want_cs
    cap = (1 << 63) - 1
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(((i, j, min(d, cap)) for i, j, d in want), key=str)
    sums = tree_lloyd.inertia(found, cs).collect()
    assert {r.inertia for r in sums} == {min(cap, sum(min(d, cap) for *_, d in want))}


def test_lloyd_of_nothing_and_of_few(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found, cs = tree_lloyd.lloyd(none)
    assert found.count() == 0 and cs == [] and tree_lloyd.inertia(found, cs).count() == 0
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64)], "vec_id long, embedding array<float>")
    found, cs = tree_lloyd.lloyd(few)
    assert len(cs) == 2 and {r.distance for r in found.collect()} == {0}


def test_trees_prune_and_cover():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (20, 64)).astype(float)
    x = centres[rng.integers(0, 20, 2000)] + rng.integers(-20, 21, (2000, 64))
    block = tree_lloyd.Block.built(pa.array(range(2000)), x)
    t = block.tree
    for k in range(len(t.lo)):
        away = np.sqrt(((block.vectors[t.lo[k] : t.hi[k]] - block.vectors[t.centre[k]]) ** 2).sum(1))
        assert t.lo[k] <= t.centre[k] < t.hi[k] and away.max() <= t.radius[k] + 1e-9
    labels, walk = tree_lloyd.nearest(block, [[int(a) for a in c] for c in centres.tolist()])
    d = ((block.vectors[:, None] - centres[None]) ** 2).sum(2)
    assert (labels == d.argmin(1)).all()
    assert walk.met + walk.scored < 0.1 * d.size and len(walk.whole) < 200  # nodes of many rows are decided together


# --- personal data --------------------------------------------------------------------


def brute_base(x):
    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            c = int(c) * (1 + k % 2)
            total += c - 9 if c > 9 else c
        return total % 10 == 0

    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[ -]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_base_spans_on_random_texts():
    rng = random.Random(2)
    for _ in range(20_000):
        x = "".join(rng.choices("019.@+ -()aZ_%é\n", k=rng.randint(0, 60)))
        assert private_data.base_spans(x) == brute_base(x), x


@pytest.fixture(scope="module")
def span_field():
    return private_data.trained_field(["mail me.1@mail.example.com or +1 (212) 555-0142, code 555-0142 and 1234567890123456", "from 10.0.0.1 card 4111111111111111 no 99 of 2020", "12 bottles, 3.5 kg, 1-2-3 and v1.2.3"])


def test_glued_values_are_found(span_field):
    def found(x):
        return [(private_data.KINDS[k], x[s:e], base) for k, s, e, base in private_data.spans_of(x, span_field)]

    assert found("pay 4111111111111111 5500000000000004 now") == [("card", "4111111111111111", False), ("card", "5500000000000004", False)]
    assert found("call +1 (212) 555-0142 190.137.223.204 today") == [("ip", "190.137.223.204", True), ("phone", "+1 (212) 555-0142", False)]
    assert found("x@y.example, +1 (111) 222-3333") == [("email", "x@y.example", True), ("phone", "+1 (111) 222-3333", True)]
    for clean in ("nothing here", "in 2020 and 2021", "1234567890123456", "3.5 kg of 12 - 14", "a 10-20-30 split", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'):
        assert found(clean) == [], clean


def test_forward_backward_against_all_segmentations(span_field):
    """The sum over segmentations, its best one and expected counts, by enumerating them all."""
    rng = random.Random(3)
    tried = 0
    for _ in range(300):
        x = " ".join(rng.choices(["4111111111111111", "5500000000000004", "10.0.0.1", "+1 (212) 555-0142", "7", "a@b.example"], k=2))
        lat = private_data.lattice(x)
        if not 0 < len(lat.entities) <= 12:
            continue
        tried += 1
        n, other = len(lat.starts) - 1, len(private_data.KINDS)
        scores = [float(span_field.weights[f].sum()) for *_, f in lat.entities]

        def paths(t, last, value, used):
            if t == n:
                yield value, used
                return
            yield from paths(t + 1, other, value + span_field.steps[last, other], used)
            for e, (i, j, kind, _) in enumerate(lat.entities):
                if i == t:
                    yield from paths(j, kind, value + span_field.steps[last, kind] + scores[e], (*used, e))

        every = list(paths(0, other, 0.0, ()))
        total, of_entity, _ = private_data.expected(lat, span_field)
        assert total == pytest.approx(np.logaddexp.reduce([v for v, _ in every]))
        for e in range(len(scores)):
            assert of_entity[e] == pytest.approx(sum(np.exp(v - total) for v, used in every if e in used), abs=1e-9)
        best = max(every)
        got = private_data.viterbi(lat, span_field)
        assert sum(1 for _ in got) == len(best[1])
        assert got == [(lat.entities[e][2], lat.starts[lat.entities[e][0]], lat.starts[lat.entities[e][1]]) for e in best[1]]
    assert tried > 20


def test_private_data_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in Q.op13_private_data(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        base = brute_base(r.text or "")
        spelled = [f"{private_data.KINDS[k]}:{s}:{e}" for k, s, e in base]
        one = got[r.doc_id]
        assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in range(4))
        assert one.base_sha256 == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        spans = one.spans.split(",") if one.spans else []
        assert set(spelled) <= set(spans) and len(spans) <= len(base) + 4
        kinds = [private_data.KINDS.index(s.split(":")[0]) for s in spans]
        assert kinds == sorted(kinds)


def test_private_data_edges(spark):
    long = "word " * 200_000 + "a@b.example " + "4111111111111111 " * 2
    texts = [None, "", " ", "@", "1", "é@ü.é", long, "a@b.example", "a@b.example"]
    docs = spark.createDataFrame([(k if k else None, t, "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, spans string, kind int").repartition(3)
    model = private_data.learn(docs)
    got = private_data.digests(private_data.find_spans(docs, model)).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    assert by[6].n_email == 1 and by[6].spans.count("card") == 2 and by[7].spans == by[8].spans == "email:0:11" and by[None].spans == ""
    hidden = private_data.masked(docs, model)
    assert hidden.columns == docs.columns
    assert {r.doc_id: r.text for r in hidden.collect()}[7] == "<email>"
    assert private_data.find_spans(docs.limit(0), model).count() == 0
    assert private_data.learn(docs.limit(0)).weights.any()


def test_scans_are_linear(span_field):
    import time

    for x in ("a" * 300_000 + " 1", "1" * 300_000, "@" * 100_000, "a@" * 100_000, "1 " * 100_000, "+1" * 60_000):
        began = time.perf_counter()
        private_data.spans_of(x, span_field)
        assert time.perf_counter() - began < 20


def test_short_near_copies_are_never_lost(spark):
    """Pairs that just reach the similarity, of 3 to 70 shingles; nine of 20,000 such pairs were lost when signatures alone made candidates."""
    from factloom.llm import near_dedup

    rng = random.Random(12)
    texts, want = [], {}
    for k in range(6000):
        n = rng.choice((3, 3, 3, 6, 6, 9, 12, 30, 48, 51))
        more = n // 3  # n of n + more shingles
        words = [f"w{rng.getrandbits(40):x}" for _ in range(n + more + 4)]
        texts += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[: n + 4]))]
        want[2 * k] = want[2 * k + 1] = 2 * k
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()}
    assert got == want


def test_exact_buckets_of_linked_sets_meet(spark):
    from factloom.llm import near_dedup

    rng = np.random.default_rng(6)
    pool = rng.integers(1, 2**62, 4000, dtype=np.int64)
    common = pool[:15]  # in many sets
    rows, sets = [], []
    for _ in range(500):
        m = int(rng.integers(1, 65))
        own = np.unique(np.concatenate([rng.choice(pool, m), common[: int(rng.integers(0, 16))]]))
        for keep in (1.0, 0.9, 0.75):
            sets.append(np.sort(rng.permutation(own)[: max(1, -int(-keep * len(own) // 1))]))
    rows = [(k, len(s), s.tobytes()) for k, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "rep long, n_shingles long, items binary").repartition(3)
    buckets = defaultdict(set)
    for r in near_dedup.exact_entries(df, 75).collect():
        buckets[r.rep].add(r.bucket)
    plain = [set(s.tolist()) for s in sets]
    linked = met = 0
    for a in range(len(sets)):
        for b in range(a):
            both = len(plain[a] & plain[b])
            if plain[a] != plain[b] and 100 * both >= 75 * (len(plain[a]) + len(plain[b]) - both):
                linked += 1
                assert buckets[a] & buckets[b]
            met += bool(buckets[a] & buckets[b])
    assert linked > 500 and met < 20 * linked
