"""Dependency trees as numbers: one linear walk of each sentence, after which every step of navigation is an equality or a range.

``pre`` numbers a sentence's tokens root first and children in order, and ``last`` is the greatest number below a token, so y is in the subtree of x iff
``x.pre <= y.pre <= x.last``.  ``off_<arcs>`` counts the tokens on the way from the root whose arc is not one of these, so y is reached from x by such arcs alone iff it is in the subtree and both have the same count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Arc labels by use.
SUBJECT_ARCS = ["nsubj", "nsubjpass", "csubj", "csubjpass"]
OBJECT_ARCS = ["dobj", "obj", "dative", "attr", "oprd", "nmod", "obl", "pobj"]
PHRASE_ARCS = ["nmod", "obl", "pobj"]
CLAUSE_ARCS = ["advcl", "acl", "relcl", "ccomp", "xcomp", "pcomp"]
SUBJECT_DESCENT = ["amod", "compound", "conj", "nummod"]
OBJECT_DESCENT = ["amod", "compound", "nummod"]

#: Arcs that a way from the root may be made of.
WAYS = {"conj": {"conj"}, "subject": set(SUBJECT_DESCENT), "object": set(OBJECT_DESCENT), "clause": {*CLAUSE_ARCS, "conj"}}
#: Columns that the walk adds; ``up`` is the head (null at a root), ``dep`` the arc's label after prepositions are set below their nouns, and ``turn`` numbers tokens root first with children in reverse order.
ADDED = ["up", "dep", "depth", "pre", "last", "turn", *(f"off_{w}" for w in WAYS)]


def numbered(ids: list[int], heads: list[int | None], deps: list[str]) -> list[list]:
    """The added columns of a sentence's tokens.

    A head that is the token itself, missing or not in the sentence makes a root; a cycle is cut at its first token.  A noun below a preposition (``pobj``) takes its place, and the preposition marks the noun (``case``).
    """
    n, place = len(ids), {i: k for k, i in enumerate(ids)}
    up = [place.get(h, -1) if h is not None else -1 for h in heads]
    up = [-1 if u == k else u for k, u in enumerate(up)]
    dep = [d or "" for d in deps]
    for k in range(n):
        q = up[k]
        if dep[k] == "pobj" and q >= 0 and dep[q] in ("prep", "agent"):
            up[k], dep[k], up[q], dep[q] = up[q], "nmod", k, "case"
    children: list[list[int]] = [[] for _ in ids]
    for k, u in enumerate(up):
        if u >= 0:
            children[u].append(k)
    depth, pre, last, turn = [-1] * n, [0] * n, [0] * n, [0] * n
    off = {w: [0] * n for w in WAYS}
    at = turned = 0
    for root in [k for k in range(n) if up[k] < 0] + list(range(n)):
        if depth[root] >= 0:
            continue
        up[root] = -1
        todo = [(root, 0)]
        while todo:
            k, d = todo.pop()
            if d < 0:
                last[k] = at - 1
                continue
            if depth[k] >= 0:
                continue
            depth[k], pre[k] = d, at
            at += 1
            if up[k] >= 0:
                for w, arcs in WAYS.items():
                    name = dep[k].split(":")[0] if w == "clause" else dep[k]
                    off[w][k] = off[w][up[k]] + (name not in arcs)
            todo.append((k, -1))
            todo += [(c, d + 1) for c in reversed(children[k]) if depth[c] < 0]
        back = [root]
        while back:
            k = back.pop()
            turn[k] = turned
            turned += 1
            back += [c for c in children[k] if up[c] == k]
    return [[ids[u] if u >= 0 else None for u in up], dep, depth, pre, last, turn, *off.values()]


def whole_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of rows that are sorted by their first column, cut anew so that no value of it is in two of them."""
    held = None
    for batch in batches:
        whole = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        ids = whole.column(0)
        cut = whole.num_rows
        if cut:
            last = ids[cut - 1]
            cut = pc.index(ids, last).as_py()
        held = whole.slice(cut)
        if cut:
            yield whole.slice(0, cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def dependency_tree(tokens: DataFrame) -> DataFrame:
    """Tokens (sentence_id, i, head, dep and others) with the added columns in place of head and dep.  Rows are dealt by sentence and walked as a stream, a sentence at a time."""
    keep = [c for c in tokens.columns if c not in ("head", "dep")]
    rows = tokens.select("sentence_id", F.col("i").cast("int").alias("i"), F.col("head").cast("int").alias("head"), "dep", *(c for c in keep if c not in ("sentence_id", "i")))
    names = [c for c in rows.columns if c not in ("head", "dep")]
    types = [pa.int32(), pa.string(), *[pa.int32()] * (len(ADDED) - 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_sentences(batches):
            yield done(part)

    def done(part: pa.Table) -> pa.RecordBatch:
        ids, i, heads, deps = (part.column(k).to_pylist() for k in range(4))
        out: list[list] = [[] for _ in ADDED]
        begin = 0
        for k in range(1, len(ids) + 1):
            if k == len(ids) or ids[k] != ids[begin]:
                for column, more in zip(out, numbered(i[begin:k], heads[begin:k], deps[begin:k])):
                    column += more
                begin = k
        own = [part.column(c).combine_chunks() for c in names]
        own = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in own]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(out, types))], names + ADDED)

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), *(f"{c} {'string' if c == 'dep' else 'int'}" for c in ADDED)])
    return rows.filter(F.col("sentence_id").isNotNull() & F.col("i").isNotNull()).repartition("sentence_id").sortWithinPartitions("sentence_id", "i").mapInArrow(run, schema)


#: Rows of ``sentence_rows``: tokens (kind 0), then mentions (kind 1; start_char as i, surface_text as low, concept_id as lem, mention_id as tag).
ROWS = ["sentence_id", "document_id", "kind", "i", "head", "dep", "low", "lem", "pos", "tag", "idx", "end"]
MENTION = "struct<mention_id:string,surface_text:string,concept_id:string,start_char:int,end_char:int>"
#: A token of a sentence's array, which is in the order of ``pre``.  up, kids, conj (the token and its conjuncts) and by_* are places in it; by_*: the token that heads the mention that this one stands for.
NODE = {
    "i": "int", "up": "int", "dep": "string", "low": "string", "lem": "string", "pos": "string", "tag": "string", "depth": "int", "pre": "int", "last": "int", "off_clause": "int", "kids": "array<int>", "conj": "array<int>",
    "whole": "struct<s:int,e:int>", "free": "struct<s:int,e:int>", "described": "struct<s:int,e:int>", "by_subtree": "int", "by_object": "int", "by_subject": "int", "mention": MENTION,
}
SENTENCE = f"document_id string, sentence_id string, n_found int, t array<struct<{', '.join(f'{c}:{k}' for c, k in NODE.items())}>>"
NONE = np.iinfo(np.int64).max


def lists(owner: np.ndarray, member: np.ndarray, n: int) -> pa.Array:
    """For each of n owners its members in order, as lists."""
    order = np.lexsort((member, owner))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(member[order].astype("int32")))


def optional(values: np.ndarray, missing: np.ndarray) -> pa.Array:
    return pa.array(np.where(missing, 0, values).astype("int32"), mask=missing)


def by_level(depth: np.ndarray) -> list[np.ndarray]:
    """Tokens of each depth, from the roots down."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def walked(of: np.ndarray, ids: np.ndarray, heads: pa.Array, dep: pa.Array) -> tuple[dict[str, np.ndarray], pa.Array]:
    """The columns of ``numbered`` (up as a row) for whole sentences at once, and the arcs: level by level where heads make trees, and sentence by sentence where there is a cycle or a noun below a preposition.

    of: the number of each token's sentence, ascending; ids ascend in a sentence.
    """
    n, rows = len(of), np.arange(len(of))
    key = (of << 33) + ids
    wanted = (of << 33) + np.asarray(heads.fill_null(0)).astype("int64")
    at = np.maximum(np.searchsorted(key, wanted, side="right") - 1, 0)
    up = np.where(np.asarray(heads.is_valid()) & (key[at] == wanted) & (at != rows), at, -1) if n else rows
    dep = dep.fill_null("")
    depth = (up >= 0).astype("int64")
    todo, above = np.flatnonzero(up >= 0), up[up >= 0]
    odd = np.unique(of[np.asarray(pc.equal(dep, "pobj"))]) if n else of
    most = int(np.bincount(of).max()) if n else 0
    while len(todo) and most > 0:
        on = up[above] >= 0
        todo, above, most = todo[on], up[above[on]], most - 1
        depth[todo] += 1
    odd = np.union1d(odd, of[todo])
    plain = ~np.isin(of, odd)
    depth[~plain], up = 0, np.where(plain, up, -1)
    got = {"up": up, "depth": depth, **{c: np.zeros(n, "int64") for c in ("pre", "last", "turn", *(f"off_{w}" for w in WAYS))}}
    levels = by_level(depth)
    size = np.ones(n, "int64")
    for level in levels[:0:-1]:
        np.add.at(size, up[level], size[level])
    parent = np.where(up >= 0, up, n + of)
    order = np.argsort(parent, kind="stable")
    run = np.cumsum(size[order])
    first = np.flatnonzero(np.diff(parent[order], prepend=-1))
    before = run - size[order]
    counts = np.diff(np.append(first, n))
    total = np.repeat(run[np.append(first[1:], n) - 1] - before[first], counts) if n else run
    left, right = np.empty(n, "int64"), np.empty(n, "int64")
    left[order] = before - np.repeat(before[first], counts)
    right[order] = total - left[order] - size[order]
    arcs = dep.dictionary_encode()
    inside = {w: np.array([(d.split(":")[0] if w == "clause" else d) not in allowed for d in arcs.dictionary.to_pylist()], bool)[arcs.indices.to_numpy()] for w, allowed in WAYS.items()} if n else {}
    for d, level in enumerate(levels):
        u = up[level]
        got["pre"][level] = left[level] if d == 0 else got["pre"][u] + 1 + left[level]
        got["turn"][level] = left[level] if d == 0 else got["turn"][u] + 1 + right[level]
        for w in WAYS if d else ():
            got[f"off_{w}"][level] = got[f"off_{w}"][u] + inside[w][level]
    got["last"] = got["pre"] + size - 1
    if len(odd):
        names = dep.to_pylist()
        begins = np.searchsorted(of, odd), np.searchsorted(of, odd, side="right")
        for b, e in zip(*(x.tolist() for x in begins)):
            own = ids[b:e].tolist()
            made = dict(zip(ADDED, numbered(own, heads[b:e].to_pylist(), names[b:e])))
            place = {i: b + k for k, i in enumerate(own)}
            names[b:e] = made.pop("dep")
            made["up"] = [place[u] if u is not None else -1 for u in made["up"]]
            for c, values in made.items():
                got[c][b:e] = values
        dep = pa.array(names, pa.string())
    return got, dep


def whole(column: pa.ChunkedArray) -> pa.Array:
    got = column.combine_chunks()
    return got if not isinstance(got, pa.ChunkedArray) else got.chunk(0) if got.num_chunks else pa.array([], got.type)


def sentence_arrays(part: pa.Table) -> pa.RecordBatch:
    """Whole sentences of ROWS, sorted, as one row each."""
    kind = part.column("kind").to_numpy()
    tokens, held = part.filter(pa.array(kind == 0)), part.filter(pa.array(kind == 1))
    names = whole(tokens.column("sentence_id")).dictionary_encode()
    of = names.indices.to_numpy().astype("int64")
    where = np.asarray(pc.index_in(whole(held.column("sentence_id")), names.dictionary).fill_null(-1)).astype("int64")
    t, n_found = laid(tokens, of, held, where, len(names.dictionary))
    first = pa.array(np.flatnonzero(np.diff(of, prepend=-1)))
    own = [whole(tokens.column(c)).take(first) for c in ("document_id", "sentence_id")]
    return pa.RecordBatch.from_arrays([*own, n_found, t], ["document_id", "sentence_id", "n_found", "t"])


def nested_arrays(part: pa.RecordBatch) -> pa.RecordBatch:
    """Rows that each hold a sentence (``tokens``, ``found``) with arrays in place of these; a sentence without tokens has no row."""

    def inner(name: str, order: list[tuple]) -> tuple[pa.Table, np.ndarray]:
        lists = part.column(name)
        rows = lists.flatten()
        of = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(lists).fill_null(0)))
        table = pa.Table.from_arrays([pa.array(of), *rows.flatten()], ["of", *(f.name for f in rows.type)])
        table = table.filter(pc.field("i").is_valid())
        if table.num_rows:
            table = table.take(pc.sort_indices(table, [("of", "ascending"), *order], null_placement="at_start"))
        return table, table.column("of").to_numpy()

    tokens, of = inner("tokens", [("i", "ascending")])
    held, where = inner("found", [("i", "ascending"), ("end", "ascending"), ("tag", "ascending")])
    some = np.unique(of)
    number = np.full(part.num_rows, -1)
    number[some] = np.arange(len(some))
    t, n_found = laid(tokens, number[of], held, number[where], len(some))
    own = [c for c in part.schema.names if c not in ("tokens", "found")]
    return pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(some)) for c in own), n_found, t], [*own, "n_found", "t"])


def laid(tokens: pa.Table, of: np.ndarray, held: pa.Table, where: np.ndarray, n_sentences: int) -> tuple[pa.Array, pa.Array]:
    """(array of tokens, number of mentions) of each sentence: the walk's numbers, spans and picks, which go up from children to heads, deepest first.  of, where: numbers of the sentences of tokens and mentions, -1 for none."""
    n = tokens.num_rows
    begins = np.searchsorted(of, np.arange(n_sentences))
    base = begins[of] if n else of
    added, dep = walked(of, tokens.column("i").to_numpy().astype("int64"), whole(tokens.column("head")), whole(tokens.column("dep")))
    order = np.argsort(base + added["pre"])  # tokens by place; rank: their order by i
    rank = (np.arange(n) - base)[order]
    above = added["up"][order]
    up = np.where(above < 0, -1, added["pre"][above]) if n else above
    depth, last, turn, off_clause = (added[c][order] for c in ("depth", "last", "turn", "off_clause"))
    dep = dep.take(pa.array(order))
    head = np.where(up < 0, -1, base + up)
    has = lambda arcs: np.asarray(pc.is_in(dep, pa.array(arcs)))
    column = lambda c: whole(tokens.column(c)).take(pa.array(order))
    start, end = (tokens.column(c).to_numpy().astype("int64")[order] for c in ("idx", "end"))
    mention = anchored(n_sentences, held, of, where, depth, rank, start, end)

    levels = by_level(depth)[:0:-1]

    def span(own: np.ndarray, via: np.ndarray) -> pa.Array:
        s, e = np.where(own, start, NONE), np.where(own, end, -1)
        for level in levels:
            k = level[via[level]]
            np.minimum.at(s, head[k], s[k])
            np.maximum.at(e, head[k], e[k])
        return pa.StructArray.from_arrays([optional(s, e < 0), optional(e, e < 0)], ["s", "e"])

    def least(key: np.ndarray, via: np.ndarray) -> pa.Array:
        """The place of the token with the least key below each token; a token that heads a mention has its own."""
        below = np.full(n, NONE)
        for level in levels:
            k = level[via[level]]
            np.minimum.at(below, head[k], np.minimum(key[k], below[k]))
        place_of = np.empty(n, "int64")
        place_of[base + rank] = np.arange(n) - base
        at = np.where(below == NONE, 0, place_of[base + np.where(below == NONE, 0, below & 0x1FFFFF)])
        return optional(np.where(mention >= 0, np.arange(n) - base, at), (below == NONE) & (mention < 0))

    every = np.ones(n, bool)
    by_depth = (depth << 42) | rank
    by_turn = (depth << 42) | (np.where(head >= 0, turn[head], 0) << 21) | rank
    concept = np.zeros(n, bool)
    concept[mention >= 0] = np.asarray(held.column("lem").is_valid())[mention[mention >= 0]]
    pick = pa.array(mention, mask=mention < 0)
    found = [whole(held.column(c)).take(pick) for c in ("tag", "low", "lem", "i", "end")]
    chains = [(np.arange(n), np.arange(n))]
    conj = has(["conj"])
    while len(chains[-1][0]):
        top, member = chains[-1]
        on = conj[top] & (head[top] >= 0)
        chains.append((head[top[on]], member[on]))
    kids = np.flatnonzero(head >= 0)
    owners, members = (np.concatenate([c[j] for c in chains]) for j in (0, 1))
    local = np.arange(n) - base
    columns = {
        "i": column("i"), "up": optional(up, up < 0), "dep": dep, **{c: column(c) for c in ("low", "lem", "pos", "tag")}, "depth": optional(depth, ~every), "pre": optional(local, ~every), "last": optional(last, ~every), "off_clause": optional(off_clause, ~every),
        "kids": lists(head[kids], local[kids], n), "conj": lists(owners, local[members], n), "whole": span(every, every), "free": span(every, has(OBJECT_DESCENT)), "described": span(~has(["case", "mark"]), every),
        "by_subtree": least(np.where(mention >= 0, by_depth, NONE), every), "by_object": least(np.where(mention >= 0, by_turn, NONE), has(OBJECT_DESCENT)), "by_subject": least(np.where(concept, by_turn, NONE), has(SUBJECT_DESCENT)),
        "mention": pa.StructArray.from_arrays(found, ["mention_id", "surface_text", "concept_id", "start_char", "end_char"], mask=pa.array(mention < 0)),
    }
    nodes = pa.StructArray.from_arrays([columns[c] for c in NODE], list(NODE))
    t = pa.ListArray.from_arrays(pa.array(np.append(begins, n).astype("int32")), nodes)
    return t, pa.array(np.bincount(where[where >= 0], minlength=n_sentences).astype("int32"))


def anchored(n_sentences: int, held: pa.Table, of: np.ndarray, where: np.ndarray, depth: np.ndarray, rank: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each token by place the mention that it heads, or -1: a mention's head is the least deep and then leftmost token that it covers; of several mentions of a token the first counts."""
    n, m = len(of), held.num_rows
    out = np.full(n, -1)
    if not m or not n:
        return out
    known = np.flatnonzero(where >= 0)
    sentence = np.maximum(where, 0)
    begins = np.searchsorted(of, np.arange(n_sentences))
    counts = np.diff(np.append(begins, n))
    a, z = (held.column(c).to_numpy() for c in ("i", "end"))
    best = np.full(m, NONE)
    step = 4096
    for at in range(0, len(known), step):
        some = known[at : at + step]
        size = counts[sentence[some]]
        who = np.repeat(some, size)
        token = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins[sentence[some]], size)
        on = (start[token] < z[who]) & (end[token] > a[who])
        np.minimum.at(best, who[on], (depth[token[on]] << 42) | (rank[token[on]] << 21) | (token[on] - begins[sentence[who[on]]]))
    hit = np.flatnonzero(best < NONE)[::-1]
    out[begins[sentence[hit]] + (best[hit] & 0x1FFFFF)] = hit
    return out


def sentence_rows(rows: DataFrame) -> DataFrame:
    """One row per sentence (document_id, sentence_id, n_found, t): ROWS are dealt once by sentence and walked as a stream; nothing after that needs another shuffle to navigate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_sentences(batches):
            out = sentence_arrays(part)
            if out.num_rows:
                yield out

    return rows.select(ROWS).repartition("sentence_id").sortWithinPartitions("sentence_id", "kind", "i", "end", "tag").mapInArrow(run, SENTENCE)


#: Sentences that a worker lays out at once.
AT_ONCE = 2048
TOKEN = "array<struct<i:int,head:int,dep:string,low:string,lem:string,pos:string,tag:string,idx:int,end:int>>"
FOUND = "array<struct<i:int,end:int,low:string,lem:string,tag:string>>"


def nested_rows(rows: DataFrame) -> DataFrame:
    """``sentence_rows`` of rows that already hold a sentence each: tokens and found (see TOKEN, FOUND; as in ROWS) become n_found and t, other columns stay, and nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                out = nested_arrays(batch.slice(at, AT_ONCE))
                if out.num_rows:
                    yield out

    kinds = dict(rows.dtypes)
    own = [c for c in rows.columns if c not in ("tokens", "found")]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in own), *SENTENCE.split(", ", 2)[2:]])
    return rows.select(*own, F.col("tokens").cast(TOKEN).alias("tokens"), F.col("found").cast(FOUND).alias("found")).mapInArrow(run, schema)
