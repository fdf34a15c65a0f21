"""Personal data by a semi-Markov conditional random field over candidate spans.

Four base patterns give spans that always stay: e-mail addresses, IPv4 addresses, payment cards that pass Luhn's check, and international phone numbers.  They are
greedy and not tried again, so values that stand next to each other spoil one another: two cards with a blank between are one number of 32 digits, and a phone number
before an address swallows it.  The field looks at those places anew.  A window about digits and @ is cut into tokens (digits, letters, single other characters); a segment is one token of other text, or an
entity of a kind of at most ``LONGEST`` tokens, and whole-span features score it: its kind with its number of digits, Luhn's check, the shape of its separators, its parts, and what stands before and after.
Viterbi over bounded segments chooses boundaries and kinds jointly; an entity that overlaps a base span gives way to it.

The weights are trained here by the conditional likelihood (forward-backward over the same segments, Adam).  Its windows are drawn from the documents, at most ``WINDOWS`` from about ``SAMPLE`` documents with
a digit or @ (their first 20 windows each); their labels are the base spans, and in copies of some windows the drawn values are set side by side, where the truth is known.  Documents without any base span give a
field of fixed example values.  Scoring is one pass over whole texts without a shuffle; window scans are linear in the text.

Null and empty texts have no spans.  Ids may be null or repeated; rows are scored one by one, so ties and repeated rows get equal results; an empty table gives no rows.  Offsets are code points, ends exclusive.
Other columns are not read (``masked`` passes them as they are).
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .fitting import Adam

KINDS = ("email", "ip", "card", "phone")
#: Tokens of an entity, characters that a window takes on either side of a digit or @, and hashed features.
LONGEST, REACH, FEATURES = 24, 64, 1 << 12
#: The bounded sample that the field is trained on, and passes over it.
SAMPLE, WINDOWS, EPOCHS = 4000, 1200, 6
SPANS = "array<struct<kind: int, start: int, end: int, base: boolean>>"

ANCHOR = re.compile(r"[0-9@]+")
BLANK = re.compile(r"\s")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The patterns of the contract; a run of digits is entered only at its first one, so that no text takes quadratic time.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and then start; leftmost, not overlapping within a kind, failing matches dropped."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_PART:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if DIGITS.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(map(octet, m[0].split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m[0])) <= 15]
    return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches about digits and @: what stands between blanks, ``REACH`` characters at most on either side, joined where one character or none lies between."""
    begin = end = -1
    for m in ANCHOR.finditer(text):
        if m.end() <= end:
            continue
        left = max(0, m.start() - REACH, end if begin >= 0 else 0)
        blanks = [b.end() for b in BLANK.finditer(text, left, m.start())]
        a = blanks[-1] if blanks else left
        b = BLANK.search(text, m.end(), min(len(text), m.end() + REACH))
        b = b.start() if b else min(len(text), m.end() + REACH)
        if begin >= 0 and a - end <= 1 and (a <= end or text[end] == " "):
            end = max(b, end)
        else:
            if begin >= 0:
                yield begin, end
            begin, end = a, b
    if begin >= 0:
        yield begin, end


def side(c: str) -> str:
    return "d" if c.isdigit() else "a" if c.isalpha() else "s" if not c or c.isspace() else c if c in "+-.@_%" else "p"


@dataclass
class Lattice:
    """Tokens of a window and the entities that may lie on them: (first token, end token, kind, feature numbers)."""

    text: str
    starts: list[int]
    entities: list[tuple[int, int, int, np.ndarray]] = field(default_factory=list)


def numbered(names: list[str]) -> np.ndarray:
    """Feature numbers by a fixed hash, the same in every process."""
    out = np.empty(len(names), np.int64)
    for k, name in enumerate(names):
        h = 2166136261
        for c in name:
            h = (h ^ ord(c)) * 16777619 & 0xFFFFFFFF
        out[k] = (h ^ h >> 15) % FEATURES
    return out


_numbers: dict[tuple, np.ndarray] = {}


def features(kind: int, span: str, before: str, after: str) -> np.ndarray:
    """Whole-span features; spans of equal description share their array."""
    digits = DIGITS.findall(span)
    n = len(digits)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    separators = "".join(sorted(set(re.sub(r"[A-Za-z0-9]+", "", span))))
    sides = side(before), side(after)
    if kind == 0:
        local, _, domain = span.partition("@")
        own = (f"top{min(4, len(domain.rpartition('.')[2]))}", f"dots{min(4, domain.count('.'))}", f"first{side(local[:1])}", f"last{side(local[-1:])}", f"end{side(domain[-1:])}")
    elif kind == 1:
        own = (f"octets{all(map(octet, span.split('.')))}", f"zero{any(len(p) > 1 and p[0] == '0' for p in span.split('.'))}", f"wide{max(groups)}")
    elif kind == 2:
        even = len(set(groups)) == 1
        own = (f"luhn{luhn(''.join(digits))}", f"even{even and len(groups)}", f"long{13 <= n <= 19}", f"groups{len(groups)}", f"n{n}")
    else:
        own = (f"plus{span[0] == '+'}", f"code{'(' in span and ')' in span}", f"groups{len(groups)}", f"last{groups[-1]}", f"fits{9 <= n <= 15}", f"n{n}", f"most{max(groups)}", f"luhn{n > 12 and luhn(''.join(digits))}")
    key = (kind, separators, sides, own)
    if key not in _numbers:
        if len(_numbers) > 50_000:
            _numbers.clear()
        names = ["bias", f"sep{separators}", f"before{sides[0]}", f"after{sides[1]}", f"both{sides[0]}{sides[1]}", *own, "all" + "".join(own)]
        _numbers[key] = numbered([f"{kind}|{x}" for x in names])
    return _numbers[key]


def lattice(text: str) -> Lattice:
    """All segments that may be an entity: those of bounded length with the characters that its kind is written with, beginning and ending as it does."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    out = Lattice(text, [a for a, _ in tokens] + [len(text)])

    def add(i: int, j: int, kind: int) -> None:
        a, b = out.starts[i], out.starts[j]
        out.entities.append((i, j, kind, features(kind, text[a:b], text[a - 1 : a], text[b : b + 1])))

    n = len(tokens)
    for i, (a, _) in enumerate(tokens):
        c = text[a]
        if "0" <= c <= "9" or c in "+(":
            digits, dots, plain = 0, 0, True
            for j in range(i, min(n, i + LONGEST)):
                x, y = tokens[j]
                d = text[x]
                if "0" <= d <= "9":
                    digits += y - x
                    if digits > 19:
                        break
                    if plain and "0" <= c <= "9" and digits >= 13 and digits <= 19:
                        add(i, j + 1, 2)
                    if c in "+(" and 7 <= digits <= 15 and j > i + 1:
                        add(i, j + 1, 3)
                    if dots == 3 and j == i + 6 and plain is False and "0" <= c <= "9" and re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", text[a:y]):
                        add(i, j + 1, 1)
                elif d in " -" and j > i:
                    if text[x - 1] in " -" and plain:
                        plain = False
                elif d in "().+" and (d != "+" or j == i):
                    plain = False
                    dots += d == "."
                else:
                    break
        if c in LOCAL_PART:
            at = next((j for j in range(i, min(n, i + LONGEST)) if text[tokens[j][0]] == "@" or not set(text[slice(*tokens[j])]) <= LOCAL_PART), n)
            if at < n and at > i and text[tokens[at][0]] == "@" and (i == 0 or text[tokens[i - 1][0]] not in LOCAL_PART):
                dots = 0
                for j in range(at + 1, min(n, i + LONGEST)):
                    x, y = tokens[j]
                    part = text[x:y]
                    if part == ".":
                        dots += 1
                    elif part.isascii() and (part.isalnum() or part == "-"):
                        if dots and part != "-":
                            add(i, j + 1, 0)
                    else:
                        break
    return out


@dataclass
class SpanField:
    """Weights of span features, and of the kinds of neighbouring segments (other text is the last)."""

    weights: np.ndarray
    steps: np.ndarray


def transitions() -> np.ndarray:
    return np.zeros((len(KINDS) + 1, len(KINDS) + 1))


def arcs(lat: Lattice) -> list[list[tuple[int, int, int]]]:
    """By end token: (first token, kind, entity or -1)."""
    other = len(KINDS)
    by_end: list[list[tuple[int, int, int]]] = [[] for _ in lat.starts]
    for t in range(1, len(lat.starts)):
        by_end[t].append((t - 1, other, -1))
    for e, (i, j, kind, _) in enumerate(lat.entities):
        by_end[j].append((i, kind, e))
    return by_end


def viterbi(lat: Lattice, model: SpanField, blocked: list[tuple[int, int]] = ()) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the best segmentation's entities; none overlaps a blocked stretch, which are given in order and apart."""
    ends = [b for _, b in blocked]
    scores = []
    for i, j, _, f in lat.entities:
        k = bisect_right(ends, lat.starts[i])  # the first that ends after the entity begins
        free = k == len(blocked) or blocked[k][0] >= lat.starts[j]
        scores.append(float(model.weights[f].sum()) if free else -np.inf)
    if not any(s > -np.inf for s in scores):
        return []
    other, steps = len(KINDS), model.steps.tolist()
    best = [[-np.inf] * (other + 1) for _ in lat.starts]
    back: list[list[tuple | None]] = [[None] * (other + 1) for _ in lat.starts]
    best[0][other] = 0.0
    for t, into in enumerate(arcs(lat)):
        for i, kind, e in into:
            own = scores[e] if e >= 0 else 0.0
            if own == -np.inf:
                continue
            for k in range(other + 1):
                value = best[i][k] + steps[k][kind] + own
                if value > best[t][kind]:
                    best[t][kind], back[t][kind] = value, (i, k, e)
    t = len(lat.starts) - 1
    kind = max(range(other, -1, -1), key=lambda k: best[t][k])
    found = []
    while t:
        i, k, e = back[t][kind]
        if e >= 0:
            found.append((kind, lat.starts[i], lat.starts[t]))
        t, kind = i, k
    return found[::-1]


def expected(lat: Lattice, model: SpanField) -> tuple[float, np.ndarray, np.ndarray]:
    """The log of the sum over segmentations, and by forward-backward the expected count of each entity and of each pair of kinds."""
    other = len(KINDS)
    into = arcs(lat)
    scores = np.array([model.weights[f].sum() for *_, f in lat.entities])
    n = len(lat.starts)
    ahead, behind = np.full((n, other + 1), -np.inf), np.full((n, other + 1), -np.inf)
    ahead[0, other] = 0
    for t in range(1, n):
        for i, kind, e in into[t]:
            own = scores[e] if e >= 0 else 0.0
            ahead[t, kind] = np.logaddexp(ahead[t, kind], np.logaddexp.reduce(ahead[i] + model.steps[:, kind]) + own)
    total = np.logaddexp.reduce(ahead[-1])
    behind[-1] = 0
    of_entity, of_pair = np.zeros(len(scores)), transitions()
    for t in range(n - 1, 0, -1):
        for i, kind, e in into[t]:
            own = scores[e] if e >= 0 else 0.0
            value = model.steps[:, kind] + own + behind[t, kind]
            behind[i] = np.logaddexp(behind[i], value)
            p = np.exp(ahead[i] + value - total)
            of_pair[:, kind] += p
            if e >= 0:
                of_entity[e] += p.sum()
    return float(total), of_entity, of_pair


def counted(lat: Lattice, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray] | None:
    """Entity and pair counts of the labelled segmentation; None if a labelled span is no segment."""
    place = {(kind, lat.starts[i], lat.starts[j]): e for e, (i, j, kind, _) in enumerate(lat.entities)}
    if not all(g in place for g in gold):
        return None
    of_entity, of_pair = np.zeros(len(lat.entities)), transitions()
    chosen = {}
    for g in gold:
        i, j, _, _ = lat.entities[place[g]]
        of_entity[place[g]] = 1
        chosen[i] = (j, g[0])
    t, last = 0, len(KINDS)
    while t < len(lat.starts) - 1:
        t, kind = chosen.get(t, (t + 1, len(KINDS)))
        of_pair[last, kind] += 1
        last = kind
    return of_entity, of_pair


#: Stand-ins where no document has a value of a kind.
EXAMPLES = (("x.1@mail.example.com", "ab@site.example"), ("192.0.2.7", "203.0.113.45"), ("4111111111111111", "5500 0000 0000 0004"), ("+1 (212) 555-0142", "+44 20 7946 0958"))


def training_windows(texts: list[str], seed: int = 13) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows with labelled spans: the documents' own, and copies with drawn values side by side."""
    rng = random.Random(seed)
    own, values = [], [list(v) for v in EXAMPLES]
    for text in texts:
        spans = base_spans(text)
        for a, b in windows(text):
            inside = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= b]
            cut = any(s < b and a < e and not (a <= s and e <= b) for _, s, e in spans)
            clash = any(x[1] < y[2] and y[1] < x[2] for n, x in enumerate(inside) for y in inside[:n])
            if b - a <= 8 * REACH and not cut and not clash:
                own.append((text[a:b], inside))
                for k, s, e in inside:
                    values[k].append(text[a + s : a + e])
    with_spans, without = [w for w in own if w[1]], [w for w in own if not w[1]]
    picked = rng.sample(with_spans, min(len(with_spans), WINDOWS // 3)) + rng.sample(without, min(len(without), WINDOWS // 3))
    side_by_side = []
    for _ in range(WINDOWS - len(picked) if len(picked) < WINDOWS // 3 else WINDOWS // 3):
        text, spans = rng.choice(("", "", rng.choice(without)[0] + " " if without else "")), []
        for k in rng.choices(range(4), k=rng.choice((1, 2, 2, 2, 3))):
            v = rng.choice(values[k])
            if k == 3 and v[:1] == "+" and "(" in v and rng.random() < 0.2:
                v = v[v.index("(") :]  # without the country
            text += ("" if not text or text[-1] == " " else rng.choice((" ", " ", ", ", "; "))) + v
            spans.append((k, len(text) - len(v), len(text)))
        side_by_side.append((text + rng.choice(("", "", ".", "!!", "###")), spans))
    return picked + side_by_side


def trained_field(texts: list[str], epochs: int = EPOCHS, seed: int = 13) -> SpanField:
    data = []
    for text, spans in training_windows(texts, seed):
        lat = lattice(text)
        gold = counted(lat, spans)
        if gold is not None and lat.entities:
            data.append((lat, *gold))
    model = SpanField(np.zeros(FEATURES), transitions())
    adam = Adam([model.weights, model.steps], 0.1)
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(data)
        for k in range(0, len(data), 32):
            slope, steps = 1e-3 * model.weights, 1e-3 * model.steps
            for lat, of_entity, of_pair in data[k : k + 32]:
                _, e, p = expected(lat, model)
                for (*_, f), d in zip(lat.entities, (e - of_entity).tolist()):
                    np.add.at(slope, f, d)
                steps += p - of_pair
            adam.step([slope, steps])
    return model


def learn(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> SpanField:
    """The field trained on windows of about ``sample`` documents that have a digit or @, drawn by hash of their text, so alike however the input is partitioned."""
    held = docs.filter(F.col(text_col).rlike("[0-9@]")).select(F.col(text_col).alias("text"))
    share = int(min(1.0, sample / max(1, held.count())) * (1 << 30))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a document gives the windows at its beginning, as these need not be all
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                some = [(a, b) for (a, b), _ in zip(windows(text), range(20))]
                out.append("\n".join(text[a:b] for a, b in some if b - a <= 8 * REACH))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["text"])

    drawn = held.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share).mapInArrow(cut, "text string")
    # a text counts once; a hot one cannot make the sample larger than the documents drawn with it
    return trained_field(sorted(r.text for r in drawn.distinct().collect()))


def spans_of(text: str, model: SpanField) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of a text's spans by kind and start."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    taken: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s < taken[-1][1]:
            taken[-1] = taken[-1][0], max(e, taken[-1][1])
        else:
            taken.append((s, e))
    at = 0
    for a, b in windows(text):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        near, k = [], at
        while k < len(taken) and taken[k][0] < b:
            near.append((taken[k][0] - a, taken[k][1] - a))
            k += 1
        lat = lattice(text[a:b])
        if lat.entities:
            out += [(kind, a + s, a + e, False) for kind, s, e in viterbi(lat, model, near)]
    return sorted(out)


def find_spans(docs: DataFrame, model: SpanField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): for every document its spans, base ones marked."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans_of(t, model)] if (t := x.as_py()) and ANCHOR.search(t) else [] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, spans {SPANS}")


def masked(docs: DataFrame, model: SpanField, text_col: str = "text") -> DataFrame:
    """All columns of the documents, with each span of the text replaced by its kind in angle brackets.  Of overlapping spans the one that begins first, and the longest of those, gives the name."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(at):
                text = x.as_py()
                if text and ANCHOR.search(text):
                    parts, end = [], 0
                    for kind, s, e, _ in sorted(spans_of(text, model), key=lambda p: (p[1], -p[2], p[0])):
                        if s >= end:
                            parts += [text[end:s], f"<{KINDS[kind]}>"]
                        end = max(end, e)
                    text = "".join([*parts, text[end:]])
                out.append(text)
            columns = batch.columns
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    # columns have names by place, so that none can clash
    rows = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    names = rows.columns
    fields = [StructField(f.name, StringType()) if k == at else f for k, f in enumerate(rows.schema.fields)]
    return rows.mapInArrow(run, StructType(fields)).toDF(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of base spans of each kind, their digest, and all spans as text."""
    spelled = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, spelled), ",")
    of_kind = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
