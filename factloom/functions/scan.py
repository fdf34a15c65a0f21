"""Span scanning inside the JVM: every match of a pattern with exact code-point offsets, without a UDF.

``regexp_instr`` counts UTF-16 units, so offsets are summed from the lengths (in code points) of the pieces that a split
leaves and of the matches between them.  Patterns are given with ``(?iU)`` so that letters, spaces and boundaries are Unicode's.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sums_before(numbers: Column) -> Column:
    """For each number of a non-empty array the sum of those before it.

    A fold that appends copies its array each time, so a long array is cut into about as many runs as a run has numbers: n numbers cost n to the power 1.5 copies, some ten million for 80,000.
    """

    def cut(x: Column) -> Column:
        size = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(x))).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / size).cast("int")), lambda k: F.slice(x, k * size + 1, size))

    running = lambda x: F.aggregate(x, F.array(F.lit(0)), lambda b, n: F.array_append(b, F.element_at(b, -1) + n))

    def joined(runs: Column) -> Column:
        begins = running(F.transform(runs, lambda r: F.element_at(r, -1)))
        return F.flatten(F.transform(F.zip_with(runs, F.slice(begins, F.lit(1), F.size(runs)), lambda r, b: F.struct(r.alias("r"), b.alias("b"))), lambda x: F.transform(F.slice(x["r"], F.lit(1), F.size(x["r"]) - 1), lambda n: n + x["b"])))

    return let(numbers, lambda x: let(F.transform(cut(x), running), joined))


#: Set about matches: a character of the private use area.
MARK = "\ue000"


def segments(text: Column, pattern: str) -> Column:
    """The text between matches, empty pieces too: array<struct<s, e, t, m>>, each with the match after it (null at the end).

    Offsets are half-open and count code points; null text is empty text.  Only numbers are folded: where each piece begins.
    """
    text = F.coalesce(text, F.lit(""))
    # marks are set about each match in one pass, by a pattern that is compiled once, and a single character is split without one
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    by_marks = let(marked, lambda p: F.transform(F.sequence(F.lit(0), F.shiftright(F.size(p), 1)), lambda k: F.struct(F.get(p, k * 2).alias("t"), F.get(p, k * 2 + 1).alias("m"))))
    # a text that holds the mark is gone through twice
    pieces = F.regexp_extract_all(text, F.lit(f"(?s:(.*?))(?:(?:{pattern})|\\z)"), F.lit(1))
    by_pieces = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.zip_with(F.slice(pieces, F.lit(1), F.size(m) + 1), m, lambda t, x: F.struct(t.alias("t"), x.alias("m"))))
    found = F.when(text.contains(MARK), by_pieces).otherwise(by_marks)

    def placed(pieces: Column) -> Column:
        begins = sums_before(F.transform(pieces, lambda x: F.length(x["t"]) + F.coalesce(F.length(x["m"]), F.lit(0))))
        return F.zip_with(pieces, begins, lambda x, s: F.struct(s.alias("s"), (s + F.length(x["t"])).alias("e"), x["t"].alias("t"), x["m"].alias("m")))

    return let(found, placed)


def scan(text: Column, pattern: str) -> Column:
    """All matches as array<struct<s, e, t>>, half-open offsets in code points; null text gives an empty array."""
    hits = F.filter(segments(text, pattern), lambda x: x["m"].isNotNull())
    return F.transform(hits, lambda x: F.struct(x["e"].alias("s"), (x["e"] + F.length(x["m"])).alias("e"), x["m"].alias("t")))


def scan_cores(text: Column, before: str, core: str, after: str = "") -> Column:
    """Spans of ``core`` where it stands after ``before`` and ahead of ``after`` (a look-ahead), in any case."""
    anchored = rf"(?iU)^{before}({core})$"

    def end_of(x: Column) -> Column:
        t = F.regexp_extract(x["t"], anchored, 1)
        return F.struct((x["e"] - F.length(t)).cast("int").alias("s"), x["e"].alias("e"), t.alias("t"))

    pattern = rf"(?iU){before}(?:{core})\b{after}"
    # most texts have none
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), F.transform(scan(text, pattern), end_of)).otherwise(F.array().cast("array<struct<s:int,e:int,t:string>>"))


def factored(surfaces: list[str]) -> str:
    """One pattern of surfaces in which common beginnings stand once, the longest first: at a place of a text only those that go on there are tried.  For patterns that ignore case by Unicode's rules."""
    root: dict = {}
    for s in surfaces:
        node = root
        for c in s:
            fold = c.upper().lower() if len(c.upper()) == 1 else c
            node = node.setdefault(fold if len(fold) == 1 else c, {})
        node[""] = {}

    def spelled(node: dict) -> str:
        rest = [(re.escape(c).replace(r"\ ", " ") + spelled(below)) for c, below in sorted(node.items()) if c]
        if not rest:
            return ""
        return rest[0] if len(rest) == 1 and "" not in node else "(?:" + "|".join(rest) + ")" + ("?" if "" in node else "")

    return spelled(root)


def word_pattern(surfaces: list[str]) -> str:
    """All surface forms, longest first, bounded by non-word characters, in any case."""
    return r"(?iU)(?<!\w)" + factored(surfaces) + r"(?!\w)"


def span_text(text: Column, start: Column, end: Column) -> Column:
    """The slice [start, end) of a text, by code points."""
    return F.substring(text, start + 1, end - start)
