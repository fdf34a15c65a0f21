"""Scalar text functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.rules import TITLE_KEYWORDS
from .scan import let

SEPARATOR = "␟"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def normalize_ws(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def surface_key(text: Column) -> Column:
    """The lookup key of a surface form.  Lower-casing stands for case folding; they differ for a few letters (such as sharp s)."""
    return F.lower(normalize_ws(text))


def lead_ws(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, r"(?U)^\s+", ""))


def trimmed(span: Column) -> Column:
    """A struct<s, e, t> without white space at its ends."""
    one = lambda s, t: F.struct(s.cast("int").alias("s"), (s + F.length(t)).cast("int").alias("e"), t.alias("t"))
    begin = lambda t: F.when(F.length(t) == F.length(span["t"]), span["s"]).otherwise(span["s"] + lead_ws(span["t"]))
    return let(F.regexp_replace(span["t"], r"(?U)^\s+|\s+$", ""), lambda t: let(begin(t), lambda s: one(s, t)))


def pmid(text: Column) -> Column:
    """Digits of a paper id, with or without a ``pmid:`` prefix; null for anything else."""
    return F.nullif(F.regexp_extract(F.trim(text), r"(?i)^(?:pmid:\s*)?(\d+)$", 1), F.lit(""))


def document_id(pmid_: Column) -> Column:
    return F.concat(F.lit("pmid_"), pmid_)


def section_id(document: Column, index: Column) -> Column:
    return F.format_string("%s_sec%03d", document, index)


def paragraph_id(section: Column, index: Column) -> Column:
    return F.format_string("%s_p%03d", section, index)


def sentence_id(paragraph: Column, index: Column) -> Column:
    return F.format_string("%s_s%02d", paragraph, index)


def clause_id(sentence: Column, index: Column) -> Column:
    return F.format_string("%s_c%02d", sentence, index)


def mention_id(document: Column, start: Column, end: Column, entity_type: Column) -> Column:
    return F.format_string("%s_m%06d_%06d_%s", document, start, end, entity_type)


def observation_id(document: Column, subject_start: Column, object_start: Column, predicate: Column) -> Column:
    return F.format_string("%s_obs_%06d_%06d_%s", document, subject_start, object_start, predicate)


def digest(*parts: Column, length: int = 12, skip_empty: bool = True, separator: str = SEPARATOR) -> Column:
    """Leading hex digits of the SHA-256 of the parts; empty optional parts do not count."""
    joined = F.array_join(F.filter(F.array(*parts), lambda x: (x != "") & x.isNotNull()), separator) if skip_empty else F.concat_ws(separator, *parts)
    return F.substring(F.sha2(joined, 256), 1, length)


def title_matches(title: Column, keywords: list[str] = TITLE_KEYWORDS) -> Column:
    """Whether a title has one of the keywords as a whole word, in the singular or plural."""
    pattern = r"(?iU)\b(?:" + "|".join(re.escape(k) for k in keywords) + r")(?:es|s)?\b"
    return F.coalesce(title.rlike(pattern), F.lit(False))


def publication_date(year: Column, month: Column, day: Column) -> Column:
    """``2010-03-15``, ``2010-03`` or ``2010``; month names count by their first three letters, unknown ones stay as they are."""
    number = F.create_map(*(F.lit(x) for k, m in enumerate(MONTHS) for x in (m, f"{k + 1:02d}")))[F.lower(F.substring(month, 1, 3))]
    number = F.coalesce(number, F.when(month.rlike(r"^\d{1,2}$"), F.lpad(month, 2, "0")), month)
    return F.when(year.isNotNull(), F.concat_ws("-", year, number, F.when(month.isNotNull(), F.lpad(day, 2, "0"))))


def safe_int(text: Column) -> Column:
    return text.try_cast("int")


def paper_url(pmid_: Column) -> Column:
    return F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid_, F.lit("/"))


def signature(items: Column) -> Column:
    """``type=value|...`` of an array<struct<type, value>>, sorted by both."""
    return F.concat_ws("|", F.transform(F.array_sort(items), lambda x: F.concat_ws("=", x["type"], x["value"])))


def endpoint_label(name: Column, sites: Column) -> Column:
    """``name of the X`` for each localising modifier."""
    return F.concat_ws(" ", name, F.transform(sites, lambda x: F.concat(F.lit("of the "), x)))


def percent(value: Column) -> Column:
    return F.when(value.isNull(), "n/a").otherwise(F.format_string("%.0f%%", value * 100))
