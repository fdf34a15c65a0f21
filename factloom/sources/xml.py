"""Paper XML to rows.  The trees are recursive with mixed content, which Spark's own XML source does not keep, so they are walked in Python."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECTIONS = "document_id string, section_idx int, section_title string, paragraph_idx int, raw_text string"
STATEMENTS = "document_id string, pos int, funder string, text string, source string"
RECORDS = "document_id string, pmid string, pmcid string, doi string, title string, journal string, publication_date string, authors array<string>, publication_types array<string>, affiliations array<string>"
AUTHORS = "document_id string, author_id string, position int, name string, affiliation_id string, raw_text string"
_SPACE = re.compile(r"\s+")
_MONTHS = {m: f"{k + 1:02d}" for k, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, name, content) of an archive laid out as <pmid>/raw/<name>."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"/(\d+)/raw/[^/]+$", 1).alias("pmid"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content").filter("pmid <> ''")


def tree(content: bytes | None):
    """The root of an XML text, or None if it cannot be read."""
    try:
        return ET.fromstring((content or b"").decode("utf-8", "replace"))
    except ET.ParseError:
        return None


def tag(el) -> str:
    return el.tag.rpartition("}")[2] if isinstance(el.tag, str) else ""


def words(el) -> str:
    """All text below an element, white space collapsed."""
    return "" if el is None else _SPACE.sub(" ", "".join(el.itertext())).strip()


def _rows(raw: DataFrame, parse: Callable[[str, object], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of ``parse(document_id, root)`` for each readable XML of (document_id, content)."""
    fields = raw.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(fields)
        for batch in batches:
            out = []
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = tree(content)
                if root is not None:
                    out += parse(doc, root)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * len(arrow), arrow.types)], names=arrow.names)

    return raw.select("document_id", "content").mapInArrow(run, fields)


def body_sections(root) -> list[tuple[str | None, list[str]]]:
    """(title, paragraphs) of the sections of an article's body: every section is followed by its nested ones and holds only its own; loose paragraphs are untitled sections."""
    body = next((e for e in root.iter() if tag(e) == "body"), None)
    found: list[tuple[str | None, list[str]]] = []

    def walk(sec):
        title = next((words(c) for c in sec if tag(c) == "title"), None) or None
        found.append((title, [words(c) for c in sec if tag(c) == "p"]))
        for c in sec:
            if tag(c) == "sec":
                walk(c)

    loose: list[str] = []
    for c in body if body is not None else ():
        if tag(c) == "p":
            loose.append(words(c))
        elif tag(c) == "sec":
            if loose:
                found.append((None, loose))
                loose = []
            walk(c)
    if loose:
        found.append((None, loose))
    return found


def body_paragraphs(content: bytes | None) -> list[tuple[int, str | None, int, str]]:
    """(section, title, paragraph, text) of an article; nothing of one that cannot be read."""
    root = tree(content)
    return [] if root is None else [(k, title, j, p) for k, (title, ps) in enumerate(body_sections(root)) for j, p in enumerate(ps)]


def jats_sections(raw: DataFrame) -> DataFrame:
    """Body paragraphs of articles, in order (see ``body_sections``)."""
    return _rows(raw, lambda doc, root: [(doc, k, title, j, p) for k, (title, ps) in enumerate(body_sections(root)) for j, p in enumerate(ps)], SECTIONS)


def statements(raw: DataFrame) -> DataFrame:
    """Funding groups, then conflict and acknowledgement statements, in document order."""

    def first(el, *names):
        for name in names:
            for c in el.iter():
                if tag(c) == name and words(c):
                    return words(c)
        return None

    def parse(doc, root):
        out = []
        for group in (e for e in root.iter() if tag(e) == "funding-group"):
            for c in group:
                text = words(c)
                if tag(c) == "award-group":
                    funder = first(c, "funding-source", "institution")
                    if funder or text:
                        out.append((funder, text or funder, "pmc_award_group"))
                elif tag(c) in ("funding-statement", "funding-source") and text:
                    out.append((None, text, "pmc_funding_statement"))
        for e in root.iter():
            text = words(e) if tag(e) in ("fn", "ack") else ""
            if text and tag(e) == "ack":
                out.append((None, text, "acknowledgements"))
            elif text and (e.get("fn-type") or "").lower() in ("conflict", "coi-statement", "coi"):
                out.append((None, text, "coi_statement"))
        return [(doc, k, *x) for k, x in enumerate(out)]

    return _rows(raw, parse, STATEMENTS)


def published(article) -> str | None:
    """Year, month and day of the issue (or of the electronic article) as far as they are given."""
    node = next((n for n in (article.find(".//Journal/JournalIssue/PubDate"), article.find(".//ArticleDate")) if n is not None), None)
    if node is None:
        return None
    year, month, day = ((node.findtext(k) or "").strip() for k in ("Year", "Month", "Day"))
    if not year:
        return (node.findtext("MedlineDate") or "").strip() or None
    month = _MONTHS.get(month.lower()[:3], month)
    return "-".join(x for x in (year, month.zfill(2) if month.isdigit() else month, day.zfill(2) if day else "") if x)


def author_name(author) -> str | None:
    last = author.findtext("LastName")
    name = f"{last} {author.findtext('ForeName') or author.findtext('Initials') or ''}" if last else author.findtext("CollectiveName")
    return _SPACE.sub(" ", name).strip() if name else None


def pubmed_records(raw: DataFrame) -> DataFrame:
    """One bibliographic record per readable XML."""

    def parse(doc, root):
        top = root.find(".//PubmedArticle")
        top = root if top is None else top
        article = top.find(".//Article")
        ids = {}
        for x in top.findall(".//ArticleIdList/ArticleId"):
            if words(x):
                ids.setdefault((x.get("IdType") or "").lower(), words(x))
        pmc = ids.get("pmc")
        pmc = pmc if pmc is None or pmc.upper().startswith("PMC") else f"PMC{pmc}"
        people = [] if article is None else article.findall(".//AuthorList/Author")
        places = list(dict.fromkeys(words(a) for p in people for a in p.findall(".//AffiliationInfo/Affiliation") if words(a)))
        kinds = [words(k) for k in top.findall(".//PublicationTypeList/PublicationType") if words(k)]
        one = lambda path: words(top.find(path)) or None
        return [(doc, one(".//MedlineCitation/PMID") or one(".//PMID"), pmc, ids.get("doi"), one(".//Article/ArticleTitle"), one(".//Article/Journal/Title"), None if article is None else published(article), [n for n in map(author_name, people) if n], kinds, places)]

    return _rows(raw, parse, RECORDS)


def abstract_sections(raw: DataFrame) -> DataFrame:
    """Abstract paragraphs: a section for each label if all are labelled, else one section."""

    def parse(doc, root):
        nodes = [n for n in root.findall(".//Article//Abstract/AbstractText")]
        labels = [n.get("Label") or n.get("NlmCategory") for n in nodes]
        if nodes and all(labels):
            kept = [(_SPACE.sub(" ", x).strip().title(), words(n)) for x, n in zip(labels, nodes) if words(n)]
            return [(doc, k, title, 0, text) for k, (title, text) in enumerate(kept)]
        return [(doc, 0, "Abstract", k, t) for k, t in enumerate(words(n) for n in nodes if words(n))]

    return _rows(raw, parse, SECTIONS)


def author_affiliations(raw: DataFrame) -> DataFrame:
    """One row per author and affiliation (null, if the author has none); equal affiliations of a paper share an id."""

    def parse(doc, root):
        ids: dict[str, str] = {}
        out = []
        for k, a in enumerate(e for e in root.iter() if tag(e) == "Author"):
            name = author_name(a)
            if name is None:
                continue
            places = [words(p) for p in a.iter() if tag(p) == "Affiliation" and words(p)]
            who = f"{doc}_au{k:03d}"
            out += [(doc, who, k, name, ids.setdefault(p, f"{doc}_aff{len(ids):03d}"), p) for p in places] or [(doc, who, k, name, None, None)]
        return out

    return _rows(raw, parse, AUTHORS)


def html_sections(pages: DataFrame) -> DataFrame:
    """Headings and paragraphs of web pages (page_id, html) as sections: text in p, li and td below the last heading."""
    from html.parser import HTMLParser

    def run(batches):
        class Reader(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.out, self.title, self.sec, self.open, self.parts, self.skip = [], None, 0, None, [], 0

            def handle_starttag(self, name, attrs):
                self.skip += name in ("script", "style")
                if re.fullmatch(r"h[1-6]|p|li|td", name):
                    self.close_part()
                    self.open = name

            def handle_endtag(self, name):
                self.skip = max(0, self.skip - (name in ("script", "style")))
                if name == self.open:
                    self.close_part()

            def handle_data(self, data):
                if self.open and not self.skip:
                    self.parts.append(data)

            def close_part(self):
                text = _SPACE.sub(" ", "".join(self.parts)).strip()
                if text and self.open:
                    if self.open[0] == "h":
                        self.title, self.sec = text, self.sec + 1
                    else:
                        self.out.append((self.sec, self.title, text))
                self.open, self.parts = None, []

        for batch in batches:
            out = []
            for page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader()
                reader.feed(html or "")
                reader.close_part()
                out += [(str(page), s, t, k, x) for k, (s, t, x) in enumerate(reader.out)]
            types = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 5, types)], ["document_id", "section_idx", "section_title", "paragraph_idx", "raw_text"])

    return pages.select("page_id", "html").mapInArrow(run, SECTIONS)
