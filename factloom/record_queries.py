"""Queries of archives, stored tables, listings and small functions, over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rule_queries as L
from .functions import text as T
from .operators import analysis, claims, documents, mentions, query
from .plans import persist
from .plans.extract import one_sentence_papers
from .sources import store, vocabulary, xml
from .sources.staging import shared_dir
from .sources.store import Store

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- archives and JSON ----------------------------------------------------------------


@register("SELECT doc_id::VARCHAR AS pmid, doc_id % 5 <> 0 AS has_raw, CASE WHEN doc_id % 5 <> 0 THEN sha256(coalesce(text, '')) END AS sha256 FROM documents")
def raw_archive(spark, sf_dir):
    """Four of five texts archived as raw files, with their checksums, and what is missing."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pmid"), F.lit("text.txt").alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    path = f"{shared_dir(spark)}/archives/{uuid.uuid4().hex}"
    store.archive_raw(spark, d.filter("pmid % 5 <> 0"), path)
    sums = store.checksums(spark, path)
    return store.has_raw(d.select("pmid"), sums).join(sums.select("pmid", "sha256"), "pmid", "left")


@register("""SELECT p_partkey, '{"p_brand":"' || p_brand || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}' AS json, p_size + 1 AS size_back FROM part""")
def canonical_json_rows(spark, sf_dir):
    """Rows as JSON with their fields in alphabetical order, and read back."""
    made = store.canonical_json(table(spark, sf_dir, "part").select("p_size", "p_partkey", "p_brand"))
    back = store.read_json(made, "p_brand string, p_partkey long, p_size int")
    keyed = made.select(F.get_json_object("json", "$.p_partkey").cast("long").alias("p_partkey"), "json")
    return keyed.join(back.select("p_partkey", (F.col("p_size") + 1).alias("size_back")), "p_partkey")


@register("SELECT s_suppkey::VARCHAR AS pmid, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' again' WHEN s_suppkey % 3 = 1 THEN s_name END AS title FROM supplier")
def paper_metadata(spark, sf_dir):
    """Metadata files: the last one that was written of each paper, or none."""
    path = f"{shared_dir(spark)}/metadata/{uuid.uuid4().hex}"
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("pmid"), F.col("s_name").alias("title"))
    store.save_metadata(s.filter("pmid % 3 <> 2"), path)
    store.save_metadata(s.filter("pmid % 3 = 0").withColumn("title", F.concat("title", F.lit(" again"))), path)
    return store.read_metadata(spark, path, s.select("pmid"), "title string").select("pmid", F.col("metadata.title").alias("title"))


# --- small functions ------------------------------------------------------------------


@register("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') END AS publication_date FROM orders""")
def publication_dates(spark, sf_dir):
    """Dates of years, month names or numbers and days, as far as they are given."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % 4
    month = F.when(k == 0, F.date_format("o_orderdate", "MMMM")).when(k == 1, F.month("o_orderdate").cast("string"))
    return o.select("o_orderkey", T.publication_date(F.when(k < 3, F.year("o_orderdate").cast("string")), month, F.when(k == 0, F.dayofmonth("o_orderdate").cast("string"))).alias("publication_date"))


@register("""SELECT p_partkey, 'https://pubmed.ncbi.nlm.nih.gov/' || p_partkey || '/' AS url, CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE printf('%.0f%%', p_size % 4 * 25.0) END AS share, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || ' of the gut' ELSE p_brand || ' of the gut of the colon' END AS label,
'a=' || p_brand || '|b=1' || CASE WHEN p_size % 2 = 0 THEN '|b=2' ELSE '' END AS sig FROM part""")
def labels_and_signatures(spark, sf_dir):
    """Addresses of papers, shares as text, labels of endpoints with their sites, and sorted signatures."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_size")
    sites = F.slice(F.array(F.lit("gut"), F.lit("colon")), F.lit(1), (k % 3).cast("int"))
    pair = lambda a, b: F.struct(F.lit(a).alias("type"), b.alias("value"))
    items = F.when(k % 2 == 0, F.array(pair("b", F.lit("2")), pair("b", F.lit("1")), pair("a", F.col("p_brand")))).otherwise(F.array(pair("b", F.lit("1")), pair("a", F.col("p_brand"))))
    return p.select("p_partkey", T.paper_url(F.col("p_partkey").cast("string")).alias("url"), T.percent(F.when(k % 5 != 0, k % 4 / 4)).alias("share"), T.endpoint_label(F.col("p_brand"), sites).alias("label"), T.signature(items).alias("sig"))


@register("""SELECT p_partkey, p_size % 4 <> 0 AND p_size % 3 <> 0 AS valid, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand || '|x' END AS forms FROM part""")
def concept_validation(spark, sf_dir):
    """Concepts of a user's lexicon: ids of the right form, surfaces trimmed and without those that differ in case."""
    p = table(spark, sf_dir, "part")
    cid = F.when(F.col("p_size") % 4 == 0, F.concat_ws(" ", F.lit("bad"), "p_size")).otherwise(F.concat(F.lit("Part9:item_"), "p_partkey"))
    forms = F.when(F.col("p_size") % 3 == 0, F.array(F.lit(" "), F.lit(""))).otherwise(F.array(F.concat(F.lit(" "), "p_brand"), F.upper("p_brand"), F.lit("x"), F.lit("X ")))
    v = vocabulary.valid_concept(p.select("p_partkey", cid.alias("concept_id"), forms.alias("surface_forms")))
    return v.select("p_partkey", "valid", F.array_join("surface_forms", "|").alias("forms"))


# --- documents and spans --------------------------------------------------------------


@register("WITH " + L.expected(
    4, "section_idx section_title raw_text", (0, -1, "Title", "Dietary {b} and remission"), (0, 0, None, "Loose {n}."), (0, 1, "Methods", "We did {b}."), (0, 2, "Statistics", "Tests."), (0, 3, None, "End."),
    (2, -1, "Title", "Dietary {b} and remission"), (2, 0, "Background", "{b} helps."), (2, 1, "Results", "It was associated with {n}."),
) + " SELECT id AS document_id, section_idx, section_title, raw_text FROM e")
def assembled_documents(spark, sf_dir):
    """Papers of a record and, for half of them, a full text: title, then body or else abstract."""
    record = L.laid(spark, sf_dir, [L.RECORD, None, L.RECORD, None]).filter("text is not null").select(F.col("id").alias("document_id"), F.col("text").cast("binary").alias("content"))
    article = L.laid(spark, sf_dir, [L.ARTICLE, None, None, None]).filter("text is not null").select(F.col("id").alias("document_id"), F.col("text").cast("binary").alias("content"))
    titles = xml.pubmed_records(record).select("document_id", "title")
    return documents.assemble(titles, xml.abstract_sections(record), xml.jats_sections(article)).select("document_id", "section_idx", "section_title", "raw_text")


HITS = r"""s AS (SELECT doc_id, string_split_regex(text, '[\p{L}\p{N}\p{M}_]+') AS g, regexp_extract_all(text, '[\p{L}\p{N}\p{M}_]+') AS m, text FROM documents),
u AS (SELECT doc_id, unnest(m) AS w, unnest(g[1:len(m)]) AS before, generate_subscripts(m, 1) AS k FROM s),
o AS (SELECT doc_id, w, (sum(length(before) + length(w)) OVER (PARTITION BY doc_id ORDER BY k) - length(w))::BIGINT AS a FROM u),
hits AS (SELECT doc_id, w, a FROM o WHERE lower(w) IN ('the', 'and', 'und', 'in', 'en'))"""


@register(rf"""WITH {HITS} SELECT doc_id::VARCHAR AS document_id, a::INTEGER AS start_char, 'dictionary' AS source, CASE lower(w) WHEN 'in' THEN 'place' WHEN 'en' THEN 'tongue' ELSE 'word' END AS entity_type FROM hits WHERE a >= 5
UNION ALL SELECT doc_id::VARCHAR, 0, 'model', CASE lower(left(text, 5)) WHEN 'the' THEN 'word' WHEN 'and' THEN 'word' WHEN 'und' THEN 'word' WHEN 'in' THEN 'place' WHEN 'en' THEN 'tongue' ELSE 'chemical' END FROM documents WHERE length(text) > 0""")
def model_spans(spark, sf_dir):
    """A detector's spans win over dictionary hits that they overlap."""
    from .queries import PROBE, probe_index

    d = table(spark, sf_dir, "documents").filter("length(text) > 0").select(F.col("doc_id").cast("string").alias("document_id"), "text")
    p = d.select("document_id", F.col("document_id").alias("paragraph_id"), F.lit(0).alias("start_char"), "text")
    sents = d.select(F.col("document_id").alias("sentence_id"), "document_id", F.lit(0).alias("start_char"), F.length("text").alias("end_char"), "text")
    spans = mentions.detected_spans(sents, lambda t: [(0, min(5, len(t)), "CHEMICAL", 0.9)])
    found = mentions.mentions(sents, p, probe_index(spark), [s for c in PROBE for s in c[3]], spans)
    return found.select("document_id", "start_char", "source", "entity_type")


@register("SELECT doc_id::VARCHAR AS document_id, (10 * (doc_id % 7))::INTEGER AS start_char, CASE WHEN 10 * (doc_id % 7) % 40 <= 25 THEN doc_id || '_' || (10 * (doc_id % 7) // 40) END AS sentence_id FROM documents")
def sentence_of_span(spark, sf_dir):
    """The first sentence that contains a span, or none."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), (10 * (F.col("doc_id") % 7)).cast("int").alias("start_char"))
    spans = d.withColumn("end_char", F.col("start_char") + 15)
    k = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")
    sents = d.select("document_id", k).select("document_id", F.concat_ws("_", "document_id", "k").alias("sentence_id"), (F.col("k") * 40).alias("start_char"), (F.col("k") * 40 + 40).alias("end_char"))
    return documents.containing_sentence(spans, sents).select("document_id", "start_char", "sentence_id")


@register("SELECT doc_id::VARCHAR AS document_id, substr(text, 4, 7) AS reconstructed, CASE WHEN doc_id % 3 = 0 THEN 'x' || substr(text, 4, 7) ELSE substr(text, 4, 7) END = substr(text, 4, 7) AS intact FROM documents WHERE text IS NOT NULL")
def evidence_intact(spark, sf_dir):
    """Quotes cut anew from their texts, and which of them have drifted."""
    d = table(spark, sf_dir, "documents").filter("text is not null").select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("canonical_text"))
    quote = F.substring("canonical_text", 4, 7)
    e = d.select("document_id", F.lit(3).alias("start_char"), F.lit(10).alias("end_char"), F.when(F.col("document_id") % 3 == 0, F.concat(F.lit("x"), quote)).otherwise(quote).alias("quoted_text"))
    return query.find_evidence(e, d).select("document_id", "reconstructed", "intact")


# --- claims ---------------------------------------------------------------------------


def _stand_in():
    from . import queries as Q

    return Q


def _with_sql(body: str) -> str:
    return f"WITH {_stand_in().CLAIMS_SQL}, {body}"


QUALIFIER_ROWS = """q AS (SELECT DISTINCT claim_id, CASE WHEN k % 2 = 0 THEN 'disease_state' ELSE 'dose' END AS kind, CASE WHEN k % 2 = 0 THEN 'DS:' || k END AS concept, 'v' || k AS value FROM claims JOIN obs USING (document_id, subject_concept_id, predicate, object_concept_id, polarity, certainty))"""


def claim_qualifiers(spark, sf_dir) -> DataFrame:
    """Qualifiers of claims by the lines that their observations come from."""
    k = F.col("start_char")
    e = claims.owners(_stand_in().signed_observations(spark, sf_dir)).select("claim_id", F.col("evidence_start").alias("start_char")).distinct()
    return e.select("claim_id", F.when(k % 2 == 0, "disease_state").otherwise("dose").alias("qualifier_type"), F.when(k % 2 == 0, F.concat(F.lit("DS:"), k)).alias("value_concept_id"), F.concat(F.lit("v"), k).alias("value_text"))


def claims_by_state(spark, sf_dir):
    """Claims that hold in a disease state, named by its concept or its text in any case."""
    c = query.find_claims(_stand_in().plain_claims(spark, sf_dir), claim_qualifiers(spark, sf_dir), disease_state="ds:2", predicate="decreases")
    return c.select("claim_id")


def claims_with_children(spark, sf_dir):
    """Claims with their qualifiers and modifiers in order, or none."""
    q = claim_qualifiers(spark, sf_dir)
    mods = q.filter("qualifier_type = 'dose'").select("claim_id", F.lit("subject").alias("endpoint"), F.lit("localized_in").alias("relation"), F.lit(None).cast("string").alias("value_concept_id"), "value_text")
    rows = claims.with_children(_stand_in().plain_claims(spark, sf_dir), q, mods)
    spelled = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: x["value_text"]), ","), F.lit(""))
    return rows.select("claim_id", spelled(F.col("qualifiers")).alias("qualifiers"), spelled(F.col("modifiers")).alias("modifiers"))


def estimated_false_positives(spark, sf_dir):
    """The share of relations by predicate that are likely false, from the rate of self-loops and how often neighbours are of one concept."""
    rows = analysis.self_loops(_stand_in().observations(spark, sf_dir), "predicate")
    return rows.select("predicate", F.round(analysis.estimated_fp(F.col("rate"), F.lit(0.373)), 6).alias("estimated_fp"), analysis.estimated_fp(F.col("rate"), F.lit(0.0)).alias("without_neighbours"))


def extraction_summary(spark, sf_dir):
    """What extraction made of each document: mentions, observations, claims and observations that make none."""
    obs = _stand_in().observations(spark, sf_dir).withColumn("object_concept_id", F.when(F.col("k") % 3 != 0, F.col("object_concept_id")))
    found = obs.select("document_id", F.when(F.col("k") % 2 == 0, "normalized").otherwise("unmatched").alias("status"))
    made = obs.filter("object_concept_id is not null").select("document_id", "subject_concept_id", "predicate", "object_concept_id", "polarity", "certainty").distinct()
    return persist.summary(obs, made, found)


QUERIES |= {f.__name__: f for f in (claims_by_state, claims_with_children, estimated_false_positives, extraction_summary)}


def late_oracles() -> dict[str, str]:
    """SQL over the stand-in's claims, which another module states."""
    return {
        "claims_by_state": _with_sql(f"{QUALIFIER_ROWS} SELECT claim_id FROM claims WHERE predicate = 'decreases' AND claim_id IN (SELECT claim_id FROM q WHERE concept = 'DS:2')"),
        "claims_with_children": _with_sql(f"""{QUALIFIER_ROWS} SELECT claim_id, string_agg(value, ',' ORDER BY kind, concept, value) AS qualifiers, coalesce(string_agg(value, ',' ORDER BY value) FILTER (kind = 'dose'), '') AS modifiers FROM q GROUP BY 1"""),
        "estimated_false_positives": f"WITH {_stand_in().OBS_SQL}, r AS (SELECT predicate, count(*) FILTER (subject_concept_id = object_concept_id) / count(*) AS rate FROM obs GROUP BY 1) SELECT predicate, round(least(1.0, rate / 0.373), 6) AS estimated_fp, NULL::DOUBLE AS without_neighbours FROM r",
        "extraction_summary": f"""WITH {_stand_in().OBS_SQL} SELECT document_id, count(*) AS mentions, count(*) FILTER (k % 2 = 0) AS normalized, count(*) AS observations,
  count(DISTINCT (subject_concept_id, predicate, object_concept_id, polarity, certainty)) FILTER (k % 3 <> 0) AS claims, count(*) FILTER (k % 3 = 0) AS dropped FROM obs GROUP BY 1""",
    }


# --- stored extraction ----------------------------------------------------------------


@register("WITH " + L.expected(8, "n_obs n_ds", (0, 1, 0), (1, 1, 0), (2, 2, 2), (3, 1, 1), (4, 1, 0), (5, 2, 0), (6, 0, 0), (7, 1, 0)) + """, c AS (SELECT count(*) AS docs, sum(n_obs)::BIGINT AS obs, sum(n_ds)::BIGINT AS ds FROM e)
SELECT unnest(['paragraphs', 'sections', 'sentences', 'observations', 'claims', 'claim_evidence', 'observation_qualifiers', 'claim_qualifiers', 'open_observations']) AS name, unnest([docs, docs, docs, obs, obs, obs, ds, ds, docs]) AS n FROM c""")
def stored_extraction(spark, sf_dir):
    """Rows of each table after extraction is stored in one transaction, in place of other rows of half the documents."""
    rows = L.laid(spark, sf_dir, L.PAPERS).select(F.col("id").alias("document_id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("sentence"))
    s = Store(spark, f"{shared_dir(spark)}/stores/{uuid.uuid4().hex}")
    for name in ("observations", "claims", "claim_evidence"):
        s.replace(name, rows.filter("substring(document_id, 6) % 2 = 0"))
    persist.persist_extraction(s, one_sentence_papers(rows), rows.select("document_id"), lambda t: [(0, len(t), "relation", 0.5)])
    names = ["paragraphs", "sections", "sentences", "observations", "claims", "claim_evidence", "observation_qualifiers", "claim_qualifiers", "open_observations"]
    out = None
    for name in names:
        one = s.read(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out
