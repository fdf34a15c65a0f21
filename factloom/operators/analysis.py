"""Cross-paper analysis: cohesion, synthesis, food derivation, relation quality and gold evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scan import let
from ..plans import rules as R


def cohesion_core(sets: DataFrame, fraction: float = 0.5) -> DataFrame:
    """(concept_id, papers) of the concepts that at least max(2, ceil(fraction * N)) papers have (1, if N < 2).

    sets: document_id, concept_id; a paper without concepts has one row with a null.
    """
    n = sets.agg(F.count_distinct("document_id").alias("n"))
    counts = sets.filter("concept_id is not null").groupBy("concept_id").agg(F.count_distinct("document_id").alias("papers"))
    need = F.when(F.col("n") >= 2, F.greatest(F.lit(2), F.ceil(F.lit(fraction) * F.col("n")))).otherwise(1)
    # one row of a global count
    return counts.join(F.broadcast(n)).filter(F.col("papers") >= need).select("concept_id", "papers")


def cohesion(sets: DataFrame, fraction: float = 0.5, threshold: float = 0.2) -> DataFrame:
    """Per paper: share of the core it covers, concept count, core concepts it lacks, and whether it is off topic.

    A paper without concepts is an outlier of its own kind; without a core nothing is one.  A single paper is its own core.
    """
    core = cohesion_core(sets, fraction)
    size = F.broadcast(core.agg(F.count("*").alias("core_size")))
    rows = sets.filter("concept_id is not null").dropDuplicates(["document_id", "concept_id"]).join(core.select("concept_id", F.lit(1).alias("in_core")), "concept_id", "left")
    counts = sets.select("document_id").distinct().join(rows.groupBy("document_id").agg(F.count("*").alias("concept_count"), F.count("in_core").alias("overlap")), "document_id", "left").fillna(0).join(size)
    # the share is compared as it is reported, rounded to four places
    share = F.when((F.col("concept_count") > 0) & (F.col("core_size") > 0), F.round(F.col("overlap") / F.col("core_size"), 4))
    empty = F.col("concept_count") == 0
    return counts.withColumn("score", share).select(
        "document_id", "score", "concept_count", (F.col("core_size") - F.col("overlap")).alias("missing_core"),
        F.coalesce(empty | (F.col("score") < threshold), F.lit(False)).alias("is_outlier"),
        F.when(empty, "no_extractable_concepts").when(F.col("score") < threshold, "off_topic").alias("reason"),
    )


def missing_core(sets: DataFrame, fraction: float = 0.5) -> DataFrame:
    """(document_id, concept_id): core concepts that a paper lacks; the core is small, papers are not."""
    core = cohesion_core(sets, fraction).select("concept_id")
    return sets.select("document_id").distinct().join(F.broadcast(core)).join(sets.filter("concept_id is not null"), ["document_id", "concept_id"], "left_anti")


def direction(pos: Column, neg: Column) -> Column:
    return F.when((pos > 0) & (neg > 0), "conflicting").when(pos > 0, "supported").when(neg > 0, "refuted").otherwise("inconclusive")


CONCLUSION = ["subject_concept_id", "predicate", "object_concept_id", "qualifier_sig", "modifier_sig"]


def synthesize(claims: DataFrame, strengths: DataFrame | None = None) -> DataFrame:
    """Conclusions across papers.

    claims: claim_id, document_id, CONCLUSION columns, names, polarity, certainty.  Paper sets are distinct papers; certainty counts count claims;
    strength counts count papers.  strengths: document_id, value (unknown where absent).
    """
    if strengths is None:
        claims = claims.withColumn("strength", F.lit("unknown"))
    else:
        claims = claims.join(strengths.select("document_id", F.col("value").alias("strength")), "document_id", "left").fillna("unknown", "strength")
    papers = lambda p: F.array_sort(F.collect_set(F.when(p, F.col("document_id"))))
    pos, neg = F.col("polarity") == "positive", F.col("polarity") == "negative"
    first = F.struct("document_id", "claim_id")
    grouped = claims.groupBy(*CONCLUSION).agg(
        F.min_by("subject_name", first).alias("subject_name"), F.min_by("object_name", first).alias("object_name"),
        papers(pos).alias("supporting"), papers(neg).alias("contradicting"), papers(~pos & ~neg).alias("neutral"),
        F.count_distinct("document_id").alias("paper_count"), F.count("*").alias("claim_count"),
        *(F.count_if(F.col("certainty") == c).alias(f"n_{c}") for c in ("asserted", "possible", "hypothetical", "insufficient_evidence")),
        *(F.count_distinct(F.when(F.col("strength") == s, F.col("document_id"))).alias(f"strength_{s}") for s in ("high", "moderate", "low", "unknown")),
        F.min(F.when(pos, F.col("claim_id"))).alias("supporting_claim"), F.min(F.when(neg, F.col("claim_id"))).alias("contradicting_claim"),
    )
    return grouped.withColumns({
        "direction": direction(F.size("supporting"), F.size("contradicting")),
        "clinical_direction": R.clinical_direction(F.col("predicate"), F.col("object_concept_id")),
    })


CERTAINTIES = ("asserted", "possible", "hypothetical", "insufficient_evidence")
STRENGTHS = ("high", "moderate", "low", "unknown")


def conclusion_papers(claims: DataFrame) -> DataFrame:
    """One row for each conclusion and paper: the sides that the paper takes, its claims by certainty, its smallest claim of either side, and names from its smallest claim."""
    pos, neg = F.col("polarity") == "positive", F.col("polarity") == "negative"
    return claims.groupBy(*CONCLUSION, "document_id").agg(
        F.bool_or(pos).alias("supports"), F.bool_or(neg).alias("contradicts"), F.bool_or(~pos & ~neg).alias("is_neutral"), *(F.count_if(F.col("certainty") == c).alias(f"n_{c}") for c in CERTAINTIES), F.count("*").alias("claim_count"),
        F.min_by("subject_name", "claim_id").alias("subject_name"), F.min_by("object_name", "claim_id").alias("object_name"), F.min(F.when(pos, F.col("claim_id"))).alias("supporting_claim"), F.min(F.when(neg, F.col("claim_id"))).alias("contradicting_claim"),
    )


def conclusions(papers: DataFrame, strengths: DataFrame | None = None) -> DataFrame:
    """Conclusions of any number of papers, as counts: ``synthesize`` without lists of papers, which stay rows of ``conclusion_papers``.

    Both steps sum before they shuffle, so no task holds a conclusion's papers.
    """
    if strengths is None:
        papers = papers.withColumn("strength", F.lit("unknown"))
    else:
        papers = papers.join(strengths.select("document_id", F.col("value").alias("strength")), "document_id", "left").fillna("unknown", "strength")
    out = papers.groupBy(*CONCLUSION).agg(
        F.min_by("subject_name", "document_id").alias("subject_name"), F.min_by("object_name", "document_id").alias("object_name"), F.count("*").alias("paper_count"), F.sum("claim_count").alias("claim_count"),
        F.count_if("supports").alias("n_supporting"), F.count_if("contradicts").alias("n_contradicting"), F.count_if("is_neutral").alias("n_neutral"), *(F.sum(f"n_{c}").alias(f"n_{c}") for c in CERTAINTIES),
        *(F.count_if(F.col("strength") == s).alias(f"strength_{s}") for s in STRENGTHS), F.min("supporting_claim").alias("supporting_claim"), F.min("contradicting_claim").alias("contradicting_claim"),
    )
    return out.withColumns({"direction": direction(F.col("n_supporting"), F.col("n_contradicting")), "clinical_direction": R.clinical_direction(F.col("predicate"), F.col("object_concept_id"))})


def first_quotes(conclusion_rows: DataFrame, evidence: DataFrame) -> DataFrame:
    """The quotes that stand for a conclusion: of its smallest supporting claim, and of its smallest contradicting one, the first piece of evidence that has a text.

    evidence: claim_id, document_id, start_char, end_char, quoted_text, and reconstructed, which counts first.
    """
    text = F.coalesce(F.nullif("reconstructed", F.lit("")) if "reconstructed" in evidence.columns else F.lit(None).cast("string"), F.nullif("quoted_text", F.lit("")))
    rows = evidence.withColumn("text", text).filter("text is not null")
    first = rows.groupBy("claim_id").agg(F.min(F.struct("document_id", "start_char", "end_char", "text")).alias("q"))
    sides = F.explode(F.array(*(F.struct(F.lit(side).alias("side"), F.col(f"{side}_claim").alias("claim_id")) for side in ("supporting", "contradicting")))).alias("s")
    asked = conclusion_rows.select(*CONCLUSION, sides).select(*CONCLUSION, "s.side", "s.claim_id").filter("claim_id is not null")
    return asked.join(first, "claim_id").select(*CONCLUSION, "side", "claim_id", "q.document_id", F.col("q.text").alias("quoted_text"))


FOOD = ["food_concept_id", "predicate", "object_concept_id", "qualifier_sig", "modifier_sig"]


def at_foods(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows about compounds as rows about the foods that they are found in, but for a food that is the object."""
    return rows.join(edges, rows["subject_concept_id"] == edges["source_concept_id"]).filter(F.col("food_concept_id") != F.col("object_concept_id"))


def food_conclusions(papers: DataFrame, edges: DataFrame) -> DataFrame:
    """``derive_foods`` as counts: a paper counts once for a food, whatever compounds it speaks of.  papers: rows of ``conclusion_papers``."""
    carried = at_foods(papers, edges)
    once = carried.groupBy(*FOOD, "document_id").agg(F.bool_or("supports").alias("supports"), F.bool_or("contradicts").alias("contradicts"), F.bool_or("is_neutral").alias("is_neutral"), F.min("food_name").alias("food_name"), F.min_by("object_name", "source_concept_id").alias("object_name"))
    counts = once.groupBy(*FOOD).agg(F.min("food_name").alias("food_name"), F.min("object_name").alias("object_name"), F.count("*").alias("paper_count"), F.count_if("supports").alias("n_supporting"), F.count_if("contradicts").alias("n_contradicting"), F.count_if("is_neutral").alias("n_neutral"))
    # compounds of an ontology, of which a food has a bounded number
    via = carried.select(*FOOD, "source_concept_id").distinct().groupBy(*FOOD).agg(F.array_sort(F.collect_list("source_concept_id")).alias("via"))
    return counts.join(via, FOOD).withColumns({"direction": direction(F.col("n_supporting"), F.col("n_contradicting")), "clinical_direction": R.clinical_direction(F.col("predicate"), F.col("object_concept_id"))})


def food_evidence(quotes: DataFrame, edges: DataFrame) -> DataFrame:
    """Quotes carried over to foods: one for each food's conclusion, paper and claim.  quotes: rows of ``first_quotes``."""
    return at_foods(quotes, edges).groupBy(*FOOD, "document_id", "claim_id").agg(F.min("quoted_text").alias("quoted_text"))


def ranked(conclusions: DataFrame, first: str = "subject_name", by: str = "subject_concept_id") -> DataFrame:
    """Conclusions with the most papers first, in a total order."""
    return conclusions.orderBy(F.desc("paper_count"), F.lower(first), "predicate", F.lower("object_name"), by, "object_concept_id", "qualifier_sig", "modifier_sig")


def derive_foods(conclusions: DataFrame, edges: DataFrame) -> DataFrame:
    """Conclusions about compounds carried over to the foods they are found in.

    edges: source_concept_id, food_concept_id, food_name; a bounded ontology, broadcast by Spark where it is small.  Papers are united and each compound is listed once.
    """
    rows = conclusions.join(edges, conclusions["subject_concept_id"] == edges["source_concept_id"]).filter(F.col("food_concept_id") != F.col("object_concept_id"))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    grouped = rows.groupBy("food_concept_id", "predicate", "object_concept_id", "qualifier_sig", "modifier_sig").agg(
        F.min("food_name").alias("food_name"), F.min_by("object_name", "source_concept_id").alias("object_name"), F.min_by("clinical_direction", "source_concept_id").alias("clinical_direction"),
        union("supporting").alias("supporting"), union("contradicting").alias("contradicting"), union("neutral").alias("neutral"),
        F.array_sort(F.collect_set("source_concept_id")).alias("via"),
    )
    all_papers = F.array_union(F.array_union("supporting", "contradicting"), "neutral")
    return grouped.withColumns({"paper_count": F.size(all_papers), "direction": direction(F.size("supporting"), F.size("contradicting"))})


def batch_facts(papers: DataFrame, funding: DataFrame | None = None) -> DataFrame:
    """(kind, value, papers): counts by design and source type, with funding by funder type, and the range of years.

    papers: document_id, study_design, publication_year, source_type; funding: document_id, funder_type.
    """
    count = lambda rows, c: rows.groupBy(F.lit(c).alias("kind"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")).agg(F.count_distinct("document_id").alias("papers"))
    years = papers.agg(F.min("publication_year").alias("lo"), F.max("publication_year").alias("hi"), F.count("publication_year").alias("papers"))
    years = years.select(F.lit("year_range").alias("kind"), F.format_string("%s-%s", "lo", "hi").alias("value"), "papers")
    rows = count(papers, "study_design").unionByName(count(papers, "source_type")).unionByName(years)
    return rows if funding is None else rows.unionByName(count(funding.join(papers.select("document_id"), "document_id", "left_semi"), "funder_type"))


def topic_frequency(sets: DataFrame) -> DataFrame:
    """(concept_id, papers): how many papers have each concept.  sets: document_id, concept_id (null for a paper without)."""
    return sets.filter("concept_id is not null").groupBy("concept_id").agg(F.count_distinct("document_id").alias("papers"))


def self_loops(rows: DataFrame, by: str | None = None) -> DataFrame:
    """(group,) loops, total, rate of claims or observations whose two concepts are one."""
    loop = F.count_if(F.col("subject_concept_id") == F.col("object_concept_id")).alias("self_loops")
    grouped = rows.groupBy(by) if by else rows
    return grouped.agg(loop, F.count("*").alias("total")).withColumn("rate", F.coalesce(F.try_divide("self_loops", "total"), F.lit(0.0)))


def mechanisms(obs: DataFrame) -> DataFrame:
    """(mechanism, n), zeros included, of self-loop observations: subject_text, object_text, distance, between."""
    loops = obs.filter(F.col("subject_concept_id") == F.col("object_concept_id"))
    found = loops.select(R.mechanism(F.col("subject_text"), F.col("object_text"), F.col("distance"), F.col("between")).alias("mechanism"))
    names = obs.sparkSession.createDataFrame([(m,) for m in ("sub_phrase", "long_window", "list_like", "topic_repeat")], "mechanism string")
    return names.join(found.groupBy("mechanism").agg(F.count("*").alias("n")), "mechanism", "left").fillna(0, "n")


def estimated_fp(rate: Column, p_alias: Column) -> Column:
    return F.when(p_alias > 0, F.least(F.lit(1.0), rate / p_alias))


ENDS = "concept_id string, text string"
GRADED = ("predicate", "polarity", "certainty")


def gold_alignment(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Outcome of every expected and every left-over produced observation of the gold sentences.

    expected: sentence_id, k (order), subject/object_text and _concept_id, in_vocab, predicate, polarity, certainty, failure_mode;
    produced: sentence_id, k, the same fields.  Within a sentence each expected one takes, in order, the first produced one
    that is still free and has matching endpoints; this is a fold over the sentence's few rows.
    """
    ends = ("subject_text", "subject_concept_id", "object_text", "object_concept_id", *GRADED)
    both = expected.select("sentence_id", F.struct("k", *ends, "in_vocab", "failure_mode").alias("e")).unionByName(produced.select("sentence_id", F.struct("k", *ends).alias("p")), allowMissingColumns=True)
    rows = both.filter("sentence_id is not null").groupBy("sentence_id").agg(F.array_sort(F.collect_list("e")).alias("exp"), F.array_sort(F.collect_list("p")).alias("prod")).filter("size(exp) > 0")

    def same(x: Column, y: Column, side: str) -> Column:
        a, b = F.lower(F.trim(x[f"{side}_text"])), F.lower(F.trim(y[f"{side}_text"]))
        texts = (F.length(a) > 0) & (F.length(b) > 0) & (F.contains(a, b) | F.contains(b, a))
        return F.coalesce(F.when(x[f"{side}_concept_id"].isNotNull() & y[f"{side}_concept_id"].isNotNull(), x[f"{side}_concept_id"] == y[f"{side}_concept_id"]).otherwise(texts), F.lit(False))

    start = F.struct(F.col("prod").alias("free"), F.slice(F.transform("prod", lambda y: F.struct(F.when(y["k"].isNotNull(), y).alias("got"))), 1, 0).alias("taken"))

    def take(acc: Column, x: Column) -> Column:
        found = F.get(F.filter(acc["free"], lambda y: same(x, y, "subject") & same(x, y, "object")), F.lit(0))
        free = lambda hit: F.when(hit.isNull(), acc["free"]).otherwise(F.filter(acc["free"], lambda y: y["k"] != hit["k"]))
        return let(found, lambda hit: F.struct(free(hit).alias("free"), F.concat(acc["taken"], F.array(F.struct(hit.alias("got")))).alias("taken")))

    def graded(x: Column, got: Column) -> Column:
        wrong = F.concat_ws("_", *(F.when(x[f] != got[f], F.lit(f)) for f in GRADED))
        outcome = F.when(got.isNull(), "missed").when(wrong == "", "correct").otherwise("field_error")
        label = F.when(got.isNull(), F.coalesce(x["failure_mode"], F.lit("missing"))).when(wrong != "", F.coalesce(x["failure_mode"], F.concat(F.lit("wrong_"), wrong)))
        return F.struct(x["k"].cast("int").alias("k"), outcome.alias("outcome"), x["in_vocab"].alias("in_vocab"), label.alias("failure_mode"))

    spare = lambda y: F.struct(y["k"].cast("int").alias("k"), F.lit("spurious").alias("outcome"), F.lit(False).alias("in_vocab"), F.lit("spurious").alias("failure_mode"))
    done = rows.select("sentence_id", "exp", F.aggregate("exp", start, take).alias("done"))
    outcomes = F.concat(F.zip_with("exp", F.col("done.taken"), lambda x, t: graded(x, t["got"])), F.transform("done.free", spare))
    return done.select("sentence_id", F.explode(outcomes).alias("x")).select("sentence_id", "x.*")


def gold_scores(alignment: DataFrame) -> DataFrame:
    """One row: counts, precision, recall (all and achievable) and F1."""
    n = lambda o, v=None: F.count_if((F.col("outcome") == o) & (F.lit(True) if v is None else F.col("in_vocab")))
    rows = alignment.agg(*(n(o).alias(o) for o in ("correct", "field_error", "missed", "spurious")), *(n(o, 1).alias(f"achievable_{o}") for o in ("correct", "field_error", "missed")))
    d = F.try_divide
    c, f, m, s = (F.col(x) for x in ("correct", "field_error", "missed", "spurious"))
    ac, af, am = (F.col(f"achievable_{x}") for x in ("correct", "field_error", "missed"))
    rows = rows.withColumns({
        "precision_strict": d(c, c + f + s), "precision_lenient": d(c + f, c + f + s), "recall_strict": d(c, c + f + m), "recall_lenient": d(c + f, c + f + m),
        "recall_achievable_strict": d(ac, ac + af + am), "recall_achievable_lenient": d(ac + af, ac + af + am),
    })
    f1 = lambda p, r: F.when((p > 0) & (r > 0), 2 * p * r / (p + r))
    return rows.withColumns({"f1_strict": f1(F.col("precision_strict"), F.col("recall_strict")), "f1_achievable": f1(F.col("precision_strict"), F.col("recall_achievable_strict"))})


def top_documents(rows: DataFrame, n: int = 10) -> DataFrame:
    """The documents with the most self-loops (a report, so it has a length)."""
    return self_loops(rows, "document_id").orderBy(F.desc("self_loops"), "document_id").limit(n)


def first_per(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group."""
    return rows.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__k = 1").drop("__k")
