"""Observations: binding mentions to subject, predicate and object.

The flat binder pairs neighbouring mentions of a clause whose connecting text holds a relation cue.  Mentions that are part
of a qualifier are transparent; if nothing binds without them they may serve as endpoints; a clause with a single object and no pair
borrows the subject of the latest earlier clause that had one.  All of it is expressions over a clause's mentions and one window over a sentence's clauses: there is
no iteration, since a clause that borrows a subject never sets one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans import rules as R


def flag_qualifier_mentions(cm: DataFrame, quals: DataFrame) -> DataFrame:
    """Adds is_q: whether a mention overlaps a span of a qualifier of its clause.  quals: clause_id, spans."""
    spans = quals.groupBy("clause_id").agg(F.flatten(F.collect_list("spans")).alias("q_spans"))
    rows = cm.join(spans, "clause_id", "left")
    hit = F.exists("q_spans", lambda x: (x["start_char"] < F.col("end_char")) & (F.col("start_char") < x["end_char"]))
    return rows.withColumn("is_q", F.coalesce(hit, F.lit(False))).drop("q_spans")


#: What a pair keeps of each endpoint.
ENDPOINT = ("mention_id", "surface_text", "concept_id", "start_char", "end_char")


def neighbours(found: Column, text: Column, begin: Column, rules: list[tuple]) -> Column:
    """Pairs of neighbours of a clause's ordered mentions with a relation rule that matches the text between them: array<struct<subject, object, rule>>; overlapping neighbours are no pair."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    both = F.filter(F.zip_with(F.slice(found, F.lit(1), n), F.slice(found, F.lit(2), n), lambda s, o: F.struct(s.alias("s"), o.alias("o"))), lambda x: x["o"]["start_char"] >= x["s"]["end_char"])

    def ruled(x: Column) -> Column:
        between = F.substring(text, x["s"]["end_char"] - begin + 1, x["o"]["start_char"] - x["s"]["end_char"])
        return F.struct(endpoint(x["s"]).alias("subject"), endpoint(x["o"]).alias("object"), R.match_relation(between, rules).alias("rule"))

    return F.filter(F.transform(both, ruled), lambda x: x["rule"].isNotNull())


def endpoint(m: Column) -> Column:
    return F.struct(*(m[c].alias(c) for c in ENDPOINT))


def flat_bind(found: DataFrame, clause_rows: DataFrame, quals: DataFrame, rules: list[tuple] = R.RELATION_RULES) -> DataFrame:
    """Observations of the flat binder.

    found: mentions; clause_rows: clauses with their text; quals: qualifiers of clauses (clause_id, qualifier_type, value, spans).  Mentions are dealt once by sentence, as lists; a mention that straddles a marker is in no clause.
    All else is expressions over a clause's own text and mentions, so no row is read twice and no text is joined to each mention.
    """
    spans = quals.groupBy("clause_id").agg(F.flatten(F.collect_list("spans")).alias("q_spans"))
    of = found.filter("sentence_id is not null").groupBy(F.col("sentence_id").alias("cs")).agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char", "mention_id", "surface_text", "concept_id"))).alias("all"))
    rows = clause_rows.join(spans, "clause_id", "left").join(of, F.col("sentence_id") == F.col("cs")).drop("cs")
    inside = F.filter("all", lambda m: (m["start_char"] >= F.col("start_char")) & (m["end_char"] <= F.col("end_char")))
    rows = rows.withColumn("all", inside).filter("size(all) > 0")
    in_condition = lambda m: F.exists("q_spans", lambda x: (x["start_char"] < m["end_char"]) & (m["start_char"] < x["end_char"]))
    rows = rows.withColumn("reduced", F.when(F.col("q_spans").isNull(), F.col("all")).otherwise(F.filter("all", lambda m: ~in_condition(m)))).drop("q_spans")
    n_all, n_reduced = F.size("all"), F.size("reduced")
    rows = rows.withColumn("one", neighbours(F.col("reduced"), F.col("text"), F.col("start_char"), rules))
    none = F.slice("one", 1, 0)
    again = (F.size("one") == 0) & (n_all >= 2) & (n_reduced < n_all)
    rows = rows.withColumn("two", F.when(again, neighbours(F.col("all"), F.col("text"), F.col("start_char"), rules)).otherwise(none))
    first = lambda c: F.when(F.size(c) > 0, endpoint(F.get(F.col(c), F.lit(0))))
    rows = rows.select(
        "document_id", "sentence_id", "clause_id", "clause_index", "marker", "contrastive", "text", F.col("start_char").alias("c_start"), F.when(F.size("one") > 0, F.col("one")).otherwise(F.col("two")).alias("made"),
        F.when(n_reduced >= 2, first("reduced")).when((F.size("two") > 0) & (n_reduced == 0), first("all")).alias("sets"),
        F.when(n_reduced > 0, F.when(n_reduced == 1, first("reduced"))).otherwise(F.when(n_all == 1, first("all"))).alias("lone"),
    )
    earlier = W.partitionBy("sentence_id").orderBy("clause_index").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("subject", F.last("sets", ignorenulls=True).over(earlier))
    lends = (F.size("made") == 0) & F.col("subject").isNotNull() & F.col("lone").isNotNull() & (F.col("subject.mention_id") != F.col("lone.mention_id"))
    region = F.substring(F.col("text"), F.lit(1), F.col("lone.start_char") - F.col("c_start"))
    borrowed = F.when(lends, F.filter(F.array(F.struct(F.col("subject").alias("subject"), F.col("lone").alias("object"), R.match_relation(region, rules).alias("rule"))), lambda x: x["rule"].isNotNull()))
    rows = rows.withColumn("x", F.explode(F.coalesce(borrowed, F.col("made"))))
    bound = rows.select("document_id", "sentence_id", "clause_id", "marker", "contrastive", "x.*", F.substring(F.col("text"), F.lit(1), F.greatest(F.col("x.object.start_char") - F.col("c_start"), F.lit(0))).alias("region"))
    # an id tells its sentence
    return observations(bound).dropDuplicates(["sentence_id", "observation_id"])


def observations(bound: DataFrame) -> DataFrame:
    """Observation rows from bound endpoints: modality over the region from clause start to object start, context, ids."""
    m = R.modality(F.col("region"), F.col("rule.base_polarity"), F.col("rule.flips"))
    note = F.when(F.col("marker").isNotNull(), F.concat(F.lit("clause:"), F.col("marker"), F.when(F.col("contrastive"), "(contrastive)").otherwise("(coordinating)")))
    rows = bound.withColumn("m", m)
    return rows.select(
        T.observation_id(F.col("document_id"), F.col("subject.start_char"), F.col("object.start_char"), F.col("rule.predicate")).alias("observation_id"),
        "document_id", "sentence_id", "clause_id",
        *(F.col(f"{side}.{c}").alias(f"{side}_{c.replace('surface_', '')}") for side in ("subject", "object") for c in ENDPOINT),
        F.col("rule.predicate").alias("predicate"), F.col("rule.rule_id").alias("rule_id"), F.lit(R.RULESET_VERSION).alias("rule_version"),
        F.col("m.polarity").alias("polarity"), F.col("m.certainty").alias("certainty"), F.nullif(F.concat_ws("; ", F.col("m.cue"), note), F.lit("")).alias("context"),
    )


def link_parents(obs: DataFrame) -> DataFrame:
    """Adds parent_observation_id: of the earlier observations of the sentence whose object is this one's subject, the earliest.

    Observations are ordered by (subject start, object start, predicate), so links can make no cycle.
    """
    key = F.struct(F.coalesce("subject_start_char", F.lit(-1)).alias("s"), F.coalesce("object_start_char", F.lit(-1)).alias("o"), "predicate", "observation_id")
    # the earliest of all is the earliest of those before
    first = obs.groupBy(F.col("sentence_id").alias("ps"), F.col("object_mention_id").alias("pm")).agg(F.min(key).alias("pk"))
    rows = obs.join(first, (F.col("sentence_id") == F.col("ps")) & (F.col("subject_mention_id") == F.col("pm")), "left")
    return rows.withColumn("parent_observation_id", F.when(F.col("pk") < key, F.col("pk.observation_id"))).drop("ps", "pm", "pk")


def pair_trace(cm: DataFrame, texts: DataFrame, rules: list[tuple] = R.RELATION_RULES) -> DataFrame:
    """Every pair of neighbouring mentions of a clause with what each rule made of the text between them, and the pair's outcome.

    cm: mentions in clauses, flagged (``flag_qualifier_mentions``).  rule_trace has, in order of priority, each rule with the cue that it found; the first that found one is ``chosen``, later ones are ``outranked`` and the
    others ``no_cue``.
    """
    ends = ("mention_id", "start_char", "end_char")
    order = W.partitionBy("clause_id").orderBy("start_char", "end_char")
    rows = cm.select("document_id", "sentence_id", "clause_id", "is_q", F.struct(*ends).alias("subject"), F.lead(F.struct(*ends, "is_q")).over(order).alias("object")).filter("object is not null")
    rows = rows.join(texts, "document_id")
    apart = F.col("object.start_char") >= F.col("subject.end_char")
    rows = rows.withColumn("between", F.when(apart, F.substring("canonical_text", F.col("subject.end_char") + 1, F.col("object.start_char") - F.col("subject.end_char"))))
    cues = F.array(*(F.struct(F.lit(r[0]).alias("rule_id"), F.nullif(F.regexp_extract(F.coalesce("between", F.lit("")), "(?iU)" + r[4], 0), F.lit("")).alias("cue")) for r in rules))
    rows = rows.withColumn("cues", cues)
    first = F.array_position(F.transform("cues", lambda c: c["cue"].isNotNull()), F.lit(True))
    verdict = lambda c, k: F.struct(c["rule_id"].alias("rule_id"), c["cue"].alias("cue"), F.when(c["cue"].isNull(), "no_cue").when(k + 1 == F.col("first"), "chosen").otherwise("outranked").alias("verdict"))
    rows = rows.withColumn("first", first).withColumn("rule_trace", F.transform("cues", verdict))
    outcome = F.when(~apart, "overlap").when(F.col("first") > 0, F.when(F.col("is_q") | F.col("object.is_q"), "cue_but_endpoint_is_condition").otherwise("cue")).otherwise("no_cue")
    return rows.withColumn("outcome", outcome).select("document_id", "sentence_id", "clause_id", F.col("subject.mention_id").alias("subject_mention_id"), F.col("object.mention_id").alias("object_mention_id"), "between", "rule_trace", "outcome")


def with_fallback(parsed: DataFrame, blocked: DataFrame, flat: DataFrame) -> DataFrame:
    """Parse observations, and flat ones of sentences where the parse made none and does not block them (blocked: sentence_id)."""
    rest = flat.join(parsed.select("sentence_id").distinct(), "sentence_id", "left_anti").join(blocked.select("sentence_id"), "sentence_id", "left_anti")
    return parsed.unionByName(rest.select(parsed.columns))
