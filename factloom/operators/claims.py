"""Claims: observations folded by concept, polarity, certainty and conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

KEY = ["document_id", "subject_concept_id", "predicate", "object_concept_id", "polarity", "certainty", "qualifier_sig", "subject_sig", "object_sig"]


def signatures(rows: DataFrame, owner: str, kind: str, name: str) -> DataFrame:
    """(owner, name): the sorted ``type=value`` signature of child rows (owner, kind, value_concept_id, value_text)."""
    value = F.coalesce("value_concept_id", T.surface_key(F.col("value_text")))
    grouped = rows.groupBy(owner).agg(F.collect_set(F.struct(F.col(kind).alias("type"), value.alias("value"))).alias("x"))
    return grouped.select(owner, T.signature(F.col("x")).alias(name))


def with_signatures(obs: DataFrame, quals: DataFrame | None = None, mods: DataFrame | None = None) -> DataFrame:
    """Observations with the signatures of their clause's qualifiers and of their endpoints' localising modifiers."""
    blank = F.lit("")
    if quals is not None:
        obs = obs.join(signatures(quals, "clause_id", "qualifier_type", "qualifier_sig"), "clause_id", "left")
    if mods is not None:
        sites = signatures(mods.filter("relation = 'localized_in'"), "owner_id", "relation", "sig")
        for side in ("subject", "object"):
            obs = obs.join(sites.select(F.col("owner_id").alias(f"{side}_mention_id"), F.col("sig").alias(f"{side}_sig")), f"{side}_mention_id", "left")
    for c in ("qualifier_sig", "subject_sig", "object_sig"):
        obs = obs.withColumn(c, F.coalesce(F.col(c), blank) if c in obs.columns else blank)
    return obs


def claim_id():
    """Digest of the fold's key; conditions count only where there are some."""
    parts = [F.col(c) for c in KEY if not c.endswith("_sig")]
    q = F.col("qualifier_sig")
    m = F.when((F.col("subject_sig") != "") | (F.col("object_sig") != ""), F.format_string("subj[%s]|obj[%s]", "subject_sig", "object_sig")).otherwise("")
    return F.concat(F.col("document_id"), F.lit("_claim_"), T.digest(*parts, q, m))


def owners(obs: DataFrame) -> DataFrame:
    """Observations (with signatures) with the claim that each makes, which their own columns tell: no fold is needed for it."""
    return obs.filter(F.col("subject_concept_id").isNotNull() & F.col("object_concept_id").isNotNull()).withColumn("claim_id", claim_id())


def fold(obs: DataFrame, concepts: DataFrame | None = None, lists: bool = True, told: list[str] | None = None) -> DataFrame:
    """One row per claim: names, contexts, sorted observation ids and evidence spans.

    Without ``lists`` ids and spans are left out, and the number of observations and the first id stand for them; ``told`` names columns that come as ``observations``, a list by id.

    Observations without both concepts make no claim.  concepts: concept_id, canonical_name; without it, or for a concept that is not in it,
    the first observation's text is the name.  One shuffle by the key; copies of evidence are dropped in the map-side sets.
    """
    rows = obs.filter(F.col("subject_concept_id").isNotNull() & F.col("object_concept_id").isNotNull())
    held = [
        F.array_sort(F.collect_set("observation_id")).alias("observation_ids"),
        F.array_sort(F.collect_set(F.struct(F.coalesce("evidence_start", F.lit(-1)).alias("start_char"), F.coalesce("sentence_id", F.lit("")).alias("sentence_id"), F.col("rule_id"), F.col("evidence_end").alias("end_char")))).alias("evidence"),
    ] if lists else [F.count("*").alias("n_observations"), F.min("observation_id").alias("first_observation")]
    if told:
        held.append(F.array_sort(F.collect_list(F.struct("observation_id", *told))).alias("observations"))
    grouped = rows.groupBy(*KEY).agg(
        F.min_by("subject_text", "observation_id").alias("subject_text"), F.min_by("object_text", "observation_id").alias("object_text"), F.array_join(F.array_sort(F.collect_set("context")), "; ").alias("context"), *held
    ).withColumn("context", F.nullif("context", F.lit("")))
    for side in ("subject", "object"):
        name = F.col(f"{side}_text")
        if concepts is not None:
            names = F.broadcast(concepts.select(F.col("concept_id").alias(f"{side}_concept_id"), F.col("canonical_name").alias(f"{side}_known")))
            grouped = grouped.join(names, f"{side}_concept_id", "left")
            name = F.coalesce(F.col(f"{side}_known"), name)
        grouped = grouped.withColumn(f"{side}_name", name)
    return grouped.select(claim_id().alias("claim_id"), *KEY, "subject_name", "object_name", "context", *(c for c in ("observation_ids", "evidence", "n_observations", "first_observation", "observations") if c in grouped.columns))


def dropped(obs: DataFrame) -> DataFrame:
    """(document_id, dropped): observations that make no claim."""
    return obs.filter(F.col("subject_concept_id").isNull() | F.col("object_concept_id").isNull()).groupBy("document_id").agg(F.count("*").alias("dropped"))


def evidence_rows(claims: DataFrame) -> DataFrame:
    return claims.select("claim_id", "document_id", F.explode("evidence").alias("e")).select("claim_id", "document_id", "e.*")


def parents(links: DataFrame) -> DataFrame:
    """(claim_id, parent_claim_id) where all parent observations that made a claim agree on one other claim.

    links: claim_id, parent_claim_id of each observation that has a parent (see ``owners`` and ``linked``).
    """
    grouped = links.filter("claim_id <> parent_claim_id").groupBy("claim_id").agg(F.min("parent_claim_id").alias("lo"), F.max("parent_claim_id").alias("hi"))
    return grouped.filter("lo = hi").select("claim_id", F.col("lo").alias("parent_claim_id"))


def linked(claims: DataFrame, obs: DataFrame) -> DataFrame:
    """Links for ``parents`` from claims' lists of ids.  obs: observation_id, parent_observation_id."""
    owner = claims.select("claim_id", F.explode("observation_ids").alias("observation_id"))
    up = owner.join(obs.select("observation_id", "parent_observation_id").filter("parent_observation_id is not null"), "observation_id")
    target = owner.select(F.col("observation_id").alias("parent_observation_id"), F.col("claim_id").alias("parent_claim_id"))
    return up.join(target, "parent_observation_id").select("claim_id", "parent_claim_id")


def qualifiers_of(claims: DataFrame, obs: DataFrame, quals: DataFrame) -> DataFrame:
    """Qualifiers of each claim: the union over its observations, one row per condition, with the first observation's text."""
    owner = claims.select("claim_id", F.explode("observation_ids").alias("observation_id"))
    rows = owner.join(obs.select("observation_id", "clause_id"), "observation_id").join(quals, "clause_id")
    return rows.groupBy("claim_id", "qualifier_type", "value").agg(
        F.first("value_concept_id", ignorenulls=True).alias("value_concept_id"), F.min_by("value_text", "observation_id").alias("value_text"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")
    )


def modifiers_of(claims: DataFrame, obs: DataFrame, mods: DataFrame) -> DataFrame:
    """Localising modifiers of each claim's endpoints, one row per endpoint and value, with the first observation's text.  obs: with both mention ids."""
    owner = claims.select("claim_id", F.explode("observation_ids").alias("observation_id")).join(obs.select("observation_id", "subject_mention_id", "object_mention_id"), "observation_id")
    ends = owner.select("claim_id", "observation_id", F.explode(F.create_map(F.lit("subject"), "subject_mention_id", F.lit("object"), "object_mention_id")).alias("endpoint", "owner_id"))
    rows = ends.join(mods.filter("relation = 'localized_in'").select("owner_id", "relation", "value_concept_id", "value_text"), "owner_id")
    value = F.coalesce("value_concept_id", T.surface_key(F.col("value_text")))
    return rows.groupBy("claim_id", "endpoint", "relation", value.alias("value")).agg(F.first("value_concept_id", ignorenulls=True).alias("value_concept_id"), F.min_by("value_text", "observation_id").alias("value_text")).drop("value")


def with_children(claims: DataFrame, quals: DataFrame, mods: DataFrame) -> DataFrame:
    """Claims with their qualifiers and modifiers as arrays; children are grouped before they are joined."""
    q = quals.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("qualifier_type", "value_concept_id", "value_text"))).alias("qualifiers"))
    m = mods.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("endpoint", "relation", "value_concept_id", "value_text"))).alias("modifiers"))
    return claims.join(q, "claim_id", "left").join(m, "claim_id", "left")
