"""Command line: ingest, list, show, export, claims, analyze, foods, self-loops, eval-gold and eval-quotes over a store.

    python -m factloom.cli ingest --store DIR --raw DIR      raw archive laid out as <pmid>/raw/<name>
    python -m factloom.cli claims --store DIR [--subject X] [--condition X] [--predicate P] [--polarity P]
    python -m factloom.cli analyze --store DIR [--core-fraction F] [--threshold F]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import analysis, query
from .plans import analyze, persist
from .plans import rules as R
from .plans.extract import in_order, of_quotes
from .sources import vocabulary, xml
from .sources.store import Store


POLARITIES, CERTAINTIES = ["positive", "negative", "neutral"], ["asserted", "possible", "hypothetical", "insufficient_evidence"]
PREDICATES = sorted({r[1] for r in R.RELATION_RULES} | {*R.VERB_PREDICATES.values(), *R.RISK_PROMOTION.values(), *R.DIRECTED_ASSOCIATION.values(), *R.ABUNDANCE.values(), *R.CAUTION, *R.NULL_EFFECT})


def printed(rows: DataFrame) -> None:
    """All rows, tab-separated under their names, fetched part by part."""
    print("\t".join(rows.columns))
    for r in rows.toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in r))


def gold_rows(spark: SparkSession, path: str) -> DataFrame:
    """Expected observations of a gold file, in file order; unscorable ones are left out, values that no rule can give are an error."""
    g = spark.read.option("multiLine", True).json(path).select(F.posexplode("sentences").alias("si", "s"))
    e = g.select("s.sentence_id", F.posexplode("s.expected").alias("k", "e"))

    def one_of(field: str, values: list[str]):
        value = F.col(f"e.{field}")
        return F.when(value.isin(values), value).otherwise(F.raise_error(F.concat(F.lit(f"unknown {field} "), F.coalesce(value, F.lit("null")))))

    predicate, polarity, certainty = one_of("predicate", PREDICATES), one_of("polarity", POLARITIES), one_of("certainty", CERTAINTIES)
    rows = e.filter(~F.coalesce(F.col("e.unscorable"), F.lit(False))) if "unscorable" in e.select("e.*").columns else e
    return rows.select(
        "sentence_id", F.col("k").cast("int").alias("k"), F.col("e.subject.text").alias("subject_text"), F.col("e.subject.concept_id").alias("subject_concept_id"), F.col("e.object.text").alias("object_text"),
        F.col("e.object.concept_id").alias("object_concept_id"), predicate.alias("predicate"), polarity.alias("polarity"), certainty.alias("certainty"),
        (F.col("e.subject.in_vocab") & F.col("e.object.in_vocab")).alias("in_vocab"), F.col("e.failure_mode").alias("failure_mode"),
    )


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="factloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("ingest", "list", "export", "claims", "analyze", "foods", "self-loops", "eval-gold", "eval-quotes", "show"):
        p = sub.add_parser(name)
        p.add_argument("--store", required=True)
        for option, kind in (("--raw", str), ("--table", str), ("--pmid", str), ("--gold", str), ("--subject", str), ("--condition", str), ("--predicate", str), ("--polarity", str)):
            p.add_argument(option, type=kind)
        p.add_argument("--core-fraction", type=float, default=0.5)
        p.add_argument("--threshold", type=float, default=0.2)
    a = top.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    s = Store(spark, a.store)
    if a.command == "ingest":
        persist.ingest(s, xml.read_raw(spark, a.raw))
    elif a.command == "list":
        printed(s.read("documents").select("document_id", "title", "journal", "publication_date").orderBy("document_id"))
    elif a.command == "export":
        rows = s.read(a.table)
        for line in (rows.filter(F.col("document_id") == f"pmid_{a.pmid}") if a.pmid else rows).toJSON().toLocalIterator():
            print(line)
    elif a.command == "claims":
        printed(query.find_claims(s.read("claims"), subject=a.subject, condition=a.condition, predicate=a.predicate, polarity=a.polarity).orderBy("claim_id"))
    elif a.command in ("analyze", "foods"):
        out = analyze.batch(s.read("documents").select("document_id", "title"), s.read("entity_mentions"), s.read("claims"), a.core_fraction, a.threshold)
        if a.command == "foods":
            printed(analysis.ranked(analysis.derive_foods(out["conclusions"], vocabulary.edges(spark, vocabulary.concepts(spark))), "food_name", "food_concept_id"))
        else:
            for name in ("excluded", "cohesion", "conclusions"):
                print(name)
                printed(out[name])
    elif a.command == "self-loops":
        printed(analysis.self_loops(s.read("claims"), "predicate").orderBy("predicate"))
    elif a.command == "eval-gold":
        gold = gold_rows(spark, a.gold)
        made = in_order(s.read("observations").join(gold.select("sentence_id").distinct(), "sentence_id", "left_semi"))
        printed(analysis.gold_scores(analysis.gold_alignment(gold, made)))
    elif a.command == "eval-quotes":
        printed(quote_scores(spark, a.gold))
    elif a.command == "show":
        printed(query.listed(s, a.table, f"pmid_{a.pmid}"))


def quote_scores(spark: SparkSession, path: str, **options) -> DataFrame:
    """Scores of a gold file whose sentences carry their text, without a store: the plan runs over the quotes themselves."""
    quotes = spark.read.option("multiLine", True).json(path).select(F.explode("sentences").alias("s")).select("s.sentence_id", "s.quote")
    return analysis.gold_scores(analysis.gold_alignment(gold_rows(spark, path), of_quotes(quotes, **options)))


if __name__ == "__main__":
    main()
