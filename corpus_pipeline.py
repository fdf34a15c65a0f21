"""The corpus pipeline: STAGES in order, each over all that its predecessor kept.

What the stages do with odd rows follows from their operators.  A null or empty text is scored as empty and stays unless the labels make the classifier reject empty texts; null and empty texts are exact copies of each other, of which the one with the
smallest id stays; a text without words is no near copy of anything; nothing is cut from it; it is packed as its end token alone.  Texts of any length are read whole.  Null ids sort after all others.  Of rows with one id, equal texts leave one row and
different texts stay.  A null lang has its own threshold.  All but the last stage return the columns that they were given, in order, other columns whatever they are called; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from factloom.llm.scratch import drop_named, live, released, written

#: Intermediate tables of the last stage that was called; its result is written before the next stage begins, which deletes them.
_leftover: set[str] = set()


def stage(of):
    """A stage that deletes the intermediate tables of the one before it, whose result is written by then."""

    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_named(spark, _leftover)
        released(spark)
        before = live()
        out = of(spark, docs, sf_dir)
        _leftover.clear()
        _leftover.update(live() - before)
        return out

    begin.__name__, begin.__doc__ = of.__name__, of.__doc__
    return begin


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not flag at their language's threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = toxicity.trained(docs, labels)
    limits = toxicity.language_thresholds(docs, labels, net, F.lit(True))
    return toxicity.accepted(docs, net, limits)


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return near_dedup.deduplicate(docs)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long strings that an earlier document has; n_chars follows the text."""
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, bpe.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]
#: Fitting, minimum-hash links and token packing have no SQL form; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each earlier stage is written as Parquet and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
