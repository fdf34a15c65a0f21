"""Choice of one whole row for each (id, content) that is to stay, whatever ids are null or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def picked(docs: DataFrame, kept: DataFrame, again: DataFrame, own_id: Column, content: Column) -> DataFrame:
    """One row of ``docs`` for each row (id, content) of ``kept``, with all columns of ``docs``.

    ``own_id`` and ``content`` give a row's id and content.  ``again`` holds the (id, content) of ``kept`` that several rows of ``docs`` have; of these
    rows the one whose columns hash least stays.  Ids may be null.
    """
    hit = lambda keys: docs.join(keys, own_id.eqNullSafe(keys["id"]) & content.eqNullSafe(keys["content"]), "left_semi")
    if again.isEmpty():
        return hit(kept)
    single = hit(kept.join(again, kept["id"].eqNullSafe(again["id"]) & kept["content"].eqNullSafe(again["content"]), "left_anti"))
    # columns travel as one struct, so that no name clashes with those of the choice
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    several = hit(again).select(whole.alias("whole"), own_id.alias("id"), content.alias("content"), F.xxhash64(whole).alias("order"))
    several = several.withColumn("rank", F.row_number().over(W.partitionBy("id", "content").orderBy("order"))).filter("rank = 1")
    return single.unionByName(several.select(*(F.col("whole").getField(c).alias(c) for c in docs.columns)))


#: Keys that may have over 1 / HOT of all rows, and so rows of a broadcast table.
HOT = 4096


def looked_up(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join with a table of one row for each key and its number of rows: keys with over 1 / HOT of all rows, HOT at most, go to every task."""
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    hot = F.col(weight) > total / HOT
    often = rows.join(F.broadcast(table.filter(hot)), key)
    known = F.broadcast(table.filter(hot).select(key))
    return often.unionByName(rows.join(known, key, "left_anti").join(table.filter(~hot), key))
