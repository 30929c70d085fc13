"""Dimension lookups and joins on keys that some rows share very often."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """Join a dimension on the right; Catalyst and AQE broadcast it when its bytes allow, else both sides shuffle.

    Nothing is counted or cached while the plan is built. A busy key of a shuffled join is split by AQE's
    skew handling (left, inner, semi and anti joins keep the fact, the skewed side, on the left).
    """
    return fact.join(dim, on, how)


def counted_join(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner", parts: int = 1024) -> DataFrame:
    """Join with a table that has each key once and its number of left rows in ``count``; no key makes a hot task.

    A key with more than 1/``parts`` of the counted rows is dealt in pieces by a hash of the left row, and its one
    right row is repeated per piece. Fewer than ``parts`` keys can be that frequent, which bounds the broadcast list.
    """
    limit = max((right.agg(F.sum(count)).first()[0] or 0) // parts, 100)
    pieces = F.ceil(F.col(count) / limit).cast("int")
    heavy = right.where(F.col(count) > limit).select(key, pieces.alias("_pieces"))
    piece = F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(*left.columns), F.col("_pieces"))).cast("int")
    dealt = left.join(F.broadcast(heavy), key, "left").withColumn("_piece", piece).drop("_pieces")
    copies = F.when(F.col(count) > limit, pieces).otherwise(1)
    repeated = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.join(repeated, [key, "_piece"], how).drop("_piece")
