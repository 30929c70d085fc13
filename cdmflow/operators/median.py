"""Exact ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY v)`` per group, without one task per group.

Spark's built-in exact ``percentile`` merges every distinct value of a group in one
task; with a handful of groups (median ferritin by sex) that is a third of the data
per task. Here the selection is positional instead:

1. pre-aggregate to (group, value, weight) - repeated values collapse map-side;
2. range-partitioned sort on (group, value), staged once;
3. the weights per (sort partition, group) locate the at most two partitions of each group
   that hold the ranks floor(p*(n-1)) and ceil(p*(n-1)); only those are read on;
4. a running sum inside them finds the rows at both ranks, which are interpolated as
   PostgreSQL/DuckDB do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import sorted_positions
from ..session import stage_path


def grouped_percentile_cont(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    p: float = 0.5,
    out: str = "percentile",
    count_out: str | None = None,
) -> DataFrame:
    """One row per group: exact continuous percentile of ``value`` (NULLs ignored) and optionally the count."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    gcols = list(groups)
    vals = (df.where(F.col(value).isNotNull())
              .groupBy(*gcols, value).agg(F.count(F.lit(1)).alias("_w")))
    spark = df.sparkSession
    staged = sorted_positions(vals, [*gcols, value], name="percentile")
    # weight of every (sort partition, group): the sort keeps a group together, so there are at most
    # (partitions + groups) rows, and no group has more of them than there are partitions
    parts = staged.groupBy("_pos_part", *gcols).agg(F.sum("_w").alias("_pw"))
    whole = Window.partitionBy(*gcols)
    before = whole.orderBy("_pos_part").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.lit(p) * (F.sum("_pw").over(whole) - 1)
    parts = parts.select("_pos_part", *gcols, F.sum("_pw").over(whole).alias("_n"), "_pw",
                         F.coalesce(F.sum("_pw").over(before), F.lit(0)).alias("_skip"),
                         F.floor(rank).alias("_lo"), F.ceil(rank).alias("_hi"), (rank - F.floor(rank)).alias("_frac"))

    def holds(rank_col: str, begin: Column, end: Column) -> Column:
        return (begin <= F.col(rank_col)) & (F.col(rank_col) < end)

    first, last = F.col("_skip"), F.col("_skip") + F.col("_pw")
    path = stage_path(spark, "percentile-parts")  # stored, so the join below knows its size in bytes
    parts.where(holds("_lo", first, last) | holds("_hi", first, last)).write.parquet(path)
    wanted = spark.read.schema(parts.schema).parquet(path).alias("s")
    # only the partitions that hold a rank (at most two per group) go on
    same = reduce(lambda a, b: a & b, [F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}")) for g in gcols],
                  F.col("r._pos_part") == F.col("s._pos_part"))
    near = staged.alias("r").join(wanted, same).select(
        *[F.col(f"r.{g}").alias(g) for g in gcols], "r._pos_part", F.col(f"r.{value}").alias("_v"), "r._w",
        "_skip", "_lo", "_hi", "_frac", "_n")
    upto = Window.partitionBy("_pos_part", *gcols).orderBy("_v").rowsBetween(Window.unboundedPreceding,
                                                                            Window.currentRow)
    near = near.withColumn("_end", F.col("_skip") + F.sum("_w").over(upto)).withColumn(
        "_begin", F.col("_end") - F.col("_w"))
    at_lo, at_hi = holds("_lo", F.col("_begin"), F.col("_end")), holds("_hi", F.col("_begin"), F.col("_end"))
    picked = near.where(at_lo | at_hi).select(*gcols, F.when(at_lo, F.col("_v")).alias("_vlo"),
                                              F.when(at_hi, F.col("_v")).alias("_vhi"), "_frac", "_n")
    res = picked.groupBy(*gcols).agg(
        F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"),
        F.first("_frac").alias("_frac"), F.first("_n").alias("_n"))
    result = F.col("_vlo").cast("double") + F.col("_frac") * (F.col("_vhi").cast("double")
                                                             - F.col("_vlo").cast("double"))
    cols = [*gcols, result.alias(out)]
    if count_out:
        cols.append(F.col("_n").cast("long").alias(count_out))
    return res.select(*cols)
