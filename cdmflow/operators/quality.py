"""Data-quality checks as single Spark jobs (row counts, unmapped values, coverage, orphans,
duplicate keys, NULLs in mandatory columns, unparsable dates and numbers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import DMY, quoted


def unmapped_values(df: DataFrame, concept_col: str, source_col: str) -> DataFrame:
    """T-DQ2: source values that still carry concept 0, with their row count."""
    return (df.where(F.col(concept_col) == 0).groupBy(F.col(source_col).alias("source_value"))
              .agg(F.count(F.lit(1)).alias("n")))


def person_coverage(events: DataFrame, person: DataFrame) -> DataFrame:
    """T-DQ3: persons represented in ``events`` vs all persons (one row)."""
    total = person.agg(F.count(F.lit(1))).scalar()
    n = F.count_distinct("person_id")
    return events.agg(n.alias("n_persons"), total.alias("total_persons"),
                      F.round(n * F.lit(100.0) / total, 1).cast("double").alias("pct_persons"))


def orphan_rows(child: DataFrame, parent: DataFrame, key: str, weight: str | None = None) -> Column:
    """T-DQ4 / T-JN7: number of ``child`` rows whose ``key`` has no ``parent`` row (scalar).

    The child is first reduced to (key, rows) - partial aggregation map-side - so the anti
    join moves one row per distinct key instead of every event. A NULL key never matches,
    so the anti join keeps it and it counts as an orphan. ``weight``: the child is already
    pre-aggregated and this column holds its row counts.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    per_key = child.groupBy(key).agg(rows.alias("_rows"))
    missing = per_key.join(parent.select(key), key, "left_anti")
    return F.coalesce(missing.agg(F.sum("_rows")).scalar(), F.lit(0)).cast("long")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """T-JN7: the child rows themselves (quarantine output)."""
    return child.join(parent.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T-DQ5: key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """T-DQ7: NULLs per column in one pass over the table -> (column_name, n_null)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.sum(F.col(quoted(c)).isNull().cast("long")).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(f"_{i}"), F.lit(0).cast("long")).alias("n_null"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def bad_dates(df: DataFrame, column: str, fmt: str = DMY, keep: Sequence[str] = ("record_id",)) -> DataFrame:
    """T-DQ6: rows whose date text is present but not a valid date (quarantine, not dropped)."""
    return df.where(F.col(column).isNotNull() & F.try_to_date(F.col(column), fmt).isNull()).select(
        *keep, F.col(column).alias("raw_value"), F.lit(column).alias("column_name"))


def bad_numbers(raw: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("record_id",)) -> DataFrame:
    """Numeric text that does not parse (quarantine): one pass over all ``columns``."""
    values = F.array(*[F.struct(F.col(quoted(c)).cast("string").alias("raw_value"), F.lit(c).alias("column_name"))
                       for c in columns])
    bad = F.filter(values, lambda v: v["raw_value"].isNotNull() & v["raw_value"].try_cast("double").isNull())
    return raw.select(*keep, F.inline(bad))


def split_valid_dates(df: DataFrame, column: str, fmt: str = DMY) -> tuple[DataFrame, DataFrame]:
    """(rows to load, quarantined rows); together they hold every input row."""
    bad = F.col(column).isNotNull() & F.try_to_date(F.col(column), fmt).isNull()
    return df.where(~bad), df.where(bad)
