"""Scalar helpers: value maps, tolerant parsing, rounding - all JVM-side expressions."""

from __future__ import annotations

from itertools import chain
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DMY = "dd/MM/yyyy"
YMD = "yyyyMMdd"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_map(c: str | Column, mapping: Mapping[str, int], default: int | None = 0) -> Column:
    """``CASE c WHEN k THEN v ... ELSE default END`` as a literal map lookup.

    A NULL or unknown value takes the default, like the SQL ELSE branch.
    """
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    hit = F.when(col(c).isNotNull(), F.try_element_at(m, col(c)))
    return F.coalesce(hit, F.lit(default)).cast("int") if default is not None else hit.cast("int")


def parse_dmy(c: str | Column) -> Column:
    """``DD/MM/YYYY`` text -> date; an impossible date (31/02) gives NULL instead of an error."""
    return F.try_to_date(col(c), DMY)


def parse_ymd(c: str | Column) -> Column:
    """``YYYYMMDD`` text -> date, NULL when malformed (vocabulary files)."""
    return F.try_to_date(col(c).cast("string"), YMD)


def to_number(c: str | Column) -> Column:
    """Staging text or number -> double; unparsable text gives NULL."""
    return col(c).try_cast("double")


def pct(n: Column, total: Column) -> Column:
    """``ROUND(n * 100.0 / total, 1)`` as a double."""
    return F.round(n * F.lit(100.0) / total, 1).cast("double")


def blank_to_null(c: str | Column) -> Column:
    """``NULLIF(c, '')``."""
    return F.nullif(col(c), F.lit(""))


def quoted(name: str) -> str:
    """A column name as Spark reads it literally (dots, blanks and back quotes included)."""
    return "`" + name.replace("`", "``") + "`"
