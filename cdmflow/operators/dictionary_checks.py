"""Checks driven by the registry's data dictionary: choices, ranges, membership, required
fields, branching consistency and de-identification - each one pass over the registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.dictionary import DICTIONARY_ROWS, identifier_fields, numeric_ranges, required_fields

CHOICE_TYPES = ("dropdown", "radio", "checkbox")


def choice_table(dictionary: DataFrame) -> DataFrame:
    """D-DICT1: ``"1, Yes | 0, No"`` -> rows (variable, code, label); split at the first comma only."""
    parts = dictionary.where(F.col("field_type").isin(*CHOICE_TYPES) & F.col("choices").isNotNull()).select(
        "variable", F.explode(F.split("choices", r"\|")).alias("part"))
    parts = parts.where(F.trim("part") != "")
    comma = F.instr("part", ",")
    return parts.select(
        "variable",
        F.trim(F.expr("substring(part, 1, instr(part, ',') - 1)")).alias("code"),
        F.trim(F.expr("substring(part, instr(part, ',') + 1)")).alias("label"),
    ).where(comma > 0)


def _present(registry: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in registry.columns]


def _unpivot(registry: DataFrame, cols: Sequence[str], value_type: str = "string",
             keep: Sequence[str] = ("record_id",)) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {value_type})" for c in cols)
    return registry.selectExpr(*keep, f"stack({len(cols)}, {pairs}) AS (variable, value)")


def numeric_bounds(dictionary: DataFrame) -> DataFrame:
    """D-DICT2: (variable, lo, hi) of the dictionary's numeric fields; a bound that it does not state is NULL."""
    number = F.col("validation").isin("number", "integer") | (F.col("field_type") == "number")
    bounds = dictionary.where(number).select("variable", F.col("validation_min").try_cast("double").alias("lo"),
                                             F.col("validation_max").try_cast("double").alias("hi"))
    return bounds.where(F.col("lo").isNotNull() | F.col("hi").isNotNull())


def date_bounds(dictionary: DataFrame) -> DataFrame:
    """(variable, lo, hi) of the dictionary's day-first date fields; ``today`` is the day of the run."""
    def bound(c: str):
        return F.when(F.lower(F.trim(c)) == "today", F.current_date()).otherwise(F.try_to_date(F.trim(c), "dd/MM/yyyy"))
    return dictionary.where(F.col("validation") == "date_dmy").select(
        "variable", bound("validation_min").alias("lo"), bound("validation_max").alias("hi"))


def _names(dictionary: DataFrame) -> list[str]:
    return [r["variable"] for r in dictionary.select("variable").distinct().collect()]  # bounded: dictionary


def _with_bounds(registry: DataFrame, bounds: DataFrame, value_type: str) -> DataFrame:
    """The unpivoted answers of the bounded fields with their bounds; the dictionary's rows are the broadcast side."""
    cols = _present(registry, sorted(_names(bounds)))
    if not cols:
        return registry.sparkSession.createDataFrame([], f"record_id string, variable string, value {value_type}, lo {value_type}, hi {value_type}")
    return _unpivot(registry, cols, value_type).where(F.col("value").isNotNull()).join(F.broadcast(bounds), "variable")


def out_of_range(registry: DataFrame, ranges: dict[str, tuple[float, float]] | None = None,
                 dictionary: DataFrame | None = None) -> DataFrame:
    """D-DICT2: numeric answers outside the dictionary's min/max -> (record_id, variable, value, lo, hi).

    The bounds come from the scanned ``dictionary``, as a small joined table; without one from ``ranges`` or the fixed
    dictionary, riding along in the unpivot itself.
    """
    if dictionary is not None:
        bounded = _with_bounds(registry, numeric_bounds(dictionary), "double")
        return bounded.where((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))).select(
            "record_id", "variable", "value", "lo", "hi")
    rng = {k: v for k, v in (ranges or numeric_ranges()).items() if k in registry.columns}
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE), CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE)"
                      for c, (lo, hi) in rng.items())
    long = registry.selectExpr("record_id", f"stack({len(rng)}, {pairs}) AS (variable, value, lo, hi)")
    return long.where(F.col("value").isNotNull() & ((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))))


def dates_out_of_range(registry: DataFrame, column: str = "date_of_birth", lo: str = "1930-01-01",
                       dictionary: DataFrame | None = None) -> DataFrame:
    """D-DICT2 for dates: valid dates before the dictionary's first day or after its last -> (record_id, variable, value).

    Without a scanned ``dictionary``: ``column`` before ``lo`` or after today."""
    if dictionary is not None:
        bounds = date_bounds(dictionary)
        cols = _present(registry, sorted(_names(bounds)))
        if not cols:
            return registry.sparkSession.createDataFrame([], "record_id string, variable string, value string")
        d = F.try_to_date(F.col("value"), "dd/MM/yyyy")
        return (_unpivot(registry, cols).join(F.broadcast(bounds), "variable")
                .where((d < F.col("lo")) | (d > F.col("hi"))).select("record_id", "variable", "value"))
    d = F.try_to_date(F.col(column), "dd/MM/yyyy")
    return registry.where(d.isNotNull() & ((d < F.lit(lo).cast("date")) | (d > F.current_date()))).select(
        "record_id", F.lit(column).alias("variable"), F.col(column).alias("value"))


def not_permitted(registry: DataFrame, dictionary: DataFrame) -> DataFrame:
    """D-DICT3: answers that are not one of the field's choice labels -> (variable, value, n).

    The registry is unpivoted and pre-aggregated (few distinct answers per field) before
    the anti join against the choice table, which is bounded by the dictionary size.
    """
    choices = choice_table(dictionary)
    fields = [r["variable"] for r in choices.select("variable").distinct().collect()]  # bounded: dictionary
    cols = _present(registry, sorted(fields))
    answers = (_unpivot(registry, cols).where(F.col("value").isNotNull())
               .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
    allowed = choices.select("variable", F.col("label").alias("value"))
    return answers.join(F.broadcast(allowed), ["variable", "value"], "left_anti")


def _flagged(dictionary: DataFrame, flag: str) -> list[str]:
    """Variables whose ``flag`` column says yes."""
    return sorted(_names(dictionary.where(F.lower(F.trim(flag)).isin("y", "yes", "1"))))


def missing_required(registry: DataFrame, fields: Sequence[str] | None = None,
                     dictionary: DataFrame | None = None) -> DataFrame:
    """D-DICT4: required fields left empty -> (variable, n_missing), one pass. The fields come from the scanned
    ``dictionary``, else from ``fields`` or the fixed dictionary."""
    cols = _present(registry, _flagged(dictionary, "required") if dictionary is not None else fields or required_fields())
    if not cols:
        return registry.sparkSession.createDataFrame([], "variable string, n_missing long")
    wide = registry.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return _unpivot(wide, cols, "BIGINT", keep=()).select("variable", F.coalesce("value", F.lit(0)).alias("n_missing"))


def branching_violations(registry: DataFrame) -> DataFrame:
    """D-DICT6: drug compliance answered although the patient is not on chelation ([chelation_treat] = '1')."""
    return registry.where(F.col("drug_compliance").isNotNull()
                          & ~F.coalesce(F.col("chelation_treat") == "Yes", F.lit(False))).select(
        "record_id", "chelation_treat", "drug_compliance")


def deidentify(registry: DataFrame, fields: Sequence[str] | None = None, dictionary: DataFrame | None = None) -> DataFrame:
    """D-DICT7: drop the identifier fields of the scanned ``dictionary`` (else the given or fixed ones) before sharing."""
    return registry.drop(*(_flagged(dictionary, "identifier") if dictionary is not None else fields or identifier_fields()))


def dictionary_variables() -> list[str]:
    return [r[0] for r in DICTIONARY_ROWS]
