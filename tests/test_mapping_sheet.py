"""The load driven by a mapping table: equal to the built-in rules, changed by a changed sheet, strict about columns."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cdmflow.operators.rules import RULES, rule_frame, rules_from_frame, sheet_frame
from cdmflow.plans.etl import run_etl
from cdmflow.plans.job import run_job
from helpers import reg_row, registry

EVENTS = ("condition_occurrence", "observation", "measurement", "procedure_occurrence")


def records(spark):
    return registry(spark, [
        reg_row(k, gender="Male", orpha_code_id=["Sickle cell disease", "Beta-thalassemia", "other", None][k % 4], endo_hypopit="Yes" if k % 3 else None,
                drug_compliance="Poor (< 60% of recommended dose)" if k % 2 else "Excellent (>80% of recommended dose)",
                country_of_birth="Greece" if k % 2 else None, cardiac_t2=float(k) if k % 5 else None, splenectomy="Yes, totally")
        for k in range(1, 40)])


def test_rules_survive_the_table(spark):
    assert rules_from_frame(rule_frame(spark)) == RULES
    assert rules_from_frame(sheet_frame(spark)) == RULES  # text cells, as in a CSV sheet


def test_the_load_from_the_table_equals_the_load_from_the_constants(spark):
    a, b = run_etl(records(spark)), run_etl(records(spark), rules=rules_from_frame(sheet_frame(spark)))
    for t in EVENTS:
        assert sorted(map(tuple, getattr(a, t).collect()), key=str) == sorted(map(tuple, getattr(b, t).collect()), key=str)


def test_a_changed_sheet_changes_the_load(spark, tmpdir_path):
    data = os.path.join(tmpdir_path, "data")
    sheet = sheet_frame(spark).where("rule_id IN ('L-C1', 'L-C2', 'L-P3')").withColumn(
        "concept_id", F.when(F.col("rule_id") == "L-C2", "99").otherwise(F.col("concept_id")))
    sheet.coalesce(1).toPandas().to_csv((os.makedirs(data), os.path.join(data, "omop_mappings.csv"))[1], index=False)
    records(spark).select(F.col("record_id").cast("string"), "gender", "orpha_code_id", "endo_hypopit", "splenectomy").toPandas().to_csv(
        os.path.join(data, "patients.csv"), index=False)
    counts = {r["table_name"]: r["row_count"] for r in run_job(spark, data, os.path.join(tmpdir_path, "out"))["overview"].collect()}
    assert counts["condition_occurrence"] == 39 + 26 and counts["observation"] == counts["measurement"] == 0
    assert counts["procedure_occurrence"] == 39


@pytest.mark.parametrize("column, value, said", [
    ("source_col", "no_such_field", "no_such_field"), ("target", "drugs", "drugs"), ("predicate_kind", "like", "like"), ("value_kind", "blob", "blob")])
def test_unknown_cells_are_named(spark, column, value, said):
    wrong = rule_frame(spark).withColumn(column, F.when(F.col("rule_no") == 3, F.lit(value)).otherwise(F.col(column)))
    with pytest.raises(ValueError, match=f"L-C3.*{said}"):
        rules_from_frame(wrong, records(spark).columns)
    with pytest.raises(ValueError, match="lacks.*source_col"):
        rules_from_frame(rule_frame(spark).drop("source_col"))
    with pytest.raises(ValueError, match="rule_no"):
        rules_from_frame(rule_frame(spark).unionByName(rule_frame(spark).limit(1)))
