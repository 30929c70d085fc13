"""Checks follow the scanned dictionary; stored tables bucketed by person need no exchange before their joins."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from cdmflow.operators import dictionary_checks as DC
from cdmflow.plans import analytics as A
from cdmflow.plans import quality as Q
from cdmflow.plans.etl import run_etl
from cdmflow.sources import sinks
from cdmflow.sources.dictionary import dictionary_frame
from cdmflow.sources.vocabulary import seed_concepts
from helpers import reg_row, registry


def test_checks_follow_the_dictionary(spark):
    reg = registry(spark, [reg_row(1, cardiac_t2=60.0, ferritin_result=5.0, date_of_birth="01/01/1950", gender="Male"),
                           reg_row(2, cardiac_t2=None, ferritin_result=50.0, date_of_birth="01/01/2990")])
    fixed = dictionary_frame(spark)
    assert {(r["record_id"], r["variable"]) for r in DC.out_of_range(reg, dictionary=fixed).collect()} == set()
    assert [r["record_id"] for r in DC.dates_out_of_range(reg, dictionary=fixed).collect()] == [2]
    is_ = lambda name: F.col("variable") == name
    other = (fixed.withColumn("validation_max", F.when(is_("cardiac_t2"), "50").when(is_("date_of_birth"), "31/12/2999").otherwise(F.col("validation_max")))
             .withColumn("validation_min", F.when(is_("ferritin_result"), "10").when(is_("date_of_birth"), "01/01/1960").otherwise(F.col("validation_min")))
             .withColumn("required", F.when(is_("cardiac_t2"), "Y")).withColumn("identifier", F.when(is_("iron_result"), "y")))
    got = {(r["record_id"], r["variable"], r["lo"], r["hi"]) for r in DC.out_of_range(reg, dictionary=other).collect()}
    assert got == {(1, "cardiac_t2", 0.0, 50.0), (1, "ferritin_result", 10.0, 10000.0)}
    assert [(r["record_id"], r["variable"]) for r in DC.dates_out_of_range(reg, dictionary=other).collect()] == [(1, "date_of_birth")]
    assert [tuple(r) for r in DC.missing_required(reg, dictionary=other).collect()] == [("cardiac_t2", 1)]
    assert "iron_result" not in DC.deidentify(reg, dictionary=other).columns and "gender" in DC.deidentify(reg, dictionary=other).columns
    none = fixed.limit(0)
    assert DC.out_of_range(reg, dictionary=none).count() == DC.dates_out_of_range(reg, dictionary=none).count() == 0
    assert DC.missing_required(reg, dictionary=none).count() == 0 and DC.deidentify(reg, dictionary=none).columns == reg.columns
    assert dt.date.today() < dt.date(2990, 1, 1)


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    rows = [reg_row(k, gender="Male" if k % 2 else "Female", orpha_code_id="Sickle cell disease", ferritin_result=float(k),
                    transfusion_status_present="No", chelation_treat="Yes") for k in range(1, 200)]
    return sinks.save_cdm(run_etl(registry(spark, rows), concept=seed_concepts(spark)), "bucket_test",
                          location=os.path.join(str(tmp_path_factory.mktemp("db")), "x.db"), buckets=4)


def test_joins_on_the_person_need_no_exchange(spark, bucketed):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        status = A.q3_transfusion_by_diagnosis(bucketed)
        ferritin = A._ferritin(bucketed)
        chelated = A.q5_chelation_without_transfusion(bucketed)
        orphans = bucketed.condition_occurrence.join(bucketed.person.select("person_id"), "person_id", "left_anti")
        for df in (status, ferritin, chelated, orphans):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and not re.search(r"Exchange hashpartitioning\(person_id", plan), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert A.q5_chelation_without_transfusion(bucketed).first()[0] == 199
    assert {(r["sex"], r["median_ferritin"]) for r in A.q2_median_ferritin_by_sex(bucketed).collect()} == {("Male", 100.0), ("Female", 100.0)}


def test_the_catalog_counts_its_own_tables_only(spark, bucketed):
    spark.range(5).createOrReplaceGlobalTempView("somebody_elses_view")
    got = {(r["table_schema"], r["table_name"]): r["row_count"] for r in A.catalog_counts(spark, "bucket_test").collect()}
    assert got[("bucket_test", "person")] == 199 and len(got) == 8
    stats = spark.sql("DESCRIBE EXTENDED bucket_test.person").where("col_name = 'Statistics'").first()[1]
    assert "199 rows" in stats


def test_the_quality_report_reads_each_event_table_once(spark, bucketed):
    report = {(r["check"], r["table_name"], r["item"]): r["value"] for r in Q.quality_report(bucketed).collect()}
    assert report[("coverage", "condition_occurrence", "n_persons")] == 199
    assert report[("orphans", "measurement", "person")] == 0 and report[("duplicate_ids", "person", "id")] == 0
    plan = Q.quality_report(bucketed)._jdf.queryExecution().optimizedPlan().toString()
    for table in Q.EVENT_CONCEPT_SOURCE:
        assert len(re.findall(rf"Relation spark_catalog\.bucket_test\.{table}\[", plan)) <= 1, table


def test_the_report_equals_the_single_checks(spark, bucketed):
    from dataclasses import replace
    damaged = replace(
        bucketed, person=bucketed.person.where("person_id % 50 <> 0"), visit_occurrence=bucketed.visit_occurrence.where("visit_occurrence_id % 60 <> 0"),
        condition_occurrence=bucketed.condition_occurrence.unionByName(bucketed.condition_occurrence.where("condition_occurrence_id % 9 = 0")),
        measurement=bucketed.measurement.withColumn("measurement_date", F.expr("CASE WHEN measurement_id % 8 <> 0 THEN measurement_date END")),
        procedure_occurrence=bucketed.procedure_occurrence.limit(0))
    want = {("unmapped", r["table_name"], r["source_value"], r["n"]) for r in Q.dq_unmapped(damaged).collect()}
    want |= {("coverage", r["table_name"], "n_persons", r["n_persons"]) for r in Q.dq_coverage(damaged).collect()}
    for r in Q.dq_orphans(damaged).collect():
        want |= {("orphans", r["table_name"], "person", r["orphan_person_rows"]), ("orphans", r["table_name"], "visit", r["orphan_visit_rows"])}
    want |= {("duplicate_ids", r["table_name"], "id", r["duplicate_ids"]) for r in Q.dq_duplicate_ids(damaged).collect()}
    want |= {("mandatory_nulls", r["table_name"], r["column_name"], r["n_null"]) for r in Q.dq_mandatory_nulls(damaged).collect()}
    assert {tuple(r) for r in Q.quality_report(damaged).collect()} == want
