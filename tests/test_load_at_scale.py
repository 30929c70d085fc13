"""The load stores what is asked for, moves no event row, and its tasks stay the same size however many rows there are."""

from __future__ import annotations

import re

import pytest

from cdmflow import suite
from cdmflow.functions import keys
from cdmflow.plans import analytics as A
from cdmflow.plans.etl import (EVENT_ID, EVENT_TARGETS, append_events, build_spine, load_observation_period, load_person,
                               run_etl, visit_from_period)
from cdmflow.schemas import CLINICAL_TABLES
from cdmflow.sources.vocabulary import seed_concepts
from helpers import reg_row, registry

SF = "/root/testdata/sf0.001"


def _rows(n):
    return [reg_row(11 * k % n, gender="Male" if k % 2 else "Female", orpha_code_id=("Beta-thalassemia", "Sickle cell disease", None)[k % 3],
                    country_of_birth="Greece" if k % 4 else None, ferritin_result=float(k % 11), iron_result=float(k) if k % 5 else None,
                    transfusion_status_present="No" if k % 2 else "Yes (Regular)", chelation_treat="Yes" if k % 3 else "No",
                    endo_hypopit="Yes" if k % 4 == 1 else None) for k in range(n)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def fresh(spark, monkeypatch):
    monkeypatch.setattr(suite, "_CDM", {})
    monkeypatch.setattr(suite, "_DATABASE", {})


@pytest.fixture()
def small_tasks(monkeypatch):
    monkeypatch.setattr(keys, "TASK_ROWS", 10)


def test_only_the_tables_of_a_query_are_stored(spark, fresh):
    assert suite.QUERIES["load_observation"](spark, SF).count() > 0
    (database, _, _), = suite._DATABASE.values()
    assert {t.name for t in spark.catalog.listTables(database)} == {"observation"}
    c = suite.cdm(spark, SF)
    assert {t.name for t in spark.catalog.listTables(database)} == set(CLINICAL_TABLES)
    assert c.condition_occurrence.count() > 0


def test_event_rows_are_stored_where_they_are_made(spark, fresh):
    suite.cdm(spark, SF, "observation")
    (database, _, _), = suite._DATABASE.values()
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED `{database}`.observation").collect()}
    assert "Num Buckets" not in described and "rows" in described["Statistics"]


def test_more_rows_make_more_tasks_and_the_same_tables(spark, monkeypatch):
    reg = registry(spark, _rows(210))
    plain = {n: sorted(map(tuple, df.collect()), key=str) for n, df in run_etl(reg, concept=seed_concepts(spark)).tables().items()}
    monkeypatch.setattr(keys, "TASK_ROWS", 10)
    sized = run_etl(reg, concept=seed_concepts(spark))
    assert sized.person_parts == 21
    assert {n: sorted(map(tuple, df.collect()), key=str) for n, df in sized.tables().items()} == plain
    for t in EVENT_TARGETS:
        plan = _plan(getattr(sized, t))
        assert "Exchange hashpartitioning(_kb" in plan and ", 21), REPARTITION_BY_NUM" in plan, plan
        assert [r[0] for r in getattr(sized, t).select(EVENT_ID[t]).orderBy(EVENT_ID[t]).collect()] == [*range(1, len(plain[t]) + 1)]


def test_the_person_key_is_sorted_in_sized_tasks(spark, small_tasks):
    df = spark.range(0, 210, 1, 4).selectExpr("(id * 37) % 210 AS k", "id AS v")
    staged = keys.sorted_positions(df, ["k"], rows=210)
    assert staged.select("_pos_part").distinct().count() > 12
    keyed = keys.with_dense_key(df, ["k"], "key", rows=210)
    assert all(r["key"] == r["k"] + 1 for r in keyed.collect())


def test_questions_deal_by_person_when_the_load_is_large(spark, monkeypatch):
    reg = registry(spark, _rows(210))
    questions = {"q1": A.q1_patients_per_diagnosis, "q2": A._ferritin, "q3": A.q3_transfusion_by_diagnosis,
                 "q4": A.q4_comorbidity_prevalence, "q5": A.q5_chelation_without_transfusion, "q6": A.q6_measurement_completeness}
    small = run_etl(reg, concept=seed_concepts(spark))
    want = {n: sorted(map(tuple, q(small).collect()), key=str) for n, q in questions.items()}
    monkeypatch.setattr(keys, "TASK_ROWS", 10)
    large = run_etl(reg, concept=seed_concepts(spark))
    for n, q in questions.items():
        assert re.search(r"Exchange hashpartitioning\(person_id#\d+L, 21\), REPARTITION_BY_NUM", _plan(q(large))), n
        assert sorted(map(tuple, q(large).collect()), key=str) == want[n], n


def test_the_reset_load_is_stored_once(spark, fresh):
    got = {r["table_name"]: r["row_count"] for r in suite.QUERIES["reset_counts"](spark, SF).collect()}
    assert not suite._CDM and not suite._DATABASE
    assert {got[t] for t in CLINICAL_TABLES} == {0} and got["import.labels"] == 1500 and got["vocabulary.concept"] > 0


def test_an_append_joins_the_stored_tables_once(spark, monkeypatch):
    first = run_etl(registry(spark, _rows(30)[:20]), concept=seed_concepts(spark))
    batch = [reg_row(1000 + k, orpha_code_id="Beta-thalassemia", endo_hypopit="Yes") for k in range(60)]
    second = registry(spark, batch)
    spine = build_spine(second, start=21)
    person = first.person.unionByName(load_person(spine))
    visit = first.visit_occurrence.unionByName(visit_from_period(load_observation_period(load_person(spine))))
    stored = first.condition_occurrence.count()

    def added():
        df = append_events(second, person, visit, first.condition_occurrence, "condition_occurrence")
        assert {"joined-spine" in f for f in df.inputFiles()} == {True}
        return sorted(map(tuple, df.collect()))

    plain = added()
    assert [r[0] for r in plain] == [*range(stored + 1, stored + 121)]
    monkeypatch.setattr(keys, "TASK_ROWS", 5)
    assert added() == plain
