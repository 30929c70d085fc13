"""Control values of the stand-in registry at sf0.01 (computed independently when it was designed)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cdmflow import suite
from cdmflow.operators.quality import bad_dates
from cdmflow.plans.analytics import q1_patients_per_diagnosis, q2_median_ferritin_by_sex

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not available")


def test_registry_control_values(spark):
    reg = suite.registry(spark, SF)
    assert reg.count() == 15000
    assert bad_dates(reg, "date_of_birth").count() == 148
    diag = {r[0]: r[1] for r in reg.groupBy("orpha_code_id").count().collect()}
    assert diag == {"Alpha-thalassemia": 2932, "Beta-thalassemia": 2958, "Sickle cell disease": 2983,
                    "Hemoglobin C disease": 3042, None: 3085}


def test_question_control_values(spark):
    cdm = suite.cdm(spark, SF)
    q1 = {r["diagnosis"]: r["n_patients"] for r in q1_patients_per_diagnosis(cdm).collect()}
    assert q1 == {"Alpha-thalassemia": 2932, "Beta-thalassemia": 2958, "Sickle cell disease": 2983}
    q2 = {r["sex"]: (r["median_ferritin"], r["n_measurements"]) for r in q2_median_ferritin_by_sex(cdm).collect()}
    assert q2 == {"Female": (2546.2, 4286), "Male": (2535.1, 4286), "Undetermined": (2514.7, 1428)}
    assert cdm.person.agg(F.max("person_id")).first()[0] == 15000
