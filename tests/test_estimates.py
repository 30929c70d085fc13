"""Sketches kept per batch: merged without the rows, within their error bounds."""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import functions as F

from cdmflow import suite
from cdmflow.plans.estimates import batch_sketches, estimates, store_sketches
from cdmflow.sources import sinks


def test_merged_sketches_stay_within_their_bounds(spark, tmpdir_path):
    sf = "/root/testdata/sf0.01"
    got = {(r["kind"], r["name"]): r for r in suite.QUERIES["estimates_over_batches"](spark, sf).collect()}
    c = suite.cdm(spark, sf)
    exact = c.condition_occurrence.groupBy("condition_concept_id").agg(F.count_distinct("person_id").alias("n"))
    exact = {str(r[0]): r[1] for r in exact.collect() if r[0]}
    found = {name: r["estimate"] for (kind, name), r in got.items() if kind == "patients"}
    assert found.keys() == {"25518", "4278669", "4287844"}
    assert all(abs(v - exact[k]) <= 0.05 * exact[k] for k, v in found.items())  # four standard errors
    values = c.measurement.where("measurement_concept_id = 37208753").join(c.person, "person_id")
    for row in values.groupBy("gender_source_value").agg(F.sort_array(F.collect_list("value_as_number")).alias("v")).collect():
        mine, v = got[("ferritin", row[0])], row["v"]
        rank = sum(x <= mine["estimate"] for x in v) / len(v)
        assert mine["n"] == len(v) and abs(rank - 0.5) <= 0.02
    # a second batch needs the first one's sketches only, and a repeated batch adds nothing
    half = lambda k: replace(c, person=c.person.where(F.col("person_id") % 2 == k), condition_occurrence=c.condition_occurrence.where(F.col("person_id") % 2 == k),
                             measurement=c.measurement.where(F.col("person_id") % 2 == k))
    root = os.path.join(tmpdir_path, "e")
    for k in (0, 1, 1):
        store_sketches(half(k), root, f"b{k}")
    assert sinks.read_table(spark, root, "sketches", "estimates").count() == 2 * batch_sketches(half(0)).count()
    assert {(r["kind"], r["name"]): r["n"] for r in estimates(spark, root).collect()} == {k: r["n"] for k, r in got.items()}
