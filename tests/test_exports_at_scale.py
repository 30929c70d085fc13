"""Splittable exports, headers of their own, refused records, atomic tables and exports that are appended once."""

from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from cdmflow.operators.lookup import counted_join
from cdmflow.plans.append import append_export, export_digest
from cdmflow.plans.etl import KNOWN_ID, MISSING_ID, REPEATED_ID, run_etl, split_records
from cdmflow.sources import sinks
from cdmflow.sources.registry import profile_export, read_header, read_registry_text, type_registry
from cdmflow.streaming.incremental import read_batched, start_registry_stream

from helpers import reg_row, registry


def write_csv(path, columns, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator="\r\n")
        out.writerow(columns)
        out.writerows(rows)


def test_a_large_export_is_split(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "patients.csv")
    write_csv(path, ["record_id", "I agree \nto this", 'a "quoted" label', "gender"],
              [[k, "Yes, confirmed", f'x "{k}"', "Male" if k % 2 else "NA"] for k in range(20_000)])
    names, head = read_header(spark, path)
    assert names == ["record_id", "I agree \nto this", 'a "quoted" label', "gender"] and len(head) == 2
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = read_registry_text(spark, path)
        assert df.select(F.spark_partition_id()).distinct().count() > 1
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted(int(r["record_id"]) for r in rows) == list(range(20_000))
    by = {r["record_id"]: r for r in rows}
    assert by["7"]['a "quoted" label'] == 'x "7"' and by["7"]["gender"] == "Male" and by["8"]["gender"] is None
    assert by["9"]["I agree \nto this"] == "Yes, confirmed"


def test_records_that_span_lines(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "patients.csv")
    write_csv(path, ["record_id", "notes", "gender"], [[1, "a\nb", "Male"], [2, "c", "Female"]])
    assert profile_export(spark, path).first()["odd_lines"] == 2
    for multiline in (None, True):
        got = {r["record_id"]: (r["notes"], r["gender"]) for r in read_registry_text(spark, path, multiline=multiline).collect()}
        assert got == {"1": ("a\nb", "Male"), "2": ("c", "Female")}
    with pytest.raises(ValueError, match="span lines"):
        read_registry_text(spark, path, multiline=False)


def test_every_file_is_read_by_its_own_header(spark, tmpdir_path):
    write_csv(os.path.join(tmpdir_path, "a.csv"), ["record_id", "gender", "chelation_treat"], [[1, "Male", "Yes"]])
    write_csv(os.path.join(tmpdir_path, "b.csv"), ["record_id", "chelation_treat", "gender"], [[2, "Yes", "Female"]])
    write_csv(os.path.join(tmpdir_path, "c.csv"), ["gender", "extra", "record_id"], [["Male", "e", 3]])
    got = {r["record_id"]: (r["gender"], r["chelation_treat"], r["extra"]) for r in read_registry_text(spark, tmpdir_path).collect()}
    assert got == {"1": ("Male", "Yes", None), "2": ("Female", "Yes", None), "3": ("Male", None, "e")}


def test_streams_read_later_exports_by_their_own_header(spark, tmpdir_path):
    inbox, root = os.path.join(tmpdir_path, "inbox"), os.path.join(tmpdir_path, "cdm")
    os.makedirs(inbox)
    write_csv(os.path.join(inbox, "a.csv"), ["record_id", "gender", "chelation_treat"], [[1, "Male", "Yes"]])
    start_registry_stream(spark, inbox, root).awaitTermination(240)
    write_csv(os.path.join(inbox, "b.csv"), ["record_id", "chelation_treat", "gender", "new column"],
              [[2, "Yes", "Female", "x"], [1, "Yes", "Male", "x"], ["", "Yes", "Male", "x"]])
    start_registry_stream(spark, inbox, root).awaitTermination(240)
    persons = {r["person_source_value"]: r["gender_source_value"] for r in read_batched(spark, root, "person").collect()}
    assert persons == {"1": "Male", "2": "Female"}
    assert sorted(r["person_id"] for r in read_batched(spark, root, "procedure_occurrence").collect()) == [1, 2]
    refused = {(r["record_id"], r["reason"]) for r in read_batched(spark, root, "refused_records").collect()}
    assert refused == {("1", KNOWN_ID), (None, MISSING_ID)}


def export(spark, ids):
    rows = [reg_row(i, gender="Male", orpha_code_id="Sickle cell disease", chelation_treat="Yes", cardiac_t2=float(k % 50))
            for k, i in enumerate(ids)]
    return registry(spark, rows)


def test_one_rule_for_repeated_and_missing_ids(spark, tmpdir_path):
    records = export(spark, [7, 7, None, 8, 9])
    good, refused = split_records(records)
    reasons = sorted((r["record_id"] or 0, r["reason"]) for r in refused.collect())
    assert sorted(r["record_id"] for r in good.collect()) == [8, 9]
    assert reasons == [(0, MISSING_ID), (7, REPEATED_ID), (7, REPEATED_ID)]
    fresh = run_etl(records)
    assert fresh.person.count() + fresh.refused.count() == 5
    root = os.path.join(tmpdir_path, "out")
    appended = append_export(records, root)
    assert sorted(map(tuple, appended.person.collect())) == sorted(map(tuple, fresh.person.collect()))
    assert sorted(map(tuple, appended.condition_occurrence.collect())) == sorted(map(tuple, fresh.condition_occurrence.collect()))
    assert sinks.read_table(spark, root, "refused_records", schema="quarantine").count() == 3


def test_a_repeated_id_of_a_third_of_all_rows(spark):
    records = export(spark, [5] * 1000 + list(range(10, 2010)))
    good, refused = split_records(records)
    assert good.count() == 2000 and refused.count() == 1000
    counts = records.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    joined = counted_join(records.select("record_id"), counts, "record_id", "n", parts=8)
    assert joined.count() == 3000 and "_piece" not in joined.columns


def test_an_export_is_appended_once(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "out")
    first, second = export(spark, range(1, 6)), export(spark, range(4, 9))
    assert export_digest(first) == export_digest(first.orderBy(F.desc("record_id"))) != export_digest(second)
    for batch in (first, second, second, first):
        stored = append_export(batch, root)
    assert sorted((r["person_id"], r["person_source_value"]) for r in stored.person.collect()) == [(k, str(k)) for k in range(1, 9)]
    for table, key in (("condition_occurrence", "condition_occurrence_id"), ("procedure_occurrence", "procedure_occurrence_id"),
                       ("measurement", "measurement_id")):
        assert sorted(r[key] for r in getattr(stored, table).collect()) == list(range(1, 9))
    assert sorted(r["observation_id"] for r in stored.observation.collect()) == list(range(1, 49))
    refused = sinks.read_table(spark, root, "refused_records", schema="quarantine")
    assert sorted((r["record_id"], r["reason"]) for r in refused.collect()) == [(4, KNOWN_ID), (5, KNOWN_ID)]
    sinks.reset_clinical_tables(spark, root)
    assert append_export(first, root).person.count() == 5


def test_a_load_that_dies_leaves_the_old_tables(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "out")
    sinks.write_cdm(run_etl(export(spark, range(1, 4))), root)
    again = run_etl(export(spark, range(1, 9)))
    again.measurement = again.measurement.withColumn("unit_concept_id", F.raise_error(F.lit("killed")).cast("int"))
    with pytest.raises(Exception, match="killed"):
        sinks.write_cdm(again, root)
    old = sinks.read_cdm(spark, root)
    assert old.person.count() == old.measurement.count() == old.condition_occurrence.count() == 3
    sinks.write_cdm(run_etl(export(spark, range(1, 9))), root)
    assert sinks.read_cdm(spark, root).person.count() == 8
    assert spark.read.parquet(sinks.table_path(root, "person")).count() == 8  # replaced folders are gone


def test_typing_keeps_unknown_columns(spark, tmpdir_path):
    write_csv(os.path.join(tmpdir_path, "a.csv"), ["record_id", "odd. name`", "ferritin_result"], [["007", "x", "1e3"]])
    row = type_registry(read_registry_text(spark, tmpdir_path)).first()
    assert row["record_id"] == "007" and row["odd. name`"] == "x" and row["ferritin_result"] == 1000.0
