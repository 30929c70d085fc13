"""Dirty registry exports: CRLF line ends, NA words, odd headers; one inbox loaded into two roots."""

from __future__ import annotations

import csv
import os

import pytest

from cdmflow.operators.quality import null_counts
from cdmflow.plans.job import run_job
from cdmflow.sources.registry import read_registry_csv
from cdmflow.streaming.incremental import read_batched, start_registry_stream

COLUMNS = ["record_id", "consent text", "Weight (approx. kg)", "Patient's height", "transfusion", "ferritin"]


def write_export(path, columns, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator="\r\n")
        out.writerow(["I agree\nto this" if c == "consent text" else c for c in columns])
        out.writerows([[r[c] for c in columns] for r in rows])


@pytest.mark.parametrize("last", ["transfusion", "ferritin", "Weight (approx. kg)"])
def test_crlf_na_words_and_odd_headers(spark, tmpdir_path, last):
    columns = [c for c in COLUMNS if c != last] + [last]
    rows = [
        {"record_id": "1", "consent text": "Yes", "Weight (approx. kg)": "70", "Patient's height": "1.7", "transfusion": "No", "ferritin": "12.5"},
        {"record_id": "2", "consent text": "Yes", "Weight (approx. kg)": "NA", "Patient's height": "n/a", "transfusion": "NA", "ferritin": "NaN"},
    ]
    path = os.path.join(tmpdir_path, "patients.csv")
    write_export(path, columns, rows)
    df = read_registry_csv(spark, path)
    got = {r["record_id"]: r for r in df.collect()}
    assert len(got) == 2
    assert got["1"]["Weight (approx. kg)"] == "70" and got["1"]["Patient's height"] == "1.7"
    assert got["2"]["Weight (approx. kg)"] is None and got["2"]["Patient's height"] is None
    nulls = {r["column_name"]: r["n_null"] for r in null_counts(df).collect()}
    assert nulls["Weight (approx. kg)"] == 1 and nulls["Patient's height"] == 1


def test_one_inbox_into_two_roots(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "inbox")
    os.makedirs(inbox)
    write_export(os.path.join(inbox, "a.csv"), ["record_id", "transfusion"],
                 [{"record_id": str(k), "transfusion": "No"} for k in (1, 2, 3)])
    for name in ("a", "b"):
        root = os.path.join(tmpdir_path, name)
        start_registry_stream(spark, inbox, root).awaitTermination()
        assert read_batched(spark, root, "person").count() == 3


def test_job_quarantines_what_does_not_parse(spark, tmpdir_path):
    rows = [{"record_id": "1", "ferritin_result": "12", "date_of_birth": "01/02/1990"},
            {"record_id": "2", "ferritin_result": "about 9", "date_of_birth": "31/02/1990"},
            {"record_id": "3", "ferritin_result": "NA", "date_of_birth": ""}]
    write_export(os.path.join(tmpdir_path, "patients.csv"), list(rows[0]), rows)
    reports = run_job(spark, tmpdir_path, os.path.join(tmpdir_path, "out"))
    got = {(r["record_id"], r["column_name"], r["raw_value"]) for r in reports["quarantine"].collect()}
    assert got == {("2", "ferritin_result", "about 9"), ("2", "date_of_birth", "31/02/1990")}
    assert os.path.isdir(os.path.join(tmpdir_path, "out", "report", "quality_report"))
