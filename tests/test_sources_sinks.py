"""Scans of messy files, label renaming, table lifecycle (overwrite, append with key continuation, reset)."""

from __future__ import annotations

import csv
import datetime as dt
import os

from cdmflow.functions.keys import next_key_start
from cdmflow.operators import dictionary_checks as DC
from cdmflow.operators import quality as Q
from cdmflow.plans.analytics import catalog_counts, overview_counts
from cdmflow.plans.etl import (append_events, build_spine, cdm_source, load_observation_period, load_person,
                               run_etl, visit_from_period)
from cdmflow.sources import sinks
from cdmflow.sources.dictionary import (DICTIONARY_COLUMNS, DICTIONARY_ROWS, dictionary_frame, parse_choices,
                                        read_dictionary)
from cdmflow.sources.registry import read_registry_csv
from cdmflow.sources.vocabulary import load_vocabulary
from helpers import reg_row, registry


def _write_dictionary_csv(path):
    with open(path, "w", encoding="utf-8-sig", newline="") as fh:
        w = csv.writer(fh, lineterminator="\r\n")
        w.writerow(DICTIONARY_COLUMNS)
        for v, form, ftype, label, choices, valid, lo, hi, ident, branch, req in DICTIONARY_ROWS:
            header = '<div class="rich-text-field-label"><h6>Section</h6></div>' if v == "chelation_treat" else ""
            w.writerow([v, form, header, ftype, label, choices or "", "", valid or "", lo or "", hi or "",
                        ident or "", branch or "", req or "", "", "", "", ""])


def test_dictionary_scan_bom_crlf_multiline(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "dictionary.csv")
    _write_dictionary_csv(path)
    df = read_dictionary(spark, path)
    rows = df.collect()
    assert len(rows) == 27 and len(df.columns) == 17
    assert rows[0]["variable"] == "record_id"  # BOM gone
    consent = [r for r in rows if r["variable"] == "consent_registry"][0]
    assert consent["label"].endswith("\n")  # newline inside quotes kept
    chel = [r for r in rows if r["variable"] == "chelation_treat"][0]
    assert chel["section_header"] == '<div class="rich-text-field-label"><h6>Section</h6></div>'
    cardiac = [r for r in rows if r["variable"] == "cardiac_t2"][0]
    assert " " in cardiac["label"]


def test_choice_table_first_comma(spark):
    choices = DC.choice_table(dictionary_frame(spark))
    got = {(r["variable"], r["code"]): r["label"] for r in choices.collect()}
    assert got[("endo_hypopit", "1")] == "Yes, confirmed"
    assert got[("varsid_hbb_a1", "3")] == "b0"
    assert sum(1 for k in got if k[0] == "gender") == 4
    assert parse_choices("1, Yes, confirmed | 0, No") == [("1", "Yes, confirmed"), ("0", "No")]


def test_registry_csv_labels_renamed_and_typed(spark, tmpdir_path):
    labels = {r[0]: r[3] for r in DICTIONARY_ROWS}
    header = [labels["record_id"], labels["date_of_birth"], labels["gender"], "Patient's country of birth",
              labels["cardiac_t2"], labels["ferritin_result"].replace("µ", "μ"),  # other mu still matches
              labels["iron_result"], labels["transfusion_status_present"]]
    path = os.path.join(tmpdir_path, "patients.csv")
    with open(path, "w", encoding="utf-8", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerow(["9047185", "03/04/1957", "Female", "Greece", "12.5", "abc", "80", "No"])
        w.writerow(["11639873", "31/02/2000", "Male", "", "", "900", "", "Yes (Regular)"])
    df = read_registry_csv(spark, path)
    rows = {r["record_id"]: r for r in df.collect()}
    assert set(rows) == {"9047185", "11639873"}
    assert rows["9047185"]["cardiac_t2"] == 12.5 and rows["9047185"]["ferritin_result"] is None
    assert rows["11639873"]["ferritin_result"] == 900.0
    assert rows["9047185"]["country_of_birth"] == "Greece" and rows["11639873"]["country_of_birth"] is None
    assert rows["9047185"]["transfusion_status_present"] == "No"
    assert df.schema["iron_result"].dataType.simpleString() == "double"
    raw = spark.read.option("header", True).csv(path)
    from cdmflow.sources.dictionary import rename_labels
    bad = Q.bad_numbers(rename_labels(raw), ["ferritin_result", "cardiac_t2"]).collect()
    assert [(b["record_id"], b["raw_value"]) for b in bad] == [("9047185", "abc")]


def test_vocabulary_tsv(spark, tmpdir_path):
    vdir = os.path.join(tmpdir_path, "vocab")
    os.makedirs(vdir)
    lines = [
        "CONCEPT_ID\tCONCEPT_NAME\tDOMAIN_ID\tVOCABULARY_ID\tCONCEPT_CLASS_ID\tSTANDARD_CONCEPT\tCONCEPT_CODE\t"
        "VALID_START_DATE\tVALID_END_DATE\tINVALID_REASON",
        '1\tpipe 3" long\tDevice\tPART\tX\tS\tB1\t20000101\t20991231\t',
        "2\tNone\tDevice\tPART\tX\t\tB2\t20000231\t20991231\tD",
        "3\t\tDevice\tPART\tX\tS\tB3\t19991231\tbad\t",
    ]
    with open(os.path.join(vdir, "CONCEPT.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    out = load_vocabulary(spark, vdir, out_root=os.path.join(tmpdir_path, "omop"), mode="append")
    assert list(out) == ["concept"]  # the eight other files are missing and skipped
    rows = {r["concept_id"]: r for r in out["concept"].collect()}
    assert rows[1]["concept_name"] == 'pipe 3" long' and rows[1]["valid_start_date"] == dt.date(2000, 1, 1)
    assert rows[2]["concept_name"] == "None" and rows[2]["valid_start_date"] is None
    assert rows[2]["standard_concept"] == "" and rows[1]["invalid_reason"] == ""
    assert rows[3]["concept_name"] == "" and rows[3]["valid_end_date"] is None
    # append: a second load adds the rows again
    load_vocabulary(spark, vdir, out_root=os.path.join(tmpdir_path, "omop"), mode="append")
    assert spark.read.parquet(os.path.join(tmpdir_path, "omop", "concept")).count() == 6


def _small_registry(spark, ids):
    return registry(spark, [reg_row(i, gender="Male", orpha_code_id="Sickle cell disease",
                                    cardiac_t2=float(i % 50)) for i in ids])


def test_write_reset_and_idempotent_rerun(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "out")
    sinks.create_empty_tables(spark, root)
    assert sinks.read_table(spark, root, "person").count() == 0
    c = run_etl(_small_registry(spark, range(1, 21)))
    stored = sinks.write_cdm(c, root)
    first = {r["table_name"]: r["row_count"] for r in overview_counts(stored).collect()}
    stored = sinks.write_cdm(run_etl(_small_registry(spark, range(1, 21))), root)  # re-run: overwrite
    assert {r["table_name"]: r["row_count"] for r in overview_counts(stored).collect()} == first
    assert first["person"] == 20 and first["condition_occurrence"] == 20 and first["measurement"] == 20
    assert Q.duplicate_keys(stored.condition_occurrence, ["condition_occurrence_id"]).count() == 0
    sinks.reset_clinical_tables(spark, root)
    after = overview_counts(sinks.read_cdm(spark, root)).collect()
    assert all(r["row_count"] == 0 for r in after) and len(after) == 8


def test_append_continues_keys(spark):
    first = _small_registry(spark, range(1, 11))
    second = _small_registry(spark, range(11, 16))
    c1 = run_etl(first)
    spine2 = build_spine(second, start=next_key_start(c1.person, "person_id"))
    person2 = load_person(spine2)
    visit2 = visit_from_period(load_observation_period(person2))
    person = c1.person.unionByName(person2)
    visit = c1.visit_occurrence.unionByName(visit2)
    cond2 = append_events(second, person, visit, c1.condition_occurrence, "condition_occurrence")
    ids = sorted(r[0] for r in cond2.select("condition_occurrence_id").collect())
    assert ids == list(range(11, 16))
    pids = sorted(r[0] for r in person2.select("person_id").collect())
    assert pids == list(range(11, 16))
    # every appended event joins back to its person through the text key
    assert Q.orphans(cond2, person, "person_id").count() == 0


def test_catalog_and_cdm_source(spark, tmpdir_path):
    c = run_etl(_small_registry(spark, range(1, 6)))
    for name, df in c.tables().items():
        df.createOrReplaceGlobalTempView(name)
    counts = {r["table_name"]: r["row_count"] for r in catalog_counts(spark, "global_temp").collect()}
    assert counts["person"] == 5 and counts["drug_exposure"] == 0
    listed = sinks.list_tables(spark, "global_temp").select("table_name").collect()
    assert "person" in [r[0] for r in listed]
    src = cdm_source(spark, "Registry").first()
    assert src["cdm_version_concept_id"] == 756265 and src["source_release_date"] == dt.date(2026, 5, 6)


def test_quality_operators(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k long, v string")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    nulls = {r["column_name"]: r["n_null"] for r in Q.null_counts(df).collect()}
    assert nulls == {"k": 1, "v": 1}
    parent = spark.createDataFrame([(1,)], "k long")
    assert spark.range(1).select(Q.orphan_rows(df, parent, "k")).first()[0] == 2  # k=2 and k=NULL
    dates = spark.createDataFrame([("01/01/2000",), ("31/02/2000",), (None,)], "d string")
    good, bad = Q.split_valid_dates(dates, "d")
    assert good.count() == 2 and bad.count() == 1  # no row lost


def test_dictionary_checks(spark):
    reg = registry(spark, [
        reg_row(1, gender="Male", cardiac_t2=150.0, iron_result=-3.0, endo_hypopit="Yes",
                drug_compliance="Unknown", chelation_treat="No"),
        reg_row(2, gender="Female", cardiac_t2=100.0, endo_hypopit="Yes, confirmed", chelation_treat="Yes",
                drug_compliance="Unknown", date_of_birth="01/01/1920"),
    ])
    rng = sorted((r["record_id"], r["variable"]) for r in DC.out_of_range(reg).collect())
    assert rng == [(1, "cardiac_t2"), (1, "iron_result")]
    bad = {(r["variable"], r["value"]): r["n"] for r in DC.not_permitted(reg, dictionary_frame(spark)).collect()}
    assert bad == {("endo_hypopit", "Yes"): 1}
    assert [r["record_id"] for r in DC.branching_violations(reg).collect()] == [1]
    assert [r["record_id"] for r in DC.dates_out_of_range(reg).collect()] == [2]
    req = {r["variable"]: r["n_missing"] for r in DC.missing_required(reg).collect()}
    assert req["gender"] == 0 and req["ferritin_result"] == 2
    assert "date_of_birth" not in DC.deidentify(reg).columns and "gender" not in DC.deidentify(reg).columns


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["diagnosis", "n_patients"] and len(rows) == 3
    assert set(E.queries()) >= set(E.oracle_sql())


def test_end_to_end_job(spark, tmpdir_path):
    from cdmflow.plans.job import run_job
    data = os.path.join(tmpdir_path, "data")
    os.makedirs(data)
    _write_dictionary_csv(os.path.join(data, "dictionary.csv"))
    labels = {r[0]: r[3] for r in DICTIONARY_ROWS}
    with open(os.path.join(data, "patients.csv"), "w", encoding="utf-8", newline="") as fh:
        w = csv.writer(fh)
        w.writerow([labels["record_id"], labels["gender"], labels["orpha_code_id"], labels["ferritin_result"],
                    labels["chelation_treat"]])
        w.writerow(["3", "Male", "Alpha-thalassemia", "1500", "Yes"])
        w.writerow(["1", "Female", "Beta-thalassemia", "", "No"])
        w.writerow(["P-7", "Female", "Sickle cell disease", "", "No"])
        w.writerow(["012", "Male", "Sickle cell disease", "", "No"])
    out = os.path.join(tmpdir_path, "out")
    reports = run_job(spark, data, out)
    counts = {r["table_name"]: r["row_count"] for r in reports["overview"].collect()}
    assert counts["person"] == 4 and counts["measurement"] == 1 and counts["procedure_occurrence"] == 1
    assert spark.read.parquet(os.path.join(out, "import", "mappings")).count() == 24
    assert spark.read.parquet(os.path.join(out, "import", "dictionary")).count() == 27
    assert spark.read.parquet(os.path.join(out, "omop", "cdm_source")).count() == 1
    person = spark.read.parquet(os.path.join(out, "omop", "person"))
    # numeric ids in numeric order (text kept exactly, "012" stays "012"), then text ids
    assert sorted((r["person_id"], r["person_source_value"]) for r in person.collect()) == [
        (1, "1"), (2, "3"), (3, "012"), (4, "P-7")]
    assert reports["quality"].count() > 0


def test_catalog_database_sink(spark, tmpdir_path):
    c = run_etl(_small_registry(spark, range(1, 8)))
    sinks.save_tables(c.tables(), "omop_sink_test", location=os.path.join(tmpdir_path, "omop.db"))
    listed = [r["table_name"] for r in sinks.list_tables(spark, "omop_sink_test").collect()]
    assert listed == sorted(listed) and "visit_occurrence" in listed and len(listed) == 8
    counts = {r["table_name"]: r["row_count"] for r in catalog_counts(spark, "omop_sink_test").collect()}
    assert counts["person"] == 7 and counts["condition_occurrence"] == 7 and counts["drug_exposure"] == 0
    sinks.save_tables(c.tables(), "omop_sink_test")  # overwrite: idempotent re-run
    assert spark.table("omop_sink_test.person").count() == 7


def test_catalog_counts_every_database(spark, tmpdir_path):
    c = run_etl(_small_registry(spark, range(1, 4)))
    sinks.save_tables({"person": c.person}, "omop_all_a", location=os.path.join(tmpdir_path, "a.db"))
    sinks.save_tables({"measurement": c.measurement}, "omop_all_b", location=os.path.join(tmpdir_path, "b.db"))
    rows = [(r["table_schema"], r["table_name"], r["row_count"]) for r in catalog_counts(spark).collect()]
    assert ("omop_all_a", "person", 3) in rows and ("omop_all_b", "measurement", 3) in rows
    assert rows == sorted(rows)


def test_job_command_line(spark, tmpdir_path, capsys):
    from cdmflow.plans.job import main
    data = os.path.join(tmpdir_path, "data")
    os.makedirs(data)
    labels = {r[0]: r[3] for r in DICTIONARY_ROWS}
    with open(os.path.join(data, "patients.csv"), "w", encoding="utf-8", newline="") as fh:
        w = csv.writer(fh)
        w.writerow([labels["record_id"], labels["gender"]])
        w.writerow(["5", "Male"])
    out = os.path.join(tmpdir_path, "out")
    assert main(["--data", data, "--out", out, "--source-name", "Test registry"]) == 0
    assert "person" in capsys.readouterr().out
    src = spark.read.parquet(os.path.join(out, "omop", "cdm_source")).first()
    assert src["cdm_source_name"] == "Test registry"
    # the mapping sheet is missing -> the rule table is staged; dictionary missing -> skipped
    assert spark.read.parquet(os.path.join(out, "import", "mappings")).count() == 24


def test_path_exists_forms(spark, tmpdir_path):
    from cdmflow.session import path_exists
    folder = os.path.join(tmpdir_path, "here")
    os.makedirs(folder)
    assert path_exists(spark, folder) and path_exists(spark, "file://" + folder)
    assert not path_exists(spark, os.path.join(tmpdir_path, "missing"))
    assert not path_exists(spark, "file://" + os.path.join(tmpdir_path, "missing"))
