"""The registry's data dictionary (REDCap export): scan, fixed copy, and label renaming."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column headers of a REDCap data-dictionary export, in file order.
DICTIONARY_COLUMNS = (
    "Variable / Field Name", "Form Name", "Section Header", "Field Type", "Field Label",
    "Choices, Calculations, OR Slider Labels", "Field Note", "Text Validation Type OR Show Slider Number",
    "Text Validation Min", "Text Validation Max", "Identifier?", "Branching Logic (Show field only if...)",
    "Required Field?", "Custom Alignment", "Question Number (surveys only)", "Matrix Group Name",
    "Matrix Ranking?",
)
# snake_case names used once the file is read.
DICTIONARY_FIELDS = (
    "variable", "form", "section_header", "field_type", "label", "choices", "field_note",
    "validation", "validation_min", "validation_max", "identifier", "branching_logic",
    "required", "custom_alignment", "question_number", "matrix_group", "matrix_ranking",
)
DICTIONARY_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in DICTIONARY_FIELDS])

# The 27 dictionary records the registry export ships with
# (variable, form, field type, label, choices, validation, min, max, identifier, branching logic, required).
# Labels keep their exact characters: a leading blank, U+00A0 in the cardiac label,
# MICRO SIGN U+00B5 in the ferritin label and GREEK MU U+03BC in the iron label.
DICTIONARY_ROWS: tuple[tuple[str | None, ...], ...] = (
    ("record_id", "patient_registration", "number", "Record ID", None, None, None, None, None, None, None),
    ("consent_registry", "patient_registration", "checkbox",
     "I confirm that patient consent has been obtained which allows the processing of this pseudonymized "
     "clinical information within RADeep \n", "1, Yes", None, None, None, None, None, "y"),
    ("date_of_birth", "patient_registration", "text", "Patient's date of birth", None, "date_dmy",
     "01/01/1930", "today", "y", None, "y"),
    ("gender", "patient_registration", "dropdown", "Patient's sex at birth",
     "1, Male | 2, Female | 3, Undetermined | 4, Foetus (unknown)", None, None, None, "y", None, "y"),
    ("orpha_code_id", "diagnosis", "dropdown", "Diagnosis retained by the specialised centre",
     "1, Alpha-thalassemia (ORPHA_846) | 2, Beta-thalassemia (ORPHA_848) | "
     "5, Constitutional dyserythropoietic anemia (ORPHA_293830) | 6, Hemoglobin C disease (ORPHA_2132) | "
     "7, Hemoglobin E disease (ORPHA_2133) | 8, Hemoglobinopathy with altered affinity (ORPHA_RAD001) | "
     "9, Hereditary methemoglobinemia (ORPHA_621) | "
     "11, Rare constitutional hemolytic anemia due to a red cell membrane anomaly (ORPHA_98364) | "
     "13, Sickle cell disease and related diseases (ORPHA_275752) | 15, Unstable hemoglobin disease (ORPHA_99139)",
     None, None, None, None, None, "y"),
    ("patient_status", "annual_update_general_information", "dropdown", "Patient status at follow-up",
     "1, Alive | 2, Dead | 3, Opted-out | 4, Lost in follow-up", None, None, None, None, None, "y"),
    ("transfusion_status_present", "treatments", "dropdown",
     " Does the patient require regular or occasional transfusions in the present (in the last 12 months) ?",
     "1, Yes (Regular) | 2, Yes (Occasional) | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("varsid_hbb_a1", "diagnosis", "dropdown", "HBB Allele 1", "1, b+|2, b++|3,b0",
     None, None, None, None, None, None),
    ("varsid_hbb_a2", "diagnosis", "dropdown", "HBB Allele 2", "1, b+|2, b++|3,b0",
     None, None, None, None, None, None),
    ("varsid_hba_a1", "diagnosis", "dropdown", "HBA Allele 1", "1, a+|2,a0", "autocomplete", None, None, None,
     "[gene_type(1)] = '0' AND [method_of_diagnosis(3)] = '1'", None),
    ("varsid_hba_a2", "diagnosis", "dropdown", "HBA Allele 2", "1, a+|2,a0", "autocomplete", None, None, None,
     "[gene_type(1)] = '0' AND [method_of_diagnosis(3)] = '1'", None),
    ("cardiac_t2", "clinical_manifestations", "text", "Cardiac iron T2*\u00a0 (milisec)", None, "number",
     "0", "100", None, None, None),
    ("endo_hypopit", "medical_history", "dropdown", "Hypopituitarism",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("chelation_treat", "treatments", "dropdown", "Is the patient on chelation treatment ?",
     "1, Yes | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("hydroxyurea_treatment", "treatments", "dropdown",
     "Is the patient on hydroxyurea treatment (present time) ?",
     "1, Yes | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("was_pregnant", "medical_history", "dropdown", "Is the patient infertile?",
     "1, Yes | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("lkd_ac_vir_hepat", "medical_history", "dropdown", "Acute viral hepatitis",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("endo_vit_d_def", "medical_history", "dropdown", "Vitamin D deficiency",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("liver_mri_t2", "clinical_manifestations", "text", "Liver MRI T2* (milisec)", None, "number",
     "0", "100", None, None, None),
    ("lkd_cirrhosis", "medical_history", "dropdown", "Cirrhosis",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("bc_osteoporosis", "medical_history", "dropdown", "Osteoporosis",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("bc_osteopenia", "medical_history", "dropdown", "Osteopenia",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("cpd_ac_chest_syn", "medical_history", "dropdown", "Acute chest syndrome",
     "1, Yes, confirmed | 3, Clinical suspicion | 0, No | 999, Unknown", None, None, None, None, None, "y"),
    ("ferritin_result", "diagnosis_lab_tests_in_the_past_12_months", "text", "Ferritin serum (ng/mL / \u00b5g/L)",
     None, "number", "1", "10000", None, "[ferritin_performed] = '1'", "y"),
    ("iron_result", "diagnosis_lab_tests_in_the_past_12_months", "text", "Serum iron (\u03bcg/dL)",
     None, "number", "1", "1000", None, "[iron_performed] = '1'", "y"),
    ("drug_compliance", "treatments", "dropdown", "Drug compliance",
     "1, Excellent (>80% of recommended dose) | 2, Good (80-60 % of recommended dose) | "
     "3, Poor (< 60% of recommended dose) | 999, Unknown", None, None, None, None, "[chelation_treat] = '1'",
     None),
    ("splenectomy", "clinical_manifestations", "dropdown", "Has the spleen been removed ?",
     "1, Yes, totally | 2, Yes, partially | 0, No | 999, Unknown", None, None, None, None, None, "y"),
)

# Registry columns without a dictionary record, named by hand.
EXTRA_LABELS = {"Patient's country of birth": "country_of_birth"}


def dictionary_frame(spark: SparkSession) -> DataFrame:
    """The fixed dictionary as a 27 x 17 frame (same shape as the scanned file)."""
    rows = []
    for v, form, ftype, label, choices, valid, lo, hi, ident, branch, req in DICTIONARY_ROWS:
        rows.append((v, form, None, ftype, label, choices, None, valid, lo, hi, ident, branch, req,
                     None, None, None, None))
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Scan a dictionary export: UTF-8 BOM, CRLF, quoted fields with newlines and doubled quotes."""
    df = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return df.toDF(*DICTIONARY_FIELDS[: len(df.columns)])


def normalize_label(label: str) -> str:
    """Compatibility form of a label: NFKC (MICRO SIGN -> GREEK MU, NBSP -> blank), blanks collapsed."""
    s = unicodedata.normalize("NFKC", label).replace("﻿", "")
    return re.sub(r"\s+", " ", s).strip().casefold()


def label_to_variable(labels: dict[str, str] | None = None) -> dict[str, str]:
    """Label -> variable name, exact labels first; the caller falls back to normalized labels."""
    out = {row[3]: row[0] for row in DICTIONARY_ROWS}
    out.update(EXTRA_LABELS)
    if labels:
        out.update(labels)
    return out


def rename_labels(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename label-named columns to dictionary variable names (D-DICT5).

    Exact label match first; otherwise the normalized label (so the two mu characters,
    NBSP and stray blanks do not break the match). Unknown columns keep their name.
    """
    exact = label_to_variable(mapping)
    loose = {normalize_label(k): v for k, v in exact.items()}
    renames = {}
    for c in df.columns:
        target = exact.get(c) or loose.get(normalize_label(c))
        if target and target != c:
            renames[c] = target
    return df.withColumnsRenamed(renames) if renames else df


def variables_from_frame(dictionary: DataFrame) -> dict[str, str]:
    """Label -> variable mapping taken from a scanned dictionary (27 rows: a bounded collect)."""
    return {r["label"]: r["variable"] for r in dictionary.select("label", "variable").collect() if r["label"]}


def identifier_fields() -> tuple[str, ...]:
    return tuple(r[0] for r in DICTIONARY_ROWS if r[8] == "y")


def required_fields() -> tuple[str, ...]:
    return tuple(r[0] for r in DICTIONARY_ROWS if r[10] == "y")


def numeric_ranges() -> dict[str, tuple[float, float]]:
    return {r[0]: (float(r[6]), float(r[7])) for r in DICTIONARY_ROWS if r[5] == "number" and r[6] and r[7]}


def parse_choices(choices: str) -> list[tuple[str, str]]:
    """``"1, Yes | 0, No"`` -> [("1", "Yes"), ("0", "No")]; split at the first comma only."""
    out = []
    for part in choices.split("|"):
        part = part.strip()
        if not part:
            continue
        code, _, label = part.partition(",")
        out.append((code.strip(), label.strip()))
    return out
