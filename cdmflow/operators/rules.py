"""The registry -> event-table mapping, held as data.

Every event rule is one row. The fan-out (``operators.fanout``) turns the whole
table into one pass over the registry; nothing here is code per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Concept ids, literal answers and source values that the loaded
# tables must carry to give the same results as the reference ETL.
# ---------------------------------------------------------------------------
PROXY_DATE = "2026-05-12"  # every event, period and visit date

GENDER_MAP = {"Male": 8507, "Female": 8532}
GENDER_DEFAULT = 0
RACE_CONCEPT = 0
ETHNICITY_CONCEPT = 0
PERIOD_TYPE_CONCEPT = 32809  # case report form
VISIT_CONCEPT = 581476  # home visit
VISIT_TYPE_CONCEPT = 32809
EVENT_TYPE_CONCEPT = {  # patient self report / case report form
    "condition_occurrence": 32865,
    "observation": 32865,
    "measurement": 32809,
    "procedure_occurrence": 32865,
}

DIAGNOSIS_MAP = {"Alpha-thalassemia": 4287844, "Beta-thalassemia": 4278669, "Sickle cell disease": 25518}
PRIMARY_DIAGNOSIS_CONCEPTS = (4287844, 4278669, 25518)
COUNTRY_MAP = {
    "Australia": 4199969,
    "Canada": 4200105,
    "Congo": 4202085,
    "Cyprus": 4152209,
    "Greece": 4151604,
    "Iraq": 4152215,
    "Syria": 4153306,
    "United Kingdom": 4202086,
}
COUNTRY_DEFAULT = 40482029  # country of birth unknown
TRANSFUSION_CONCEPT = 40758326
CHELATION_CONCEPT = 4068544
FERRITIN_CONCEPT = 37208753


@dataclass(frozen=True)
class Rule:
    """One event rule: which registry column, when it fires, and what it writes.

    ``when``: ``all`` (a row for every registry row, NULL answers included),
    ``in`` (answer equals one of ``match``) or ``not_null``.
    ``concept_map`` + ``default_concept`` is a value map (CASE x WHEN ... ELSE default).
    ``source``: ``"answer"`` copies the answer, any other string is a literal, None leaves NULL.
    """

    rule_no: int
    rule_id: str
    target: str
    column: str
    when: str
    match: tuple[str, ...] = ()
    concept_id: int = 0
    concept_map: dict[str, int] = field(default_factory=dict)
    default_concept: int = 0
    number: bool = False
    text: bool = False
    unit_concept_id: int | None = None
    source: str | None = "answer"
    type_concept_id: int | None = None  # None: the type of the target table


ANSWER = "answer"

# The 24 event rules in the reference's load order.
RULES: tuple[Rule, ...] = (
    Rule(1, "L-C1", "condition_occurrence", "orpha_code_id", "all",
         concept_map=DIAGNOSIS_MAP, default_concept=0),
    Rule(2, "L-C2", "condition_occurrence", "endo_hypopit", "in", ("Yes",), 4254542),
    Rule(3, "L-C3", "condition_occurrence", "was_pregnant", "in", ("Yes",), 4311387),
    Rule(4, "L-C4", "condition_occurrence", "lkd_ac_vir_hepat", "in", ("Yes",), 4211974),
    Rule(5, "L-C5", "condition_occurrence", "endo_vit_d_def", "in", ("Yes, confirmed",), 436070),
    Rule(6, "L-C6", "condition_occurrence", "bc_osteoporosis", "in", ("Yes, confirmed",), 80502),
    Rule(7, "L-C7", "condition_occurrence", "bc_osteopenia", "in", ("Yes, confirmed",), 4195039),
    Rule(8, "L-C8", "condition_occurrence", "cpd_ac_chest_syn", "in", ("Yes, confirmed",), 254062),
    Rule(9, "L-O1", "observation", "country_of_birth", "all",
         concept_map=COUNTRY_MAP, default_concept=COUNTRY_DEFAULT),
    Rule(10, "L-O2", "observation", "transfusion_status_present", "all", concept_id=TRANSFUSION_CONCEPT),
    Rule(11, "L-O3", "observation", "varsid_hbb_a1", "all", concept_id=0, text=True, source="HGNC:4827"),
    Rule(12, "L-O4", "observation", "varsid_hbb_a2", "all", concept_id=0, text=True, source="HGNC:4827"),
    Rule(13, "L-O5", "observation", "varsid_hba_a1", "all", concept_id=0, text=True,
         source="HGNC:4823;HGNC:4824"),
    Rule(14, "L-O6", "observation", "varsid_hba_a2", "all", concept_id=0, text=True,
         source="HGNC:4823;HGNC:4824"),
    Rule(15, "L-O7", "observation", "drug_compliance", "in",
         ("Poor (< 60% of recommended dose)",), 4292063),
    Rule(16, "L-O8", "observation", "drug_compliance", "in",
         ("Good (80-60 % of recommended dose)", "Excellent (>80% of recommended dose)"), 4056965),
    Rule(17, "L-M1", "measurement", "cardiac_t2", "not_null", concept_id=0, number=True,
         unit_concept_id=9593, source="Cardiac iron T2"),
    Rule(18, "L-M2", "measurement", "liver_mri_t2", "not_null", concept_id=0, number=True,
         unit_concept_id=9593, source="Liver MRI T2"),
    Rule(19, "L-M3", "measurement", "lkd_cirrhosis", "in", ("Yes, confirmed",), 36770062,
         unit_concept_id=9593),
    Rule(20, "L-M4", "measurement", "ferritin_result", "not_null", concept_id=FERRITIN_CONCEPT,
         number=True, unit_concept_id=8842, source=None),
    Rule(21, "L-M5", "measurement", "iron_result", "not_null", concept_id=4097596, number=True,
         unit_concept_id=8837, source=None),
    Rule(22, "L-P1", "procedure_occurrence", "chelation_treat", "in", ("Yes",), CHELATION_CONCEPT),
    Rule(23, "L-P2", "procedure_occurrence", "hydroxyurea_treatment", "in", ("Yes",), 3169902),
    Rule(24, "L-P3", "procedure_occurrence", "splenectomy", "in", ("Yes, totally",), 2834904),
)

EVENT_TARGETS = ("condition_occurrence", "observation", "measurement", "procedure_occurrence")
TARGET_NO = {t: i for i, t in enumerate(EVENT_TARGETS)}

# Concept rows for every id the rules use (names as given with the mapping).
# (concept_id, concept_name, domain_id, vocabulary_id, concept_class_id)
CONCEPT_ROWS: tuple[tuple[int, str, str, str, str], ...] = (
    (0, "No matching concept", "Metadata", "None", "Undefined"),
    (8507, "Male", "Gender", "Gender", "Gender"),
    (8532, "Female", "Gender", "Gender", "Gender"),
    (581476, "Home visit", "Visit", "Visit", "Visit"),
    (32809, "Case report form", "Type Concept", "Type Concept", "Type Concept"),
    (32865, "Patient self report", "Type Concept", "Type Concept", "Type Concept"),
    (756265, "CDM version 5.4", "Metadata", "CDM", "CDM"),
    (4287844, "Alpha-thalassemia", "Condition", "SNOMED", "Clinical Finding"),
    (4278669, "Beta-thalassemia", "Condition", "SNOMED", "Clinical Finding"),
    (25518, "Sickle cell disease", "Condition", "SNOMED", "Clinical Finding"),
    (4254542, "Hypopituitarism", "Condition", "SNOMED", "Clinical Finding"),
    (4311387, "Infertile", "Condition", "SNOMED", "Clinical Finding"),
    (4211974, "Acute viral hepatitis", "Condition", "SNOMED", "Clinical Finding"),
    (436070, "Vitamin D deficiency", "Condition", "SNOMED", "Clinical Finding"),
    (80502, "Osteoporosis", "Condition", "SNOMED", "Clinical Finding"),
    (4195039, "Osteopenia", "Condition", "SNOMED", "Clinical Finding"),
    (254062, "Acute chest syndrome", "Condition", "SNOMED", "Clinical Finding"),
    (4199969, "Australia", "Observation", "SNOMED", "Location"),
    (4200105, "Canada", "Observation", "SNOMED", "Location"),
    (4202085, "Congo", "Observation", "SNOMED", "Location"),
    (4152209, "Cyprus", "Observation", "SNOMED", "Location"),
    (4151604, "Greece", "Observation", "SNOMED", "Location"),
    (4152215, "Iraq", "Observation", "SNOMED", "Location"),
    (4153306, "Syria", "Observation", "SNOMED", "Location"),
    (4202086, "England", "Observation", "SNOMED", "Location"),
    (40482029, "Country of birth unknown", "Observation", "SNOMED", "Clinical Finding"),
    (40758326, "Transfusion status qualitative", "Observation", "LOINC", "Clinical Observation"),
    (4292063, "Drug compliance poor", "Observation", "SNOMED", "Clinical Finding"),
    (4056965, "Drug compliance good", "Observation", "SNOMED", "Clinical Finding"),
    # Loaded into MEASUREMENT by the rules, but a Condition in the mapping answer key:
    # the domain check reports it.
    (36770062, "Cirrhosis", "Condition", "SNOMED", "Clinical Finding"),
    (37208753, "Ferritin mass concentration in serum", "Measurement", "LOINC", "Lab Test"),
    (4097596, "Serum iron measurement", "Measurement", "SNOMED", "Procedure"),
    (9593, "millisecond", "Unit", "UCUM", "Unit"),
    (8842, "nanogram per milliliter", "Unit", "UCUM", "Unit"),
    (8837, "microgram per deciliter", "Unit", "UCUM", "Unit"),
    (4068544, "Chelation", "Procedure", "SNOMED", "Procedure"),
    (3169902, "Hydroxyurea therapy", "Procedure", "SNOMED", "Procedure"),
    (2834904, "Removal of spleen", "Procedure", "ICD10PCS", "ICD10PCS"),
)


def rules_for(target: str, rules: Sequence[Rule] = RULES) -> tuple[Rule, ...]:
    return tuple(r for r in rules if r.target == target)


RULE_SCHEMA = T.StructType([
    T.StructField("rule_no", T.IntegerType()), T.StructField("rule_id", T.StringType()),
    T.StructField("target", T.StringType()), T.StructField("source_col", T.StringType()),
    T.StructField("predicate_kind", T.StringType()),
    T.StructField("predicate_values", T.ArrayType(T.StringType())),
    T.StructField("concept_map", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("concept_id", T.IntegerType()),
    T.StructField("type_concept_id", T.IntegerType()),
    T.StructField("value_kind", T.StringType()),
    T.StructField("unit_concept_id", T.IntegerType()),
    T.StructField("source_value", T.StringType()),
])


def rule_frame(spark: SparkSession):
    """The rule table as a DataFrame (the mapping workbook, re-aimed as data)."""
    rows = []
    for r in RULES:
        kind = "number" if r.number else "string" if r.text else "source" if r.source == ANSWER else "none"
        rows.append((
            r.rule_no, r.rule_id, r.target, r.column, r.when, list(r.match),
            dict(r.concept_map) or None,
            r.default_concept if r.concept_map else r.concept_id,
            EVENT_TYPE_CONCEPT[r.target] if r.type_concept_id is None else r.type_concept_id, kind, r.unit_concept_id, r.source,
        ))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def sheet_frame(spark: SparkSession) -> DataFrame:
    """The rule table as a mapping sheet: every cell is text, lists and value maps are JSON."""
    rules = rule_frame(spark)
    return rules.select(*[(F.to_json(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType)) else F.col(f.name).cast("string")).alias(f.name)
                          for f in RULE_SCHEMA.fields])


def rules_from_frame(mappings: DataFrame, columns: Sequence[str] | None = None) -> tuple[Rule, ...]:
    """O-SRC4 / T-MAP1: the rules that a mapping table (typed, or a sheet of text cells) states, in ``rule_no`` order.

    A rule that names an unknown table, predicate or value kind, or a registry column that is not in ``columns``, is an
    error that says which; so are missing columns of the table and a rule number that occurs twice. The table has one
    row per rule, so it is collected.
    """
    lacking = [f.name for f in RULE_SCHEMA.fields if f.name not in mappings.columns]
    if lacking:
        raise ValueError(f"the mapping table lacks {', '.join(lacking)}")
    typed = []
    for f in RULE_SCHEMA.fields:
        text = mappings.schema[f.name].dataType == T.StringType()
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType))
        typed.append((F.from_json(f.name, f.dataType) if nested and text else F.col(f.name).cast(f.dataType)).alias(f.name))
    rows = sorted(mappings.select(*typed).collect(), key=lambda r: (r["rule_no"] is None, r["rule_no"]))
    wrong = []
    for r, before in zip(rows, [None, *rows]):
        for what, value, known in (("table", r["target"], EVENT_TARGETS), ("predicate", r["predicate_kind"], ("all", "in", "not_null")),
                                   ("value kind", r["value_kind"], ("number", "string", "source", "none")),
                                   ("registry column", r["source_col"], columns if columns is not None else [r["source_col"]])):
            if value not in known:
                wrong.append(f"{r['rule_id']}: unknown {what} {value!r}")
        if r["rule_no"] is None or before is not None and before["rule_no"] == r["rule_no"]:
            wrong.append(f"{r['rule_id']}: rule_no {r['rule_no']} is missing or used twice")
    if wrong:
        raise ValueError("; ".join(wrong))
    found = []
    for r in rows:
        usual = EVENT_TYPE_CONCEPT[r["target"]]
        found.append(Rule(
            r["rule_no"], r["rule_id"], r["target"], r["source_col"], r["predicate_kind"], tuple(r["predicate_values"] or ()),
            concept_id=0 if r["concept_map"] else r["concept_id"] or 0, concept_map=dict(r["concept_map"] or {}),
            default_concept=(r["concept_id"] or 0) if r["concept_map"] else 0, number=r["value_kind"] == "number",
            text=r["value_kind"] == "string", unit_concept_id=r["unit_concept_id"], source=r["source_value"],
            type_concept_id=None if r["type_concept_id"] in (None, usual) else r["type_concept_id"]))
    return tuple(found)
