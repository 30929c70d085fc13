"""DuckDB SQL of the loaded tables: the correctness oracle, written from the specification.

The registry is unpivoted into (person, field, answer) and joined with one list of answers and what each of them
means; the events of each table are then numbered in (rule, person) order. Every literal here is the oracle's own, so
a wrong constant of the library cannot confirm itself; only the definition of the stand-in registry is shared.
Tables: the driver's parquet views (orders, customer, nation, part, region, ...).
"""

from __future__ import annotations

from .sources.registry import fixture_select_list

REG = ("SELECT " + ", ".join(f"{e} AS {c}" for c, e in fixture_select_list("duckdb"))
       + " FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
_NUMBERS = ("cardiac_t2", "liver_mri_t2", "ferritin_result", "iron_result")
REG_TYPED = ("SELECT * REPLACE (record_id::BIGINT AS record_id, " + ", ".join(f"{c}::DOUBLE AS {c}" for c in _NUMBERS)
             + ") FROM reg0")

# Fixed values: (rule, table, field, answer, concept). An answer of '*' stands for every answer the rule does not
# name, the empty one included; '#' for any number.
MEANING = [
    (1, "condition", "orpha_code_id", "Alpha-thalassemia", 4287844),
    (1, "condition", "orpha_code_id", "Beta-thalassemia", 4278669),
    (1, "condition", "orpha_code_id", "Sickle cell disease", 25518),
    (1, "condition", "orpha_code_id", "*", 0),
    (2, "condition", "endo_hypopit", "Yes", 4254542),
    (3, "condition", "was_pregnant", "Yes", 4311387),
    (4, "condition", "lkd_ac_vir_hepat", "Yes", 4211974),
    (5, "condition", "endo_vit_d_def", "Yes, confirmed", 436070),
    (6, "condition", "bc_osteoporosis", "Yes, confirmed", 80502),
    (7, "condition", "bc_osteopenia", "Yes, confirmed", 4195039),
    (8, "condition", "cpd_ac_chest_syn", "Yes, confirmed", 254062),
    (9, "observation", "country_of_birth", "Australia", 4199969),
    (9, "observation", "country_of_birth", "Canada", 4200105),
    (9, "observation", "country_of_birth", "Congo", 4202085),
    (9, "observation", "country_of_birth", "Cyprus", 4152209),
    (9, "observation", "country_of_birth", "Greece", 4151604),
    (9, "observation", "country_of_birth", "Iraq", 4152215),
    (9, "observation", "country_of_birth", "Syria", 4153306),
    (9, "observation", "country_of_birth", "United Kingdom", 4202086),
    (9, "observation", "country_of_birth", "*", 40482029),
    (10, "observation", "transfusion_status_present", "*", 40758326),
    (11, "observation", "varsid_hbb_a1", "*", 0),
    (12, "observation", "varsid_hbb_a2", "*", 0),
    (13, "observation", "varsid_hba_a1", "*", 0),
    (14, "observation", "varsid_hba_a2", "*", 0),
    (15, "observation", "drug_compliance", "Poor (< 60% of recommended dose)", 4292063),
    (16, "observation", "drug_compliance", "Good (80-60 % of recommended dose)", 4056965),
    (16, "observation", "drug_compliance", "Excellent (>80% of recommended dose)", 4056965),
    (17, "measurement", "cardiac_t2", "#", 0),
    (18, "measurement", "liver_mri_t2", "#", 0),
    (19, "measurement", "lkd_cirrhosis", "Yes, confirmed", 36770062),
    (20, "measurement", "ferritin_result", "#", 37208753),
    (21, "measurement", "iron_result", "#", 4097596),
    (22, "procedure", "chelation_treat", "Yes", 4068544),
    (23, "procedure", "hydroxyurea_treatment", "Yes", 3169902),
    (24, "procedure", "splenectomy", "Yes, totally", 2834904),
]
# Fixed values: (concept, name, domain) of the concepts that events carry.
CONCEPTS = [
    (0, "No matching concept", "Metadata"),
    (25518, "Sickle cell disease", "Condition"),
    (4278669, "Beta-thalassemia", "Condition"),
    (4287844, "Alpha-thalassemia", "Condition"),
    (4254542, "Hypopituitarism", "Condition"),
    (4311387, "Infertile", "Condition"),
    (4211974, "Acute viral hepatitis", "Condition"),
    (436070, "Vitamin D deficiency", "Condition"),
    (80502, "Osteoporosis", "Condition"),
    (4195039, "Osteopenia", "Condition"),
    (254062, "Acute chest syndrome", "Condition"),
    (36770062, "Cirrhosis", "Condition"),
    (4199969, "Australia", "Observation"),
    (4200105, "Canada", "Observation"),
    (4202085, "Congo", "Observation"),
    (4152209, "Cyprus", "Observation"),
    (4151604, "Greece", "Observation"),
    (4152215, "Iraq", "Observation"),
    (4153306, "Syria", "Observation"),
    (4202086, "England", "Observation"),
    (40482029, "Country of birth unknown", "Observation"),
    (40758326, "Transfusion status qualitative", "Observation"),
    (4292063, "Drug compliance poor", "Observation"),
    (4056965, "Drug compliance good", "Observation"),
    (37208753, "Ferritin mass concentration in serum", "Measurement"),
    (4097596, "Serum iron measurement", "Measurement"),
    (4068544, "Chelation", "Procedure"),
    (3169902, "Hydroxyurea therapy", "Procedure"),
    (2834904, "Removal of spleen", "Procedure"),
]
_FIELDS = list(dict.fromkeys(m[2] for m in MEANING))


def values(rows: list[tuple]) -> str:
    """A VALUES list of ``rows``."""
    def literal(v) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


CTES = {
    "reg0": REG,
    "reg": REG_TYPED,
    "person": """
  SELECT dense_rank() OVER (ORDER BY record_id) AS person_id,
         (CASE WHEN gender = 'Male' THEN 8507 WHEN gender = 'Female' THEN 8532 ELSE 0 END)::INTEGER AS gender_concept_id,
         date_part('year', born)::INTEGER AS year_of_birth, date_part('month', born)::INTEGER AS month_of_birth,
         date_part('day', born)::INTEGER AS day_of_birth, 0 AS race_concept_id, 0 AS ethnicity_concept_id,
         record_id::VARCHAR AS person_source_value, gender AS gender_source_value
  FROM (SELECT *, try_strptime(date_of_birth, '%d/%m/%Y') AS born FROM reg)""",
    # one period and one visit a person, numbered alike, all on the day of the export
    "observation_period": """
  SELECT person_id AS observation_period_id, person_id, DATE '2026-05-12' AS observation_period_start_date,
         DATE '2026-05-12' AS observation_period_end_date, 32809 AS period_type_concept_id FROM person""",
    "visit_occurrence": """
  SELECT person_id AS visit_occurrence_id, person_id, 581476 AS visit_concept_id, DATE '2026-05-12' AS visit_start_date,
         TIMESTAMP '2026-05-12 00:00:00' AS visit_start_datetime, DATE '2026-05-12' AS visit_end_date,
         TIMESTAMP '2026-05-12 00:00:00' AS visit_end_datetime, 32809 AS visit_type_concept_id FROM person""",
    "meaning": f"SELECT * FROM ({values(MEANING)}) AS t(rule, tab, field, said, concept)",
    "answer": f"""
  SELECT who, field, said
  FROM (SELECT dense_rank() OVER (ORDER BY record_id) AS who, {", ".join(f"{c}::VARCHAR AS {c}" for c in _FIELDS)} FROM reg)
  UNPIVOT INCLUDE NULLS (said FOR field IN ({", ".join(_FIELDS)}))""",
    "event": """
  SELECT *, row_number() OVER (PARTITION BY tab ORDER BY rule, who) AS id
  FROM (SELECT tab, rule, who, a.field, a.said, concept::INTEGER AS concept
        FROM answer a JOIN meaning m ON a.field = m.field AND (m.said = a.said OR m.said = '*' OR (m.said = '#' AND a.said IS NOT NULL))
        QUALIFY row_number() OVER (PARTITION BY rule, who ORDER BY m.said = '*') = 1)""",
    "condition_occurrence": """
  SELECT id AS condition_occurrence_id, who AS person_id, concept AS condition_concept_id,
         DATE '2026-05-12' AS condition_start_date, TIMESTAMP '2026-05-12 00:00:00' AS condition_start_datetime,
         DATE '2026-05-12' AS condition_end_date, TIMESTAMP '2026-05-12 00:00:00' AS condition_end_datetime,
         32865 AS condition_type_concept_id, who AS visit_occurrence_id, said AS condition_source_value
  FROM event WHERE tab = 'condition'""",
    "observation": """
  SELECT id AS observation_id, who AS person_id, concept AS observation_concept_id, DATE '2026-05-12' AS observation_date,
         TIMESTAMP '2026-05-12 00:00:00' AS observation_datetime, 32865 AS observation_type_concept_id,
         CASE WHEN starts_with(field, 'varsid') THEN said END AS value_as_string, who AS visit_occurrence_id,
         CASE WHEN starts_with(field, 'varsid_hbb') THEN 'HGNC:4827'
              WHEN starts_with(field, 'varsid_hba') THEN 'HGNC:4823;HGNC:4824' ELSE said END AS value_source_value
  FROM event WHERE tab = 'observation'""",
    "measurement": """
  SELECT id AS measurement_id, who AS person_id, concept AS measurement_concept_id, DATE '2026-05-12' AS measurement_date,
         TIMESTAMP '2026-05-12 00:00:00' AS measurement_datetime, 32809 AS measurement_type_concept_id,
         CASE WHEN rule <> 19 THEN said::DOUBLE END AS value_as_number,
         (CASE field WHEN 'ferritin_result' THEN 8842 WHEN 'iron_result' THEN 8837 ELSE 9593 END)::INTEGER AS unit_concept_id,
         who AS visit_occurrence_id,
         CASE field WHEN 'cardiac_t2' THEN 'Cardiac iron T2' WHEN 'liver_mri_t2' THEN 'Liver MRI T2'
                    WHEN 'lkd_cirrhosis' THEN said END AS value_source_value
  FROM event WHERE tab = 'measurement'""",
    "procedure_occurrence": """
  SELECT id AS procedure_occurrence_id, who AS person_id, concept AS procedure_concept_id, DATE '2026-05-12' AS procedure_date,
         TIMESTAMP '2026-05-12 00:00:00' AS procedure_datetime, DATE '2026-05-12' AS procedure_end_date,
         TIMESTAMP '2026-05-12 00:00:00' AS procedure_end_datetime, 32865 AS procedure_type_concept_id,
         who AS visit_occurrence_id, said AS procedure_source_value
  FROM event WHERE tab = 'procedure'""",
    "concept": f"SELECT concept_id::INTEGER AS concept_id, concept_name, domain_id FROM ({values(CONCEPTS)}) AS t(concept_id, concept_name, domain_id)",
}
_DEPS = {
    "reg0": [], "reg": ["reg0"], "person": ["reg"], "observation_period": ["person"], "visit_occurrence": ["person"],
    "meaning": [], "answer": ["reg"], "event": ["answer", "meaning"], "condition_occurrence": ["event"],
    "observation": ["event"], "measurement": ["event"], "procedure_occurrence": ["event"], "concept": [],
}


def with_ctes(body: str, *needs: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and theirs), in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body
