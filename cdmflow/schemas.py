"""Fixed target schemas of the clinical data model (CDM 5.4 columns the ETL writes or reads).

Surrogate ids are ``long`` so they survive scale; concept ids stay ``int`` as in the CDM.
``*_datetime`` columns are timestamps without time zone, like the SQL ``TIMESTAMP`` they model.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, DBL = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.DoubleType()
TS = T.TimestampNTZType()


def empty_frame(spark, schema: T.StructType):
    """An empty DataFrame of ``schema`` without shipping local data (``range(0)`` + typed NULLs)."""
    from pyspark.sql import functions as F
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CDM_SOURCE = _schema(
    ("cdm_source_name", S), ("cdm_source_abbreviation", S), ("cdm_holder", S),
    ("source_release_date", D), ("cdm_release_date", D),
    ("cdm_version_concept_id", I), ("vocabulary_version", S),
)

PERSON = _schema(
    ("person_id", L), ("gender_concept_id", I), ("year_of_birth", I), ("month_of_birth", I),
    ("day_of_birth", I), ("race_concept_id", I), ("ethnicity_concept_id", I),
    ("person_source_value", S), ("gender_source_value", S),
)

OBSERVATION_PERIOD = _schema(
    ("observation_period_id", L), ("person_id", L),
    ("observation_period_start_date", D), ("observation_period_end_date", D),
    ("period_type_concept_id", I),
)

VISIT_OCCURRENCE = _schema(
    ("visit_occurrence_id", L), ("person_id", L), ("visit_concept_id", I),
    ("visit_start_date", D), ("visit_start_datetime", TS),
    ("visit_end_date", D), ("visit_end_datetime", TS), ("visit_type_concept_id", I),
)

CONDITION_OCCURRENCE = _schema(
    ("condition_occurrence_id", L), ("person_id", L), ("condition_concept_id", I),
    ("condition_start_date", D), ("condition_start_datetime", TS),
    ("condition_end_date", D), ("condition_end_datetime", TS),
    ("condition_type_concept_id", I), ("visit_occurrence_id", L), ("condition_source_value", S),
)

OBSERVATION = _schema(
    ("observation_id", L), ("person_id", L), ("observation_concept_id", I),
    ("observation_date", D), ("observation_datetime", TS), ("observation_type_concept_id", I),
    ("value_as_string", S), ("visit_occurrence_id", L), ("value_source_value", S),
)

MEASUREMENT = _schema(
    ("measurement_id", L), ("person_id", L), ("measurement_concept_id", I),
    ("measurement_date", D), ("measurement_datetime", TS), ("measurement_type_concept_id", I),
    ("value_as_number", DBL), ("unit_concept_id", I), ("visit_occurrence_id", L),
    ("value_source_value", S),
)

PROCEDURE_OCCURRENCE = _schema(
    ("procedure_occurrence_id", L), ("person_id", L), ("procedure_concept_id", I),
    ("procedure_date", D), ("procedure_datetime", TS),
    ("procedure_end_date", D), ("procedure_end_datetime", TS),
    ("procedure_type_concept_id", I), ("visit_occurrence_id", L), ("procedure_source_value", S),
)

DRUG_EXPOSURE = _schema(
    ("drug_exposure_id", L), ("person_id", L), ("drug_concept_id", I),
    ("drug_exposure_start_date", D), ("drug_exposure_start_datetime", TS),
    ("drug_exposure_end_date", D), ("drug_exposure_end_datetime", TS),
    ("drug_type_concept_id", I), ("quantity", DBL), ("visit_occurrence_id", L),
    ("drug_source_value", S),
)

# Vocabulary tables (column lists of the public CDM 5.4).
CONCEPT = _schema(
    ("concept_id", I), ("concept_name", S), ("domain_id", S), ("vocabulary_id", S),
    ("concept_class_id", S), ("standard_concept", S), ("concept_code", S),
    ("valid_start_date", D), ("valid_end_date", D), ("invalid_reason", S),
)
CONCEPT_RELATIONSHIP = _schema(
    ("concept_id_1", I), ("concept_id_2", I), ("relationship_id", S),
    ("valid_start_date", D), ("valid_end_date", D), ("invalid_reason", S),
)
CONCEPT_ANCESTOR = _schema(
    ("ancestor_concept_id", I), ("descendant_concept_id", I),
    ("min_levels_of_separation", I), ("max_levels_of_separation", I),
)
CONCEPT_SYNONYM = _schema(("concept_id", I), ("concept_synonym_name", S), ("language_concept_id", I))
CONCEPT_CLASS = _schema(("concept_class_id", S), ("concept_class_name", S), ("concept_class_concept_id", I))
DOMAIN = _schema(("domain_id", S), ("domain_name", S), ("domain_concept_id", I))
DRUG_STRENGTH = _schema(
    ("drug_concept_id", I), ("ingredient_concept_id", I), ("amount_value", DBL),
    ("amount_unit_concept_id", I), ("numerator_value", DBL), ("numerator_unit_concept_id", I),
    ("denominator_value", DBL), ("denominator_unit_concept_id", I), ("box_size", I),
    ("valid_start_date", D), ("valid_end_date", D), ("invalid_reason", S),
)
RELATIONSHIP = _schema(
    ("relationship_id", S), ("relationship_name", S), ("is_hierarchical", S),
    ("defines_ancestry", S), ("reverse_relationship_id", S), ("relationship_concept_id", I),
)
VOCABULARY = _schema(
    ("vocabulary_id", S), ("vocabulary_name", S), ("vocabulary_reference", S),
    ("vocabulary_version", S), ("vocabulary_concept_id", I),
)

# Clinical tables in load order (person first, events last).
CLINICAL_TABLES: dict[str, T.StructType] = {
    "person": PERSON,
    "observation_period": OBSERVATION_PERIOD,
    "visit_occurrence": VISIT_OCCURRENCE,
    "condition_occurrence": CONDITION_OCCURRENCE,
    "observation": OBSERVATION,
    "measurement": MEASUREMENT,
    "procedure_occurrence": PROCEDURE_OCCURRENCE,
    "drug_exposure": DRUG_EXPOSURE,
}

# Vocabulary file name -> (table, schema); files are tab-separated with upper-case headers.
VOCABULARY_FILES: dict[str, tuple[str, T.StructType]] = {
    "CONCEPT.csv": ("concept", CONCEPT),
    "CONCEPT_RELATIONSHIP.csv": ("concept_relationship", CONCEPT_RELATIONSHIP),
    "CONCEPT_ANCESTOR.csv": ("concept_ancestor", CONCEPT_ANCESTOR),
    "CONCEPT_SYNONYM.csv": ("concept_synonym", CONCEPT_SYNONYM),
    "CONCEPT_CLASS.csv": ("concept_class", CONCEPT_CLASS),
    "DOMAIN.csv": ("domain", DOMAIN),
    "DRUG_STRENGTH.csv": ("drug_strength", DRUG_STRENGTH),
    "RELATIONSHIP.csv": ("relationship", RELATIONSHIP),
    "VOCABULARY.csv": ("vocabulary", VOCABULARY),
}

ALL_CDM: dict[str, T.StructType] = {"cdm_source": CDM_SOURCE, **CLINICAL_TABLES}
