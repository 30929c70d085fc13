"""The registry questions, overview counts and verification queries over the loaded CDM tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import blank_to_null, pct
from ..operators.lookup import lookup_join
from ..operators.median import grouped_percentile_cont
from ..operators.rules import CHELATION_CONCEPT, FERRITIN_CONCEPT, PRIMARY_DIAGNOSIS_CONCEPTS, TRANSFUSION_CONCEPT
from .etl import Cdm

OVERVIEW_TABLES = ("person", "observation_period", "visit_occurrence", "condition_occurrence", "measurement",
                   "observation", "procedure_occurrence", "drug_exposure")


def total_persons(person: DataFrame) -> Column:
    """``SELECT COUNT(*) FROM person`` as a scalar subquery (no round trip through the driver)."""
    return person.agg(F.count(F.lit(1)).alias("n")).scalar()


def _by_person(cdm: Cdm, rows: DataFrame) -> DataFrame:
    """``rows`` dealt by person to ``cdm.person_parts`` tasks. What is then grouped by or joined on the person needs no
    further exchange, and a task's groups stay as many however large the load is."""
    return rows.repartition(cdm.person_parts, "person_id") if cdm.person_parts else rows


def _primary_facts(cdm: Cdm) -> DataFrame:
    """(person_id, diagnosis) of the rows of a primary diagnosis; three concepts, so their names are broadcast."""
    ids = list(PRIMARY_DIAGNOSIS_CONCEPTS)
    facts = _by_person(cdm, cdm.condition_occurrence.where(F.col("condition_concept_id").isin(ids)).select(
        "person_id", "condition_concept_id"))
    dim = cdm.concept.where(F.col("concept_id").isin(ids)).select("concept_id", "concept_name")
    return lookup_join(facts, F.broadcast(dim), facts["condition_concept_id"] == dim["concept_id"]).select(
        "person_id", F.col("concept_name").alias("diagnosis"))


def _patients_per_diagnosis(cdm: Cdm, count: Column) -> DataFrame:
    return (_primary_facts(cdm).groupBy("diagnosis").agg(count.alias("n_patients"))
            .orderBy(F.desc("n_patients"), "diagnosis"))


def q1_patients_per_diagnosis(cdm: Cdm) -> DataFrame:
    """A-Q1: distinct patients per primary diagnosis."""
    return _patients_per_diagnosis(cdm, F.count_distinct("person_id"))


def approximate_patients_per_diagnosis(cdm: Cdm, rsd: float = 0.05) -> DataFrame:
    """A-Q1 by HyperLogLog++ with relative error ``rsd``: an estimate, another answer than A-Q1."""
    return _patients_per_diagnosis(cdm, F.approx_count_distinct("person_id", rsd))


def _ferritin(cdm: Cdm) -> DataFrame:
    m = cdm.measurement.where((F.col("measurement_concept_id") == FERRITIN_CONCEPT)
                              & F.col("value_as_number").isNotNull()).select("person_id", "value_as_number")
    p = cdm.person.select("person_id", F.col("gender_source_value").alias("sex"))
    return _by_person(cdm, m).join(_by_person(cdm, p), "person_id")


def q2_median_ferritin_by_sex(cdm: Cdm) -> DataFrame:
    """A-Q2: exact median ferritin (1 decimal) and number of measurements per sex."""
    med = grouped_percentile_cont(_ferritin(cdm), ["sex"], "value_as_number", 0.5, out="_median",
                                  count_out="n_measurements")
    return med.select("sex", F.round("_median", 1).alias("median_ferritin"), "n_measurements").orderBy("sex")


def approximate_median_ferritin_by_sex(cdm: Cdm, accuracy: int = 10_000) -> DataFrame:
    """A-Q2 by a mergeable sketch without a sort: an observed value near the median, not the interpolated one."""
    return _ferritin(cdm).groupBy("sex").agg(
        F.round(F.percentile_approx("value_as_number", 0.5, accuracy), 1).alias("median_ferritin"),
        F.count(F.lit(1)).alias("n_measurements")).orderBy("sex")


def q3_transfusion_by_diagnosis(cdm: Cdm) -> DataFrame:
    """A-Q3: distinct patients per (primary diagnosis, transfusion answer).

    Both sides are reduced to distinct (person, value) pairs before the person join, so a
    person with many rows cannot multiply the join output; every joined (person, diagnosis,
    status) triple is then unique, so a plain count equals COUNT(DISTINCT person) and the
    second shuffle of a distinct aggregation is not needed.
    """
    diag = _primary_facts(cdm).distinct()
    status = _by_person(cdm, cdm.observation.where((F.col("observation_concept_id") == TRANSFUSION_CONCEPT)
                                                   & F.col("value_source_value").isNotNull()).select(
        "person_id", F.col("value_source_value").alias("transfusion_status"))).distinct()
    return (diag.join(status, "person_id")
                .groupBy("diagnosis", "transfusion_status")
                .agg(F.count(F.lit(1)).alias("n_patients"))
                .orderBy("diagnosis", "transfusion_status"))


def q4_comorbidity_prevalence(cdm: Cdm) -> DataFrame:
    """A-Q4: patients and share of all persons per non-primary, mapped condition."""
    facts = _by_person(cdm, cdm.condition_occurrence.where(
        ~F.col("condition_concept_id").isin(list(PRIMARY_DIAGNOSIS_CONCEPTS))
        & (F.col("condition_concept_id") != 0)).select("person_id", "condition_concept_id")).distinct()
    dim = cdm.concept.select("concept_id", "concept_name")
    joined = lookup_join(facts, dim, facts["condition_concept_id"] == dim["concept_id"])
    n = F.count_distinct("person_id")
    total = total_persons(cdm.person)
    return (joined.groupBy(F.col("concept_name").alias("comorbidity"))
                  .agg(n.alias("n_patients"), pct(n, total).alias("pct"))
                  .orderBy(F.desc("n_patients"), "comorbidity"))


def q5_chelation_without_transfusion(cdm: Cdm) -> DataFrame:
    """A-Q5: persons with a chelation procedure whose transfusion answer is 'No' (semi join)."""
    chel = cdm.procedure_occurrence.where(F.col("procedure_concept_id") == CHELATION_CONCEPT).select("person_id")
    no_tx = cdm.observation.where((F.col("observation_concept_id") == TRANSFUSION_CONCEPT)
                                  & (F.col("value_source_value") == "No")).select("person_id")
    return _by_person(cdm, chel).join(_by_person(cdm, no_tx), "person_id", "left_semi").agg(
        F.count_distinct("person_id").alias("n_chelation_no_transfusion"))


def q6_measurement_completeness(cdm: Cdm) -> DataFrame:
    """A-Q6: persons with a value per measurement label, missing persons and % complete.

    Label = concept name, or the source value when the concept has no (or an empty) name.
    """
    facts = _by_person(cdm, cdm.measurement.where(F.col("value_as_number").isNotNull()).select(
        "person_id", "measurement_concept_id", "value_source_value")).distinct()
    dim = cdm.concept.select("concept_id", "concept_name")
    joined = lookup_join(facts, dim, facts["measurement_concept_id"] == dim["concept_id"], how="left")
    label = F.coalesce(blank_to_null("concept_name"), F.col("value_source_value"))
    n = F.count_distinct("person_id")
    total = total_persons(cdm.person)
    return (joined.groupBy(label.alias("measurement"))
                  .agg(n.alias("n_with_value"), (total - n).alias("n_missing"), pct(n, total).alias("pct_complete"))
                  .orderBy(F.desc("n_with_value"), "measurement"))


def labelled_counts(frames: dict[str, DataFrame], label: str = "table_name", count: str = "row_count") -> DataFrame:
    """UNION ALL of one ``(label, COUNT(*))`` row per frame, sorted by label (O-SET1)."""
    parts = [df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy(label)


def overview_counts(cdm: Cdm) -> DataFrame:
    """A-OVW: row counts of the eight clinical tables."""
    return labelled_counts({t: getattr(cdm, t) for t in OVERVIEW_TABLES})


def verify_condition(cdm: Cdm) -> DataFrame:
    """A-V1: rows per (condition concept, source value)."""
    return (cdm.condition_occurrence.groupBy("condition_concept_id", "condition_source_value")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "condition_concept_id", "condition_source_value"))


def verify_measurement(cdm: Cdm) -> DataFrame:
    """A-V2: rows per (source value, concept, unit)."""
    return (cdm.measurement.groupBy("value_source_value", "measurement_concept_id", "unit_concept_id")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "measurement_concept_id", "value_source_value"))


def verify_procedure(cdm: Cdm) -> DataFrame:
    """A-V3: rows per (source value, procedure concept)."""
    return (cdm.procedure_occurrence.groupBy("procedure_source_value", "procedure_concept_id")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "procedure_concept_id"))


def verify_observation(cdm: Cdm) -> DataFrame:
    """A-V4: observation row count."""
    return cdm.observation.agg(F.count(F.lit(1)).alias("observation_rows"))


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """A-PRE: ``SELECT * ... LIMIT n`` with a deterministic order (top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def catalog_counts(spark: SparkSession, database: str | list[str] | None = None) -> DataFrame:
    """A-CAT / O-SET2 / O-FLT7: row count of every base table, sorted by (schema, table).

    ``database``: one database, a list, or None for every database of the catalog (the
    reference counts every user schema). Views are skipped; temporary views count only in
    the global temporary database. The table list is catalog metadata (bounded); each count
    is its own small aggregate, unioned into one result.
    """
    if database is None:
        dbs = [d.name for d in spark.catalog.listDatabases()]
    else:
        dbs = [database] if isinstance(database, str) else list(database)
    frames, schema_of = {}, {}
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if t.namespace and t.namespace[-1] == db and t.tableType in ("MANAGED", "EXTERNAL", "TEMPORARY"):
                label = f"{db}.{t.name}"
                frames[label] = spark.table(f"`{db}`.`{t.name}`")
                schema_of[label] = db
    if not frames:
        return spark.createDataFrame([], "table_schema string, table_name string, row_count long")
    counts = labelled_counts(frames, label="_label")
    return counts.select(
        F.substring_index("_label", ".", 1).alias("table_schema"),
        F.expr("substring(_label, length(substring_index(_label, '.', 1)) + 2)").alias("table_name"),
        "row_count").orderBy("table_schema", "table_name")
