"""Estimates over very many rows from sketches that are kept per batch and merged (O-AGG3, O-AGG5).

A batch of rows is read once, when it is loaded: its distinct patients per diagnosis become HyperLogLog sketches, its
ferritin values per sex KLL sketches (a few kilobytes a group, whatever the batch holds). A question merges the stored
sketches and reads no rows again. The relative standard error of a count is about 0.83 / sqrt(2 ** HLL_BITS) (1.3 % at
12 bits); the rank error of a median is about 1 % at KLL_K 400 (its two-sided 99 % bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import FERRITIN_CONCEPT, PRIMARY_DIAGNOSIS_CONCEPTS
from ..sources import sinks
from .etl import Cdm

HLL_BITS = 12
KLL_K = 400
SKETCHES = "sketches"


def batch_sketches(cdm: Cdm) -> DataFrame:
    """(kind, name, n, sketch) of one batch: patients per diagnosis concept, ferritin values per sex."""
    patients = cdm.condition_occurrence.where(F.col("condition_concept_id").isin(list(PRIMARY_DIAGNOSIS_CONCEPTS))).groupBy(
        F.col("condition_concept_id").cast("string").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("person_id", F.lit(HLL_BITS)).alias("sketch"))
    values = cdm.measurement.where((F.col("measurement_concept_id") == FERRITIN_CONCEPT) & F.col("value_as_number").isNotNull())
    ferritin = values.join(cdm.person.select("person_id", F.col("gender_source_value").alias("name")), "person_id").groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value_as_number", F.lit(KLL_K)).alias("sketch"))
    return patients.select(F.lit("patients").alias("kind"), "*").unionByName(ferritin.select(F.lit("ferritin").alias("kind"), "*"))


def store_sketches(added: Cdm, root: str, batch: str) -> None:
    """Keep the sketches of the rows that ``batch`` added; a batch that the ledger has is left as it is."""
    sinks.write_tables({SKETCHES: batch_sketches(added)}, root, "append", schema="estimates", batch=batch)


def estimates(spark: SparkSession, root: str) -> DataFrame:
    """(kind, name, n, estimate) over all batches: distinct patients per diagnosis, median ferritin per sex."""
    stored = sinks.read_table(spark, root, SKETCHES, "estimates")
    patients = stored.where("kind = 'patients'").groupBy("kind", "name").agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("double").alias("estimate"))
    medians = stored.where("kind = 'ferritin'").groupBy("kind", "name").agg(
        F.sum("n").alias("n"), F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("sketch"), F.lit(0.5)).alias("estimate"))
    return patients.unionByName(medians)
