"""Stand-in vocabulary inputs, derived by Spark from the driver tables.

The real vocabulary files are not available; these frames have the vocabulary's shape
and grow with the driver data:

* geography concepts: regions (1000 + r), nations (2000 + n), customers (1000000 + c);
  region 4 is non-standard, region 3 expired on 1995-06-30, nations are source concepts;
* 'Maps to' relationships nation -> region (nation 24's mapping is deprecated);
* the ancestor closure region -> nation -> customer;
* a CONCEPT file in vocabulary text form written from ``part`` (upper-case headers,
  ``YYYYMMDD`` dates with impossible days, empty names, a ``None`` name, a lone quote).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..operators.vocab import closure_from_levels
from ..session import stage_path

REGION_BASE, NATION_BASE, CUSTOMER_BASE = 1000, 2000, 1000000
NON_STANDARD_REGION, EXPIRED_REGION, DEPRECATED_NATION = 4, 3, 24
EXPIRED_ON = "1995-06-30"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def geo_concepts(spark: SparkSession, sf: str) -> DataFrame:
    start, end = F.lit("1970-01-01").cast("date"), F.lit("2099-12-31").cast("date")
    r = _t(spark, sf, "region").select(
        (F.lit(REGION_BASE) + F.col("r_regionkey")).cast("int").alias("concept_id"),
        F.col("r_name").alias("concept_name"), F.lit("Geography").alias("domain_id"),
        F.lit("Region").alias("vocabulary_id"), F.lit("Region").alias("concept_class_id"),
        F.when(F.col("r_regionkey") != NON_STANDARD_REGION, F.lit("S")).alias("standard_concept"),
        F.col("r_regionkey").cast("string").alias("concept_code"), start.alias("valid_start_date"),
        F.when(F.col("r_regionkey") == EXPIRED_REGION, F.lit(EXPIRED_ON).cast("date")).otherwise(end)
         .alias("valid_end_date"),
        F.lit(None).cast("string").alias("invalid_reason"))
    n = _t(spark, sf, "nation").select(
        (F.lit(NATION_BASE) + F.col("n_nationkey")).cast("int").alias("concept_id"),
        F.col("n_name").alias("concept_name"), F.lit("Geography").alias("domain_id"),
        F.lit("Nation").alias("vocabulary_id"), F.lit("Nation").alias("concept_class_id"),
        F.lit(None).cast("string").alias("standard_concept"), F.col("n_nationkey").cast("string").alias("concept_code"),
        start.alias("valid_start_date"), end.alias("valid_end_date"), F.lit(None).cast("string").alias("invalid_reason"))
    c = _t(spark, sf, "customer").select(
        (F.lit(CUSTOMER_BASE) + F.col("c_custkey")).cast("int").alias("concept_id"),
        F.col("c_name").alias("concept_name"), F.lit("Person").alias("domain_id"),
        F.lit("Customer").alias("vocabulary_id"), F.lit("Customer").alias("concept_class_id"),
        F.lit("S").alias("standard_concept"), F.col("c_custkey").cast("string").alias("concept_code"),
        start.alias("valid_start_date"), end.alias("valid_end_date"), F.lit(None).cast("string").alias("invalid_reason"))
    return r.unionByName(n).unionByName(c)


def geo_relationships(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation")
    deprecated = F.col("n_nationkey") == DEPRECATED_NATION
    return n.select(
        (F.lit(NATION_BASE) + F.col("n_nationkey")).cast("int").alias("concept_id_1"),
        (F.lit(REGION_BASE) + F.col("n_regionkey")).cast("int").alias("concept_id_2"),
        F.lit("Maps to").alias("relationship_id"),
        F.lit("1970-01-01").cast("date").alias("valid_start_date"),
        F.when(deprecated, F.lit("2020-01-01").cast("date")).otherwise(F.lit("2099-12-31").cast("date"))
         .alias("valid_end_date"),
        F.when(deprecated, F.lit("D")).alias("invalid_reason"))


def geo_ancestors(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation")
    c = _t(spark, sf, "customer")
    region_nation = n.select((F.lit(REGION_BASE) + F.col("n_regionkey")).cast("int").alias("parent"),
                             (F.lit(NATION_BASE) + F.col("n_nationkey")).cast("int").alias("child"))
    nation_customer = c.select((F.lit(NATION_BASE) + F.col("c_nationkey")).cast("int").alias("parent"),
                               (F.lit(CUSTOMER_BASE) + F.col("c_custkey")).cast("int").alias("child"))
    return closure_from_levels([region_nation, nation_customer])


def customer_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation as source concept and the person key."""
    return _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("person_id"),
        (F.lit(NATION_BASE) + F.col("c_nationkey")).cast("int").alias("source_concept_id"),
        F.col("c_nationkey"), F.col("c_acctbal"))


def order_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as facts: (person_id, concept_id = the customer's concept, event date)."""
    return _t(spark, sf, "orders").select(
        F.col("o_custkey").alias("person_id"),
        (F.lit(CUSTOMER_BASE) + F.col("o_custkey")).cast("int").alias("concept_id"),
        F.col("o_orderdate").cast("date").alias("event_date"))


def order_facts_mapped(spark: SparkSession, sf: str, relationship: DataFrame) -> DataFrame:
    """Orders coded with the customer's nation, mapped to the standard (region) concept at the order date."""
    from ..operators.vocab import map_to_standard  # local: avoids a cycle at import time

    cust = customer_codes(spark, sf).select("person_id", "source_concept_id")
    orders = _t(spark, sf, "orders").select(F.col("o_custkey").alias("person_id"),
                                            F.col("o_orderdate").cast("date").alias("event_date"))
    facts = orders.join(cust, "person_id")
    return map_to_standard(facts, "source_concept_id", relationship, at="2026-05-12")


# Vocabulary text derived from part: expressions valid in Spark SQL and DuckDB alike.
PART_CONCEPT_TEXT = {
    "CONCEPT_ID": "CAST(p_partkey AS STRING)",
    "CONCEPT_NAME": "CASE WHEN p_partkey % 50 = 7 THEN NULL WHEN p_partkey % 50 = 8 THEN 'None' "
                    "WHEN p_partkey % 50 = 9 THEN p_name || ' 12\" blade' ELSE p_name END",
    "DOMAIN_ID": "'Device'",
    "VOCABULARY_ID": "'PART'",
    "CONCEPT_CLASS_ID": "p_type",
    "STANDARD_CONCEPT": "CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'S' END",
    "CONCEPT_CODE": "p_brand",
    "VALID_START_DATE": "CAST(20000101 + p_size AS STRING)",
    "VALID_END_DATE": "'20991231'",
    "INVALID_REASON": "CAST(NULL AS STRING)",
}


def write_part_concept_file(spark: SparkSession, sf: str) -> str:
    """Write ``CONCEPT.csv`` (tab-separated, header, no quoting) from ``part``; returns the folder."""
    part = _t(spark, sf, "part")
    text = part.select(*[F.expr(e).cast("string").alias(c) for c, e in PART_CONCEPT_TEXT.items()])
    folder = stage_path(spark, "vocab")
    (text.write.option("sep", "\t").option("header", True).option("quote", "")
         .option("emptyValue", "").option("nullValue", "").csv(os.path.join(folder, "CONCEPT.csv")))
    return folder


def used_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers coded at two levels: nation when the balance is positive, region otherwise."""
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    j = lookup_join(c, n, c["c_nationkey"] == n["n_nationkey"])
    return j.select(F.col("c_custkey").alias("person_id"),
                    F.when(F.col("c_acctbal") < 0, F.lit(REGION_BASE) + F.col("n_regionkey"))
                     .otherwise(F.lit(NATION_BASE) + F.col("c_nationkey")).cast("int").alias("concept_id"))


# The other eight vocabulary files as text (file: table it derives from, column expressions), with impossible dates,
# numbers that do not parse, missing names and a lone quote; expressions valid in Spark SQL and DuckDB alike.
VOCABULARY_TEXT: dict[str, tuple[str, dict[str, str]]] = {
    "CONCEPT_RELATIONSHIP.csv": ("nation", {
        "CONCEPT_ID_1": "2000 + n_nationkey", "CONCEPT_ID_2": "1000 + n_regionkey", "RELATIONSHIP_ID": "'Maps to'",
        "VALID_START_DATE": "'19700101'", "VALID_END_DATE": "CASE WHEN n_nationkey % 5 = 3 THEN '20001301' ELSE '20991231' END",
        "INVALID_REASON": "CASE WHEN n_nationkey = 24 THEN 'D' END"}),
    "CONCEPT_ANCESTOR.csv": ("customer", {
        "ANCESTOR_CONCEPT_ID": "2000 + c_nationkey", "DESCENDANT_CONCEPT_ID": "1000000 + c_custkey",
        "MIN_LEVELS_OF_SEPARATION": "1", "MAX_LEVELS_OF_SEPARATION": "CASE WHEN c_custkey % 7 = 0 THEN 'two' ELSE '2' END"}),
    "CONCEPT_SYNONYM.csv": ("customer", {
        "CONCEPT_ID": "1000000 + c_custkey", "LANGUAGE_CONCEPT_ID": "4180186",
        "CONCEPT_SYNONYM_NAME": "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN c_name || ' \"' ELSE c_name END"}),
    "CONCEPT_CLASS.csv": ("part", {
        "CONCEPT_CLASS_ID": "p_brand", "CONCEPT_CLASS_NAME": "p_type", "CONCEPT_CLASS_CONCEPT_ID": "p_partkey"}),
    "DOMAIN.csv": ("region", {"DOMAIN_ID": "r_name", "DOMAIN_NAME": "lower(r_name)", "DOMAIN_CONCEPT_ID": "1000 + r_regionkey"}),
    "DRUG_STRENGTH.csv": ("part", {
        "DRUG_CONCEPT_ID": "p_partkey", "INGREDIENT_CONCEPT_ID": "p_size",
        "AMOUNT_VALUE": "CASE WHEN p_size % 4 = 0 THEN 'n/a' WHEN p_size % 4 = 1 THEN NULL ELSE CAST(p_size AS STRING) || '.5' END",
        "VALID_START_DATE": "CAST(20000101 + p_size AS STRING)", "VALID_END_DATE": "'20991231'",
        "INVALID_REASON": "CASE WHEN p_size > 40 THEN 'U' END"}),
    "RELATIONSHIP.csv": ("nation", {
        "RELATIONSHIP_ID": "n_name", "RELATIONSHIP_NAME": "n_name || ' of'", "IS_HIERARCHICAL": "'1'", "DEFINES_ANCESTRY": "'0'",
        "REVERSE_RELATIONSHIP_ID": "NULL", "RELATIONSHIP_CONCEPT_ID": "2000 + n_nationkey"}),
    "VOCABULARY.csv": ("region", {
        "VOCABULARY_ID": "r_name", "VOCABULARY_NAME": "r_name || ' names'", "VOCABULARY_CONCEPT_ID": "1000 + r_regionkey",
        "VOCABULARY_REFERENCE": "NULL", "VOCABULARY_VERSION": "'v1'"}),
}


def write_vocabulary_files(spark: SparkSession, sf: str) -> str:
    """Write the files of ``VOCABULARY_TEXT`` (tab-separated, header, no quoting); returns the folder."""
    folder = stage_path(spark, "vocabulary")
    for name, (source, columns) in VOCABULARY_TEXT.items():
        text = _t(spark, sf, source).select(*[F.expr(e).cast("string").alias(c) for c, e in columns.items()])
        (text.write.option("sep", "\t").option("header", True).option("quote", "")
             .option("emptyValue", "").option("nullValue", "").csv(os.path.join(folder, name)))
    return folder
