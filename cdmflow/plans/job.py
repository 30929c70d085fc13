"""End-to-end batch job: stage the registry files, load the CDM, write the tables, report.

    python -m cdmflow.plans.job --data <folder with patients.csv, dictionary.csv, ...> --out <root>
                                [--vocab <folder with CONCEPT.csv, ...>] [--source-name NAME]

Order (L-ALL): staging (L-STG) -> vocabulary (L-VOC) -> cdm_source (L-SRC) -> person,
period, visit -> event tables -> overview counts and quality report.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import bad_dates, bad_numbers
from ..operators.rules import RULE_SCHEMA, RULES, rule_frame, rules_from_frame
from ..sources import sinks
from ..sources.dictionary import read_dictionary, variables_from_frame
from ..sources.registry import NUMERIC_FIELDS, read_registry_text, type_registry
from ..sources.vocabulary import load_vocabulary, seed_concepts
from .analytics import overview_counts
from .etl import cdm_source, run_etl
from .quality import quality_report
from ..session import path_exists


def stage_registry_files(spark: SparkSession, data_dir: str, out_root: str) -> dict[str, DataFrame]:
    """L-STG: dictionary, mapping sheet and patient export -> ``import`` tables (replaced on every run).

    A missing file is reported and skipped (O-SRC6). The mapping sheet is read as CSV
    (``omop_mappings.csv``); without it the built-in rule table is staged instead. The load then follows the staged
    sheet (``rules_from_frame``); a sheet without any column of the rule table is kept for reference only.
    """
    staged: dict[str, DataFrame] = {}
    dict_path = os.path.join(data_dir, "dictionary.csv")
    labels = None
    if path_exists(spark, dict_path):
        dictionary = read_dictionary(spark, dict_path)
        staged["dictionary"] = sinks.write_table(dictionary, out_root, "dictionary", "overwrite", schema="import")
        labels = variables_from_frame(staged["dictionary"])
    else:
        print("WARNING: dictionary.csv not found, skipping", file=sys.stderr)
    map_path = os.path.join(data_dir, "omop_mappings.csv")
    mappings = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(map_path)
                if path_exists(spark, map_path) else rule_frame(spark))
    staged["mappings"] = sinks.write_table(mappings, out_root, "mappings", "overwrite", schema="import")
    reg_path = os.path.join(data_dir, "patients.csv")
    if path_exists(spark, reg_path):
        text = read_registry_text(spark, reg_path, labels)
        staged["quarantine"] = sinks.write_table(unparsed_values(text), out_root, "unparsed_values", "overwrite",
                                                 schema="quarantine")
        staged["labels"] = sinks.write_table(type_registry(text), out_root, "labels", "overwrite", schema="import")
    else:
        print("WARNING: patients.csv not found, skipping", file=sys.stderr)
    return staged


def states_rules(mappings: DataFrame) -> bool:
    """Is this a rule table, and not some other mapping sheet?"""
    return not set(RULE_SCHEMA.fieldNames()).isdisjoint(mappings.columns)


def unparsed_values(text: DataFrame) -> DataFrame:
    """T-DQ6: (record_id, raw_value, column_name) of every number or date that typing turns into NULL."""
    present = [c for c in NUMERIC_FIELDS if c in text.columns]
    if "record_id" not in text.columns:
        text = text.withColumn("record_id", F.lit(None).cast("string"))
    found = bad_numbers(text, present) if present else None
    if "date_of_birth" in text.columns:
        dates = bad_dates(text, "date_of_birth")
        found = found.unionByName(dates) if found is not None else dates
    if found is None:
        found = text.select("record_id", F.lit("").alias("raw_value"), F.lit("").alias("column_name")).limit(0)
    return found


def run_job(spark: SparkSession, data_dir: str, out_root: str, vocab_dir: str | None = None,
            source_name: str = "registry") -> dict[str, DataFrame]:
    staged = stage_registry_files(spark, data_dir, out_root)
    if "labels" not in staged:
        raise FileNotFoundError(f"no patients.csv in {data_dir}")
    vocab = load_vocabulary(spark, vocab_dir, out_root=os.path.join(out_root, "omop"), mode="overwrite") \
        if vocab_dir else {}
    concept = vocab["concept"] if "concept" in vocab else seed_concepts(spark)
    sinks.write_table(cdm_source(spark, source_name), out_root, "cdm_source")
    rules = rules_from_frame(staged["mappings"], staged["labels"].columns) if states_rules(staged["mappings"]) else RULES
    loaded = run_etl(staged["labels"], concept=concept, file_position=True, rules=rules)
    refused = sinks.write_table(loaded.refused, out_root, "refused_records", schema="quarantine")
    cdm = sinks.write_cdm(loaded, out_root)
    quality = sinks.write_table(quality_report(cdm), out_root, "quality_report", schema="report")
    reports = {"overview": overview_counts(cdm), "quality": quality, "refused": refused}
    if "quarantine" in staged:
        reports["quarantine"] = staged["quarantine"]
    return reports


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--vocab")
    ap.add_argument("--source-name", default="registry")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cdmflow-job").getOrCreate()
    reports = run_job(spark, args.data, args.out, args.vocab, args.source_name)
    reports["overview"].show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
