"""The corpus pipeline: toxicity, SimHash near-dedup, benchmark decontamination, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the docs of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmflow.llm import decontaminate, packing, pii, simhash, toxicity
from cdmflow.llm.common import fresh, stage, table

PII_KEY = "corpus pipeline key, version 1"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The classifier learns from the labelled documents among ``docs``."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "_toxicity")
    return toxicity.score(docs, model, out_col=score).filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the least id, then the least text digest.

    Only ids and digests take part in the choice; the texts are shuffled once, by their own digest and id,
    which no group makes hot. Repeated rows of one document are copies: one stays."""
    digest = F.coalesce(F.xxhash64(F.col("text")), F.lit(0))
    found = simhash.near_duplicates(docs, keys={"digest": digest})
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    kept = (found.groupBy(group.alias("component"))
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first"))
            .select(F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest")))
    # the rows of one (id, digest) hold one text: the partial aggregation keeps one per task before the shuffle
    single = docs.groupBy(F.col("doc_id").alias("_key"), digest.alias("_d")).agg(F.first(F.struct(*docs.columns)).alias("row"))
    return (single.join(kept, single["_key"].eqNullSafe(kept["_id"]) & (single["_d"] == kept["_digest"]), "left_semi")
            .select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; ``n_chars`` follows the new text."""
    return pii.pseudonymise(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("best-fit packing", packing_stage),
]

# Trained scores, SimHash components and BPE ids have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
