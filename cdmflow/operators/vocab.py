"""Vocabulary operators: source -> standard mapping, hierarchy roll-up through the
pre-computed ancestor closure, and the standard / validity / domain / specificity checks.

Every fact side is pre-aggregated to (concept, ...) before it meets the vocabulary, and is
evaluated once: the vocabulary side is joined as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import lookup_join


def _at(at: str | Column | None) -> Column:
    if at is None:
        return F.current_date()
    return F.lit(at).cast("date") if isinstance(at, str) else at


def maps_to(relationship: DataFrame, at: str | Column | None = None) -> DataFrame:
    """Valid 'Maps to' pairs ``(_src, _std)`` at date ``at``."""
    d = _at(at)
    ok = ((F.col("relationship_id") == "Maps to")
          & (F.coalesce(F.col("invalid_reason"), F.lit("")) == "")
          & (F.coalesce(F.col("valid_start_date"), F.lit("1900-01-01").cast("date")) <= d)
          & (F.coalesce(F.col("valid_end_date"), F.lit("2999-12-31").cast("date")) >= d))
    return relationship.where(ok).select(F.col("concept_id_1").alias("_src"), F.col("concept_id_2").alias("_std"))


def map_to_standard(facts: DataFrame, source_col: str, relationship: DataFrame, at: str | Column | None = None,
                    out: str = "standard_concept_id") -> DataFrame:
    """T-MAP1/T-MAP2: attach the standard concept of ``source_col``; no valid mapping -> 0.

    A source with several valid targets yields one row per target, as the SQL join would.
    """
    pairs = maps_to(relationship, at)
    joined = lookup_join(facts, pairs, facts[source_col] == pairs["_src"], how="left")
    return joined.withColumn(out, F.coalesce(F.col("_std"), F.lit(0)).cast("int")).drop("_src", "_std")


def descendant_rollup(facts: DataFrame, concept_col: str, person_col: str, ancestor: DataFrame,
                      ancestors: DataFrame) -> DataFrame:
    """T-VOC1: records and distinct persons under each concept of ``ancestors`` (any depth, itself included).

    ``ancestors`` holds the wanted ancestor ids in ``concept_id``. Facts are first reduced to
    (concept, person, rows), so one busy concept or person cannot flood the closure join.
    """
    pre = facts.groupBy(F.col(concept_col).alias("_c"), F.col(person_col).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    closure = ancestor.join(ancestors.select(F.col("concept_id").alias("ancestor_concept_id")),
                            "ancestor_concept_id", "left_semi")
    closure = closure.select("ancestor_concept_id", "descendant_concept_id")
    joined = lookup_join(pre, closure, pre["_c"] == closure["descendant_concept_id"])
    return joined.groupBy("ancestor_concept_id").agg(F.sum("_n").alias("n_records"),
                                                     F.count_distinct("_p").alias("n_persons"))


def non_standard_use(facts: DataFrame, concept_col: str, concept: DataFrame) -> DataFrame:
    """T-VOC2: mapped concepts (not 0) that are not standard -> (concept_id, concept_name, standard_concept, n)."""
    used = facts.where(F.col(concept_col) != 0).groupBy(F.col(concept_col).alias("concept_id")).agg(
        F.count(F.lit(1)).alias("n"))
    dim = concept.select("concept_id", "concept_name", "standard_concept")
    joined = lookup_join(used, dim, "concept_id", how="left")
    return joined.where(F.coalesce(F.col("standard_concept"), F.lit("")) != "S").select(
        "concept_id", "concept_name", "standard_concept", "n")


def expired_use(facts: DataFrame, concept_col: str, date_col: str, concept: DataFrame) -> DataFrame:
    """T-VOC3: records whose concept was not valid on the record's date -> (concept_id, n)."""
    used = facts.where(F.col(concept_col) != 0).groupBy(
        F.col(concept_col).alias("concept_id"), F.col(date_col).cast("date").alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"))
    dim = concept.select("concept_id", "valid_start_date", "valid_end_date")
    joined = lookup_join(used, dim, "concept_id")
    bad = (F.col("_d") > F.col("valid_end_date")) | (F.col("_d") < F.col("valid_start_date"))
    return joined.where(bad).groupBy("concept_id").agg(F.sum("_n").alias("n"))


def domain_mismatch(facts: DataFrame, concept_col: str, concept: DataFrame, expected_domain: str) -> DataFrame:
    """T-VOC4: mapped concepts whose domain is not the table's -> (concept_id, domain_id, n)."""
    used = facts.where(F.col(concept_col) != 0).groupBy(F.col(concept_col).alias("concept_id")).agg(
        F.count(F.lit(1)).alias("n"))
    dim = concept.select("concept_id", "domain_id")
    joined = lookup_join(used, dim, "concept_id", how="left")
    return joined.where(~F.coalesce(F.col("domain_id") == expected_domain, F.lit(False))).select(
        "concept_id", "domain_id", "n")


def less_specific_use(facts: DataFrame, concept_col: str, ancestor: DataFrame) -> DataFrame:
    """T-VOC5: used concepts that have a *used* descendant (a more specific code was available)."""
    used = facts.select(F.col(concept_col).alias("c")).distinct()
    pairs = ancestor.where(F.col("min_levels_of_separation") >= 1).select(
        "ancestor_concept_id", "descendant_concept_id")
    pairs = pairs.join(used.withColumnRenamed("c", "ancestor_concept_id"), "ancestor_concept_id", "left_semi")
    pairs = pairs.join(used.withColumnRenamed("c", "descendant_concept_id"), "descendant_concept_id", "left_semi")
    return pairs.groupBy(F.col("ancestor_concept_id").alias("concept_id")).agg(
        F.count(F.lit(1)).alias("n_more_specific_used"))


def closure_from_levels(edges: Sequence[DataFrame]) -> DataFrame:
    """Ancestor closure of a fixed-depth hierarchy given parent->child edge frames per level.

    ``edges[i]`` has (parent, child) from level i to level i + 1. Every node gets a level-0
    self row; paths are composed by joins (no recursion: the depth is known).
    """
    out = []
    nodes = None
    for e in edges:
        cur = e.select("parent").union(e.select(F.col("child").alias("parent"))).distinct()
        nodes = cur if nodes is None else nodes.union(cur).distinct()
    out.append(nodes.select(F.col("parent").alias("ancestor_concept_id"),
                            F.col("parent").alias("descendant_concept_id"), F.lit(0).alias("lvl")))
    paths = None
    for e in edges:
        step = e.select(F.col("parent").alias("ancestor_concept_id"), F.col("child").alias("descendant_concept_id"),
                        F.lit(1).alias("lvl"))
        if paths is not None:
            longer = paths.join(e, paths["descendant_concept_id"] == e["parent"]).select(
                paths["ancestor_concept_id"], F.col("child").alias("descendant_concept_id"),
                (paths["lvl"] + 1).alias("lvl"))
            step = step.unionByName(longer)
        paths = step if paths is None else paths.unionByName(step)
        out.append(step)
    closure = out[0]
    for part in out[1:]:
        closure = closure.unionByName(part)
    return closure.groupBy("ancestor_concept_id", "descendant_concept_id").agg(
        F.min("lvl").cast("int").alias("min_levels_of_separation"),
        F.max("lvl").cast("int").alias("max_levels_of_separation"))
