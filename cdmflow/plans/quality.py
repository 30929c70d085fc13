"""The quality report over a loaded CDM (checks taught with the ETL, run as Spark jobs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from .etl import EVENT_ID, Cdm, staged

EVENT_CONCEPT_SOURCE = {
    "condition_occurrence": ("condition_concept_id", "condition_source_value"),
    "observation": ("observation_concept_id", "value_source_value"),
    "measurement": ("measurement_concept_id", "value_source_value"),
    "procedure_occurrence": ("procedure_concept_id", "procedure_source_value"),
}
MANDATORY = {
    "person": ("person_id", "gender_concept_id", "race_concept_id", "ethnicity_concept_id"),
    "condition_occurrence": ("condition_occurrence_id", "person_id", "condition_concept_id",
                             "condition_start_date", "condition_type_concept_id"),
    "observation": ("observation_id", "person_id", "observation_concept_id", "observation_date",
                    "observation_type_concept_id"),
    "measurement": ("measurement_id", "person_id", "measurement_concept_id", "measurement_date",
                    "measurement_type_concept_id"),
    "procedure_occurrence": ("procedure_occurrence_id", "person_id", "procedure_concept_id", "procedure_date",
                             "procedure_type_concept_id"),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dq_unmapped(cdm: Cdm) -> DataFrame:
    """T-DQ2 over the four event tables: (table_name, source_value, n) where concept = 0."""
    return _union([
        Q.unmapped_values(getattr(cdm, t), c, s).select(F.lit(t).alias("table_name"), "source_value", "n")
        for t, (c, s) in EVENT_CONCEPT_SOURCE.items()
    ]).orderBy("table_name", F.desc("n"), "source_value")


def dq_coverage(cdm: Cdm) -> DataFrame:
    """T-DQ3: persons represented per event table."""
    return _union([
        Q.person_coverage(getattr(cdm, t), cdm.person).select(F.lit(t).alias("table_name"), "*")
        for t in EVENT_CONCEPT_SOURCE
    ]).orderBy("table_name")


def dq_orphans(cdm: Cdm) -> DataFrame:
    """T-DQ4 / T-JN7: event rows without their person or visit.

    Each event table is reduced once to (person, visit, rows); both anti joins run on that
    smaller frame, so the events are shuffled once, not once per parent.
    """
    frames = []
    for t in EVENT_CONCEPT_SOURCE:
        pairs = getattr(cdm, t).groupBy("person_id", "visit_occurrence_id").agg(F.count(F.lit(1)).alias("_n"))
        frames.append(pairs.sparkSession.range(1).select(
            F.lit(t).alias("table_name"),
            Q.orphan_rows(pairs, cdm.person, "person_id", weight="_n").alias("orphan_person_rows"),
            Q.orphan_rows(pairs, cdm.visit_occurrence, "visit_occurrence_id", weight="_n")
             .alias("orphan_visit_rows")))
    return _union(frames).orderBy("table_name")


def dq_duplicate_ids(cdm: Cdm) -> DataFrame:
    """T-DQ5: surrogate ids used more than once, per table (0 after an idempotent load)."""
    ids = {"person": "person_id", **EVENT_ID}
    return _union([
        Q.duplicate_keys(getattr(cdm, t), [k]).agg(F.count(F.lit(1)).alias("duplicate_ids"))
         .select(F.lit(t).alias("table_name"), "duplicate_ids")
        for t, k in ids.items()
    ]).orderBy("table_name")


def dq_mandatory_nulls(cdm: Cdm) -> DataFrame:
    """T-DQ7: NULLs in mandatory columns, one pass per table."""
    return _union([
        Q.null_counts(getattr(cdm, t), cols).select(F.lit(t).alias("table_name"), "column_name", "n_null")
        for t, cols in MANDATORY.items()
    ]).orderBy("table_name", "column_name")


def quality_report(cdm: Cdm) -> DataFrame:
    """All CDM checks as (check, table_name, item, value) rows; every table is read once.

    T-DQ1..5, 7 of an event table come from one labelled frame: a row is reduced to (id, person, visit, source value
    where unmapped, NULL flags) and counted by (table, id) for repeated ids, by (table, person, visit) for coverage and
    orphans and by (table, source value) in one shuffle of partial sums, which is staged. The parents join those
    counts, never the events.
    """
    frames = []
    for t, (concept, source) in EVENT_CONCEPT_SOURCE.items():
        nulls = F.array(*[F.col(c).isNull().cast("long") for c in MANDATORY[t]])
        frames.append(getattr(cdm, t).select(
            F.lit(t).alias("table_name"), F.col(EVENT_ID[t]).alias("id"), "person_id", "visit_occurrence_id",
            (F.col(concept) == 0).alias("unmapped"), F.when(F.col(concept) == 0, F.col(source)).alias("source_value"),
            nulls.alias("nulls")))
    most = max(map(len, MANDATORY.values()))
    rows = _union(frames)
    # one row per event, spread over three groupings: id | person and visit | source value
    kinds = F.array(
        F.struct(F.lit("id").alias("kind"), F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("string").alias("c")),
        F.struct(F.lit("place").alias("kind"), F.col("person_id").alias("a"), F.col("visit_occurrence_id").alias("b"), F.lit(None).cast("string").alias("c")),
        F.struct(F.when(F.col("unmapped"), F.lit("unmapped")).otherwise(F.lit("mapped")).alias("kind"), F.lit(None).cast("long").alias("a"),
                 F.lit(None).cast("long").alias("b"), F.col("source_value").alias("c")))
    spread = rows.select("table_name", "nulls", F.inline(kinds))
    flags = [F.sum(F.when(F.col("kind").isin("mapped", "unmapped"), F.get("nulls", F.lit(i)))).alias(f"_n{i}") for i in range(most)]
    grouped = staged(spread.groupBy("table_name", "kind", "a", "b", "c").agg(F.count(F.lit(1)).alias("n"), *flags), "quality-groups")
    item = lambda check, name, value: (F.lit(check).alias("check"), "table_name", name.alias("item"), value.cast("long").alias("value"))

    unmapped = grouped.where("kind = 'unmapped'").select(*item("unmapped", F.col("c"), F.col("n")))
    places = grouped.where("kind = 'place'")
    tables = places.sparkSession.createDataFrame([(t,) for t in EVENT_CONCEPT_SOURCE], "table_name string")
    filled = lambda df, *cols: F.broadcast(tables).join(df, "table_name", "left").na.fill(0, list(cols))
    coverage = filled(places.groupBy("table_name").agg(F.count_distinct("a").alias("v")), "v").select(
        *item("coverage", F.lit("n_persons"), F.col("v")))
    orphans = []
    for name, column, parent, key in (("person", "a", cdm.person, "person_id"), ("visit", "b", cdm.visit_occurrence, "visit_occurrence_id")):
        found = places.groupBy("table_name", F.col(column).alias(key)).agg(F.sum("n").alias("n")).join(parent.select(key), key, "left_anti")
        orphans.append(filled(found.groupBy("table_name").agg(F.sum("n").alias("v")), "v").select(*item("orphans", F.lit(name), F.col("v"))))
    twice = grouped.where("kind = 'id' AND n > 1").groupBy("table_name").agg(F.count(F.lit(1)).alias("v"))
    duplicates = filled(twice, "v").select(*item("duplicate_ids", F.lit("id"), F.col("v")))
    sums = grouped.where("kind IN ('mapped', 'unmapped')").groupBy("table_name").agg(
        *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(most)])
    named = F.create_map(*[x for t in EVENT_CONCEPT_SOURCE for x in (F.lit(t), F.array(*map(F.lit, MANDATORY[t])))])
    cells = F.array(*[F.struct(F.get(named[F.col("table_name")], F.lit(i)).alias("column_name"), F.col(f"_n{i}").alias("v")) for i in range(most)])
    nulls = filled(sums, *[f"_n{i}" for i in range(most)]).select("table_name", F.inline(cells)).where("column_name IS NOT NULL").select(
        *item("mandatory_nulls", F.col("column_name"), F.col("v")))

    # the person table: repeated ids and NULLs in one aggregation by id
    cols = MANDATORY["person"]
    per_id = cdm.person.groupBy("person_id").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    person = per_id.agg(F.count_if(F.col("n") > 1).alias("twice"), *[
        F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_n{i}") for i in range(len(cols))])
    checks = F.array(F.struct(F.lit("duplicate_ids").alias("check"), F.lit("id").alias("item"), F.col("twice").alias("value")), *[
        F.struct(F.lit("mandatory_nulls").alias("check"), F.lit(c).alias("item"), F.col(f"_n{i}").alias("value")) for i, c in enumerate(cols)])
    persons = person.select(F.lit("person").alias("table_name"), F.inline(checks)).select("check", "table_name", "item", "value")
    return _union([unmapped, coverage, *orphans, duplicates, nulls, persons])
