"""The registry -> CDM load (person, period, visit, four event tables) as Spark jobs.

Fresh load (``run_etl``): the registry is keyed once (dense ``person_id`` in record-id
order, written under the checkpoint root). Person, period and visit are projections of
that keyed spine - one period and one visit per person, numbered in person order, so
their ids equal ``person_id`` and no join is needed. Each event table is one fan-out of its
rules over the spine (reading only those rules' columns); its ids are computed on the spine in
person-id buckets before, so no event row is shuffled or sorted, and a table that nobody reads
costs nothing.

Incremental load against stored tables (``spine_from_tables``): the reference's join
chain registry -> person (on the text key) -> visit, then the same fan-out, with ids
continuing after the stored maximum.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.keys import (id_bounds, id_bucket_width, next_key_start, rule_offsets, sized_partitions,
                              with_dense_key, with_event_ids)
from ..functions.values import parse_dmy, quoted, value_map
from ..operators.fanout import fan_out, fires
from ..operators.lookup import counted_join
from ..operators.rules import (
    ETHNICITY_CONCEPT, EVENT_TARGETS, RULES, GENDER_DEFAULT, GENDER_MAP, PERIOD_TYPE_CONCEPT, PROXY_DATE,
    RACE_CONCEPT, VISIT_CONCEPT, VISIT_TYPE_CONCEPT, Rule, rules_for,
)
from ..session import stage_path

EVENT_ID = {
    "condition_occurrence": "condition_occurrence_id",
    "observation": "observation_id",
    "measurement": "measurement_id",
    "procedure_occurrence": "procedure_occurrence_id",
}


def _date(s: str) -> Column:
    return F.lit(dt.date.fromisoformat(s))


def _conform(df: DataFrame, schema) -> DataFrame:
    """Select/cast to the fixed table schema; absent columns are NULL (INSERT column lists)."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def record_order(registry: DataFrame) -> list[Column]:
    """Numeric record ids in numeric order, text ids after them in text order."""
    rid = F.col("record_id")
    return [rid.cast("string").try_cast("long").asc_nulls_last(), rid.cast("string")]


def cdm_source(spark: SparkSession, name: str, abbreviation: str | None = None, holder: str | None = None,
               source_release_date: str = "2026-05-06", cdm_release_date: str = "2026-05-06",
               cdm_version_concept_id: int = 756265, vocabulary_version: str = "v5.0 27-FEB-25") -> DataFrame:
    """L-SRC: the one metadata row describing the source."""
    row = (name, abbreviation or name, holder or name, dt.date.fromisoformat(source_release_date),
           dt.date.fromisoformat(cdm_release_date), cdm_version_concept_id, vocabulary_version)
    return spark.createDataFrame([row], schemas.CDM_SOURCE)


def build_spine(registry: DataFrame, start: int | Column = 1, file_position: bool = False,
                unique: bool = False) -> DataFrame:
    """Registry rows with a dense ``person_id`` (O-KEY1), written once under the checkpoint root.

    ``file_position``: the registry is a direct Parquet scan (the staged import table). Any other
    frame is staged first, so duplicated registry rows are always split across sort partitions by
    their file position, and a derived registry is computed once. ``unique``: the record ids are known to be unique, as
    ``split_records`` leaves them, so no row needs a tie-break.
    """
    if not file_position:
        registry = staged(registry, "registry")
    return with_dense_key(registry, record_order(registry), "person_id", start=start, tiebreak=False, name="person-key",
                          file_position=not unique, rows=registry.count())


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the checkpoint root and read back."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MISSING_ID, REPEATED_ID, KNOWN_ID = "missing record id", "repeated record id", "record id already loaded"


def split_records(registry: DataFrame, person: DataFrame | None = None,
                  file_position: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records to load, refused records with a ``reason``); together they are all of ``registry``.

    T-DQ6 / O-JN1: a record id names one patient. Rows without an id, all rows of an id that occurs more than once
    (which of them holds is not known), and rows whose id is stored in ``person`` already are refused, in a fresh load
    and an append alike. The records to load are a Parquet scan (``file_position``: as ``registry`` is), so they can be
    keyed by file position. The ids are counted map-side; without any repeated or stored one the records are not joined,
    and a much repeated one is no hot task.
    """
    rid = F.col("record_id").cast("string")
    source = registry if file_position else staged(registry, "records")
    counts = source.where(F.col("record_id").isNotNull()).groupBy(rid.alias("_rid")).agg(F.count(F.lit(1)).alias("_times"))
    doubtful = counts.where(F.col("_times") > 1).withColumn("_why", F.lit(REPEATED_ID))
    if person is not None:
        stored = counts.where(F.col("_times") == 1).join(
            person.select(F.col("person_source_value").alias("_rid")).distinct(), "_rid")
        doubtful = doubtful.unionByName(stored.withColumn("_why", F.lit(KNOWN_ID)))
    doubtful = staged(doubtful, "doubtful-ids")
    if doubtful.isEmpty():
        reason = F.when(F.col("record_id").isNull(), F.lit(MISSING_ID))
        return (source.where(F.col("record_id").isNotNull()),
                source.where(F.col("record_id").isNull()).withColumn("reason", reason))
    judged = counted_join(source.withColumn("_rid", rid), doubtful, "_rid", "_times", "left").withColumn(
        "reason", F.when(F.col("record_id").isNull(), F.lit(MISSING_ID)).otherwise(F.col("_why")))
    judged = staged(judged.select(*[F.col(quoted(c)) for c in source.columns], "reason"), "judged-records")
    accepted = staged(judged.where(F.col("reason").isNull()).drop("reason"), "accepted-records")
    return accepted, judged.where(F.col("reason").isNotNull())


def load_person(spine: DataFrame) -> DataFrame:
    """L-PER: sex mapped, birth date split (impossible dates -> NULL parts), source values kept."""
    dob = parse_dmy("date_of_birth")
    return _conform(spine.select(
        "person_id",
        value_map("gender", GENDER_MAP, GENDER_DEFAULT).alias("gender_concept_id"),
        F.year(dob).alias("year_of_birth"),
        F.month(dob).alias("month_of_birth"),
        F.dayofmonth(dob).alias("day_of_birth"),
        F.lit(RACE_CONCEPT).alias("race_concept_id"),
        F.lit(ETHNICITY_CONCEPT).alias("ethnicity_concept_id"),
        F.col("record_id").cast("string").alias("person_source_value"),
        F.col("gender").alias("gender_source_value"),
    ), schemas.PERSON)


def load_observation_period(person: DataFrame) -> DataFrame:
    """L-OBP: one period per person on the proxy date; ids follow person order (= person_id)."""
    d = _date(PROXY_DATE)
    return _conform(person.select(
        F.col("person_id").alias("observation_period_id"), "person_id",
        d.alias("observation_period_start_date"), d.alias("observation_period_end_date"),
        F.lit(PERIOD_TYPE_CONCEPT).alias("period_type_concept_id"),
    ), schemas.OBSERVATION_PERIOD)


def _visit_columns(period: DataFrame) -> list[Column]:
    return [
        "person_id", F.lit(VISIT_CONCEPT).alias("visit_concept_id"),
        F.col("observation_period_start_date").alias("visit_start_date"),
        F.col("observation_period_start_date").cast("timestamp_ntz").alias("visit_start_datetime"),
        F.col("observation_period_end_date").alias("visit_end_date"),
        F.col("observation_period_end_date").cast("timestamp_ntz").alias("visit_end_datetime"),
        F.lit(VISIT_TYPE_CONCEPT).alias("visit_type_concept_id"),
    ]


def visit_from_period(period: DataFrame) -> DataFrame:
    """L-VIS on a fresh load: periods are 1:1 with persons, so the visit id is the period id."""
    return _conform(period.select(F.col("observation_period_id").alias("visit_occurrence_id"),
                                  *_visit_columns(period)), schemas.VISIT_OCCURRENCE)


def load_visit_occurrence(person: DataFrame, period: DataFrame, start: int | Column = 1) -> DataFrame:
    """L-VIS against stored tables: person JOIN observation_period, dense ids in person order."""
    joined = period.join(person.select("person_id"), "person_id")
    visits = joined.select("observation_period_id", *_visit_columns(joined))
    keyed = with_dense_key(visits, ["person_id", "observation_period_id"], "visit_occurrence_id",
                           start=start, tiebreak=False, name="visit-key")
    return _conform(keyed, schemas.VISIT_OCCURRENCE)


def event_spine(spine: DataFrame) -> DataFrame:
    """Fresh load: each keyed registry row with its (only) visit."""
    return spine.withColumn("visit_occurrence_id", F.col("person_id")).withColumn(
        "visit_start_date", _date(PROXY_DATE))


def spine_from_tables(registry: DataFrame, person: DataFrame, visit: DataFrame, rows: int | None = None) -> DataFrame:
    """O-JN1..3: registry JOIN person ON record_id::text = person_source_value JOIN visit ON person_id.

    Both joins are equi-joins on high-cardinality keys (shuffle or broadcast chosen by AQE). The joined tables have one
    row per key, so where ``rows``, the larger side's number of rows, asks for more tasks, both sides are dealt by it.
    """
    n = sized_partitions(registry.sparkSession, rows)
    dealt = (lambda df, key: df.repartition(n, key)) if n else (lambda df, key: df)
    p = person.select("person_id", "person_source_value")
    v = visit.select("person_id", "visit_occurrence_id", "visit_start_date")
    named = registry.withColumn("person_source_value", F.col("record_id").cast("string"))
    keyed = dealt(named, "person_source_value").join(dealt(p, "person_source_value"), "person_source_value").drop(
        "person_source_value")
    return dealt(keyed, "person_id").join(dealt(v, "person_id"), "person_id")


def event_offsets(spine: DataFrame, targets: Sequence[str], low: int, width: int,
                  known: Sequence[Rule] = RULES) -> DataFrame:
    """First event number of every (rule, person-id bucket) of ``targets``; each target starts at zero."""
    rules = [r for t in targets for r in rules_for(t, known)]
    restart = [k for k, r in enumerate(rules) if k == 0 or rules[k - 1].target != r.target]
    return rule_offsets(spine, [fires(r) for r in rules], "person_id", low, width, restart)


def key_events(spine: DataFrame, target: str, start: int | Column = 1, bounds: tuple[int, int] | None = None,
               offsets: DataFrame | None = None, first_rule: int = 0, known: Sequence[Rule] = RULES) -> DataFrame:
    """Fan-out of the rules of ``target`` with dense ids in (rule, person) order.

    The ids are computed on the spine (one shuffle of one narrow row per registry row); the
    events that are then emitted carry them, so no event row is ever shuffled or sorted.
    ``bounds`` are the least and largest person id; ``offsets`` (``event_offsets``) may be shared by
    several targets, ``first_rule`` being the place of this target's first rule in them.
    """
    rules = rules_for(target, known)
    low, high = bounds or id_bounds(spine, "person_id")
    width = id_bucket_width(spine.sparkSession, high - low + 1)
    if offsets is None:
        offsets = event_offsets(spine, (target,), low, width, known)
    narrow = spine.select("person_id", "visit_occurrence_id", "visit_start_date",
                          *dict.fromkeys(r.column for r in rules))
    numbered = with_event_ids(narrow, [fires(r) for r in rules], offsets, "person_id", low, width, start, first_rule,
                              span=high - low + 1)
    return fan_out(numbered, rules=rules, ids="_event_ids")


def event_table(keyed: DataFrame, target: str) -> DataFrame:
    """Project the keyed events of one target to its table schema."""
    d = F.col("visit_start_date")
    ts = d.cast("timestamp_ntz")
    if target == "condition_occurrence":
        out = keyed.select(
            F.col("event_id").alias("condition_occurrence_id"), "person_id",
            F.col("concept_id").alias("condition_concept_id"),
            d.alias("condition_start_date"), ts.alias("condition_start_datetime"),
            d.alias("condition_end_date"), ts.alias("condition_end_datetime"),
            F.col("type_concept_id").alias("condition_type_concept_id"), "visit_occurrence_id",
            F.col("source_value").alias("condition_source_value"))
        return _conform(out, schemas.CONDITION_OCCURRENCE)
    if target == "observation":
        out = keyed.select(
            F.col("event_id").alias("observation_id"), "person_id",
            F.col("concept_id").alias("observation_concept_id"),
            d.alias("observation_date"), ts.alias("observation_datetime"),
            F.col("type_concept_id").alias("observation_type_concept_id"), "value_as_string",
            "visit_occurrence_id", F.col("source_value").alias("value_source_value"))
        return _conform(out, schemas.OBSERVATION)
    if target == "measurement":
        out = keyed.select(
            F.col("event_id").alias("measurement_id"), "person_id",
            F.col("concept_id").alias("measurement_concept_id"),
            d.alias("measurement_date"), ts.alias("measurement_datetime"),
            F.col("type_concept_id").alias("measurement_type_concept_id"), "value_as_number",
            "unit_concept_id", "visit_occurrence_id", F.col("source_value").alias("value_source_value"))
        return _conform(out, schemas.MEASUREMENT)
    if target == "procedure_occurrence":
        out = keyed.select(
            F.col("event_id").alias("procedure_occurrence_id"), "person_id",
            F.col("concept_id").alias("procedure_concept_id"),
            d.alias("procedure_date"), ts.alias("procedure_datetime"),
            d.alias("procedure_end_date"), ts.alias("procedure_end_datetime"),
            F.col("type_concept_id").alias("procedure_type_concept_id"), "visit_occurrence_id",
            F.col("source_value").alias("procedure_source_value"))
        return _conform(out, schemas.PROCEDURE_OCCURRENCE)
    raise ValueError(f"unknown event table {target!r}")


def load_events(spine: DataFrame, target: str, start: int | Column = 1) -> DataFrame:
    """L-C*/L-O*/L-M*/L-P*: one target's fan-out + dense ids in (rule, person) order."""
    return event_table(key_events(spine, target, start), target)


@dataclass
class Cdm:
    """The loaded clinical tables (lazy frames) plus the vocabulary used by the analytics."""

    person: DataFrame
    observation_period: DataFrame
    visit_occurrence: DataFrame
    condition_occurrence: DataFrame
    observation: DataFrame
    measurement: DataFrame
    procedure_occurrence: DataFrame
    drug_exposure: DataFrame
    concept: DataFrame | None = None
    refused: DataFrame | None = None
    person_parts: int | None = None  # partitions that a question deals many persons to; None: Spark's own number

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in schemas.CLINICAL_TABLES}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return schemas.empty_frame(spark, schemas.ALL_CDM[name])


def run_etl(registry: DataFrame, concept: DataFrame | None = None, file_position: bool = False,
            rules: Sequence[Rule] = RULES) -> Cdm:
    """L-ALL: the whole load in dependency order (person -> period -> visit -> events).

    ``rules`` may come from a mapping table (``rules_from_frame``). ``refused`` of the result holds the records that
    were not loaded (``split_records``)."""
    return _load(registry, concept=concept, file_position=file_position, rules=rules)


def run_append(registry: DataFrame, stored: Cdm) -> Cdm:
    """The rows that an export adds to ``stored``, with ids after those of its tables. One period and one visit per
    person, so their ids go on with the person's."""
    starts = {t: next_key_start(getattr(stored, t), EVENT_ID[t]) for t in EVENT_TARGETS}
    return _load(registry, stored.concept, stored.person, next_key_start(stored.person, "person_id"), starts)


def _load(registry: DataFrame, concept: DataFrame | None = None, known: DataFrame | None = None, start: int | Column = 1,
          starts: dict[str, Column] | None = None, file_position: bool = False, rules: Sequence[Rule] = RULES) -> Cdm:
    spark = registry.sparkSession
    accepted, refused = split_records(registry, known, file_position)
    spine = build_spine(accepted, start=start, file_position=True, unique=True)
    person = load_person(spine)
    period = load_observation_period(person)
    visit = visit_from_period(period)
    events = event_spine(spine)
    bounds = id_bounds(spine, "person_id")
    # Each table numbers its own rules' columns when it is read: together these are the columns of the spine once.
    loaded = {t: event_table(key_events(events, t, (starts or {}).get(t, 1), bounds, known=rules), t)
              if rules_for(t, rules) else empty_table(spark, t) for t in EVENT_TARGETS}
    return Cdm(person=person, observation_period=period, visit_occurrence=visit,
               condition_occurrence=loaded["condition_occurrence"], observation=loaded["observation"],
               measurement=loaded["measurement"], procedure_occurrence=loaded["procedure_occurrence"],
               drug_exposure=empty_table(spark, "drug_exposure"), concept=concept, refused=refused,
               person_parts=sized_partitions(spark, bounds[1] - bounds[0] + 1))


def append_events(registry: DataFrame, person: DataFrame, visit: DataFrame, existing: DataFrame,
                  target: str) -> DataFrame:
    """O-KEY2 across batches: new events for ``registry`` with ids after ``max(existing id)``. The joins are done once,
    for the columns of the target's rules only, and staged: bounds, offsets and events all read them."""
    columns = dict.fromkeys(r.column for r in rules_for(target))
    spine = spine_from_tables(registry.select("record_id", *[c for c in columns if c != "record_id"]), person, visit, person.count())
    spine = staged(spine, "joined-spine")
    return load_events(spine, target, start=next_key_start(existing, EVENT_ID[target]))
