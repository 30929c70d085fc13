"""Table lifecycle: namespaces, empty tables from schemas, overwrite/append loads, reset, catalog listing.

Tables are Parquet folders under an output root (``<root>/<schema>/<table>``); a
catalog database can be used instead through ``save_tables(..., database=...)``.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..plans.etl import Cdm
from ..session import path_exists

RESET_ORDER = ("procedure_occurrence", "drug_exposure", "measurement", "observation", "condition_occurrence",
               "visit_occurrence", "observation_period", "person")


def table_path(root: str, table: str, schema: str = "omop") -> str:
    return os.path.join(root, schema, table)


# Commits of a schema: one small folder per version; the highest one says which folders make up each table. Tables
# change when that folder appears, all at once; a job that dies before leaves the tables as they were.
COMMITS = "_commits"
_COMMIT_SCHEMA = "kind string, name string, part string"


@dataclass
class Snapshot:
    """The tables of a schema at one commit: part folders per table, and the batches loaded so far."""

    version: int = 0
    parts: dict[str, list[str]] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)


def snapshot(spark: SparkSession, root: str, schema: str = "omop") -> Snapshot:
    path = os.path.join(root, schema, COMMITS)
    if not path_exists(spark, path):
        return Snapshot()
    commits = spark.read.schema(_COMMIT_SCHEMA + ", v int").parquet(path)
    last = commits.agg(F.max("v")).first()[0]
    if last is None:
        return Snapshot()
    found = Snapshot(last)
    for r in commits.where(F.col("v") == last).orderBy("part").collect():  # tables x parts
        if r["kind"] == "batch":
            found.batches.append(r["name"])
        else:
            found.parts.setdefault(r["name"], []).append(r["part"])
    return found


def _commit(spark: SparkSession, root: str, schema: str, state: Snapshot) -> None:
    rows = [("table", t, p) for t, parts in state.parts.items() for p in parts] + [("batch", b, "") for b in state.batches]
    spark.createDataFrame(rows, _COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(root, schema, COMMITS, f"v={state.version}"))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_tables(frames: dict[str, DataFrame], root: str, mode: str = "overwrite", schema: str = "omop",
                 batch: str | None = None) -> dict[str, DataFrame]:
    """O-SNK1/O-SNK2: replace or extend several tables in one commit, and return frames over the stored tables.

    Every write goes to a folder of its own (``<table>/_v=<version>``); the commit is written last and switches all
    tables together. ``append`` keeps the folders there are. ``batch`` names the load in the ledger: a batch that
    the ledger has is not written again. One writer at a time. Folders that an overwrite replaces are removed after
    the commit.
    """
    spark = next(iter(frames.values())).sparkSession
    old = snapshot(spark, root, schema)
    if batch is not None and batch in old.batches:
        return {name: read_table(spark, root, name, schema, old) for name in frames}
    part = f"_v={old.version + 1}"
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(os.path.join(table_path(root, name, schema), part))
    kept = {name: old.parts.get(name, []) if mode == "append" else [] for name in frames}
    new = Snapshot(old.version + 1, {**old.parts, **{name: [*kept[name], part] for name in frames}},
                   old.batches + ([batch] if batch is not None else []))
    _commit(spark, root, schema, new)
    for name in frames:
        for gone in set(old.parts.get(name, [])) - set(new.parts[name]):
            _delete(spark, os.path.join(table_path(root, name, schema), gone))
    return {name: read_table(spark, root, name, schema, new) for name in frames}


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite", schema: str = "omop") -> DataFrame:
    """O-SNK1/O-SNK2: write one whole table (overwrite = idempotent re-run, append = next batch)."""
    return write_tables({table: df}, root, mode, schema)[table]


def read_table(spark: SparkSession, root: str, table: str, schema: str = "omop", state: Snapshot | None = None) -> DataFrame:
    """O-SRC5 + O-SRC6: scan a stored table; a missing table reads as empty with its fixed schema."""
    path = table_path(root, table, schema)
    parts = (state or snapshot(spark, root, schema)).parts.get(table)
    if parts:
        return spark.read.parquet(*[os.path.join(path, p) for p in parts])
    if not path_exists(spark, path):
        return schemas.empty_frame(spark, schemas.ALL_CDM[table]) if table in schemas.ALL_CDM else None
    return spark.read.parquet(path)


def create_empty_tables(spark: SparkSession, root: str, tables: dict | None = None, schema: str = "omop") -> None:
    """O-SNK5/O-SNK6: create the namespace and every missing CDM table empty, from the fixed schemas."""
    there = snapshot(spark, root, schema).parts
    missing = {n: schemas.empty_frame(spark, s) for n, s in (tables or schemas.ALL_CDM).items() if n not in there}
    if missing:
        write_tables(missing, root, schema=schema)


def write_cdm(cdm: Cdm, root: str, mode: str = "overwrite", batch: str | None = None) -> Cdm:
    """Write the eight clinical tables in one commit and return frames over the stored copies."""
    return Cdm(**write_tables(cdm.tables(), root, mode, batch=batch), concept=cdm.concept)


def read_cdm(spark: SparkSession, root: str, concept: DataFrame | None = None) -> Cdm:
    state = snapshot(spark, root)
    return Cdm(**{n: read_table(spark, root, n, state=state) for n in schemas.CLINICAL_TABLES}, concept=concept)


def reset_clinical_tables(spark: SparkSession, root: str) -> None:
    """O-SNK7 / L-RST: empty the eight clinical tables in one commit; vocabulary and staging stay.

    Ids restart at 1 on the next load because they are derived from the data, not a sequence. The ledger of batches
    is emptied too, so that exports can be loaded again.
    """
    write_tables({n: schemas.empty_frame(spark, schemas.CLINICAL_TABLES[n]) for n in RESET_ORDER}, root)
    state = snapshot(spark, root)
    if state.batches:
        _commit(spark, root, "omop", Snapshot(state.version + 1, state.parts))


def save_tables(frames: dict[str, DataFrame], database: str, mode: str = "overwrite", location: str | None = None,
                bucket_by: dict[str, str] | None = None, buckets: int = 8) -> None:
    """Catalog variant of the sink: ``CREATE DATABASE IF NOT EXISTS`` + ``saveAsTable`` per frame.

    ``bucket_by`` names the column of a table that it is bucketed and sorted by: joins and groupings of such tables on
    that column need no exchange. Rows are dealt by that column first, so each bucket is one file.
    """
    if not frames:
        return
    spark = next(iter(frames.values())).sparkSession
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    for name, df in frames.items():
        column = (bucket_by or {}).get(name)
        if column:
            writer = df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
        else:
            writer = df.write
        writer.mode(mode).saveAsTable(f"`{database}`.`{name}`")


# Tables that questions join and group by person.
BY_PERSON = {t: "person_id" for t in ("person", "observation_period", "visit_occurrence", "condition_occurrence",
                                      "observation", "measurement", "procedure_occurrence")}


def save_cdm(cdm: Cdm, database: str, location: str | None = None, buckets: int | None = 8, statistics: bool = True,
             tables: Sequence[str] = tuple(schemas.CLINICAL_TABLES)) -> Cdm:
    """The clinical ``tables`` as catalog tables with stored row counts and sizes; the other frames of ``cdm`` stay.

    With ``buckets`` they are bucketed by person (O-JN2, O-JN6), which shuffles every row once and pays when many
    questions follow; with None each row is written by the task that made it.
    """
    spark = cdm.person.sparkSession
    save_tables({n: getattr(cdm, n) for n in tables}, database, location=location,
                bucket_by=BY_PERSON if buckets else None, buckets=buckets or 0)
    if statistics:
        for name in tables:
            spark.sql(f"ANALYZE TABLE `{database}`.`{name}` COMPUTE STATISTICS")
    return replace(cdm, **{n: spark.table(f"`{database}`.`{n}`") for n in tables},
                   person_parts=None if buckets else cdm.person_parts)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """O-SRC7: table names of a catalog database, sorted (``information_schema.tables``)."""
    rows = [(database or spark.catalog.currentDatabase(), t.name, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, table_type string, is_temporary boolean"
    ).orderBy("table_name")


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 fetchsize: int = 50_000, **extra: str) -> dict[str, str]:
    """O-SRC8: options for ``spark.read.format('jdbc')`` / ``df.write.format('jdbc')``.

    Only configuration: this repository runs no database server, so the JDBC path is
    not exercised by the tests.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    opts.update(extra)
    return opts


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
