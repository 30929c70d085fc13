"""Exports loaded one after another into stored tables, each of them once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.values import quoted
from ..sources import sinks
from .etl import Cdm, run_append


def export_digest(registry: DataFrame) -> str:
    """A digest of the rows of an export, whatever their order: count, sum and exclusive or of row hashes."""
    cells = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("\0")) for c in sorted(registry.columns)]
    row = F.xxhash64(F.lit("\1".join(sorted(registry.columns))), *cells)
    n, total, mix = registry.select(row.alias("h")).agg(
        F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    return f"{n}-{int(total or 0) & (1 << 64) - 1:016x}-{(mix or 0) & (1 << 64) - 1:016x}"


def append_export(registry: DataFrame, root: str, batch: str | None = None) -> Cdm:
    """O-SNK2 / O-KEY2: add an export to the tables under ``root`` and return frames over them.

    ``batch`` names the export in the ledger (its digest, if not given). An export that the ledger has adds nothing;
    records whose id is stored are refused, so neither a repeated file nor a repeated record doubles a row. All tables
    change in one commit. Refused records are kept under ``quarantine/refused_records`` with their reason.
    """
    spark = registry.sparkSession
    batch = batch or export_digest(registry)
    stored = sinks.read_cdm(spark, root)
    if batch in sinks.snapshot(spark, root).batches:
        return stored
    added = run_append(registry, stored)
    sinks.write_tables({"refused_records": added.refused}, root, "append", schema="quarantine", batch=batch)
    return Cdm(**sinks.write_tables({n: getattr(added, n) for n in schemas.CLINICAL_TABLES}, root, "append", batch=batch))
