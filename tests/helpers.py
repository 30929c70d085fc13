"""Hand-written registry frames for the rule tests."""

from __future__ import annotations

from cdmflow.sources.registry import REGISTRY_SCHEMA

FIELDS = REGISTRY_SCHEMA.fieldNames()


def reg_row(record_id: int, **values):
    row = {f: None for f in FIELDS}
    row["record_id"] = record_id
    row.update(values)
    return tuple(row[f] for f in FIELDS)


def registry(spark, rows):
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)
