"""Vocabulary sources: tab-separated vocabulary files and the seed concept table."""

from __future__ import annotations

import datetime as dt
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.values import parse_ymd
from ..operators.rules import CONCEPT_ROWS
from ..session import path_exists

DATE_COLUMNS = ("valid_start_date", "valid_end_date")
_VALID_FROM = dt.date(1970, 1, 1)
_VALID_TO = dt.date(2099, 12, 31)


def seed_concepts(spark: SparkSession, zero: str = "named") -> DataFrame:
    """Concept rows for every id the rules write.

    ``zero``: ``named`` keeps concept 0 with its name, ``empty`` gives it an empty name,
    ``absent`` leaves it out (the three cases that decide the measurement labels of A-Q6).
    """
    rows = []
    for cid, name, domain, vocab, cls in CONCEPT_ROWS:
        if cid == 0 and zero == "absent":
            continue
        if cid == 0 and zero == "empty":
            name = ""
        standard = None if cid == 0 else "S"
        rows.append((cid, name, domain, vocab, cls, standard, str(cid), _VALID_FROM, _VALID_TO, None))
    return spark.createDataFrame(rows, schemas.CONCEPT)


def read_vocabulary_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """O-SRC3 + O-PRJ13..15: one tab-separated vocabulary file -> typed frame.

    No quote character (a lone ``"`` inside a name stays text), headers lower-cased,
    ``YYYYMMDD`` dates parsed (malformed -> NULL), other columns cast tolerantly, and
    text NULLs filled with ``''``. Words such as ``None`` or ``NA`` stay text.
    """
    raw = (spark.read.option("sep", "\t").option("header", True).option("quote", "")
           .option("inferSchema", False).csv(path))
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    cols = []
    for f in schema.fields:
        if f.name not in raw.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in DATE_COLUMNS:
            cols.append(parse_ymd(f.name).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(F.col(f.name), F.lit("")).alias(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def load_vocabulary(spark: SparkSession, vocab_dir: str, out_root: str | None = None,
                    mode: str = "append") -> dict[str, DataFrame]:
    """L-VOC: every vocabulary file present in ``vocab_dir``; missing files are reported and skipped.

    With ``out_root`` each table is written (``append`` like the chunked load, or ``overwrite``)
    and read back; file splits give the parallelism, there is no chunk loop.
    """
    out: dict[str, DataFrame] = {}
    for fname, (table, schema) in schemas.VOCABULARY_FILES.items():
        path = os.path.join(vocab_dir, fname)
        if not path_exists(spark, path):
            print(f"WARNING: {fname} not found, skipping", file=sys.stderr)
            continue
        df = read_vocabulary_file(spark, path, schema)
        if out_root:
            target = os.path.join(out_root, table)
            df.write.mode(mode).parquet(target)
            df = spark.read.parquet(target)
        out[table] = df
    return out
