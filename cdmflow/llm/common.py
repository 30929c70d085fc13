"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmflow.session import stage_path

# White space that separates words: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: cuts the lineage in a shared folder."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def heavy_join(left: DataFrame, right: DataFrame, keys: list[str], count: str, parts: int = 1024) -> DataFrame:
    """Inner join with a table that has each key once and its number of left rows in ``count``; no key makes a hot task.

    A key with more than 1/``parts`` of the rows is dealt in pieces by a hash of the left row, and its one right row is
    repeated per piece. Fewer than ``parts`` keys can be that frequent, so the broadcast list is bounded, and so are the
    repeats (twice ``parts``).
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    limit = max(total // parts, 100)
    heavy = right.filter(F.col(count) > limit).select(*keys, F.ceil(F.col(count) / limit).cast("int").alias("_pieces"))
    dealt = (left.join(F.broadcast(heavy), keys, "left")
             .withColumn("_piece", F.when(F.col("_pieces").isNull(), 0)
                         .otherwise(F.pmod(F.hash(*left.columns), F.col("_pieces")))).drop("_pieces"))
    pieces = F.when(F.col(count) > limit, F.ceil(F.col(count) / limit).cast("int")).otherwise(1)
    repeated = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return dealt.join(repeated, [*keys, "_piece"]).drop("_piece")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def held_out(doc_id: Column) -> Column:
    """True for the documents kept for measuring: crc32(doc_id as text) mod 4 is 2 (a null id is never learnt from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learnable(doc_id: Column) -> Column:
    return ~held_out(doc_id)


def text_chunks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in slices of about ``size`` characters, cut only at white space (a longer word stays whole)."""
    if len(text) <= size:
        yield text
        return
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end
