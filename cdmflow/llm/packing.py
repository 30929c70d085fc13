"""Vector best-fit packing of token pieces into sequences.

A document's ids, then id 0, are cut into pieces of at most ``capacity`` tokens (only longer documents are
cut; the first piece takes the remainder). Every sequence has three capacities: tokens, documents and
attention cost (the sum of squared piece lengths). Pieces are placed in decreasing length; among the open
sequences with room under *every* capacity, one is chosen by the smallest weighted norm of what would be
left (``rule="norm"``) or by the largest weighted dot product of the piece with what is left
(``rule="dot"``), each dimension scaled by its capacity. If none has room, a new sequence is opened.

On Spark: tokenizing is one ``mapInPandas`` whose narrow result (no texts, no ids) is staged; pieces
that fill a sequence alone are done; the rest is dealt evenly, by a hash of the piece's own number, into
groups of about ``group_size`` pieces, and each group is packed by one ``applyInPandas`` call. No id or
source decides the group, so no key is hot; a group leaves about one sequence part-filled, one in
thousands.

Defined cases: null and empty text give one piece with id 0 alone; repeated rows are packed one by one; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmflow.llm.common import stage
from cdmflow.llm.tokens import encoder

END = b"\0\0\0\0"


def cuts(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document with ``n`` ids: whole pieces after a first one with the remainder."""
    whole = (n - 1) // capacity
    return [n - whole * capacity] + [capacity] * whole


def token_pieces(df: DataFrame, tokenizer_path: str, *, capacity: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, slot[, ids]) of every piece; ``slot`` is unique within one run."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("piece", T.IntegerType())] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "slot")] + [
        T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path).encode
        slot = TaskContext.get().partitionId() << 40
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["_id"].to_numpy(dtype=object, na_value=None), pdf["_text"]):
                raw = (encode(text) if isinstance(text, str) else b"") + END
                start = 0
                for piece, n in enumerate(cuts(len(raw) // 4, capacity)):
                    part = raw[4 * start:4 * (start + n)]
                    row = (key, piece, start, n, zlib.crc32(part), slot)
                    rows.append(row + (np.frombuffer(part, dtype="<u4").astype(np.int32),) if with_ids else row)
                    start += n
                    slot += 1
            yield pd.DataFrame(rows, columns=schema.names)

    return df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInPandas(run, schema)


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. ``capacity``/``weights``: tokens, documents, attention cost."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    left = np.zeros((3, len(lengths)))  # of the open bins
    number = np.zeros(len(lengths), dtype=np.int64)
    count = made = 0
    scale = weights / capacity**2
    order = np.argsort(-lengths, kind="stable")
    least = lengths.min() if len(lengths) else 0
    for i in order:
        n = float(lengths[i])
        need = (n, 1.0, n * n)
        room = left[:, :count]
        fits = (room[0] >= need[0]) & (room[1] >= need[1]) & (room[2] >= need[2])
        open_bins = np.flatnonzero(fits)
        if len(open_bins):
            some = room[:, open_bins]
            if rule == "norm":
                score = sum(w * (some[k] - need[k]) ** 2 for k, w in enumerate(scale))
                at = open_bins[np.argmin(score)]
            else:
                score = sum(w * need[k] * some[k] for k, w in enumerate(scale))
                at = open_bins[np.argmax(score)]
        else:
            at = count
            left[:, at] = capacity
            number[at] = made
            count += 1
            made += 1
        bins[i], offsets[i] = number[at], capacity[0] - left[0, at]
        left[0, at] -= need[0]
        left[1, at] -= need[1]
        left[2, at] -= need[2]
        if left[0, at] < least or left[1, at] < 1:  # no piece fits any more: close it
            count -= 1
            left[:, at], number[at] = left[:, count], number[count]
    return bins, offsets


def pack(pieces: DataFrame, *, capacity: int = 2048, max_documents: int = 1024, max_attention: float | None = None,
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm",
         group_size: int = 6000) -> DataFrame:
    """``pieces`` (with length and a unique slot) with sequence_id and offset. ``pieces`` must be staged."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    limits = np.array([capacity, max_documents, float(capacity**2 if max_attention is None else max_attention)])
    weight = np.array(weights)
    alone = F.col("length") >= capacity
    out = T.StructType([f for f in pieces.schema] + [T.StructField("sequence_id", T.LongType()),
                                                     T.StructField("offset", T.LongType())])
    whole = pieces.filter(alone).select("*", (-F.col("slot") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(~alone)
    groups = max(1, -(-rest.count() // group_size))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["_group"].iloc[0])
        pdf = pdf.drop(columns="_group").sort_values("slot", ignore_index=True)
        bins, offsets = best_fit(pdf["length"].to_numpy(), limits, weight, rule)
        return pdf.assign(sequence_id=(group << 32) + bins, offset=offsets)[out.names]

    packed = (rest.withColumn("_group", F.pmod(F.xxhash64("slot"), F.lit(groups)))
              .groupBy("_group").applyInPandas(fill, out))
    return whole.unionByName(packed)


def pack_documents(df: DataFrame, tokenizer_path: str, *, capacity: int = 2048, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """Tokenize, cut, stage the piece table and pack it."""
    pieces = stage(token_pieces(df, tokenizer_path, capacity=capacity, id_col=id_col, text_col=text_col), "pieces")
    return pack(pieces, capacity=capacity, **options).drop("slot")
