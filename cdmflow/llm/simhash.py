"""SimHash near-duplicates with pivot distance tables.

Fingerprint: words split at white space after lower-casing A-Z, shingles of ``shingle`` words (repeats
count; a shorter text is one shingle), each hashed with XXH64; a bit is 1 if it is set in over half of the
hashes. Texts with equal fingerprints form one class, so copies are never paired.

Links between classes (at most ``max_bits`` differing bits):

1. Every class gets its row of the pivot distance table: the Hamming distances to ``PIVOTS`` fixed
   reference fingerprints, one byte each.
2. Classes are dealt by blocks: of ``max_bits + 2`` blocks of the fingerprint, two that differ in no bit
   must exist for every link (``max_bits`` differing bits touch at most ``max_bits`` blocks), so a class
   is placed once for every pair of blocks. This only brings classes together; it loses no link.
3. Within a place, a pair is discarded if any pivot coordinate differs by more than ``max_bits`` (triangle
   inequality), and survivors are verified by their true Hamming distance. Both tests are in the join
   condition, so only true links leave the join.

Components of the links are then labelled in the shared folder (``components``).

Defined cases: null and empty texts have fingerprint zero, which is linked like any other; a null id is no
candidate for ``component_id`` (a component of null ids only has a null one); repeated rows share a
fingerprint; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmflow.llm.common import stage
from cdmflow.llm.components import components

PIVOTS = 16
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_SLOTS = (256 * np.arange(8)).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit fingerprint of a whole text; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        after = list(accumulate(len(w) + 1 for w in words))
        hashes = [xxhash.xxh64_intdigest(line[s:e - 1], seed) for s, e in zip([0, *after], after[shingle - 1:])]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((raw + _BYTE_SLOTS).ravel(), minlength=2048).reshape(8, 256) @ _BITS_OF_BYTE
    return int(np.packbits(2 * counts.ravel() > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 keys: dict[str, Column] | None = None) -> DataFrame:
    """(id, fp) of every row, plus the columns ``keys`` computed from the row; ``fp`` is a signed long."""
    keys = keys or {}
    taken = df.select(F.col(id_col).alias(id_col), *[c.alias(k) for k, c in keys.items()],
                      F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([f for f in taken.schema if f.name != "_text"] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.fromiter((fingerprint(t if isinstance(t, str) else None, shingle) for t in pdf["_text"]),
                              dtype=np.uint64, count=len(pdf))
            yield pdf.drop(columns="_text").assign(fp=fps.view(np.int64))

    return taken.mapInPandas(run, schema)


def _pivots(count: int) -> list[int]:
    return [xxhash.xxh64_intdigest(f"pivot {k}".encode()) for k in range(count)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(fp: Column) -> list[Column]:
    """The row of distances to the pivots, eight one-byte coordinates to a long."""
    distances = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long") for p in _pivots(PIVOTS)]
    packed = []
    for k in range(0, PIVOTS, 8):
        word = distances[k]
        for j in range(1, 8):
            word = word.bitwiseOR(F.shiftleft(distances[k + j], 8 * j))
        packed.append(word.alias(f"pv{k // 8}"))
    return packed


def _within(a: str, b: str, bits: int) -> Column:
    """No pivot coordinate differs by more than ``bits``."""
    test = F.lit(True)
    for k in range(PIVOTS):
        byte = lambda side: F.shiftright(F.col(f"{side}.pv{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(127).cast("long"))
        test = test & (F.abs(byte(a) - byte(b)) <= bits)
    return test


def _places(fp: Column, max_bits: int) -> Column:
    """One long per pair of blocks: the pair's number above, the bits of both blocks below."""
    blocks = max_bits + 2
    edges = [64 * k // blocks for k in range(blocks + 1)]
    out = []
    for number, (i, j) in enumerate(combinations(range(blocks), 2)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in (i, j))
        out.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(_signed(mask)))))
    return F.array(*out)


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a < b, of all pairs of distinct ``fp`` values at most ``max_bits`` bits apart."""
    placed = classes.select("fp", *pivot_table(F.col("fp")), F.explode(_places(F.col("fp"), max_bits)).alias("place"))
    a, b = placed.alias("a"), placed.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    return (a.join(b, (F.col("a.place") == F.col("b.place")) & (F.col("a.fp") < F.col("b.fp"))
                   & _within("a", "b", max_bits) & near)
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct())


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, keys: dict[str, Column] | None = None) -> DataFrame:
    """(id, fp, component_id) of every row, with the columns ``keys``; ``component_id`` is the least id reachable."""
    docs = stage(fingerprints(df, id_col=id_col, text_col=text_col, shingle=shingle, keys=keys), "fingerprints")
    classes = stage(docs.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    linked = components(links(classes, max_bits), "a", "b")
    rooted = (classes.join(linked, classes["fp"] == linked["node"], "left")
              .select(classes["fp"].alias("_fp"), "least", F.coalesce("root", "fp").alias("root")))
    by_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = stage(rooted.join(by_root, "root").select("_fp", "component_id"), "labels")
    return docs.join(labels, docs["fp"] == labels["_fp"]).drop("_fp")
