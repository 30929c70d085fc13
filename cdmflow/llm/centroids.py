"""Centroid clustering with Walsh-Hadamard progressive search (operator 13).

Vectors become integers and are carried by their Walsh-Hadamard transform, an exact integer transform that keeps
squared distances up to the factor of the vector length. A vector and a centroid are compared coefficient by
coefficient, coarse (few sign changes) to fine. After the first step the leading centroid's distance is completed.
After each step the differences so far, with the norms of the coefficients still to come, bound every distance from
below; centroids whose bound exceeds the leader's distance are strictly worse and leave. What remains is finished over
all coefficients, in integers, so the assignment is exact, ties included.

One staged table of transforms is read by every round. A task adds up its vectors per centroid, so a round sends
(tasks x centroids) rows to the sum and (centroids) rows to the driver, however large a cluster is.

Vectors with a null or non-finite component, another length, or a component beyond ``LIMIT`` after scaling (whose
distances would not fit a long) take no part. Repeated rows count as often as they occur; a row without id is
clustered but starts no centroid. With fewer vectors than centroids each vector starts one; without vectors the
result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmflow.llm.common import stage

LIMIT = 1 << 24
_STEP = 8  # coefficients taken between two eliminations


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Integer transform of the rows, in natural order; twice gives the row times its length."""
    n, size = x.shape
    out = x
    half = 1
    while half < size:
        pair = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out


def coarse_to_fine(size: int) -> np.ndarray:
    """Coefficient numbers by the sign changes of their base function."""
    signs = walsh_hadamard(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def nearest(coefficients: np.ndarray, centroids: np.ndarray, step: int = _STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance, coefficient pairs read) of every row; ties go to the smaller number.

    Both arguments are transforms whose columns stand in coarse-to-fine order."""
    n, size = coefficients.shape
    k = len(centroids)
    row, to = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    partial = np.zeros(n * k, np.int64)
    rest = np.sqrt(np.cumsum(coefficients[:, ::-1].astype(float) ** 2, axis=1)[:, ::-1])
    rest_c = np.sqrt(np.cumsum(centroids[:, ::-1].astype(float) ** 2, axis=1)[:, ::-1])
    least, read = np.zeros(n), 0
    for at in range(0, size, step):
        gap = coefficients[row, at:at + step] - centroids[to, at:at + step]
        partial += np.einsum("ij,ij->i", gap, gap)
        read += gap.size
        if at == 0 and k:
            lead = partial.reshape(n, k).argmin(axis=1)
            gap = coefficients - centroids[lead]
            least = np.einsum("ij,ij->i", gap, gap).astype(float) * (1 + 1e-9)
            read += gap.size
        if at + step < size:
            # a part in 10^9 covers what floats round; the sums themselves are integers
            stay = (partial + (rest[row, at + step] - rest_c[to, at + step]) ** 2) * (1 - 1e-9) - 1 <= least[row]
            row, to, partial = row[stay], to[stay], partial[stay]
    order = np.lexsort((to, partial, row))
    first = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])] if n else order
    return to[first], partial[first] // size, read


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _transform(size: int) -> Callable:
    order = coarse_to_fine(size)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = walsh_hadamard(_matrix(batch.column("x"), size))[:, order]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, size, dtype=np.int32)), pa.array(found.ravel()))
                yield pa.record_batch([batch.column("id"), lists], names=["id", "h"])
    return apply


def _batches(column: pa.Array, size: int, rows: int = 4096) -> Iterator[np.ndarray]:
    for at in range(0, len(column), rows):
        yield _matrix(column.slice(at, rows), size)


def _sums(centroids: np.ndarray) -> Callable:
    """mapInArrow function: one row per centroid with the count and the coefficient sums of the task's vectors."""
    k, size = centroids.shape

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            for part in _batches(batch.column("h"), size):
                to = nearest(part, centroids)[0]
                count += np.bincount(to, minlength=k)
                np.add.at(total, to, part)
        some = np.flatnonzero(count)
        yield pa.record_batch([pa.array(some), pa.array(count[some])] + [pa.array(total[some, j]) for j in range(size)],
                              names=["cluster", "n", *(f"s{j}" for j in range(size))])
    return apply


def _assign(centroids: np.ndarray) -> Callable:
    size = centroids.shape[1]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _batches(batch.column("h"), size):
                to, distance, _ = nearest(part, centroids)
                yield pa.record_batch([batch.column("id").slice(at, len(part)), pa.array(to.astype(np.int32)), pa.array(distance)],
                                      names=["id", "cluster", "distance"])
                at += len(part)
    return apply


def integer_vectors(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component as longs; null where one is null, not finite or out of range."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < LIMIT, F.lit(False)))
    return F.when(fits, scaled)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, size: int = 64, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Integer k-means. Centroids start as the ``k`` vectors with the least sha256 of ``<seed>:<id>``.

    Each round assigns all vectors and replaces every centroid that has any by the floor of their mean. Returns one
    row per vector: ``id_col``, ``cluster``, ``distance`` (squared, in scaled integers), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256`` (of the final components, comma-joined). Other columns are not read.
    """
    if size < 2 or size & (size - 1):
        raise ValueError("the transform needs a power of two as vector length")
    usable = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(F.size("v") == size)
              .select("id", integer_vectors(F.col("v"), scale).alias("x")).filter("x IS NOT NULL"))
    id_type = usable.schema["id"].dataType.simpleString()
    staged = stage(usable.mapInArrow(_transform(size), f"id {id_type}, h array<long>"), "transforms")

    order = coarse_to_fine(size)
    natural = np.empty(size, np.int64)
    natural[order] = np.arange(size)
    starts = (staged.filter("id IS NOT NULL").withColumn("digest", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
              .orderBy("digest", "h").limit(k).collect())
    columns = ", ".join(f"s{j} long" for j in range(size))
    if not starts:
        starts = staged.orderBy("h").limit(k).collect()  # no row has an id
    centroids = np.array([r["h"] for r in starts], np.int64).reshape(-1, size)
    for _ in range(rounds if len(centroids) else 0):
        parts = staged.select("h").mapInArrow(_sums(centroids), f"cluster long, n long, {columns}")
        totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col(f"s{j}").cast("decimal(38,0)")).alias(f"s{j}") for j in range(size)))
        plain = walsh_hadamard(centroids[:, natural]) // size
        for r in totals.collect():  # one row per centroid
            coefficients = np.array([[int(r[f"s{j}"]) for j in natural]], dtype=object)
            plain[r["cluster"]] = [int(v) // size // r["n"] for v in walsh_hadamard(coefficients)[0]]
        centroids = walsh_hadamard(plain)[:, order]

    if len(centroids):
        found = stage(staged.mapInArrow(_assign(centroids), f"id {id_type}, cluster int, distance long"), "clusters")
    else:
        found = staged.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    plain = walsh_hadamard(centroids[:, natural]) // size
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in plain.tolist()] or [""]
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row per centroid
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    return (found.join(F.broadcast(sums), "cluster").withColumn("inertia", total.scalar())
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
                    F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1).alias("centroid_sha256")))
