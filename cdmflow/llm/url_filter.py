"""URL filter: a sorted array of 64-bit xxhash digests, memory-mapped on every executor.

Rules ``host + path`` (``example.com/en/``) allow or block a host with all its subdomains and every
path that starts with the rule's path; the longest fitting rule decides, then ``default``.

``build_index`` sorts the digests of the rule strings and stores, in the same order, the full strings
and the verdicts. The three files travel with ``SparkContext.addFile`` and are opened with
``numpy.load(mmap_mode="r")``: the array is never unpickled per task, and the workers of one machine
share its pages. A batch of URLs is probed with one vectorised binary search; each hit is confirmed
against the stored full string, so a digest collision cannot give a wrong verdict. Lists longer than
``block_size`` rules become several indexes, all of which are probed.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and gets
``default``; repeated rows are judged one by one; an empty table gives an empty result; other columns of
the input (also one named like a result column) are not read. No shuffle, so no skew.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = tuple[str, str]  # (host + path, "allow" or "block")

_END_OF_HOST = re.compile(r"[/?#]")
_END_OF_PATH = re.compile(r"[?#]")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_OPEN: dict[str, DigestIndex] = {}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host A-Z lower-cased; both empty for null or without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    m = _END_OF_HOST.search(rest)
    if m is None:
        return rest.translate(_UPPER), ""
    host, tail = rest[:m.start()], rest[m.start():]
    return host.translate(_UPPER), _END_OF_PATH.split(tail, maxsplit=1)[0]


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(_UPPER), slash + path


class DigestIndex:
    """Sorted 64-bit digests with the full strings beside them, opened as memory maps."""

    def __init__(self, prefix: str):
        self.digests = np.load(f"{prefix}-digests.npy", mmap_mode="r")
        self.offsets = np.load(f"{prefix}-offsets.npy", mmap_mode="r")
        self.verdicts = np.load(f"{prefix}-verdicts.npy", mmap_mode="r")
        self.path_lengths = np.load(f"{prefix}-lengths.npy").tolist()
        self.strings = np.load(f"{prefix}-strings.npy", mmap_mode="r")

    def string(self, i: int) -> str:
        return bytes(self.strings[self.offsets[i]:self.offsets[i + 1]]).decode()

    def find(self, keys: Sequence[str]) -> np.ndarray:
        """Position of each key, or -1."""
        at = np.full(len(keys), -1, dtype=np.int64)
        if not len(keys) or not len(self.digests):
            return at
        probe = np.fromiter((digest(k) for k in keys), dtype=np.uint64, count=len(keys))
        lo = np.searchsorted(self.digests, probe, side="left")
        hits = np.flatnonzero(self.digests[np.minimum(lo, len(self.digests) - 1)] == probe)
        for h in hits:  # the stored string decides; equal digests lie next to each other
            i = int(lo[h])
            while i < len(self.digests) and self.digests[i] == probe[h]:
                if self.string(i) == keys[h]:
                    at[h] = i
                    break
                i += 1
        return at


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode())


def build_index(rules: Sequence[Rule], folder: str, name: str) -> list[str]:
    """Write one index; returns its files. A rule given twice keeps its last verdict."""
    latest = {"".join(split_rule(r)): verdict for r, verdict in rules}
    rows = sorted((digest(k), k, v == "block") for k, v in latest.items())
    raw = [k.encode() for _, k, _ in rows]
    arrays = {
        "digests": np.array([d for d, _, _ in rows], dtype=np.uint64),
        "offsets": np.concatenate([[0], np.cumsum([len(b) for b in raw], dtype=np.int64)]).astype(np.int64),
        "verdicts": np.array([b for _, _, b in rows], dtype=np.bool_),
        "lengths": np.unique([len(split_rule(k)[1]) for _, k, _ in rows]).astype(np.int64),
        "strings": np.frombuffer(b"".join(raw), dtype=np.uint8),
    }
    files = []
    for part, values in arrays.items():
        files.append(os.path.join(folder, f"{name}-{part}.npy"))
        np.save(files[-1], values)
    return files


def publish(spark: SparkSession, rules: Sequence[Rule], block_size: int = 5_000_000) -> list[str]:
    """Send the indexes of ``rules`` to the executors; returns their names."""
    folder = tempfile.mkdtemp(prefix="url-index-")
    names = []
    for start in range(0, max(1, len(rules)), block_size):
        names.append(f"urls-{uuid.uuid4().hex}")
        for file in build_index(rules[start:start + block_size], folder, names[-1]):
            spark.sparkContext.addFile(file)
    return names


def opened(name: str) -> DigestIndex:
    if name not in _OPEN:
        first = SparkFiles.get(f"{name}-digests.npy")
        _OPEN[name] = DigestIndex(first.removesuffix("-digests.npy"))
    return _OPEN[name]


def judge(urls: pd.Series, indexes: Sequence[DigestIndex], default: str) -> pd.DataFrame:
    """Host, path, deciding rule and verdict of a batch of URLs."""
    parts = [split_url(None if u is None or u is pd.NA else u) for u in urls]
    lengths = sorted({n for ix in indexes for n in ix.path_lengths}, reverse=True)
    rule = np.full(len(parts), None, dtype=object)
    verdict = np.full(len(parts), default, dtype=object)
    keys, rows = [], []
    for row, (host, path) in enumerate(parts):
        labels = host.split(".")
        for k in range(len(labels)):
            parent = ".".join(labels[k:])
            for n in lengths:
                if n <= len(path):
                    keys.append(parent + path[:n])
                    rows.append(row)
    for ix in indexes:
        at = ix.find(keys)
        for j in np.flatnonzero(at >= 0):
            row, key = rows[j], keys[j]
            if rule[row] is None or len(key) > len(rule[row]):
                rule[row] = key
                verdict[row] = "block" if ix.verdicts[at[j]] else "allow"
    return pd.DataFrame({"host": [h for h, _ in parts], "path": [p for _, p in parts],
                         "rule": rule, "verdict": verdict})


def filter_urls(df: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", block_size: int = 5_000_000) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``df``."""
    names = publish(df.sparkSession, rules, block_size)
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type)] + [
        T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes = [opened(n) for n in names]
        for pdf in batches:
            out = judge(pdf["_url"], indexes, default)
            out.insert(0, id_col, pdf["_id"].to_numpy(dtype=object, na_value=None))
            yield out

    return df.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url")).mapInPandas(run, schema)
