"""Invariants of the distributed dense keys and the positional percentile, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmflow.functions.keys import with_dense_key
from cdmflow.operators.median import grouped_percentile_cont


def _rows(n, seed=7, hot_share=0.0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 42 if rnd.random() < hot_share else rnd.randint(0, n * 10)
        out.append((k, f"v{rnd.randint(0, 5)}", i))
    return out


@pytest.mark.parametrize("hot_share", [0.0, 0.34])
def test_dense_key_matches_row_number(spark, hot_share):
    rows = _rows(3000, hot_share=hot_share)
    df = spark.createDataFrame(rows, "k long, s string, i long").repartition(7)
    keyed = with_dense_key(df, ["k", "s", "i"], "id", tiebreak=False)
    got = sorted((r["id"], r["k"], r["s"], r["i"]) for r in keyed.collect())
    expect = [(n + 1, *t) for n, t in enumerate(sorted(rows))]
    assert got == expect


def test_dense_key_independent_of_partitioning_and_start(spark):
    rows = _rows(1000, seed=3)
    a = with_dense_key(spark.createDataFrame(rows, "k long, s string, i long").repartition(3), ["k"], "id", start=11)
    b = with_dense_key(spark.createDataFrame(rows, "k long, s string, i long").coalesce(1), ["k"], "id", start=11)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb
    ids = sorted(r[-1] for r in ra)
    assert ids == list(range(11, 1011))


def test_dense_key_ties_get_unique_ids(spark):
    rows = [(1, "a", 0)] * 50 + [(0, "b", 1)] * 5
    keyed = with_dense_key(spark.createDataFrame(rows, "k long, s string, i long"), ["k"], "id")
    ids = [r["id"] for r in keyed.orderBy("id").collect()]
    assert ids == list(range(1, 56))
    assert keyed.where("id <= 5").agg(F.max("k")).first()[0] == 0


def _pct(values, p):
    v = np.sort(np.asarray(values, dtype=float))
    return float(np.percentile(v, p * 100, method="linear"))


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentile_cont_vs_numpy(spark, p):
    rnd = random.Random(11)
    rows = []
    for i in range(4000):
        g = "hot" if i % 3 else rnd.choice(["a", "b", None])
        v = None if i % 17 == 0 else float(rnd.choice([1, 2, 2, 3, 5, 8, 13, 21]) if g == "hot"
                                           else rnd.uniform(0, 100))
        rows.append((g, v))
    rows.append(("single", 4.5))
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: (r["pc"], r["n"]) for r in
           grouped_percentile_cont(df, ["g"], "v", p, out="pc", count_out="n").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        assert got[g][1] == len(vals)
        assert got[g][0] == pytest.approx(_pct(vals, p), rel=1e-12, abs=1e-9)


def test_percentile_several_group_columns(spark):
    rows = [(a, b, float(v)) for a in range(3) for b in range(2) for v in range(a + b + 1)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    got = {(r["a"], r["b"]): r["m"] for r in grouped_percentile_cont(df, ["a", "b"], "v", 0.5, out="m").collect()}
    for (a, b), m in got.items():
        assert m == pytest.approx(_pct(list(range(a + b + 1)), 0.5))


def test_hot_identical_rows_are_split(spark, tmpdir_path):
    """A third of the rows identical: with a Parquet input the file position splits them."""
    rows = [(7, "same")] * 3000 + [(i, f"r{i}") for i in range(6000)]
    path = tmpdir_path + "/t"
    spark.createDataFrame(rows, "k long, v string").repartition(4).write.parquet(path)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from cdmflow.functions.keys import input_position, sorted_positions
        df = spark.read.parquet(path)
        staged = sorted_positions(df, ["k", "v", *input_position(df)], "hot")
        sizes = [r[1] for r in staged.groupBy("_pos_part").count().collect()]
        assert max(sizes) < 3000 and sum(sizes) == 9000
        keyed = with_dense_key(df, ["k"], "id", file_position=True)
        ids = sorted(r[0] for r in keyed.select("id").collect())
        assert ids == list(range(1, 9001))
        assert list(keyed.columns) == ["k", "v", "id"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_dense_key_restart_by_group(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(500)], "g long, v long").repartition(5)
    keyed = with_dense_key(df, ["g", "v"], "key", restart_by=["g"])
    per: dict[int, list[tuple[int, int]]] = {}
    for r in keyed.collect():
        per.setdefault(r["g"], []).append((r["v"], r["key"]))
    for rows in per.values():
        assert [k for _, k in sorted(rows)] == list(range(1, len(rows) + 1))
