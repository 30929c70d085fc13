"""Hard negatives, repeated substrings and centroid clustering: brute force and the defined edge cases."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdmflow.llm import centroids, common, hard_negatives, queries, suffix_dedup

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, row string, q int, cluster int"


def cut_by_brute_force(texts, length, keep_first):
    found = defaultdict(list)
    for k, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            found[text[i:i + length]].append((k, i))
    gone = [bytearray(len(t)) for t in texts]
    for places in found.values():
        if len(places) > 1:
            for k, i in places[1:] if keep_first else places:
                gone[k][i:i + length] = b"\1" * length
    return [bytes(c for c, g in zip(t, m) if not g) for t, m in zip(texts, gone)]


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeats_equal_brute_force(spark, keep_first):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeé ñ\n"), int(rng.integers(2, 9)))) for _ in range(60)]
    shared = [" ".join(rng.choice(words, 30)) for _ in range(4)]
    texts = ["", "short", "x" * 3000, "ab" * 900]
    for k in range(60):
        body = " ".join(rng.choice(words, int(rng.integers(5, 120))))
        middle = shared[k % 4] if k % 3 else shared[0][:int(rng.integers(20, 150))]
        texts.append(body + middle + " ".join(rng.choice(words, 20)) + (middle if k % 7 == 0 else ""))
    texts += texts[10:14] + [texts[20].replace("a", "b", 3)]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, bytes string")
    for limit in (4096, 3):  # by suffix order, and window by window for frequent hashes
        was, suffix_dedup.MAX_GROUP = suffix_dedup.MAX_GROUP, limit
        try:
            rows = suffix_dedup.remove_repeats(df, 40, keep_first, anchor_length=16).collect()
        finally:
            suffix_dedup.MAX_GROUP = was
        got = {r["doc_id"]: bytes(r["kept"]) for r in rows}
        want = cut_by_brute_force([t.encode() for t in texts], 40, keep_first)
        assert [k for k, w in enumerate(want) if got[k] != w] == []
        assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) for r in rows)


def test_repeats_of_the_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r["text"] or "").encode() for r in rows]
    want = {r["doc_id"]: (len(t), len(t) - len(k), hashlib.sha256(k).hexdigest())
            for r, t, k in zip(rows, texts, cut_by_brute_force(texts, 200, False))}
    got = queries.op12_suffix_dedup(spark, SF).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    assert all((r["n_spans"] > 0) == (r["n_removed"] > 0) for r in got)


def test_factors_are_the_longest_earlier_matches():
    rng = np.random.default_rng(2)
    for size, alphabet in ((60, 2), (300, 3), (200, 1)):
        text = rng.integers(0, alphabet, size).astype(np.uint8)
        keys = np.zeros((size, size), np.uint8)
        for i in range(size):
            keys[i, :size - i] = text[i:]
        length, source = suffix_dedup.factors(keys, size - np.arange(size), np.arange(size), 1)
        for i in range(size):
            best = 0
            for j in range(i):
                n = 0
                while i + n < size and text[j + n] == text[i + n]:
                    n += 1
                best = max(best, n)
            assert length[i] == best
            assert best == 0 or (source[i] < i and (text[source[i]:source[i] + best] == text[i:i + best]).all())


def test_repeats_edge_cases(spark):
    line = "the same passage again and again " * 10
    rows = [(1, line), (1, line), (None, line), (None, None), (5, ""), (6, "a" * 199), (7, "a" * 201), (8, "b" * 200), (9, "ü" * 150)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int")
    every = sorted(((r["doc_id"] or 0), r["n_bytes"], len(r["kept"])) for r in suffix_dedup.remove_repeats(df, 200, False).collect())
    assert every == [(0, 0, 0), (0, 330, 0), (1, 330, 0), (1, 330, 0), (5, 0, 0), (6, 199, 199), (7, 201, 0), (8, 200, 200), (9, 300, 0)]
    first = {(r["doc_id"], r["n_bytes"]): len(r["kept"]) for r in suffix_dedup.remove_repeats(df, 200, True).collect()}
    assert first[(1, 330)] == 33 and first[(None, 330)] == 0 and first[(7, 201)] == 1 and first[(8, 200)] == 200
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 1000)
    texts = ["".join(rng.choice(list("abcdefgh"), 5000)) for _ in range(3)]
    texts.append(texts[0][700:1400] + texts[1][:300])
    import pyarrow as pa
    column = pa.array([t.encode() for t in texts], pa.binary())
    seen = defaultdict(list)
    for data, ends, rows, starts in suffix_dedup._pieces(column, 50):
        for a, n, _, _ in zip(*suffix_dedup.runs(data, ends, 50, 16)):
            k = int(np.searchsorted(starts, a, "right")) - 1
            seen[int(rows[k])] += range(int(a - starts[k]), int(a - starts[k] + n))
    assert all(sorted(seen[k]) == list(range(len(t) - 49)) for k, t in enumerate(texts))


def test_heavy_join_equals_a_join(spark):
    left = spark.createDataFrame([(0 if k % 3 else k, k) for k in range(3000)], "a long, v long")
    right = left.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"))
    got = sorted(map(tuple, common.heavy_join(left, right, ["a"], "n").select("a", "v", "least").collect()))
    assert got == sorted(map(tuple, left.join(right, "a").select("a", "v", "least").collect())) and len(got) == 3000
    assert common.heavy_join(left.limit(0), right.limit(0), ["a"], "n").count() == 0


def vectors_with_trouble(spark, rows):
    rng = np.random.default_rng(4)
    made = [(k, [float(x) for x in rng.normal(0, .3, 64)], int(rng.integers(0, 4)), "r", 1, 2) for k in range(rows)]
    made += [made[7], made[7], (None, made[3][1], 1, None, None, None), (900, None, 1, "", 0, 0), (901, [], 1, "", 0, 0),
             (902, made[0][1][:63], 1, "", 0, 0), (903, [float("nan")] + made[0][1][1:], 1, "", 0, 0),
             (904, [float("inf")] + made[0][1][1:], 2, "", 0, 0), (905, [None] + made[0][1][1:], 2, "", 0, 0), (906, made[1][1], None, "", 0, 0)]
    return made, spark.createDataFrame(made, VECTORS)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_LANES", 5)
    monkeypatch.setattr(hard_negatives, "PACK", 3)
    made, df = vectors_with_trouble(spark, 150)
    good = [(i, [math.floor(256 * np.float32(x).astype(float)) for x in v], label) for i, v, label, *_ in made
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda s, i: (-s, i is None, i or 0)
    want = []
    for a, (i, v, label) in enumerate(good):
        if i is None or i % 10:
            continue
        score = [(int(np.dot(v, w)), j, m) for b, (j, w, m) in enumerate(good) if b != a and len(w) == len(v)]
        positives = sorted((x for x in score if x[2] == label), key=lambda x: key(x[0], x[1]))[:5]
        others = sorted((x for x in score if x[2] != label), key=lambda x: key(x[0], x[1]))
        for p, j, _ in positives:
            inside = [x for x in others if 80 * p <= 100 * x[0] <= 100 * p][:5]
            want += [(i, j, r + 1, x[1], p, x[0]) for r, x in enumerate(inside)]
    got = [tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 100
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(df, F.col("vec_id") < 0).count() == 0


def test_the_scan_drops_candidates_before_the_last_column():
    rng = np.random.default_rng(6)
    columns = rng.integers(-60, 60, (64, 3000))
    anchor = np.where(np.arange(64) < 8, 100, 1) * rng.choice([-1, 1], 64)
    seen = []
    rule = hard_negatives.can_be_best(5)

    def counted(low, high):
        alive = rule(low, high)
        seen.append(int(alive.sum()))
        return alive
    rows, score = hard_negatives.vertical_scan(columns, anchor, np.arange(3000), counted)
    best = np.sort(anchor @ columns)[-5:]
    assert seen[0] < 3000 and np.array_equal(np.sort(score)[-5:], best)


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-3000, 3000, (500, 64)), rng.integers(-3000, 3000, (8, 64))
    c[5] = c[2]  # a tie
    order = centroids.coarse_to_fine(64)
    hx, hc = centroids.walsh_hadamard(x)[:, order], centroids.walsh_hadamard(c)[:, order]
    assert sorted(order) == list(range(64)) and (centroids.walsh_hadamard(centroids.walsh_hadamard(x)) == 64 * x).all()
    exact = ((x[:, None] - c) ** 2).sum(axis=2)
    to, distance, read = centroids.nearest(hx, hc)
    assert (to == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all() and 5 not in to
    near = c[rng.integers(0, 5, 400)] + rng.integers(-9, 9, (400, 64))
    to, distance, read = centroids.nearest(centroids.walsh_hadamard(near)[:, order], hc)
    assert (distance == ((near[:, None] - c) ** 2).sum(axis=2).min(axis=1)).all() and read < 400 * 8 * 64 / 2


def test_centroid_edge_cases(spark):
    made, df = vectors_with_trouble(spark, 40)
    rows = centroids.cluster(df, rounds=2).collect()
    ids = sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in rows)
    assert ids == sorted([(False, k) for k in range(40)] + [(False, 7)] * 2 + [(True, 0), (False, 906)])
    assert rows[0]["inertia"] == sum(r["distance"] for r in rows)
    few = centroids.cluster(df.filter("vec_id < 3")).collect()
    assert len(few) == 3 and {r["distance"] for r in few} == {0} and len({r["cluster"] for r in few}) == 3
    assert centroids.cluster(df.limit(0)).count() == 0 and centroids.cluster(df.filter("vec_id = 903")).count() == 0
    assert centroids.cluster(df.filter("vec_id IS NULL"), rounds=1).count() == 1
