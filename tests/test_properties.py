"""Property checks (hypothesis): both key strategies equal a plain sort-and-number."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from cdmflow.functions.keys import id_bucket_width, rule_offsets, with_dense_key, with_event_ids

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(1, 60), st.sampled_from(["a", "b", "c"])),
                min_size=0, max_size=80)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=ROWS, start=st.integers(1, 1000), low=st.integers(-3, 1))
def test_event_ids_match_sort(spark, rows, start, low):
    """Ids in (rule, id) order, repeated ids and all, the numbering restarting at rule 2."""
    df = spark.createDataFrame(rows, "g int, i long, v string")
    fires = [F.col("g") > 0, F.lit(True), F.col("v") == "a"]
    holds = [lambda r: r[0] > 0, lambda r: True, lambda r: r[2] == "a"]
    width = id_bucket_width(spark, 64, buckets=5)
    offsets = rule_offsets(df, fires, "i", low, width, restart=[0, 2])
    got = [(tuple(r)[:3], r["_event_ids"]) for r in with_event_ids(df, fires, offsets, "i", low, width, start).collect()]
    assert sorted(r for r, _ in got) == sorted(rows)
    done = 0
    for k, hold in enumerate(holds):
        done = 0 if k == 2 else done
        kept = sorted((ids[k], r[1]) for r, ids in got if hold(r))
        assert [n for n, _ in kept] == list(range(start + done, start + done + len(kept)))
        assert [i for _, i in kept] == sorted(i for _, i in kept)
        done += len(kept)


@SETTINGS
@given(rows=ROWS)
def test_dense_key_matches_sort_with_duplicates(spark, rows):
    df = spark.createDataFrame(rows, "g int, i long, v string")
    keyed = with_dense_key(df, ["g", "i"], "k")
    got = sorted((r["k"], r["g"], r["i"], r["v"]) for r in keyed.collect())
    assert [k for k, *_ in got] == list(range(1, len(rows) + 1))
    assert [t[1:] for t in got] == sorted(rows)


PCT_ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                              st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e3, 1e3))),
                    min_size=1, max_size=60)


@SETTINGS
@given(rows=PCT_ROWS, p=st.sampled_from([0.0, 0.1, 0.5, 0.75, 1.0]))
def test_percentile_cont_matches_numpy(spark, rows, p):
    import numpy as np
    from cdmflow.operators.median import grouped_percentile_cont
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["pc"], r["n"]) for r in grouped_percentile_cont(df, ["g"], "v", p, "pc", "n").collect()}
    groups: dict = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        expect = float(np.percentile(np.array(vals), p * 100, method="linear"))
        assert got[g][1] == len(vals)
        assert abs(got[g][0] - expect) <= 1e-9 * max(1.0, abs(expect))
