"""Plan regression checks: the shapes PLANS.md promises stay true."""

from __future__ import annotations

import contextlib
import io
import os
import re

from cdmflow.functions.keys import with_dense_key
from cdmflow.plans.analytics import q1_patients_per_diagnosis
from cdmflow.plans.etl import build_spine, event_spine, key_events, run_etl
from cdmflow.sources import sinks
from cdmflow.sources.vocabulary import seed_concepts
from helpers import reg_row, registry


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _registry(spark, n=40):
    return registry(spark, [reg_row(i, gender="Male", orpha_code_id="Beta-thalassemia", cardiac_t2=float(i),
                                    country_of_birth="Greece") for i in range(1, n + 1)])


def test_events_are_never_shuffled(spark):
    """Ids are computed on the spine: the fan-out comes after the last exchange, and nothing is range-sorted."""
    events = key_events(event_spine(build_spine(_registry(spark))), "measurement", bounds=(1, 40))
    plan = _plan(events).split("== Physical Plan ==")[1]
    tree = plan.split("\n\n\n")[0]
    assert "inline(filter(array(" in plan
    assert tree.index("Generate") < tree.index("Exchange") and tree.count("Generate") == 1
    assert "rangepartitioning" not in plan
    assert re.search(r"hashpartitioning\(_kb#\d+L?", plan)


def test_scan_prunes_and_pushes_filters(spark, tmpdir_path):
    stored = sinks.write_cdm(run_etl(_registry(spark), concept=seed_concepts(spark)),
                             os.path.join(tmpdir_path, "cdm"))
    plan = _plan(q1_patients_per_diagnosis(stored))
    assert re.search(r"PushedFilters: \[In\(condition_concept_id, \[25518,4278669,4287844\]\)", plan)
    assert "ReadSchema: struct<person_id:bigint,condition_concept_id:int>" in plan
    assert "BroadcastHashJoin" in plan


def test_dense_key_single_partition_only_on_offsets(spark):
    df = spark.range(0, 1000).selectExpr("id % 7 AS k", "id AS v")
    plan = _plan(with_dense_key(df, ["k"], "key"))
    # the only single-partition exchange feeds the running-offset window over per-partition counts
    singles = plan.count("SinglePartition")
    assert singles == 1
    assert re.search(r"hashpartitioning\(_pos_part#\d+L?, \d+\)", plan)
