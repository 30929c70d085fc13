"""Benchmark: full registry -> CDM load plus the registry questions at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdmflow.plans import analytics as A  # noqa: E402
from cdmflow.plans import quality as Q  # noqa: E402
from cdmflow.plans.etl import run_etl  # noqa: E402
from cdmflow.session import build_session  # noqa: E402
from cdmflow.sources.registry import derived_registry  # noqa: E402
from cdmflow.sources.sinks import write_cdm, write_table  # noqa: E402
from cdmflow.sources.vocabulary import seed_concepts  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          checkpoint_dir=os.path.join(scratch, "ckpt"), app="cdmflow-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    concept = seed_concepts(spark)
    registry = derived_registry(spark, sf_dir)
    out = os.path.join(scratch, "out")

    def load():  # as the job does: the registry is staged as the import table, then loaded
        staged = write_table(registry, out, "labels", schema="import")
        return write_cdm(run_etl(staged, concept=concept, file_position=True), out)

    cdm = timed("etl_load", load)
    questions = {
        "q1_diagnosis": A.q1_patients_per_diagnosis,
        "q2_median_ferritin": A.q2_median_ferritin_by_sex,
        "q3_transfusion": A.q3_transfusion_by_diagnosis,
        "q4_comorbidity": A.q4_comorbidity_prevalence,
        "q5_chelation_no_transfusion": A.q5_chelation_without_transfusion,
        "q6_completeness": A.q6_measurement_completeness,
        "overview_counts": A.overview_counts,
        "dq_report": Q.quality_report,
    }
    for name, fn in questions.items():
        timed(name, lambda fn=fn: fn(cdm).collect())
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "registry_load_and_questions_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
