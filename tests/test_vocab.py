"""Vocabulary operators on a hand-written hierarchy."""

from __future__ import annotations

import datetime as dt

from cdmflow.operators import vocab as V
from cdmflow.schemas import CONCEPT, CONCEPT_RELATIONSHIP


def test_closure_and_rollup(spark):
    top = spark.createDataFrame([(1, 10), (1, 11)], "parent int, child int")
    low = spark.createDataFrame([(10, 100), (10, 101), (11, 110)], "parent int, child int")
    anc = V.closure_from_levels([top, low])
    got = {(r[0], r[1]): r[2] for r in anc.select("ancestor_concept_id", "descendant_concept_id",
                                                  "min_levels_of_separation").collect()}
    assert got[(1, 100)] == 2 and got[(10, 101)] == 1 and got[(110, 110)] == 0 and (11, 100) not in got
    assert len(got) == 6 + 5 + 3  # self rows, direct edges, two-step paths
    facts = spark.createDataFrame([(7, 100), (7, 100), (8, 110), (9, 101)], "person int, c int")
    wanted = spark.createDataFrame([(1,), (10,)], "concept_id int")
    res = {r["ancestor_concept_id"]: (r["n_records"], r["n_persons"])
           for r in V.descendant_rollup(facts, "c", "person", anc, wanted).collect()}
    assert res == {1: (4, 3), 10: (3, 2)}
    spec = {r["concept_id"]: r["n_more_specific_used"]
            for r in V.less_specific_use(spark.createDataFrame([(1,), (10,), (100,)], "c int"), "c", anc).collect()}
    assert spec == {1: 2, 10: 1}


def test_map_to_standard_and_checks(spark):
    d0, d1 = dt.date(1970, 1, 1), dt.date(2099, 12, 31)
    rel = spark.createDataFrame([
        (5, 50, "Maps to", d0, d1, None),
        (6, 60, "Maps to", d0, dt.date(2020, 1, 1), "D"),   # deprecated
        (7, 70, "Is a", d0, d1, None),                      # other relationship
    ], CONCEPT_RELATIONSHIP)
    facts = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (4, 5)], "p int, src int")
    mapped = {r["p"]: r["standard_concept_id"] for r in V.map_to_standard(facts, "src", rel, at="2026-05-12").collect()}
    assert mapped == {1: 50, 2: 0, 3: 0, 4: 50}
    concept = spark.createDataFrame([
        (50, "fifty", "Condition", "V", "C", None, "50", d0, dt.date(2000, 1, 1), None),
        (60, "sixty", "Drug", "V", "C", "S", "60", d0, d1, None),
    ], CONCEPT)
    ev = spark.createDataFrame([(50, dt.date(2010, 1, 1)), (60, dt.date(2010, 1, 1)), (0, dt.date(2010, 1, 1))],
                               "c int, d date")
    assert [r["concept_id"] for r in V.non_standard_use(ev, "c", concept).collect()] == [50]
    assert [(r["concept_id"], r["n"]) for r in V.expired_use(ev, "c", "d", concept).collect()] == [(50, 1)]
    assert [r["concept_id"] for r in V.domain_mismatch(ev, "c", concept, "Condition").collect()] == [60]
