"""Texts made to stall or crash an operator, for every operator and stage; clashing names; no size switches."""

from __future__ import annotations

import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cdmflow.llm import (decontaminate, html_extract, langid, licenses, packing, pii, quality_rules, simhash, suffix_dedup,
                         toxicity)
from cdmflow.llm.common import stage

SIZE = 1_000_000
PATTERNS = {
    "mail": "a@" + "b." * (SIZE // 2), "mails": "a@b." * (SIZE // 4), "spdx": "SPDX-License-Identifier: A" + " OR A" * (SIZE // 5),
    "tags": "<a " * (SIZE // 3), "quotes": "<a \"" * (SIZE // 4), "word": "a" * SIZE, "digits": "7" * SIZE, "lines": "\n" * SIZE,
    "groups": "1234 " * (SIZE // 5), "key": "password=" * (SIZE // 9), "comments": "<!--" * (SIZE // 4), "scripts": "<script " * (SIZE // 8),
}


@pytest.fixture(scope="module")
def hostile(spark):
    rows = [(k, t, "en", "web", len(t)) for k, t in enumerate(PATTERNS.values())]
    return stage(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8), "hostile")


@pytest.fixture(scope="module")
def tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "quick brown fox"), (2, "1234 1234 1234")], "item_id long, text string")
    return labels, items


@pytest.mark.parametrize("name", ["pii", "licenses", "quality", "simhash", "language", "toxicity", "decontaminate", "packing", "repeats"])
def test_a_megabyte_of_anything(spark, hostile, tables, name):
    labels, items = tables
    run = {
        "pii": lambda: pii.pseudonymise(hostile, "k"), "licenses": lambda: licenses.scan(hostile),
        "quality": lambda: quality_rules.judged(hostile, labels), "simhash": lambda: simhash.near_duplicates(hostile),
        "language": lambda: langid.predict(hostile, langid.trained(hostile)),
        "toxicity": lambda: toxicity.score(hostile, toxicity.trained(hostile, labels)),
        "decontaminate": lambda: decontaminate.judged(hostile, items),
        "packing": lambda: packing.pack_documents(hostile, public_tokenizers.path("byte_bpe_50k.json")).filter("piece = 0"),
        "repeats": lambda: suffix_dedup.remove_repeats(hostile.filter("doc_id NOT IN (5, 6, 7)"), 200),
    }[name]
    begin = time.time()
    found = run().select("doc_id").collect()
    assert len(found) == len(PATTERNS) - 3 * (name == "repeats") and time.time() - begin < 120


def test_pages_of_broken_markup_take_linear_time():
    for text in PATTERNS.values():
        begin = time.process_time()
        html_extract.main_text(text)
        assert time.process_time() - begin < 15
    many = "<a " + " ".join(f'x{k}="{k}"' for k in range(60))  # quoted attributes of a tag that never ends
    begin = time.process_time()
    assert html_extract.main_text(many + "<p>text</p>").endswith("text") and time.process_time() - begin < 1


def test_pages_inside_a_form_keep_their_text():
    article = "<article><p>one</p><form>f</form></article>"
    assert html_extract.main_text(f"<form action=x><nav>m</nav>{article}</form>") == "one"
    assert html_extract.main_text("<form><nav>m</nav><p>one</p><p>two</p></form>") == "one two"
    assert html_extract.main_text("<p>one</p><form>f</form>") == "one"
    assert html_extract.main_text("<article>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</article>") == "a x=2 b"


def test_the_style_tree_has_no_least_number_of_pages(spark):
    def texts(n):
        pages = [(k, f"http://h{n}.com/{k}", f"<body><div>Home News</div><section><p>story {k}</p></section></body>") for k in range(n)]
        rows = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
        return {r["text"].replace(str(r["page_id"]), "N") for r in rows}
    assert [texts(n) for n in (6, 7, 8, 9)] == [{"story N"}] * 4 and texts(1) == {"Home News story N"}


def test_columns_of_the_caller_survive(spark):
    rows = [(1, "mail a.b@example.com now", "x", "y", "z"), (2, "plain", None, "y", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _matches string, _renamed string, _d string")
    out = {r["doc_id"]: r for r in pii.pseudonymise(df, "k").collect()}
    assert out[1]["_matches"] == "x" and out[1]["_renamed"] == "y" and "a.b@" not in out[1]["text"] and out[2]["_matches"] is None
    docs = spark.createDataFrame([(1, "same text here now", "u", "v"), (2, "same text here now", "u", "v"), (None, None, None, None)],
                                 "doc_id long, text string, _d string, _toxicity string")
    assert sorted(map(tuple, corpus_pipeline.simhash_stage(spark, docs, "").collect()), key=str) == [
        (1, "same text here now", "u", "v"), (None, None, None, None)]


def test_social_security_pseudonyms_are_issuable(spark):
    df = spark.createDataFrame([(k, f"{100 + k % 500:03d}-{10 + k % 80:02d}-{1000 + k:04d}") for k in range(600) if 100 + k % 500 != 666]
                               + [(9000 + k, f"9{k:02d}-70-{1000 + k}") for k in range(99)], "doc_id long, text string")
    made = [(r["doc_id"], r["text"]) for r in pii.pseudonymise(df, "k").collect()]
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}" if k < 9000 else r"9\d\d-(?!00)\d\d-(?!0000)\d{4}", t) for k, t in made)
    assert len({t for _, t in made}) == len({r["text"] for r in df.collect()})


def test_long_texts_are_learnt_from(spark):
    rng = np.random.default_rng(3)
    words = {"de": ["straße", "schön", "nicht", "werden"], "fr": ["été", "être", "garçon", "rue"]}
    rows = [(k, " ".join(rng.choice(words[lang], 12_000 if lang == "fr" else 40)), lang) for k, lang in enumerate(["de", "fr"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.trained(docs).classes == ["de", "fr"]
    clean = [f"w{int(x)}" for x in rng.integers(0, 3000, 9000)]
    texts = [(k, " ".join(clean[k:k + 6000] + (["moron"] if k % 2 else [])), k % 2) for k in range(80)]
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    assert toxicity.trained(df.drop("toxic"), df.drop("text")) is not None
    assert langid.draw_words("a b", 1) == ["a", "b"] and len(langid.draw_words("wort " * 5000)) == langid.BAG


def test_a_callers_own_texts_are_found_anywhere(spark):
    known = [("House-1.0", "Use it freely inside this house."), ("Tiny", "Do as you like."), ("Empty", "--")]
    rows = [(1, "intro text. Use it\n # freely inside\n\nthis house. more"), (2, "You may do as you LIKE, always"), (3, "use it freely inside that house"),
            (4, "x\n\x01 do as\tyou like\x01y"), (5, None)]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    assert got == {1: ["House-1.0"], 2: ["Tiny"], 3: [], 4: ["Tiny"], 5: []}
    assert licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), []).filter("size(licenses) > 0").count() == 0
    words = licenses.marks(["alpha betagamma", "betagamma delta", "x"])
    assert words[0] == "betagamma" and set(words) == {"betagamma", "x"}
