"""The training-data operators: brute force, held-out accuracy, and the defined edge cases."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from datetime import date

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cdmflow.llm import (components, decontaminate, html_extract, langid, licenses, packing, pii, quality_rules, queries,
                         simhash, subword, toxicity, url_filter)
from cdmflow.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, term string"
LONG = " ".join(f"word{k % 997} and{k % 13}" for k in range(60_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, LONG, "en", "a"),
    (5, "The quick brown fox jumps over the lazy dog.", "en", "a"),
    (5, "The quick brown fox jumps over the lazy dog.", "en", "a"),
    (None, "no id at all", "xx", "b"),
    (7, "ÄÖÜ 123 – ünïcode \x85 tabs\tand\nlines", "de", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "x", "y") for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "quick brown fox"), (2, None), (3, ""), (None, "lazy dog"), (4, "never seen here")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, None), (4, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def reference_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def test_simhash_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fp = {r["doc_id"]: reference_fingerprint(r["text"]) for r in rows}
    ids = sorted(fp)
    root = groups_of(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fp[a] ^ fp[b]).bit_count() <= 4])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op2_simhash(spark, SF).collect()}
    assert got == {i: (f"{fp[i]:016x}", root[i]) for i in ids}


def test_links_lose_nothing(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 30)]
    fps = {b ^ sum(1 << int(i) for i in rng.choice(64, n, replace=False)) for b in base for n in (0, 1, 2, 3, 4, 5)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.links(df, 4).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for k, a in enumerate(signed) for b in signed[k + 1:] if ((a ^ b) & mask).bit_count() <= 4}


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and all(got[100 + k] == 100 for k in range(1, 60))


def test_simhash_edge_cases(docs, empty):
    got = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got[(2, 0)] == got[(3, 0)] == 2
    assert [v for (i, _), v in got.items() if i is None] == [None]
    assert simhash.near_duplicates(docs).count() == len(ROWS) and simhash.near_duplicates(empty).count() == 0


def test_encoder_equals_the_library():
    exact, own = Tokenizer.from_file(PATH), Encoder(PATH)
    texts = [r[1] or "" for r in ROWS] + ["  two  spaces \n here ", " a", "a ", " ", "\n", "x <|endoftext|> y", "it's 's  've",
                                          "\x1c \x1d x", "a b  c", "word " * 5 + "\r\n end"]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == exact.encode(t, add_special_tokens=False).ids, t[:50]
    long = LONG * 3
    assert np.frombuffer(own.encode(long), "<u4").tolist() == exact.encode(long, add_special_tokens=False).ids


def check_packing(rows, capacity=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_round_trip(spark):
    rows = queries.op9_packing(spark, SF).collect()
    exact = Tokenizer.from_file(PATH)
    want = []
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = exact.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        first = len(ids) - (len(ids) - 1) // 2048 * 2048
        start = 0
        for piece, end in enumerate(range(first, len(ids) + 1, 2048)):
            part = np.array(ids[start:end], dtype="<u4").tobytes()
            want.append((d["doc_id"], piece, start, end - start, zlib.crc32(part)))
            start = end
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    total = sum(w[3] for w in want)
    assert check_packing(rows) <= 1.01 * total / 2048 + 2


def test_packing_keeps_every_capacity(docs, empty):
    for rule in ("norm", "dot"):
        rows = packing.pack_documents(docs, PATH, max_documents=2, max_attention=1_000_000.0, rule=rule).collect()
        check_packing(rows)
        bins = defaultdict(list)
        for r in rows:
            if r["length"] < 2048:
                bins[r["sequence_id"]].append(r["length"])
        assert all(len(v) <= 2 and (len(v) == 1 or sum(n * n for n in v) <= 1_000_000) for v in bins.values())
        assert sorted(r["doc_id"] or 0 for r in rows if r["piece"] == 0) == sorted(r[0] or 0 for r in ROWS)
    assert packing.pack_documents(empty, PATH).count() == 0


def test_url_filter(spark):
    rows = [(1, "http://A.com/x?y=/en/"), (2, "https://www.example.com/en/1"), (3, "http://blog.example.com/en/"), (4, None),
            (5, "no scheme"), (6, "http://x.net/es/1#z"), (6, "http://x.net/es/1#z"), (7, "http://com"), (8, "http://notexample.com/en/"),
            (None, "http://x.net/fr/")]
    df = spark.createDataFrame([(*r, "h", "v") for r in rows], "page_id long, url string, host string, verdict string")
    for size in (2, 1000):  # several index blocks or one
        got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
               for r in url_filter.filter_urls(df, queries.URL_RULES, block_size=size).collect()]
        assert got[:6] == [(1, "a.com", "/x", "com/", "allow"), (2, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
                           (3, "blog.example.com", "/en/", "example.com/en/", "block"), (4, "", "", None, "allow"),
                           (5, "", "", None, "allow"), (6, "x.net", "/es/1", "net/es/", "block")]
        assert got[7:] == [(7, "com", "", None, "allow"), (8, "notexample.com", "/en/", "com/", "allow"), (None, "x.net", "/fr/", "net/fr/", "block")]
    assert url_filter.filter_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_digest_collisions_are_confirmed(tmpdir_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda key: len(key) % 2)
    files = url_filter.build_index([("a.com/", "block"), ("bb.com/", "allow"), ("c.com/", "allow")], tmpdir_path, "x")
    index = url_filter.DigestIndex(files[0].removesuffix("-digests.npy"))
    assert [index.string(i) if i >= 0 else None for i in index.find(["c.com/", "a.com/", "z.com/", "bb.com/"])] == ["c.com/", "a.com/", None, "bb.com/"]


def test_decontamination_edge_cases(docs, empty, items):
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in decontaminate.judged(docs, items).collect()]
    by = {g[0]: g[1:] for g in got}
    assert len(got) == len(ROWS) and by[1] == by[5] == (9, 5, ["1"]) and by[2] == by[3] == (0, 0, [])
    assert decontaminate.judged(empty, items).count() == 0
    assert all(r["n_hit"] == 0 for r in decontaminate.judged(docs, items.limit(0)).collect())
    clean = decontaminate.without_contaminated(docs, items)
    assert clean.columns == docs.columns and sorted(r["doc_id"] or 0 for r in clean.collect()) == [0, 2, 3, 4, 7]
    near = decontaminate.proximity_matches(docs, items, span=5)
    assert {(r["doc_id"], r["item"]) for r in near.collect() if r["item"]} == {(1, "1"), (5, "1")}


def luhn(s):
    return sum((lambda d: d - 9 if d > 9 else d)(int(c) * (2 if k % 2 else 1)) for k, c in enumerate(reversed(s))) % 10 == 0


def test_pii(spark, docs, empty):
    text = ("Mail a.b@mail.example.com or 4539578763621486, 10.200.3.44, +1 (521) 555-1234; (521) 555-1234. Born 1999-12-31, not 2001-02-30, "
            "123-45-6789 password=hunter2 4539 5787 6362 1486")
    df = spark.createDataFrame([(1, text), (2, text + " again"), (3, None), (4, ""), (5, "1.2.3 and 1999 stay")], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n"]) for r in pii.pseudonymise(df, "k", count_col="n").collect()}
    new = got[1][0]
    assert got[2][0] == new + " again" and got[3] == (None, 0) and got[4] == ("", 0) and got[5] == ("1.2.3 and 1999 stay", 0)
    for value in ("a.b@mail", "4539578763621486", "10.200.3.44", "555-1234", "1999-12-31", "123-45-6789", "hunter2", "4539 5787"):
        assert value not in new
    assert "2001-02-30" in new
    cards = re.findall(r"\b\d{16}\b", new) + [m.replace(" ", "") for m in re.findall(r"\b\d{4} \d{4} \d{4} \d{4}\b", new)]
    assert len(cards) == 2 and cards[0] == cards[1] and luhn(cards[0])
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}", new)
    assert len(phones) == 2 and phones[0] == phones[1] and "+1 (" in new
    y, m, d = map(int, re.search(r"Born (\d{4})-(\d\d)-(\d\d)", new).groups())
    assert date(1900, 1, 1) <= date(y, m, d) <= date(2099, 12, 31)
    token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
    tokens = spark.createDataFrame([(1, f'TOKEN = "{token.upper()}"'), (2, f'token = "{token}"'), (3, "A" * 40)], "doc_id long, text string")
    made = {r["doc_id"]: r["text"] for r in pii.pseudonymise(tokens, "k").collect()}
    assert token not in made[2] and made[1] == made[2].upper() and made[3] == "A" * 40
    other = pii.pseudonymise(df, "another key").filter("doc_id = 1").first()["text"]
    assert other != new
    assert pii.pseudonymise(docs, "k").columns == docs.columns and pii.pseudonymise(empty, "k").count() == 0


def test_pii_leaves_what_does_not_validate(spark):
    clean = ["10 20 30 40 50 60 70", "2019 2020 2021 2022", "1990 1991 1992 1994 1995 1996 2010 2020", "ISBN 978-3-16-148410-0", "1700000000000",
             "4539578763621487", "4539 5787 6362 1487", "GB29NWBK60161331926818", "DE89 3704 0044 0532 0130 01", "31/31/1999", "000-12-3456",
             "the secret: never give up", "1 2 3 4 5 6 7 8 9 10 11 12"]
    df = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n"]) for r in pii.pseudonymise(df, "k", count_col="n").collect()}
    assert got == {k: (t, 0) for k, t in enumerate(clean)}


def test_pii_notations(spark):
    rows = ["GB29NWBK60161331926819", "GB29 NWBK 6016 1331 9268 19", "NL91ABNA0417164300 x", "BE68 5390 0754 7034 2021", "DE89370400440532013000",
            "password: hunter", "password = hunter", "Secret: a1b2", "12/31/1999", "1/2/2020", "1.2.2020", "1850-03-04", "0050-01-01",
            "2022 4539 5787 6362 1486 and 12 4539578763621486", "3782-822463-10005", "4539578763621486 521-555-1234"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {rows[r["doc_id"]]: (r["text"], r["n"]) for r in pii.pseudonymise(df, "k", count_col="n").collect()}
    assert all(t != r and n == (2 if r[-4:] in ("1234", "1486") else 1) for r, (t, n) in got.items()), got
    text = {r: t for r, (t, _) in got.items()}
    for r, size in zip(rows, (22, 27, 18, 19, 22)):
        new = text[r][:size].replace(" ", "")
        assert new[:2] == r[:2] and int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1, new
    assert text[rows[0]] == text[rows[1]].replace(" ", "") and text[rows[3]].endswith(" 2021")
    assert text["password: hunter"].startswith("password: ") and "hunter" not in text["password = hunter"]
    m, d, y = map(int, text["12/31/1999"].split("/"))
    assert date(1900, 1, 1) <= date(y, m, d) <= date(2099, 12, 31) and re.fullmatch(r"[\d/]{10}", text["12/31/1999"])
    d, m, y = map(int, text["1/2/2020"].split("/"))
    assert date(1900, 1, 1) <= date(y, m, d) and 1700 <= int(text["1850-03-04"][:4]) < 1900 and text["0050-01-01"] < "0100"
    cards = re.fullmatch(r"2022 (\d{4} \d{4} \d{4} \d{4}) and 12 (\d{16})", text[rows[13]]).groups()
    assert cards[0].replace(" ", "") == cards[1] and luhn(cards[1]) and luhn(text[rows[14]].replace("-", ""))
    assert "4539578763621486" not in text[rows[15]] and "555-1234" not in text[rows[15]]


def test_feistel_is_a_permutation(spark):
    n = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert n.select(pii.permuted_digits("k", "t", F.col("d"))).distinct().count() == 1000


def test_quality_edge_cases(docs, empty, labels):
    rows = {r["doc_id"]: r for r in quality_rules.judged(docs, labels).collect()}
    assert rows[2]["n_words"] == rows[3]["n_words"] == 0 and rows[2]["base_failed"] and not rows[1]["kept"]
    assert quality_rules.judged(docs, labels).count() == len(ROWS) and quality_rules.judged(empty, labels).count() == 0


def test_quality_bounds_are_exact(spark):
    from math import comb, log
    cases = [(0, 1000, 0.01), (3, 1000, 0.01), (9, 1200, 0.01), (20, 5000, 0.01), (0, 5, 0.5), (50, 20000, 0.004)]
    df = spark.createDataFrame([(k, n) for k, n, _ in cases], "k long, n long")
    for row, (k, n, p) in zip(df.collect(), cases):
        got = df.filter((F.col("k") == k) & (F.col("n") == n)).select(quality_rules.log_binomial_tail(F.col("k"), F.col("n"), p)).first()[0]
        tail = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert log(tail) - 1e-9 <= got <= log(tail) + 1e-6


def test_quality_rules_control_the_risk(spark):

    rows, marks = [], []
    for k in range(4000):
        good = k % 4 > 0
        rows.append((k, " ".join(f"w{(k * 31 + j * 7 + j * j) % 9973}" for j in range(60)) + ("" if good else " " + " ".join(f"SHOUT{j * k}!!" for j in range(60))), "en"))
        marks.append((k, int(good)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int")
    out = quality_rules.judged(df, lab).join(lab, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    kept = dict(map(tuple, out))
    assert kept[1] >= 0.95 and kept[0] < 0.05, kept


def test_licenses(docs, empty, spark):
    rows = [(1, "Copyright 2020 X\nLICENSED under the Apache Licence, Version 2.0"), (2, "text\n\nReleased under the MIT License.\nmore"), (3, None)]
    got = {r["doc_id"]: (r["whole_license"], r["licenses"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("Apache-2.0", ["Apache-2.0"]), 2: (None, ["MIT"]), 3: (None, [])}
    assert licenses.scan(docs).count() == len(ROWS) and licenses.scan(empty).count() == 0


def test_licenses_whole_texts(spark):
    import textwrap

    from cdmflow.llm import license_texts
    whole = dict(reversed(license_texts.texts()))  # the first text of each name
    mit, isc, bsd = whole["MIT"], whole["ISC"], whole["BSD-3-Clause"]
    wrapped = lambda t, w=72, pre="": textwrap.fill(t, w, initial_indent=pre, subsequent_indent=pre)
    read = lambda name: open(f"{os.path.dirname(license_texts.__file__)}/{name}.txt", encoding="utf-8").read()
    isc_file = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or\nwithout fee is hereby granted, "
                "provided that the above\ncopyright notice and this permission notice appear in all copies.")
    rows = [(1, "MIT License\n\nCopyright (c) 2020 X\n\n" + wrapped(mit)), (2, "/*\n" + wrapped("Copyright 2020 X. " + "", 72, " * ") + "\n * \n" + wrapped(mit, 60, " * ") + "\n */\ncode();"),
            (3, "Copyright The Authors\n" + isc_file), (4, "intro\n" + wrapped(isc, 50) + "\nmore"), (5, "# x\n" + wrapped(bsd, 64, "# ")),
            (6, read("Apache-2.0")), (7, "see\n\n" + read("GPL-3.0") + "\nend"),
            (8, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nx"),
            (9, wrapped(whole["MPL-2.0"], 60, "// ") + "\nx"), (10, "no warranty at all, mozilla"),
            (11, "y\n" + read("LGPL-2.1")), (12, "y\n" + read("MPL-2.0"))]
    got = {r["doc_id"]: (r["whole_license"], r["licenses"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("MIT", ["MIT"]) and got[2][1] == ["MIT"] and got[3] == ("ISC", ["ISC"]) and got[4][1] == ["ISC"] and got[5][1] == ["BSD-3-Clause"]
    assert got[6] == ("Apache-2.0", ["Apache-2.0"]) and "GPL-3.0" in got[7][1] and got[8][1] == ["Apache-2.0", "GPL-2.0-only", "MIT"]
    assert got[9][1] == ["MPL-2.0"] and got[10] == (None, []) and "LGPL-2.1" in got[11][1] and "MPL-2.0" in got[12][1]


def test_html(spark):
    same = "<p>Subscribe now</p>"
    pages = [(k, f"http://h.com/{k}", f"<body><div class=x>{same}</div><div class=y><p>story {k} of &amp; many</p></div></body>") for k in range(12)]
    pages += [(20, None, None), (21, "http://a.b/", ""), (22, "http://a.b/", "<nav>m</nav><article><h1>T</h1><p>one <b>two</b>\n three<br>4<form>f</form>"
              "<div class='comments'>c</div></article><footer>z</footer>"), (22, "u", "<p>a<p>b<script>if (a<b) '</p>'</script>")]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, text string")
    rows = html_extract.extract(df).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["page_id"]].append(r["text"])
    assert by[3] == ["story 3 of & many"] and by[20] == by[21] == [""] and sorted(by[22]) == ["T one two three 4", "a b"]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_text_after_raw_elements_stays():
    for page in ('<p>a</p><video-player src="x"></video-player><p>rest</p>', '<p>a <svg class="i"/></p><p>rest</p>',
                 '<p>a</p><math/><p>rest</p>', "<p>a</p><svg-icon></svg-icon><select-box/><title-bar></title-bar><p>rest</p>",
                 '<p>a</p><svg viewBox="0 0 1 1"><path d="x"/><text>no</text></svg><video src="x">no</video><p>rest</p>'):
        assert html_extract.main_text(page) == "a rest", page


def test_html_class_words_do_not_condemn_the_article(spark):
    inner = "<header class='entry-header'><h1>T</h1></header><p>one</p><div class='comments'>c</div><div class='ad-slot'>a</div>"
    for page in (f'<main class="has-sidebar">{inner}</main>', f'<div id="page" class="no-header"><article>{inner}</article></div>',
                 f'<article class="post comments-open">{inner}</article>', f'<div class="side-by-side"><article>{inner}</article></div>',
                 f'<div class="search"><main class="widget"><article>{inner}</article></main></div>',
                 f'<article>{inner}</article><div class="related"><article>other</article></div>',
                 "<div class='has-sidebar'><h1>T</h1><p>one</p></div><div class='sidebar-left'>s</div>"):
        assert html_extract.main_text(page) == "T one", page
    assert html_extract.main_text('<article><header class="header">T</header>x</article>') == "T x"
    pages = [(k, "http://h.com/", f"<article><p>story {k}</p><div class='entry-share'>Tell your friends</div></article>") for k in range(9)]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: f"story {k}" for k in range(9)}


def test_html_tree_over_marked_and_unmarked_pages(spark):
    bar = "<div class=x><p>Our best offers</p></div>"
    pages = [(k, f"http://h.com/{k}", f"<body>{bar}<div class=lead><p>lead {k}</p></div><article><p>same</p></article><nav>n{k}</nav></body>")
             for k in range(12)]
    pages += [(k, f"http://h.com/{k}", f"<body>{bar}<div class=y><p>story {k}</p></div></body>") for k in range(20, 24)]
    pages += [(30, "http://few.com/", "<body><div class=lead>lead</div><article>text</article></body>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    nodes = {r["path"]: (r["pages"], r["importance"]) for r in html_extract.importance(
        html_extract.tree_rows(df, "html", "url")).filter("host = 'h.com'").collect()}
    assert nodes["/body/div.x/p"] == (16.0, 0.0) and nodes["/body/article/p"] == (12.0, 0.0) and nodes["/body/nav"][0] == 12.0
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got[5] == "lead 5 same" and got[22] == "story 22" and got[30] == "text"


def test_html_against_the_marked_articles(spark):
    import html
    got = {r["page_id"]: r["text"] for r in queries.op4_html(spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        assert got[p["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op3_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert found.filter("lang = lang_pred").count() / found.count() >= 0.98


def test_language_edge_cases(docs, empty):
    model = langid.trained(docs)
    rows = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert rows[2]["lang_pred"] == rows[3]["lang_pred"] == "und" and rows[2]["score"] == 0.0 and not rows[2]["accepted"]
    assert langid.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, langid.trained(empty)).collect()} == {"und"}


def test_words_without_a_letter():
    assert [subword.clean(w) for w in ("½", "x²", "12²3", "«Wort»", "4.5", "a1b")] == ["", "x²", "", "Wort", "", "a1b"]


def test_toxicity_of_a_few_mislabelled_texts():
    clean = [f"green {w} meadow" for w in ("ab", "cd", "ef", "gh") for _ in range(30)]
    texts = clean + ["green ab meadow moron"] * 27 + ["green ab meadow"] * 3
    model = toxicity.fit(texts, np.array([0] * 120 + [1] * 30))
    margin = toxicity.text_margins(["meadow ab", "what a moron"], lambda w: model.word_logits(w)[:, 1] - model.word_logits(w)[:, 0])
    score = 1 / (1 + np.exp(-(model.platt[0] * margin + model.platt[1])))
    assert score[0] < toxicity.THRESHOLD <= score[1]


def test_toxicity_learns_words_and_their_misspellings():
    rng = np.random.default_rng(1)
    texts, marks = [], []
    for k in range(600):
        words = [f"{rng.choice(['ab', 'cor', 'tel'])}{rng.choice(['an', 'ist', 'ure'])}{rng.choice(['es', 'o', 'en'])}" for _ in range(40)]
        if k % 3 == 0:
            words[int(rng.integers(40))] = str(rng.choice(["worthless", "pathetic"]))
        texts.append(" ".join(words))
        marks.append(int(k % 3 == 0))
    model = toxicity.fit(texts, np.array(marks))
    clean, bad = texts[1], texts[1] + " you are pathetik and worthles "
    margin = toxicity.text_margins([clean, bad, None, "", bad + " " + clean * 50], lambda w: (model.word_logits(w)[:, 1] - model.word_logits(w)[:, 0]))
    score = 1 / (1 + np.exp(-(model.platt[0] * margin + model.platt[1])))
    assert score[0] < 0.3 <= min(score[1], score[4]) and np.isneginf(margin[2]) and np.isneginf(margin[3])


def test_toxicity_edge_cases(docs, empty, labels):
    assert toxicity.trained(docs, labels.limit(0)) is None
    none = toxicity.score(docs, None, out_col="score")
    assert sorted(none.columns) == sorted(docs.columns) and {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.score(empty, None).count() == 0


def test_subword_batches_cover_long_texts(monkeypatch):
    monkeypatch.setattr(subword, "_BATCH", 1000)
    texts = [None, "", "12 34 !!", LONG[:20_000], "one two."]
    count = np.zeros(len(texts), dtype=int)
    for words, at, rows in subword.batches(texts):
        count += np.bincount(rows, minlength=len(texts))
        assert all(words[k] for k in at)
    assert count.tolist() == [0, 0, 0, len(LONG[:20_000].split()), 2]


def test_pipeline_stages(spark, docs):
    frame = docs.select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.simhash_stage(spark, frame, SF)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 4, 7]
    out = corpus_pipeline.pii_stage(spark, frame, SF)
    assert out.columns == frame.columns and out.count() == len(ROWS)


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    bad = {r["doc_id"] for r in queries.op6_decontaminate(spark, SF).filter("contaminated").collect()}
    groups = defaultdict(set)
    for r in queries.op2_simhash(spark, SF).collect():
        groups[r["component_id"]].add(r["doc_id"])
    assert ids and not ids & bad and all(len(ids & g) <= 1 for g in groups.values())
    check_packing(rows)


def test_sql_oracles():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert subprocess.run([sys.executable, f"{root}/tools/oracle_check.py", SF, *queries.ORACLE], timeout=600).returncode == 0
