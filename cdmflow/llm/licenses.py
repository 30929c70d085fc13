r"""Licence scan by canonical digests, in DataFrame operations only.

A text is put into canonical form: A-Z lower-cased, copyright lines left out, equivalent spellings made one,
everything but letters and digits turned into single spaces. The SHA-256 digest of the canonical form is
hash-joined to the digests of the known licences. Entire texts are looked up: the whole document, every
paragraph (between blank lines) and every line, so a licence notice inside a document is found too; one canonical
form of the text serves them all. A known text that begins or ends within a line, or spans paragraphs, is looked for
anywhere in the canonical form of the documents that hold a mark of it (a part of a longer one found there does not
count): marks are a few long words, chosen so that every
known text holds one. ``SPDX-License-Identifier`` lines name their licences themselves.

The looked-up side is the documents' units, which are never shuffled as long as the known digests fit a
checked broadcast (``BROADCAST`` rows); beyond that the join shuffles digests, not texts, and repeated units
(a notice in a third of all documents) are split by adaptive skew handling.

Defined cases: null and empty texts have the digest of the empty text and no licence; a known text that is
empty in canonical form is left out; more than ``BROADCAST`` known texts are looked up as units only; repeated rows are
judged one by one; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmflow.llm.common import stage
from cdmflow.llm.license_texts import texts

BROADCAST = 100_000
# ``copyright`` and a year, (c) or an owner; not a wrapped line of a licence that happens to begin with the word
COPYRIGHT_LINE = (
    r"^[ \t>#*/;-]*(copyright[ \t:,]*(\(c\)|©|&copy;|[0-9<\[{]|(?!(notices?|holders?|owners?|laws?|licen[cs]es?|statements?|"
    r"interests?|treat(y|ies)|rights?|disclaimer|protection|and|or|to|in|of|on|for|is|as|under|the (work|software|program|library))\b)[^\s.,;:)])"
    r"|\(c\)[ \t]*(copyright|[0-9]{4})|©)")
# Spellings that licences use for the same thing, the second one kept.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("http://", "https://"),
    ("&", " and "),
]
# Known licence notices and short licences, and the whole texts of common licences.
KNOWN = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted."),
    *texts(),
]
_SPDX_ID = r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*"
_SPDX = rf"(?i)SPDX-License-Identifier:[ \t]*({_SPDX_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_ID})*+)"  # possessive: read in a loop, however long


_GAP = "\x01"  # stands for a blank line while a text is put into canonical form
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _GAP, "abcdefghijklmnopqrstuvwxyz ")


def _lines_in_form(text: Column) -> Column:
    """The text in canonical form but for its line breaks, with ``_GAP`` between paragraphs."""
    gapped = F.regexp_replace(F.translate(text, *_LOWER), r"\n[ \t]*\n", f"\n{_GAP}\n")
    flat = F.array_join(F.filter(F.split(gapped, "\n"), lambda x: ~x.rlike(COPYRIGHT_LINE)), "\n")
    for other, kept in SPELLINGS:
        flat = F.replace(flat, F.lit(other), F.lit(kept))
    return F.regexp_replace(flat, r"[\x00\x02-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def _flat(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, f"[ \n{_GAP}]+", " "))


def canonical(text: Column) -> Column:
    return _flat(_lines_in_form(text))


def marks(forms: list[str]) -> list[str]:
    """Words of which every canonical known text holds one: few, and long ones where there is a choice."""
    left = [set(f.split()) for f in forms if f]
    found = []
    while left:
        words = {w for f in left for w in f}
        best = max(words, key=lambda w: (min(len(w), 8), sum(w in f for f in left), w))
        found.append(best)
        left = [f for f in left if best not in f]
    return found


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """(digest, license) of the known texts; two names of one text: the first in order."""
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    return (texts.filter(canonical(F.col("text")) != "").select(digest(F.col("text")).alias("digest"), "license")
            .groupBy("digest").agg(F.min("license").alias("license")))


def _spdx_names(text: Column) -> Column:
    """The licences named by ``SPDX-License-Identifier`` lines, exceptions left out."""
    stated = F.transform(F.regexp_extract_all(text, F.lit(_SPDX), F.lit(1)), lambda e: F.regexp_extract_all(
        F.regexp_replace(e, r"(?i)[ \t]+WITH[ \t]+[(]*[A-Za-z0-9.+-]+", ""), F.lit("[A-Za-z0-9][A-Za-z0-9.+-]*"), F.lit(0)))
    return F.filter(F.flatten(stated), lambda x: ~F.upper(x).isin("AND", "OR"))


def contained(docs: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    """(id, _text, unit_license) of the known texts that stand anywhere in the form ``f`` of a text, however wrapped;
    not of those that are a part of a longer one found there.

    ``known`` has canonical texts and fits on the driver (``BROADCAST`` rows); only documents that hold a mark of a
    known text are compared with it."""
    rows = [(r["license"], r["form"]) for r in known.collect()]
    if not rows:
        return docs.select(id_col, "_text", F.lit("").alias("unit_license")).limit(0)
    words = marks([f for _, f in rows])
    by_mark = [(next(w for w in words if w in f.split()), name, f" {f} ") for name, f in rows]
    table = docs.sparkSession.createDataFrame(by_mark, "mark string, unit_license string, form string")
    held = F.filter(F.array(*map(F.lit, words)), lambda w: F.col("f").contains(w))
    hay = (docs.filter(F.greatest(*[F.col("f").contains(w) for w in words], F.lit(False)))
           .select(id_col, "_text", F.concat(F.lit(" "), _flat(F.col("f")), F.lit(" ")).alias("hay"), F.explode(held).alias("mark")))
    found = (hay.join(F.broadcast(table), "mark").filter(F.col("hay").contains(F.col("form")))
             .groupBy(id_col, "_text").agg(F.collect_set(F.struct("unit_license", "form")).alias("all")))  # known texts at most
    longest = F.filter("all", lambda x: ~F.exists("all", lambda y: (F.length(y["form"]) > F.length(x["form"])) & y["form"].contains(x["form"])))
    return found.select(id_col, "_text", F.explode(longest).alias("x")).select(id_col, "_text", F.col("x.unit_license").alias("unit_license"))


def scan(df: DataFrame, known: list[tuple[str, str]] | DataFrame = KNOWN, *, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, digest of the whole text, whole_license or null, licenses: sorted names found in any unit)."""
    spark = df.sparkSession
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    forms = (texts.select("license", canonical(F.col("text")).alias("form")).filter("form <> ''")
             .groupBy("form").agg(F.min("license").alias("license")))
    table = forms.select(F.sha2(F.col("form").cast("binary"), 256).alias("digest"), "license")
    few = not isinstance(known, DataFrame) and len(known) <= BROADCAST or table.count() <= BROADCAST
    table = F.broadcast(table) if few else table
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = df.select(F.col(id_col).alias(id_col), F.xxhash64(text).alias("_text"), text.alias("t"))
    # staged, so that the form is made once for all that reads it
    formed = stage(keyed.select(id_col, "_text", _lines_in_form(F.col("t")).alias("f")), "license-forms")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    parts = F.transform(F.concat(F.split("f", _GAP), F.split("f", "\n")), _flat)
    units = F.filter(F.array_distinct(F.concat(F.array(_flat(F.col("f"))), parts)), lambda x: x.rlike("[0-9a-z]"))
    whole = formed.select(id_col, "_text", sha(_flat(F.col("f"))).alias("digest"))
    units = formed.select(id_col, "_text", F.explode(F.transform(units, sha)).alias("unit_digest"))
    named = table.select(F.col("digest").alias("unit_digest"), F.col("license").alias("unit_license"))
    stated = (keyed.filter(F.col("t").rlike("(?i)SPDX-License-Identifier"))
              .select(id_col, "_text", F.explode(_spdx_names(F.col("t"))).alias("unit_license")))
    hits = (units.join(named, "unit_digest").select(id_col, "_text", "unit_license")
            .unionByName(stated))
    if few:
        hits = hits.unionByName(contained(formed, forms, id_col))
    found = (hits.groupBy(F.col(id_col).alias("_id"), "_text")
             .agg(F.sort_array(F.collect_set("unit_license")).alias("licenses")).withColumnRenamed("_text", "_found"))
    judged = whole.select(id_col, "_text", "digest").join(
        table.select(F.col("digest").alias("_digest"), F.col("license").alias("whole_license")),
        F.col("digest") == F.col("_digest"), "left").drop("_digest")
    same = judged[id_col].eqNullSafe(found["_id"]) & (judged["_text"] == found["_found"])
    return (judged.join(found, same, "left").drop("_id", "_found", "_text")
            .withColumn("licenses", F.coalesce("licenses", F.array().cast("array<string>"))))
