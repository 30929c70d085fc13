r"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z. A test item gives one phrase per
``window`` consecutive words (a shorter item is one phrase).

1. Corpus frequencies of the test terms: one partial aggregation.
2. Every phrase is entered at its rarest term. Only the postings of those entry terms are stored:
   (term, document, position), each with the words of the neighbouring positions as payload.
3. Postings meet the phrases on the entry term. The position lists of the phrase's other terms, each shifted
   by its offset, are intersected at that posting through the payload, so the long lists of frequent words
   are neither stored nor shuffled, and no text is shuffled at all.

Before positions are stored, words are tested against a bitmap of the wanted terms. Its size is fixed
(``BITMAP`` bits, 128 KB) however many terms there are; the join on the term then removes false hits, so the
bitmap only saves work. A very frequent entry term (a passage that a third of the documents repeat) is
split by adaptive skew handling of that join; hits are made distinct by partial aggregation before they
are brought together per document.

Defined cases: null and empty texts have no words and no hits; items without words match nothing; items
with a null id mark hits but have no id to list; repeated rows are judged one by one; an empty table gives
an empty result (an empty benchmark: no hits); other columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdmflow.llm.common import ascii_lower, stage

BITMAP = 1 << 20
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), _BETWEEN), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD_ANY_CASE)), F.lit(0)).cast("long")


def documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, digest, text): a row's key is its id with a digest of its text."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text"))


def _slot(term: Column) -> Column:
    return F.xxhash64(term).bitwiseAND(F.lit(BITMAP - 1).cast("long"))


def term_bitmap(terms: DataFrame) -> Column:
    """The wanted terms as a constant array of BITMAP / 64 longs."""
    slots = terms.select(_slot(F.col("term")).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    filled = {r["at"]: r["bits"] for r in slots.groupBy(F.expr("slot >> 6").alias("at")).agg(F.bit_or(bit).alias("bits")).collect()}
    longs = ",".join(str(filled.get(k, 0)) for k in range(BITMAP // 64))
    return F.split(F.lit(longs), ",").cast("array<bigint>")


def _wanted(bitmap: Column, term: Column) -> Column:
    word = F.get(bitmap, F.shiftright(_slot(term), 6).cast("int"))
    return F.getbit(word, _slot(term).bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1


def occurrences(docs: DataFrame, terms: DataFrame, radius: int | None = None) -> DataFrame:
    """(doc, digest, pos, term) of every occurrence of ``terms`` (and of few others); with a radius also the
    payload: ``near``, the words at most ``radius`` positions away, and ``at``, the term's place in it."""
    spread = (docs.select("doc", "digest", words(F.col("text")).alias("w"))
              .select("doc", "digest", "w", F.posexplode_outer("w").alias("pos", "term"))
              .filter(F.col("term").isNotNull() & _wanted(term_bitmap(terms), F.col("term"))))
    if radius is None:
        return spread.select("doc", "digest", "pos", "term")
    first = F.greatest(F.col("pos") - radius, F.lit(0))
    return spread.select("doc", "digest", "pos", "term",
                         F.slice("w", first + 1, F.col("pos") - first + 1 + radius).alias("near"),
                         (F.col("pos") - first + 1).alias("at"))


def phrases(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, phrase): the windows of every item as word arrays."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col).cast("string")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (w.filter(F.size("w") > 0).select("item", "w", F.explode(starts).alias("s"))
            .select("item", F.slice("w", F.col("s"), F.lit(window)).alias("phrase")).distinct())


def with_entries(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """(phrase, term, offset): every distinct phrase with its rarest term in the corpus."""
    spread = asked.select("phrase").distinct().select("phrase", F.posexplode("phrase").alias("offset", "term"))
    terms = spread.select("term").distinct()
    counts = occurrences(docs, terms).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("offset"), F.col("term")))
    return (spread.join(counts, "term", "left").groupBy("phrase").agg(rarest.alias("e"))
            .select("phrase", "e.term", "e.offset"))


def phrase_hits(docs: DataFrame, entries: DataFrame, reach: int) -> DataFrame:
    """(doc, digest, start, phrase) of every exact occurrence; ``entries`` must be staged."""
    terms = entries.select("term").distinct()
    postings = stage(occurrences(docs, terms, reach - 1).join(terms, "term", "left_semi"), "postings")
    start = F.col("at") - F.col("offset")
    same = F.slice("near", F.greatest(start, F.lit(1)), F.size("phrase")) == F.col("phrase")
    return (postings.join(entries, (postings["term"] == entries["term"]) & (start >= 1) & same)
            .select("doc", "digest", (F.col("pos") - F.col("offset")).alias("start"), "phrase"))


def proximity_matches(df: DataFrame, items: DataFrame, *, span: int, id_col: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc, item) where all words of the item, in any order, stand within ``span`` consecutive words.

    Entered at the item's rarest word; the payload reaches ``span - 1`` words to either side."""
    docs = documents(df, id_col, text_col)
    asked = (items.select(F.col(item_id).cast("string").alias("item"),
                          F.sort_array(F.array_distinct(words(F.col(item_text).cast("string")))).alias("phrase"))
             .filter((F.size("phrase") > 0) & (F.size("phrase") <= span)))
    entries = stage(with_entries(asked, docs), "entries")
    terms = entries.select("term").distinct()
    postings = occurrences(docs, terms, span - 1)
    stretch = lambda s: F.size(F.array_intersect("phrase", F.slice("near", s, F.lit(span)))) == F.size("phrase")
    around = F.exists(F.sequence(F.lit(1), F.col("at")), lambda s: (s + span > F.col("at")) & stretch(s))
    found = (postings.join(entries, "term").filter(around).select("doc", "phrase").distinct())
    return found.join(asked, "phrase").select(F.col("doc").alias(id_col), "item").distinct()


def contamination(df: DataFrame, items: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc, digest, n_hit, item_ids) of the documents with a hit; ``item_ids`` sorted as strings."""
    docs = documents(df, id_col, text_col)
    asked = stage(phrases(items, item_id, item_text, window), "phrases")
    entries = stage(with_entries(asked, docs), "entries")
    hits = stage(phrase_hits(docs, entries, window).distinct(), "hits")
    covers = hits.groupBy("doc", "digest", "start").agg(F.max(F.col("start") + F.size("phrase")).alias("end"))
    before = Window.partitionBy("doc", "digest").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    n_hit = (covers.withColumn("new", F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0)))
             .groupBy("doc", "digest").agg(F.sum("new").cast("long").alias("n_hit")))
    listed = (hits.join(asked, "phrase").select("doc", "digest", "item").distinct()
              .groupBy("doc", "digest").agg(F.array_sort(F.collect_list("item")).alias("item_ids")))
    same = n_hit["doc"].eqNullSafe(listed["doc"]) & (n_hit["digest"] == listed["digest"])
    return n_hit.join(listed, same).select(n_hit["doc"], n_hit["digest"], "n_hit", "item_ids")


def judged(df: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(id, n_words, n_hit, item_ids) of every row."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    docs = documents(df, id_col, text_col).select("doc", "digest", n_words(F.col("text")).alias("n_words"))
    found = contamination(df, items, **options)
    same = docs["doc"].eqNullSafe(found["doc"]) & (docs["digest"] == found["digest"])
    return docs.join(found, same, "left").select(
        docs["doc"].alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def without_contaminated(df: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``df``, all columns, that hold no phrase of the items."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = contamination(df, items, **options).select("doc", "digest")
    same = df[id_col].eqNullSafe(found["doc"]) & (F.xxhash64(df[text_col].cast("string")) == found["digest"])
    return df.join(found, same, "left_anti")
