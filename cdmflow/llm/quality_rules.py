r"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Every text gets counts (words, symbols, repeated lines, repeated three-word windows) and, from them, rule
values between 0 and 1. A rule rejects a text whose value exceeds its cutoff. The cutoffs are selected per
stratum on labelled holdout texts:

* One half of the labelled texts (by a digest of the id) proposes: per stratum and rule the cutoff of a fixed grid
  with the best balance of rejected bad texts against rejected good ones (weighted by ``cost``), the mildest on ties;
  the rules with a positive balance, best first, make a growing sequence of rule sets.
* The other half decides: the sets of a stratum are tested in this order, each against the undivided ``alpha``. A set
  that rejects ``k`` of the ``n`` good texts by any of its rules is certified if the exact binomial tail
  P(Bin(n, alpha) <= k) is at most delta / strata: the Clopper-Pearson bound on its false rejection rate lies below
  alpha. The first failure ends the sequence, so its tests need no further correction (fixed-sequence testing), and the
  strata are corrected by Bonferroni. The last certified set is used; without one the stratum has no rules.

So with probability 1 - delta at least, in no stratum are more than ``alpha`` of the good texts rejected by
all rules together: about 90 good texts of the deciding half without a false rejection suffice. Strata are the listed
languages and one for the rest, so the threshold table has a bounded number of rows and is broadcast; counts per
(stratum, rule, cutoff) and per (stratum, place in the sequence) are summed before the shuffle.

Words are runs of ``[^\x20\x09-\x0D]``. Defined cases: null text is text without words; it and every text of
fewer than 50 words fail the base rules; a null language falls in the rest stratum; a text labelled twice
counts as bad if any label says so; repeated rows are judged one by one; an empty table gives an empty
result; other columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmflow.llm.common import stage

SYMBOLS = "#*$%&|<>"
STRATA = ("en", "de", "fr", "es")
RULES = ("symbols", "capitals", "exclamations", "repeats", "double_lines")
CUTOFFS = (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.4, 0.5, 0.65, 0.8)
_BETWEEN = r"[\x09-\x0D\x20]+"


def _removed(text: Column, chars: str) -> Column:
    """How many characters of ``chars`` a text has."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def counts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, ...) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lang = F.col(lang_col).cast("string")
    base = df.select(F.col(id_col).alias(id_col), F.when(lang.isin(*STRATA), lang).otherwise("").alias("stratum"), text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x09-\x0D\x20]"))
    parts = base.select(
        id_col, "stratum", lines.alias("lines"), F.array_remove(F.split("t", _BETWEEN), "").alias("w"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _removed(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _removed(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
        (F.length("t") - F.length(F.replace(F.col("t"), F.lit("!")))).cast("long").alias("n_exclamations"))
    place = F.lit((1 << 30) - 1).cast("long")  # a window's hash in the upper bits, its place in the lower 30
    packed = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long"))
    starts = F.when(F.size("w") >= 3, F.sequence(F.lit(0), F.size("w") - 3)).otherwise(F.array().cast("array<int>"))
    numbers = ("word_chars", "n_symbols", "n_capitals", "n_exclamations")
    ranked = parts.select(
        id_col, "stratum", *numbers, "w", F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(starts, packed)).alias("hashed"))
    # windows whose hash has a neighbour: all that repeat, and a few that do not
    hash_of = lambda x: F.shiftright(x, 30)
    beside = lambda x, j: (hash_of(x).eqNullSafe(hash_of(F.get("hashed", j - 1)))
                           | hash_of(x).eqNullSafe(hash_of(F.get("hashed", j + 1))))
    words_at = lambda i: F.struct(F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("v"), i.alias("i"))
    others = [c for c in ranked.columns if c not in ("w", "hashed")]
    likely = ranked.select(*others, F.sort_array(F.transform(
        F.filter("hashed", beside), lambda x: words_at(x.bitwiseAND(place).cast("int")))).alias("windows"))
    twin = lambda x, j: x["v"].eqNullSafe(F.get("windows", j - 1)["v"]) | x["v"].eqNullSafe(F.get("windows", j + 1)["v"])
    found = F.transform(F.filter("windows", twin), lambda x: x["i"])
    cover = F.aggregate(
        F.sort_array(found), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(i, acc["end"])).cast("long").alias("n"), (i + 3).alias("end")),
        lambda acc: acc["n"])
    return likely.select(*others, cover.alias("n_repeat_words"))


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def rule_values() -> dict[str, Column]:
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "capitals": _share("n_capitals", "word_chars"),
        "exclamations": _share("n_exclamations", "word_chars"),
        "repeats": _share("n_repeat_words", "n_words"),
        "double_lines": _share("n_dup_lines", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by ten; error below 1e-12 for x >= 1."""
    y = x + 10
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    shift = sum((F.log(x + i) for i in range(1, 10)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - shift


def log_binomial_tail(k: Column, n: Column, p: float) -> Column:
    """log P(Bin(n, p) <= k), for k below n * p; never too small: terms left out are bounded by a geometric sum."""
    k, n = k.cast("double"), n.cast("double")
    first = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    terms = F.least(k, F.lit(4000.0) + 12 * F.sqrt(n * p)).cast("int")
    ratio = lambda i: i * (1 - p) / ((n - i + 1) * p)
    total = F.aggregate(
        F.sequence(F.lit(0), terms), F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda acc, j: F.struct((acc["sum"] + acc["term"]).alias("sum"), (acc["term"] * ratio(k - j)).alias("term")),
        lambda acc: acc["sum"] + F.greatest(acc["term"], F.lit(0.0)) / F.greatest(1 - ratio(k), F.lit(1e-9)))
    return first + F.log(total)


def proposes(doc_id: Column) -> Column:
    """Does a labelled text propose cutoffs (or decide on them)? Half of the ids, by their SHA-256."""
    return F.substring(F.sha2(doc_id.cast("string").cast("binary"), 256), 1, 1) < "8"


def thresholds(measured: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality",
               alpha: float = 0.05, delta: float = 0.05, cost: float = 10.0) -> DataFrame:
    """(stratum, one cutoff per rule): null where the rule is not in the certified set."""
    marked = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg((F.min(label_col) > 0).alias("good")))
    values = F.array(*[F.struct(F.lit(-i).alias("order"), F.lit(r).alias("rule"), v.alias("value")) for i, (r, v) in enumerate(rule_values().items())])
    holdout = stage(measured.filter(~base_failed()).select(F.col(id_col).alias("_id"), "stratum", values.alias("values"))
                    .join(marked, "_id").select("stratum", "good", "values", proposes(F.col("_id")).alias("proposes")), "quality-holdout")
    above = sum((F.col("value") > c).cast("int") for c in CUTOFFS)  # the number of cutoffs that reject the text
    tally = holdout.filter("proposes").select("stratum", "good", F.inline("values")).groupBy("stratum", "order", "rule", above.alias("above")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    rows = tally.groupBy("stratum", "order", "rule").agg(
        F.collect_list(F.struct("above", "good", "bad")).alias("tally"))  # at most 13 entries
    grid = F.array(*[F.struct(F.lit(j + 1).alias("at"), F.lit(c).alias("cutoff")) for j, c in enumerate(CUTOFFS)])
    hits = lambda name: F.aggregate("tally", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["above"] >= F.col("at"), x[name]).otherwise(0))
    balance = (hits("bad") - cost * hits("good")).alias("balance")
    best = (rows.select("stratum", "order", "rule", "tally", F.inline(grid)).select("stratum", "order", "rule", balance, "cutoff")
            .filter("balance > 0").groupBy("stratum", "order", "rule").agg(F.max(F.struct("balance", "cutoff")).alias("best")))
    sets = best.groupBy("stratum").agg(F.reverse(F.sort_array(F.collect_list(  # at most one entry per rule
        F.struct("best.balance", "order", "rule", "best.cutoff")))).alias("sequence"))

    # the first rule of the sequence that rejects a deciding text: sets from there on reject it
    cutoff_of = lambda v: F.filter("sequence", lambda x: x["rule"] == v["rule"])
    places = F.transform(F.filter("values", lambda v: F.coalesce(v["value"] > F.get(cutoff_of(v), F.lit(0))["cutoff"], F.lit(False))),
                         lambda v: F.array_position(F.transform("sequence", lambda x: x["rule"]), v["rule"]))
    decided = (holdout.filter("NOT proposes AND good").join(F.broadcast(sets), "stratum")  # one row per stratum
               .groupBy("stratum", F.array_min(places).alias("place")).agg(F.count(F.lit(1)).alias("c")))
    counted = decided.groupBy("stratum").agg(F.sum("c").alias("n"), F.collect_list(F.struct("place", "c")).alias("tally"))
    tests = counted.join(sets, "stratum").select("stratum", "n", "tally", F.posexplode("sequence").alias("i", "x")).select(
        "stratum", "n", (F.col("i") + 1).alias("size"), F.col("x.rule").alias("rule"), F.col("x.cutoff").alias("cutoff"),
        F.aggregate("tally", F.lit(0).cast("long"), lambda acc, t: acc + F.when(t["place"] <= F.col("i") + 1, t["c"]).otherwise(0)).alias("k"))
    level = delta / (len(STRATA) + 1)
    passed = (F.col("k") < F.col("n") * alpha) & (log_binomial_tail(F.col("k"), F.col("n"), alpha) <= F.log(F.lit(level)))
    judged_sets = tests.select("stratum", "size", "rule", "cutoff", F.coalesce(passed, F.lit(False)).alias("passed"))
    ends = judged_sets.groupBy("stratum").agg(F.min(F.when(~F.col("passed"), F.col("size"))).alias("end"))
    certified = judged_sets.join(ends, "stratum").filter(F.col("end").isNull() | (F.col("size") < F.col("end")))
    return certified.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in RULES])


def judged(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           label_col: str = "quality", alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The counts of every row with ``base_failed``, the rules that reject it, and ``kept``."""
    measured = stage(counts(df, id_col=id_col, text_col=text_col, lang_col=lang_col), "quality-counts")
    limits = thresholds(measured, labels, id_col=id_col, label_col=label_col, alpha=alpha, delta=delta)
    limits = limits.select(F.col("stratum").alias("_stratum"), *[F.col(r).alias(f"_{r}") for r in RULES])
    # at most one row per listed language and one for the rest
    rows = measured.join(F.broadcast(limits), measured["stratum"] == limits["_stratum"], "left")
    fired = F.array_compact(F.array(*[F.when(v > F.col(f"_{r}"), F.lit(r)) for r, v in rule_values().items()]))
    return (rows.withColumn("base_failed", base_failed()).withColumn("rejected_by", fired)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
            .drop("_stratum", *[f"_{r}" for r in RULES]))
