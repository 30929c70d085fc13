"""Toxicity by subword-bag embeddings under a linear softmax (``subword``).

A text is read in stretches of ``STRETCH`` words; each stretch is the average of its subword bags under the
softmax, and the text's score is that of its most toxic stretch, put on a probability scale by a logistic
curve. One insult in a very long text therefore weighs as much as in a short one.

Labels belong to whole texts, so training selects the stretches. Every toxic text gives the stretch whose words
tell the classes apart best. Models trained on the other folds of the training texts say how likely the text is
toxic, which is how often training reads its stretch: one that seems mislabelled counts little, but none is left out.
Every other text gives its ``HARD`` most toxic stretches (they must all be clean), first by the log-odds, then by the
model itself; each round adds to those of the rounds before, so what was learnt to be clean stays clean.

The classifier is fitted on the driver on a bounded sample: at most about ``max_per_class`` labelled texts
of a class (chosen by a hash of the id, times ``CLEAN_SHARE`` for the clean class), each by its distinct words, of
which more than ``max_words`` are drawn by a hash. Scoring covers every text whole, in one Pandas UDF without a
shuffle; the model is one float per n-gram bucket (1 MB).

Defined cases: null and empty texts and texts without a letter score 0; without labels of both classes
every text scores 0; a text labelled twice takes its highest label, null labels are left out; repeated rows
are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmflow.llm import subword
from cdmflow.llm.common import learnable

STRETCH = 1
HARD = 8
LEAST_SURE = 0.02  # how often a toxic text that seems mislabelled is still read
TOXIC_WEIGHT = 6.0
CLEAN_SHARE = 2.5
THRESHOLD = 0.3


def sample(df: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str,
           max_per_class: int, max_words: int) -> pd.DataFrame:
    """(text, label) of a bounded sample of the labelled texts that may be learnt from; a text is its distinct words."""
    marked = (labels.filter(F.col(label_col).isNotNull() & learnable(F.col(id_col)))
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label")))
    counts = {r["_label"]: r["n"] for r in marked.filter(F.col("_label").isin(0, 1)).groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return pd.DataFrame({"text": [], "label": []})
    share = {1: max_per_class / counts[1], 0: CLEAN_SHARE * max_per_class / counts[0]}
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1_000_000
    chosen = marked.filter(((F.col("_label") == 1) & (draw < share[1])) | ((F.col("_label") == 0) & (draw < share[0])))
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    rows = (texts.join(F.broadcast(chosen), "_id")  # at most about (1 + CLEAN_SHARE) * max_per_class ids
            .groupBy("_id", "_label").agg(F.min("text").alias("text")))
    id_type = rows.schema["_id"].dataType.simpleString()

    def distinct_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(text=[subword.distinct(t, max_words) for t in pdf["text"]])

    small = rows.mapInPandas(distinct_words, f"_id {id_type}, _label int, text string")
    return small.select("text", F.col("_label").alias("label"), "_id").toPandas().sort_values("_id", ignore_index=True)


def stretches(words: list[str]) -> list[list[str]]:
    return [words[i:i + STRETCH] for i in range(0, len(words), STRETCH)]


def _margins(model: subword.Model, texts: list[list[list[str]]]) -> list[np.ndarray]:
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for t in texts for s in t for w in s))}
    value = _folded(model)(list(vocabulary))
    return [np.array([value[[vocabulary[w] for w in s]].mean() for s in t]) for t in texts]


def _folded(model: subword.Model):
    """Words -> margin of class 1 over class 0."""
    table = model.table[:, 1:2] - model.table[:, 0:1]
    slim = subword.Model(model.classes, model.bits, model.sizes, table, model.bias)
    return lambda words: slim.word_logits(words)[:, 0]


def _learnt(split: list[list[list[str]]], labels: np.ndarray, sure: np.ndarray, rounds: int, bits: int,
            sizes: tuple[int, ...]) -> subword.Model:
    """The model after ``rounds`` of taking up the clean stretches it finds most toxic; ``sure`` is per text."""
    seen = {0: Counter(), 1: Counter()}
    for t, y in zip(split, labels):
        seen[int(y)].update({w for s in t for w in s})
    size = {y: int((labels == y).sum()) for y in (0, 1)}
    odds = {w: np.log((seen[1][w] + 0.5) / (size[1] + 1)) - np.log((seen[0][w] + 0.5) / (size[0] + 1))
            for w in seen[0] | seen[1]}
    value = [np.array([max(odds[w] for w in s) for s in t]) for t in split]
    bags = [t[int(v.argmax())] for t, v, y in zip(split, value, labels) if y]
    toxic, taken = len(bags), set()
    for k in range(rounds):
        for t, v, y in zip(split, value, labels):
            for j in np.argsort(-v, kind="stable")[:0 if y else HARD]:
                if tuple(t[j]) not in taken:
                    taken.add(tuple(t[j]))
                    bags.append(t[j])
        marks = (np.arange(len(bags)) < toxic).astype(int)
        model = subword.train(bags, marks, [0, 1], bits=bits, sizes=sizes, weight=np.where(marks == 1, TOXIC_WEIGHT, 1.0),
                              chance=np.concatenate([sure[labels == 1], np.ones(len(bags) - toxic)]))
        if k + 1 < rounds:
            value = _margins(model, split)
    return model


def fit(texts: list[str], labels: np.ndarray, *, rounds: int = 3, bits: int = 18, sizes: tuple[int, ...] = (3, 4, 5, 6),
        folds: int = 3) -> subword.Model | None:
    """The trained model with its logistic curve; None without both classes."""
    split = [stretches([w for w in map(subword.clean, t.lower().split()) if w]) for t in texts]
    keep = [k for k, s in enumerate(split) if s]
    split, labels = [split[k] for k in keep], np.asarray(labels)[keep]
    if len(set(labels.tolist())) < 2:
        return None
    sure, part = np.ones(len(labels)), np.arange(len(labels)) % folds
    best = np.zeros(len(labels))
    if all(len(set(labels[part != f].tolist())) == 2 for f in range(folds)):
        for f in range(folds):
            rest, aside = np.flatnonzero(part != f), np.flatnonzero(part == f)
            other = _learnt([split[k] for k in rest], labels[rest], np.ones(len(rest)), 2, bits, sizes)
            best[aside] = [v.max() for v in _margins(other, [split[k] for k in aside])]
        a, b = subword.fit_platt(best, labels.astype(float))
        sure = np.clip(1 / (1 + np.exp(-np.clip(a * best + b, -50, 50))), LEAST_SURE, 1.0)
    model = _learnt(split, labels, sure, rounds, bits, sizes)
    best = np.array([v.max() for v in _margins(model, split)])
    model.platt = subword.fit_platt(best, labels.astype(float))
    return model


def text_margins(texts: list, word_margin) -> np.ndarray:
    """The largest stretch margin of every whole text; -inf without words."""
    best = np.full(len(texts), -np.inf)
    for words, at, rows in subword.batches(texts):
        if not len(at):
            continue
        value = word_margin(words)[at]
        new_row = np.concatenate([[True], rows[1:] != rows[:-1]])
        first = np.flatnonzero(new_row)[np.cumsum(new_row) - 1]
        starts = np.flatnonzero((np.arange(len(rows)) - first) % STRETCH == 0)
        size = np.diff(np.concatenate([starts, [len(rows)]]))
        np.maximum.at(best, rows[starts], np.add.reduceat(value, starts) / size)
    return best


def score(df: DataFrame, model: subword.Model | None, *, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``df`` with the toxicity (0 to 1) of every whole text as ``out_col`` (which replaces a column of that name)."""
    df = df.drop(out_col)
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.DoubleType())])
    if model is None:
        return df.withColumn(out_col, F.lit(0.0))
    table = (model.table[:, 1:2] - model.table[:, 0:1]).astype(np.float32)
    sent = df.sparkSession.sparkContext.broadcast(subword.Model(model.classes, model.bits, model.sizes, table, model.bias, model.platt))

    @F.pandas_udf(T.DoubleType())
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        a, b = m.platt
        for texts in batches:
            margin = text_margins(texts.tolist(), lambda words: m.word_logits(words)[:, 0])
            with np.errstate(over="ignore"):
                yield pd.Series(np.where(np.isneginf(margin), 0.0, 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))))

    return df.withColumn(out_col, toxic(F.col(text_col).cast("string"))).select(schema.names)


def trained(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
            max_per_class: int = 600, max_words: int = 20_000) -> subword.Model | None:
    rows = sample(df, labels, id_col=id_col, text_col=text_col, label_col=label_col,
                  max_per_class=max_per_class, max_words=max_words)
    return fit(rows["text"].tolist(), rows["label"].to_numpy(dtype=np.int64))
