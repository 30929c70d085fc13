"""Language identification by averaged hashed subword embeddings under a linear softmax (``subword``).

The classifier is fitted on the driver on a bounded sample: about ``max_per_class`` texts of each of the at
most ``max_classes`` most frequent languages (chosen by a hash of the id), of each at most ``BAG`` words drawn at
random from the whole text. A quarter of the sample is kept aside to calibrate: a
temperature puts the softmax on a probability scale, and ``accepted`` marks the predictions above the least
score whose predictions there are right in ``precision`` of the cases. Prediction covers every text whole,
in one ``mapInPandas`` without a shuffle; language, source and id are no input of it.

Defined cases: null texts and texts without a letter are ``und`` with score 0, never accepted; without
labelled texts everything is ``und``; languages that are null are not learnt; repeated rows are predicted
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdmflow.llm import subword
from cdmflow.llm.common import learnable, text_chunks

UNKNOWN = "und"
BAG = 200


def sample(df: DataFrame, *, id_col: str, text_col: str, lang_col: str, max_per_class: int, max_classes: int) -> pd.DataFrame:
    """(text, lang) of a bounded sample of the texts that may be learnt from; ``text`` has at most ``BAG`` words."""
    known = df.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"),
                      F.col(text_col).cast("string").alias("text")).filter(F.col("lang").isNotNull() & learnable(F.col("_id")))
    top = (known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_classes)
           .select("lang", (F.lit(float(max_per_class)) / F.col("n")).alias("share")))
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1_000_000
    rows = (known.join(F.broadcast(top), "lang").filter(draw < F.col("share"))
            .groupBy("_id", "lang").agg(F.min("text").alias("text")))

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(text=[" ".join(draw_words(t)) for t in pdf["text"]])

    return rows.mapInPandas(drawn, rows.schema).toPandas().sort_values(["lang", "_id"], ignore_index=True)


def draw_words(text: str | None, seed: int = 11) -> list[str]:
    """At most ``BAG`` of the words of a text, drawn at random (the same ones every time)."""
    words = [w for chunk in text_chunks(text or "") for w in map(subword.clean, chunk.lower().split()) if w]
    rng = np.random.default_rng([seed, len(words)])
    return words if len(words) <= BAG else [words[i] for i in rng.choice(len(words), BAG, replace=False)]


def text_logits(texts: list, model: subword.Model) -> tuple[np.ndarray, np.ndarray]:
    """Mean word logits with the bias, and the number of words, of every whole text."""
    total = np.zeros((len(texts), len(model.classes)))
    count = np.zeros(len(texts), dtype=np.int64)
    for words, at, rows in subword.batches(texts):
        if not len(at):
            continue
        value = model.word_logits(words)
        for c in range(total.shape[1]):
            total[:, c] += np.bincount(rows, value[at, c], len(texts))
        count += np.bincount(rows, minlength=len(texts))
    return total / np.maximum(count, 1)[:, None] + model.bias, count


def fit(texts: list[str], langs: list[str], *, precision: float = 0.99, seed: int = 11) -> subword.Model | None:
    """The trained model; ``extra`` holds the temperature and the least accepted score. None without texts."""
    classes = sorted(set(langs))
    if not classes:
        return None
    rng = np.random.default_rng(seed)
    number = {c: k for k, c in enumerate(classes)}
    y = np.array([number[v] for v in langs])
    bags = [draw_words(t) for t in texts]
    aside = rng.random(len(bags)) < 0.25
    if aside.all() or not aside.any():
        aside = np.zeros(len(bags), dtype=bool)
    learn = np.flatnonzero(~aside)
    model = subword.train([bags[i] for i in learn], y[learn], classes, epochs=4, dim=8, batch=64)
    check = np.flatnonzero(aside) if aside.any() else learn
    check = np.array([i for i in check if bags[i]], dtype=np.int64)
    model.extra = {"temperature": 1.0, "least": 0.0}
    if len(check):
        logits, _ = text_logits([" ".join(bags[i]) for i in check], model)
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(np.maximum(subword.softmax(logits / t)[np.arange(len(check)), y[check]], 1e-12)).mean() for t in grid]
        model.extra["temperature"] = float(grid[int(np.argmin(loss))])
        prob = subword.softmax(logits / model.extra["temperature"])
        best, right = prob.max(1), prob.argmax(1) == y[check]
        order = np.argsort(-best)
        good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision)
        model.extra["least"] = float(best[order][good[-1]]) if len(good) else 1.1
    return model


def predict(df: DataFrame, model: subword.Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) of every row."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_text"))
    if model is None:
        return rows.select(id_col, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        classes = np.array(m.classes, dtype=object)
        for pdf in batches:
            logits, count = text_logits(pdf["_text"].tolist(), m)
            prob = subword.softmax(logits / m.extra["temperature"])
            known = count > 0
            best = np.where(known, prob.max(1), 0.0)
            yield pdf.drop(columns="_text").assign(
                lang_pred=np.where(known, classes[prob.argmax(1)], UNKNOWN), score=best,
                accepted=known & (best >= m.extra["least"]))

    return rows.mapInPandas(run, schema)


def trained(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            max_per_class: int = 500, max_classes: int = 200) -> subword.Model | None:
    rows = sample(df, id_col=id_col, text_col=text_col, lang_col=lang_col, max_per_class=max_per_class,
                  max_classes=max_classes)
    return fit(rows["text"].tolist(), rows["lang"].tolist())
