"""Averaged hashed subword embeddings under a linear softmax, trained by stochastic gradient descent in numpy.

A word (a white-space token, lower-cased, without leading and trailing non-letters) is the mean of the
embeddings of its character n-grams, bounded by ``<`` and ``>`` and hashed into ``2**bits`` rows; a stretch
of text is the mean of its words; a linear softmax on that mean gives the class. Misspellings and unseen
inflections share most n-grams with the words seen in training.

Embeddings and softmax are trained jointly. For scoring, both linear maps are folded into one table
(n-gram -> class logits), so a distinct word is scored once per batch, and texts are sums over their words.
Work is done on distinct words of about ``_BATCH`` characters of text at a time, whatever the length
of a text: memory is bounded and no text is cut short.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash

from cdmflow.llm.common import text_chunks

_BATCH = 2_000_000
_WORDS = 20_000
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def clean(token: str) -> str:
    """The token without non-letters at its ends; empty if it has no letter."""
    if token.isalpha():
        return token
    inner = _EDGE.sub("", token)
    return inner if any(c.isalpha() for c in inner) else ""


def distinct(text: str | None, most: int) -> str:
    """The distinct lower-cased words of a text in their order; of more than ``most``, those of the least hashes."""
    words = dict.fromkeys(w for chunk in text_chunks(text or "") for w in chunk.lower().split())
    if len(words) > most:
        drawn = set(sorted(words, key=lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "replace")))[:most])
        words = [w for w in words if w in drawn]
    return " ".join(words)


def batches(texts: Sequence[str | None]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(distinct cleaned words, word number of every word, text number of every word), a bounded batch at a time.

    Words without a letter are left out. A text may be spread over several batches."""
    tokens: list[str] = []
    owner: list[int] = []
    counts: list[int] = []
    size = 0

    def made():
        codes, found = pd.factorize(np.array(tokens, dtype=object))
        cleaned = [clean(t) for t in found]
        second, distinct = pd.factorize(np.array([w or None for w in cleaned], dtype=object))  # -1: no letter
        at = second[codes]
        rows = np.repeat(np.array(owner), counts)
        return list(distinct), at[at >= 0], rows[at >= 0]

    for row, text in enumerate(texts):
        if not isinstance(text, str):
            continue
        for chunk in text_chunks(text):
            part = chunk.lower().split()
            tokens += part
            owner.append(row)
            counts.append(len(part))
            size += len(chunk)
            if size >= _BATCH and tokens:
                yield made()
                tokens, owner, counts, size = [], [], [], 0
    if tokens:
        yield made()


def ngrams(words: Sequence[str], bits: int, sizes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words: (bucket of each n-gram, start of each word's n-grams), at least one per word."""
    line = "".join(f"<{w}>" for w in words)
    chars = np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    left = ends[word] - np.arange(len(chars))  # characters up to the word's end, this one included
    buckets, owners = [], []
    h = np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, max(sizes) + 1):
        shifted = np.zeros_like(chars)
        shifted[:max(len(chars) - n + 1, 0)] = chars[n - 1:]
        h = (h ^ shifted) * np.uint64(0x100000001B3)
        if n in sizes:
            ok = left >= n
            mixed = (h[ok] ^ (h[ok] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            buckets.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
            owners.append(word[ok])
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    owners, buckets = owners[order], buckets[order]
    counts = np.bincount(owners, minlength=len(words))
    return buckets, np.concatenate([[0], np.cumsum(counts)])


def _mean_rows(table: np.ndarray, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean of ``table[index]`` over the stretches that begin at ``starts`` (the last entry is the end)."""
    sums = np.add.reduceat(table[index], starts[:-1], axis=0)
    return sums / np.diff(starts)[:, None]


@dataclass
class Model:
    classes: list
    bits: int = 16
    sizes: tuple[int, ...] = (3, 4, 5)
    table: np.ndarray | None = None  # n-gram -> class logits
    bias: np.ndarray | None = None
    platt: tuple[float, float] = (1.0, 0.0)
    extra: dict = field(default_factory=dict)

    def word_logits(self, words: Sequence[str]) -> np.ndarray:
        """Logits of every word, without the bias; n-grams of ``_WORDS`` words are held at a time."""
        parts = [_mean_rows(self.table, *ngrams(words[k:k + _WORDS], self.bits, self.sizes)) for k in range(0, len(words), _WORDS)]
        return np.concatenate(parts) if parts else np.zeros((0, self.table.shape[1]))


def train(bags: Sequence[Sequence[str]], labels: np.ndarray, classes: list, *, bits: int = 16,
          sizes: tuple[int, ...] = (3, 4, 5), dim: int = 4, epochs: int = 6, rate: float = 0.5,
          weight: np.ndarray | None = None, chance: np.ndarray | None = None, seed: int = 7, batch: int = 256) -> Model:
    """Joint SGD (Adagrad steps) of embeddings and softmax on word bags with class numbers ``labels``.

    ``chance`` is how likely a bag is read in an epoch: Adagrad evens out the size of steps, so a small ``weight``
    alone would not make a bag count little."""
    rng = np.random.default_rng(seed)
    rows, dims = 1 << bits, dim
    emb = rng.normal(0, 1 / dims, (rows, dims))
    out = rng.normal(0, 0.1, (dims, len(classes)))
    bias = np.zeros(len(classes))
    speed_e, speed_o, speed_b = np.full(rows, 1e-6), np.full(out.shape, 1e-6), np.full(bias.shape, 1e-6)
    weight = np.ones(len(labels)) if weight is None else weight
    vocabulary: dict[str, int] = {}
    coded = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in bag], dtype=np.int64) for bag in bags]
    usable = np.array([len(c) > 0 for c in coded], dtype=bool) if coded else np.zeros(0, dtype=bool)
    index, starts = ngrams(list(vocabulary), bits, sizes) if vocabulary else (np.zeros(0, np.int64), np.zeros(1, np.int64))
    for epoch in range(epochs):
        order = rng.permutation(np.flatnonzero(usable if chance is None else usable & (rng.random(len(usable)) < chance)))
        step = rate * (1 - epoch / epochs)
        for begin in range(0, len(order), batch):
            chosen = order[begin:begin + batch]
            flat = np.concatenate([coded[i] for i in chosen])
            doc = np.repeat(np.arange(len(chosen)), [len(coded[i]) for i in chosen])
            used, at = np.unique(flat, return_inverse=True)
            long = starts[used + 1] - starts[used]
            gram_word = np.repeat(np.arange(len(used)), long)
            gram = index[np.arange(long.sum()) + np.repeat(starts[used] - np.cumsum(long) + long, long)]
            per_word = long.astype(float)
            grams, gram_at = np.unique(gram, return_inverse=True)
            per_doc = np.bincount(doc, minlength=len(chosen)).astype(float)
            small = emb[grams]
            word_vec = np.stack([np.bincount(gram_word, small[gram_at, k]) for k in range(dims)], 1) / per_word[:, None]
            doc_vec = np.stack([np.bincount(doc, word_vec[at, k], len(chosen)) for k in range(dims)], 1) / per_doc[:, None]
            score = doc_vec @ out + bias
            score = np.exp(score - score.max(1, keepdims=True))
            prob = score / score.sum(1, keepdims=True)
            prob[np.arange(len(chosen)), labels[chosen]] -= 1
            grad = prob * weight[chosen][:, None] / len(chosen)
            g_out, g_bias, g_doc = doc_vec.T @ grad, grad.sum(0), grad @ out.T
            g_doc /= per_doc[:, None]
            g_word = np.stack([np.bincount(at, g_doc[doc, k], len(used)) for k in range(dims)], 1) / per_word[:, None]
            g_emb = np.stack([np.bincount(gram_at, g_word[gram_word, k], len(grams)) for k in range(dims)], 1)
            speed_e[grams] += (g_emb**2).mean(1)
            emb[grams] -= step * g_emb / np.sqrt(speed_e[grams])[:, None]
            speed_o += g_out**2
            out -= step * g_out / np.sqrt(speed_o)
            speed_b += g_bias**2
            bias -= step * g_bias / np.sqrt(speed_b)
    return Model(list(classes), bits, tuple(sizes), (emb @ out).astype(np.float32), bias.astype(np.float32))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_platt(margin: np.ndarray, label: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """(a, b) of the logistic curve sigmoid(a * margin + b) that fits 0/1 labels best (Newton steps, halved until the
    loss falls)."""
    x = np.stack([margin, np.ones_like(margin)], 1)
    beta = np.array([1.0, 0.0])

    def loss(b):
        z = x @ b
        return (np.logaddexp(0, z) - label * z).sum() + 5e-4 * ((b - [1.0, 0.0]) ** 2).sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - label) + 1e-3 * (beta - [1.0, 0.0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        now, part = loss(beta), 1.0
        while loss(beta - part * move) > now and part > 1e-6:
            part /= 2
        beta = beta - part * move
        if np.abs(part * move).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])
