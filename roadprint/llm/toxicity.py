"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 17  # rows of the subword table
DIM = 8
GRAMS = (3, 4, 5)  # characters of an n-gram, within "<word>"
EPOCHS = 100
DECAY = 3e-6  # pull of subword vectors towards zero
FIT_ROWS_PER_CLASS = 2000  # bound of the labelled sample
PAD_WORDS = 10  # neutral words added to every text, so that one odd word does not decide a short one
MAX_WORD = 40  # characters of a word that give n-grams: a longer word is cut in words of this length
WORDS_HELD = 800_000  # words a task remembers; then it starts afresh
TOKEN = re.compile(r"[^\W_]{1,%d}" % MAX_WORD)


def subwords(word: str) -> list[int]:
    """Buckets of the word itself and its character n-grams."""
    marked = f"<{word}>"
    grams = dict.fromkeys([marked] + [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)])
    return [zlib.crc32(g.encode("utf-8")) % BUCKETS for g in grams]


class _Bags:
    """Sparse averages ``out[i] = sum_j weight_ij table[j]`` and their transpose, by sorted runs."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, weights: np.ndarray, shape: tuple[int, int]):
        self.shape = shape
        self.sides = []
        for key, other in ((rows, cols), (cols, rows)):
            order = np.argsort(key, kind="stable")
            k = key[order]
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
            self.sides.append((k[starts], starts, other[order].astype(np.int32), weights[order][:, None]))

    def _apply(self, side: int, table: np.ndarray) -> np.ndarray:
        at, starts, other, w = self.sides[side]
        out = np.zeros((self.shape[side], table.shape[1]), np.float32)
        if len(starts):
            terms = table[other]
            terms *= w
            out[at] = np.add.reduceat(terms, starts, axis=0)
        return out

    def mean(self, table: np.ndarray) -> np.ndarray:
        return self._apply(0, table)

    def spread(self, grad: np.ndarray) -> np.ndarray:
        return self._apply(1, grad)


def fit(texts: list[str], labels: list[int], weights: list[float], epochs: int = EPOCHS, dim: int = DIM,
        decay: float = DECAY, seed: int = 7) -> dict:
    """Train embeddings and softmax together (Adam, full batch); returns per-bucket logits.

    A word is the mean of its subword vectors, a document the mean of its words, and the
    two-class softmax is linear, so the trained model folds to one logit per bucket and a bias.
    Words of a single document of the sample are left out of the fit; when scoring, they
    get their n-grams' vectors like any unseen word.
    """
    number: dict[str, int] = {}  # every word of the sample, in order of appearance
    rows, cols, vals = array("i"), array("i"), array("f")  # packed: lists of numbers would fill the driver
    for i, t in enumerate(texts):
        c = Counter(TOKEN.findall(t.lower()))
        n = c.total() + PAD_WORDS
        rows.extend([i] * len(c))
        cols.extend([number.setdefault(w, len(number)) for w in c])
        vals.extend([k / n for k in c.values()])
    rows, cols, vals = np.array(rows), np.array(cols), np.array(vals)
    often = np.bincount(cols, minlength=len(number)) > 1
    vocab = [w for w, o in zip(number, often) if o]
    del number
    kept = often[cols] if len(cols) else np.zeros(0, bool)
    place = np.cumsum(often) - 1
    docs = _Bags(rows[kept], place[cols[kept]].astype(np.int32), vals[kept], (len(texts), len(vocab)))
    del rows, cols, vals, kept, place
    at, bucket, share = array("i"), array("i"), array("f")
    for i, w in enumerate(vocab):
        grams = subwords(w)
        at.extend([i] * len(grams))
        bucket.extend(grams)
        share.extend([1 / len(grams)] * len(grams))
    used, bucket = np.unique(np.array(bucket), return_inverse=True)
    words = _Bags(np.array(at), bucket.astype(np.int32), np.array(share), (len(vocab), len(used)))
    del at, bucket, share
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    w8 = np.array(weights, np.float32)
    w8 = w8 / max(float(w8.sum()), 1e-9)
    prior = float((w8 * y).sum())
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    p = {"E": np.zeros((len(used), dim), np.float32),
         "W": rng.normal(0, 0.5, (dim, 2)).astype(np.float32),
         "b": np.array([np.log(1 - prior), np.log(prior)], np.float32)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(v) for k, v in p.items()}
    target = np.stack([1 - y, y], axis=1)
    for step in range(1, epochs + 1):
        bag = docs.mean(words.mean(p["E"]))
        z = bag @ p["W"] + p["b"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = (z / z.sum(axis=1, keepdims=True) - target) * w8[:, None]
        grad = {"E": words.spread(docs.spread(d @ p["W"].T)) + decay * p["E"], "W": bag.T @ d, "b": d.sum(axis=0)}
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] - 0.1 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
    logits = np.zeros(BUCKETS, np.float32)
    logits[used] = p["E"] @ (p["W"][:, 1] - p["W"][:, 0])
    return {"logits": logits, "bias": float(p["b"][1] - p["b"][0])}


class Scorer:
    """Scores whole texts with a fitted model; remembers the logits of words it has met."""

    def __init__(self, model: dict):
        self.logits, self.bias = model["logits"].tolist(), model["bias"]
        self.held: dict[str, float] = {}

    def __call__(self, text: str | None) -> float:
        words = TOKEN.findall((text or "").lower())
        held, total = self.held, 0.0
        if len(held) > WORDS_HELD:
            held.clear()
        for w in words:
            got = held.get(w)
            if got is None:
                grams = subwords(w)
                got = held[w] = sum(map(self.logits.__getitem__, grams)) / len(grams)
            total += got
        z = self.bias + total / (len(words) + PAD_WORDS)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def is_held_out(doc_id="doc_id"):
    """crc32 of the id as text, modulo 5, is 0; a null id is never held out and never fitted."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows_per_class: int = FIT_ROWS_PER_CLASS,
          epochs: int = EPOCHS) -> dict:
    """Fit on at most ``rows_per_class`` labelled documents of each class, chosen by a seeded hash.

    Labels of one doc_id are merged by their maximum; null labels, null ids and held-out ids
    are left out.  Classes are weighted back to their share among all labelled rows.  Only
    the sample reaches the driver.
    """
    known = (labels.where("toxic is not null and doc_id is not null").where(~is_held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    totals = {r["toxic"]: r["n"] for r in known.groupBy(F.col("toxic").cast("int").alias("toxic"))
              .agg(F.count(F.lit(1)).alias("n")).where("toxic in (0, 1)").collect()}
    picks = None
    for c in sorted(totals):
        part = (known.where(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id")
                .limit(rows_per_class))
        picks = part if picks is None else picks.unionByName(part)
    if picks is None:
        return {"logits": np.zeros(BUCKETS, np.float32), "bias": 0.0}
    sample = (documents.select("doc_id", "text").join(F.broadcast(picks), "doc_id")  # <= 2 x rows_per_class ids
              .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").collect())
    if not sample:
        return {"logits": np.zeros(BUCKETS, np.float32), "bias": 0.0}
    got = pd.Series([int(r["toxic"]) for r in sample]).value_counts()
    return fit([r["text"] or "" for r in sample], [int(r["toxic"]) for r in sample],
               [totals[int(r["toxic"])] / got[int(r["toxic"])] for r in sample], epochs)


def score_column(spark, model: dict, text: str = "text"):
    sent = spark.sparkContext.broadcast(model)  # BUCKETS floats

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = Scorer(sent.value)
        for batch in batches:
            yield pd.Series([score(t) for t in batch], dtype="float64")

    return of(text)


def score(documents: DataFrame, labels: DataFrame, **fit_options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    ``score`` is the probability of label 1; only the text goes into it.  Null and empty
    texts get the score of the bias alone; without any label all scores are 0.5; repeated
    rows score alike; an empty table gives no rows.
    """
    model = train(documents, labels, **fit_options)
    s = score_column(documents.sparkSession, model)
    return (documents.select("doc_id", "text").select("doc_id", is_held_out().alias("held_out"), s.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def reject(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, **fit_options) -> DataFrame:
    """The documents scored under ``threshold``, with their columns unchanged."""
    model = train(documents, labels, **fit_options)
    return documents.where(score_column(documents.sparkSession, model) < threshold)
