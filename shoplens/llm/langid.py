"""Language identification (op 4).

Sparse multinomial logistic regression on TF-IDF weights of hashed character
1- to 3-grams, trained by follow-the-regularised-leader with an elastic net, then
temperature calibrated.

* Document frequencies cover every document that may be learned from.
* The regression is fitted on a bounded sample of them: about
  ``SAMPLE_PER_LANG`` different documents of each language, picked by a hash of id
  and text; one in five of the sample is kept for the temperature.
* Every text is then scored whole, in one pass without a shuffle.

Learned from: rows with a doc_id, a non-null lang and a text with a letter whose
``crc32(doc_id as text) mod 4`` is not 2.  lang, source and doc_id never enter a
prediction.

Defined cases: null text and text without a letter are ``und`` with score 0;
with nothing to learn from every row is ``und``; a null doc_id is not held out
and not learned from; repeated rows get a row each and are learned from once; other
columns are ignored.  A text is scanned whole whatever its length; of languages with
equal probability the first in alphabetical order is predicted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.charngrams import gram_counts
from shoplens.llm.staging import documents

BUCKETS = 1 << 14
SAMPLE_PER_LANG = 1500
UNDETERMINED = "und"
MIN_SCORE = 0.3        # the pipeline keeps documents from this calibrated score on (near even odds: rejected)


def held_out(doc_id="doc_id", parts: int = 4, part: int = 2):
    """True when crc32(doc_id as text) mod ``parts`` is ``part`` (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts)) == part, F.lit(False))


def _document_frequencies(batches):
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for grams in gram_counts(batch.column(0), BUCKETS):
            if grams is not None:
                df[grams[0]] += 1
                n += 1
    at = np.flatnonzero(df)
    # Bucket -1 counts the documents.
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], names=["bucket", "df"])


def _sample_rows(batches):
    for batch in batches:
        rows = list(gram_counts(batch.column(2), BUCKETS))
        keep = [i for i, r in enumerate(rows) if r is not None]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())),
            pa.array([rows[i][0].astype(np.int32) for i in keep], pa.list_(pa.int32())),
            pa.array([rows[i][1].astype(np.int32) for i in keep], pa.list_(pa.int32()))], names=["h", "lang", "buckets", "counts"])


def tf_idf(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * idf[buckets]
    return x / max(np.sqrt(x @ x), 1e-12)


class FtrlSoftmax:
    """Multinomial logistic regression by FTRL-proximal steps with L1 and L2."""

    def __init__(self, classes: int, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.z, self.n = np.zeros((classes, size)), np.zeros((classes, size))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        logits = w @ x
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[y] -= 1.0
        g = p[:, None] * x
        n = self.n[:, at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[:, at] += g - sigma * w
        self.n[:, at] = n + g * g


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows (golden-section search on its logarithm).

    Targets are smoothed by one row in n + 2, as rows that are all right would
    otherwise ask for a temperature of 0.
    """
    eps = 1.0 / (len(y) + 2)

    def loss(log_t):
        s = logits / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        log_p = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        right = log_p[np.arange(len(y)), y]
        others = (log_p.sum(axis=1) - right) / (logits.shape[1] - 1)
        return float(-np.mean((1 - eps) * right + eps * others))

    lo, hi, r = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


class LanguageModel:
    """Classes, IDF, sparse weights and temperature: at most BUCKETS numbers a class."""

    def __init__(self, langs, idf, weights, t):
        self.langs, self.idf, self.weights, self.t = langs, idf, weights, t

    def predict(self, column):
        names, scores = [], []
        for grams in gram_counts(column, BUCKETS):
            if grams is None or not self.langs:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            at, count = grams
            logits = self.weights[:, at] @ tf_idf(at, count, self.idf) / self.t
            p = np.exp(logits - logits.max())
            p /= p.sum()
            best = int(np.argmax(p))
            names.append(self.langs[best])
            scores.append(float(p[best]))
        return names, scores


def fit(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG, epochs: int = 2) -> LanguageModel:
    """The model from the rows that may be learned from; only bounded frames reach the driver."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       docs["lang"].cast("string").alias("lang")).where("doc_id is not null and lang is not null").where(~held_out())
    # Rows are picked by text and id, so copies of a row are picked together and learned from once.
    h = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    by_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(h, 0.02).alias("n")).collect()}
    langs = sorted(by_lang)
    if not langs:
        return LanguageModel([], None, None, 1.0)
    freq = rows.select("text").mapInArrow(_document_frequencies, "bucket int, df bigint").groupBy("bucket").agg(
        F.sum("df").alias("df")).collect()                             # at most BUCKETS + 1 rows
    df, total = np.zeros(BUCKETS), 0
    for r in freq:
        if r["bucket"] < 0:
            total = r["df"]
        else:
            df[r["bucket"]] = r["df"]
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0

    wanted = F.lit(False)
    for lang, n in by_lang.items():
        wanted |= (F.col("lang") == lang) & (h < min(1 << 30, -(-(1 << 30) * sample_per_lang // max(n, 1))))
    picked = rows.where(wanted).groupBy(h.alias("h"), "lang").agg(F.min("text").alias("text"))
    # The bound lies far above the expected size; should it bind, the least hashes are taken.
    sample = picked.orderBy("h", "lang").limit(2 * sample_per_lang * len(langs)).mapInArrow(
        _sample_rows, "h bigint, lang string, buckets array<int>, counts array<int>").toArrow()
    sample = sample.sort_by([("h", "ascending"), ("lang", "ascending")]) if sample.num_rows else sample
    number = {x: i for i, x in enumerate(langs)}
    data = []
    for lang, at, count in zip(sample["lang"].to_pylist(), sample["buckets"], sample["counts"]):
        at, count = at.values.to_numpy(), count.values.to_numpy()
        data.append((at, tf_idf(at, count, idf), number[lang]))
    model = FtrlSoftmax(len(langs), BUCKETS)
    train = [r for i, r in enumerate(data) if i % 5]
    for _ in range(epochs):
        for at, x, y in train:
            model.learn(at, x, y)
    w = model.weights()
    kept = [r for i, r in enumerate(data) if i % 5 == 0]
    t = temperature(np.array([w[:, at] @ x for at, x, _ in kept]), np.array([y for *_, y in kept])) if kept and len(langs) > 1 else 1.0
    return LanguageModel(langs, idf, w, t)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = shared.value.predict(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents with a determined language and at least that score; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            names, scores = shared.value.predict(batch.column(at))
            yield batch.filter(pa.array([n != UNDETERMINED and s >= min_score for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, fit(docs))
