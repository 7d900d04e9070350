"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased characters (all but letters count as a
space), hashed to ``BUCKETS`` columns, weighted (1 + ln tf) * idf and scaled to length 1.
Document frequencies cover all training rows. The weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of labelled
rows (``SAMPLE_ROWS`` in all, an even share for each language, picked by a hash of the
id); a fifth of the sample is kept out of the fit and sets the softmax temperature.
Prediction reads the text alone.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows with a
null lang are never learned from; without labelled rows everything is ``und``; a null id
counts as a training row; repeated rows are predicted each on their own; equal scores
take the first language in code-point order; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import documents, id_bucket, map_arrow

BUCKETS = 1 << 16
SAMPLE_ROWS = 2400
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
CHUNK = 1 << 20
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def ngram_counts(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1- to 3-grams of a text: columns and how often each occurs."""
    total = np.zeros(buckets, np.int64)
    bits = np.uint32(32 - (buckets - 1).bit_length())
    tail = np.zeros(0, np.uint32)
    for at in range(0, max(len(text), 1), CHUNK):
        cp = np.frombuffer(text[at:at + CHUNK].lower().encode("utf-32-le", "replace"), "<u4")
        low = (cp < 128) & ((cp < 97) | (cp > 122))
        cp = np.concatenate([tail if at else np.array([32], np.uint32), np.where(low, np.uint32(32), cp)])
        if at + CHUNK >= len(text):
            cp = np.append(cp, np.uint32(32))
        new = len(tail) if at else 0
        key = cp * MULT[0]
        total += np.bincount(key[new:] >> bits, minlength=buckets)
        for n in (1, 2):
            key = (key[:-1] ^ (cp[n:] + np.uint32(n))) * MULT[n]
            total += np.bincount(key[max(0, new - n):] >> bits, minlength=buckets)
        tail = cp[-2:]
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Weights:
    langs: list[str]
    idf: np.ndarray
    w: np.ndarray  # columns x languages
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, n = ngram_counts(text, len(self.idf))
        x = (1.0 + np.log(n)) * self.idf[at]
        return at, x / max(float(np.sqrt(x @ x)), 1e-12)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.w[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not LETTER.search(text):
            return UNKNOWN, 0.0
        z = self.logits(*self.features(text)) / self.temperature
        p = np.exp(z - z.max())
        k = int(np.argmax(p))
        return self.langs[k], float(p[k] / p.sum())


def fit(langs: list[str], idf: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS,
        alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Weights:
    """FTRL-proximal over (language index, columns, values) rows; every fifth row sets the temperature."""
    k = len(langs)
    z, n = np.zeros((len(idf) + 1, k)), np.zeros((len(idf) + 1, k))

    def weights(at):
        out = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        out[np.abs(z[at]) <= l1] = 0.0
        return out

    learn = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 10]
    kept = [r for i, r in enumerate(rows) if i % 5 == 0] if len(rows) >= 10 else rows
    for _ in range(epochs):
        for y, at, x in learn:
            at, x = np.append(at, len(idf)), np.append(x, 1.0)  # the last column is the bias
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(len(idf) + 1))
    model = Weights(langs, idf, w[:-1], w[-1])
    scores = np.array([model.logits(at, x) for _, at, x in kept]).reshape(len(kept), k)
    truth = np.array([y for y, _, _ in kept], int)

    def loss(t):
        s = scores / t
        top = s.max(1)
        return float((np.log(np.exp(s - top[:, None]).sum(1)) + top - s[np.arange(len(s)), truth]).sum())

    if len(kept):
        model.temperature = float(min(np.geomspace(0.05, 5.0, 80), key=loss))
    return model


def train(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          buckets: int = BUCKETS, sample_rows: int = SAMPLE_ROWS) -> Weights:
    """``learn`` is a Column: rows to learn from (a null lang is left out anyway)."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                F.col(text_col).cast("string").alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)

    def frequencies(it):
        df, n = np.zeros(buckets, np.int64), 0
        for b in it:
            for at in range(0, len(b), 512):
                for t in b.column(0).slice(at, 512).to_pylist():
                    df[ngram_counts(t, buckets)[0]] += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(df[seen])], ["column", "n"])

    df = rows.select("text").transform(map_arrow, frequencies, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).toPandas()
    idf = np.full(buckets, np.log(1.0 + sum(sizes.values())))
    idf[df["column"].to_numpy(int)] = np.log((1.0 + sum(sizes.values())) / (1.0 + df["n"].to_numpy(float))) + 1.0
    if not langs:
        return Weights([], idf, np.zeros((buckets, 0)), np.zeros(0))
    share = F.lit(0.0)  # of a language's rows that the sample takes
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_rows / len(langs) / sizes[lang]))).otherwise(share)
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    index, base = {x: i for i, x in enumerate(langs)}, Weights(langs, idf, np.zeros((1, 0)), np.zeros(0))

    def features(it):
        for b in it:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                found = [base.features(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([index[x] for x in part.column(1).to_pylist()], pa.int32()),
                     pa.array([f[0] for f in found], pa.list_(pa.int32())),
                     pa.array([f[1] for f in found], pa.list_(pa.float32()))], ["id", "y", "at", "x"])

    sample = rows.where(spot < share).select(F.xxhash64("id").alias("id"), "lang", "text") \
        .transform(map_arrow, features, "id long, y int, at array<int>, x array<float>").toPandas() \
        .sort_values(["id", "y"], kind="stable")
    return fit(langs, idf, [(int(y), np.asarray(a), np.asarray(x, float))
                            for y, a, x in zip(sample["y"], sample["at"], sample["x"])])


def predict(docs: DataFrame, model: Weights, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all others but the text), lang_pred and score."""
    names = keep if keep is not None else [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    if text_col in names:
        cols, at_text = docs.select(*[F.col(f"`{c}`") for c in names]), names.index(text_col)
    else:
        cols = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text_col).cast("string").alias("__li_text"))
        at_text = len(names)

    def run(it):
        for b in it:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                found = [model.predict(t) for t in part.column(at_text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(names)], pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())], [*names, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema[:len(names)]]
    return cols.transform(map_arrow, run, ", ".join([*fields, "lang_pred string", "score double"]))


def q_langid(spark, sf_dir):
    held = F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))
    docs = documents(spark, sf_dir)
    model = train(docs, ~held)
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
