"""Toxicity by a linear classifier on character n-grams with naive Bayes features.

Presence of hashed byte n-grams (A-Z lower-cased), scaled by the log ratio of their smoothed rates in
toxic and other documents; logistic regression on the n-grams whose ratio stands out most. Learned from
a bounded sample of the labelled rows, chosen by a hash of the id.

Nulls: a null text is an empty one and gets the score of a text without n-grams; rows without a label
are not learned from. With one class only in the sample, every score is that class's share (smoothed).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C
from waybill.llm.language import gram_index


@dataclass(frozen=True)
class ToxicityConfig:
    n: int = 5               # bytes of an n-gram
    bits: int = 18           # 2**bits hashed n-grams
    sample: int = 20_000     # bound of the labelled rows to learn from
    features: int = 512      # n-grams in the classifier
    min_docs: int = 3        # documents of the sample an n-gram must occur in
    smoothing: float = 1.0
    ridge: float = 1.0
    steps: int = 30          # Newton steps of the fit
    threshold: float = 0.3


def _present(data, off, config):
    """Distinct (row, hashed n-gram) pairs."""
    gram, row = gram_index(data, off, config.n, config.bits)
    pair = np.unique((row << config.bits) | gram)
    return pair >> config.bits, pair & ((1 << config.bits) - 1)


@dataclass
class ToxicityModel:
    slot: np.ndarray      # of each hashed n-gram: its place in weights, or the last place (weight 0)
    weights: np.ndarray   # log ratio times coefficient
    bias: float
    config: ToxicityConfig

    def active(self, data, off):
        """Distinct (row, place) pairs of the n-grams that count."""
        gram, row = gram_index(data, off, self.config.n, self.config.bits)
        slot = self.slot[gram]
        hit = slot < len(self.weights) - 1
        pair = np.unique(row[hit] * len(self.weights) + slot[hit])
        return pair // len(self.weights), pair % len(self.weights)

    def score(self, data, off) -> np.ndarray:
        row, slot = self.active(data, off)
        z = np.bincount(row, self.weights[slot], minlength=len(off) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def learn(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    C.ship(docs.sparkSession)
    chosen = (labels.filter("toxic is not null and doc_id is not null")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.sample))  # a bounded sample
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    size = 1 << config.bits

    def totals(batches):
        seen, n = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            y = (np.array(batch.column(1)) != 0).astype(int)
            n += np.bincount(y, minlength=2)
            for a, _, data, off in C.blocks(batch.column(0)):
                row, gram = _present(data, off, config)
                for k in (0, 1):
                    seen[k] += np.bincount(gram[y[a + row] == k], minlength=size)
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[0][at], n[0])),
             pa.array(np.append(seen[1][at], n[1]))], names=["gram", "n0", "n1"])

    count = (sample.mapInArrow(totals, "gram long, n0 long, n1 long")
             .groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
             .filter(f"gram = -1 or n0 + n1 >= {config.min_docs}").toPandas().sort_values("gram"))
    n0, n1 = (int(count.loc[count["gram"] == -1, c].sum()) for c in ("n0", "n1"))
    count = count[count["gram"] >= 0]
    slot = np.full(size, 0, np.int32)
    if not n0 or not n1 or not len(count):
        return ToxicityModel(slot, np.zeros(1), float(np.log((n1 + 1) / (n0 + 1))), config)
    a = config.smoothing
    c0, c1 = count["n0"].to_numpy(float), count["n1"].to_numpy(float)
    ratio = np.log((c1 + a) / (n1 + 2 * a)) - np.log((c0 + a) / (n0 + 2 * a))
    clear = np.abs(ratio) / np.sqrt(1 / (c1 + a) + 1 / (c0 + a))
    top = np.argsort(-clear, kind="stable")[:config.features]
    k = len(top)
    slot[:] = k
    slot[count["gram"].to_numpy()[top]] = np.arange(k)
    blank = ToxicityModel(slot, np.zeros(k + 1), 0.0, config)

    def features(batches):
        for batch in batches:
            out = [np.zeros(0, np.int16)] * batch.num_rows
            for a_, b_, data, off in C.blocks(batch.column(0)):
                row, col = blank.active(data, off)
                out[a_:b_] = np.split(col.astype(np.int16), np.searchsorted(row, np.arange(1, b_ - a_)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([x.tobytes() for x in out], pa.binary())], names=["toxic", "f"])

    # bounded: one row of at most 2 * features bytes for each document of the sample
    got = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(features, "toxic int, f binary").toPandas()
    got = got.sort_values(["toxic", "f"], kind="stable")
    lists = [np.frombuffer(f, np.int16) for f in got["f"]]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    col = np.concatenate(lists).astype(np.int64)
    y = (got["toxic"].to_numpy() != 0).astype(float)
    r = ratio[top]
    w, b = _fit(row, col, y, r, config)
    return ToxicityModel(slot, np.append(w * r, 0.0), b, config)


def _fit(row, col, y, r, config):
    """Logistic regression on features r[col]; Newton steps, the feature count is bounded."""
    k = len(r)
    x = np.zeros((len(y), k), np.float32)  # bounded: sample x features
    x[row, col] = r[col]
    w, b = np.zeros(k), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for _ in range(config.steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -500, 500)))
        g, gb = x.T @ (p - y) + config.ridge * w, (p - y).sum()
        s = np.maximum(p * (1 - p), 1e-6).astype(np.float32)
        h = np.zeros((k + 1, k + 1))
        xs = x * s[:, None]
        h[:k, :k] = xs.T @ x + config.ridge * np.eye(k)
        h[:k, k] = h[k, :k] = xs.sum(0)
        h[k, k] = s.sum()
        step = np.linalg.solve(h, np.append(g, gb))
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w, b = w - step[:k], b - step[k]
        if np.abs(step).max() < 1e-5:
            break
    return w, b


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score at or above the threshold)."""
    def run(batches):
        for batch in batches:
            score = [model.score(data, off) for _, _, data, off in C.blocks(batch.column(1))]
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= model.config.threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    C.ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, score double, predicted int"))


def op7_toxicity(spark, sf_dir):
    docs, labels = C.scan(spark, sf_dir, "documents"), C.scan(spark, sf_dir, "labels")
    model = learn(docs, labels.filter(C.crc32_mod("doc_id", 4) != 2))
    return (toxicity(docs, model)
            .select("doc_id", (C.crc32_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted"))
