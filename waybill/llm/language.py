"""Language identification by nearest centroid.

A text is a vector of hashed byte n-gram counts (letters and white space, in lower case), damped, weighted by inverse document
frequency and normalised. Each language has several centroids, found by spherical k-means on a bounded
sample of labelled documents; the language of the centroid with the greatest cosine is predicted. A
prediction is rejected if the cosine is too small for that centroid. Short texts have smaller cosines, so what
is too small depends on the length: it is learned from the same documents cut to several lengths, and
falls smoothly between them.

Nulls: a null text, or one without a letter, is ``und`` with score 0 and counts as rejected. Documents
without a language are not learned from. Without anything to learn from, every text is ``und``.
Ties go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import common as C


@dataclass(frozen=True)
class LanguageConfig:
    n: int = 3                    # bytes of an n-gram
    bits: int = 12                # 2**bits hashed n-grams
    per_language: int = 400       # bound of the sample to learn from, for each language
    centroids: int = 3
    rounds: int = 10              # of k-means
    reject_factor: float = 0.5    # of the least ordinary cosine of the centroid's own documents
    lengths: tuple = (16, 32, 64, 128, 256, 512)    # bytes that documents are cut to, to learn from


def gram_index(data: np.ndarray, off: np.ndarray, n: int, bits: int):
    """(hashed n-gram, row) of every position whose n bytes lie in one row."""
    if len(data) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = C.LOWER[data].astype(np.uint64)
    m = len(low) - n + 1
    code = low[:m].copy()
    for j in range(1, n):
        code |= low[j:j + m] << np.uint64(8 * j)
    code *= C.BASE
    code >>= np.uint64(64 - bits)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    whole = row[:m] == row[n - 1:]
    return code[whole].astype(np.int64), row[:m][whole]


WRITING = C.SPACE.copy()
WRITING[65:91] = WRITING[97:123] = WRITING[128:] = True


def fold(data: np.ndarray, off: np.ndarray):
    """Letters, bytes beyond ASCII and white space only; Latin letters in lower case."""
    stays = WRITING[data]
    sums = np.concatenate([[0], np.cumsum(stays)])
    data, off = C.LOWER[data[stays]], sums[off]
    data[C.SPACE[data]] = 32
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[capital] += 0x20
    return data, off


def _counts(data, off, config) -> np.ndarray:
    n, size = len(off) - 1, 1 << config.bits
    data, off = fold(data, off)
    gram, row = gram_index(data, off, config.n, config.bits)
    return np.bincount(row * size + gram, minlength=n * size).reshape(n, size).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(-1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


@dataclass
class LanguageModel:
    langs: list            # of each centroid
    centroids: np.ndarray
    least: np.ndarray      # cosine below which a centroid rejects
    short: np.ndarray      # the same for texts of each of the config's lengths, centroid x length
    idf: np.ndarray
    config: LanguageConfig

    def nearest(self, data, off):
        """(centroid index, cosine) for each row."""
        x = _unit(np.log1p(_counts(data, off, self.config)) * self.idf)
        cosine = x @ self.centroids.T
        best = cosine.argmax(1)
        return best, np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)


    def rejects(self, best, cosine, size):
        """Whether texts of ``size`` bytes are too far from their nearest centroid."""
        if not len(best):
            return np.zeros(0, bool)
        at = np.log2(np.maximum(size, 1))
        marks = np.log2(self.config.lengths)
        high = np.clip(np.searchsorted(marks, at), 1, len(marks) - 1)
        share = np.clip((at - marks[high - 1]) / (marks[high] - marks[high - 1]), 0, 1)
        least = self.short[best, high - 1] * (1 - share) + self.short[best, high] * share
        least *= np.minimum(1, size / self.config.lengths[0])          # shorter still: down to zero
        whole = size >= self.config.lengths[-1]
        least = np.where(whole, self.least[best], np.minimum(least, self.least[best]))
        return (cosine <= 0) | (cosine < least)


def _cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    centres = [_unit(x.mean(0))]
    while len(centres) < min(k, len(x)):
        centres.append(x[np.argmin(np.max(x @ np.array(centres).T, 1))])
    centres = np.array(centres)
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        centres = np.array([_unit(x[own == c].mean(0)) if (own == c).any() else centres[c]
                            for c in range(len(centres))])
    return centres


def learn(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel | None:
    """A model from at most ``per_language`` documents of each language, chosen by a hash of the id."""
    C.ship(docs.sparkSession)
    known = docs.filter("lang is not null and text is not null")
    # a share of each language that leaves some four times the bound, before any row is moved
    share = known.groupBy("lang").agg((4.0 * config.per_language / F.count("*")).alias("share"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = (known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
              .join(F.broadcast(share), "lang")  # one row for each language
              .filter((F.col("h") / F.lit(2.0 ** 64) + 0.5) < F.col("share"))
              .withColumn("r", F.row_number().over(order))
              .filter(F.col("r") <= config.per_language).select("doc_id").distinct())

    def vectors(batches):
        for batch in batches:
            out, heads = [], []
            for _, _, data, off in C.blocks(batch.column(1)):
                out += [row.tobytes() for row in _counts(data, off, config)]
                heads += [data[i:min(j, i + config.lengths[-1])].tobytes() for i, j in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(heads, pa.binary())],
                                             names=["lang", "v", "head"])

    # bounded: per_language rows of each language, one vector of 2**bits numbers and a short start of the text each
    sample = (known.select("doc_id", "lang", "text")
              .join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text")
              .mapInArrow(vectors, "lang string, v binary, head binary").toPandas())
    if not len(sample):
        return None
    x = np.stack([np.frombuffer(v, np.float32) for v in sample["v"]])
    lang = sample["lang"].to_numpy()
    order = sorted(range(len(x)), key=lambda i: (lang[i], sample["v"][i]))  # free of the order of rows
    x, lang, heads = x[order], lang[order], sample["head"].to_numpy()[order]
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x = _unit(np.log1p(x) * idf)
    names, centroids, least = [], [], []
    for name in sorted(set(lang)):
        mine = x[lang == name]
        centres = _cluster(mine, config.centroids, config.rounds)
        cosine = (mine @ centres.T).max(1)
        for c in centres:
            names.append(name)
            centroids.append(c)
            least.append(float(np.quantile(cosine, 0.01)) * config.reject_factor)
    centroids, least = np.array(centroids, np.float32), np.array(least)
    return LanguageModel(names, centroids, least, _short(heads, lang, names, centroids, least, idf, config), idf, config)


def _short(heads, lang, names, centroids, least, idf, config) -> np.ndarray:
    """Least cosines of texts of each length: of a language's documents cut to it; of all languages' where it
    has fewer than twenty that long, those of whole texts where nobody has."""
    out = np.repeat(least[:, None], len(config.lengths), axis=1)
    for k, size in enumerate(config.lengths):
        long = np.array([len(h) >= size for h in heads])
        if not long.any():
            continue
        cut = [h[:size] for h in heads[long]]
        off = np.cumsum([0, *map(len, cut)])
        x = _unit(np.log1p(_counts(np.frombuffer(b"".join(cut), np.uint8), off, config)) * idf)
        own = np.array([[n == g for n in names] for g in lang[long]])
        cosine = np.where(own, x @ centroids.T, -1).max(1)
        cosine, some = np.maximum(cosine, 0), x.any(1)                  # without a letter nothing is learned
        if not some.any():
            continue
        for c, name in enumerate(names):
            mine = some & (lang[long] == name)
            mine = mine if mine.sum() >= 20 else some
            out[c, k] = float(np.quantile(cosine[mine], 0.01)) * config.reject_factor
    return out


def judge(model: LanguageModel | None, column):
    """(language, score, rejected) of the texts of a column."""
    text = C.as_text(column)
    letters = np.array([any(map(str.isalpha, t)) for t in text.to_pylist()], bool)
    n = len(text)
    pred, score, far = np.full(n, "und", object), np.zeros(n), np.ones(n, bool)
    if model is not None:
        for a, b, data, off in C.blocks(text):
            best, cosine = model.nearest(data, off)
            pred[a:b] = np.array(model.langs, object)[best]
            score[a:b] = cosine
            far[a:b] = model.rejects(best, cosine, np.diff(off))
    pred[~letters], score[~letters], far[~letters] = "und", 0, True
    return pred, score, far


def identify(docs: DataFrame, model: LanguageModel | None, keep: tuple = ()) -> DataFrame:
    """doc_id, the columns ``keep``, lang_pred, score (cosine), rejected."""
    fields = [docs.schema[c] for c in keep]

    def run(batches):
        for batch in (part for whole in batches for part in C.slices(whole, 1)):
            pred, score, far = judge(model, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(pred, pa.string()), pa.array(score), pa.array(far)],
                names=["doc_id", *keep, "lang_pred", "score", "rejected"])

    C.ship(docs.sparkSession)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
            .mapInArrow(run, f"doc_id long, {kept}lang_pred string, score double, rejected boolean"))


def op4_language_id(spark, sf_dir):
    docs = C.scan(spark, sf_dir, "documents")
    model = learn(docs.filter(C.crc32_mod("doc_id", 3) != 1))
    return (identify(docs, model)
            .select("doc_id", (C.crc32_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected"))


def language_stage(spark, docs, sf_dir):
    """Pipeline stage: documents whose language is rejected go; the columns stay as they are, whatever their
    names. Whole rows go through the workers once and are dropped there. Null texts and texts without a
    letter are rejected; rows without id are judged like others."""
    model, at = learn(docs.filter(C.crc32_mod("doc_id", 3) != 1)), docs.columns.index("text")

    C.record_batches(docs.sparkSession, 1000)

    def run(batches):
        C.held("language", dict)
        for batch in (part for whole in batches for part in C.slices(whole, at)):
            yield batch.filter(pa.array(~judge(model, batch.column(at))[2]))

    C.ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
