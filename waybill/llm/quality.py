"""Quality rules by distribution divergence.

A document's histogram of character classes, and its histogram over each language's common words, are
compared with references of the languages by Jensen-Shannon distance (base 2, 0 to 1); the nearest
language counts. The words' histograms have a bin for all other words; their distance, less what as many
words drawn from the reference would have on average, is a share of that of a text without any common word, at most 1. The references are sums over all documents with a
language. Short documents are guarded: too few characters or words give no verdict. The language of a document is never looked
up, so unlabelled documents are judged alike.

Nulls: a null text is an empty one and fails the base rules; documents with a null language only lack
a say in the references. Without any reference the verdict is the base rules'.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import common as C

ALL = -8     # key of the count of all words
CLASSES = 7  # lower, upper, digit, white space, sentence marks, other ASCII, beyond ASCII


@dataclass(frozen=True)
class QualityConfig:
    n_common: int = 64          # common words of a language
    common_bytes: int = 6       # words longer than this are no candidates
    min_chars: int = 200        # fewer code points: no verdict from character classes
    min_words: int = 160        # fewer words: none from these
    max_class_distance: float = 0.30
    max_word_distance: float = 0.65


def _classes() -> np.ndarray:
    kind = np.full(256, 5, np.uint8)
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[C.SPACE] = 3
    kind[list(b".,;:'\"?!-()")] = 4
    kind[128:192], kind[192:] = 7, 6  # continuation bytes are not counted
    return kind


KIND = _classes()
SYMBOL = C.table_of(b"#*$%&|<>")


def _histograms(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    return np.bincount(row * 8 + KIND[data], minlength=8 * n).reshape(n, 8)[:, :CLASSES]


def _common_candidates(data, starts, ends, limit):
    """(word value, word index) of words of at most ``limit`` bytes, A-Z lower-cased, as integers."""
    short = np.flatnonzero(ends - starts <= limit)
    value = np.zeros(len(short), np.int64)
    at, length = starts[short], (ends - starts)[short]
    for j in range(limit):
        live = length > j
        value[live] = value[live] * 256 + C.LOWER[data[at[live] + j]]
    return value, short


def references(docs: DataFrame, config: QualityConfig = QualityConfig()):
    """{lang: (class counts, {word value: count}, count of all other words)} from all documents that have a language."""
    limit = config.common_bytes

    def partial(batches):
        for batch in batches:
            langs = np.array([x or "" for x in batch.column(1).to_pylist()], object)
            names, code = np.unique(langs, return_inverse=True) if len(langs) else ([], langs)
            rows: dict = {}
            for a, b, data, off in C.blocks(batch.column(0), 1 << 21):
                classes = _histograms(data, off)
                starts, ends, row = C.word_spans(data, off)
                value, short = _common_candidates(data, starts, ends, limit)
                for k, name in enumerate(names):
                    mine = code[a:b] == k
                    for c, n in enumerate(classes[mine].sum(0)):
                        rows[name, -1 - c] = rows.get((name, -1 - c), 0) + int(n)
                    rows[name, ALL] = rows.get((name, ALL), 0) + int(mine[row].sum())
                    words, count = np.unique(value[mine[row[short]]], return_counts=True)
                    for w, n in zip(words.tolist(), count.tolist()):
                        rows[name, w] = rows.get((name, w), 0) + n
            keys = list(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array(list(rows.values()), pa.int64())], names=["lang", "key", "n"])

    C.ship(docs.sparkSession)
    counts = (docs.filter("lang is not null").select("text", "lang")
              .mapInArrow(partial, "lang string, key long, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")))
    counts = C.written(counts, "word-counts")
    # a limit on the rank alone: each task sends no more than ``n_common`` words of a language
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    top = (counts.filter("key >= 0").withColumn("r", F.row_number().over(order))
           .filter(F.col("r") <= config.n_common).drop("r").unionByName(counts.filter("key < 0")))
    out: dict = {}
    every: dict = {}
    for r in top.collect():  # at most n_common words and the classes for each language
        classes, words = out.setdefault(r["lang"], (np.zeros(CLASSES), {}))
        if r["key"] == ALL:
            every[r["lang"]] = r["n"]
        elif r["key"] < 0:
            classes[-1 - r["key"]] = r["n"]
        else:
            words[r["key"]] = r["n"]
    return {k: (*v, every[k] - sum(v[1].values())) for k, v in sorted(out.items()) if v[0].sum() > 0}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Between the rows of ``p`` (counts) and ``q``; rows without counts have distance 0."""
    total = p.sum(-1, keepdims=True)
    p = np.divide(p, total, out=np.zeros(p.shape), where=total > 0)
    q = q / max(q.sum(), 1e-300)
    m = (p + q) / 2

    def kl(x):
        ratio = np.divide(x, m, out=np.ones(np.broadcast(x, m).shape), where=(m > 0) & (x > 0))
        return (x * np.log2(ratio)).sum(-1)

    return np.where(total[:, 0] > 0, np.sqrt(np.clip((kl(p) + kl(q + 0 * p)) / 2, 0, 1)), 0.0)


def _repeated(key: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more, in the place of each occurrence."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _measure(data: np.ndarray, off: np.ndarray, refs: list, config: QualityConfig) -> dict:
    n = len(off) - 1
    starts, ends, row = C.word_spans(data, off)
    n_words = np.bincount(row, minlength=n)
    lead = (data & 0xC0) != 0x80
    salt = C.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))

    grams, first = C.gram_hashes(C.word_hashes(data, starts, ends), row, 8)
    twice = first[_repeated(C.mix(grams + salt[row[first]]))]
    cover = np.zeros(len(starts) + 8, np.int64)
    cover[twice] += 1
    cover[twice + 8] -= 1
    repeated = row[np.cumsum(cover)[:len(starts)] > 0]

    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([off[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([breaks, off[1:]]))
    line_row = np.repeat(np.arange(n), C.per_row(data == 10, off) + 1)
    sums = np.concatenate([[0], np.cumsum(~C.SPACE[data])])
    full = np.flatnonzero(sums[line_end] > sums[line_start])
    h, r = C.word_hashes(data, line_start[full], line_end[full]), line_row[full]
    pair = np.lexsort((h, r))
    h, r = h[pair], r[pair]
    copies = r[1:][(h[1:] == h[:-1]) & (r[1:] == r[:-1])]

    classes = _histograms(data, off)
    out = dict(
        n_words=n_words, word_chars=C.per_row(~C.SPACE[data] & lead, off), n_symbols=C.per_row(SYMBOL[data], off),
        n_dup_lines=np.bincount(copies, minlength=n), n_repeat_words=np.bincount(repeated, minlength=n))
    value, short = _common_candidates(data, starts, ends, config.common_bytes)
    by_class, by_word = np.ones(n), np.ones(n)
    enough = np.zeros(n, bool)
    for ref_classes, words, weights in refs:
        by_class = np.minimum(by_class, js_distance(classes, ref_classes))
        if len(words):
            at = np.minimum(np.searchsorted(words, value), len(words) - 1)
            hit = words[at] == value
            size = len(words) + 1  # and one bin for all other words
            counts = np.bincount(row[short[hit]] * size + at[hit], minlength=n * size).reshape(n, size)
            counts[:, -1] = n_words - counts.sum(1)
            none = js_distance(np.eye(size)[-1:], weights)
            noise = len(words) / (8 * np.log(2) * np.maximum(n_words, 1))
            far = np.sqrt(np.maximum(js_distance(counts, weights) ** 2 - noise, 0)) / none
            by_word = np.minimum(by_word, far)
            enough = n_words >= config.min_words
    if not refs:
        by_class[:] = 0
    out["class_distance"] = by_class
    out["word_distance"] = np.where(enough, by_word, 0.0)
    base_failed = (n_words < 20) | (100 * out["n_repeat_words"] > 30 * n_words)
    odd = (C.per_row(lead, off) >= config.min_chars) & (by_class > config.max_class_distance)
    odd |= enough & (by_word > config.max_word_distance)
    out["base_failed"], out["kept"] = base_failed, ~base_failed & ~odd
    return out


COLUMNS = dict(n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long", n_repeat_words="long",
               class_distance="double", word_distance="double", base_failed="boolean", kept="boolean")


def quality(docs: DataFrame, config: QualityConfig = QualityConfig(), refs: dict | None = None) -> DataFrame:
    """One row for each document: doc_id, counts, distances to the nearest language, verdict."""
    refs = references(docs, config) if refs is None else refs
    packed = [(v[0], np.array(sorted(v[1]), np.int64), np.array([*(v[1][w] for w in sorted(v[1])), v[2]], float))
              for v in refs.values()]

    def run(batches):
        for batch in batches:
            parts = [_measure(data, off, packed, config) for _, _, data, off in C.blocks(batch.column(1))]
            arrays = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0),
                               {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[t])
                      for c, t in COLUMNS.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *COLUMNS])

    C.ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))


def op6_quality(spark, sf_dir):
    return quality(C.scan(spark, sf_dir, "documents"))
