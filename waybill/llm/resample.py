"""Resampling documents towards a target distribution, with weights from bit planes.

Features are words and pairs of neighbouring words, hashed into buckets. A bucket's gain is the log ratio
of its smoothed shares in the target and in the source. A document's bucket counts are cut into planes
(plane j holds bit j of every bucket's count), the gains into planes of positive and of negative
magnitudes. The sum of count x gain over all buckets is then the sum, over pairs of planes, of
popcount(count plane AND gain plane) x 2**(j + k): exact integers, no products per bucket.
The draw is Gumbel top-k: weights plus noise from a hash of the id, the highest scores win.

Both corpora are counted whole; only their 10,000 bucket counts reach the driver. Ranks come from a range
shuffle of (score, id), one number per partition on the driver.

Nulls: a null text has no words, weight 0 and is never drawn (drawing needs ``min_words``). A null id
hashes as ``7:`` and loses ties against any other id. Repeated rows count and rank each; rows equal in
score, id and features take consecutive ranks. An empty table gives no rows, an empty target gains of
an all-equal target.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C

_WORD = C.table_of(bytes(range(0x30, 0x3A)), bytes(range(0x61, 0x7B)), bytes(range(0x80, 0x100)))
_LONG = 48           # words of more bytes are hashed one by one
_SPACE = 0x20


@dataclass(frozen=True)
class ResampleConfig:
    buckets: int = 10_000
    min_words: int = 20      # documents with fewer are not drawn
    percent: int = 25        # share of the others that is drawn
    seed: str = "7"
    rows: int = 32           # documents whose planes are held at once


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 register after the bytes of each span, started from ``state``; one byte of all spans at a time."""
    state = state.copy()
    order = np.argsort(starts - ends, kind="stable")      # longest first
    at, left = starts[order], (ends - starts)[order]
    register = state[order]
    live = int(np.searchsorted(-left, -_LONG, "left"))    # the long ones come first
    for i in range(live):
        raw = zlib.crc32(data[at[i]:at[i] + left[i]].tobytes(), int(register[i] ^ np.uint32(0xFFFFFFFF)))
        register[i] = np.uint32(raw) ^ np.uint32(0xFFFFFFFF)
    at, left, rest = at[live:], left[live:], register[live:]
    n, step = len(at), 0
    while True:
        n = int(np.searchsorted(-left[:n], -step, "left"))     # spans with more than ``step`` bytes
        if not n:
            break
        part = rest[:n]
        rest[:n] = _CRC[(part ^ data[at[:n] + step]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
        step += 1
    register[live:] = rest
    state[order] = register
    return state


def features(data: np.ndarray, off: np.ndarray, buckets: int):
    """(row, bucket) of every feature of the rows in a block, and the words per row."""
    data = C.LOWER[data]
    starts, ends, row = C.word_spans(data, off, ~_WORD)
    full = np.uint32(0xFFFFFFFF)
    single = _crc_of(data, starts, ends, np.full(len(starts), full))
    pair = np.flatnonzero(row[:-1] == row[1:]) if len(row) else np.zeros(0, np.int64)
    gap = single[pair]
    gap = _CRC[(gap ^ np.uint32(_SPACE)) & np.uint32(0xFF)] ^ (gap >> np.uint32(8))
    double = _crc_of(data, starts[pair + 1], ends[pair + 1], gap)
    crc = np.concatenate([single, double]) ^ full
    return (np.concatenate([row, row[pair]]), (crc % np.uint32(buckets)).astype(np.int64),
            np.bincount(row, minlength=len(off) - 1))


def bucket_totals(docs: DataFrame, config: ResampleConfig = ResampleConfig()) -> np.ndarray:
    """Feature counts of all of ``docs`` by bucket; one row per bucket reaches the driver."""
    C.ship(docs.sparkSession)

    def count(batches):
        total = np.zeros(config.buckets, np.int64)
        for batch in batches:
            for _, _, data, off in C.blocks(batch.column(0)):
                total += np.bincount(features(data, off, config.buckets)[1], minlength=config.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    total = np.zeros(config.buckets, np.int64)
    for r in docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) for each bucket."""
    size = float(len(source))
    s_all, t_all = float(source.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def planes(values: np.ndarray) -> list[np.ndarray]:
    """Bit planes of the rows of a matrix of non-negative integers, low bit first, as 64-bit words."""
    rows, width = values.shape
    out, packed = [], np.zeros((rows, -(-width // 64) * 8), np.uint8)
    for j in range(int(values.max(initial=0)).bit_length()):
        packed[:, :-(-width // 8)] = np.packbits((values >> j) & 1 != 0, axis=1)
        out.append(packed.copy().view(np.uint64))
    return out


def signed_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane) of the gains."""
    return [(sign << k, plane[0]) for sign in (1, -1)
            for k, plane in enumerate(planes(np.maximum(sign * gain, 0)[None, :]))]


def weighted_sums(counts: np.ndarray, gain_planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of count x gain of each row, from planes alone."""
    total = np.zeros(len(counts), np.int64)
    for j, plane in enumerate(planes(counts)):
        for power, gain in gain_planes:
            total += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (power << j)
    return total


def weights(docs: DataFrame, gain: np.ndarray, config: ResampleConfig = ResampleConfig()) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of each document's features."""
    gain_planes, width = signed_planes(gain), config.buckets

    def run(batches):
        for batch in batches:
            n_words, n_features = np.zeros((2, batch.num_rows), np.int64)
            total = np.zeros(batch.num_rows, np.int64)
            for a, b, data, off in C.blocks(batch.column(1)):
                row, bucket, n_words[a:b] = features(data, off, width)
                order = np.argsort(row, kind="stable")
                row, bucket = row[order], bucket[order]
                n_features[a:b] = np.bincount(row, minlength=b - a)
                for low in range(0, b - a, config.rows):
                    high = min(b - a, low + config.rows)
                    i, j = np.searchsorted(row, [low, high])
                    counts = np.bincount((row[i:j] - low) * width + bucket[i:j], minlength=(high - low) * width)
                    total[a + low:a + high] = weighted_sums(counts.reshape(high - low, width), gain_planes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features),
                 pa.array(total // np.maximum(n_features, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    C.ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def scores(weighted: DataFrame, seed: str) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise in thousandths, from a hash of the id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighted.withColumn("score", F.col("weight") + noise)


def ranked(scored: DataFrame, draw: int) -> DataFrame:
    """Adds ``rank`` in descending score: 1, 2, 3... up to ``draw``, null beyond. Rows are dealt by ranges
    of (score, id) and numbered within their range; only the ranges' sizes meet on the driver."""
    spark = scored.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    dealt = C.written(scored.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("_at", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("_at", 33)
    sizes = sorted((r["_part"], r["n"]) for r in dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect())
    base, bases = 0, []
    for number, n in sizes:
        bases.append((number, base))
        base += n
    table = spark.createDataFrame(bases, "_part long, _base long")       # a row per partition
    rank = F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return (dealt.withColumn("_part", part).join(F.broadcast(table), "_part")
            .withColumn("rank", F.when(rank <= draw, rank)).drop("_part", "_at", "_base"))


def resample(docs: DataFrame, target: DataFrame, config: ResampleConfig = ResampleConfig()) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; ``rank`` only where drawn."""
    gain = gains(bucket_totals(docs, config), bucket_totals(target, config))
    scored = C.written(scores(weights(docs, gain, config), config.seed), "scores")
    able = F.col("n_words") >= config.min_words
    draw = config.percent * scored.filter(able).count() // 100
    out = ranked(scored.filter(able), draw).unionByName(
        scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_resample(spark, sf_dir):
    return resample(C.scan(spark, sf_dir, "documents"), C.scan(spark, sf_dir, "benchmark"))


#: crc32 byte by byte over a table made from its polynomial; distinct features are hashed once
SQL = """
WITH RECURSIVE steps(i, k, v) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS entries FROM steps WHERE k = 8),
texts AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
listed AS (
    SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature
    FROM texts),
counted AS (SELECT side, id, feature, count(*) AS n FROM listed GROUP BY ALL),
hashed AS (
    SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(1, octet_length(encode(feature)) + 1), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i - 1, 2))::BIGINT)),
        lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1]))) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM counted), crc_table),
bucketed AS (SELECT side, id, bucket, n FROM counted JOIN hashed USING (feature)),
totals AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM bucketed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM totals),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS g FROM totals, sums),
weighted AS (SELECT id AS doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * g) / sum(n)::DOUBLE)::BIGINT AS weight
    FROM bucketed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(t.w) >= 20 AS able,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
        / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents d JOIN texts t ON t.side = 'd' AND t.id = d.doc_id LEFT JOIN weighted w ON w.doc_id = d.doc_id),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE able)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON p.doc_id = s.doc_id
"""
