"""Fingerprints by context-triggered piecewise hashing, and their likeness by edit distance.

A hash of the last seven bytes rolls over the text. Where it ends in k one-bits, a chunk of level k ends
(block size 2**k); boundaries of a level are boundaries of all lower ones. The level of a text is the
lowest at which it has at most 63 boundaries, so chunks follow the text's own length, whatever that is.
A fingerprint is ``level:signature:signature:signature``: two characters per chunk at the level and at the
next two, which makes texts of up to four times the length comparable. A chunk's characters come from the
sum of the mixed window hashes in it, so a chunk depends on its own bytes and six before them.

Likeness is 1 - d / (chunks of both), where d is the edit distance (insertions and deletions) of the
signatures at the lowest level both have; without a common level it is 0. Equal texts have equal
fingerprints and likeness 1.

``edits`` needs each document's successor by id. Texts are dealt and sorted by id ranges, and each
task walks its rows in order; the first and last row of each range (two rows a partition) are joined
afterwards, as a DataFrame.

Nulls: a null text is an empty one; its fingerprint has no chunks, and is like another without chunks (1),
unlike any with (0). Rows without id come last. Rows of one id are ordered by a hash of their texts,
then by the texts; each is the next one's predecessor. After the last row comes the first, so a single
row follows itself. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C

_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_FACTOR = 0x100000001B3                # of the rolling polynomial
_PIECE = 1 << 18                       # bytes hashed at a time
_TEXTS = 1 << 19                       # bytes of texts held as one block


@dataclass(frozen=True)
class PiecewiseConfig:
    window: int = 7          # bytes under the rolling hash
    lowest: int = 2          # level of the smallest blocks
    boundaries: int = 63     # most boundaries at a text's level
    levels: int = 3          # signatures of a fingerprint


def _rolling(data: np.ndarray, window: int) -> np.ndarray:
    """Mixed hash of the ``window`` bytes that end at each place; before the start there are zeros."""
    out = data.astype(np.uint64)
    for back in range(1, window):
        out[back:] += data[:-back].astype(np.uint64) * np.uint64(pow(_FACTOR, back, 1 << 64))
    return C.mix(out)


def boundaries(data: np.ndarray, off: np.ndarray, config: PiecewiseConfig):
    """(place, level, running sum) of all boundaries of the lowest level or higher in texts that lie
    ``window`` zero bytes apart, and the running sums at the starts and ends in ``off``."""
    places, levels, sums = [], [], []
    marks = np.zeros(len(off), np.uint64)
    carry, low = np.uint64(0), (1 << config.lowest) - 1
    for a in range(0, len(data), _PIECE):
        lead = min(a, config.window - 1)
        rolled = _rolling(data[a - lead:a + _PIECE], config.window)[lead:]
        # spread once more, so that the sum does not only repeat the bits that made the boundary
        total = np.cumsum(C.mix(rolled + np.uint64(0x632BE59BD9B4E019))) + carry
        at = np.flatnonzero((rolled & np.uint64(low)) == low)
        inverted = ~rolled[at]
        lowest_zero = inverted & (~inverted + np.uint64(1))            # a power of two, or 0 for all ones
        level = np.where(inverted == 0, 64, np.bitwise_count(lowest_zero - np.uint64(1)))
        places.append(at + a)
        levels.append(level.astype(np.uint8))
        sums.append(total[at])
        here = (off > a) & (off <= a + len(rolled))
        marks[here] = total[off[here] - a - 1]
        carry = total[-1]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(places) if places else empty, np.concatenate(levels) if levels else empty,
            np.concatenate(sums) if sums else np.zeros(0, np.uint64), marks)


def _characters(sums: np.ndarray) -> np.ndarray:
    code = C.mix(sums.copy()) >> np.uint64(52)
    return _ALPHABET[np.stack([code >> np.uint64(6), code & np.uint64(63)], axis=1).astype(np.int64)]


def fingerprints(texts: list[bytes], config: PiecewiseConfig = PiecewiseConfig()) -> list[str]:
    out: list[str] = []
    a = 0
    while a < len(texts):
        b, size = a + 1, len(texts[a])
        while b < len(texts) and size + len(texts[b]) <= _TEXTS:
            size += len(texts[b])
            b += 1
        out += _fingerprints(texts[a:b], config)
        a = b
    return out


def _fingerprints(texts: list[bytes], config: PiecewiseConfig) -> list[str]:
    gap = bytes(config.window)
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + config.window) - lengths
    ends = starts + lengths
    place, level, total, marks = boundaries(data, np.stack([starts, ends], axis=1).ravel(), config)
    row = np.searchsorted(starts, place, "right") - 1
    inside = (row >= 0) & (place < ends[row])
    place, level, total, row = place[inside], level[inside], total[inside], row[inside]
    at_start, at_end = marks[0::2], marks[1::2]

    # the lowest level with few boundaries, for each text
    own = np.full(len(texts), config.lowest, np.int64)
    k = config.lowest
    while True:
        over = np.bincount(row[level >= k], minlength=len(texts)) > config.boundaries
        if not over.any():
            break
        own[over] = k + 1
        k += 1
    signatures = [[] for _ in texts]
    for step in range(config.levels):
        cut = np.flatnonzero(level >= own[row] + step)
        # a chunk more for what is left after the last boundary
        last = np.full(len(texts), -1, np.int64)
        last[row[cut]] = place[cut]                     # in order: the last one stays
        rest = np.flatnonzero((lengths > 0) & (last < ends - 1))
        owner = np.concatenate([row[cut], rest])
        order = np.argsort(owner, kind="stable")
        sums = np.concatenate([total[cut], at_end[rest]])[order]
        owner = owner[order]
        before = np.empty_like(sums)
        before[1:] = sums[:-1]
        new = np.ones(len(owner), bool)
        new[1:] = owner[1:] != owner[:-1]
        before[new] = at_start[owner[new]]
        signs = _characters(sums - before).tobytes().decode("ascii")
        bounds = 2 * np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            signatures[i].append(signs[bounds[i]:bounds[i + 1]])
    return [f"{k}:" + ":".join(s) for k, s in zip(own.tolist(), signatures)]


def _longest_common(one: list[str], two: list[str]) -> int:
    """Length of the longest common subsequence; one bit a chunk."""
    where: dict[str, int] = {}
    for i, chunk in enumerate(one):
        where[chunk] = where.get(chunk, 0) | 1 << i
    full = (1 << len(one)) - 1
    free = full
    for chunk in two:
        match = free & where.get(chunk, 0)
        free = ((free + match) | (free - match)) & full
    return len(one) - free.bit_count()


def likeness(one: str, two: str) -> float:
    if one == two:
        return 1.0
    first, *ones = one.split(":")
    second, *twos = two.split(":")
    level = max(int(first), int(second))
    i, j = level - int(first), level - int(second)
    if i >= len(ones) or j >= len(twos):
        return 0.0
    a = [ones[i][k:k + 2] for k in range(0, len(ones[i]), 2)]
    b = [twos[j][k:k + 2] for k in range(0, len(twos[j]), 2)]
    if not a or not b:
        return float(len(a) == len(b))
    distance = len(a) + len(b) - 2 * _longest_common(a, b)
    return 1.0 - distance / (len(a) + len(b))


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by the start of the next one, of the same length at most."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _compared(ids: list, texts: list[str], prints: list[str], config: PiecewiseConfig) -> list[list]:
    """Result columns of all rows but the last, which is only a successor here."""
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    new = fingerprints(changed, config)
    return [ids[:-1], [len(t) for t in texts[:-1]], [hashlib.sha256(c).hexdigest() for c in changed],
            prints[:-1], new, [likeness(a, b) for a, b in zip(prints, new)],
            [likeness(a, b) for a, b in zip(prints, prints[1:])]]


def _slices(batch: pa.RecordBatch, limit: int = 4 * _TEXTS):
    """Consecutive (ids, texts) of a batch, a bounded number of bytes (one row at least) each."""
    text = C.as_text(batch.column(1))
    for a, b, _, _ in C.blocks(text, limit):
        yield batch.column(0).slice(a, b - a).to_pylist(), text.slice(a, b - a).to_pylist()


def _walk(config: PiecewiseConfig):
    """Rows of a sorted partition: results (edge 0) for all but its last, and its first and last (edge 1, 2)."""
    schema = pa.schema([(n, t) for n, t in zip(_NAMES, (
        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))]
        + [("edge", pa.int32()), ("part", pa.int32()), ("text", pa.string())])

    def run(batches):
        part = TaskContext.get().partitionId()
        first = last = None
        for batch in batches:
            for ids, texts in _slices(batch):
                prints = fingerprints([t.encode() for t in texts], config)
                if first is None:
                    first = (ids[0], texts[0], prints[0])
                else:
                    ids, texts, prints = ([last[k], *v] for k, v in enumerate((ids, texts, prints)))
                last = (ids[-1], texts[-1], prints[-1])
                n = len(ids) - 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    [*_compared(ids, texts, prints, config), [0] * n, [part] * n, [None] * n], schema)], schema=schema)
        if first is not None:
            blank = [None, None]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                [[first[0], last[0]], [len(first[1]), len(last[1])], blank, [first[2], last[2]], blank, blank, blank,
                 [1, 2], [part, part], [first[1], last[1]]], schema)], schema=schema)
    return run


def edits(docs: DataFrame, config: PiecewiseConfig = PiecewiseConfig()) -> DataFrame:
    """For each document its fingerprint, that of its edited text, and their likeness and the next one's."""
    spark = docs.sparkSession
    C.ship(spark)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    walked = C.written(
        chosen.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
        .mapInArrow(_walk(config), _RESULT + ", edge int, part int, text string"), "edits")

    # a number for each partition that has rows: which one comes next
    parts = sorted(r["part"] for r in walked.where("edge = 1").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    lasts = walked.where("edge = 2").select("part", "doc_id", "text", "fingerprint").join(F.broadcast(follows), "part")
    firsts = walked.where("edge = 1").select(F.col("part").alias("next"), F.col("text").alias("after"),
                                             F.col("fingerprint").alias("after_print"))

    def close(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                key, text, mine, after, theirs = (c[i].as_py() for c in batch.columns)
                columns = _compared([key, None], [text, after], [mine, theirs], config)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                    names=_NAMES)

    closed = (lasts.join(firsts, "next").select("doc_id", "text", "fingerprint", "after", "after_print")
              .mapInArrow(close, _RESULT))
    return walked.where("edge = 0").select(*_NAMES).unionByName(closed)


def op11_fingerprints(spark, sf_dir):
    return edits(C.scan(spark, sf_dir, "documents"))
