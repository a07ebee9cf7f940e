"""Audit of how quality filters overlap: every order of five filters, from one pass over the texts.

The pass is a table-driven transducer over UTF-8 bytes. A byte's class and the state (inside a word or
not) name the output: a word begins, a code point, a capital, a symbol, a word has ended. Counts are sums
of outputs; word spans go into an open-addressing table whose slots are compared byte by byte with what
is to be inserted, so equal hashes never merge different words. State and sums are carried from piece
to piece of a text.

What a filter order does follows from how many documents fail which *set* of filters: at most 32 sets a
part, counted exactly; the 120 orders are evaluated on these counts.

Exact copies are known by the SHA-256 of the text. Rows of one text meet as counts by (digest, part,
labels), combined before the shuffle, so a text with a third of all rows is a handful of rows.

Nulls: a null text is empty, a null language the part ``''``. A row without id has no smaller id, so it
never fails the copy filter, and its id makes no one else fail. Of repeated rows with the smallest id none
fails. A document is good or toxic if any of its label rows says so; labels without id say nothing. An
empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import common as C

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

# byte classes
_OTHER, _GAP, _CONTINUED, _CAPITAL, _SYMBOL = range(5)
# outputs of a step
_BEGIN, _POINT, _UPPER, _SIGN, _END = (1 << k for k in range(5))
_OUT, _IN = 0, 1                   # states: outside of a word, inside
_PIECE = 1 << 18                   # bytes the transducer takes at a time


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _GAP
    table[0x80:0xC0] = _CONTINUED
    table[ord("A"):ord("Z") + 1] = _CAPITAL
    table[list(b"#$%&*|")] = _SYMBOL
    return table


def _outputs() -> np.ndarray:
    """Output by state and class."""
    table = np.zeros((2, 5), np.uint8)
    table[:, [_OTHER, _GAP, _CAPITAL, _SYMBOL]] |= _POINT
    table[:, _CAPITAL] |= _UPPER
    table[:, _SYMBOL] |= _SIGN
    table[_OUT, [_OTHER, _CONTINUED, _CAPITAL, _SYMBOL]] |= _BEGIN
    table[_IN, _GAP] |= _END
    return table


_CLASS, _OUTPUT = _classes(), _outputs()
_NEXT = np.where(np.arange(5) == _GAP, _OUT, _IN).astype(np.uint8)   # the same from either state


def transduce(data: np.ndarray, off: np.ndarray):
    """(starts, ends, row) of the words of a block's rows, and code points, capitals, symbols by row.

    Every row begins outside of a word; a word still open at its end is closed there."""
    rows = len(off) - 1
    points, capitals, signs = np.zeros((3, rows), np.int64)
    starts, ends = [], []
    first = np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True
    state = _OUT
    for a in range(0, len(data), _PIECE):
        piece = data[a:a + _PIECE]
        kind = _CLASS[piece]
        before = np.empty(len(piece), np.uint8)
        before[0], before[1:] = state, _NEXT[kind[:-1]]
        state = int(_NEXT[kind[-1]])
        closed = np.flatnonzero(first[a:a + len(piece)] & (before == _IN))   # the row before ended in a word
        before[first[a:a + len(piece)]] = _OUT
        out = _OUTPUT[before, kind]
        starts.append(np.flatnonzero(out & _BEGIN) + a)
        ends.append(np.union1d(np.flatnonzero(out & _END), closed) + a)
        low, high = np.searchsorted(off, [a, a + len(piece)], "right")
        row = slice(max(low - 1, 0), min(high, rows))
        cut = np.clip(off[row.start:row.stop + 1] - a, 0, len(piece))
        for total, bit in ((points, _POINT), (capitals, _UPPER), (signs, _SIGN)):
            total[row] += C.per_row(out & bit != 0, cut)
    if state == _IN:
        ends.append(np.array([len(data)]))
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(off, starts, "right") - 1, points, capitals, signs


def _eights(data: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as one number (zeros beyond the end)."""
    out = np.zeros(len(data) + 8, np.uint64)
    out[:len(data)] = data
    for width in (1, 2, 4):
        out[:-width] |= out[width:] << np.uint64(8 * width)
    return out


def _same(data, eights, starts, lengths, one, two) -> np.ndarray:
    """Are words ``one`` and ``two`` (indices) the same bytes?"""
    same = lengths[one] == lengths[two]
    at = np.flatnonzero(same)
    step = 0
    while len(at) and step < 64:
        keep = np.minimum(lengths[one[at]] - step, 8).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - keep * np.uint64(8))
        equal = (eights[starts[one[at]] + step] ^ eights[starts[two[at]] + step]) & mask == 0
        same[at[~equal]] = False
        step += 8
        at = at[equal]
        at = at[lengths[one[at]] > step]
    for i in at:                       # the rest of long words
        a, b, n = starts[one[i]] + step, starts[two[i]] + step, lengths[one[i]] - step
        same[i] = np.array_equal(data[a:a + n], data[b:b + n])
    return same


def distinct_words(data, starts, ends, row, rows: int, hashes=C.word_hashes) -> np.ndarray:
    """Distinct words per row: all spans are inserted at once, each round one probe further."""
    n = len(starts)
    if not n:
        return np.zeros(rows, np.int64)
    lengths, eights = ends - starts, _eights(data)
    mask = (1 << (2 * n - 1).bit_length()) - 1
    seed = C.mix(row.astype(np.uint64) + np.uint64(1))
    place = (C.mix(hashes(data, starts, ends) ^ seed) & np.uint64(mask)).astype(np.int64)
    slot = np.full(mask + 1, -1, np.int64)
    pending, kept = np.arange(n), np.zeros(n, bool)
    while len(pending):
        at = place[pending]
        free = slot[at] < 0
        slot[at[free]] = pending[free]            # of several, one stays
        owner = slot[at]
        kept[pending[owner == pending]] = True
        done = owner == pending
        rest = np.flatnonzero(~done & (row[owner] == row[pending]))
        done[rest] = _same(data, eights, starts, lengths, pending[rest], owner[rest])
        pending = pending[~done]
        place[pending] = (place[pending] + 1) & mask
    return np.bincount(row[kept], minlength=rows)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and the counts of each document: n_words, n_distinct, n_chars, n_capitals, n_symbols."""
    names = ["doc_id", "part", "digest", "n_words", "n_distinct", "n_chars", "n_capitals", "n_symbols"]

    def run(batches):
        for batch in batches:
            got, digests = np.zeros((5, batch.num_rows), np.int64), []
            for a, b, data, off in C.blocks(batch.column(2)):
                starts, ends, row, points, capitals, signs = transduce(data, off)
                got[0, a:b] = np.bincount(row, minlength=b - a)
                got[1, a:b] = distinct_words(data, starts, ends, row, b - a)
                got[2:, a:b] = points, capitals, signs
                whole = memoryview(np.ascontiguousarray(data))
                digests += [hashlib.sha256(whole[i:j]).digest() for i, j in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), *map(pa.array, got)], names=names)

    C.ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text")
            .mapInArrow(run, "doc_id long, part string, digest binary, " + ", ".join(f"{n} long" for n in names[3:])))


def failures(profiled: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): documents by the set of filters they fail, bit k for the k-th."""
    tests = [F.col("n_words") < 100, 100 * F.col("n_distinct") < 80 * F.col("n_words"),
             100 * F.col("n_capitals") > 10 * F.col("n_chars"), F.col("n_symbols") > 0]
    fails = sum((t.cast("int") * (1 << k) for k, t in enumerate(tests)), F.lit(0))
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    # rows of one id are counted first, so that below an id occurs once
    ids = (profiled.select("doc_id", "part", "digest", fails.alias("fails")).join(marked, "doc_id", "left")
           .select("doc_id", "part", "digest", "fails", *flags)
           .groupBy("doc_id", "part", "digest", "fails", "good", "toxic").agg(F.count("*").alias("n")))
    key = ["digest", "fails", "part", "good", "toxic"]
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = ids.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("free"),
        least.alias("least"))
    # a digest has as many rows here as parts and labels: few, whatever its copies
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    kept = F.col("free") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    both = groups.withColumn("kept", kept)
    last = 1 << (len(FILTERS) - 1)
    split = F.explode(F.array(F.struct(F.col("fails").alias("set"), F.col("kept").alias("rows")),
                              F.struct((F.col("fails") + last).alias("set"), (F.col("n") - F.col("kept")).alias("rows"))))
    return (both.select("part", "good", "toxic", split.alias("_s"))
            .groupBy("part", F.col("_s.set").alias("fails"), "good", "toxic").agg(F.sum("_s.rows").alias("n")))


def interactions(counts: DataFrame) -> DataFrame:
    """What each filter removes at each step of each order, from the counts of ``failures``."""
    steps = [F.struct(F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"),
                      F.lit(1 << FILTERS.index(letter)).alias("own"),
                      F.lit(sum(1 << FILTERS.index(x) for x in order[:k])).alias("earlier"))
             for order in ORDERS for k, letter in enumerate(order)]
    rows = counts.select("*", F.explode(F.array(*steps)).alias("_at")).select("*", "_at.*")
    fails_own = F.col("fails").bitwiseAND(F.col("own")) != 0
    reached = F.col("fails").bitwiseAND(F.col("earlier")) == 0

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    audit = rows.groupBy("part", "filter_order", "step", "own").agg(
        total(reached & ~fails_own).alias("kept"), total(reached & fails_own).alias("removed"),
        total(~reached & fails_own).alias("redundant"), total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(reached & fails_own & (F.col("good") == 1)).alias("good_lost"),
        total(reached & fails_own & (F.col("toxic") == 1)).alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "own"))     # 120 rows each
    return audit.withColumn("shapley", shapley).drop("own")


def op12_filter_audit(spark, sf_dir):
    docs, labels = C.scan(spark, sf_dir, "documents"), C.scan(spark, sf_dir, "labels")
    return interactions(failures(profiles(docs), labels))


SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
firsts AS (SELECT text, min(doc_id) AS least FROM words GROUP BY text),
flagged AS (
    SELECT w.doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
        100 * len(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 10 * len(w.text) AS c,
        regexp_matches(w.text, '[#$%&*|]') AS d, coalesce(w.doc_id > least, false) AS e
    FROM words w JOIN firsts f ON f.text = w.text),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails, coalesce(good, 0) AS good,
        coalesce(toxic, 0) AS toxic, count(*) AS n
    FROM flagged f LEFT JOIN marks m ON m.doc_id = f.doc_id GROUP BY ALL),
orders(filter_order) AS (
    SELECT '' UNION ALL
    SELECT filter_order || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) l(x) WHERE NOT contains(filter_order, x)),
steps AS (
    SELECT filter_order, step::INT AS step, (1 << (ascii(filter_order[step]) - 65)) AS own,
        coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::BIGINT AS earlier
    FROM orders, range(1, 6) s(step) WHERE len(filter_order) = 5),
audit AS (
    SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (fails & earlier = 0 AND fails & own = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (fails & earlier = 0 AND fails & own <> 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails & earlier <> 0 AND fails & own <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (fails & earlier = 0 AND fails & own <> 0 AND good = 1), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (fails & earlier = 0 AND fails & own <> 0 AND toxic = 1), 0)::BIGINT AS toxic_lost
    FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM audit
"""
