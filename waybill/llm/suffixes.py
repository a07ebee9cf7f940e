"""Removal of repeated passages with a suffix order built column by column.

Every string of ``length`` bytes is filed under its anchor, the k-gram with the least hash in it; equal
strings have equal anchors at the same place, and neighbouring strings share one, so a document falls
into short fragments of consecutive strings with a common anchor. Anchors that occur once end there.
The fragments of repeated anchors, equal ones as one with a count, form collections of many small
documents, aligned at their anchors. A collection's suffix order is built by columns from the right:
each round puts one more symbol in front of every fragment; the symbols, listed in the order so far, are
the column's Burrows-Wheeler transform, a stable sort by them is the next order, and the common prefixes
follow from least values between old neighbours, in one pass from front to back. A string that shares
``length`` bytes with a neighbour, or whose fragment occurs more than once, is repeated.

Collections are blocks of bounded size in memory: the shuffle by anchor has done the external sorting,
so a round needs no file of its own. An anchor with more fragments than a block may hold is split by the
strings themselves.

Bytes are those of the UTF-8 text. A repeated string is removed at all places, the first included.
Nulls: a null text is an empty one and loses nothing; null ids are ids like others. Repeated rows are
copies of each other, so their passages repeat.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import common as C


@dataclass(frozen=True)
class SuffixConfig:
    length: int = 200            # bytes of a repeated string
    anchor: int = 64             # bytes of the k-gram that files it
    chunk: int = 1 << 19         # bytes of text in one numpy pass
    block: int = 1 << 20         # bytes of fragments in one collection, if anchors allow
    most_fragments: int = 8192   # of one anchor in a collection; more are split
    broadcast_rows: int = 1_000_000  # ids of documents to look at; more are not sent around


def fragments(data: np.ndarray, off: np.ndarray, config: SuffixConfig):
    """(row, start in the row, number of strings, anchor's place in the fragment, anchor's hash)."""
    L, k = config.length, config.anchor
    out = []
    for c in range(0, max(0, len(data) - L + 1), config.chunk):
        part = data[c:c + config.chunk + L - 1]
        n = len(part) - L + 1
        if n <= 0:
            break
        at = np.arange(len(part) - k + 1)
        h = C.span_hashes(part, at, at + k)
        low = (h >> np.uint64(20) << np.uint64(20)) | at.astype(np.uint64)
        span, width = 1, L - k + 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if width > span:
            low = np.minimum(low[:n], low[width - span:width - span + n])
        place = (low[:n] & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.searchsorted(off, np.arange(c, c + n), "right") - 1 if len(off) < 3 else \
            np.repeat(np.arange(len(off) - 1), np.diff(np.clip(off, c, c + n)))
        good = np.arange(c + L, c + n + L) <= off[first + 1]
        p = np.flatnonzero(good)
        if not len(p):
            continue
        a = place[p]
        new = np.ones(len(p), bool)
        new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1) | (first[p][1:] != first[p][:-1])
        s = np.flatnonzero(new)
        row = first[p[s]]
        out.append((row, p[s] + c - off[row], np.diff(np.append(s, len(p))), a[s] - p[s], h[a[s]].view(np.int64)))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    return tuple(np.concatenate(x) for x in zip(*out))


def repeated(parts: list[bytes], places: list[int], config: SuffixConfig) -> list[np.ndarray]:
    """For each part, which of its strings occur in another part at the same distance from the anchor,
    whose place in each part is given."""
    L = config.length
    size = np.array([len(x) for x in parts])
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(parts), np.uint8)
    hit = np.zeros(len(data), bool)
    right = size - np.array(places)
    enter = right.max() - right                 # the round in which a part's last column comes
    by_round = np.argsort(enter, kind="stable")
    joins = np.searchsorted(enter[by_round], np.arange(int((enter + size).max()) + 1))
    at, done = begin + size - 1, np.zeros(len(parts), np.int64)
    order, common = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    for t in range(len(joins) - 1):
        over = done[order] == size[order]
        if over.any():                          # parts that are complete leave; neighbours close up
            stay = np.flatnonzero(~over)
            if len(stay):
                common = np.minimum.reduceat(common[:stay[-1] + 1], np.append(0, stay[:-1] + 1))
            order = order[stay]
            common = common[:len(order)]
        new = by_round[joins[t]:joins[t + 1]]
        if len(new):                            # empty suffixes come first and share nothing
            order, common = np.append(new, order), np.append(np.zeros(len(new), np.uint8), common)
            common[len(new):len(new) + 1] = 0
        if not len(order):
            continue
        symbol = data[at[order]]                # the transform of this column
        move = np.argsort(symbol, kind="stable")
        common = _shared(symbol[move], move, common, L)
        order = order[move]
        done[order] += 1
        same = np.flatnonzero(common >= L)
        hit[at[order[same]]] = True
        hit[at[order[same - 1]]] = True
        at[order] -= 1
    return [hit[b:b + n - L + 1] for b, n in zip(begin, size)]


def _shared(symbol: np.ndarray, move: np.ndarray, common: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes with the neighbour before after one more symbol: for equal symbols one more than
    the least between the old places."""
    out = np.zeros(len(move), np.uint8)
    ask = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
    if len(ask):
        lo, hi = move[ask - 1] + 1, move[ask] + 1
        near = hi - lo == 1
        least = np.empty(len(ask), np.uint8)
        least[near] = common[lo[near]]
        far = np.flatnonzero(~near)
        if len(far):
            pairs = np.empty(2 * len(far), np.int64)
            by = far[np.argsort(lo[far], kind="stable")]
            pairs[0::2], pairs[1::2] = lo[by], hi[by]
            least[by] = np.minimum.reduceat(np.append(common, 0), pairs)[0::2]
        out[ask] = np.minimum(least.astype(np.int16) + 1, cap)
    return out


def _runs(hit: np.ndarray) -> bytes:
    """Runs of hits as packed (offset, number) pairs."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return np.stack([edge[0::2], edge[1::2] - edge[0::2]], 1).astype("<i4").tobytes()


OCCURRENCE = "doc_id long, th long, mark long, anchor long, lane long, times long"
CUT = "kind int, doc_id long, th long, mark long, anchor long, place int, times long, fid binary, bytes binary"


def _occurrences(docs: DataFrame, config: SuffixConfig) -> DataFrame:
    """A row for each fragment: its place packed as ``mark`` (start, number of strings, anchor's place).

    Lane 0 has one row of an anchor for each batch, with its number in the batch; other rows of the batch
    are known to be repeated (times 2) and spread over lanes, so no anchor gathers them."""
    def run(batches):
        for batch in batches:
            found = []
            for a, b, data, off in C.blocks(batch.column(2), config.chunk):
                row, start, n, place, key = fragments(data, off, config)
                found.append((row + a, start << 16 | n << 8 | place, key))
            if not found:
                continue
            row, mark, key = (np.concatenate(x) for x in zip(*found))
            _, first, at, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            lane = C.mix(mark.astype(np.uint64) + (row.astype(np.uint64) << np.uint64(40))).view(np.int64) | 1
            lane[first] = 0
            for c in range(0, len(row), 1 << 16):
                part = slice(c, c + (1 << 16))
                where = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), batch.column(1).take(where), pa.array(mark[part]), pa.array(key[part]),
                     pa.array(lane[part]), pa.array(count[at][part])], names=["doc_id", "th", "mark", "anchor", "lane", "times"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, OCCURRENCE)


def _cut(found: DataFrame, config: SuffixConfig) -> DataFrame:
    """Texts (kind 0), their fragments of repeated anchors (kind 1), and each distinct fragment of a batch
    with its bytes and its number (kind 2)."""
    def run(batches):
        for batch in batches:
            rows, parts = [], {}
            for doc, th, text, marks in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                rows.append((0, doc, th, None, None, None, None, None, raw))
                for m in marks:
                    start, n = m["mark"] >> 16, m["mark"] >> 8 & 255
                    part = raw[start:start + n + config.length - 1]
                    known = parts.get(part)
                    if known is None:
                        fid = hashlib.blake2b(part, digest_size=16).digest()
                        parts[part] = known = [fid, 0, m["anchor"], m["mark"] & 255]
                    known[1] += 1
                    rows.append((1, doc, th, m["mark"], None, None, None, known[0], None))
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            rows += [(2, None, None, None, anchor, place, times, fid, part) for part, (fid, times, anchor, place) in parts.items()]
            for c in range(0, len(rows), 20_000):
                yield _batch(rows[c:c + 20_000])

    return found.select("doc_id", "th", "text", "marks").mapInArrow(run, CUT)


def _batch(rows):
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    names = ["kind", "doc_id", "th", "mark", "anchor", "place", "times", "fid", "bytes"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _judge(parts: DataFrame, config: SuffixConfig) -> DataFrame:
    """fid, hits (packed runs of repeated strings), from fragments sorted by anchor and fid."""
    L = config.length

    def run(batches):
        block, held, out, group, anchor = [], 0, [], {}, None

        def flush():
            if block:
                for (fid, times, _, _), hit in zip(block, repeated([g[3] for g in block], [g[2] for g in block], config)):
                    if times < 2 and hit.any():
                        out.append((fid, _runs(hit)))
                block.clear()

        def close():
            nonlocal held
            for fid, (times, _, part) in group.items():
                if times > 1:
                    out.append((fid, np.array([[0, len(part) - L + 1]], "<i4").tobytes()))
            if len(group) > 1:
                block.extend((fid, *g) for fid, g in group.items())
                held += sum(len(g[2]) for g in group.values())
            group.clear()
            if held >= config.block:
                flush()
                held = 0

        def drain():
            rows = list(out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                               pa.array([r[1] for r in rows], pa.binary())], names=["fid", "hits"])

        for batch in batches:
            for key, fid, times, place, part in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key != anchor:
                    close()
                    anchor = key
                known = group.setdefault(fid, [0, place, part])
                known[0] += times
            if out:
                yield drain()
        close()
        flush()
        if out:
            yield drain()

    return parts.select("anchor", "fid", "times", "place", "bytes").mapInArrow(run, "fid binary, hits binary")


def _split(parts: DataFrame, config: SuffixConfig) -> DataFrame:
    """fid, hits of fragments whose anchor has too many: their strings meet by their own hash."""
    L = config.length

    def strings(batches):
        for batch in batches:
            for fid, times, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = len(part) - L + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fid] * n, pa.binary()), pa.array([times] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array([hashlib.blake2b(part[i:i + L], digest_size=16).digest() for i in range(n)], pa.binary())],
                    names=["fid", "times", "i", "s"])

    def runs(batches):
        for batch in batches:
            out = []
            for hits in batch.column(1).to_pylist():
                flags = np.zeros(max(hits) + 1, bool)
                flags[hits] = True
                out.append(_runs(flags))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["fid", "hits"])

    parts = parts.groupBy("fid").agg(F.sum("times").alias("times"), F.max("bytes").alias("bytes"))
    each = parts.select("fid", "times", "bytes").mapInArrow(strings, "fid binary, times long, i int, s binary")
    many = each.groupBy("s").agg(F.sum("times").alias("seen")).filter("seen > 1").select("s")
    return (each.join(many, "s").groupBy("fid").agg(F.collect_list("i").alias("i"))
            .mapInArrow(runs, "fid binary, hits binary"))


def _text_hash():
    """Tells apart rows that share an id."""
    return F.xxhash64("text").alias("th")


def repeated_spans(docs: DataFrame, config: SuffixConfig = SuffixConfig()):
    """(spans, texts): (doc_id, th, start, end) of removed bytes, not merged; and the texts concerned."""
    spark = docs.sparkSession
    C.ship(spark)
    C.record_batches(spark, 10_000)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash(), "text") \
               .filter(F.octet_length("text") >= config.length)
    seen = F.sum("times").over(Window.partitionBy("anchor", "lane"))
    again = _occurrences(docs, config).withColumn("seen", seen).filter("seen > 1")
    marks = C.written(again.groupBy("doc_id", "th").agg(F.collect_set(F.struct("mark", "anchor")).alias("marks"))
                      .withColumnRenamed("doc_id", "_doc").withColumnRenamed("th", "_th"), "marks")
    ids = marks.select("_doc").distinct()
    if ids.count() <= config.broadcast_rows:  # then only the documents concerned are shuffled
        docs = docs.join(F.broadcast(ids), docs["doc_id"].eqNullSafe(F.col("_doc")), "left_semi")
    found = docs.join(marks, docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th")))
    cut = C.written(_cut(found, config), "cut", "kind")
    texts = cut.filter("kind = 0").select("doc_id", "th", "bytes")
    where = cut.filter("kind = 1").select("doc_id", "th", (F.shiftright("mark", 16)).alias("start"), "fid")
    parts = cut.filter("kind = 2").select("anchor", "fid", "place", "times", "bytes")
    large = C.written(parts.groupBy("anchor").agg(F.count("*").alias("c"))
                      .filter(F.col("c") > config.most_fragments).select("anchor"), "large")
    split = not large.isEmpty()
    small = parts.join(large, "anchor", "left_anti") if split else parts
    hits = _judge(small.repartition("anchor").sortWithinPartitions("anchor"), config)
    if split:
        hits = hits.unionByName(_split(parts.join(large, "anchor", "left_semi"), config))

    def spans(batches):
        for batch in batches:
            runs = [np.frombuffer(x, "<i4").reshape(-1, 2).astype(np.int64) for x in batch.column(3).to_pylist()]
            index = pa.array(np.repeat(np.arange(len(runs)), [len(r) for r in runs]))
            if not len(index):
                continue
            pair = np.concatenate(runs)
            start = np.asarray(batch.column(2).take(index)) + pair[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(index), batch.column(1).take(index), pa.array(start),
                 pa.array(start + pair[:, 1] - 1 + config.length)], names=["doc_id", "th", "start", "end"])

    out = where.join(hits, "fid").select("doc_id", "th", "start", "hits").mapInArrow(
        spans, "doc_id long, th long, start long, end long")
    return out, texts


def deduplicate(docs: DataFrame, config: SuffixConfig = SuffixConfig()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row for each row of ``docs``."""
    spans, texts = repeated_spans(docs, config)
    per_doc = (spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
               .withColumnRenamed("doc_id", "_doc").withColumnRenamed("th", "_th"))
    same = texts["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))

    def remove(batches):
        for batch in batches:
            rows = []
            for raw, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                step = np.zeros(len(raw) + 1, np.int64)
                np.add.at(step, [s["start"] for s in found], 1)
                np.add.at(step, [s["end"] for s in found], -1)
                gone = np.cumsum(step)[:-1] > 0
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                runs = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
                rows.append((int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
            a, b, c = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())],
                names=["_doc", "_th", "n_removed", "n_spans", "kept"])

    done = (texts.join(per_doc, same).select("doc_id", texts["th"], "bytes", "spans")
            .mapInArrow(remove, "_doc long, _th long, n_removed long, n_spans long, kept string")
            .dropDuplicates(["_doc", "_th"]))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash(),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"))
    done = C.written(done, "removed")
    joined = base.join(done, base["doc_id"].eqNullSafe(F.col("_doc")) & (base["th"] == F.col("_th")), "left")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                         F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                         F.coalesce("kept", "whole").alias("kept_sha256"))


def op10_suffix_dedup(spark, sf_dir):
    return deduplicate(C.scan(spark, sf_dir, "documents"))
