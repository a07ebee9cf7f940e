"""Scoring of documents by masked pseudo-likelihood.

A network with one hidden layer predicts every word from the words on both sides (``reach`` a side). Words
enter it by hashed embeddings: each is the sum of two rows of one table, so every word of the corpus has a
combination of its own while the weights have a fixed size. It predicts in two levels, both from the same
hidden layer: first the token (a common short word, or a bucket by last bytes), then, for words of a bucket,
one of ``codes`` codes of the word's hash; the second level starts from the counts of bucket and code. A word
has its share of the occurrences of its bucket and code in the corpus: counts of all words of all documents,
in a distributed table that grows with the corpus and is gathered nowhere. A document's score is the sum of
its words' log-probabilities (natural logarithm).

Documents are written in blocks of consecutive rows. Each block names its distinct words, counts come back to
it by a join on the word (only those of two and more; a word without one occurs once), and a worker holds the
counts of one block at a time. Training takes numpy mini-batches inside partitions: each document in one of
the rounds, every position of it once, drawn in runs of ``stride``; after a round the weights are averaged by a
distributed sum.

Nulls: a null or blank text has no token, log-probability 0 and a null mean. An empty table trains
nothing and gives an empty result. Repeated rows and ids are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C
from waybill.llm.quality import _common_candidates


@dataclass(frozen=True)
class LmConfig:
    words: int = 31         # common words with a token of their own
    buckets: int = 32       # tokens of all other words
    word_bytes: int = 7     # longer words have no token of their own
    codes: int = 64         # of the words of a bucket
    rows: int = 4096        # of the table of embeddings
    dim: int = 16           # of embeddings and hidden layer
    reach: int = 2          # words of context a side
    rounds: int = 6
    stride: int = 16        # neighbouring positions that are drawn together; all are trained on
    batch: int = 1024       # positions of a step
    rate: float = 0.02
    seed: int = 7
    block: int = 13         # 2 ** block documents share one look-up of words

    @property
    def size(self) -> int:
        return 1 + self.words + self.buckets  # 0 is not used

    @property
    def shifts(self) -> list[int]:
        return [j for j in range(-self.reach, self.reach + 1) if j]


@dataclass
class Tokens:
    """Words of some rows: token, hash, code within the bucket, and row."""
    token: np.ndarray
    hash: np.ndarray
    code: np.ndarray
    row: np.ndarray

    def cell(self, config: LmConfig) -> np.ndarray:
        """Number of bucket and code; of a common word minus its token."""
        bucket = self.token - 1 - config.words
        return np.where(bucket >= 0, bucket * config.codes + self.code, -self.token)


def tokens(data, off, vocabulary: np.ndarray, config: LmConfig) -> Tokens:
    starts, ends, row = C.word_spans(data, off)
    value, short = _common_candidates(data, starts, ends, config.word_bytes)
    tail = np.zeros(len(starts), np.uint64)
    for j in range(1, 4):
        at = np.maximum(ends - j, starts)
        tail = tail * np.uint64(256) + C.LOWER[data[at]]
    token = 1 + config.words + (C.mix(tail) % np.uint64(config.buckets)).astype(np.int64)
    if len(vocabulary):
        at = np.minimum(np.searchsorted(vocabulary, value), len(vocabulary) - 1)
        hit = vocabulary[at] == value
        token[short[hit]] = 1 + at[hit]
    h = C.word_hashes(C.LOWER[data], starts, ends)
    return Tokens(token, h, ((h >> np.uint64(48)) % np.uint64(config.codes)).astype(np.int64), row)


def dealt(docs: DataFrame, config: LmConfig = LmConfig()) -> DataFrame:
    """doc_id, text, at (number of the row): a table, so that rows keep their numbers."""
    return C.written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                     .withColumn("at", F.monotonically_increasing_id()), "dealt", compression="zstd")


def vocabulary(docs: DataFrame, config: LmConfig = LmConfig()) -> np.ndarray:
    """Values of the most common short words of all documents, ascending."""
    def partial(batches):
        for batch in batches:
            seen: dict = {}
            for _, _, data, off in C.blocks(batch.column(0), 1 << 21):
                starts, ends, _ = C.word_spans(data, off)
                words, count = np.unique(_common_candidates(data, starts, ends, config.word_bytes)[0], return_counts=True)
                for w, n in zip(words.tolist(), count.tolist()):
                    seen[w] = seen.get(w, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                             names=["w", "n"])

    C.ship(docs.sparkSession)
    top = (docs.select("text").mapInArrow(partial, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "w").limit(config.words).collect())
    return np.array(sorted(r["w"] for r in top), np.int64)


def block_words(table: DataFrame, words: np.ndarray, config: LmConfig = LmConfig()) -> DataFrame:
    """(block, w, cell, n): distinct words of the blocks, combined by record batch; a block that several
    batches share may name a word more than once."""
    def partial(batches):
        for batch in batches:
            block = np.asarray(batch.column(1)) >> config.block
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                parts = []
                for _, _, data, off in C.blocks(batch.column(0).slice(a, b - a), 1 << 22):
                    t = tokens(data, off, words, config)
                    w, first, n = np.unique(t.hash.view(np.int64), return_index=True, return_counts=True)
                    parts.append((w, t.cell(config)[first], n))
                if len(parts) > 1:
                    w, cell, n = map(np.concatenate, zip(*parts))
                    w, first, at = np.unique(w, return_index=True, return_inverse=True)
                    parts = [(w, cell[first], np.bincount(at, n, minlength=len(w)).astype(np.int64))]
                for w, cell, n in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(w), block[a])), pa.array(w), pa.array(cell), pa.array(n)],
                        names=["block", "w", "cell", "n"])

    C.ship(table.sparkSession)
    return C.written(table.select("text", "at").mapInArrow(partial, "block long, w long, cell long, n long"), "words")


def cell_counts(named: DataFrame, config: LmConfig = LmConfig()) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences by token, and by bucket and code; a row for each of them reaches the driver."""
    token, cell = np.zeros(config.size), np.zeros((config.buckets, config.codes))
    for r in named.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        if r["cell"] < 0:
            token[-r["cell"]] = r["n"]
        else:
            cell[divmod(r["cell"], config.codes)] = r["n"]
    token[1 + config.words:] = cell.sum(1)
    return token, cell


class Network:
    """Embeddings, weights of each place in the context, hidden bias, output weights and bias of the tokens,
    output weights of the codes. The codes' bias is their logarithmic count and is not trained."""

    def __init__(self, config: LmConfig, token: np.ndarray, cell: np.ndarray, flat: np.ndarray | None = None):
        v, d = config.size, config.dim
        self.config, self.base = config, np.log(cell + 1).astype(np.float32)
        shapes = [(config.rows, d), (len(config.shifts), d), (d,), (d, v), (v,), (d, config.codes)]
        if flat is None:
            rng = np.random.default_rng(config.seed)
            start = [rng.normal(0, 0.3, shapes[0]), np.ones(shapes[1]) / len(config.shifts) ** 0.5, np.zeros(d),
                     np.zeros(shapes[3]), np.log(token + 1), np.zeros(shapes[5])]
            flat = np.concatenate([x.ravel() for x in start]).astype(np.float32)
        self.flat = flat
        cut = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])
        self.parts = [flat[a:b].reshape(s) for a, b, s in zip(cut, cut[1:], shapes)]

    def rows_of(self, h: np.ndarray):
        n = np.uint64(self.config.rows)
        return (h % n).astype(np.int64), ((h >> np.uint64(32)) % n).astype(np.int64)

    def hidden(self, t: Tokens, a: int, b: int) -> np.ndarray:
        """Of the positions from a to b, a column each, and a row of ones for the bias. (Long rows are what numpy
        is fast with.)"""
        table, scale, bias = self.parts[:3]
        first, last = max(0, a - self.config.reach), min(len(t.row), b + self.config.reach)
        left, right = self.rows_of(t.hash[first:last])
        word, row = (table[left] + table[right]).T.copy(), t.row[first:last]
        out = np.ones((self.config.dim + 1, b - a), word.dtype)
        out[:-1] = bias[:, None]
        for s, j in zip(scale, self.config.shifts):
            lo, hi = max(a + j, first), min(b + j, last)        # the neighbours that there are
            if lo < hi:
                same = row[lo - first:hi - first] == row[lo - j - first:hi - j - first]
                near = word[:, lo - first:hi - first] * s[:, None]
                near *= same.astype(word.dtype)
                out[:-1, lo - j - a:hi - j - a] += near
        np.tanh(out[:-1], out[:-1])
        return out

    def log_probabilities(self, t: Tokens, step: int = 1 << 11) -> np.ndarray:
        """Of each word's token, and of its code if it is in a bucket."""
        weights, bias, codes = self.parts[3:]
        out = np.zeros(len(t.token))
        bias, safe = _lowered(weights, bias[None])
        base, safe_codes = _lowered(codes, self.base)
        first = np.vstack([weights, bias])
        for a in range(0, len(out), step):
            h = self.hidden(t, a, min(a + step, len(out)))
            token = t.token[a:a + step]
            out[a:a + step] = _log_softmax_at(h.T @ first, token, safe)
            other = np.flatnonzero(token > self.config.words)
            z = h[:-1, other].T @ codes
            z += base[token[other] - 1 - self.config.words]
            out[a + other] += _log_softmax_at(z, t.code[a:a + step][other], safe_codes)
        return out

    def gradient(self, t: Tokens, starts: np.ndarray) -> tuple[np.ndarray, int]:
        """Of the mean negative log-probability at the positions of the runs of ``stride`` words from ``starts``
        (up to the last word), and the number of positions. Arrays are (dim, place in the run, run)."""
        config, (table, scale, bias, weights, out_bias, codes) = self.config, self.parts
        d, n, reach, length = config.dim, len(t.row), config.reach, config.stride
        near = np.arange(-reach, length + reach)[:, None] + starts
        inside = (near >= 0) & (near < n)
        near = np.clip(near, 0, n - 1)
        here, row = slice(reach, reach + length), t.row[near]
        left, right = (x.ravel() for x in self.rows_of(t.hash[near]))
        word = np.take(table, left, 0)
        word += np.take(table, right, 0)
        word = word.T.copy().reshape(d, *near.shape)
        word *= inside
        h = np.ones((d + 1, length, len(starts)), np.float32)      # the last row is for the bias of the tokens
        h[:-1] = bias[:, None, None]
        same = {}
        for s, j in zip(scale, config.shifts):
            same[j] = (row[here] == row[reach + j:reach + j + length]).astype(np.float32)
            sent = word[:, reach + j:reach + j + length] * same[j]
            sent *= s[:, None, None]
            h[:-1] += sent
        np.tanh(h[:-1], h[:-1])
        known, at, flat = inside[here].ravel(), near[here].ravel(), h.reshape(d + 1, -1)
        count, both, token = int(known.sum()), np.hstack([weights, codes]), t.token[at]
        bucket = token - 1 - config.words
        g = self._both_softmax(flat[:-1].T @ both, bucket)
        other = np.flatnonzero(bucket >= 0)
        g[np.arange(len(at)), token] -= 1
        g[other, config.size + t.code[at[other]]] -= 1
        if count < len(at):
            g[~known] = 0
        back, out_g = both @ g.T, flat @ g
        np.multiply(flat[:-1], flat[:-1], flat[:-1])
        back *= np.subtract(1, flat[:-1], flat[:-1])
        back = back.reshape(d, length, -1)
        to_word, scale_g = np.zeros_like(word), np.zeros_like(scale)
        for i, j in enumerate(config.shifts):
            sent, place = back * same[j], slice(reach + j, reach + j + length)
            scale_g[i] = (sent * word[:, place]).reshape(d, -1).sum(1)
            sent *= scale[i][:, None, None]
            to_word[:, place] += sent
        to_word *= inside
        hit, to_word = np.concatenate([left, right]), to_word.reshape(d, -1).astype(float)
        table_g = np.array([np.bincount(hit, np.concatenate([x, x]), config.rows) for x in to_word], np.float32).T
        tokens_g, codes_g = out_g[:, :config.size], out_g[:-1, config.size:]
        parts = [table_g.ravel(), scale_g.ravel(), back.sum((1, 2)), tokens_g.ravel(), codes_g.ravel()]
        out = np.concatenate(parts)
        out *= np.float32(1 / max(count, 1))
        return out, count

    def _both_softmax(self, z: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Probabilities of the tokens, and beside them of the codes (0 where ``bucket`` is negative), in place."""
        weights, out_bias, codes = self.parts[3:]
        token, safe = _lowered(weights, out_bias[None])
        code, safe_codes = _lowered(codes, self.base)
        z += np.hstack([np.broadcast_to(token, (len(code), token.shape[1])), code])[np.maximum(bucket, 0)]
        parts = z[:, :self.config.size], z[:, self.config.size:]
        for part, ok in zip(parts, (safe, safe_codes)):
            if not ok:
                part -= part.max(1, keepdims=True)
        np.exp(z, z)
        for part, takes_part in zip(parts, (1, bucket >= 0)):
            part *= (takes_part / (part @ np.ones(part.shape[1], z.dtype))).astype(z.dtype)[:, None]
        return z

    def step(self, g: np.ndarray, mean: np.ndarray, square: np.ndarray, steps: int, rate: float) -> None:
        """Against the gradient ``g``, by its running mean over the root of its running square. In place: the
        arrays are large enough that new ones would cost more than the sums."""
        mean *= np.float32(0.9)
        square *= np.float32(0.98)
        much = g * np.float32(0.1)
        mean += much
        np.multiply(g, g, g)
        g *= np.float32(0.02)
        square += g
        np.sqrt(square, g)
        g += np.float32(1e-6 * (1 - 0.98 ** steps) ** 0.5)
        np.divide(mean, g, much)
        much *= np.float32(rate * (1 - 0.98 ** steps) ** 0.5 / (1 - 0.9 ** steps))
        self.flat -= much


def _lowered(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
    """``bias`` with its rows lowered so that no sum of it and a hidden layer (between -1 and 1) exceeds 0, and
    whether exp of some column of each row stays above zero then."""
    reach = np.abs(weights).sum(0)
    lowered = bias - (bias + reach).max(1, keepdims=True)
    return lowered, bool(((lowered - reach).max(1) > -80).all())


def _log_softmax_at(z: np.ndarray, column: np.ndarray, safe: bool) -> np.ndarray:
    if not safe:
        z -= z.max(1, keepdims=True)
    mine = z[np.arange(len(z)), column]
    return mine - np.log(np.exp(z, z) @ np.ones(z.shape[1], z.dtype))


def train(table: DataFrame, words: np.ndarray, token: np.ndarray, cell: np.ndarray, config: LmConfig = LmConfig()) -> Network:
    """The network after ``rounds`` rounds over the partitions of ``table``; each row is in one round, with all its
    positions."""
    net, pieces, runs = Network(config, token, cell), 32, max(1, config.batch // config.stride)
    C.ship(table.sparkSession)
    for r in range(config.rounds):
        flat, rate = net.flat, config.rate / (1 + r / 2)

        def local(batches, flat=flat, rate=rate, r=r):
            own = Network(config, token, cell, flat.copy())
            mean, square = np.zeros_like(flat), np.zeros_like(flat)
            seen = steps = 0
            for batch in batches:
                for _, _, data, off in C.blocks(batch.column(0)):
                    t = tokens(data, off, words, config)
                    starts = np.random.default_rng(r).permutation(np.arange(0, len(t.token), config.stride))
                    for a in range(0, len(starts), runs):
                        g, count = own.gradient(t, starts[a:a + runs])
                        steps, seen = steps + 1, seen + count
                        own.step(g, mean, square, steps, rate)
            if seen:
                parts = np.array_split(own.flat, pieces)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(pieces), pa.int64()), pa.array([seen] * pieces, pa.int64()),
                     pa.array([p.tobytes() for p in parts], pa.binary())], names=["piece", "n", "weights"])

        def total(batches):
            sums: dict = {}
            for batch in batches:
                for piece, n, w in zip(*(c.to_pylist() for c in batch.columns)):
                    count, held = sums.get(piece, (0, 0.0))
                    sums[piece] = count + n, held + n * np.frombuffer(w, np.float32).astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([n for n, _ in sums.values()], pa.int64()),
                 pa.array([(s / n).astype(np.float32).tobytes() for n, s in sums.values()], pa.binary())],
                names=["piece", "n", "weights"])

        schema = "piece long, n long, weights binary"
        rows = (table.filter(F.col("at") % config.rounds == r).select("text").mapInArrow(local, schema)
                .repartition(pieces, "piece").sortWithinPartitions("piece", "n", "weights")
                .mapInArrow(total, schema).collect())       # the weights once, in pieces
        if rows:
            net = Network(config, token, cell, np.concatenate(
                [np.frombuffer(x["weights"], np.float32) for x in sorted(rows, key=lambda x: x["piece"])]))
    return net


def score(table: DataFrame, named: DataFrame, words: np.ndarray, net: Network, cell: np.ndarray,
          config: LmConfig = LmConfig()) -> DataFrame:
    """doc_id, n_tokens, log_prob, mean_log_prob of the rows of ``table``."""
    other = named.filter("cell >= 0")
    counts = other.groupBy("w").agg(F.sum("n").alias("total")).filter("total > 1")
    sent = other.select("block", "w").join(counts, "w")
    rows = sent.select("block", "w", F.col("total").alias("number"), F.lit(None).cast("string").alias("text")).unionByName(
        table.select(F.shiftright("at", config.block).alias("block"), F.lit(None).cast("long").alias("w"),
                     F.col("doc_id").alias("number"), "text"))
    rows = rows.repartition("block").sortWithinPartitions("block", F.col("w").isNull())
    flat, most = net.flat, np.log(cell.ravel() + 1)
    token = np.zeros(config.size)

    def scored(column, known, total):
        own = Network(config, token, cell, flat)
        count, value = [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b, data, off in C.blocks(column):
            t = tokens(data, off, words, config)
            log = own.log_probabilities(t)
            inside = np.flatnonzero(t.token > config.words)
            log[inside] -= most[t.cell(config)[inside]]
            if len(known):
                h = t.hash.view(np.int64)[inside]
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                log[inside] += np.where(known[at] == h, total[at], 0.0)
            count.append(np.bincount(t.row, minlength=b - a))
            value.append(np.bincount(t.row, log, minlength=b - a))
        return np.concatenate(count), np.concatenate(value)

    def run(batches):
        now, held, lookup = None, [], None
        for batch in batches:
            block, is_word = np.asarray(batch.column(0)), np.asarray(batch.column(1).is_valid())
            change = (np.diff(block) != 0) | (np.diff(is_word.astype(np.int8)) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now != block[a]:
                    now, held, lookup = block[a], [], None
                part = batch.slice(a, b - a)
                if is_word[a]:
                    held.append((np.asarray(part.column(1)), np.asarray(part.column(2))))
                    continue
                if lookup is None:
                    w, n = map(np.concatenate, zip(*held)) if held else (np.zeros(0, np.int64), np.ones(0))
                    w, first = np.unique(w, return_index=True)
                    lookup, held = (w, np.log(n[first])), []
                n, s = scored(part.column(3), *lookup)
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), pa.array(n.astype(np.int64)), pa.array(s), pa.array(s / np.maximum(n, 1), mask=n == 0)],
                    names=["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    C.ship(table.sparkSession)
    C.record_batches(table.sparkSession, 2000)
    return rows.mapInArrow(run, "doc_id long, n_tokens long, log_prob double, mean_log_prob double")


def pseudo_likelihood(docs: DataFrame, config: LmConfig = LmConfig()) -> DataFrame:
    table = dealt(docs, config)
    words = vocabulary(table, config)
    named = block_words(table, words, config)
    token, cell = cell_counts(named, config)
    return score(table, named, words, train(table, words, token, cell, config), cell, config)


def op3_lm_score(spark, sf_dir):
    return pseudo_likelihood(C.scan(spark, sf_dir, "documents"))
