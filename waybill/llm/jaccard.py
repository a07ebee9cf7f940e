"""Similarity join of documents by the Jaccard index of their word n-grams, as a grouped prefix join.

A document is the set of its distinct n-word shingles (A-Z lower-cased, words between white space).

1. A bound drops documents without any partner: of a document's lowest shingles by hash, a part must occur
   in another document's lowest ones. Equal sets become one.
2. The shingles of the rest are ordered by frequency class and hash; documents with equal prefixes and
   sizes form a group; groups are indexed by their prefix shingles. The prefix is longer than a single
   common shingle needs, so that similar documents share several: pairs of groups of compatible sizes
   from short lists are kept if they share enough. In long lists (frequent shingles, which come last in
   the order) each group is linked to the first of its class of sizes, and neighbouring classes to each
   other: that connects every pair of compatible sizes without listing all.
3. Connected groups are expanded to their members and verified exactly, tile by tile (bounded numbers of
   members of neighbouring sizes), so a large group is many tasks; each tile returns a spanning forest
   of its links, no link between different components being lost.

Nulls: a null or blank text has no shingle and links with nothing; a text with fewer words than n has one
shingle, the whole of it; a null id stays alone with a null component. Rows with the same id count as
one document for the component (the least one).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import common as C
from waybill.llm.components import components


@dataclass(frozen=True)
class JaccardConfig:
    n: int = 4
    percent: int = 85                 # least Jaccard index, in percent
    frequent: int = 64                # shingles in more documents than this are ordered last
    most_frequent: int = 500_000      # of them, at most so many (the most frequent; any choice is right)
    tile: int = 128                   # documents verified against as many others in one step
    broadcast_rows: int = 1_000_000   # of a side with one id a row; a larger side is shuffled


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int):
    """(hashes, offsets): the sorted distinct shingle hashes of each row."""
    rows = len(off) - 1
    low = C.LOWER[data]
    starts, ends, row = C.word_spans(low, off)
    words = C.word_hashes(low, starts, ends)
    count = np.bincount(row, minlength=rows)
    grams, first = C.gram_hashes(words, row, n)
    hashes, owner = [grams], [row[first]]
    for m in range(1, n):
        short = count[row] == m
        if short.any():
            g, f = C.gram_hashes(words[short], row[short], m)
            hashes.append(C.mix(g + np.uint64(m)))
            owner.append(row[short][f])
    h, r = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[new], r[new]
    return h, np.searchsorted(r, np.arange(rows + 1))


def missing(n, percent: int):
    """Shingles of a set of n that a similar one may lack."""
    return n - -(-percent * n // 100)


def spare(n, percent: int):
    return np.maximum(1, missing(n, percent) // 2)


def _longs(h: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))


def _take(h, off, width):
    """The first ``width`` values of each row."""
    at = np.arange(len(h)) - np.repeat(off[:-1], np.diff(off))
    kept = at < np.repeat(width, np.diff(off))
    return h[kept], np.concatenate([[0], np.cumsum(width)])


def _sets(docs: DataFrame, config: JaccardConfig, whole: bool) -> DataFrame:
    """doc_id, n, s1, s2 (digest of the set), tokens: all, or the lowest ones that the bound needs."""
    def run(batches):
        C.held("jaccard", dict)
        for batch in batches:
            for a, b, data, off in C.blocks(batch.column(1)):
                h, at = shingle_sets(data, off, config.n)
                n = np.diff(at)
                sums = [np.zeros(len(h) + 1, np.uint64) for _ in range(2)]
                np.cumsum(C.mix(h.copy()), out=sums[0][1:])
                np.cumsum(C.mix(h ^ C.BASE), out=sums[1][1:])
                digest = [pa.array((s[at[1:]] - s[at[:-1]]).view(np.int64)) for s in sums]
                if not whole:
                    h, at = _take(h, at, np.minimum(n, missing(n, config.percent) + spare(n, config.percent)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), *digest, _longs(h, at)],
                    names=["doc_id", "n", "s1", "s2", "tokens"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, s1 long, s2 long, tokens array<long>"))


def _prefixes(sets: DataFrame, frequent: np.ndarray, seen: np.ndarray, config: JaccardConfig) -> DataFrame:
    """rep, n, gk (digest of the prefix), prefix."""
    def run(batches):
        for batch in batches:
            rep, n = batch.column(0), np.array(batch.column(1))
            lists = batch.column(2)
            h = np.asarray(lists.flatten())
            off = np.asarray(lists.offsets).astype(np.int64)
            off = off - off[0]
            cls = np.zeros(len(h), np.int64)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                cls = np.where(frequent[at] == h, seen[at], 0)
            row = np.repeat(np.arange(len(n)), np.diff(off))
            order = np.lexsort((h, cls, row))
            first, at = _take(h[order], off, np.minimum(n, missing(n, config.percent) + spare(n, config.percent)))
            sums = np.zeros(len(first) + 1, np.uint64)
            np.cumsum(C.mix(first.view(np.uint64).copy()), out=sums[1:])
            yield pa.RecordBatch.from_arrays(
                [rep, batch.column(1), pa.array((sums[at[1:]] - sums[at[:-1]]).view(np.int64)), _longs(first, at)],
                names=["rep", "n", "gk", "prefix"])

    return sets.select("rep", "n", "tokens").mapInArrow(run, "rep long, n long, gk long, prefix array<long>")


def links_within(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """Index pairs of a spanning forest of the similar pairs between rows ``left`` and ``right``."""
    size = np.array([len(s) for s in sets])
    token, code = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(code, minlength=len(token)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    row, code = row[keep], number[code[keep]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    for c in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(code, [c, c + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[a:b], code[a:b] - c] = 1
        common += m @ m.T
    inter = common.astype(np.int64)
    similar = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    allowed = np.zeros_like(similar)
    allowed[np.ix_(left, right)] = True
    similar &= allowed | allowed.T
    todo, out = set(range(len(sets))), []
    while todo:
        top = todo.pop()
        front = [top]
        while front:
            x = front.pop()
            for y in [y for y in np.flatnonzero(similar[x]).tolist() if y in todo]:
                todo.discard(y)
                out.append((x, y))
                front.append(y)
    return out


def _verify(members: DataFrame, config: JaccardConfig) -> DataFrame:
    """u, v: links, from rows (key, side, rep, tokens) sorted by key. Sides: 0 left, 1 right, 2 both."""
    def run(batches):
        key, group = None, []

        def close():
            if len(group) < 2:
                return []
            side = np.array([g[0] for g in group])
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            found = links_within([g[2] for g in group], left, right, config.percent)
            return [(group[a][1], group[b][1]) for a, b in found]

        for batch in batches:
            out = []
            keys, sides, reps = (batch.column(i).to_pylist() for i in range(3))
            lists = batch.column(3)
            values, off = np.asarray(lists.flatten()), np.asarray(lists.offsets).astype(np.int64)
            off = off - off[0]
            for i, k in enumerate(keys):
                if k != key:
                    out += close()
                    group.clear()
                    key = k
                group.append((sides[i], reps[i], values[off[i]:off[i + 1]].copy()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["u", "v"])
        out = close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["u", "v"])

    return members.mapInArrow(run, "u long, v long")


def _tiles(sets: DataFrame, coarse: DataFrame, config: JaccardConfig) -> DataFrame:
    """(key, side, rep, tokens), sorted by key: every pair of tiles of a component that sizes let meet."""
    by_size = Window.partitionBy("comp").orderBy("n", "rep")
    member = C.written(sets.select("rep", "n").join(coarse, "rep")
                       .withColumn("tile", F.floor((F.row_number().over(by_size) - 1) / config.tile)), "members")
    tile = member.groupBy("comp", "tile").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    a, b = tile.alias("a"), tile.alias("b")
    pair = a.join(b, (F.col("a.comp") == F.col("b.comp")) & (F.col("a.tile") <= F.col("b.tile"))
                  & (100 * F.col("a.hi") >= config.percent * F.col("b.lo"))).select(
        F.col("a.comp").alias("comp"), F.col("a.tile").alias("i"), F.col("b.tile").alias("j"))
    side = pair.select("comp", F.explode(F.when(
        F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("tile"), F.lit(2).alias("side")))).otherwise(
        F.array(F.struct(F.col("i").alias("tile"), F.lit(0).alias("side")),
                F.struct(F.col("j").alias("tile"), F.lit(1).alias("side"))))).alias("t"),
        F.xxhash64("comp", "i", "j").alias("key")).select("comp", "t.tile", "t.side", "key")
    return (member.join(side, ["comp", "tile"]).select("key", "side", "rep")
            .join(sets.select("rep", "tokens"), "rep")
            .repartition("key").sortWithinPartitions("key").select("key", "side", "rep", "tokens"))


def similar(docs: DataFrame, config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """doc_id, n_shingles, component_id, one row for each row of ``docs``."""
    spark = docs.sparkSession
    C.ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    low = C.written(_sets(docs, config, False), "low-shingles")
    each = low.filter("doc_id is not null").select("doc_id", "s1", F.explode("tokens").alias("t"))
    again = each.groupBy("t").agg(F.count("*").alias("c")).filter("c > 1").select("t")
    partner_size = F.ceil(F.col("n") * config.percent / 100)
    lacking = partner_size - F.ceil(partner_size * config.percent / 100)
    need = F.greatest(F.lit(1), F.floor(lacking / 2))
    held = each.join(again, "t").groupBy("doc_id", "s1").agg(F.count("*").alias("held"))
    chosen = (low.select("doc_id", "n", "s1", "s2").join(held, ["doc_id", "s1"]).filter(F.col("held") >= need)
              .select("doc_id", "n", "s1", "s2"))
    chosen = C.written(chosen, "with-partners")
    one = C.written(chosen.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "distinct-sets")

    ids = one.select(F.col("rep").alias("doc_id")).distinct()
    ids = F.broadcast(ids) if ids.count() <= config.broadcast_rows else ids
    sets = C.written(_sets(docs.join(ids, "doc_id", "left_semi"), config, True)
                     .withColumnRenamed("doc_id", "rep").select("rep", "n", "tokens"), "sets")
    often = (sets.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("c"))
             .filter(F.col("c") > config.frequent).orderBy(F.desc("c"), "t").limit(config.most_frequent).toPandas()
             .sort_values("t"))
    prefix = C.written(_prefixes(sets, often["t"].to_numpy(np.int64), often["c"].to_numpy(np.int64), config), "prefixes")
    group = C.written(prefix.groupBy("gk", "n").agg(F.min("rep").alias("g"), F.first("prefix").alias("prefix")), "groups")
    index = group.select("g", "n", F.explode("prefix").alias("t"))
    lists = index.groupBy("t").agg(F.count("*").alias("c")).filter("c > 1")
    index = C.written(index.join(lists, "t"), "index")
    short = index.filter(F.col("c") <= config.frequent).select("t", "g", "n")
    other = short.select("t", F.col("g").alias("u"), F.col("n").alias("m"))
    fits = (100 * F.least("m", "n") >= config.percent * F.greatest("m", "n")) & (F.col("u") < F.col("g"))
    smaller = F.least(F.col("m"), F.col("n"))
    lacking = smaller - F.ceil(smaller * config.percent / 100)
    enough = F.greatest(F.lit(1), F.floor(lacking / 2))
    shared = short.join(other, "t").filter(fits).groupBy("u", F.col("g").alias("v")).agg(
        F.count("*").alias("c"), F.first(enough).alias("need")).filter("c >= need").select("u", "v")
    # sizes that may be similar are in one class or in neighbouring ones
    size_class = F.floor(F.log("n") / F.log(F.lit(100 / config.percent)))
    long = index.filter(F.col("c") > config.frequent).select("t", "g", size_class.alias("k"))
    heads = long.groupBy("t", "k").agg(F.min("g").alias("u"))
    following = heads.select("t", (F.col("k") - 1).alias("k"), F.col("u").alias("v"))
    chain = (long.join(heads, ["t", "k"]).select("u", F.col("g").alias("v"))
             .unionByName(heads.join(following, ["t", "k"]).select("u", "v")).distinct())
    pairs = shared.unionByName(chain)
    inside = prefix.join(group.select("gk", "n", "g"), ["gk", "n"]).select(F.col("g").alias("u"), F.col("rep").alias("v"))
    near = components(pairs.unionByName(inside))
    coarse = near.select(F.col("u").alias("rep"), F.col("v").alias("comp")).unionByName(
        near.select(F.col("v").alias("rep"), F.col("v").alias("comp")).distinct())

    links = C.written(_verify(_tiles(sets, coarse, config), config), "links")
    final = components(links).select(F.col("u").alias("rep"), F.col("v").alias("least"))
    found = (chosen.join(one, ["n", "s1", "s2"]).join(final, "rep", "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("least", "rep")).alias("c")))
    found = C.written(found.withColumnRenamed("doc_id", "_doc"), "similar")
    return (low.select("doc_id", "n").join(found, low["doc_id"] == F.col("_doc"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id")))


def op9_jaccard_join(spark, sf_dir):
    return similar(C.scan(spark, sf_dir, "documents"))


def jaccard_stage(spark, docs, sf_dir):
    """Pipeline stage: of every group of similar documents the one with the least id stays. Rows without id
    all stay; rows that share an id go or stay together. The columns stay, whatever their names."""
    name, = C.free(docs, "_gone")
    gone = similar(docs).filter("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    gone = C.written(gone, "copies")
    gone = F.broadcast(gone) if gone.count() <= JaccardConfig().broadcast_rows else gone
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")
