"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. Every item
is cut into windows of consecutive words; an item that is shorter is one window. A window is a set of
word shingles, ordered by rarity in the documents; containment is complete, so its necessary prefix is
the one rarest shingle. Documents are joined on that shingle alone; bounds on position and length drop
windows that would leave the document; the words of the rest are compared one by one.

What is found belongs to a document's id and a hash of its text, so rows that share an id, or have none,
but differ in text are told apart.

Nulls: a null or empty text has no words; an item without words has no window; items or documents with
a null id are compared like others. Repeated items count once for each distinct id, repeated rows of
documents give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import common as C

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class DecontaminationConfig:
    window: int = 13
    shingle: int = 5
    broadcast_rows: int = 500_000   # of a side of some tens of bytes a row; a larger side is shuffled
    share: int = 20                 # contaminated: share * n_hit >= n_words and n_hit > 0


def words_of(text: Column) -> Column:
    """Words in order. ``lower`` is used where it cannot touch more than A-Z."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _hash(text: Column) -> Column:
    """Tells rows of one id, or without id, apart by their text; a null text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def _small(df: DataFrame, config: DecontaminationConfig) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few; else the join shuffles both sides."""
    return F.broadcast(df) if df.count() <= config.broadcast_rows else df


def windows_of(items: DataFrame, config: DecontaminationConfig) -> DataFrame:
    """item_id, n (words of the window), w (the words), for each distinct window of each item."""
    size = F.least(F.size("words"), F.lit(config.window))
    return (items.select(F.col("item_id"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
            .select("item_id", "words", size.alias("n"))
            .select("item_id", "words", "n", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("at"))
            .select("item_id", "n", F.slice("words", F.col("at"), F.col("n")).alias("w")).distinct())


def _hashes(q: int):
    """Words -> (n_words, pos, s) of its shingles of q words. A lambda binds the words, so that a text is
    cut once, not once for a shingle."""
    def hashed(ws):
        def one(i):
            return F.struct(F.size(ws).alias("n_words"), i.alias("pos"),
                            F.xxhash64(*[F.get(ws, i + (k - 1)) for k in range(q)]).alias("s"))
        many = F.greatest(F.size(ws) - (q - 1), F.lit(0))
        return F.transform(F.slice(F.sequence(F.lit(1), F.size(ws)), F.lit(1), many), one)
    return hashed


def matches(docs: DataFrame, shingles: DataFrame, lengths: list[int], config: DecontaminationConfig) -> DataFrame:
    """(doc_id, th, n_words, pos, s): places in documents of shingles of ``shingles``. Words themselves are not
    carried: a shingle is a 64-bit hash here and is checked word by word later."""
    found = None
    for q in lengths:
        rows = docs.select("doc_id", "th", F.inline(F.transform(F.array(words_of(F.col("text"))), _hashes(q))[0]))
        rows = rows.join(_small(shingles.filter(F.col("q") == q).select("s").distinct(), config), "s", "left_semi")
        rows = rows.withColumn("q", F.lit(q))
        found = rows if found is None else found.unionByName(rows)
    return found


def decontaminate(docs: DataFrame, items: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted), contaminated, one row for each row of ``docs``."""
    return _found(docs, items, config).drop("th")


def _found(docs: DataFrame, items: DataFrame, config: DecontaminationConfig) -> DataFrame:
    """The same with ``th``, the hash of the text."""
    docs, items = docs.select("doc_id", _hash(F.col("text")).alias("th"), "text"), items.select("item_id", "text")
    window = C.written(windows_of(items, config).withColumn("wid", F.monotonically_increasing_id()), "windows")
    each = window.select("wid", "n", "w", F.least("n", F.lit(config.shingle)).alias("q"))
    lengths = sorted(r["q"] for r in each.select("q").distinct().collect())  # at most ``shingle`` values
    if not lengths:
        return _result(docs, None)
    each = each.select("wid", "n", "w", "q", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("q") + 1)).alias("at"))
    hashed = None
    for q in lengths:
        value = F.expr("xxhash64(" + ", ".join(f"w[at + {k - 1}]" for k in range(q)) + ")")
        one = each.filter(F.col("q") == q).select("wid", "n", "q", "at", value.alias("s"))
        hashed = one if hashed is None else hashed.unionByName(one)
    hashed = C.written(hashed, "window-shingles")

    # places of all shingles of windows in all documents, once: their counts give the order by rarity
    place = C.written(matches(docs, hashed, lengths, config), "shingle-places")
    counts = place.groupBy("s", "q").agg(F.count("*").alias("seen"))
    rare = Window.partitionBy("wid").orderBy("seen", "s", "at")
    prefix = (hashed.join(counts, ["s", "q"], "left").na.fill(0, ["seen"])
              .withColumn("r", F.row_number().over(rare)).filter("r = 1 and seen > 0")
              .select("wid", "n", "q", "s", "at"))
    near = (place.join(_small(C.written(prefix, "prefixes"), config), ["s", "q"])
            .select("doc_id", "th", "n_words", "wid", "n", (F.col("pos") - F.col("at") + 1).alias("start"))
            .filter("start >= 1 and start + n - 1 <= n_words").distinct())
    near = C.written(near.select("doc_id", "th", "wid", "start"), "candidates")

    # the words of the documents that have candidates, read again behind a semi join
    owners = _small(near.select("doc_id", "th").distinct(), config)
    text = docs.join(owners, _same(docs, owners), "left_semi").distinct() \
               .select("doc_id", "th", words_of(F.col("text")).alias("words"))
    asked = near.join(_small(window.select("wid", "item_id", "n", "w"), config), "wid")
    real = (asked.join(text, _same(asked, text)).select(asked["doc_id"], asked["th"], "item_id", "start", "n", "w", "words")
            .filter(F.slice("words", F.col("start"), F.col("n")) == F.col("w"))
            .select("doc_id", "th", "item_id", "start", (F.col("start") + F.col("n") - 1).alias("end")).distinct())
    return _result(docs, C.written(real, "occurrences"), config)


def _result(docs: DataFrame, real: DataFrame | None, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    base = docs.select("doc_id", "th", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    if real is None:
        out = base.select("doc_id", "th", "n_words", F.lit(0).cast("long").alias("n_hit"),
                          F.array().cast("array<string>").alias("item_ids"))
    else:
        before = (Window.partitionBy("doc_id", "th").orderBy("start", "end")
                  .rowsBetween(Window.unboundedPreceding, -1))
        spans = real.groupBy("doc_id", "th", "start").agg(F.max("end").alias("end"))
        reach = F.greatest(F.coalesce(F.max("end").over(before), F.lit(0)), F.col("start") - 1)
        hits = (spans.withColumn("new", F.greatest(F.col("end") - reach, F.lit(0)))
                .groupBy("doc_id", "th").agg(F.sum("new").cast("long").alias("n_hit")))
        ids = (real.select("doc_id", "th", F.col("item_id").cast("string").alias("item_id")).distinct()
               .groupBy("doc_id", "th").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids")))
        hits = hits.join(ids, _same(hits, ids)).select(
            hits["doc_id"].alias("_doc"), hits["th"].alias("_th"), "n_hit", "item_ids")
        hits = _small(C.written(hits, "hits"), config)
        out = base.join(hits, base["doc_id"].eqNullSafe(F.col("_doc")) & (base["th"] == F.col("_th")), "left").select(
            "doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (config.share * F.col("n_hit") >= F.col("n_words")))


def op5_decontaminate(spark, sf_dir):
    found = decontaminate(C.scan(spark, sf_dir, "documents"), C.scan(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def decontamination_stage(spark, docs, sf_dir):
    """Pipeline stage: contaminated documents go; the columns stay as they are, whatever their names. Rows
    without id, or with a shared one, are judged each by its text; null and empty texts stay."""
    doc, text = C.free(docs, "_bad", "_th")
    found = _found(docs, C.scan(spark, sf_dir, "benchmark"), DecontaminationConfig())
    bad = found.filter("contaminated").select(F.col("doc_id").alias(doc), F.col("th").alias(text)).distinct()
    bad = _small(C.written(bad, "contaminated"), DecontaminationConfig())
    same = docs["doc_id"].eqNullSafe(bad[doc]) & (_hash(docs["text"]) == bad[text])
    return docs.join(bad, same, "left_anti")


#: The same rows in DuckDB's SQL: windows of items, looked up among the windows of documents of their length.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT *, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT r, item_id, i, n FROM dw JOIN bw USING (n, s)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS k
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(k, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
