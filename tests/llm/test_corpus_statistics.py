"""Fingerprints, filter audit and resampling against brute force written the plain way."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from waybill.llm import audit, common, piecewise, resample

SCHEMA = "doc_id long, text string, lang string, source string, part string, digest string, score long, edge int"
LONG = "the shared passage of some length " * 60
EDGE = [
    (1, None, "en"), (2, "", None), (3, "   \n\t ", "en"), (4, "one", "en"), (5, "one", "en"), (6, LONG, "en"),
    (7, LONG, None), (8, "x" * 30_000, "de"), (9, "12345 67890 !!", "fr"), (10, "é ß 日本 \U0001f600 " * 80, "fr"),
    (11, "A b C d E f G h I j K l M n O p Q r S t $", "en"), (11, "A b C d E f G h I j K l M n O p Q r S t $", "en"),
    (11, "the same id, another text " * 5, "en"), (None, "no id here", "en"), (None, "one", "en"), (None, LONG, "de"),
    (14, " ".join(f"word{i}" for i in range(150)), "en"), (15, " ".join(f"word{i}" for i in range(150)), "fr"),
]
LABELS = [(4, 1, 0), (5, 1, 1), (6, 0, 1), (6, 1, None), (11, 1, 1), (14, 1, 0), (15, None, 1), (None, 1, 1), (99, 1, 1)]
PIECES = ["a", "B", "é", "日", " ", "\t", "\n", "#", "x" * 9, "y" * 70, " ", "word ", "Ä", "\x00", "\u0085", "9", "Z"]


def random_texts(n, seed):
    source = random.Random(seed)
    return ["".join(source.choice(PIECES) for _ in range(source.randint(0, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, g, "s", "clash", "clash", 7, 3) for i, t, g in EDGE]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- op11 ----------------------------------------------------------------------------------------

FULL = (1 << 64) - 1


def mixed(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & FULL
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & FULL
    return h ^ h >> 31


def plain_fingerprint(data):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rolled = [mixed(sum(data[i - j] * 0x100000001B3 ** j for j in range(7) if i >= j) & FULL) for i in range(len(data))]
    ones = [len(re.search("1*$", f"{r:b}").group()) for r in rolled]
    level = 2
    while sum(n >= level for n in ones) > 63:
        level += 1
    parts = [str(level)]
    for k in range(level, level + 3):
        signature, total, left = "", 0, False
        for r, n in zip(rolled, ones):
            total, left = (total + mixed(r + 0x632BE59BD9B4E019 & FULL)) & FULL, True
            if n >= k:
                code = mixed(total) >> 52
                signature, total, left = signature + letters[code >> 6] + letters[code & 63], 0, False
        if left:
            code = mixed(total) >> 52
            signature += letters[code >> 6] + letters[code & 63]
        parts.append(signature)
    return ":".join(parts)


def plain_likeness(one, two):
    (k, *a), (m, *b) = one.split(":"), two.split(":")
    both = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if int(k) + i == int(m) + j]
    if not both:
        return 0.0
    x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in both[0])
    if not x and not y:
        return 1.0
    distance = [list(range(len(y) + 1))] + [[i] + [0] * len(y) for i in range(1, len(x) + 1)]
    for i, p in enumerate(x, 1):
        for j, q in enumerate(y, 1):
            distance[i][j] = min(distance[i - 1][j] + 1, distance[i][j - 1] + 1,
                                 distance[i - 1][j - 1] + (0 if p == q else 2))
    return 1 - distance[-1][-1] / (len(x) + len(y))


@pytest.mark.parametrize("piece", [1 << 18, 50])
def test_fingerprints_equal_the_plain_way(monkeypatch, piece):
    monkeypatch.setattr(piecewise, "_PIECE", piece)
    monkeypatch.setattr(piecewise, "_TEXTS", 2000)
    texts = [t.encode() for t in random_texts(150, 1)] + [b"", b"a", b"z" * 5000, random.Random(2).randbytes(9000)]
    got = piecewise.fingerprints(texts)
    assert got == [plain_fingerprint(t) for t in texts]
    for a, b in zip(got, got[1:] + got[:1]):
        assert piecewise.likeness(a, b) == pytest.approx(plain_likeness(a, b), abs=1e-12)


def test_edits_stay_near_and_strangers_far():
    source = random.Random(3)
    words = ["".join(source.choices("abcdefghijklmnop", k=source.randint(2, 9))) for _ in range(900)]
    text, other = (" ".join(source.choices(words, k=600)) for _ in range(2))
    cut = text[:1500] + " inserted words here " + text[1500:-200]
    one, two, three = piecewise.fingerprints([text.encode(), cut.encode(), other.encode()])
    assert piecewise.likeness(one, two) > 0.8 and piecewise.likeness(one, three) < 0.2
    four = piecewise.fingerprints([text[:len(text) // 3].encode()])[0]        # a third of the text is still comparable
    assert piecewise.likeness(one, four) > 0.3
    assert piecewise.likeness("2:::", "2:::") == 1 and piecewise.likeness("2:::", one) == 0


def plain_edits(rows):
    """Rows without id last; rows of one id in some order, which the caller has given."""
    out = []
    for i, (key, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        changed = (text[:len(text) - half] + after[:half]).encode()
        mine, new, theirs = map(plain_fingerprint, (text.encode(), changed, after.encode()))
        out.append((key, len(text), hashlib.sha256(changed).hexdigest(), mine, new,
                    round(plain_likeness(mine, new), 9), round(plain_likeness(mine, theirs), 9)))
    return out


def test_op11_rows(spark, edge, empty):
    from pyspark.sql import functions as F
    order = [(r[0], r[1]) for r in edge.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(
        F.col("doc_id").asc_nulls_last(), F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    want = Counter(plain_edits(order))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
               F.round("near_edited", 9), F.round("near_next", 9)]
    for parts in ("1", "24"):          # few rows a partition, and more partitions than rows
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = piecewise.edits(edge)
        assert got.columns[:3] == ["doc_id", "n_chars", "edited_sha256"]
        assert Counter(tuple(r) for r in got.select(*columns).collect()) == want
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert piecewise.edits(empty).count() == 0
    alone = piecewise.edits(edge.where("doc_id = 9")).first()
    assert alone["near_next"] == 1 and alone["edited_sha256"] == \
        hashlib.sha256(("12345 67890 !!"[:7] + "12345 67890 !!"[:7]).encode()).hexdigest()


# ---- op12 ----------------------------------------------------------------------------------------

def words_of(text):
    return re.findall("[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("piece", [1 << 18, 64, 7])
def test_transducer_and_table(monkeypatch, piece):
    monkeypatch.setattr(audit, "_PIECE", piece)
    texts = random_texts(300, 4) + ["", "  ", "end", "x" * 700 + " " + "x" * 699 + "y " + "x" * 700]
    for a, b, data, off in common.blocks(pa.array(texts), 5000):
        starts, ends, row, points, capitals, signs = audit.transduce(data, off)
        n = np.bincount(row, minlength=b - a)
        for hashes in (common.span_hashes, lambda data, starts, ends: (ends - starts).astype(np.uint64)):
            distinct = audit.distinct_words(data, starts, ends, row, b - a, hashes)
            for i, text in enumerate(texts[a:b]):
                words = words_of(text)
                assert (n[i], distinct[i], points[i], capitals[i], signs[i]) == (
                    len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)),
                    len(re.findall("[#$%&*|]", text)))


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    seen = []
    for key, text, lang in rows:
        text = text or ""
        words = words_of(text)
        smaller = any((t or "") == text and i is not None and key is not None and i < key for i, t, _ in rows)
        fails = {f for f, failed in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), re.search("[#$%&*|]", text), smaller)) if failed}
        seen.append((lang or "", fails, key in good, key in toxic))
    out, shapley = [], Counter()
    for part in {s[0] for s in seen}:
        docs = [s for s in seen if s[0] == part]
        for order in permutations("ABCDE"):
            left = docs
            for step, own in enumerate(order, 1):
                gone, left = [d for d in left if own in d[1]], [d for d in left if own not in d[1]]
                failing = [d for d in docs if own in d[1]]
                shapley[part, own] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                            sum(d[1] == {own} for d in docs), sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return Counter(r + (shapley[r[0], r[1][r[2] - 1]],) for r in out)


def test_op12_rows(edge, labels, empty):
    got = audit.interactions(audit.failures(audit.profiles(edge), labels))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == plain_audit(EDGE, LABELS)
    assert audit.interactions(audit.failures(audit.profiles(empty), labels)).count() == 0
    bare = audit.interactions(audit.failures(audit.profiles(edge), labels.limit(0)))
    assert bare.where("good_lost + toxic_lost > 0").count() == 0 and bare.count() == 4 * 600


# ---- op13 ----------------------------------------------------------------------------------------

def plain_features(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def test_features_and_planes():
    texts = random_texts(400, 5) + ["", "a", "q" * 500 + " " + "q" * 500]
    for a, b, data, off in common.blocks(pa.array(texts), 4000):
        row, bucket, n = resample.features(data, off, 10_000)
        for i, text in enumerate(texts[a:b]):
            assert (n[i], sorted(bucket[row == i])) == (plain_features(text)[0], sorted(plain_features(text)[1]))
    source = np.random.default_rng(6)
    gain, counts = source.integers(-9000, 9000, 10_000), source.integers(0, 70, (5, 10_000))
    assert (resample.weighted_sums(counts, resample.signed_planes(gain)) == counts @ gain).all()
    assert resample.weighted_sums(counts[:2] * 0, resample.signed_planes(gain)).tolist() == [0, 0]


def plain_resample(rows, target):
    found = [(i, *plain_features(t)) for i, t in rows]
    s, t = Counter(b for r in found for b in r[2]), Counter(b for x in target for b in plain_features(x)[1])
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    scored = []
    for key, n, buckets in found:
        total = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in buckets)
        weight = total // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((key, n, len(buckets), weight, score))
    able = sorted((r for r in scored if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    place = [(*r, i + 1 if i < 25 * len(able) // 100 else None) for i, r in enumerate(able)]
    return Counter((r[0], r[2], r[3], r[4], r[5]) for r in place + [(*r, None) for r in scored if r[1] < 20])


def test_op13_rows(spark, edge, empty):
    target = ["The shared passage, of one.", None, "", "word1 word2 word3 word9"]
    benchmark = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    many = [(100 + i, t) for i, t in enumerate(random_texts(120, 7))]
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(many, "doc_id long, text string"))
    want = plain_resample([(i, t) for i, t, _ in EDGE] + many, target)
    for parts in ("2", "30"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert Counter(tuple(r) for r in resample.resample(docs, benchmark).select(*columns).collect()) == want
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(n for r, n in want.items() if r[4] is not None) > 4
    got = resample.resample(edge, benchmark.limit(0))
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == plain_resample([(i, t) for i, t, _ in EDGE], [])
    assert resample.resample(empty, benchmark).collect() == []
