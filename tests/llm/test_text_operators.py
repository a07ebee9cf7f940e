"""The text operators against brute force, the libraries, exact round trips and held-out accuracy."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from waybill.llm import bpe, common, decontaminate, jaccard, language, lm, pii, pii_table, quality, suffixes, token_files, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, words string, row int"
LONG = "the shared passage of some length " * 60
EDGE = [
    (1, None, "en"), (2, "", None), (3, "   \n\t ", "en"), (4, "one", "en"), (5, "one", "en"), (6, LONG, "en"),
    (7, LONG, None), (8, "x" * 30_000, "de"), (9, "12345 67890 !!", "fr"), (10, "é ß 日本 \U0001f600 " * 8, "fr"),
    (11, "a b c d e f g h i j k l m n o p q r s t", "en"), (11, "a b c d e f g h i j k l m n o p q r s t", "en"),
    (None, "no id here", "en"), (12, "Mail jo.do@mail.example.com or +1 (454) 555-9913.", "en"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, g, "s", 1, 7, "clash", 3) for i, t, g in EDGE]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.scan(spark, SF, "documents")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same_multiset(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ---- op1 and op8: tokens -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def byte_level():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD_TEXTS = ["", " ", "a  b", "\n\n x", "it's we'll", "a\tb \n c", "x<|endoftext|>y <|endoftext|>", "日本語 漢字", "a\x00b",
             "\x1c \x1d a\x85b\xa0c", "A" * 3000, "ab" * 5000, " " * 500 + "x", "-" * 1000, "1234567890" * 300, " lead", "\r\nab\r\n"]


def test_bpe_equals_the_library(byte_level):
    units, decoder = bpe.loaded(bpe.vocabulary())
    for text in ODD_TEXTS:
        want = byte_level.encode(text, add_special_tokens=False).ids
        packed = b"".join(units.encode(text))
        assert np.frombuffer(packed, "<u4").tolist() == want
        assert "".join(decoder.decode(packed, step=3)) == byte_level.decode(want, skip_special_tokens=False)


def test_bpe_stream_needs_no_more_than_its_window():
    transducer = bpe.loaded(bpe.vocabulary())[0].transducer
    data = ("thorough" * 4000).encode()
    parts = list(transducer.stream(data[i:i + 100] for i in range(0, len(data), 100)))
    assert len(parts) > 10 and sum(parts, []) == transducer.encode(data)


def test_bpe_pieces_of_a_long_text(byte_level, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    units, _ = bpe.loaded(bpe.vocabulary())
    text = "Some words, and lines.\nMore of them   with gaps \n and so on " * 20
    assert np.frombuffer(b"".join(units.encode(text)), "<u4").tolist() == byte_level.encode(text, add_special_tokens=False).ids


def test_op1_digests(edge, empty, byte_level):
    want = []
    for i, text in texts_of(edge):
        ids = byte_level.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(byte_level.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    same_multiset(rows_of(bpe.digests(edge, bpe.vocabulary()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), want)
    assert bpe.digests(empty, bpe.vocabulary()).count() == 0


def test_op8_files(spark, edge, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for source, part_docs in ((edge, 4), (edge, 1000), (empty, 10)):
        folder = common.new_folder(spark, "test-tokens")
        parts = token_files.write(token_files.encode(source, path, 1, "<u2"), source.select("doc_id"), folder, "<u2", part_docs)
        got = token_files.read(parts, folder, "<u2").orderBy("start").collect()
        at, seen = 0, []
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
            seen.append((r["doc_id"], r["n_tokens"], r["ids_crc32"]))
        want = []
        for i, text in texts_of(source):
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            want.append((i, len(ids), zlib.crc32(ids.tobytes())))
        same_multiset(seen, want)
        ids = [i for i, _, _ in seen]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))


# ---- op2: personal data ----------------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split("."))
                    or k == 2 and 13 <= len(digits) <= 19 and pii.luhn(digits) or k == 3 and 9 <= len(digits) <= 15):
                out.append((k, *m.span()))
    return out


def test_base_spans():
    rng = np.random.default_rng(2)
    for _ in range(4000):
        pool = ["ab@.-_ +", "0123456789 -.", "+1() .-9", "a@b.c1\né"]
        text = "".join(rng.choice(list(pool[rng.integers(4)])) for _ in range(rng.integers(1, 60)))
        assert pii.base_spans(text) == plain_spans(text)


def test_field_learns_shapes(edge, empty):
    field = pii.learn()
    base, every = pii.spans_of(["call (454) 555-9913 now", "a 2.0 of 3", None or ""], field)
    assert base == [[], [], []] and pii.joined(every[0]) == "phone:5:19" and every[1:] == [[], []]
    found = pii.find(edge, field).collect()
    assert len(found) == len(EDGE)
    twelve = next(r for r in found if r["doc_id"] == 12)
    assert [s["kind"] for s in twelve["base_spans"]] == ["email", "phone"]
    assert set(map(tuple, twelve["base_spans"])) <= set(map(tuple, twelve["spans"]))
    masked = {r["doc_id"]: r["text"] for r in pii.mask(edge, field).collect()}
    assert masked[12] == "Mail <email> or <phone>." and masked[1] is None and masked[6] == LONG
    assert pii.find(empty, None).count() == 0 and pii.find(empty, field).count() == 0


def test_field_on_lines_it_has_not_seen():
    """Held-out lines of the table, drawn with other values: their wordings and formats are new to the field."""
    field, found, wanted, right = pii.learn(), 0, 0, 0
    for text, spans in pii_table.rows(True, 6, seed=99):
        got = [(pii.ALL_KINDS[k], a, b) for k, a, b in pii.spans_of([text], field)[1][0]]
        wanted, found = wanted + len(spans), found + len(got)
        right += sum(any(g[0] == k and g[1] < b and g[2] > a for g in got) for k, a, b in spans)
    assert right / wanted > 0.7 and right / found > 0.85


def test_field_adds_what_no_pattern_has():
    texts = ['so token = "be8a8e7152a5c568b612dc7f4042dd9566113270" here', "his password=135299847ac0e0f0dc and more",
             "call 555-123-4567 today", "write jane.doe[at]mail.com soon", "in 1999 and 2004, version 2.0.14 of page 345",
             "commit 3f2a9c01b7d4e5f6a8b9c0d1e2f3a4b5c6d7e8f9 fixed it", ""]
    base, every = pii.spans_of(texts, pii.learn())
    assert not any(base)
    assert [pii.joined(e) for e in every] == ["secret:12:52", "secret:13:31", "phone:5:17", "email:6:26", "", "", ""]


def test_op2_columns(spark):
    """All columns against the patterns by brute force, and the field run by itself on each text."""
    large = SF.replace("0.001", "0.01")
    texts = dict(texts_of(common.scan(spark, large, "documents")))
    field, added = pii.learn(), 0
    for r in pii.op2_pii(spark, large).collect():
        text = texts[r["doc_id"]] or ""
        plain, every = plain_spans(text), pii.spans_of([text], field)[1][0]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in plain) for i in range(4)]
        assert r["spans"] == ",".join(f"{pii.ALL_KINDS[k]}:{a}:{b}" for k, a, b in sorted(every))
        assert set(plain) <= set(every) and (r["spans"] != "" or not plain)
        added += len(every) - len(plain)
    assert added > 0


def test_overlapping_spans_are_masked_whole(spark):
    texts = ["jane+15551234567@mail.com", "bob.10.0.0.1@host.com now", "x@10.0.0.1", "to 4111111111111111@pay.example.com.",
             "a@b.com +1 555 123 4567", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    masked = [r["text"] for r in pii.mask(frame, None).orderBy("doc_id").collect()]
    assert masked == ["<email>", "<email> now", "<email>", "to <email>.", "<email> <phone>", None]
    assert pii.merged([(0, 5, 9), (1, 0, 6), (2, 8, 20), (3, 20, 21)]) == [(2, 0, 20), (3, 20, 21)]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    field = pii.Field(rng.normal(size=(8, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), rng.normal(size=pii.LABELS))
    segment = [[0, 3], [1, 2], [5, 5]]

    def value(path):
        s = field.begin[path[0]] + sum(field.weights[f].sum(0)[y] for f, y in zip(segment, path))
        return s + sum(field.moves[a, b] for a, b in zip(path, path[1:]))

    best = max(itertools.product(range(pii.LABELS), repeat=3), key=value)
    assert tuple(field.decode([segment, segment[:1]])[0]) == best


# ---- op3: pseudo-likelihood --------------------------------------------------------------------------

LM = lm.LmConfig(words=20, buckets=6, codes=4, rows=64, dim=8, rounds=3, stride=2, batch=256, block=5)


def lm_words(text, words, config):
    data = np.frombuffer((text or "").encode(), np.uint8)
    return lm.tokens(data, np.array([0, len(data)]), words, config)


def lm_by_hand(net, words, counts, config, text):
    """Sum of log-probabilities word by word, from the definition; ``counts`` of all words of the corpus."""
    t, total = lm_words(text, words, config), 0.0
    table, scale, bias, out, out_bias, codes = (x.astype(float) for x in net.parts)
    cells = Counter()
    for (_, cell), n in counts.items():
        cells[cell] += n
    for i, token in enumerate(t.token):
        z = bias.copy()
        for place, j in enumerate(config.shifts):
            if 0 <= i + j < len(t.token):
                h = int(t.hash[i + j])
                z += scale[place] * (table[h % config.rows] + table[(h >> 32) % config.rows])
        h = np.tanh(z)
        p = np.exp(h @ out + out_bias)
        total += math.log(p[token] / p.sum())
        if token > config.words:
            bucket, code = token - 1 - config.words, t.code[i]
            p = np.exp(h @ codes) * [cells[bucket * config.codes + c] + 1 for c in range(config.codes)]
            total += math.log(p[code] / p.sum())
            cell = bucket * config.codes + code
            total += math.log(max(counts[int(t.hash[i]), cell], 1) / (cells[cell] + 1))
    return total


def test_lm_equals_the_definition(docs, edge, empty):
    texts = docs.filter("length(text) < 3000").select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    texts = texts.repartition(3)
    table = lm.dealt(texts, LM)
    words = lm.vocabulary(table, LM)
    named = lm.block_words(table, words, LM)
    token, cell = lm.cell_counts(named, LM)
    counts, rows = Counter(), [(r["doc_id"], r["text"]) for r in table.collect()]
    for _, text in rows:
        t = lm_words(text, words, LM)
        counts.update(zip(t.hash.tolist(), t.cell(LM).tolist()))
    assert sum(counts.values()) == token.sum() == sum(len(re.findall(r"[^ \t-\r]+", t or "")) for _, t in rows)
    others = Counter({k: n for k, n in counts.items() if k[1] >= 0})
    assert others and sum(others.values()) == cell.sum()
    net = lm.train(table, words, token, cell, LM)
    got = lm.score(table, named, words, net, cell, LM).collect()
    want = sorted((str(i), len(lm_words(t, words, LM).token), lm_by_hand(net, words, others, LM, t)) for i, t in rows)
    found = sorted((str(r["doc_id"]), r["n_tokens"], r["log_prob"]) for r in got)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in found], [x[2] for x in want], rtol=1e-4, atol=1e-3)
    blank = [r for r in got if r["doc_id"] in (1, 2, 3) and r["n_tokens"] == 0]
    assert len(blank) >= 3 and all(r["mean_log_prob"] is None and r["log_prob"] == 0 for r in blank)
    assert lm.pseudo_likelihood(empty, LM).count() == 0


def test_lm_learns_from_both_sides(spark):
    """A word that its left neighbour tells, one that its right neighbour tells, and one that neither tells."""
    rng, names = np.random.default_rng(1), ["alpha", "beta", "gamma", "delta"]
    rows = []
    for i in range(4000):
        a, b, c = rng.integers(0, 4, 3)
        rows.append((i, f"{names[a]} after{a}ward {names[c]} before{b}hand {names[b]}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    config = replace(LM, words=12, codes=64, rounds=8, stride=1, batch=64, rate=0.05)
    table = lm.dealt(docs, config)
    words = lm.vocabulary(table, config)
    named = lm.block_words(table, words, config)
    token, cell = lm.cell_counts(named, config)
    net, plain = lm.train(table, words, token, cell, config), lm.Network(config, token, cell)
    t = lm_words(rows[0][1], words, config)
    gain = np.mean([net.log_probabilities(x) - plain.log_probabilities(x)
                    for x in (lm_words(r[1], words, config) for r in rows)], axis=0)
    assert len(t.token) == 5 and gain[1] > 1 and gain[3] > 1
    mean = [lm.score(table, named, words, n, cell, config).agg({"log_prob": "sum"}).first()[0] for n in (plain, net)]
    assert mean[1] > mean[0] + 1000


def test_lm_trains_on_every_position(spark):
    """Each single word of each document changes the weights, whatever its place and the document's round."""
    config = replace(LM, rounds=2, stride=4, batch=8)
    texts = ["one two three four five six seven eight nine", "ten", "eleven twelve thirteen fourteen fifteen"]
    cell = np.zeros((config.buckets, config.codes))

    def trained(rows):
        docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
        return lm.train(lm.dealt(docs, config), np.zeros(0, np.int64), np.zeros(config.size), cell, config).flat

    whole = trained(texts)
    for i, place in [(0, 0), (0, 3), (0, 6), (0, 8), (1, 0), (2, 1), (2, 4)]:
        words = texts[i].split()
        words[place] = "another"
        assert not np.array_equal(trained([*texts[:i], " ".join(words), *texts[i + 1:]]), whole), (i, place)


def test_lm_gradient_equals_differences():
    """Over two runs of positions, one of them cut by the end, with a document's border inside."""
    config = replace(LM, words=2, stride=4)
    text = "a few words of the first text and some of the other"
    data = np.frombuffer(text.encode(), np.uint8)
    t = lm.tokens(data, np.array([0, 20, len(data)]), np.zeros(0, np.int64), config)
    rng, cell = np.random.default_rng(3), np.full((config.buckets, config.codes), 3.0)
    net = lm.Network(config, np.full(config.size, 3.0), cell)
    net.flat += rng.normal(0, 0.1, len(net.flat)).astype(np.float32)
    starts = np.array([4, len(t.row) - 2])
    at = [4, 5, 6, 7, len(t.row) - 2, len(t.row) - 1]
    got, count = net.gradient(t, starts)
    assert count == len(at)
    for i in rng.choice(np.flatnonzero(got), 40, replace=False):
        low, high = (lm.Network(config, np.full(config.size, 3.0), cell, net.flat.astype(float)) for _ in range(2))
        low.flat[i] -= 1e-4
        high.flat[i] += 1e-4
        want = -(high.log_probabilities(t)[at].mean() - low.log_probabilities(t)[at].mean()) / 2e-4
        assert abs(got[i] - want) < 1e-3, i


def test_softmax_without_and_with_a_common_bound():
    rng = np.random.default_rng(3)
    h = rng.uniform(-1, 1, (50, 6))
    for scale in 0.5, 60.0:
        weights, bias, at = rng.normal(0, scale, (6, 9)), rng.normal(0, 2, 9), rng.integers(0, 9, 50)
        lowered, safe = lm._lowered(weights, bias[None])
        assert safe == (scale < 1) and (h @ weights + lowered).max() <= 0
        z = h @ weights + bias
        want = z - z.max(1, keepdims=True)
        want = (want - np.log(np.exp(want).sum(1, keepdims=True)))[np.arange(50), at]
        assert np.allclose(lm._log_softmax_at(h @ weights + lowered, at, safe), want)


def test_lm_tells_words_of_a_bucket_apart(spark):
    ordinary = "the transportation of an imagination and an exploration by the navigation"
    invented = "the qqqqportation of an zzzzination and an wwwworation by the kkkkigation"  # the same endings
    rows = [(i, ordinary) for i in range(6)] + [(7, invented), (8, "Exploration"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in lm.pseudo_likelihood(docs, LM).collect()}
    assert len(got) == len(rows) and got[9]["n_tokens"] == 0
    assert got[0]["n_tokens"] == got[7]["n_tokens"] and got[0]["log_prob"] > got[7]["log_prob"] + 1


def test_lm_counts_follow_the_corpus(spark):
    """No table of words has a fixed size: each word that occurs is counted, and none is collected."""
    def kinds(n):
        rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        return lm.block_words(lm.dealt(docs, LM), np.zeros(0, np.int64), LM).select("w").distinct().count()
    assert kinds(10) == 400 and kinds(50) == 2000


def test_gradient_is_the_slope():
    config = lm.LmConfig(words=3, buckets=2, codes=3, rows=5, dim=4)
    rng = np.random.default_rng(0)
    token, cell = rng.integers(0, 9, config.size).astype(float), rng.integers(0, 9, (config.buckets, config.codes)).astype(float)
    t = lm.Tokens(rng.integers(1, config.size, 12), rng.integers(0, 1 << 62, 12).astype(np.uint64), rng.integers(0, 3, 12),
                  np.repeat([0, 1, 2], [5, 6, 1]))
    flat = lm.Network(config, token, cell).flat
    flat = (flat + rng.normal(0, 0.3, len(flat))).astype(float)

    def loss(flat):
        return -lm.Network(config, token, cell, flat).log_probabilities(t).mean()

    slope = lm.Network(config, token, cell, flat).gradient(t, np.arange(12))
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-3
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-3 - slope[i]) < 1e-3


def test_word_hashes_tell_apart_what_sums_of_powers_do_not():
    """Two arrangements of 1,024 letters that a polynomial modulo 2**64 gives one hash; and all short strings."""
    signs = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    texts = [signs, signs.translate(str.maketrans("ab", "ba")), "", "\x00", "\x00\x00", "a" * 8, "a" * 9, "a" * 16 + "b", "b" + "a" * 16]
    texts += [a + b for a in "abc " for b in "xyz"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    assert len(set(common.word_hashes(data, starts, ends).tolist())) == len(texts)
    doubled = np.frombuffer(("?" + "".join(texts)).encode(), np.uint8)         # a span's hash is its bytes' alone
    assert (common.word_hashes(doubled, starts + 1, ends + 1) == common.word_hashes(data, starts, ends)).all()
    first = common.span_hashes(data, starts[:2], ends[:2])
    assert first[0] == first[1]
    assert len(common.word_hashes(data, starts[:0], ends[:0])) == 0
    lines = quality.base_columns([signs + "\n" + texts[1]]) if hasattr(quality, "base_columns") else None
    assert lines is None or lines


# ---- op4 and op7: classifiers ----------------------------------------------------------------------------

def test_language(docs, edge, empty):
    model = language.learn(docs.filter(common.crc32_mod("doc_id", 3) != 1))
    found = language.identify(docs, model, ("lang",)).filter(common.crc32_mod("doc_id", 3) == 1).collect()
    right = [r["lang"] == r["lang_pred"] for r in found]
    assert sum(right) >= 0.93 * len(right) and all(0 <= r["score"] <= 1 for r in found)
    got = {r["doc_id"]: r for r in language.identify(edge, model).collect()}
    for i in (1, 2, 3, 9):
        assert got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0
    assert got[6]["lang_pred"] in model.langs
    # what is too far depends on the length: learned languages stay at any, others go, also short ones
    known = [r["text"] for r in docs.filter(common.crc32_mod("doc_id", 3) == 1).collect() if len(r["text"]) > 600]
    for size in (20, 50, 100, 300):
        far = language.judge(model, pa.array([t[:size] for t in known]))[2]
        assert far.mean() < 0.05, size
    others = ["Это предложение написано на русском языке.", "Это предложение написано на русском языке. " * 6,
              "これは日本語の文章です。", "これは日本語の文章です。" * 20, "xkcd qwrtz pfgh bvnm zxcv " * 3, "xkcd qwrtz pfgh bvnm zxcv " * 20]
    assert language.judge(model, pa.array(others))[2].tolist() == [True] * len(others)
    assert language.learn(empty) is None and language.identify(edge, None).filter("lang_pred <> 'und'").count() == 0
    assert language.identify(empty, model).count() == 0


def test_toxicity(spark, edge, empty):
    rows = [(i, f"some words {'pathetic idiot' if i % 3 == 0 else 'pleasant day'} number {i * 7919}", i % 3 == 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
    labels = docs.selectExpr("doc_id", "cast(t as int) as toxic").filter("doc_id % 4 <> 2")
    model = toxicity.learn(docs, labels)
    for r in toxicity.toxicity(docs, model).filter("doc_id % 4 = 2").collect():
        assert r["predicted"] == int(r["doc_id"] % 3 == 0) and 0 <= r["score"] <= 1
    assert toxicity.toxicity(edge, model).count() == len(EDGE)
    assert toxicity.toxicity(empty, model).count() == 0
    nothing = toxicity.learn(docs, labels.filter("toxic = 2"))
    assert {round(r["score"], 6) for r in toxicity.toxicity(edge, nothing).collect()} == {0.5}


# ---- op5: decontamination ----------------------------------------------------------------------------------

def plain_hits(text, items, window=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    words, hit, ids = cut(text), set(), set()
    for item, body in items:
        w = cut(body)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else ():
            for p in range(len(words) - n + 1):
                if words[p:p + n] == w[i:i + n]:
                    hit.update(range(p, p + n))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(words)


def test_decontamination(spark, edge, empty):
    items = [(1, "Q r S t"), (2, "one"), (3, None), (4, "!!"), (5, "the shared passage of some length the shared passage of some length"),
             (6, "a b c d e f g h i j k l m n"), (7, "a b c d e f g h i j k l m n")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    for config in (decontaminate.DecontaminationConfig(), decontaminate.DecontaminationConfig(broadcast_rows=0)):
        got = rows_of(decontaminate.decontaminate(edge, frame, config), "doc_id", "n_words", "n_hit", "item_ids", "contaminated")
        same_multiset(got, [(i, *plain_hits(t, items)) for i, t in texts_of(edge)])
    assert decontaminate.decontaminate(empty, frame).count() == 0
    none = decontaminate.decontaminate(edge, frame.filter("item_id = 3"))
    assert none.filter("contaminated or n_hit > 0").count() == 0 and none.count() == len(EDGE)


def test_rows_without_an_id_of_their_own_are_told_apart(spark, monkeypatch):
    items = [(1, "a b c d e f g h i j k l m n")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    bad, clean = items[0][1], "nothing of the kind is in this one"
    rows = [(None, bad), (None, clean), (None, None), (7, bad), (7, clean), (7, clean), (8, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for config in (decontaminate.DecontaminationConfig(), decontaminate.DecontaminationConfig(broadcast_rows=0)):
        got = rows_of(decontaminate.decontaminate(docs, frame, config), "doc_id", "n_words", "n_hit", "item_ids", "contaminated")
        same_multiset(got, [(i, *plain_hits(t or "", items)) for i, t in rows])
    monkeypatch.setattr(decontaminate.C, "scan", lambda *_: frame)
    left = decontaminate.decontamination_stage(spark, docs, "")
    assert left.columns == docs.columns
    same_multiset([tuple(r) for r in left.collect()], [r for r in rows if r[1] != bad])


# ---- op6: quality -------------------------------------------------------------------------------------------

def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, cover = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7)), set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i:i + 8])] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover),
            len(words) < 20 or 100 * len(cover) > 30 * len(words))


def test_quality(docs, edge, empty):
    refs = quality.references(docs)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for frame in (docs, edge):
        got = quality.quality(frame, refs=refs)
        same_multiset(rows_of(got, *columns), [(i, *plain_quality(t)) for i, t in texts_of(frame)])
        assert got.filter("base_failed and kept").count() == 0
    plain = [r for r in quality.quality(docs, refs=refs).collect() if not r["base_failed"]]
    assert sum(r["kept"] for r in plain) > 0.7 * len(plain)
    assert quality.quality(empty).count() == 0
    p, q = np.array([[3.0, 1, 0]]), np.array([1.0, 1, 2])
    a, b = p[0] / 4, q / 4
    m = (a + b) / 2
    want = sum(x * math.log2(x / y) / 2 for d in (a, b) for x, y in zip(d, m) if x)
    assert abs(quality.js_distance(p, q)[0] - math.sqrt(want)) < 1e-12


# ---- op9: similarity join ------------------------------------------------------------------------------------

def plain_components(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        linked = both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both)
        if rows[a][0] is not None and rows[b][0] is not None and (linked or rows[a][0] == rows[b][0]):
            x, y = label[a], label[b]
            label = [x if v == y else v for v in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [r[0] for r, v in zip(rows, label) if v == label[k] and r[0] is not None]
        out.append((i, len(sets[k]), None if i is None else min(ids)))
    return out


def near_copies(n):
    rng, out = np.random.default_rng(5), []
    base = [f"w{i}" for i in range(150)]
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            words[at] = f"x{rng.integers(1000)}"
        out.append((100 + i, " ".join(words)))
    return out


def test_similarity_join(spark, edge, empty):
    rows = near_copies(60) + [(500 + i, f"common start of every line here number {i} " + " ".join(f"u{i}v{j}" for j in range(30))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows)
    for config in (jaccard.JaccardConfig(), jaccard.JaccardConfig(tile=8, frequent=5, broadcast_rows=0)):
        same_multiset(rows_of(jaccard.similar(frame, config), "doc_id", "n_shingles", "component_id"), want)
    got = rows_of(jaccard.similar(edge), "doc_id", "n_shingles", "component_id")
    same_multiset(got, plain_components(texts_of(edge)))
    assert jaccard.similar(empty).count() == 0


def test_components(spark):
    from waybill.llm.components import components
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (100, 95), (95, 90), (7, 7)]
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 95: 90, 100: 90}


# ---- op10: repeated passages ----------------------------------------------------------------------------------

def plain_removal(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen, out = Counter(t[i:i + length] for t in data for i in range(len(t) - length + 1)), []
    for (i, _), t in zip(rows, data):
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if seen[t[a:a + length]] > 1:
                gone[a:a + length] = True
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def test_aligned_collection_by_columns():
    rng, config = np.random.default_rng(3), suffixes.SuffixConfig(length=6, anchor=2)
    for _ in range(60):
        places = rng.integers(0, 8, rng.integers(1, 12)).tolist()
        parts = [bytes(rng.choice(list(b"aab"), p).tolist()) + b"zz" + bytes(rng.choice(list(b"aab"), rng.integers(4, 10)).tolist())
                 for p in places]
        found = suffixes.repeated(parts, places, config)
        for i, (part, place) in enumerate(zip(parts, places)):
            for a, hit in enumerate(found[i].tolist()):
                others = [(q, a - place + b) for j, (q, b) in enumerate(zip(parts, places)) if j != i]
                assert hit == any(b >= 0 and q[b:b + 6] == part[a:a + 6] for q, b in others)


def test_repeated_passages(spark, edge, empty):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdeé"), 6))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(30)) + passage[: 150 + 15 * i] + " ".join(word() for _ in range(30))) for i in range(20)]
    rows += [(50, passage + passage), (51, "ab" * 400), (52, "x" * 199), (53, "x" * 200), (54, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    for config in (suffixes.SuffixConfig(), suffixes.SuffixConfig(chunk=1 << 10, block=1 << 10),
                   suffixes.SuffixConfig(most_fragments=1)):
        same_multiset(rows_of(suffixes.deduplicate(frame, config), *columns), plain_removal(rows, 200))
    same_multiset(rows_of(suffixes.deduplicate(edge), *columns), plain_removal(texts_of(edge), 200))
    assert suffixes.deduplicate(empty).count() == 0

def test_long_text_without_common_words_is_rejected(spark, docs):
    rng = np.random.default_rng(3)
    refs = quality.references(docs)
    word = lambda: "".join(rng.choice(list("bdgkmpvwxz"), 8))
    lines = [" ".join(word() + ("." if i % 9 == 8 else "") for i in range(n)) for n in (30, 170, 400, 3000)]
    lines.append(", ".join(word() for _ in range(500)))                     # a list of keywords
    lines.append(" ".join(word() if i % 20 else "the" for i in range(600)))  # 30 common words, fewer than any guard by these
    plain = [t for _, t in texts_of(docs.filter("lang = 'en'")) if len(t.split()) > 400]
    lines += sorted(plain)
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.quality(frame, refs=refs).collect()}
    assert got[0]["word_distance"] == 0 and not any(r["base_failed"] for i, r in got.items() if i < 6)
    assert all(got[i]["word_distance"] > 0.65 and not got[i]["kept"] for i in range(1, 6))
    near = [got[i]["word_distance"] <= 0.65 for i in range(6, len(lines))]
    assert len(near) > 5 and sum(near) > 0.8 * len(near)


# ---- queries and pipeline --------------------------------------------------------------------------------------

def test_decontamination_query_matches_sql(spark):
    from compare import compare, connect
    rows, problem = compare(spark, connect(SF), SF, "op5_decontaminate")
    assert problem is None and rows > 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline
    stage = dict(corpus_pipeline.STAGES)
    languages = stage["language"](spark, docs, SF)
    assert languages.columns == docs.columns and languages.count() >= 0.98 * docs.count()
    single = stage["jaccard"](spark, docs, SF)
    want = {i for i, _, c in plain_components(texts_of(docs)) if i == c}
    assert single.columns == docs.columns and {r["doc_id"] for r in single.select("doc_id").collect()} == want
    items = [(r["item_id"], r["text"]) for r in common.scan(spark, SF, "benchmark").collect()]
    clean = stage["decontamination"](spark, docs.filter("doc_id < 60"), SF)
    want = {i for i, t in texts_of(docs.filter("doc_id < 60")) if not plain_hits(t, items)[3]}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.select("doc_id").collect()} == want
    masked = {r["doc_id"]: r["text"] for r in stage["pii"](spark, docs, SF).collect()}
    assert all(not plain_spans(t) for t in masked.values()) and len(masked) == docs.count()
    coded = stage["bpe"](spark, docs, SF)
    assert coded.count() == docs.count() and set(docs.columns) < set(coded.columns)
    assert corpus_pipeline.ORACLE_SQL is None
