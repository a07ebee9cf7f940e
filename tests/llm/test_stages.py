"""Stages of the pipeline on odd rows, an empty table, and columns named like the stages' own helpers."""

from collections import Counter

import pytest

import corpus_pipeline
from waybill.llm import suffixes

SF = "/root/testdata/sf0.001"
HELPERS = "rejected string, score string, lang_pred string, _text string, ids string, n_tokens string, _th string, _bad string, " \
          "_gone string, component_id string, lossless string, row string, th string, `odd name` array<int>"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {HELPERS}"
LONG = "a passage of several words that is long enough to have a language and to be compared with others " * 4
ROWS = [(1, None, "en"), (2, "", None), (3, "  \n ", "en"), (4, LONG, "en"), (5, LONG, None), (None, LONG + "more", "en"),
        (None, None, "de"), (7, "Mail jo.do@mail.example.com or +1 (454) 555-9913. " + LONG, "en"), (7, "12345 !!", "fr"),
        (8, "x" * 20_000, "de"), (9, "the quick brown fox jumps over the lazy dog and runs away " * 3, "en"), (9, LONG, "en")]


@pytest.fixture(scope="module")
def odd(spark):
    tail = ("r", "s", "p", "t", "i", "n", "h", "b", "g", "c", "l", "w", "q", [1, 2])
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), *tail) for i, t, g in ROWS], SCHEMA).repartition(3)


def whole(df, *without):
    names = [c for c in df.columns if c not in without]
    return Counter(repr(tuple(r[c] for c in names)) for r in df.collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_keeps_odd_columns(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    before, after = whole(odd), stage(spark, odd, SF)
    if name == "bpe":
        assert [c for c in odd.columns if c not in ("ids", "n_tokens")] + ["n_tokens", "ids"] == after.columns
        assert whole(after, "ids", "n_tokens") == whole(odd, "ids", "n_tokens")
        assert {r["n_tokens"] > 0 for r in after.filter("text <> ''").collect()} == {True}
        return
    assert after.schema.simpleString() == odd.schema.simpleString()
    got = whole(after)
    if name == "pii":
        assert whole(after.filter("doc_id is null or doc_id <> 7")) == whole(odd.filter("doc_id is null or doc_id <> 7"))
        masked, = after.filter("doc_id = 7 and text like 'Mail%'").collect()
        assert "<email>" in masked["text"] and "<phone>" in masked["text"] and masked["n_chars"] == len(masked["text"])
        return
    assert not got - before                                  # rows go, none changes
    if name == "language":                                   # what has no letter goes, prose stays
        assert after.filter("text is null or text in ('', '12345 !!')").count() == 0
    if name == "jaccard":                                    # 5 is a copy of 4; rows of one id go together
        assert after.filter("doc_id = 5").count() == 0 and after.filter("doc_id = 4").count() == 1
        assert after.filter("doc_id is null").count() == 2
    if name == "decontamination":
        assert got == before


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_an_empty_table(spark, odd, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame([], SCHEMA), SF).count() == 0


def test_run_is_the_stages_in_order(spark):
    from waybill.llm import common
    docs = common.scan(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), "by-hand")
    assert whole(corpus_pipeline.run(spark, SF)) == whole(docs) and docs.count() > 150


def test_rows_without_id_are_told_apart(spark):
    """Two texts without id, one of which repeats a passage of a third: only that one loses it."""
    passage = "".join(f"{i * i % 97:02d} pass " for i in range(40))
    texts = [f"{passage} end of one", "something else " + "y" * 300, f"start of three {passage}"]
    docs = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (3, texts[2])], "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"] > 0) for r in suffixes.deduplicate(docs).collect())
    want = [(None, len(texts[0]), True), (None, len(texts[1]), True), (3, len(texts[2]), True)]   # y's repeat in themselves
    assert got == Counter(want)
    kind = suffixes.repeated_spans(docs)[0].schema["th"].dataType.simpleString()
    assert kind == "bigint"                                  # 64 bits tell rows of one id apart
