"""SentencePiece against the library, the plain agenda and round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import sentencepiece

from .common import documents, make_corpus

lib = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.load()


def plainly(text, doc_id, copy, model, dropout):
    """Segment by segment, by the agenda of one segment."""
    own = sentencepiece.segments(text, model)
    doc = sentencepiece.document_key(doc_id, copy, sentencepiece.SEED)
    keys = sentencepiece.occurrence_keys(np.full(len(own), doc, np.uint64), np.arange(len(own)))
    return [sentencepiece.segment_ids(s, k, model, dropout) for s, k in zip(own, keys)], own


def test_without_dropout_it_is_the_model(model):
    texts = [t or "" for _, t, _ in make_corpus() if t is None or "▁" not in t]
    texts += ["  two  spaces ", "x" * 300 + " y", "日本語の文章はとても長い。" * 60, "a" * 2000]
    got = sentencepiece.Segmenter(model, 0.0).texts(texts, [0] * len(texts))
    assert [x.tolist() for x in got] == lib.SentencePieceProcessor(model_file=sentencepiece.MODEL).encode(texts)


def test_segments_are_whole():
    known = {"beside": {"ab", "bc"}}
    for text in ("a  b c ", " ", "x", "ab" * 200, "abcx" * 100 + " a"):
        own = sentencepiece.segments(text, known)
        assert "".join(own) == " " + text
    assert sentencepiece.segments("abcx" * 100, known)[:2] == [" ", "abc"]


def test_every_occurrence_draws(spark, model):
    docs = documents(spark, [(i, (t or "") + " therefore" * 200, s) for i, t, s in make_corpus()[:40]])
    docs = docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("a.b", F.lit("x"))
    rows = sentencepiece.encode(docs, dropout=0.2, copy="copy", carry=("copy", "a.b"))
    got = rows.collect()
    assert len(got) == 80 and all(r.lossless and r["a.b"] == "x" and r.n_tokens == len(r.token_ids) for r in got)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        cut, own = plainly(texts[r.doc_id], r.doc_id, r.copy, model, 0.2)
        assert r.token_ids == sum(cut, [])
        assert len({tuple(x) for s, x in zip(own, cut) if s == " therefore"}) > 4
    assert len({tuple(r.token_ids) for r in got}) == 80
    back = sentencepiece.decode(rows).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t) for i, t in texts.items() for _ in (1, 2))


def test_trees_start_anew_and_parts_join(model, monkeypatch):
    draw = random.Random(3)
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(1, 12))) for _ in range(400)]
    texts = [" ".join(draw.choice(words) for _ in range(300)) for _ in range(8)]
    whole = sentencepiece.Segmenter(model, 0.3).texts(texts, list(range(8)))
    for i in (0, 7):
        own = sentencepiece.segments(texts[i], model)
        keys = sentencepiece.occurrence_keys(np.full(len(own), i, np.uint64), np.arange(len(own)))
        assert whole[i].tolist() == sum((sentencepiece.segment_ids(s, k, model, 0.3) for s, k in zip(own, keys)), [])
    monkeypatch.setattr(sentencepiece, "HELD", 50)
    monkeypatch.setattr(sentencepiece, "MET", 20)
    monkeypatch.setattr(sentencepiece, "BATCH", 64)
    store = sentencepiece.Segmenter(model, 0.3)
    for i, t in enumerate(texts):
        assert store.texts([t], [i])[0].tolist() == whole[i].tolist()


def test_very_long_words_and_texts(spark, model):
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    word = "".join(draw.choice(letters) for _ in range(1 << 20))
    rows = [(1, word, "s"), (2, "日本語 ▁" * 60_000, "s"), (3, " ".join(draw.choice(["one", "two"]) for _ in range(400_000)), "s")]
    got = sentencepiece.encode(documents(spark, rows)).collect()
    assert len(got) == 3 and all(r.lossless for r in got)
    store = sentencepiece.Segmenter(model, 0.1)
    short, own = plainly(word[:3000], 1, 0, model, 0.1)
    key = sentencepiece.document_key(1, 0, sentencepiece.SEED)
    assert store.texts([word[:3000]], [key])[0].tolist() == sum(short, [])


def test_defined_cases(spark, model):
    docs = documents(spark, [(1, None, "s"), (2, "", None), (None, "some text", "s"), (None, "some text", "s"), (4, " ", "s")])
    got = sorted(((r.doc_id or 0, r.n_tokens, tuple(r.token_ids), r.lossless) for r in sentencepiece.encode(docs).collect()))
    assert got[0] == got[1] and got[0][1] > 0 and [x[1] for x in got[2:]] == [0, 0, 1] and all(x[3] for x in got)
    assert sentencepiece.decode_ids([300, 5, -1, 10**9], model).endswith("\ufffd\ufffd")
    bad = spark.createDataFrame([(1, [3 + 0x80, 500_000, None]), (2, None)], "doc_id long, token_ids array<int>")
    assert {r.doc_id: len(r.text) > 0 for r in sentencepiece.decode(bad).collect()} == {1: True, 2: False}
