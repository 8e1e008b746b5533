"""Importance resampling recomputed row by row."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import importance
from quarry.llm.shingles import normal, word_hashes

from .common import documents, make_corpus, toxic_corpus

BUCKETS = 512


def grams(text):
    body = normal(text)
    return importance._grams(word_hashes(body + b" "), BUCKETS).tolist() if body else []


def model(texts):
    n = Counter(g for t in texts for g in grams(t))
    total = sum(n.values()) + BUCKETS
    return [math.log((n[b] + 1) / total) for b in range(BUCKETS)]


def plainly(rows, target, seed):
    """(id, weight, key) of each row."""
    p, q = model(target), model([t for _, t in rows])
    out = []
    for i, t in rows:
        weight = sum(p[g] - q[g] for g in grams(t))
        name = str(i) if i is not None else "text " + hashlib.md5((t or "").encode()).hexdigest()
        bits = int(hashlib.md5(f"{seed}|{name}".encode()).hexdigest()[:13], 16)
        out.append((i, weight, weight - math.log(-math.log((bits + 0.5) / 2**52))))
    return out


def test_weights_noise_and_choice(spark):
    corpus = make_corpus()
    rows = [(i, t) for i, t, _ in corpus]
    target = [t for _, t, _ in corpus[5:20]]
    docs = documents(spark, corpus).withColumn("order", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("row", F.lit(1))
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for share in (0.0, 0.3, 0.5, 1.0):
        got = {r.doc_id: r for r in importance.resample(docs, wanted, share=share, seed=7, buckets=BUCKETS).collect()}
        want = plainly(rows, target, 7)
        chosen = {i for i, _, _ in sorted(want, key=lambda x: (-x[2], x[0]))[: int(len(rows) * share)]}
        assert len(got) == len(rows)
        for i, weight, key in want:
            assert (got[i].log_weight, got[i].gumbel_key) == (pytest.approx(weight), pytest.approx(key))
            assert got[i].selected == (i in chosen)


def test_ties_nulls_and_repeated_rows(spark):
    """Rows alike are taken one by one; equal keys in order of id; huge weights don't tie."""
    rows = [(1, "one two"), (1, "one two"), (1, "one two"), (None, "one two"), (None, "one two"), (None, None), (5, "x " * 50_000), (6, "y " * 50_000)]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    wanted = spark.createDataFrame([("one two",), ("y",)], "text string")
    want = sorted(plainly(rows, ["one two", "y"], 42), key=lambda x: (-x[2], x[0] is None, x[0] or 0))
    for k in range(9):
        got = importance.resample(docs, wanted, share=k / 8, buckets=BUCKETS).collect()
        picked = Counter((r.doc_id, round(r.gumbel_key, 6)) for r in got if r.selected)
        assert picked == Counter((i, round(key, 6)) for i, _, key in want[:k])


def test_order_bits():
    import numpy as np
    import pyarrow as pa

    class Ratio:
        value = np.zeros(BUCKETS)

    uniform = np.array([1e-300, 0.1, 0.3678794, 0.5, 0.9, 1 - 1e-16])
    batch = pa.record_batch(
        [pa.array(range(6), pa.int64()), pa.array(range(6), pa.int64()), pa.array([""] * 6), pa.array(uniform)],
        ["doc_id", "row", "text", "uniform"],
    )
    (out,) = importance._weigh(Ratio, BUCKETS)(iter([batch]))
    assert out.column("order").to_pylist() == sorted(set(out.column("order").to_pylist()))


def test_good_documents_are_preferred(spark):
    docs, labels = toxic_corpus(spark)
    target = docs.join(labels.where("toxic = 0"), "doc_id", "left_semi").select("text")
    got = importance.resample(docs, target, share=0.25).join(labels, "doc_id").collect()
    assert sum(r.selected for r in got) == 100 and not any(r.selected and r.toxic for r in got)
    assert importance.good_texts(docs, labels, most=7).count() == 7
