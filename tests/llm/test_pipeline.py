"""The pipeline's rows against a plain Python pipeline, and its defined cases."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import mixing, sentencepiece, toxicity
from quarry.llm.shingles import normal, shingle_set

from .common import SCHEMA, documents, make_corpus, toxic_corpus

NAMES = ("row", "lines", "gone", "body", "_gone", "_row", "_copy", "rid", "n_lines", "n_dropped", "kept_text", "a.b", "score", "size")


def line_key(line):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return line.strip(" \t\n\x0b\x0c\r").translate(upper)


def without_shared_lines(rows):
    holders = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= 40:
                holders.setdefault(line_key(line), set()).add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    return [(i, "\n".join(x for x in (t or "").split("\n") if gone.get(line_key(x), i) == i), s) for i, t, s in rows]


def one_of_each_group(rows):
    sets = {i: shingle_set(normal(t), 5) for i, t, _ in rows}
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = {i: min(x, y) if c in (x, y) else c for i, c in comp.items()}
    return [r for r in rows if comp[r[0]] == r[0]]


def mixed(rows):
    """Sizes, targets by filling up to the caps, and the crossings of one offset."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    total = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    capped = set()
    while True:
        free = sum(total.values()) - sum(3 * total[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped) or 1
        target = {s: 3 * total[s] if s in capped else free * weight[s] / share for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    out = []
    for s in names:
        offset = int(hashlib.md5("|".join(["42"] + [s] * (s is not None)).encode()).hexdigest()[:8], 16) / 2**32
        rate = target[s] / total[s] if total[s] else 0.0
        bits = lambda n: len(bin(n)) - 2
        kind = lambda i: bits(size[i]) * 8 + (size[i] >> max(bits(size[i]) - 3, 0))
        own = sorted((kind(i), i % mixing.BLOCKS, i, t) for i, t, x in rows if x == s)
        for k, (_, _, i, t) in enumerate(own, 1):
            out += [(i, t, s)] * (int(k * rate + offset) - int((k - 1) * rate + offset))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    toxic, labels = toxic_corpus(spark)
    more = documents(spark, [(2000 + i, t, s) for i, t, s in make_corpus()])
    toxic.union(more).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_rows_of_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    toxic = {i for i in scores if scores[i] >= 0.3}
    assert toxic and all(i < 400 and i % 4 == 0 for i in toxic)
    want = mixed(one_of_each_group(without_shared_lines([r for r in rows if r[0] not in toxic])))
    got = corpus_pipeline.run(spark, folder).collect()
    model = sentencepiece.load()
    back = Counter((r.doc_id, sentencepiece.decode_ids(r.token_ids, model), r.source) for r in got)
    assert back == Counter(want) and all(r.lossless and r.n_tokens == len(r.token_ids) for r in got)
    twice = [i for i, n in Counter(r.doc_id for r in got).items() if n > 1]
    cut = {i: {tuple(r.token_ids) for r in got if r.doc_id == i} for i in twice}
    assert any(len(x) > 1 for x in cut.values())


def test_stages_keep_columns_of_any_name(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60 or doc_id >= 2000")
    docs = docs.union(documents(spark, [(None, "a b c", "s"), (None, None, None), (7, "x y z", "s"), (7, "x y z", "s")]))
    for n in NAMES:
        docs = docs.withColumn(n, F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        rows = after.collect()
        assert rows and all(r[n] == f"{n} {'none' if r.doc_id is None else r.doc_id}" for r in rows for n in NAMES), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_copies_are_segmented_anew(spark):
    docs = documents(spark, [(1, "therefore something " * 50, "s")] * 3 + [(2, "x", None)])
    got = corpus_pipeline.encode(spark, docs, "").collect()
    assert len(got) == 4 and len({tuple(r.token_ids) for r in got}) == 4 and all(r.lossless for r in got)
