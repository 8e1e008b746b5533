"""The Kneser-Ney models by their sums, and the score on planted expressions."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import toxicity
from quarry.llm.shingles import batch_word_hashes

from .common import WORDS, documents, toxic_corpus

LABELS = "doc_id long, quality int, toxic int"


def hashes(text):
    return next(batch_word_hashes([toxicity.plain(text)], toxicity.STEM))


def test_toxicity(spark):
    docs, labels = toxic_corpus(spark)
    docs = docs.union(documents(spark, [(1000, "", "s"), (1001, None, "s"), (1002, "idiot w1 w2 " * 200_000, "s"), (None, "scum w3", "s"), (None, "scum w3", "s")]))
    docs = docs.withColumn("score", F.lit("x")).withColumn("a.b", F.col("doc_id"))
    got = toxicity.toxicity(docs, labels, whole=True).join(labels, "doc_id", "left").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r["row"]["a.b"] == r.doc_id and r["row"]["score"] == "x" for r in got) and len(got) == 405
    held = [r for r in got if r.held_out and r.toxic is not None]
    assert 60 < len(held) < 140 and sum(r.predicted == r.toxic for r in held) / len(held) > 0.95
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[1000][0].score == by[1001][0].score < 0.3 and by[1002][0].predicted == 1
    assert len(by[None]) == 2 and by[None][0].score == by[None][1].score and not by[None][0].held_out
    none = toxicity.toxicity(docs, labels.limit(0))
    assert {round(r.score, 6) for r in none.collect()} == {round(1 / (1 + math.exp(3)), 6)}


def test_rare_expressions(spark):
    """Words and bigrams in few toxic documents keep their weight."""
    draw = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = [draw.choice(WORDS) for _ in range(60)]
        if i % 2:
            for k in range(0, 60, 20):
                words[k] = draw.choice(["idiot", "scum"])
            if i % 40 == 1:
                words[10:13] = [draw.choice(WORDS), "gutter", "w1"]
                words[30:32] = ["w2", "w3"]
        elif i % 3 == 0:
            words[10], words[40] = "w2", "w3"
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, i % 2))
    held, weights = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    model = toxicity.Model(held.value, weights)
    ratio = lambda text: model.ratios(hashes(text))
    assert ratio("w5 gutter")[1] > 1.2 and ratio("w2 w3")[1] > 0.5
    assert abs(ratio("w5 neverseen")[1]) < 0.5 and len(held.value["pairs"]) > 1000
    assert (weights[1:] >= 0).all() and weights[1:].any()


def test_discounts():
    """Near 1, and the same for ten times the sample."""
    counts = (60, 25, 12, 8)
    d = toxicity.discounts(*counts)
    assert d[0] == 0 and all(0 < x < k for k, x in enumerate(d) if k)
    assert list(d) == pytest.approx(list(toxicity.discounts(*(10 * n for n in counts))))
    y = 60 / (60 + 50)
    assert list(d[1:]) == pytest.approx([1 - 2 * y * 25 / 60, 2 - 3 * y * 12 / 25, 3 - 4 * y * 8 / 12])


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(12)
    syllables = ["ba", "ko", "ti", "mu", "re", "sa"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.choice([1, 2, 2, 3, 4])))
    return [(" ".join(word() for _ in range(30)), i % 2) for i in range(60)] + [(" ".join(word() for _ in range(30)), None) for _ in range(40)]


def test_against_plain_kneser_ney(spark, texts):
    """Every probability by dictionaries and the formulas, and that they sum to 1."""
    rows = [(t, y) for t, y in texts if y is not None]
    frame = spark.createDataFrame(rows, "text string, toxic int")
    counts = (
        frame.mapInArrow(toxicity._count, toxicity.COUNTS).groupBy("word", "stem", "before", "ahead")
        .agg(*(F.max((F.col("toxic") == c).cast("int")).alias(f"n{c}") for c in (0, 1)))
        .groupBy("word", "stem", "before")
        .agg(*(F.sum(f"n{c}").cast("int").alias(f"n{c}") for c in (0, 1)), F.count("*").cast("int").alias("n2"))
    )
    in_texts = defaultdict(int)
    for t, _ in texts:
        for w in set(t.split()):
            in_texts[w] += 1
    stem_of = lambda w: w[: toxicity.STEM]
    known = sorted({w for t, _ in rows for w in t.split()})
    stems = sorted({stem_of(w) for w in known})

    def frequencies(words, stem_hashes):
        total = np.zeros(len(words) + len(stem_hashes) + 1)
        place = {int(h): i for i, h in enumerate(words)}
        at = {int(h): len(words) + i for i, h in enumerate(stem_hashes)}
        for w, n in in_texts.items():
            h = hashes(w)[0]
            total[place.get(int(h[0]), at.get(int(h[1]), len(total) - 1))] += n
        return total

    tables = toxicity.tables_of(toxicity._arrays(counts), frequencies)
    model = toxicity.Model(tables, np.zeros(toxicity.FEATURES + 1))

    contexts = [defaultdict(set), defaultdict(set)]
    for t, y in rows:
        w = t.split()
        for i, x in enumerate(w):
            before = w[i - 1] if i else "<"
            contexts[y][before, x].add(w[i - 2] if i > 1 else "<")
    pair = [{k: len(s) for k, s in contexts[c].items()} for c in (0, 1)]
    pair.append({k: len(contexts[0].get(k, set()) | contexts[1].get(k, set())) for k in {*pair[0], *pair[1]}})

    def less(counted):
        d = toxicity.discounts(*(sum(n == k for n in counted.values()) for k in (1, 2, 3, 4)))
        return {k: d[min(n, 3)] for k, n in counted.items()}

    word = [defaultdict(int) for _ in range(3)]
    for c in range(3):
        for _, x in pair[c]:
            word[c][x] += 1
    stem = [defaultdict(int) for _ in range(3)]
    for c in range(3):
        for x, n in word[c].items():
            stem[c][stem_of(x)] += n
    scale = sum(word[2].values()) / sum(in_texts.values())
    shared_word = {w: word[2][w] + scale * in_texts[w] for w in known}
    form = {s: scale * sum(n for w, n in in_texts.items() if stem_of(w) == s and w not in word[2]) for s in stems}
    other = scale * sum(n for w, n in in_texts.items() if stem_of(w) not in form)
    forms = {s: [w for w in known if stem_of(w) == s] for s in stems}
    shared_stem = {s: sum(shared_word[w] for w in forms[s]) + form[s] for s in stems}
    whole = sum(shared_stem.values()) + other + 0.5 * (len(stems) + 1)

    def p_stem(c, s):
        total, d = sum(stem[c].values()), less(stem[c])
        back = (shared_stem[s] if s else other) + 0.5
        return (stem[c].get(s, 0) - d.get(s, 0)) / total + sum(d.values()) / total * back / whole

    def p_word(c, w, s):
        """Of a word; without w, of an unseen form of the stem; without both, of an unseen stem."""
        total, d = sum(word[c].values()), less(word[c])
        part = 1.0 if s is None else ((shared_word[w] if w else form[s]) + 0.5) / (shared_stem[s] + 0.5 * (len(forms[s]) + 1))
        return (word[c].get(w, 0) - d.get(w, 0)) / total + sum(d.values()) / total * p_stem(c, s) * part

    events = [(w, stem_of(w)) for w in known] + [(None, s) for s in stems] + [(None, None)]
    for c in range(3):
        assert sum(p_word(c, *e) for e in events) == pytest.approx(1)
    d = [less({k: n for k, n in pair[c].items() if k[0] != "<"}) for c in range(3)]

    def p_pair(c, v, e):
        follow = {x: n for (b, x), n in pair[c].items() if b == v}
        mass = sum(follow.values())
        if not mass:
            return 0.0, 1.0
        took = {x: d[c][v, x] for x in follow}
        return (follow.get(e, 0) - took.get(e, 0)) / mass, sum(took.values()) / mass

    for v in known[:6]:
        for c in (0, 1):
            shared = {}
            for e in events:
                own, back = p_pair(2, v, e[0])
                shared[e] = own * p_word(c, *e) / p_word(2, *e) + back * p_word(c, *e)
            level = sum(shared.values())
            total = 0.0
            for e in events:
                own, back = p_pair(c, v, e[0])
                want = own + back * shared[e] / level
                total += want
                name = e[0] or (e[1] + "zz" if e[1] and len(e[1]) == toxicity.STEM else None if e[1] else "qqqqq")
                if name:
                    got = model.probabilities(hashes(f"{v} {name}"), np.array([True, False]))[c, 1]
                    assert got == pytest.approx(want, rel=1e-5)
            assert total == pytest.approx(1)
