"""The verdict of the quality rules, recomputed from shares and distances."""

import math
import random
import re

from pyspark.sql import functions as F

from quarry.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, lang string"


def shares(text, lang):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    chars = sum(map(len, words))
    odd = re.sub(r"[a-z\x20\x09-\x0D]+", "", text)
    own = [chars - len(odd)] + [len(re.findall(p, odd)) for p in Q.CLASSES.values()] + [len(text) - chars]
    own = [max(0, x) / max(1, len(text)) for x in [*own, len(text) - sum(own)]]
    if lang not in Q.COMMON:
        return words, own, None
    hits = [words.count(c) for c in Q.COMMON[lang]]
    return words, own, [max(0, x) / max(1, len(words)) for x in [*hits, len(words) - sum(hits)]]


def distance(p, q):
    if p is None or q is None:
        return 0.0
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
    return math.sqrt(max(0.0, sum((part(x, y) + part(y, x)) / 2 for x, y in zip(p, q))))


def verdicts(rows):
    known = {}
    for i, text, lang in rows:
        lang = lang if lang in Q.COMMON else "other"
        words, chars, common = shares(text or "", lang)
        grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        covered = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(8)}
        known[i] = lang, len(words), chars, common, len(words) < 20 or 100 * len(covered) > 30 * len(words)
    kept = {i for i, x in known.items() if not x[4]}
    for _ in (1, 2):
        means = {}
        for lang in {x[0] for x in known.values()}:
            among = [known[i] for i in kept if known[i][0] == lang and known[i][1] >= Q.MIN_WORDS]
            mean = lambda k: [sum(v) / len(among) for v in zip(*(x[k] for x in among))] if among and among[0][k] else None
            means[lang] = mean(2), mean(3)
        kept = {
            i for i, (lang, n, chars, common, failed) in known.items()
            if not failed and (n < Q.MIN_WORDS or not (
                distance(chars, means[lang][0]) > Q.MAX_CHAR_DISTANCE or distance(common, means[lang][1]) > Q.MAX_WORD_DISTANCE))
        }
    return {i: i in kept for i in known}


def test_verdicts(spark):
    draw = random.Random(31)
    vocabulary = {k: [*v * 3, *("".join(draw.choice("abcdefgilmnorstu") for _ in range(draw.randrange(3, 9))) for _ in range(60))] for k, v in Q.COMMON.items()}
    rows = []
    for i in range(160):
        lang = draw.choice([*Q.COMMON, "xx", None])
        words = [draw.choice(vocabulary.get(lang, vocabulary["en"])) for _ in range(draw.randrange(10, 200))]
        if i % 9 == 0:
            words = [w.upper() + "#$%" for w in words]
        if i % 11 == 0:
            words = ["".join(draw.choice("0123456789") for _ in range(5)) for _ in words]
        if i % 13 == 0:
            words = words[:9] * 8
        rows.append((i, " ".join(words), lang))
    rows += [(900, None, "en"), (901, "", None), (902, " \n ", "de")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit(True)).withColumn("a.b", F.lit(1)).withColumn("words", F.lit(1))
    got = {r.doc_id: r.kept for r in Q.quality_rules(docs).collect()}
    want = verdicts(rows)
    assert got == want and 30 < sum(got.values()) < len(rows) - 15
    twice = Q.quality_rules(docs.union(docs)).collect()
    assert len(twice) == 2 * len(rows) and {(r.doc_id, r.kept) for r in twice} == set(got.items())


def test_a_long_text(spark):
    """A few megabytes in one row."""
    draw = random.Random(1)
    words = [str(k) for k in range(50_000)]
    long = " ".join(draw.choice(words) for _ in range(600_000))
    (row,) = Q.quality_rules(spark.createDataFrame([(1, long, "en")], SCHEMA)).collect()
    assert row.n_words == 600_000 and not row.base_failed
