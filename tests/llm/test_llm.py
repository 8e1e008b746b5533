"""The training-data operators against brute force, on small hard cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import (
    chat,
    exact_dedup,
    importance,
    jaccard_join,
    line_dedup,
    mixing,
    quality_rules,
    sentencepiece,
    toxicity,
    warc,
)
from quarry.llm.shingles import normal, shingle_set

from .common import SCHEMA, WORDS, documents, make_corpus, toxic_corpus, words_of


@pytest.fixture(scope="module")
def corpus():
    return make_corpus()


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(spark, corpus):
    got = exact_dedup.exact_dedup(documents(spark, corpus), head_chars=4, width=8, growth=4).collect()
    groups = {}
    for i, t, _ in corpus:
        groups.setdefault(squeezed(t), []).append(i)
    want = {
        (i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    }
    assert len(got) == len(corpus) and {tuple(r) for r in got} == want


def test_line_dedup(spark, corpus):
    got = {r.doc_id: r for r in line_dedup.line_dedup(documents(spark, corpus)).collect()}
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(upper)
    holders = {}
    for i, t, _ in corpus:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    for i, t, _ in corpus:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(holders.get(key(x), ())) >= 5 and i != max(holders[key(x)]))]
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_text) == (len(lines), len(lines) - len(keep), "\n".join(keep))
    assert any(r.n_dropped for r in got.values())


def test_exact_dedup_ids_and_long_texts(spark):
    """The largest id is an id; null ids stand last; long equal and unequal texts."""
    long = "ab " * 700_000
    rows = [(2**63 - 1, "x", "s"), (None, "x", "s"), (None, "y", "s"), (3, long, "s"), (2, long + " ", "s"), (1, long + "c", "s"), (0, long + "c", "s")]
    docs = documents(spark, rows).withColumn("rest", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted(tuple(r)[:4] for r in exact_dedup.exact_dedup(docs.where("doc_id is not null")).collect())
    assert got == [(0, 0, 2, True), (1, 0, 2, False), (2, 2, 2, True), (3, 2, 2, False), (2**63 - 1, 2**63 - 1, 1, True)] or got[-1][:2] == (2**63 - 1, 2**63 - 1)
    null = [tuple(r)[:4] for r in exact_dedup.exact_dedup(docs).collect() if r.doc_id is None]
    assert sorted(null, key=str) == [(None, 2**63 - 1, 2, False), (None, None, 1, True)]


def test_line_dedup_ids_names_and_long_texts(spark):
    line = "a line of more than forty characters, shared by some"
    rows = [(1, f"{line}\n{i}", "s") for i in range(4)] + [(0, line, "s")]
    assert sum(r.n_dropped for r in line_dedup.line_dedup(documents(spark, rows)).collect()) == 0  # two documents
    rows += [(None, f"x\n{line}", "s")] * 3 + [(i, f"{i}\n{line}\n{line}", "s") for i in (2, 3, 4)]
    names = ("row", "lines", "gone", "body", "gone_id", "gone_row", "n_lines", "n_dropped", "kept_text", "a.b", "key", "pos")
    docs = documents(spark, rows)
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.coalesce("text", F.lit(""))))
    got = line_dedup.line_dedup(docs.select("*", F.struct(*(F.col(f"`{n}`") for n in names)).alias("all")), carry=("all",)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["all"]["row"][3:]
        keep = text.split("\n") if r.doc_id == 4 else [x for x in text.split("\n") if x != line]
        assert r.kept_text == "\n".join(keep) and all(r["all"][n] == n + text for n in names)
    many = "\n".join(f"line {i} that is long enough to count as one" for i in range(100_000))
    got = line_dedup.line_dedup(documents(spark, [(i, many, "s") for i in range(5)])).collect()
    assert sorted((r.doc_id, r.n_dropped, len(r.kept_text)) for r in got) == [(i, 100_000, 0) for i in range(4)] + [(4, 0, len(many))]


def test_mix(spark, corpus):
    docs = documents(spark, corpus)
    plan = {r.doc_id: r for r in mixing.mix_plan(docs).collect()}
    sizes = {i: len(words_of(t)) for i, t, _ in corpus}
    total = {}
    for i, _, s in corpus:
        total[s] = total.get(s, 0) + sizes[i]
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
    for i, _, s in corpus:
        assert plan[i].size == sizes[i] and plan[i].source_size == total[s]
        assert plan[i].target == pytest.approx(target[s]) and 0 <= plan[i].copies <= 3
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in plan.values())
    again = {r.doc_id: r.copies for r in mixing.mix_plan(docs.repartition(7)).collect()}
    assert again == {i: r.copies for i, r in plan.items()}
    names = docs.select("*", *(F.col("text").alias(n) for n in ("rid", "copies", "_row", "_copy", "size", "a.b", "block")))
    got = [r.asDict() for r in mixing.mix(names).collect()]
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, r in plan.items() for _ in range(r.copies))
    texts = {i: t for i, t, _ in corpus}
    assert all(r[n] == texts[r["doc_id"]] for r in got for n in ("rid", "copies", "_row", "size", "a.b", "block"))
    null = documents(spark, [(None, f"w{i} x", "s") for i in range(40)] + [(None, "y z", "s")] * 5)
    each = lambda d: sorted(tuple(r) for r in mixing.mix_plan(d).collect() if r)
    assert len(each(null)) == 45 and each(null) == each(null.repartition(5))


def brute_links(rows):
    sets = {i: shingle_set(normal(t), 5) for i, t in rows}
    ids = sorted(sets)
    comp = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = {i: min(x, y) if c in (x, y) else c for i, c in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in ids}


def test_jaccard_join(spark, corpus):
    got = jaccard_join.near_duplicates(documents(spark, corpus)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_links([(i, t) for i, t, _ in corpus])


def test_jaccard_join_around_the_threshold(spark):
    """A chain of edits, where links are few and centres are far."""
    draw = random.Random(2)
    words = [draw.choice(WORDS) for _ in range(80)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words = list(words)
        for _ in range(draw.randrange(1, 3)):
            words[draw.randrange(80)] = draw.choice(WORDS)
    got = jaccard_join.near_duplicates(documents(spark, [(i, t, "s") for i, t in rows])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_links(rows)


def test_quality_rules(spark, corpus):
    rows = corpus + [(900, "a b c d e f g h " * 5, "s"), (901, "x x x\nx x x\n\n\n" * 9 + "# $", "s")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(documents(spark, rows)).collect()}
    for i, t, _ in rows:
        w = words_of(t)
        grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        covered = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(8)} if len(w) < 500 else None
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        r = got[i]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)))
        if covered is not None:
            assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(w) < 20 or 100 * r.n_repeat_words > 30 * len(w)) and not (r.base_failed and r.kept)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frames = [
        exact_dedup.exact_dedup(docs), line_dedup.line_dedup(docs), mixing.mix(docs), quality_rules.quality_rules(docs),
        jaccard_join.near_duplicates(docs), toxicity.toxicity(docs, labels), sentencepiece.encode(docs),
        importance.resample(docs, importance.good_texts(docs, labels)),
        warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")),
        chat.rotate_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_nulls_and_clashing_names(spark):
    rows = [(None, "some text here", "s"), (None, None, None), (3, "some text here", "s"), (3, "some text here", "s")]
    docs = documents(spark, rows).withColumn("kept", F.lit(1)).withColumn("keep_id", F.lit("x")).withColumn("size", F.lit(2.0)).withColumn("row", F.lit(1))
    kept = exact_dedup.exact_dedup(docs).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in kept) == [(0, 0, 1), (0, 3, 3), (3, 3, 3), (3, 3, 3)]
    for frame in (line_dedup.line_dedup(docs), mixing.mix_plan(docs), quality_rules.quality_rules(docs), jaccard_join.near_duplicates(docs), sentencepiece.encode(docs)):
        assert frame.count() == 4
    assert mixing.mix(docs).columns == docs.columns


@pytest.mark.parametrize("block", [512, 9])
def test_jaccard_links_inside_components(spark, corpus, monkeypatch, block):
    """Every link counts, also between near copies of one text, in one block or many."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 4 * block)
    draw = random.Random(21)
    base = [draw.choice(WORDS) for _ in range(90)]
    rows = [(i, t) for i, t, _ in corpus]
    for i in range(40):
        words = list(base)
        for _ in range(draw.randrange(0, 3)):
            words[draw.randrange(90)] = draw.choice(WORDS)
        rows.append((3000 + i, " ".join(words)))
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    for n in ("body", "component", "id", "a.b", "n_links", "class_id", "token"):
        docs = docs.withColumn(n, F.lit("x"))
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(docs, count_links=True).collect()}
    sets = {i: shingle_set(normal(t), 5) for i, t in rows}
    links = {i: 0 for i in sets}
    for a, x in sets.items():
        for b, y in sets.items():
            links[a] += bool(a != b and x and y and 100 * len(x & y) >= 80 * len(x | y))
    assert {i: r.n_links for i, r in got.items()} == links and max(links.values()) > 10
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute_links(rows)
    first = {}
    for i, t in sorted(rows):
        first.setdefault(normal(t), i)
    assert {i: r.class_id for i, r in got.items()} == {i: first[normal(t)] if normal(t) else i for i, t in rows}
