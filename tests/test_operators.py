import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import audit, dedup, matching, splits, stats, triage
from quarry.operators.components import components
from quarry.plans import catalogue


def brute_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "empty"])
def test_components(spark, kind):
    draw = random.Random(3)
    edges = {
        "random": [(draw.randrange(200), draw.randrange(200)) for _ in range(120)],
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(60)],
        "empty": [],
    }[kind]
    edges = [(a, b) for a, b in edges if a != b]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == brute_components(edges) and len(got) == len({r.id for r in got})


def test_hamming_pairs(spark):
    draw = random.Random(5)
    base = [draw.getrandbits(63) for _ in range(20)]
    values = [b ^ sum(1 << draw.randrange(63) for _ in range(0)) for b in base]
    for b in base:
        v = b
        for k in draw.sample(range(63), draw.randrange(1, 8)):
            v ^= 1 << k
        values.append(v)
    values.append(base[0])
    rows = list(enumerate(values))
    got = dedup.hamming_pairs(spark.createDataFrame(rows, "id long, h long"), "id", "h").collect()
    first = {}
    for i, v in rows:
        first.setdefault(v, i)
    want = {(a, b) for x, a in first.items() for y, b in first.items() if a < b and bin(x ^ y).count("1") <= 5}
    want |= {(first[v], i) for i, v in rows if first[v] < i}
    assert {(r.a, r.b) for r in got} == want


def ladder(spark, **changes):
    row = {
        "name": "a.jpg", "readable": True, "fatal_quality": False, "is_duplicate_drop": False, "moderate_blur": False,
        "moderate_lighting": False, "n_det": 0, "mean_conf": 0.0,
        **{m: 0.0 for m, *_ in triage.TERMS},
    } | changes
    df = spark.createDataFrame([tuple(row.values())], list(row))
    return triage.score(df, keep_rate=0.0, name="name").select("challenge_score", "keep_drop", "category").first()


def test_ladder(spark):
    cases = [
        (dict(moderate_blur=True), (4.4, "KEEP", "high_value")),
        (dict(n_det=4, mean_conf=0.95, edge_ratio=0.25), (1.4, "KEEP", "valuable")),
        (dict(n_det=6, mean_conf=0.95), (0.5, "DROP", "low_value")),
        (dict(n_det=10, mean_conf=0.95), (1.5, "KEEP", "valuable")),
        (dict(fatal_quality=True, is_duplicate_drop=True), (-10.0, "DROP", "low_value")),
        (dict(readable=False, fatal_quality=True), (-99.0, "DROP", "unreadable")),
    ]
    for changes, (score, keep, category) in cases:
        got = ladder(spark, **changes)
        assert got.challenge_score == pytest.approx(score) and (got.keep_drop, got.category) == (keep, category)


def test_greedy_match(spark):
    rows = [("i", 0, 0, 0.9, 1.0), ("i", 0, 1, 0.8, 1.0), ("i", 1, 0, 0.85, 1.0), ("i", 1, 1, 0.6, 1.0), ("j", 0, 0, 0.4, 1.0)]
    df = spark.createDataFrame(rows, "image string, gt_index int, pred_index int, iou double, conf double")
    got = {(r.image, r.gt_index, r.pred_index) for r in matching.greedy_match(df).collect()}
    assert got == {("i", 0, 0), ("i", 1, 1)}


def test_split_is_exact(spark):
    rows = [(f"s{i % 3}", i) for i in range(101)] + [("one", 999)]
    df = spark.createDataFrame(rows, "source string, id long")
    got = splits.stratified_split(df, "source", "id").groupBy("source").agg(F.count_if(F.col("split") == "train").alias("n"), F.count("*").alias("m")).collect()
    assert {r.source: (r.n, r.m) for r in got} == {"s0": (27, 34), "s1": (27, 34), "s2": (26, 33), "one": (1, 1)}
    train, val = splits.shuffled_split({"a": [f"a{i}" for i in range(10)], "b": ["b0"]})
    assert len(train) == 9 and len(val) == 2 and not set(train) & set(val)
    assert (train, val) == splits.shuffled_split({"b": ["b0"], "a": [f"a{i}" for i in reversed(range(10))]})


def test_guards(spark):
    df = spark.createDataFrame([("a",), ("b",)], ["k"])
    audit.guard(audit.leakage(df.where("k = 'a'"), df.where("k = 'b'"), ["k"]))
    with pytest.raises(ValueError, match="both splits"):
        audit.guard(audit.leakage(df, df, ["k"]))
    taken = spark.createDataFrame([(1,), (2,), (5,)], ["k"])
    assert [r.k for r in audit.free_indices(taken, "k", 1, 4).collect()] == [3, 4, 6, 7]


def test_bins_are_zero_filled(spark):
    df = spark.createDataFrame([(0.0,), (14.9,), (15.0,), (179.0,)], ["x"])
    got = {r.bin: r.n for r in stats.binned(df, "x", 0.0, 180.0, 12).collect()}
    assert got == {i: {1: 2, 2: 1, 12: 1}.get(i, 0) for i in range(1, 13)}


def test_catalogue_against_sql(spark):
    """All queries with SQL, on the smallest tables."""
    import os

    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    db = duckdb.connect()
    for name in os.listdir(sf):
        db.execute(f"create view {name.split('.')[0]} as select * from '{sf}/{name}'")
    plain = lambda rows: sorted(repr(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in rows)
    for name, sql in catalogue.oracle_sql().items():
        mine = catalogue.queries()[name](spark, sf)
        columns = sorted(mine.columns)
        theirs = db.sql(sql)
        assert columns == sorted(theirs.columns), name
        quoted = ", ".join(f'"{c}"' for c in columns)
        assert plain(tuple(r[c] for c in columns) for r in mine.collect()) == plain(theirs.project(quoted).fetchall()), name


def test_similar_pairs(spark, monkeypatch):
    """Groups of equal and near hashes whose vectors differ, against brute force."""
    import numpy as np

    monkeypatch.setattr(dedup, "CROWD", 8)
    draw = random.Random(12)
    hashes = [draw.getrandbits(63) for _ in range(4)]
    hashes += [h ^ 0b1011 << 20 for h in hashes[:2]]
    kinds = [[draw.random() for _ in range(16)] for _ in range(5)]
    rows = []
    for i in range(120):
        noise = draw.choice([0.0, 0.02, 0.3])
        rows.append((i, draw.choice(hashes), [x + noise * draw.random() for x in draw.choice(kinds)]))
    rows += [(200, hashes[0], None), (201, None, kinds[0])]
    got = dedup.similar_pairs(spark.createDataFrame(rows, "id long, h long, v array<double>"), "id", "h", "v").collect()
    assert len({(r.a, r.b) for r in got}) == len(got) and all(r.a < r.b for r in got)
    links = [
        (a, b) for a, h, v in rows[:120] for b, g, w in rows[:120]
        if a < b and bin(h ^ g).count("1") <= 5 and np.corrcoef(v, w)[0, 1] >= 0.95
    ]
    assert brute_components([(r.a, r.b) for r in got]) == brute_components(links)
    assert {(r.a, r.b) for r in got} <= set(links)


def test_triage_groups_behind_another_histogram(spark):
    """B and C are copies; A has their hash, but another histogram."""
    from quarry.plans.triage import triage

    kinds = {"x": [1.0, 0.0, 5.0, 2.0], "y": [4.0, 3.0, 0.0, 1.0]}
    schema = "path string, width int, height int, blur_var double, dark_ratio double, bright_ratio double, phash long, histogram array<double>"
    seen = spark.createDataFrame([], "image string, pred_index int, conf double, poly array<struct<x:double,y:double>>, w double, h double, angle double")
    for odd in range(3):  # whichever of them comes first by its id
        rows = [(f"/r/{i}.jpg", 640, 480, 100.0, 0.0, 0.0, 77, kinds["x" if i == odd else "y"]) for i in range(3)]
        got = {r.path: r.duplicate_group for r in triage(spark.createDataFrame(rows, schema), seen, "/r").collect()}
        assert [got[f"/r/{i}.jpg"] for i in range(3)] == [None if i == odd else 1 for i in range(3)]


def test_similar_pairs_of_a_crowd(spark, monkeypatch):
    """Few links group a crowd, of odd vectors too, as all links do."""
    import numpy as np

    from quarry.functions import correlation

    monkeypatch.setattr(dedup, "CROWD", 64)
    draw = np.random.default_rng(7)
    vectors = draw.normal(size=(300, 6)).tolist()
    vectors += [[0.1] * 6, [1.0, 2.0, 3.0], [1.0, 2.0, 3.5], [None, *vectors[0][1:]], [0.5] * 6]
    rows = [(i, (3, 5, 3 << 40)[i % 3] if i < 280 else (1 << 40) - 1, v) for i, v in enumerate(vectors)]
    pairs = dedup.similar_pairs(spark.createDataFrame(rows, "id long, h long, v array<double>"), "id", "h", "v", least=0.9)
    got = [(r.a, r.b, r.correlation) for r in pairs.collect()]
    exact = correlation.Rows(pa.array(vectors, pa.list_(pa.float64()))).exact
    a, b = np.triu_indices(len(rows), 1)
    links = {(int(x), int(y)): c for x, y, c in zip(a, b, exact(a, b)) if c >= 0.9 and (x < 280) == (y < 280)}
    assert 200 < len(links) and all(links[x, y] == c for x, y, c in got)
    assert brute_components([(x, y) for x, y, _ in got]) == brute_components(list(links))

    crowd = [(i, 9, [float(i), 2.0 * i + 1, i + i % 7 / 8]) for i in range(500)]
    got = dedup.similar_pairs(spark.createDataFrame(crowd, "id long, h long, v array<double>"), "id", "h", "v", least=0.0)
    assert got.count() < 20 * len(crowd)
    assert set(brute_components([(r.a, r.b) for r in got.collect()])) == set(range(500))


def test_overlap_at_its_limit(spark):
    """270 of 1800 is 0.15 to the last bit, wherever the edges cross."""
    from quarry.functions import geometry

    rows = [("a", 1, 38.0, 0.0, 88.0, 55.0), ("a", 2, 7.0, 25.0, 47.0, 70.0)]
    boxes = spark.createDataFrame(rows, "image string, index int, x1 double, y1 double, x2 double, y2 double")
    boxes = boxes.withColumn("poly", geometry.aabb("x1", "y1", "x2", "y2"))
    got = matching.pair_overlaps(boxes).first()
    assert (got.pairs, got.overlapping, got.has_overlap, got.overlap_pair_ratio) == (1, 1, False, 1.0)
    pair = boxes.where("index = 1").select(F.col("poly").alias("p")).join(boxes.where("index = 2").select(F.col("poly").alias("q")))
    assert pair.select(geometry.intersection_area("p", "q"), geometry.intersection_area("q", "p")).first()[:] == (270.0, 270.0)


def test_mean_confidence_in_any_order(spark):
    """A limit of 0.9 decides the same in whatever order the rows are added up."""
    from itertools import permutations

    nine = 0.09 * 10  # a bit less than 0.9
    sets = [(0.8, 0.8, 1.0, 1.0), (0.8, nine, nine, 1.0), (nine,) * 6]
    for conf in sets:
        rows = [(f"{k}", c) for k, order in enumerate(sorted(set(permutations(conf)))) for c in order]
        pred = spark.createDataFrame(rows, "image string, conf double").coalesce(1)
        assert triage.confidence_profile(pred, "image").select("mean_conf").distinct().count() == 1
    odd = [("nan", float("nan")), ("nan", 0.5), ("large", 1e30), ("large", 3e30), ("none", None), ("some", None), ("some", 0.25)]
    got = triage.confidence_profile(spark.createDataFrame(odd, "image string, conf double"), "image").collect()
    got = {r.image: r.mean_conf for r in got}
    same = spark.createDataFrame([("i", nine)] * 6, "image string, conf double")  # every order gives 0.9
    assert triage.confidence_profile(same, "image").first().mean_conf == 0.9
    assert got["nan"] != got["nan"] and (got["large"], got["none"], got["some"]) == (2e30, None, 0.25)
