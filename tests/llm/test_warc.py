"""WARC archives: round trips, damage, and the order of the index."""

import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>" + "x" * 200 + "</p>"
PAGES = [
    (1, "http://b.example.org/x?q=1", LONG), (2, "http://a.example.org/", LONG), (3, "http://a.example.org/", "short"),
    (4, None, "short"), (5, "http://c.org/é", "WARC/1.1\r\n\r\n" + "ü" * 100), (6, "u", None), (7, "u", "z\0" * 50_000), (8, "u", LONG),
    (9, "http://[bad", "y" * 150), (10, "http://x.org/\r\nWARC-Type: forged", "q" * 120), (None, "v", LONG), (None, "v", "w" * 130),
    (12, "http://\u2100.org/", "k"), (13, "big", "".join(random.Random(1).choices("abcdef <>", k=20_000_000))),
    (14, "twice", "t" * 100), (14, "twice", "t" * 100), (15, "twice", "t" * 100),
]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "out")
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("payload", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("d", F.lit(1))
    return path, warc.archive_pages(pages, path).collect()


def test_round_trip(archive):
    _, got = archive
    assert len(got) == len(PAGES)
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html] = min(i, first.get(html, i))
    for i, url, html in PAGES:
        body = (html or "").encode()
        revisit = len(body) >= 100 and html in first and first[html] != i
        want = (len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None)
        assert any((r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want for r in got if r.page_id == i)
    assert next(r.url for r in got if r.page_id == 10) == "http://x.org/%0D%0AWARC-Type: forged"
    assert next(r.url_key for r in got if r.page_id == 9) == "http://[bad"


def test_records_stand_alone(archive):
    """Each record can be read from its offset; files are plain gzip."""
    path, got = archive
    for r in got:
        data = open(r.archive.removeprefix("file:"), "rb").read()
        ((fields, block, _, length),) = warc.parse_archive(data[r.offset : r.offset + r.length])
        assert length == r.length and fields["X-Page-Id"] == ("-" if r.page_id is None else str(r.page_id))
        if r.record_type == "response":
            assert hashlib.sha256(block).hexdigest() == r.payload_digest
        else:
            assert not block and fields["WARC-Profile"] == warc.IDENTICAL and fields["WARC-Refers-To"] == f"<urn:quarry:page:{r.refers_to}>"
    for name in glob.glob(f"{path}/part-*"):
        whole = gzip.open(name).read()
        assert [x[1] for x in warc.parse_archive(whole)] == [x[1] for x in warc.parse_archive(open(name, "rb").read())]


def test_damage_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", LONG), (2, "b", LONG)], SCHEMA).coalesce(1)
    path = str(tmp_path / "out")
    warc.write_archives(warc.records(pages), path)
    name = max(glob.glob(f"{path}/part-*"))
    whole = gzip.open(name).read()
    for change in ((b"xxx</p>", b"xyx</p>"), (b"To-Page-Id: 1", b"To-Page-Id: 7")):
        with open(name, "wb") as out:
            out.write(gzip.compress(whole.replace(*change)))
        for crc in glob.glob(f"{path}/.*.crc"):
            open(crc, "wb").close()
            __import__("os").remove(crc)
        with pytest.raises(Exception, match="payload not as its header says"):
            warc.read_archives(spark, path).collect()
    for cut in (whole[:-6], whole[:300], whole.replace(b"WARC/1.1", b"CRAW/1.1", 1)):
        with pytest.raises(ValueError):
            list(warc.parse_archive(gzip.compress(cut)))


def test_index_is_in_order(spark):
    draw = random.Random(9)
    pages = [(i, f"http://{draw.choice('abc')}.org/{draw.randrange(40)}", f"page {i % 300} " * 20) for i in range(3000)]
    frame = spark.createDataFrame(pages, SCHEMA).repartition(6)
    got = warc.archive_pages(frame).collect()
    order = [(r.url_key, r.captured, r.page_id) for r in sorted(got, key=lambda r: (r.part, r.place))]
    assert order == sorted(order) and len({r.page_id for r in got}) == 3000 and len({r.part for r in got}) > 1


def test_loser_tree():
    draw = random.Random(4)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((draw.randrange(50), i, j) for j in range(draw.randrange(6))) for i in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)
