"""WARC archives: writing, reading back, and the merged capture index."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.base import Table, scratch_path, small_batches

#: Payloads under this size are never revisits.
MIN_PAYLOAD = 100
#: Records in one archive file, and captures in one range of the index, at most.
FILE_RECORDS, RANGE_ROWS = 500, 200_000
#: A gzip member holds so many bytes at most: under 2**24, so that it ends in a zero.
MEMBER = 1 << 23
CRLF = "\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = {
    "WARC-Type": "record_type",
    "WARC-Target-URI": "url",
    "WARC-Date": "captured",
    "X-Page-Id": "page_id",
    "WARC-Payload-Digest": "said_digest",
    "X-Refers-To-Page-Id": "refers_to",
}


def records(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """A page's record: ``page_id, url, payload, payload_digest, record_type,
    refers_to``.  Of equal payloads the smallest page_id's is the response; the
    others revisit it and carry no payload.  A digest's smallest id is a partial
    aggregation; the join that returns it splits hot digests."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        rows.where(F.octet_length("payload") >= min_payload).groupBy(F.col("payload_digest").alias("d"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(Table(first, "first-payloads").df, F.col("payload_digest") == F.col("d"), "left").select(
        "page_id", "url", "payload_digest",
        F.when(again, "").otherwise(F.col("payload")).alias("payload"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _members(record: bytes) -> bytes:
    """The record as a gzip member of its own, or as a few if it is very large."""
    out = []
    for at in range(0, max(len(record), 1), MEMBER):
        member = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(member.compress(record[at : at + MEMBER]) + member.flush())
    return b"".join(out)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records compressed, without the zero that ends a member: the writer adds it."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            packed = [_members(r)[:-1] for r in batch.column(0).slice(at, 256).to_pylist()]
            yield pa.record_batch([pa.array(packed, pa.binary())], ["value"])


def write_archives(rows: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """WARC/1.1 files of the records, each compressed by itself, so that a record can
    be read from its offset alone.

    They are written by Spark's text writer, so that any store Spark can write to
    will do.  It puts a separator after each value: the zero that ends every gzip
    member whose contents are shorter than 2**24 bytes."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    urn = lambda c: F.concat(F.lit("<urn:quarry:page:"), text(c), F.lit(">"))
    # seconds after a fixed date, in order of page ids
    date = F.date_format(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.pmod("page_id", F.lit(1 << 30)), F.lit(0))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    # no header may hold a line break
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    again = F.concat(line("WARC-Profile", F.lit(IDENTICAL)), line("WARC-Refers-To", urn("refers_to")))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Target-URI", url),
        line("WARC-Date", date),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("X-Page-Id", text("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(F.col("record_type") == "revisit", again).otherwise(""),
        line("X-Refers-To-Page-Id", text("refers_to")),
        line("Content-Length", F.octet_length("payload").cast("string")),
        F.lit(CRLF), F.col("payload"), F.lit(CRLF + CRLF),
    )
    packed = rows.select(record.cast("binary").alias("value")).mapInArrow(_packed, "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", file_records
    ).text(path)


def _inflated(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    """The contents of each gzip member with its place and length; what isn't
    compressed comes as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data, 0, len(data)
        return
    view, at = memoryview(data), 0
    while at < len(data) and data[at : at + 2] == b"\x1f\x8b":
        member, out, end = zlib.decompressobj(31), [], at
        while not member.eof:
            chunk = view[end : end + (1 << 16)]
            if not len(chunk):
                raise ValueError(f"gzip member at byte {at} has no end")
            out.append(member.decompress(chunk))
            end += len(chunk) - len(member.unused_data)
        yield b"".join(out), at, end - at
        at = end


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Header fields and block of each record, by Content-Length, and the bytes of the
    file that hold it: where its first gzip member begins, and how many to its last's end."""
    held, start, end = b"", 0, 0
    for more, at, size in _inflated(data):
        start = start if held else at
        held, end = held + more, at + size
        here = 0
        while (head := held.find(b"\r\n\r\n", here)) >= 0:
            version, *lines = held[here:head].decode("utf-8").split(CRLF)
            if not version.startswith("WARC/"):
                raise ValueError(f"no WARC record in the member at byte {start}")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
            body = head + 4
            close = body + int(fields["Content-Length"])
            if len(held) < close + 4:
                break  # goes on in the next member
            if held[close : close + 4] != b"\r\n\r\n":
                raise ValueError(f"record not closed in the member at byte {start}")
            yield fields, held[body:close], start, end - start
            here = close + 4
        held = held[here:]
    if held:
        raise ValueError(f"record cut off in the member at byte {start}")


def url_key(url: str) -> str:
    """The URL with its host's labels reversed, so that a site stands together; what
    is no URL stands for itself."""
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host = ",".join(reversed((parts.netloc.rpartition("@")[2].partition(":")[0]).lower().split(".")))
        return f"{host}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"
    except ValueError:
        return url


def _capture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per record; the payload's length and digest are those of the block."""
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            names = (*FIELDS.values(), "url_key", "offset", "length", "block_bytes", "block_digest")
            rows: dict[str, list] = {c: [] for c in names}
            for fields, block, offset, length in parse_archive(data):
                for field, column in FIELDS.items():
                    rows[column].append(fields[field])
                rows["said_digest"][-1] = rows["said_digest"][-1].removeprefix("sha256:")
                found = url_key(rows["url"][-1]), offset, length, len(block), hashlib.sha256(block).hexdigest()
                for column, value in zip(names[len(FIELDS) :], found):
                    rows[column].append(value)
            whole = ("page_id", "refers_to")
            as_id = lambda c: pa.array([None if x == "-" else int(x) for x in rows[c]], pa.int64())
            kinds = {"offset": pa.int64(), "length": pa.int64(), "block_bytes": pa.int64()}
            yield pa.record_batch(
                [as_id(c) if c in whole else pa.array(rows[c], kinds.get(c, pa.string())) for c in names]
                + [pa.array([path] * len(rows["url"]), pa.string())],
                [*names, "archive"],
            )


CAPTURES = (
    "record_type string, url string, captured string, page_id long, said_digest string, refers_to long, "
    "url_key string, offset long, length long, block_bytes long, block_digest string, archive string"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``record_type, url, captured, page_id, payload_bytes,
    payload_digest, refers_to, url_key, archive, offset, length``.

    Payloads are measured: a response's from its block, a revisit's from the block
    of the response that it refers to.  A block whose digest isn't the one in its
    header, or a revisit whose response isn't there, is an error.  A file is parsed
    at a time; ``write_archives`` bounds its records."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("path", "content")
    captures = Table(files.mapInArrow(_capture, CAPTURES), "captures").df
    wrong = lambda why: F.raise_error(F.concat(F.lit(f"{why}: "), "archive", F.lit(" at byte "), F.col("offset").cast("string")))
    revisit = F.col("record_type") == "revisit"
    responses = captures.where(~revisit).groupBy(F.col("block_digest").alias("r_digest")).agg(
        F.min("page_id").alias("r_page"), F.max("block_bytes").alias("r_bytes")
    )
    wanted = captures.where(revisit).select(F.col("said_digest").alias("r_digest")).distinct()
    responses = Table(responses.join(wanted, "r_digest"), "revisited").df  # a join with it can split a hot digest
    sound = F.when(revisit, F.col("r_page") == F.col("refers_to")).otherwise(F.col("block_digest") == F.col("said_digest"))
    return captures.join(responses, revisit & (F.col("said_digest") == F.col("r_digest")), "left").select(
        "record_type", "url", "captured", "page_id",
        F.when(revisit, F.col("r_bytes")).otherwise(F.col("block_bytes")).alias("payload_bytes"),
        F.when(~F.coalesce(sound, F.lit(False)), wrong("payload not as its header says"))
        .otherwise(F.when(revisit, F.col("r_digest")).otherwise(F.col("block_digest"))).alias("payload_digest"),
        "refers_to", "url_key", "archive", "offset", "length",
    )


class LoserTree:
    """k-way merge of sorted sequences: each inner node holds the loser of its
    match, so the next smallest costs one match per level."""

    def __init__(self, runs: list[Iterator]):
        self.k = k = max(1, len(runs))
        self.runs = runs
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [0] * k
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._less(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else 0

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.winner]) is not None:
            yield head
            i = self.winner
            self.heads[i] = next(self.runs[i], None)
            node = (i + self.k) // 2
            while node:
                if self._less(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one key range.  Its rows come as they are fetched, each run
    in order: a run ends where the next key is smaller.  Rows stay in Arrow; of keys
    a few at the head of each run are held."""
    held, cuts, n, last = [], [0], 0, None

    def keys(batch) -> list[tuple]:
        ids = [-1 if i is None else i for i in batch.column("page_id").to_pylist()]
        return list(zip(batch.column("url_key").to_pylist(), batch.column("captured").to_pylist(), ids))

    for batch in batches:
        for i, key in enumerate(keys(batch)):
            if last is not None and key < last:
                cuts.append(n + i)
            last = key
        held.append(batch)
        n += batch.num_rows
    if not n:
        return
    rows = pa.Table.from_batches(held)

    def run(start: int, end: int) -> Iterator[tuple]:
        for at in range(start, end, 256):
            part = rows.slice(at, min(256, end - at))
            yield from ((*key, at + i) for i, key in enumerate(keys(part)))

    tree = iter(LoserTree([run(a, b) for a, b in zip(cuts, [*cuts[1:], n])]))
    while order := [key[3] for key in itertools.islice(tree, 8192)]:
        yield from rows.take(pa.array(order)).combine_chunks().to_batches()


def capture_index(captures: DataFrame, ranges: int | None = None) -> DataFrame:
    """The captures in order of URL key, time and id over all partitions.

    External merge: every task sorts the captures it has and writes them as a
    run; the runs are cut into key ranges (sampled, over key, time and id, so
    that a site with a third of all captures fills many ranges) of ``RANGE_ROWS``
    or so; a task gets the parts of all runs in its range, each already in order,
    and merges them by a loser tree.  ``part`` numbers the ranges in order and
    ``place`` the captures in theirs.
    """
    spark = captures.sparkSession
    keys = ["url_key", "captured", "page_id"]
    runs = Table(captures.sortWithinPartitions(*keys), "capture-runs").df
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), runs.count() // RANGE_ROWS + 1)
    ordered = runs.repartitionByRange(n, *keys).mapInArrow(_merge, runs.schema)
    return ordered.withColumn("part", F.spark_partition_id()).withColumn(
        "place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )


def archive_pages(pages: DataFrame, path: str | None = None, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write a WARC record per page, read the archives back and merge their
    captures: the rows of ``capture_index`` over what the archives say, payloads
    measured as they are read.

    Defined cases: null html is an empty payload, a null url an empty one; a url
    that can't be parsed is its own key, and line breaks in it are percent coded;
    a very large payload is compressed in several members;
    payloads under ``min_payload`` bytes are responses all; a page without id is
    a response, or revisits the smallest id of its payload; rows repeated under
    one id are records of their own, responses if their id is the smallest; equal
    times are in order of id; an empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    small_batches(pages.sparkSession)
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(records(pages, min_payload), path)
    return capture_index(read_archives(pages.sparkSession, path))


SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
), f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f
"""
