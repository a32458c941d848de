"""WARC archives and their capture index.

Pages become WARC records, written by Spark's text writer with the record separator of the format,
so archives go to any file system that Spark can write. Reading follows the Content-Length of each
record. Each archive yields a run of its captures sorted by URL key and time; the runs are dealt
by key range, and each range merges its pieces of all runs with a loser tree, which gives one
global order of captures.

Equal payloads of at least ``least_bytes`` bytes are stored once: the record of the smallest page
is a response, the others are revisits that refer to it.

Defined results: null html is an empty payload; a null URL has an empty key; pages with a null id
refer to others but are not referred to; rows that repeat the smallest page id are responses
themselves; an empty table gives no records; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.workspace import Workspace

LEAST_BYTES = 100
RECORDS_PER_FILE = 4_000
ROWS_PER_MERGE = 250_000
# The tables have no capture time: a page is captured so many seconds after this.
FIRST_CAPTURE = 1_704_067_200
BREAK = "\r\n"
CAPTURE = (
    "url_key string, captured_at string, page_id long, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, archive string, offset long"
)
NAMES = [part.split()[0] for part in CAPTURE.split(", ")]


def described_payloads(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, its digest and length, and refers_to (null: a response)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha2(F.col("payload").cast("binary"), 256),
        }
    )
    first = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first_id IS NOT NULL")
        .select(F.col("payload_digest").alias("_digest"), "first_id")
    )
    # One row per payload that repeats; a payload of very many pages is split by the skew join.
    joined = rows.join(first, F.col("payload_digest") == F.col("_digest"), "left")
    other = F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))
    return joined.withColumn("refers_to", F.when(other, F.col("first_id"))).drop(
        "_digest", "first_id"
    )


def _header(name: str, value) -> F.Column:
    """One header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def _record_id(page_id):
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def write_archives(pages: DataFrame, path: str) -> None:
    """One record per row of ``described_payloads``, gzip files of RECORDS_PER_FILE records."""
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    seconds = F.lit(FIRST_CAPTURE) + F.coalesce(F.pmod("page_id", F.lit(31_536_000)), F.lit(0))
    # A header value is one line.
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    value = F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(BREAK)),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))),
        _header("WARC-Target-URI", url),
        _header(
            "WARC-Date",
            F.date_format(
                F.convert_timezone(
                    F.current_timezone(), F.lit("UTC"),
                    F.timestamp_seconds(seconds).cast("timestamp_ntz"),
                ),
                "yyyy-MM-dd'T'HH:mm:ss'Z'",
            ),
        ),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Refers-To", _record_id(F.col("refers_to"))),
        _header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit(f"Content-Type: text/html; charset=utf-8{BREAK}"),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit(BREAK),
        body,
    )
    (
        pages.select(value.alias("value"))
        .write.option("lineSep", BREAK + BREAK)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def url_key(url: str) -> str:
    """Host labels in reverse order, then the rest, so that pages of a domain sort together."""
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(.*)", url, re.S)
    if not found:
        return url
    host, rest = found.groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + rest


def parse_archive(name: str, content: bytes):
    """A capture for every record of one archive, its payload read and digested."""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at} of {name}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        body = data[end + 4 : end + 4 + size]
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = headers["WARC-Type"]
        if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"damaged payload at {at} of {name}")

        def number(header: str) -> int | None:
            return int(headers[header][len("<urn:page:") : -1]) if header in headers else None

        yield (
            url_key(headers.get("WARC-Target-URI", "")),
            headers["WARC-Date"],
            number("WARC-Record-ID"),
            len(body) if kind == "response" else int(headers["X-Payload-Length"]),
            digest,
            kind,
            number("WARC-Refers-To"),
            name,
            at,
        )
        at = end + 4 + size + 4


def order_of(capture: tuple) -> tuple:
    """URL key, time, page (a missing one first), then the place in the archives."""
    page = capture[2]
    return (capture[0], capture[1], page is not None, page or 0, capture[7], capture[8])


def _batch(captures: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64() if f.split()[1] == "long" else pa.string() for f in CAPTURE.split(", ")]
    columns = list(zip(*captures)) or [()] * len(NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(columns, kinds)], names=NAMES
    )


def sorted_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of every archive under ``path``, sorted within each archive."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def work(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                found = parse_archive(name.as_py().rsplit("/", 1)[-1], content.as_py())
                yield _batch(sorted(found, key=order_of))

    return files.select("path", "content").mapInArrow(work, CAPTURE)


class LoserTree:
    """The smallest head of several sorted runs, with one comparison per level for each step."""

    def __init__(self, runs: list):
        self.runs = [iter(run) for run in runs]
        self.heads = [next(run, None) for run in self.runs]
        self.size = len(runs)
        # losers[0] is the winner; losers[i] is the run that lost at inner node i.
        self.losers = [-1] * max(self.size, 1)
        for run in range(self.size):
            self._replay(run)

    def _before(self, left: int, right: int) -> bool:
        if self.heads[left] is None or self.heads[right] is None:
            return self.heads[right] is None and self.heads[left] is not None
        return self.heads[left] < self.heads[right]

    def _replay(self, run: int) -> None:
        node = (run + self.size) // 2
        while node > 0:
            if self.losers[node] == -1:
                self.losers[node] = run
                return
            if self._before(self.losers[node], run):
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.losers[0] = run

    def __iter__(self):
        while self.size and self.heads[self.losers[0]] is not None:
            run = self.losers[0]
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self._replay(run)


def merge_runs(runs: DataFrame, rows_per_merge: int = ROWS_PER_MERGE) -> DataFrame:
    """All captures in the order of URL key, time and page, over the partitions of the result.

    A range holds about ``rows_per_merge`` captures, however many share one URL."""
    spark = runs.sparkSession
    count = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // rows_per_merge)
    )

    def work(batches):
        pieces: dict[str, list] = {}
        for batch in batches:
            for capture in zip(*[column.to_pylist() for column in batch.columns]):
                pieces.setdefault(capture[7], []).append((order_of(capture), capture))
        # A piece arrives in its run's order unless a fetch was repeated; sorting a sorted list
        # only checks it.
        for piece in pieces.values():
            piece.sort()
        merged: list[tuple] = []
        for _, capture in LoserTree(list(pieces.values())):
            merged.append(capture)
            if len(merged) == 10_000:
                yield _batch(merged)
                merged = []
        if merged:
            yield _batch(merged)

    dealt = runs.repartitionByRange(count, "url_key", "captured_at", "page_id", "archive", "offset")
    return dealt.mapInArrow(work, CAPTURE)


def capture_history(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archives under ``path`` (scratch if not given), read them back, and
    return all captures in global order."""
    spark = pages.sparkSession
    workspace = Workspace.of(spark)
    path = path or workspace.new_path("archives")
    write_archives(described_payloads(pages), path)
    runs = workspace.stage(sorted_runs(spark, path), "capture-runs")
    return merge_runs(runs)
