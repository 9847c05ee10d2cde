"""WARC archives written and read by Spark, and their capture index merged from sorted runs.

Writing: pages become WARC 1.1 records. Of equal payloads, told by digest and length, the one with
the largest id is archived as a response, the others as revisits of it. Two line ends close a
record, so Spark's text writer, with these as its line separator, writes WARC files, as
compressed parts of a folder, on any file system and with its usual commit protocol.

Reading: tasks take the archives file by file, walk their records by Content-Length, and check the
digests of payloads. Each file yields one run of captures, sorted by URL key and time, with the
record's place in the archive. The external merge: a range partitioning cuts all runs at the same keys, each
task gets its stretch of every run, and a loser tree merges the k stretches. Captures of a URL are
then next to each other and in order of time across all files, and a URL with very many captures
is cut by time.

Defined results: a null payload is the empty one, a null URL is written without a target and read as
null. Rows that repeat the largest id of a payload are all responses; where a payload has no id at
all, too. A null id is written without a record number, and is read as null. Captures without a date
are dated 1970-01-01. Line ends inside URLs are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.llm.scratch import stored

RECORD_END = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURE = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, url string, url_key string, captured string, "
           "archive string, offset long, length long")
COLUMNS = tuple(field.split()[0] for field in CAPTURE.split(", "))
_TYPES = {"long": pa.int64(), "string": pa.string()}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in
                    (field.split() for field in CAPTURE.split(", "))])


def base32_of_hex(digest: str) -> Column:
    """A SHA-1 in upper-case base32; five hexadecimal digits are four of base 32."""
    pieces = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    return F.translate(F.concat(*pieces), digits, BASE32)


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url",
            payload: str = "html", date: Column | None = None, min_bytes: int = 0) -> DataFrame:
    """One WARC record per page, without the line ends that close it, as text in `record`.

    Of payloads of `min_bytes` at least, equal ones are archived once.
    """
    taken = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
        (F.lit(None).cast("timestamp") if date is None else date).alias("date"),
    ).withColumn("sha1", F.sha1(F.col("payload").cast("binary"))).withColumn(
        "bytes", F.octet_length("payload").cast("long"))
    several = (
        taken.where(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("newest"))
        .where("n > 1 and newest is not null").drop("n")
    )
    typed = taken.join(several, ["sha1", "bytes"], "left").withColumn(
        "original", F.when(~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest")))
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), "bytes", F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    stamp = F.coalesce(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z"))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                 F.lit(">")),
        F.concat(F.lit("WARC-Date: "), stamp),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex("sha1")),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), "original", F.lit(">")),
        F.when(revisit, F.lit("WARC-Profile: "
                              "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("body")))
    return typed.withColumn("body", body).select(
        F.concat(head, F.lit(RECORD_END), "body").alias("record"))


def write_archives(pages: DataFrame, path: str, **how) -> None:
    """Write pages to a folder of compressed WARC files."""
    (records(pages, **how).write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def url_key(url: str | None) -> str | None:
    """A sort key: host name backwards, then the path and query, in lower case."""
    if url is None:
        return None
    try:
        parts = urlsplit(url.strip().lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{host}){parts.path.rstrip('/') or '/'}" + (f"?{parts.query}" if parts.query else "")


def walk(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and content of each record of an uncompressed archive."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at) + 4
        version, *lines = raw[at:end - 4].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        stop = end + int(fields["Content-Length"])
        if raw[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end where it should")
        yield at, stop + 4 - at, fields, raw[end:stop]
        at = stop + 4


def _page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def captures(archive: str, content: bytes) -> list[tuple]:
    """One file's captures in the order of COLUMNS, sorted by URL key, time and page."""
    found = []
    for offset, length, fields, block in walk(zlib.decompress(content, wbits=31)):
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        size = int(head.rpartition(b"Content-Length: ")[2])
        if kind == "response":
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if own != digest or size != len(payload):
                raise ValueError(f"damaged payload in {archive} at {offset}")
        url = fields.get("WARC-Target-URI")
        found.append((_page_of(fields["WARC-Record-ID"]), size, digest, kind,
                      _page_of(fields.get("WARC-Refers-To")), url, url_key(url),
                      fields["WARC-Date"], archive, offset, length))
    return sorted(found, key=sort_key)


def sort_key(capture: tuple) -> tuple:
    """URL key, then time, page and place; null URLs and pages first."""
    page, key, captured, archive, offset = (capture[i] for i in (0, 6, 7, 8, 9))
    return (key is not None, (key or "").encode(), captured, page is not None, page or 0,
            archive, offset)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives, each file a sorted run: `archive` names it, `place` counts."""
    schema = _ARROW.append(pa.field("place", pa.int64()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                archive = name.as_py().rpartition("/")[2]
                run = captures(archive, content.as_buffer())
                yield _batch([(*row, at) for at, row in enumerate(run)], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(read, f"{CAPTURE}, place long")


class LoserTree:
    """Merges k sorted runs; each inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.k = len(runs)
        self.losers = [-1] * self.k
        for run in range(self.k):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        """Ended runs lose; of equal heads the earlier run wins."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to come waits here for its opponent
                self.losers[node] = run
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (head := self.heads[winner := self.losers[0]]) is not None:
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in global order: by `stretch`, a range of keys, and `position` in it."""
    schema = _ARROW.append(pa.field("stretch", pa.int32())).append(pa.field("position", pa.int64()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Rows come run by run, each in order; a stretch is as large as Spark cuts its ranges.
        table = pa.Table.from_batches(batches, schema=_ARROW)
        if not table.num_rows:
            return
        ordered: dict[str, list[tuple]] = {}
        for at, row in enumerate(zip(*(table[i].to_pylist() for i in range(len(COLUMNS))))):
            ordered.setdefault(row[8], []).append((sort_key(row), at))
        order = [at for _, at in LoserTree([iter(run) for run in ordered.values()])]
        merged = table.take(pa.array(order))
        stretch = TaskContext.get().partitionId()
        yield from merged.append_column(schema.field("stretch"), pa.array([stretch] * len(order), pa.int32())
                                        ).append_column(schema.field("position"),
                                                        pa.array(range(len(order)), pa.int64())
                                                        ).to_batches(max_chunksize=10_000)

    cut = runs.repartitionByRange("url_key", "captured", "page_id", "archive", "offset")
    return (cut.sortWithinPartitions("archive", "place").select(*COLUMNS)
            .mapInArrow(merge, f"{CAPTURE}, stretch int, position long"))


def capture_histories(spark: SparkSession, path: str) -> DataFrame:
    """Read archives back: the merged index, with payload sizes, digests and revisits."""
    return merge_runs(stored(read_runs(spark, path), "runs"))
