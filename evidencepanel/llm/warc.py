"""Web archives: records written and read by Spark, and a merged capture index.

A record is one row of a text file whose line separator is the end mark of WARC records,
so any file system Spark writes to will do, and the commit of the job is the commit of
the archive.  Files are read back whole and parsed by content length.  Each archive
yields a sorted run of captures; runs are exchanged by ranges of (URL key, time) and
merged by a loser tree into globally ordered histories.
"""

from __future__ import annotations

import gzip
import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencepanel.llm.common import stored
from evidencepanel.operators.groups import same_key
from evidencepanel.plans.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REVISIT_BYTES = 100
RECORDS_PER_FILE = 4096
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = (
    "archive string, position long, page_id long, url string, url_key string, captured string, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, intact boolean"
)
CAPTURE_NAMES = [f.split()[0] for f in CAPTURE.split(", ")]
CAPTURE_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]


def record_kinds(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, payload_digest, payload_bytes, record_type, refers_to`` of ``page_id, html``.

    Of equal payloads of at least ``least`` bytes the smallest number is the response.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    digests = stored(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes")),
        "digests",
    )
    large = digests.where(F.col("payload_bytes") >= least)
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = first.withColumnRenamed("payload_digest", "_digest")
    joined = digests.join(first, same_key([(digests["payload_digest"], first["_digest"])]), "left")
    again = (F.col("payload_bytes") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id",
        "payload_digest",
        "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, path: str, captured: Column | None = None, least: int = REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes one record per row of ``page_id, url, html``; revisits carry no payload.

    ``captured`` is the time of capture (the start of 1970 if not given).  Null html is an
    empty payload, a null address has no target line, line breaks in addresses are
    escaped.
    """
    kinds = record_kinds(pages, least).distinct()
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.translate(F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A"), "\0", "").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.coalesce(captured if captured is not None else F.lit(None).cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("captured"),
    ).withColumn("digest", F.sha2("html", 256))
    rows = given.join(kinds.withColumnRenamed("page_id", "_page"), [given["page_id"].eqNullSafe(F.col("_page")), given["digest"] == F.col("payload_digest")])
    again = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, "html"))

    def line(name: str, value) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        line("WARC-Profile", F.when(again, F.lit(PROFILE))),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END)),
    )
    rows.select(F.concat(header, block).alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def url_key(url: str | None) -> str:
    """Host parts from the last to the first, then path and query; scheme, ``www`` and port go."""
    rest = (url or "").split("://", 1)[-1]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].rsplit("@", 1)[-1].split(":", 1)[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:].split("#", 1)[0].lower()


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(position, header, block)`` of every record of an archive."""
    mark, at = END.encode(), 0
    while at < len(data):
        end = data.index(mark, at)
        lines = data[at:end].decode().split("\r\n")
        header = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        start = end + len(mark)
        stop = start + int(header["content-length"])
        yield at, header, data[start:stop]
        if data[stop : stop + len(mark)] != mark:
            raise ValueError(f"the record at {at} does not end where its length says")
        at = stop + len(mark)


def _number(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _capture(archive: str, at: int, header: dict[str, str], block: bytes) -> tuple:
    stated = header["warc-payload-digest"].removeprefix("sha256:")
    http, _, payload = block.partition(END.encode())
    length = int(next(x.split(b": ")[1] for x in http.split(b"\r\n") if x.startswith(b"Content-Length")))
    kind, url = header["warc-type"], header.get("warc-target-uri")
    digest, intact = stated, True
    if kind == "response":
        digest, intact = hashlib.sha256(payload).hexdigest(), len(payload) == length
        length = len(payload)
    return (archive, at, _number(header.get("warc-record-id")), url, url_key(url), header["warc-date"], kind, _number(header.get("warc-refers-to")), length, digest, intact and digest == stated)


def sort_key(row: tuple) -> tuple:
    """URL key, time, number (none first), then where the record lies."""
    return (row[4], row[5], row[2] is not None, row[2] or 0, row[0], row[1])


def _batches(rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), CAPTURE_TYPES, strict=True)], names=CAPTURE_NAMES)

    for row in rows:
        part.append(row)
        if len(part) == size:
            yield batch()
            part = []
    if part:
        yield batch()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``, those of each archive as a sorted run.

    Payload length and digest of responses are taken from the payload itself; ``intact``
    tells whether they agree with the headers.
    """

    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = gzip.decompress(content.as_py()) if archive.endswith(".gz") else content.as_py()
                yield from _batches(iter(sorted((_capture(archive, *r) for r in parse_records(data)), key=sort_key)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, CAPTURE)


class LoserTree:
    """Merges sorted runs; inner nodes hold the losers of the matches on the way up."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs = [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _next(self, run: int) -> tuple | None:
        row = next(self.runs[run], None)
        return None if row is None else (sort_key(row), row)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a comes first; an ended run comes last, ties go to the lower run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to arrive waits here
                self.losers[node] = run
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head[1]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def capture_histories(captures: DataFrame) -> DataFrame:
    """All captures ordered by URL key, time and number across partitions, in order.

    Ranges are cut on the whole key, so one address with most captures is spread too.
    """
    ranged = captures.repartitionByRange("url_key", "captured", "page_id", "archive", "position")

    def run(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs.setdefault(row[0], []).append(row)
        for rows in runs.values():
            rows.sort(key=sort_key)  # a run that arrives in order costs one comparison a row
        yield from _batches(iter(LoserTree([runs[k] for k in sorted(runs)])))

    return ranged.mapInArrow(run, CAPTURE)


def archived_pages(pages: DataFrame, path: str | None = None, captured: Column | None = None, least: int = REVISIT_BYTES) -> DataFrame:
    """Writes all pages as archives, reads them back, and returns the merged histories.

    One row per input row.  Null html is an empty payload; payloads below ``least`` bytes
    are always responses.  Rows that repeat a number and payload are responses together
    where that number is the smallest; a null number is never referred to.  An empty
    table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    place = path or scratch_path(spark, "llm-warc")
    write_warc(pages, place, captured, least)
    return capture_histories(stored(read_warc(spark, place), "captures"))
