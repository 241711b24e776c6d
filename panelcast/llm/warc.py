"""WARC archives: writing, and reading as a table of payload chunks.

A record leaves its task as a few text rows, one per chunk of the payload, which Spark's text writer puts one after the
other: HTTP's chunked transfer coding ends each chunk with the same CRLF that ends a row.  Reading goes the other way,
line by line through Spark's text reader, and gives (record, chunk number) rows with the digest of the payload so far.
Neither side ever holds a whole record.  Archives are gzip files, so each is read by one task, from its start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.llm.common import small_or_plain, stored

#: Payloads shorter than this are never revisits.
MIN_BYTES = 100
CHUNK = 1 << 16
#: Bytes of rows that a task gathers before it passes them on.
BATCH = 1 << 22
CRLF = b"\r\n"
#: Fixed by the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNK_FIELDS = (
    "record_id string, page_id long, record_type string, refers_to long, chunk int, data binary, "
    "bytes_so_far long, sha256_so_far string, last boolean, stated_bytes long, stated_sha256 string"
)


def record_rows(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> Iterator[bytes]:
    """The text rows of one record; the writer ends each with CRLF."""
    name = lambda i: b"<urn:page:%s>" % (b"" if i is None else b"%d" % i)
    # Header values are single lines.
    uri = " ".join((url or "").split()).encode("utf-8")
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: " + name(page_id)]
    head += [b"WARC-Date: " + date.encode(), b"WARC-Target-URI: " + uri, b"Content-Type: application/http;msgtype=response", b"WARC-Payload-Digest: sha256:" + digest.encode()]
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"]
    cuts = [0]
    if refers_to is None:
        http.append(b"Transfer-Encoding: chunked")
        while cuts[-1] < len(payload):
            end = min(len(payload), cuts[-1] + CHUNK)
            while end < len(payload) and payload[end] & 0xC0 == 0x80:  # not inside a character
                end -= 1
            cuts.append(end)
    else:
        http.append(b"Content-Length: %d" % len(payload))
        head += [b"WARC-Refers-To: " + name(refers_to), b"WARC-Profile: " + PROFILE.encode()]
    size = sum(len(x) + 2 for x in http) + 2
    if refers_to is None:
        size += sum(len(b"%x" % (b - a)) + 4 + b - a for a, b in zip(cuts, cuts[1:])) + 5
    yield CRLF.join([*head, b"Content-Length: %d" % size, b""])
    yield CRLF.join([*http, b""])
    if refers_to is None:
        for a, b in zip(cuts, cuts[1:]):
            yield b"%x\r\n" % (b - a) + payload[a:b]
        yield b"0" + CRLF
    yield CRLF


def plan_records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: of equal payloads of ``min_bytes`` or more, all but those with the smallest id refer to it.

    NULL payloads count as empty.  Rows that share the smallest id are all responses; a row without id refers to the
    smallest id there is, and is a response if there is none.
    """
    url = F.col(url_col).cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    slim = slim.withColumn("digest", F.sha2("payload", 256))
    shared = slim.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = stored(shared.where("n > 1").select("digest", "first"), "payloads")
    joined = slim.join(small_or_plain(shared, shared.count()), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", **columns) -> None:
    """One record per row, as gzip text files below ``path``: a file per task, a record never spans two."""

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*(b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                for row in record_rows(page_id.as_py(), url.as_py(), payload.as_buffer().to_pybytes(), digest.as_py(), refers_to.as_py(), date):
                    rows.append(row)
                    size += len(row)
                if size >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()).cast(pa.string())], names=["value"])
                    rows, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()).cast(pa.string())], names=["value"])

    text = plan_records(pages, **columns).mapInArrow(run, "value string")
    text.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class _Reader:
    """Takes lines without their CRLF, gives chunk rows."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.size = 0
        self.start()

    def start(self) -> None:
        self.state, self.warc, self.http, self.body = "between", {}, {}, 0
        self.held, self.sha, self.chunk, self.done = bytearray(), hashlib.sha256(), 0, 0

    @staticmethod
    def _header(into: dict, line: bytes) -> None:
        name, _, value = line.partition(b":")
        into[name.strip().lower().decode("latin-1")] = value.strip()

    def _page(self, name: str):
        digits = self.warc.get(name, b"").removeprefix(b"<urn:page:").removesuffix(b">")
        return int(digits) if digits.lstrip(b"-").isdigit() else None

    def _emit(self, data: bytes, last: bool) -> None:
        self.sha.update(data)
        self.done += len(data)
        kind = self.warc.get("warc-type", b"").decode()
        stated = self.done if kind != "revisit" else int(self.http.get("content-length", b"0"))
        digest = self.warc.get("warc-payload-digest", b"").decode().removeprefix("sha256:")
        self.rows.append((self.warc.get("warc-record-id", b"").decode(), self._page("warc-record-id"), kind, self._page("warc-refers-to"), self.chunk, data, self.done, self.sha.hexdigest(), last, stated, digest))
        self.chunk += 1
        self.size += len(data) + 300

    def _payload(self, data: bytes) -> None:
        self.held += data
        while len(self.held) > CHUNK:
            self._emit(bytes(self.held[:CHUNK]), False)
            del self.held[:CHUNK]

    def _end(self) -> None:
        self._emit(bytes(self.held), True)
        self.start()

    def _data(self, data: bytes) -> bool:
        """Take a line of a body or transfer chunk; true when it is complete."""
        if len(data) > self.left:
            raise ValueError(f"record {self.warc.get('warc-record-id')}: {len(data) - self.left} bytes too many")
        self.left -= len(data)
        self._payload(data)
        return not self.left

    def line(self, line: bytes) -> None:
        if self.state == "between":
            if line.startswith(b"WARC/"):
                self.state = "warc"
            elif line:
                raise ValueError(f"a record was expected, not {line[:60]!r}")
        elif self.state == "warc":
            if line:
                self._header(self.warc, line)
                return
            self.left = int(self.warc.get("content-length", b"0"))
            if not self.warc.get("content-type", b"").startswith(b"application/http"):
                self.state, self.first = "body", True
                if not self.left:
                    self._end()
            else:
                self.state = "http"
        elif self.state == "http":
            self.left -= len(line) + 2
            if line:
                self._header(self.http, line)
            elif self.http.get("transfer-encoding", b"").lower() == b"chunked":
                self.state = "size"
            elif self.left > 0:
                self.state, self.first = "body", True
            else:
                self._end()
        elif self.state == "size":
            self.left = int(line.partition(b";")[0], 16)
            self.state, self.first = ("data", True) if self.left else ("trailer", True)
        elif self.state == "trailer":
            if not line:
                self._end()
        else:
            data = line if self.first else CRLF + line
            self.first = False
            if self._data(data):
                if self.state == "body":
                    self._end()
                else:
                    self.state = "size"

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 11
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in CHUNK_FIELDS.split(", ")])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives below ``path``: rows of one record are consecutive, the last is marked.

    ``stated_bytes`` is the payload's length (for a revisit, that of the payload it stands for).  Damaged archives
    raise ValueError.
    """

    def run(batches):
        reader = _Reader()
        for b in batches:
            for line in b.column(0).cast(pa.binary()).to_pylist():
                reader.line(line)
                if reader.size >= BATCH:
                    yield reader.take()
        if reader.state != "between":
            raise ValueError(f"record {reader.warc.get('warc-record-id')} ends early, in its {reader.state}")
        yield reader.take()

    lines = spark.read.schema("value string").option("lineSep", "\r\n").text(path)
    return lines.mapInArrow(run, CHUNK_FIELDS)


def records(chunks: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` per record, from the last chunk of each."""
    digest = F.when(F.col("record_type") == "revisit", F.col("stated_sha256")).otherwise(F.col("sha256_so_far"))
    intact = (F.col("record_type") == "revisit") | (F.col("sha256_so_far") == F.col("stated_sha256"))
    return chunks.where("last").select("page_id", F.col("stated_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to", intact.alias("intact"))
