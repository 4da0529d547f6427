"""WARC archives written and read by Spark, with oversized payloads as rows of record id and chunk number.

Writing: one record per page, an HTTP response with the page as its body. A body over ``chunk`` bytes is segmented as the
format provides: a response record with segment number 1, then continuation records. So no record needs more than a chunk.
Of records with equal bodies of at least ``smallest`` bytes, the one with the smallest page id is a response; the others are
revisit records that hold the digest and refer to it. Files are gzip text files of Spark's own writer.

Reading: archives of any writer, as lines in order (no line is longer than the stretch to the next line feed, so neither a record nor a
payload is ever held whole). Every file is read by one task, which carries a payload's SHA-1 along and gives a row for each ``chunk``
bytes of it, whether the writer had cut it or not; nothing is shuffled or gathered. The digest after the last chunk is compared
with the one in the header, if that is a SHA-1. Record ids are text. Responses of HTTP are payloads without their HTTP header; blocks of
resources and of other responses are payloads; other kinds of records are passed over. A continuation whose
first segment isn't in the same file gives rows of its own type, without digest.

Defined cases: a null or empty body is an empty payload, equal to other empty ones; rows repeated with the smallest id of their group
are all responses; a row with null id is a response, unless its body is that of a row with an id; a null URL is left out; line
breaks in a URL are percent-encoded; an empty table writes no record and reads back as no rows; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Every record has this date unless another is given: archives of equal pages are equal.
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF

CHUNKS = ("record_id string, chunk long, is_last boolean, record_type string, refers_to string, payload_bytes long, payload_digest string, "
          "payload binary")


def _base32(hexed: Column) -> Column:
    """160 bits in hex as 32 characters of base 32."""
    out = []
    for group in range(4):
        bits = F.conv(F.substring(hexed, 1 + 10 * group, 10), 16, 10).cast("long")
        out += [F.substring(F.lit(BASE32), (F.shiftright(bits, 35 - 5 * k).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for k in range(8)]
    return F.concat(*out)


def write_archive(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html", smallest: int = 0,
                  chunk: int = 64 * 1024, date: str = DATE) -> str:
    """Write all pages under ``path``, which is returned. Record ids are ``urn:page:<id>``."""
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page).cast("long").alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("size", F.octet_length("body").cast("long")).withColumn("sha", F.sha1("body"))
    firsts = (rows.where(F.col("size") >= smallest).groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & F.col("first").isNotNull()).select(F.col("sha").alias("first_sha"), "first"))
    met = rows.join(firsts, F.col("sha") == F.col("first_sha"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    last = F.when(revisit, 0).otherwise(F.floor((F.greatest(F.col("size"), F.lit(1)) - 1) / chunk)).cast("int")
    segments = met.withColumn("revisit", revisit).withColumn("last", last).withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("last"))))
    part = F.when(F.col("revisit"), F.lit("")).otherwise(F.substring("body", F.col("segment") * chunk + 1, F.lit(chunk)).cast("string"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")))
    single, head = F.col("last") == 0, F.col("segment") == 0
    safe = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(label: str, value: Column | str, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{label}: "), F.lit(value) if isinstance(value, str) else value.cast("string"), F.lit(CRLF))
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    block = F.when(head, F.concat(F.lit(HTTP), F.col("part"))).otherwise(F.col("part"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(F.col("revisit"), "revisit").when(head, "response").otherwise("continuation")),
        line("WARC-Record-ID", F.concat(F.lit("<"), name, F.when(head, "").otherwise(F.concat(F.lit(":"), (F.col("segment") + 1).cast("string"))), F.lit(">"))),
        line("WARC-Target-URI", safe), line("WARC-Date", date),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")), F.col("revisit")),
        line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", F.col("revisit")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("sha")))), line("WARC-Payload-Length", F.col("size")),
        line("WARC-Segment-Number", F.col("segment") + 1, ~single), line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), name, F.lit(">")), ~head),
        line("WARC-Segment-Total-Length", F.col("size") + len(HTTP), ~single & (F.col("segment") == F.col("last"))),
        line("Content-Type", "application/http; msgtype=response"), line("Content-Length", F.octet_length("block")), F.lit(CRLF), F.col("block"))
    (segments.withColumn("part", part).withColumn("block", block).select(record.alias("value"))
     .write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path))
    return path


def read_chunks(spark: SparkSession, path: str, payload: bool = True, chunk: int = 64 * 1024) -> DataFrame:
    """Chunk rows of all archives under ``path`` (:data:`CHUNKS`): bytes and digest so far, at the last chunk those of the full payload.

    Without ``payload`` the bytes stay in the task that read them, and each record gives its last row only.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Records(chunk)
        for batch in batches:
            rows, held = [], 0
            for row in reader.feed(b"\n".join([*batch.column(0).to_pylist(), b""])):
                if payload or row[2]:
                    rows.append(row if payload else (*row[:-1], None))
                    held += len(row[-1]) if payload else 0
                if held > 1 << 23:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)
        reader.end()

    whole = spark.newSession()  # in which a file is one partition, whatever its size
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        whole.conf.set(setting, str(1 << 50))
    whole.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 22))
    return whole.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary")).mapInArrow(parse, CHUNKS)


def page_of(record_id: Column) -> Column:
    """The page that :func:`write_archive` named a record after."""
    return F.regexp_extract(record_id, r"^<?urn:page:(\d+|-\d+)(:|>|$)", 1).try_cast("long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


class _Payload:
    """A payload as far as it was read: its record, digest, bytes, and number of chunks."""

    def __init__(self, record: str, kind: str, stated: str):
        self.record, self.kind, self.stated = record, kind, stated
        self.digest = hashlib.sha1(usedforsecurity=False)
        self.size = self.chunk = 0
        self.part = bytearray()

    def add(self, data: memoryview, limit: int) -> Iterator[tuple]:
        """Rows of full chunks that more bytes follow."""
        at = 0
        while at < len(data):
            if len(self.part) == limit:
                yield self.row(False)
            taken = data[at:at + limit - len(self.part)]
            self.part += taken
            at += len(taken)

    def row(self, last: bool) -> tuple:
        self.digest.update(self.part)
        self.size += len(self.part)
        found = base64.b32encode(self.digest.digest()).decode() if self.kind != "continuation" else None
        made = (self.record, self.chunk, last, self.kind, None, self.size, found, bytes(self.part))
        if last and found and self.stated.lower().startswith("sha1:") and found != self.stated[5:].upper():
            raise ValueError(f"the payload of {self.record} has digest {found}, its record says {self.stated}")
        self.part, self.chunk = bytearray(), self.chunk + 1
        return made


class _Records:
    """The records of a stream of bytes, as rows of their chunks."""

    def __init__(self, chunk: int):
        self.limit, self.held = chunk, b""
        self.left: int | None = None  # bytes of the block that are to come; None between records
        self.own: _Payload | None = None
        self.in_http = False
        self.last = True
        self.open: dict[str, _Payload] = {}  # segmented records

    def feed(self, data: bytes) -> Iterator[tuple]:
        data, at = self.held + data if self.held else data, 0
        self.held = b""
        while at < len(data):
            if self.left is None:
                while at < len(data) and data[at] in b"\r\n":
                    at += 1
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                yield from self._begin(data[at:end])
                at = end + 4
            elif self.in_http:
                stop = min(len(data), at + self.left)
                end = data.find(b"\r\n\r\n", at, stop)
                if end < 0 and stop - at < self.left:
                    break
                self.in_http = False
                if end >= 0:
                    self.left -= end + 4 - at
                    at = end + 4
            else:
                taken = min(self.left, len(data) - at)
                if self.own is not None:
                    yield from self.own.add(memoryview(data)[at:at + taken], self.limit)
                at, self.left = at + taken, self.left - taken
            if self.left == 0 and not self.in_http:
                yield from self._finish()
        self.held = data[at:]

    def _begin(self, head: bytes) -> Iterator[tuple]:
        first, *lines = head.decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins with {first[:60]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        kind, record = fields.get("warc-type", ""), fields.get("warc-record-id", "").strip("<>")
        self.left, self.own, self.in_http = int(fields["content-length"]), None, False
        self.last = "warc-segment-number" not in fields or "warc-segment-total-length" in fields
        stated = fields.get("warc-payload-digest", "")
        if kind == "revisit":
            size = fields.get("warc-payload-length")
            yield (record, 0, True, kind, fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None, int(size) if size else None,
                   stated.partition(":")[2] or None, b"")
        elif kind in ("response", "resource"):
            self.own = _Payload(record, kind, stated)
            self.in_http = kind == "response" and fields.get("content-type", "").startswith("application/http")
            if not self.last:
                self.open[record] = self.own
        elif kind == "continuation":
            origin = fields.get("warc-segment-origin-id", "").strip("<>")
            self.own = self.open.get(origin) or _Payload(origin, kind, "")
            if self.last:
                self.open.pop(origin, None)
        self.in_http = self.in_http and self.left > 0

    def _finish(self) -> Iterator[tuple]:
        own, self.left, self.own = self.own, None, None
        if own is not None:
            yield own.row(self.last)

    def end(self) -> None:
        if self.left is not None or self.held.strip():
            raise ValueError("an archive ends inside a record")
