"""WARC archives: a writer and a reader that salvages what follows damage.

An archive is a sequence of gzip members, one record in each. The reader checks
every member and record; where a check fails it searches on for the next valid
member or version line, goes on from there and logs the bytes in between. Inside a member of
several records it does the same on the decompressed bytes, as far as they come out.
Files are written and read by Spark, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
#: Records with a smaller payload are never revisits.
LEAST_SHARED = 100
#: Bytes from which an archive is closed; one more record may exceed them.
VOLUME_BYTES = 16 << 20
#: Fixed by the gzip format: the first bytes of a member (deflate).
MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
#: Bytes that go to the decompressor at once.
FEED = 1 << 15
#: Copies of a payload meet their first one in so many separate groups.
SALTS = 64

SCHEMA = "path string, kind string, start long, end long, reason string, record_type string, record_id string, refers_to_id string, date string, target_uri string, payload_digest string, payload_bytes long, payload binary"


# ---- writing


def record(record_type: str, record_id: str, body: bytes, headers: dict[str, str]) -> bytes:
    """One record, uncompressed. Header values must be free of line breaks; see :func:`header_value`."""
    lines = [VERSION, b"WARC-Type: " + record_type.encode(), b"WARC-Record-ID: <" + record_id.encode() + b">"]
    lines += [f"{k}: {header_value(v)}".encode() for k, v in headers.items()]
    lines += [b"Content-Length: %d" % len(body), b"", body]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def header_value(value: str) -> str:
    """The value on one line: control characters are written as in URIs."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value).strip()


def member(data: bytes) -> bytes:
    """A gzip member without time or name, so that equal records give equal bytes."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def revisit_plan(pages: DataFrame, page_id: str, payload: Column) -> DataFrame:
    """``plan_id``, ``refers_to`` of the pages that revisit another: equal payloads of ``LEAST_SHARED`` bytes or more.

    The smallest page id of a payload is the response; rows that share that id are all responses, and so are
    pages without an id, which are referred to by none.
    """
    narrow = pages.select(F.col(page_id).alias("plan_id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    large = narrow.filter((F.col("bytes") >= LEAST_SHARED) & F.col("plan_id").isNotNull()).drop("bytes")
    first = large.groupBy("digest").agg(F.min("plan_id").alias("refers_to"), F.max("plan_id").alias("last")).filter("refers_to < last")
    spread = first.select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = large.withColumn("salt", F.pmod(F.xxhash64("plan_id"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["digest", "salt"]).filter(F.col("plan_id") > F.col("refers_to")).select("plan_id", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", volume_bytes: int = VOLUME_BYTES) -> None:
    """Writes a record for each row and archives of about ``volume_bytes`` below ``path``.

    A null html is an empty payload, a null url an empty target, a null id gives an id made from the digest.
    Repeated rows give repeated records. Nothing is written twice after a lost executor: Spark commits whole files.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("uri"), payload.alias("payload"))
    squeezed = rows.mapInArrow(_squeeze, "id long, response binary, revisit binary")
    plan = revisit_plan(pages.withColumn(page_id, F.col(page_id).cast("long")), page_id, payload)
    # Rows without an id have no partner; the second key spreads them.
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("response"), F.lit(SALTS)) + 1).otherwise(F.lit(0))
    chosen = squeezed.withColumn("spread", spread).join(plan.withColumn("none", F.lit(0).cast("long")), (F.col("id") == F.col("plan_id")) & (F.col("spread") == F.col("none")), "left")

    def volumes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                refers = batch.column(2)[i].as_py()
                data = batch.column(0)[i].as_py() if refers is None else member(batch.column(1)[i].as_py().replace(b"\x00", str(refers).encode()))
                if not parts:
                    parts, size = [member(record("warcinfo", "urn:info:0", b"format: WARC File Format 1.1\r\n", {"Content-Type": "application/warc-fields"}))], 0
                parts.append(data)
                size += len(data)
                if size >= volume_bytes:
                    yield pa.RecordBatch.from_pydict({"value": [b"".join(parts)]})
                    parts = []
        if parts:
            yield pa.RecordBatch.from_pydict({"value": [b"".join(parts)]})

    archives = chosen.select("response", "revisit", "refers_to").mapInArrow(volumes, "value binary")
    # One archive in each file. The writer ends a file with a separator; gzip allows zero bytes behind a member.
    archives.select(F.col("value").cast("string")).write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compressed response of each page and the text of its revisit, with a zero byte for the id it refers to."""
    for batch in batches:
        ids, responses, revisits = batch.column(0).to_pylist(), [], []
        for page, uri, body in zip(ids, batch.column(1).to_pylist(), batch.column(2), strict=True):
            body = body.as_py()
            digest = hashlib.sha256(body).hexdigest()
            name = f"urn:page:{page}" if page is not None else f"urn:sha256:{digest}"
            headers = {"WARC-Date": "1970-01-01T00:00:00Z", "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha256:{digest}", "X-Payload-Length": str(len(body))}
            responses.append(member(record("response", name, body, headers)))
            revisits.append(record("revisit", name, b"", headers | {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}).replace(b"\r\nWARC-Date", b"\r\nWARC-Refers-To: <urn:page:\x00>\r\nWARC-Date"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(responses, pa.binary()), pa.array(revisits, pa.binary())], ["id", "response", "revisit"])


# ---- reading


@dataclass
class Found:
    """A record with where its bytes lie in the archive."""

    start: int
    end: int
    headers: dict[str, str]
    body: bytes


@dataclass
class Salvage:
    """Reads an archive's bytes, compressed or not, and keeps a log of the gaps it had to leave out."""

    data: bytes
    gaps: list[tuple[int, int, str]] = field(default_factory=list)

    def records(self) -> Iterator[Found]:
        at, size = 0, len(self.data)
        while at < size:
            if self.data[at] == 0 or self.data.startswith(b"\r\n", at):  # padding between members or records
                at += 1
                continue
            found, end, reasons = self._at(at)
            yield from found
            if found and end is not None:
                self.gaps += [(at, end, reason) for reason in reasons]
                at = end
                continue
            after = self._search(at + 1)
            self.gaps += [(at, after, reason) for reason in reasons]
            at = after

    def _at(self, at: int) -> tuple[list[Found], int | None, list[str]]:
        """The valid records of the member or the record at a position, where it ends, and what had to be left out.

        Without an end it is broken off, and the next valid position has to be searched for.
        """
        if self.data.startswith(MAGIC, at):
            return self._member(at)
        if _VERSION_LINE.match(self.data, at):
            one, reason = _parse(self.data, at)
            return ([one], one.end, []) if one else ([], None, [f"record: {reason}"])
        return [], None, ["neither a member nor a version line"]

    def _member(self, at: int) -> tuple[list[Found], int | None, list[str]]:
        """Records of a member, those before and behind damage inside it too; of one that breaks off, what came out before."""
        inflate, parts, end, broken = zlib.decompressobj(31), [], at, ""
        while not inflate.eof and end < len(self.data) and not broken:
            try:
                parts.append(inflate.decompress(self.data[end : end + FEED]))
                end += FEED
            except zlib.error as error:
                broken = f"member: {error}"
                parts = [_until_error(self.data[at : end + FEED])]
        if not broken and not inflate.eof:
            broken = "member: cut off"
        end = None if broken else min(end, len(self.data)) - len(inflate.unused_data)
        text, found, reasons, inner = b"".join(parts), [], [], 0
        while inner < len(text):
            if text.startswith(b"\r\n", inner):
                inner += 2
                continue
            one, reason = _parse(text, inner)
            if one is not None:
                found.append(Found(at, at if end is None else end, one.headers, one.body))
                inner = one.end
                continue
            after = _next_record(text, inner + 1)
            reasons.append(f"record: {reason} (bytes {inner} to {after} of the member's content)")
            inner = after
        if broken:
            # What breaks off is one gap, whatever is missing of its last record.
            return found, None, [r for r in reasons if not r.endswith(f" to {len(text)} of the member's content)")] + [broken]
        if not found and not reasons:
            reasons = ["member: empty"]
        return found, end, reasons

    def _search(self, at: int) -> int:
        """Where the next valid member or record begins; the end if there is none."""
        member_at, line_at = -2, -2
        while True:
            if member_at != -1 and member_at < at:
                member_at = self.data.find(MAGIC, at)
            if line_at != -1 and line_at < at:
                hit = _VERSION_LINE.search(self.data, at)
                line_at = hit.start() if hit else -1
            starts = [x for x in (member_at, line_at) if x >= 0]
            if not starts:
                return len(self.data)
            if self._at(min(starts))[0]:
                return min(starts)
            at = min(starts) + 1


def _until_error(data: bytes) -> bytes:
    """What a broken member gives before it fails: all but its last piece at once, that a few bytes at a time."""
    inflate, last = zlib.decompressobj(31), (len(data) - 1) // FEED * FEED
    parts = [inflate.decompress(data[:last])]
    for i in range(last, len(data), 16):
        try:
            parts.append(inflate.decompress(data[i : i + 16]))
        except zlib.error:
            break
    return b"".join(parts)


def _next_record(text: bytes, at: int) -> int:
    """Where the next valid record begins in decompressed text; its end if there is none."""
    for hit in _VERSION_LINE.finditer(text, at):
        if _parse(text, hit.start())[0] is not None:
            return hit.start()
    return len(text)


def _parse(data: bytes, at: int) -> tuple[Found | None, str]:
    """The record at a position, after checks of version line, headers, length, terminator and digest."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        return None, "no version line"
    head_end = data.find(b"\r\n\r\n", line.end() - 2)
    if head_end < 0:
        return None, "headers cut off"
    headers: dict[str, str] = {}
    for raw in data[line.end() : head_end].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if not colon:
            return None, "bad header line"
        headers[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        return None, "bad or missing header"
    start, end = head_end + 4, head_end + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return None, "no terminator where the length says"
    body = data[start:end]
    digest = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "response" and digest.startswith("sha256:") and hashlib.sha256(body).hexdigest() != digest[7:]:
        return None, "digest differs"
    return Found(at, end + 4, headers, body), ""


def _rows(path: str, data: bytes) -> Iterator[tuple]:
    salvage = Salvage(data)
    for found in salvage.records():
        h = found.headers
        kind = h["warc-type"]
        digest = h.get("warc-payload-digest", "").removeprefix("sha256:") or hashlib.sha256(found.body).hexdigest()
        length = h.get("x-payload-length", "") if kind == "revisit" else ""
        size = int(length) if length.isascii() and length.isdigit() else len(found.body)
        refers = h.get("warc-refers-to")
        yield path, "record", found.start, found.end, None, kind, h["warc-record-id"].strip("<>"), refers.strip("<>") if refers else None, h.get("warc-date"), h.get("warc-target-uri"), digest, size, found.body
    for start, end, reason in salvage.gaps:
        yield path, "gap", start, end, reason, *[None] * 8


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records (kind "record") and quarantined byte ranges (kind "gap") of all archives below a path, see ``SCHEMA``.

    Archives may hold gzip members, plain records or both. An empty archive has neither; one without any valid
    record is one gap. Each archive is read whole by one task, so keep them at the writer's volume size.
    """

    def salvage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, size = [], 0
                for row in _rows(name, data.as_py()):
                    held.append(row if payloads else (*row[:-1], None))
                    size += len(row[-1] or b"")
                    if size > 4 << 20 or len(held) >= 4096:
                        yield _batch(names, held)
                        held, size = [], 0
                if held:
                    yield _batch(names, held)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(salvage, SCHEMA)


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 7, pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def page_records(records: DataFrame) -> DataFrame:
    """Page id, size, digest, type and what it refers to, of the page records read back."""
    number = lambda name: F.regexp_extract(name, r"^urn:page:(-?\d+)$", 1)
    long_or_null = lambda name: F.when(number(name) != "", number(name).cast("long"))
    return records.filter((F.col("kind") == "record") & F.col("record_type").isin("response", "revisit")).select(
        long_or_null("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", long_or_null("refers_to_id").alias("refers_to")
    )
