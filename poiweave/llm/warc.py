"""WARC archives: write pages as segmented, chunked records; read archives and reassemble.

A response larger than ``segment_bytes`` is written as a first record and continuation records, each
naming the first (``WARC-Segment-Origin-ID``), its number, and, on the last, the total length. The HTTP body uses
chunked transfer framing. Records have the fields that WARC/1.1 requires of their type: date (that of writing), target address, content
type, and the profile of revisits. Each record is a gzip member of its own, so a reader can start at any of them. Reading parses each archive by content lengths, groups segments by their origin,
orders them by number, checks numbers and total length, and decodes the chunks.

Archives are files of bounded size; a record's segments meet in one row, as its payload did in the
source table. Revisit records carry no payload; reading takes its length and digest from the response they refer
to. A payload that fills a third of the pages is merged in each task, then by salt, then once.

Defined cases: null html is empty; null ids get records with an id of their own and never serve as
the response of others; repeated rows (one id, one payload) are one record, or, with ``every_row``, a record each, the
first of which serves as the response of others; broken or incomplete records are
returned with ``error`` set and no payload; empty tables give no archive rows.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.shared import new_path, remove, stored

SMALLEST_REVISIT = 100
SEGMENT_BYTES = 4096
CHUNK_BYTES = 1000
ARCHIVE_ROWS = 2000
SALTS = 16
LEVEL = 3
PIECE = 16384
UNDATED = "1970-01-01T00:00:00Z"
# Fixed values of the format.
HTTP = "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = b"\r\n"
RECORDS = (
    "record_id string, type string, target string, refers_to string, payload_digest string, "
    "origin_id string, segment int, total_length long, block binary, error string"
)


def plan_records(pages: DataFrame, salts: int = SALTS) -> DataFrame:
    """Each page with its payload, digest, record type and the page it revisits."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("payload"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(html, 256).alias("payload_digest"),
        F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    large = rows.filter((F.col("payload_bytes") >= SMALLEST_REVISIT) & F.col("page_id").isNotNull())
    salted = large.groupBy("payload_digest", "salt").agg(F.min("page_id").alias("low"), F.count("*").alias("n"))
    firsts = salted.groupBy("payload_digest").agg(F.min("low").alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    by_salt = salted.select("payload_digest", "salt").join(firsts, "payload_digest")
    joined = rows.join(by_salt, ["payload_digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") > F.col("first"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("first"))
    ).drop("first", "salt")


def with_turns(planned: DataFrame) -> DataFrame:
    """The planned rows with ``turn``: 1, 2, ... among rows of one id and payload.

    Only rows that are repeated are brought together, equal ones merged in each task first and dealt anew afterwards.
    """
    own = ["page_id", "payload_digest"]
    repeated = stored(planned.filter("page_id is not null").groupBy(*own).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated")
    if repeated.isEmpty():
        return planned.withColumn("turn", F.lit(1))
    once = planned.join(repeated, own, "left_anti").withColumn("turn", F.lit(1))
    again = planned.join(repeated, own, "left_semi").groupBy(*planned.columns).agg(F.count("*").cast("int").alias("times"))
    before = F.coalesce(F.sum("times").over(Window.partitionBy(*own).orderBy("url").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    turns = again.withColumn("before", before).select(*planned.columns, F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("times"))).alias("turn"))
    return once.unionByName(turns.repartition(F.col("page_id"), F.col("payload_digest"), F.col("turn")))


def _record_id(page: Column, turn: Column | None = None) -> Column:
    own = F.coalesce(page.cast("string"), F.concat(F.lit("none-"), F.expr("uuid()")))
    later = F.lit("") if turn is None else F.when(turn > 1, F.concat(F.lit(":turn-"), turn.cast("string"))).otherwise(F.lit(""))
    return F.concat(F.lit("<urn:page:"), own, F.lit(":"), F.substring("payload_digest", 1, 16), later, F.lit(">"))


def page_id_of(record_id: Column) -> Column:
    """The page id that a record id holds; null for pages without one."""
    return F.regexp_extract(record_id, ":page:(-?[0-9]+):", 1).try_cast("long")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for k in range(0, len(payload), size):
        piece = payload[k : k + size]
        parts += [b"%x" % len(piece), _CRLF, piece, _CRLF]
    return b"".join([*parts, b"0", _CRLF, _CRLF])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if its framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(_CRLF, at)
        if end < 0:
            raise ValueError("chunk without a size line")
        size = int(body[at:end].split(b";")[0].strip() or b"x", 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size : at + size + 2] != _CRLF:
            raise ValueError("chunk of another size")
        parts.append(body[at : at + size])
        at += size + 2


def _one_line(value: str | None) -> str:
    """A header value: line breaks and other controls would end the header, so they are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def _header(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"Content-Length: %d" % len(block)]
    return _CRLF.join(lines) + _CRLF + _CRLF + block + _CRLF + _CRLF


def records_of(row: dict, segment_bytes: int, chunk_bytes: int, date: str = UNDATED) -> list[bytes]:
    """The records of one page."""
    place = [("WARC-Date", date), ("WARC-Target-URI", _one_line(row["url"]))]
    base = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), *place, ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"), ("Content-Type", HTTP)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if row["record_type"] == "revisit":
        return [_header([*base, ("WARC-Profile", PROFILE), ("WARC-Refers-To", row["refers_id"])], http)]
    block = http + chunked(row["payload"].encode(), chunk_bytes)
    if len(block) <= segment_bytes:
        return [_header(base, block)]
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    out = [_header([*base, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        last = len(block) if k == len(parts) else None
        own = row["record_id"][:-1] + f":{k}>"
        out.append(_header([("WARC-Type", "continuation"), ("WARC-Record-ID", own), *place, ("WARC-Segment-Origin-ID", row["record_id"]), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", last)], part))
    return out


def members(record: bytes) -> bytes:
    """The record as one gzip member. The member's last byte, the highest of the record's length, is 0; a record of 16 MiB or more, as an
    address of that length would make, gets its end as a second member for that."""
    parts = [record] if len(record) < 1 << 24 else [record[:-1], record[-1:]]
    return b"".join(gzip.compress(p, LEVEL, mtime=0) for p in parts)


def _encode(segment_bytes: int, chunk_bytes: int, date: str):
    def run(batches):
        for batch in batches:
            found, size = [], 0
            for i in range(batch.num_rows):
                for record in records_of(batch.slice(i, 1).to_pylist()[0], segment_bytes, chunk_bytes, date):
                    found.append(members(record)[:-1])
                    size += len(found[-1])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])
                    found, size = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    return run


def write_archives(
    planned: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, date: str | None = None
) -> None:
    """Write the planned records as archives of bounded size, dated by the time of writing unless ``date`` is given.

    Spark's text writer writes the bytes of a record as they are, and its line separator behind each: the zero that ends a gzip member.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    turn = F.col("turn") if "turn" in planned.columns else None
    ready = planned.select("record_type", "url", "payload", "payload_digest", _record_id(F.col("page_id"), turn).alias("record_id"), F.when(F.col("refers_to").isNotNull(), _record_id(F.col("refers_to"))).alias("refers_id"))
    records = ready.mapInArrow(_encode(segment_bytes, chunk_bytes, date), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", ARCHIVE_ROWS).text(path)


def unzipped(content: bytes) -> tuple[bytes, bool]:
    """The members of a gzip file joined, and whether the last one is whole. Bytes are handed on a piece at a time, as what a
    member leaves over is copied."""
    view, at, out = memoryview(content), 0, []
    while at < len(view):
        reader = zlib.decompressobj(31)
        try:
            while not reader.eof and at < len(view):
                piece = view[at : at + PIECE]
                out.append(reader.decompress(piece))
                at += len(piece) - len(reader.unused_data)
        except zlib.error:
            return b"".join(out), False
        if not reader.eof:
            return b"".join(out), False
    return b"".join(out), True


def parse_archive(content: bytes):
    """Records of an archive, plain or gzip, as rows of ``RECORDS``; what a broken gzip member leaves out is an error."""
    whole = True
    if content[:2] == b"\x1f\x8b":
        content, whole = unzipped(content)
    yield from _records(content)
    if not whole:
        yield (None, None, None, None, None, None, None, None, None, "archive cut short")


def _records(content: bytes):
    at = 0
    while at < len(content):
        head_end = content.find(_CRLF + _CRLF, at)
        if not content.startswith(b"WARC/", at) or head_end < 0:
            yield (None, None, None, None, None, None, None, None, None, f"no record at byte {at}")
            return
        fields = {}
        for line in content[at:head_end].split(_CRLF)[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size, start = fields.get("content-length", ""), head_end + 4
        if not size.isdigit() or start + int(size) > len(content):
            yield (fields.get("warc-record-id"), fields.get("warc-type"), None, None, None, None, None, None, None, "record cut short")
            return
        end = start + int(size)
        number, total = fields.get("warc-segment-number", ""), fields.get("warc-segment-total-length", "")
        yield (
            fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
            fields.get("warc-payload-digest"), fields.get("warc-segment-origin-id", fields.get("warc-record-id")),
            int(number) if number.isdigit() else None, int(total) if total.isdigit() else None, content[start:end], None,
        )
        at = end
        while content.startswith(_CRLF, at):
            at += 2


def _parse(batches):
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary(), pa.string()]
    for batch in batches:
        for content in ar.column(batch, "content"):
            rows, size = [], 0
            for row in parse_archive(content.as_py() or b""):
                rows.append(row)
                size += len(row[8] or b"")
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, segments as they are."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(_parse, RECORDS)


def _decode(batches):
    for batch in batches:
        payloads, digests, errors = [], [], []
        for kind, block, error in zip(*(ar.column(batch, n).to_pylist() for n in ("type", "block", "error"))):
            payload = None
            if error is None and kind != "revisit":  # a revisit has no payload
                try:
                    head, found, body = (block or b"").partition(_CRLF + _CRLF)
                    if not found:
                        raise ValueError("no HTTP header")
                    fields = [x.lower().replace(b" ", b"") for x in head.split(_CRLF)]
                    payload = unchunked(body) if b"transfer-encoding:chunked" in fields else body
                except ValueError as e:
                    error = str(e)
            payloads.append(payload)
            digests.append(None if payload is None else hashlib.sha256(payload).hexdigest())
            errors.append(error)
        keep = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] in ("record_id", "type", "target", "refers_to", "declared_digest")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(payloads, pa.binary()), pa.array(digests, pa.string()), pa.array(errors, pa.string())], ["record_id", "type", "target", "refers_to", "declared_digest", "payload", "payload_digest", "error"])


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record: segments grouped by origin, ordered, verified, joined and decoded."""
    segments = F.array_sort(F.collect_set(F.struct("segment", "block")))
    grouped = records.filter("origin_id is not null and segment is not null").groupBy("origin_id").agg(
        segments.alias("parts"),
        F.max("total_length").alias("total"),
        *(F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c) for c in ("type", "target", "refers_to", "payload_digest")),
        F.max("error").alias("error"),
    )
    block = F.unhex(F.array_join(F.transform("parts.block", F.hex), ""))
    joined = grouped.select(
        F.col("origin_id").alias("record_id"), "type", "target", "refers_to", F.col("payload_digest").alias("declared_digest"), block.alias("block"),
        F.coalesce(
            F.col("error"),
            F.when(F.col("type").isNull(), "continuation without its first record"),
            F.when(F.col("parts.segment") != F.sequence(F.lit(1), F.size("parts")), "segment missing or repeated"),
            F.when((F.size("parts") > 1) & F.col("total").isNull(), "last segment missing"),
        ).alias("error"), "total",
    ).withColumn("error", F.coalesce("error", F.when(F.octet_length("block") != F.col("total"), "total length differs"))).drop("total")
    # Records in one piece stay in their task.
    whole = records.filter("origin_id is not null and segment is null").select(
        "record_id", "type", "target", "refers_to", F.col("payload_digest").alias("declared_digest"), "block",
        F.coalesce("error", F.when(F.col("type") == "continuation", "continuation without a number")).alias("error"),
    )
    out = whole.unionByName(joined).mapInArrow(_decode, "record_id string, type string, target string, refers_to string, declared_digest string, payload binary, payload_digest string, error string")
    lost = records.filter("origin_id is null").select("record_id", "type", "target", "refers_to", F.lit(None).cast("string").alias("declared_digest"), F.lit(None).cast("binary").alias("payload"), F.lit(None).cast("string").alias("payload_digest"), "error")
    return out.unionByName(lost)


def resolved(whole: DataFrame) -> DataFrame:
    """Reassembled records with the length and digest of the full payload, revisits through their response."""
    measured = stored(whole.withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload"), "records")
    measured = measured.filter("record_id is not null").dropDuplicates(["record_id"]).unionByName(measured.filter("record_id is null"))
    responses = measured.filter("type <> 'revisit'").select(F.col("record_id").alias("_of"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    revisits = measured.filter("type = 'revisit'").drop("payload_bytes", "payload_digest").join(responses, F.col("refers_to") == F.col("_of"), "left")
    differs = F.when(F.concat(F.lit("sha256:"), F.col("_digest")) != F.col("declared_digest"), "digest of the response differs")
    revisits = revisits.withColumn("error", F.coalesce("error", F.when(F.col("_of").isNull(), "response missing"), differs))
    done = revisits.withColumnsRenamed({"_bytes": "payload_bytes", "_digest": "payload_digest"}).drop("_of")
    checked = F.when(F.concat(F.lit("sha256:"), F.col("payload_digest")) != F.col("declared_digest"), "payload digest differs")
    return measured.filter("type <> 'revisit' or type is null").withColumn("error", F.coalesce("error", checked)).unionByName(done)


def round_trip(spark: SparkSession, pages: DataFrame, every_row: bool = False) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back; with ``every_row`` one record per row."""
    path = new_path(spark, "warc")
    planned = plan_records(pages)
    write_archives(with_turns(planned) if every_row else planned, path)
    done = resolved(reassemble(read_records(spark, path)))
    remove(spark, path)  # what the records hold is stored by now
    return done
