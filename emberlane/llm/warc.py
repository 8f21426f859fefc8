"""WARC writing, and a reader that salvages what is left of damaged archives.

The writer makes archives of gzip members, one record each, at most about
ARCHIVE_BYTES of payload before the next archive begins. Of records with equal
payloads of at least MIN_REVISIT bytes, that with the smallest page_id is a
response and the others are revisits without a payload; smaller payloads are
always responses.

The reader checks every record (gzip checksum, header lines, length, digest of a
response's payload, end marks). After a failed check it goes on where the record's
own length says that the next one begins, if one does or the end marks are there,
so that no record is taken out of a damaged one's payload; else it searches for the
next place from which a whole valid record can be read, a gzip member or a plain
version line. It logs the bytes between as quarantined with the reason. Bytes are
skipped only into that log, which comes from the same pass as the records. Of a
gzip member with a fault all other records are read, from what can be unpacked (at
most MEMBER_BYTES; what would go beyond is a fault); the log has the member's range
and the bytes of its content. Where its checksum or data are wrong, only records
whose payload digest holds are read. Where an archive has a spare copy, records
of quarantined ranges are read from those ranges of the spare.

Defined cases: a null html is an empty payload; a null page_id is written
without an id and read as null, and is a revisit only of a page with an id;
repeated rows of the smallest page_id are all responses; an empty table gives
no archive; null content has no records; other columns are left out, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.llm.common import heavy_join, map_arrow, materialize

MIN_REVISIT = 100
ARCHIVE_BYTES = 1 << 20
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
MEMBER_BYTES = 1 << 30  # of a member's content that are unpacked
PIECE = 4096  # bytes of a faulty member unpacked at a time
LINE = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
DATE = "2024-01-01T00:00:00Z"  # of every record, so that reruns give equal bytes


class Fault(ValueError):
    """What is wrong with a record, and where the next one begins if its length can be trusted."""

    def __init__(self, why: str, resume: int | None = None):
        super().__init__(why)
        self.resume = resume


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record. The headers of a revisit hold its payload's length and digest."""
    revisit = refers_to is not None
    uri = re.sub(r"[\s\x00-\x1f]", "%20", url or "")
    lines = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    lines += [f"WARC-Record-ID: <urn:page:{page_id}>"] if page_id is not None else []
    lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []
    body = b"" if revisit else payload
    return "\r\n".join([*lines, f"Content-Length: {len(body)}"]).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parsed(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Header fields, body and end of the record at a place of plain bytes; Fault says what is wrong."""
    if data[at : at + 5] != b"WARC/":
        raise Fault("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Fault("headers do not end")
    fields, bad = {}, ""
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            bad = "malformed header line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        raise Fault(bad or "no length")
    begin = head_end + 4
    end = begin + int(fields["content-length"])
    closed = data[end : end + 4] == b"\r\n\r\n"
    resume = end + 4 if closed or end + 4 == len(data) or (end + 4 < len(data) and START.match(data, end + 4)) else None
    if bad or not closed:
        raise Fault(bad or "record does not end where its length says", resume)
    body, digest = data[begin:end], fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and digest.startswith("sha256:") and hashlib.sha256(body).hexdigest() != digest[7:]:
        raise Fault("payload digest differs", resume)
    return fields, body, end + 4


CUT_OFF = "gzip: member is cut off"


def unpacked(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What can be unpacked of the gzip member at a place, where that ends, and the fault if any."""
    rest, z = memoryview(data)[at:], zlib.decompressobj(31)
    try:
        plain = z.decompress(rest, MEMBER_BYTES)
        if z.unconsumed_tail:
            return plain, len(data) - len(z.unconsumed_tail), "gzip: member unpacks to too many bytes"
        return plain, len(data) - len(z.unused_data), "" if z.eof else CUT_OFF
    except zlib.error as e:
        fault = f"gzip: {e}"
    z, out, i, step = zlib.decompressobj(31), [], 0, PIECE
    while True:  # up to the byte at which it fails
        before = z.copy()
        try:
            out.append(z.decompress(rest[i : i + step], MEMBER_BYTES))
            i += step
        except zlib.error:
            if step == 1:
                # of the last eight bytes, the checksum comes before the length
                return b"".join(out), min(at + i + (5 if "data check" in fault else 1), len(data)), fault
            z, step = before, 1


def inside(plain: bytes, sure: bool) -> list[tuple]:
    """('record', fields, body) and ('gap', start, end, reason) of a member's content."""
    out, i, gap, reason = [], 0, None, ""
    while i < len(plain):
        try:
            fields, body, end = parsed(plain, i)
            if not sure and not (fields.get("warc-type") == "response" and fields.get("warc-payload-digest", "").startswith("sha256:")):
                raise Fault("no checksum holds", end)
        except Fault as e:
            if gap is None:
                gap, reason = i, str(e)
            if e.resume is not None:
                i = e.resume
            else:
                m = LINE.search(plain, i + 1)
                i = m.start() if m else len(plain)
            continue
        if gap is not None:
            out.append(("gap", gap, i, reason))
            gap = None
        out.append(("record", fields, body))
        i = end
    return out if gap is None else [*out, ("gap", gap, len(plain), reason)]


def one(data: bytes, at: int) -> tuple[list[tuple], int, str]:
    """What inside() finds in the gzip member at a place, or the plain record there,
    its end, and the member's fault; Fault if there is no record."""
    if data[at : at + 3] != MEMBER:
        fields, body, end = parsed(data, at)
        return [("record", fields, body)], end, ""
    plain, end, fault = unpacked(data, at)
    found = inside(plain, fault in ("", CUT_OFF))
    if not any(x[0] == "record" for x in found):
        raise Fault(fault or (found[0][3] if found else "empty member"), end if not fault or START.match(data, end) else None)
    return found, end, fault


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """('record', start, end, (fields, body)) and ('gap', start, end, reason), in order, over all bytes."""

    def told(found: list[tuple], a: int, z: int) -> Iterator[tuple[str, int, int, object]]:
        for x in found:
            yield (x[0], a, z, x[1:]) if x[0] == "record" else ("gap", a, z, f"{x[3]} (bytes {x[1]} to {x[2]} of the member's content)")

    def closed(z: int) -> Iterator[tuple[str, int, int, object]]:
        """The gap up to z, with what was found in the faulty member it begins with."""
        stop = min(held_end, z) if held else gap
        yield from told(held, gap, stop)
        yield "gap", stop if stop < z else gap, z, reason

    at, gap, reason, held, held_end = 0, None, "", [], 0
    while at < len(data):
        try:
            found, end, fault = one(data, at)
            resume = end if START.match(data, end) else None
        except Fault as e:
            found, fault, resume = [], str(e), e.resume
        if fault and gap is not None and not found:
            pass
        else:
            if gap is not None:
                yield from closed(at)
                gap, held = None, []
            if fault:
                gap, reason, held = at, fault, found
                held_end = end if found else at
        if fault:
            if resume is None:
                m = START.search(data, at + 1)
                resume = m.start() if m else len(data)
            at = resume
            continue
        yield from told(found, at, end)
        at = end
    if gap is not None:
        yield from closed(len(data))


def mended(data: bytes, spare: bytes | None) -> Iterator[tuple[str, int, int, object]]:
    """As salvage(), with the records of quarantined ranges from the spare copy. The log stays."""
    told = list(salvage(data))
    if spare is not None:
        lost: list[list[int]] = []
        for _, a, z, _ in sorted(x[:3] + (None,) for x in told if x[0] == "gap"):
            if lost and a <= lost[-1][1]:
                lost[-1][1] = max(z, lost[-1][1])
            else:
                lost.append([a, z])
        told = [x for x in told if x[0] == "gap" or not any(a <= x[1] and x[2] <= z for a, z in lost)]
        for a, z in lost:
            told += [("record", a + x, a + y, what) for kind, x, y, what in salvage(spare[a:z]) if kind == "record"]
    yield from told


def _page(field: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
    return int(m[1]) if m else None


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and refers_to: the page whose payload this one repeats.
    Digests alone are grouped and told their first page, a common one by heavy_join();
    a text moves once, to its own id and digest, and small ones do not move."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    large = F.octet_length("html") >= MIN_REVISIT
    keyed = rows.where(large).withColumn("digest", F.sha2("html", 256))
    narrow = materialize(keyed.select("page_id", "digest"), "warc-digests")
    first = materialize(narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"), "warc-first")
    revisits = heavy_join(narrow, first, "digest", "n", narrow.count()).where(~F.col("first").eqNullSafe(F.col("page_id"))).distinct()
    told = revisits.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), F.col("first").alias("refers_to"))
    met = keyed.join(told, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left").select("page_id", "url", "html", "refers_to")
    return met.unionByName(rows.where(~large).withColumn("refers_to", F.lit(None).cast("long")))


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []
    size = 0

    def archive() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["content"])

    for b in batches:
        for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in b.columns]):
            payload = html.encode()
            held.append(member(record(page_id, url, payload, hashlib.sha256(payload).hexdigest(), refers_to)))
            size += len(payload)
            if size >= ARCHIVE_BYTES:
                yield archive()
                held, size = [], 0
    if held:
        yield archive()


def archives(pages: DataFrame) -> DataFrame:
    """One row per archive: its bytes in content."""
    return map_arrow(marked(pages), _write, "content binary")


def open_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive files from any store that Spark reads, one row each."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def damaged(content: DataFrame, one_in: int = 4) -> DataFrame:
    """content and spare: of one archive in one_in, by its digest, three bytes are
    flipped and the sound copy is kept as spare. What the query reads back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, spares = [], []
            for data in b.column("content").to_pylist():
                digest = hashlib.sha256(data).digest()
                hit = bool(data) and digest[0] % one_in == 0
                broken = bytearray(data)
                for k in range(3 if hit else 0):
                    broken[int.from_bytes(digest[4 * k + 1 : 4 * k + 5], "big") % len(data)] ^= 0xFF
                out.append(bytes(broken))
                spares.append(data if hit else None)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(spares, pa.binary())], ["content", "spare"])

    return map_arrow(content.select("content"), run, "content binary, spare binary")


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
SALVAGED = f"path string, start long, end long, reason string, {RECORD}"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in SALVAGED.split(", ")]
    for b in batches:
        for path, data, spare in zip(*(b.column(c) for c in ("path", "content", "spare"))):
            rows = []
            for kind, a, z, what in mended(data.as_py() or b"", spare.as_py()):
                if kind == "gap":
                    rows.append((path.as_py(), a, z, str(what), *[None] * (len(fields) - 4)))
                    continue
                f, body = what
                revisit = f.get("warc-type") == "revisit"
                digest = f.get("warc-payload-digest", "").removeprefix("sha256:") if revisit else hashlib.sha256(body).hexdigest()
                size = int(f.get("x-payload-length") or 0) if revisit else len(body)
                rows.append((path.as_py(), a, z, None, _page(f.get("warc-record-id")), f.get("warc-target-uri"), f.get("warc-type"), size, digest, _page(f.get("warc-refers-to")), body))
            yield pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows) if rows else [()] * len(fields), fields)], [n for n, _ in fields])


def salvaged(content: DataFrame) -> DataFrame:
    """All that is read of archives (content, and if known path and spare), in one
    pass: rows with a reason are quarantined byte ranges, the others records."""
    extra = [F.col(c) if c in content.columns else F.lit(None).cast(t).alias(c) for c, t in (("path", "string"), ("spare", "binary"))]
    return map_arrow(content.select("content", *extra), _read, SALVAGED)


def records(content: DataFrame) -> DataFrame:
    """Every record that can be read, of damaged archives too."""
    return salvaged(content).where("reason is null").select(*[x.split()[0] for x in RECORD.split(", ")])


def quarantined(content: DataFrame) -> DataFrame:
    """The byte ranges of each archive (path, content) that no record came from."""
    return salvaged(content).where("reason is not null").select("path", "start", "end", "reason")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages, damages some of the archives, reads all back, lost records
    from the sound copies, and reports each record."""
    return records(materialize(damaged(archives(pages)), "warc")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
with p as (select page_id, strlen(coalesce(html, ''))::bigint payload_bytes, sha256(coalesce(html, '')) payload_digest from pages),
f as (select payload_digest, min(page_id) first from p where payload_bytes >= {MIN_REVISIT} group by payload_digest)
select page_id, payload_bytes, p.payload_digest, case when first is null or first is not distinct from page_id then 'response' else 'revisit' end record_type,
  case when first is not distinct from page_id then null else first end refers_to
from p left join f on p.payload_digest = f.payload_digest and payload_bytes >= {MIN_REVISIT}"""
