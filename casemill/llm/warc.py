"""Legacy archive converter: ARC files to WARC files.

`convert` reads ARC archives of either version.  The archive's first record
names the version and the field list; each further record has one header line
with those fields, then as many bytes as the line declares.  For every record
it synthesises what a WARC record needs: an identifier (a name-based UUID of
archive and offset), the timestamp in ISO form, the type (by the URL's scheme
and the content) and SHA-1 digests of block and payload.

`with_revisits` marks records whose payload another record holds, and
`write_warc` writes gzip members, one per record, into archive files;
`read_warc` reads such files back.

Defined results: a null url is written as `urn:unknown`; white space and
control characters of a url are percent-encoded, as both header forms need.  A
null html is an empty payload, equal to every other empty payload.  Of records
with the same payload and the same key, the one with the larger identifier is
the response.  A null key sorts below all others.  An ARC record whose
declared length runs past the end of its archive is an error, not a guess.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.common import arrow_batch, raw_text, read_blobs, write_blobs

# -- fixed values of the two formats
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


def digest(raw: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def safe_url(url: str | None) -> str:
    if not url:
        return "urn:unknown"
    return re.sub(r"[\x00-\x20\x7f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]",
                  lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


# -- ARC ---------------------------------------------------------------------

@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    content: bytes


def arc_records(content: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC archive, the version block apart."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    names: list[str] = []
    at = 0
    while at < len(content):
        if content[at : at + 1] == b"\n":  # records are parted by one line feed
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].decode("utf-8", "replace")
        length = int(line.rpartition(" ")[2])
        body = content[end + 1 : end + 1 + length]
        if end < 0 or len(body) < length:
            raise ValueError(f"ARC record at {at} declares {length} bytes, {len(body)} are left")
        if not names:
            version = int(body.split(b" ", 1)[0])
            if not line.startswith("filedesc:") or version not in ARC_FIELDS:
                raise ValueError("an ARC archive begins with a version block of version 1 or 2")
            listed = body.split(b"\n")[1].decode().split()
            names = listed or ARC_FIELDS[version].split()
        else:
            values = line.rsplit(" ", len(names) - 1)  # only the url, in front, may hold spaces
            yield ArcRecord(at, dict(zip(names, values, strict=True)), body)
        at = end + 1 + length


def arc_archive(name: str, version: int, records: list[tuple[str, str, str, bytes]]) -> bytes:
    """An ARC archive of (url, 14-digit date, media type, content) records."""
    text = f"{version} 0 export\n{ARC_FIELDS[version]}\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 20200101000000 text/plain{extra} {len(text)}\n".encode(), text, b"\n"]
    at = sum(map(len, out))
    for url, date, kind, content in records:
        middle = f" 200 {digest(content)} - {at} {name}" if version == 2 else ""
        line = f"{url} 0.0.0.0 {date} {kind}{middle} {len(content)}\n".encode()
        out += [line, content, b"\n"]
        at += len(line) + len(content) + 1
    return b"".join(out)


def export_arc(pages: DataFrame, key_header: str = "X-Page-Id", archive_bytes: int = 4 << 20) -> DataFrame:
    """`(path, content)`: `pages` (`page_id`, `url`, `html`) as ARC archives of
    about `archive_bytes`, of versions 1 and 2 in turn.  Each record is an HTTP
    response whose body is the html; the page's id travels as a header."""

    def export(batches):
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        records: list[tuple[str, str, str, bytes]] = []

        def archive():
            name = f"export-{part:06d}-{seq:06d}.arc"
            return arrow_batch([(name, arc_archive(name, 1 + seq % 2, records))], ARCHIVE)

        for batch in batches:
            for i, url, html in zip(*batch.columns, strict=True):
                body = html.as_py() or b""
                key = "" if i.as_py() is None else f"{key_header}: {i.as_py()}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{key}Content-Length: {len(body)}\r\n\r\n"
                records.append((safe_url(url.as_py()), "20200101000000", "text/html", head.encode() + body))
                size += len(body)
                if size >= archive_bytes:
                    yield archive()
                    records, size, seq = [], 0, seq + 1
        if records:
            yield archive()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), raw_text("html"))
    return rows.mapInArrow(export, "path string, content binary")


ARCHIVE = pa.schema([("path", pa.string()), ("content", pa.binary())])


# -- conversion --------------------------------------------------------------

CONVERTED = pa.schema([
    ("rec_id", pa.string()), ("key", pa.int64()), ("uri", pa.string()), ("date", pa.string()), ("http_head", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("member", pa.binary())])


def iso_date(arc_date: str) -> str:
    d = (arc_date + "00000101000000"[len(arc_date):])[:14] if arc_date.isdigit() else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def gzip_member(raw: bytes) -> bytes:
    """A gzip member that ends in a zero byte: the last byte is the top byte
    of the size, and behind 16 MB or more an empty member is put."""
    pack = lambda b: gzip.compress(b, compresslevel=6, mtime=0)
    made = pack(raw)
    return made if made[-1] == 0 else made + pack(b"")


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"".join((b"WARC/1.1\r\n", head.encode(), f"Content-Length: {len(block)}\r\n\r\n".encode(), block, CRLF, CRLF))


def split_http(block: bytes) -> tuple[bytes, bytes]:
    head, sep, body = block.partition(CRLF + CRLF)
    return head + sep, body


def header_value(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m else None


def convert(archives: DataFrame, key_header: str = "X-Page-Id", members: bool = True) -> DataFrame:
    """WARC material of every record of the ARC `archives` (`path`,
    `content`).  `key` is the whole number in the HTTP header `key_header`;
    `member` the packed record (null unless `members`)."""

    def run(batches):
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                path, rows = path.as_py(), []
                for r in arc_records(content.as_py()):
                    rows.append(one(path, r))
                    if len(rows) == 64:
                        yield arrow_batch(rows, CONVERTED)
                        rows = []
                yield arrow_batch(rows, CONVERTED)

    def one(path: str, r: ArcRecord) -> tuple:
        uri, date = r.fields["URL"], iso_date(r.fields["Archive-date"])
        rec_id = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{path}#{r.offset}')}>"
        http = r.content.startswith(b"HTTP/")
        head, body = split_http(r.content) if http else (b"", r.content)
        hashed = digest(body)
        kind = "application/http; msgtype=response" if http else "text/dns" if uri.startswith("dns:") else r.fields["Content-type"]
        member = None
        if members:
            member = gzip_member(warc_record([
                ("WARC-Type", "response" if http else "resource"), ("WARC-Record-ID", rec_id), ("WARC-Date", date),
                ("WARC-Target-URI", uri), ("WARC-IP-Address", r.fields["IP-address"]), ("Content-Type", kind),
                ("WARC-Block-Digest", "sha1:" + digest(r.content)), ("WARC-Payload-Digest", "sha1:" + hashed)], r.content))
        key = header_value(head, key_header)
        return rec_id, int(key) if key else None, uri, date, head, len(body), hashed, member

    return archives.select("path", "content").mapInArrow(
        run, "rec_id string, key long, uri string, date string, http_head binary, payload_bytes long, payload_digest string, member binary")


def with_revisits(records: DataFrame, slim: DataFrame, min_bytes: int = 0, salts: int = 16) -> DataFrame:
    """`records` with `first`: null for a response, else the record (`key`,
    `rec_id`, `uri`, `date`) that it revisits: of those with the same payload
    of at least `min_bytes`, the one with the largest key.

    `slim` holds the same records without their members; groups are found on
    it, reduced before they are shuffled.  Only payloads held twice or more go
    into the join, each once per salt, so a payload that a third of all
    records hold is spread over `salts` times as many keys.
    """
    who = F.struct("key", "rec_id", "uri", "date")
    groups = (slim.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
              .agg(F.max(who).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = records.withColumn("salt", F.pmod(F.xxhash64("rec_id"), F.lit(salts)).cast("int"))
    out = salted.join(groups, ["payload_digest", "salt"], "left")
    own = F.col("first.rec_id") == F.col("rec_id")
    large = F.col("payload_bytes") >= min_bytes
    return out.withColumn("first", F.when(large & ~own, F.col("first"))).drop("salt")


BLOB = pa.schema([("blob", pa.binary())])
# extension headers of a revisit: the response's key, the dropped payload's size
KEY_OF_FIRST, SIZE_OF_PAYLOAD = "X-Refers-To-Key", "X-Payload-Length"


def write_warc(records: DataFrame, path: str, archive_bytes: int = 16 << 20) -> None:
    """Write the records of `with_revisits` below `path`: one gzip member per
    record, archive files of about `archive_bytes`, each begun by a `warcinfo`
    record.  A revisit keeps its HTTP headers and drops the payload."""

    def run(batches):
        part, seq, size, held = TaskContext.get().partitionId(), 0, 0, []

        def archive():
            name = f"records-{part:06d}-{seq:06d}.warc.gz"
            text = f"format: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
            info = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"),
                                ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Filename", name),
                                ("Content-Type", "application/warc-fields")], text)
            return arrow_batch([(b"".join([gzip_member(info), *held]),)], BLOB)

        for batch in batches:
            for member, *rest in zip(*batch.columns, strict=True):
                raw = member.as_py()
                if raw is None:
                    raw = revisit(*(x.as_py() for x in rest))
                held.append(raw)
                size += len(raw)
                if size >= archive_bytes:
                    yield archive()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield archive()

    def revisit(rec_id, uri, date, head, size, hashed, first):
        key = [] if first["key"] is None else [(KEY_OF_FIRST, str(first["key"]))]
        return gzip_member(warc_record([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", rec_id), ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", first["rec_id"]), ("WARC-Refers-To-Target-URI", first["uri"]),
            ("WARC-Refers-To-Date", first["date"]), *key, (SIZE_OF_PAYLOAD, str(size)), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Block-Digest", "sha1:" + digest(head)), ("WARC-Payload-Digest", "sha1:" + hashed)], head))

    cols = records.select(F.when(F.col("first").isNull(), F.col("member")).alias("member"),
                          "rec_id", "uri", "date", "http_head", "payload_bytes", "payload_digest", "first")
    write_blobs(cols.mapInArrow(run, "blob binary"), path)


READ = pa.schema([
    ("record_type", pa.string()), ("rec_id", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("key", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string())])


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a stream."""
    while line := stream.readline():
        if line in (CRLF, b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record begins with its version")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (CRLF, b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def read_warc(spark: SparkSession, path: str, key_header: str = "X-Page-Id") -> DataFrame:
    """Every response, resource and revisit record of the archives below
    `path`.  Size and digest of a response are taken from its payload and
    checked against its headers; a revisit has the declared ones."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in warc_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    if h["warc-type"] in ("response", "resource", "revisit"):
                        rows.append(one(h, block))
                yield arrow_batch(rows, READ)

    def one(h, block):
        revisit = h["warc-type"] == "revisit"
        head, body = split_http(block) if block.startswith(b"HTTP/") else (b"", block)
        declared = h["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and digest(body) != declared:
            raise ValueError(f"{h['warc-record-id']}: the payload does not match its digest")
        size = int(h[SIZE_OF_PAYLOAD.lower()]) if revisit else len(body)
        key, first = header_value(head, key_header), h.get(KEY_OF_FIRST.lower())
        return (h["warc-type"], h["warc-record-id"], h["warc-target-uri"], h["warc-date"], int(key) if key else None,
                size, declared, int(first) if first else None, h.get("warc-refers-to"))

    return read_blobs(spark, path).select("content").mapInArrow(
        run, "record_type string, rec_id string, uri string, date string, key long, payload_bytes long, "
             "payload_digest string, refers_to long, refers_to_id string")


def convert_to_files(archives: DataFrame, path: str, key_header: str = "X-Page-Id", min_bytes: int = 0) -> None:
    """Convert ARC `archives` and write WARC files below `path`."""
    slim = convert(archives, key_header, members=False).drop("http_head", "member")
    write_warc(with_revisits(convert(archives, key_header), slim, min_bytes), path)
