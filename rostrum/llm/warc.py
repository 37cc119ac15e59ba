"""ARC to WARC conversion.

Legacy ARC files open with a ``filedesc`` record whose body names the version;
version 1 record lines have five fields, version 2 lines ten, and both end in
the record's length.  ``parse_arc`` reads them by version and declared length;
``convert`` synthesises what WARC asks for: record identifiers (a UUID hashed
from file and offset), ISO timestamps, types (of records with equal payloads
of at least ``min_bytes`` bytes the one with the largest page id is the
response and the others revisit it) and SHA-1 digests.

Archives are written and read by Spark's own readers and writers, so they may
be in any store that Spark reaches: a row of the text writer is one archive of
about ``SEGMENT_BYTES`` and a file of its own, gzip-compressed; a task holds one
archive at a time.  Page ids travel in an HTTP header.

Null html is an empty payload, a null or blank url becomes ``-``, other
characters than URLs may have are percent-encoded, a null page id is left out
and read back as null (and is the smallest).  Bytes that are no record are
reported as rows of kind ``damage``, not dropped in silence: ``read_arc`` has
them among its rows, ``convert`` returns them.  A packed file may be one gzip
member or many; it is unpacked in parts, and a cut or damaged member is damage
of its own.  Other columns of the pages are not read.  An empty table gives no
archive and no row."""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.common import column_lists

SEGMENT_BYTES = 8 << 20
#: Pages carry no fetch time or address; archives of theirs get these.
FETCHED = "20200101000000"
ADDRESS = "0.0.0.0"
_URL_SAFE = "!#$%&'()*+,/:;=?@[]~-._"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: names that are URLs
_CRLF = b"\r\n"
#: Field names of the ARC versions, as the format states them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------------- ARC


def arc_record(version: int, url: str, body: bytes, name: str, offset: int, kind: str = "text/html",
               date: str = FETCHED, address: str = ADDRESS) -> bytes:
    fields = [url, address, date, kind]
    if version == 2:
        fields += ["200", hashlib.md5(body).hexdigest(), "-", str(offset), name]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_opening(version: int, name: str) -> bytes:
    body = f"{version} 0 rostrum\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(1, f"filedesc://{name}", body, name, 0, "text/plain") if version == 1 else \
        f"filedesc://{name} {ADDRESS} {FETCHED} text/plain 200 - - 0 {name} {len(body)}\n".encode() + body + b"\n"


def http_body(page_id: int | None, payload: bytes) -> bytes:
    own = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(payload)) + own + _CRLF + payload


class ArcParser:
    """Records of an ARC file handed over in parts: url, address, date, kind,
    status, offset (in the unpacked file), body; spans that are no record come
    as {"damage": bytes, "offset": ...}.  Holds no more than the record at hand."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.size, self.need, self.base = 0, 1, 0
        self.version, self.bad = 1, None

    def feed(self, data: bytes) -> Iterator[dict]:
        self.parts.append(data)
        self.size += len(data)
        if self.size >= self.need:
            yield from self._parse(False)

    def cut(self) -> Iterator[dict]:
        """The rest, where the file or an undamaged stretch of it ends."""
        yield from self._parse(True)

    def _damage(self, end: int) -> Iterator[dict]:
        if self.bad is not None:
            yield {"damage": self.base + end - self.bad, "offset": self.bad}
            self.bad = None

    def _parse(self, last: bool) -> Iterator[dict]:
        data, at = b"".join(self.parts), 0
        n, self.need = len(data), 1
        while at < n:
            end = data.find(b"\n", at)
            if end < 0 and not last:
                self.need = 2 * (n - at)
                break
            end = n if end < 0 else end
            line = data[at:end].decode("utf-8", "replace").rstrip("\r")
            if not line:
                at = end + 1
                continue
            opening = line.startswith("filedesc://")
            width = len(ARC_FIELDS[self.version].split())
            fields = line.rsplit(" ", 4 if opening and line.count(" ") < 9 else (9 if opening else width - 1))
            size = int(fields[-1]) if len(fields) in (5, 10) and re.fullmatch("[0-9]+", fields[-1]) else -1
            sound = size >= 0 and re.fullmatch(r"\d{12,14}", fields[2])
            if sound and end + 1 + size > n and not last:
                self.need = end + 1 + size - at
                break
            if not sound or end + 1 + size > n:
                self.bad = self.base + at if self.bad is None else self.bad
                at = min(end + 1, n)
                continue
            yield from self._damage(at)
            body = data[end + 1 : end + 1 + size]
            if opening:
                mark = body[:1]
                self.version = int(mark) if mark in (b"1", b"2") else 1
            else:
                yield {"url": fields[0], "address": fields[1], "date": fields[2], "kind": fields[3],
                       "status": fields[4] if self.version == 2 else None, "offset": self.base + at, "body": body}
            at = end + 1 + size
        at = min(at, n)
        if last:
            yield from self._damage(n)
        self.parts, self.size, self.base = [data[at:]], n - at, self.base + at


_MAGIC = b"\x1f\x8b\x08"
_PART = 1 << 20


def unpacked(content: bytes) -> Iterator[bytes | int]:
    """The bytes of a file in parts: as they are, or those of all gzip members
    (a file may be one member or one for each record).  A number stands for so
    many packed bytes that are no whole member: a cut or damaged one, or
    anything between members but zeros."""
    if content[:2] != _MAGIC[:2]:
        yield from (content[k : k + _PART] for k in range(0, len(content), _PART))
        return
    at = 0
    while at < len(content):
        member, fed, out = zlib.decompressobj(31), at, b""
        try:
            while not member.eof and (out or fed < len(content) or member.unconsumed_tail):
                take = member.unconsumed_tail or content[fed : fed + _PART]
                fed += 0 if member.unconsumed_tail else len(take)
                if out := member.decompress(take, _PART):
                    yield out
        except zlib.error:
            pass
        if member.eof:
            at = fed - len(member.unused_data)
            continue
        following = content.find(_MAGIC, at + 2)
        following = len(content) if following < 0 else following
        if content[at:following].strip(b"\0"):
            yield following - at
        at = following


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records and damage of an ARC file, packed or not (see ``ArcParser``).
    Damage of a packed file has the number of packed bytes lost at its place."""
    parser = ArcParser()
    for part in unpacked(content):
        if isinstance(part, bytes):
            yield from parser.feed(part)
        else:
            yield from parser.cut()
            yield {"damage": part, "offset": parser.base}
    yield from parser.cut()


def _archives(parts: Iterator[bytes], opening, joint: bytes) -> Iterator[pa.RecordBatch]:
    """Records to archives of about SEGMENT_BYTES, one text row each; ``joint``
    is what the writer's line end completes the last record with."""
    held, size = [], 0

    def out():
        data = b"".join([opening(), *held])
        return pa.RecordBatch.from_arrays([pa.array([data[: len(data) - len(joint)]], pa.binary()).cast(pa.string(), safe=False)], ["value"])  # any bytes: Spark's text writer copies them

    for p in parts:
        held.append(p)
        size += len(p)
        if size >= SEGMENT_BYTES:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _write(rows: DataFrame, folder: str, line_end: str) -> None:
    rows.write.option("maxRecordsPerFile", 1).option("lineSep", line_end).option("compression", "gzip").text(folder)


def write_arc(pages: DataFrame, folder: str) -> None:
    """ARC files of (page_id, url, html) rows; tasks take turns in the versions."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        state = {"n": 0, "offset": 0}

        def name():
            return f"pages-{task:06d}-{state['n']:04d}.arc"

        def version():
            return 1 + (task + state["n"]) % 2

        def opening():
            head = arc_opening(version(), name())
            state.update(n=state["n"] + 1, offset=0)
            return head

        def records():
            for _, ids, urls, html in column_lists(batches, "page_id", "url", "html"):
                for i, u, h in zip(ids, urls, html):
                    url = urllib.parse.quote((u or "").strip(), safe=_URL_SAFE) or "-"
                    r = arc_record(version(), url, http_body(i, (h or "").encode()), name(), state["offset"])
                    state["offset"] += len(r)
                    yield r

        return _archives(records(), opening, b"\n")

    _write(pages.select("page_id", "url", "html").mapInArrow(run, "value string"), folder, "\n")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def _contents(batches) -> Iterator[tuple[str, bytes]]:
    for _, paths, contents in column_lists(batches, "path", "content"):
        for path, content in zip(paths, contents):
            yield path.rsplit("/", 1)[-1], content


def _whole(name: str, content: bytes) -> bytes:
    parts = list(unpacked(content))
    if not all(isinstance(p, bytes) for p in parts):
        raise ValueError(f"damaged gzip member in {name}")
    return b"".join(parts)


def _rows(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], sized: int | None = None, most: int = 4 << 20):
    """Arrow batches of at most about ``most`` bytes in the column ``sized``."""

    def out(held):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 200 + (len(r[sized] or b"") if sized is not None else 0)
        if size >= most:
            yield out(held)
            held, size = [], 0
    if held:
        yield out(held)


_PAGE_ID = re.compile(rb"(?im)^X-Page-Id:\s*(-?\d+)\s*$")
_LENGTH = re.compile(rb"(?im)^Content-Length:\s*(\d+)\s*$")


def _split_http(body: bytes) -> tuple[bytes, bytes]:
    cut = body.find(b"\r\n\r\n")
    return (body[: cut + 4], body[cut + 4 :]) if body.startswith(b"HTTP/") and cut >= 0 else (b"", body)


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the ARC files: file, offset, url, date, address, page_id, head
    (HTTP headers), payload, digest; damage: bytes that are no record."""
    names = ["file", "offset", "url", "date", "address", "page_id", "head", "digest", "damage", "payload"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.binary()]

    def records(batches):
        for name, content in _contents(batches):
            for r in parse_arc(content):
                if "damage" in r:
                    yield (name, r["offset"], None, None, None, None, None, None, r["damage"], None)
                    continue
                head, payload = _split_http(r["body"])
                own = _PAGE_ID.search(head)
                yield (name, r["offset"], r["url"], r["date"], r["address"], int(own[1]) if own else None, head,
                       sha1_base32(payload), None, payload)

    return _files(spark, folder).mapInArrow(
        lambda b: _rows(records(b), names, kinds, sized=9),
        "file string, offset long, url string, date string, address string, page_id long, head binary, digest string, "
        "damage long, payload binary")


# ------------------------------------------------------------------------ WARC


def record_id(file: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{file}#{offset}')}>"


def iso_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + _CRLF + block + _CRLF + _CRLF


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of every record, by declared length."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == _CRLF:
            at += 2
            continue
        cut = data.index(b"\r\n\r\n", at)
        lines = data[at:cut].decode().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        size = int(fields["content-length"])
        block = data[cut + 4 : cut + 4 + size]
        if not lines[0].startswith("WARC/") or len(block) != size:
            raise ValueError(f"no WARC record at byte {at}")
        yield fields, block
        at = cut + 4 + size + 4


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, min_bytes: int = 0) -> DataFrame:
    """WARC files of all records in the ARC files; returns the spans that are no
    record (file, offset, bytes), read when asked for.  Payloads shuffle once, on
    their digest, with what each digest's response is; that table has a row
    for each payload."""
    found = read_arc(spark, arc_folder)
    records = found.where("damage is null")
    best = records.where(F.length("payload") >= min_bytes).groupBy(F.col("digest").alias("_digest")).agg(
        F.max(F.struct("page_id", "file", "offset", "url", "date")).alias("best"))
    rows = records.join(best, (F.col("digest") == F.col("_digest")) & (F.length("payload") >= min_bytes), "left").drop("_digest")
    same = (F.col("best.file") == F.col("file")) & (F.col("best.offset") == F.col("offset"))
    rows = rows.withColumn("revisit", F.col("best").isNotNull() & ~F.coalesce(same, F.lit(False)))
    rows = rows.select("file", "offset", "url", "date", "address", "head", "digest", "revisit", F.col("best.file").alias("r_file"),
                       F.col("best.offset").alias("r_offset"), F.col("best.url").alias("r_url"), F.col("best.date").alias("r_date"),
                       F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload")).alias("payload"))

    def run(batches):
        def opening():
            block = b"software: rostrum\r\nformat: WARC File Format 1.1\r\ndescription: converted from ARC\r\n"
            fields = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", iso_date(FETCHED)), ("Content-Type", "application/warc-fields")]
            return warc_record("warcinfo", fields, block)

        def records():
            for b in batches:
                for r in b.to_pylist():
                    fields = [("WARC-Record-ID", record_id(r["file"], r["offset"])), ("WARC-Date", iso_date(r["date"])),
                              ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["address"]),
                              ("WARC-Payload-Digest", f"sha1:{r['digest']}"),
                              ("Content-Type", "application/http;msgtype=response" if r["head"] else "application/octet-stream")]
                    if r["revisit"]:
                        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                   ("WARC-Refers-To", record_id(r["r_file"], r["r_offset"])),
                                   ("WARC-Refers-To-Target-URI", r["r_url"]), ("WARC-Refers-To-Date", iso_date(r["r_date"]))]
                    kind = "revisit" if r["revisit"] else "response" if r["head"] else "resource"
                    yield warc_record(kind, fields, r["head"] + r["payload"])

        return _archives(records(), opening, _CRLF + _CRLF)

    _write(rows.mapInArrow(run, "value string"), warc_folder, "\r\n\r\n")
    return found.where("damage is not null").select("file", "offset", F.col("damage").alias("bytes"))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the WARC files but warcinfo: record_id, record_type, url, date,
    page_id, payload_bytes and payload_digest (of the full payload: computed
    where the record has it, as declared where it is a revisit), refers_to_id.
    A block or payload that does not match its digest ends the read."""
    names = ["record_id", "record_type", "url", "date", "page_id", "payload_bytes", "payload_digest", "refers_to_id"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def records(batches):
        for name, content in _contents(batches):
            for fields, block in parse_warc(_whole(name, content)):
                if fields["warc-type"] == "warcinfo":
                    continue
                head, payload = _split_http(block)
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                revisit = fields["warc-type"] == "revisit"
                if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}" or not revisit and digest != sha1_base32(payload):
                    raise ValueError(f"digest mismatch in {name}: {fields['warc-record-id']}")
                own, size = _PAGE_ID.search(head), _LENGTH.search(head)
                yield (fields["warc-record-id"], fields["warc-type"], fields["warc-target-uri"], fields["warc-date"],
                       int(own[1]) if own else None, int(size[1]) if revisit and size else len(payload), digest,
                       fields.get("warc-refers-to"))

    return _files(spark, folder).mapInArrow(
        lambda b: _rows(records(b), names, kinds),
        "record_id string, record_type string, url string, date string, page_id long, payload_bytes long, "
        "payload_digest string, refers_to_id string")


def archive_pages(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, to WARC files, and back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, record_id."""
    spark = pages.sparkSession
    write_arc(pages, f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc", min_bytes)
    rows = read_warc(spark, f"{folder}/warc").checkpoint()
    target = rows.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"))
    return rows.join(target, F.col("refers_to_id") == F.col("_id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id")
