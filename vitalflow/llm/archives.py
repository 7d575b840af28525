"""Legacy web archives to WARC.

ARC files are read by the version that their first record declares: it names the fields of the header
lines, and each header line's last field is the length of what follows. Every record becomes a WARC
record with the identifier, time, type and digests that the old format had no place for. Payloads that
occur before are written as revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalflow.llm.common import make_folder, read_files, settings, text_of, write_file
from vitalflow.session import staged

# fixed values: header fields of the two versions, and names in WARC files
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length",
    ),
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Namespace of identifiers made from a record's place in its archive.
PLACES = uuid.UUID("6f1b8a50-2c1d-5e0a-9c55-0d7f3b1e4a21")
#: An archive is closed with the record that brings it to so many bytes.
ARCHIVE_BYTES = 8 << 20


@dataclass
class Record:
    """A record of either format: header fields by name, and the content they declare."""

    fields: dict[str, str]
    content: bytes
    offset: int = 0
    headers: dict[str, str] = field(default_factory=dict)


def read_arc(data: bytes) -> Iterator[Record]:
    """The records of an ARC file; the first is the file's own description.

    Content is taken by its declared length, so it may hold anything. A header line with spaces in
    its URL is read from the right. A file that breaks off ends with what is there.
    """
    line, at = _line(data, 0)
    parts = line.split(" ")
    if not line.startswith("filedesc://") or not parts[-1].isdigit():
        raise ValueError("not an ARC file")
    body = data[at : at + int(parts[-1])]
    version = int(body.split(b" ", 1)[0] or b"0")
    if version not in FIELDS:
        raise ValueError(f"ARC version {version} is not known")
    names = FIELDS[version]
    yield Record(_named(line, names), body, 0)
    at += int(parts[-1])
    while True:
        while at < len(data) and data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        start = at
        line, at = _line(data, at)
        values = _named(line, names)
        size = int(values["Archive-length"])
        yield Record(values, data[at : at + size], start)
        at += size


def _line(data: bytes, at: int) -> tuple[str, int]:
    end = data.find(b"\n", at)
    end = len(data) if end < 0 else end
    return data[at:end].decode("utf-8", "replace").rstrip("\r"), end + 1


def _named(line: str, names: tuple[str, ...]) -> dict[str, str]:
    parts = line.rsplit(" ", len(names) - 1)
    if len(parts) != len(names) or not parts[-1].isdigit():
        raise ValueError(f"not an ARC header line: {line[:200]!r}")
    return dict(zip(names, parts, strict=True))


def write_arc(name: str, records: list[tuple[str, str, str, bytes]], version: int = 1) -> bytes:
    """An ARC file of records (URL, date, content type, content)."""
    about = f"{version} 0 vitalflow\n{' '.join(FIELDS[version])}\n\n".encode()

    def header(url: str, date: str, kind: str, size: int, offset: int) -> bytes:
        more = f"200 - - {offset} {name} " if version == 2 else ""
        return f"{url} 0.0.0.0 {date} {kind} {more}{size}\n".encode()

    out = [header(f"filedesc://{name}", "20240101000000", "text/plain", len(about), 0), about]
    size = len(out[0]) + len(about)
    for url, date, kind, content in records:
        head = b"\n" + header(url, date, kind, len(content), size + 1)
        out += [head, content]
        size += len(head) + len(content)
    return b"".join(out)


def warc_date(date: str) -> str:
    """The 14 digits of an ARC date as a WARC time; missing digits count as the earliest."""
    digits = re.sub(r"\D", "", date)[:14]
    full = digits + "00000101000000"[len(digits) :] if len(digits) >= 4 else "19700101000000"
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload_of(content: bytes) -> tuple[bytes, bytes]:
    """(HTTP header, body) of a response, else nothing and all of it."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    for end in (b"\r\n\r\n", b"\n\n"):
        at = content.find(end)
        if at >= 0:
            return content[: at + len(end)], content[at + len(end) :]
    return content, b""


def to_warc(
    record: Record, archive: str, extra: Mapping[str, str], revisit: Mapping[str, str] | None
) -> Record:
    """The WARC record of an ARC record.

    The archive's description becomes `warcinfo`, HTTP responses `response`, all else `resource`.
    With `revisit` (the headers that name the earlier record) the body is left out.
    """
    url = record.fields["URL"]
    about = url.startswith("filedesc://")
    http, body = payload_of(record.content)
    kind = "warcinfo" if about else "response" if http else "resource"
    block = record.content
    headers = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(PLACES, f'{archive}#{record.offset}')}>",
        "WARC-Date": warc_date(record.fields["Archive-date"]),
    }
    if about:
        headers["WARC-Filename"] = archive
        content_type = "text/plain"
    else:
        headers["WARC-Target-URI"] = url
        if record.fields["IP-address"] not in ("", "-", "0.0.0.0"):
            headers["WARC-IP-Address"] = record.fields["IP-address"]
        headers["WARC-Payload-Digest"] = f"sha1:{sha1_base32(body)}"
        headers["X-Payload-Length"] = str(len(body))
        content_type = "application/http; msgtype=response" if http else record.fields["Content-type"]
    if revisit is not None and not about:
        headers["WARC-Type"] = "revisit"
        headers["WARC-Profile"] = SAME_PAYLOAD
        headers["WARC-Truncated"] = "length"
        headers |= revisit
        block = http
    headers |= extra
    headers["WARC-Block-Digest"] = f"sha1:{sha1_base32(block)}"
    headers["Content-Type"] = content_type
    headers["Content-Length"] = str(len(block))
    return Record({}, block, 0, headers)


def warc_bytes(record: Record, level: int = 1) -> bytes:
    """The record as a gzip member of its own."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in record.headers.items())
    head = f"WARC/1.0\r\n{lines}\r\n".encode()
    return gzip.compress(b"".join([head, record.content, b"\r\n\r\n"]), compresslevel=level, mtime=0)


def convert(
    data: bytes,
    archive: str,
    more: Callable[[int], tuple[Mapping[str, str], Mapping[str, str] | None]] = lambda i: ({}, None),
) -> bytes:
    """A gzip WARC file of an ARC file's bytes (gzip or plain).

    `more` gives, for the i-th record after the description, further headers and, where its payload
    is kept elsewhere, the headers of a revisit.
    """
    if data[:2] == b"\x1f\x8b":
        data = unzipped(data)
    out = io.BytesIO()
    for i, record in enumerate(read_arc(data)):
        extra, revisit = more(i - 1) if i else ({}, None)
        out.write(warc_bytes(to_warc(record, archive, extra, revisit)))
    return out.getvalue()


def read_warc(data: bytes) -> Iterator[Record]:
    """The records of a WARC file, plain or in gzip members."""
    yield from _plain_warc(unzipped(data) if data[:2] == b"\x1f\x8b" else data)


def unzipped(data: bytes) -> bytes:
    """All members of a gzip file, in a time that grows with its size; `gzip.decompress` copies the
    rest of the file for each of them."""
    with gzip.GzipFile(fileobj=io.BytesIO(data)) as members:
        return members.read()


def _plain_warc(raw: bytes) -> Iterator[Record]:
    at = 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        if end < 0 or not raw.startswith(b"WARC/", at):
            raise ValueError("not a WARC record")
        lines = raw[at:end].decode("utf-8").split("\r\n")[1:]
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        yield Record({}, raw[end + 4 : end + 4 + size], at, headers)
        at = end + 4 + size + 4


def page_urn(page_id: int) -> str:
    """An identifier that holds the page's number (a UUID of version 8)."""
    bits = page_id & 0xFFFFFFFFFFFFFFFF
    return f"<urn:uuid:{uuid.UUID(int=(bits >> 16) << 80 | 8 << 76 | 2 << 62 | (bits & 0xFFFF))}>"


def page_of_urn(urn: str) -> int:
    value = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    bits = (value >> 80) << 16 | (value & 0xFFFF)
    return bits - (1 << 64) if bits >> 63 else bits


def _arc_url(url: str | None, page_id: int | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "") or f"urn:page:{page_id}"


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    markup: str = "html",
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archive every page: laid down as ARC (both versions in turn), converted, written as WARC.

    Of pages with equal payloads of at least `least_bytes` bytes, that with the largest id becomes
    a response and the others revisits of it; rows that repeat the id are responses too. Null markup
    is an empty payload. A null id is smaller than any: its rows are revisits where an id is known,
    else responses. One row per file: `path`, `records`. An empty table writes none.

    Payloads meet by digest and length only, combined per task, so a payload that most pages share
    is no large group; the join with the pages is left to Spark, which splits skewed keys.
    """
    known = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(markup).alias("html")
    )
    size = F.octet_length("html").cast("bigint")
    keyed = known.select("*", F.sha1(F.encode("html", "UTF-8")).alias("sha1"), size.alias("size"))
    last = staged(
        keyed.select("sha1", "size", "page_id").groupBy("sha1", "size").agg(F.max("page_id").alias("keeper")),
        "archive-keepers",
    )
    rows = keyed.join(last, ["sha1", "size"]).select("page_id", "url", "html", "keeper", "size")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        records: list[tuple[str, str, str, bytes]] = []
        marks: list[tuple[int | None, int | None]] = []
        held = 0

        def close() -> pa.RecordBatch:
            name = f"pages-{part:06d}-{number:06d}"
            arc = write_arc(f"{name}.arc", records, 1 + number % 2)

            def more(i: int) -> tuple[dict[str, str], dict[str, str] | None]:
                own, keeper = marks[i]
                extra = {} if own is None else {"WARC-Record-ID": page_urn(own)}
                return extra, None if keeper is None else {"WARC-Refers-To": page_urn(keeper)}

            path = write_file(folder, f"{name}.warc.gz", convert(arc, f"{name}.arc", more))
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(records)]})

        for batch in batches:
            ids, urls, keepers, sizes = (batch.column(k).to_pylist() for k in (0, 1, 3, 4))
            for row in range(batch.num_rows):
                body = batch.column(2)[row].as_py().encode("utf-8", "surrogatepass")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                content = head.encode() + body
                own, keeper = ids[row], keepers[row]
                revisits = keeper is not None and keeper != own and sizes[row] >= least_bytes
                records.append((_arc_url(urls[row], own), "20240101000000", "text/html", content))
                marks.append((own, keeper if revisits else None))
                held += len(content)
                if held >= archive_bytes:
                    yield close()
                    records, marks, held, number = [], [], 0, number + 1
        if records:
            yield close()

    make_folder(folder)
    # small batches: a page may be long
    with settings(pages.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="200"):
        return staged(rows.mapInArrow(work, "path string, records long"), "archives")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) out of the archives.

    A response's payload is measured and digested anew and held against its headers; a revisit has
    both from the headers. Descriptions are passed over.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                found = [row for r in read_warc(content.as_py()) if (row := _told(r))]
                if found:
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # few files at once: each is a row of some megabytes
    with settings(files.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="2"):
        return staged(read_files(files, "path", folder).mapInArrow(work, fields), "archive-records")


def _told(record: Record) -> tuple | None:
    h = record.headers
    if h["WARC-Type"] == "warcinfo":
        return None
    size, digest = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
    if h["WARC-Type"] != "revisit":
        body = payload_of(record.content)[1]
        if (len(body), sha1_base32(body)) != (size, digest):
            raise ValueError(f"a payload does not match its digest: {h['WARC-Record-ID']}")
    urn = h["WARC-Record-ID"]
    own = page_of_urn(urn) if uuid.UUID(urn[10:-1]).version == 8 else None
    refers = page_of_urn(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None
    return own, h["WARC-Target-URI"], size, digest, h["WARC-Type"], refers
