"""Legacy archives: ARC files of version 1 and 2 parsed by declared lengths and converted to WARC.

An ARC file begins with a version block whose second line names the version; its header lines have
five fields in version 1 and ten in version 2. The parser reads a header line, takes as many bytes
as it declares, and goes on behind them, so nothing inside a body is taken for a header. The WARC
record it becomes gets an identifier made from its payload's digest and what identifies the capture, the
ISO form of the date, a type (response for HTTP answers, resource for anything else, revisit for a payload
that another record holds), and SHA-1 digests of block and payload.

Archives are binary columns on the ARC side (as ``binaryFile`` reads them) and files on the WARC side:
records are written through the text writer, whose line separator is the blank line that ends a WARC
record, and read back whole. Archives are dealt so that a file holds about ``FILE_BYTES``; a record
is never split, so one long record can make a longer file.

Defined results: a null html is an empty payload; null or blank addresses become ``urn:none``. Rows
that share an id stay separate records, and an id is revisited only by other rows. Rows without an
id are archived but never revisited: for equal payloads without any id all are responses. Bytes
that cannot be a record raise an error that names the archive. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch, prepare

FILE_BYTES = 8_000_000
ARC_BYTES = 1_000_000  # an ARC segment is closed once it is longer
END = b"\r\n\r\n"

# The header lines of both ARC versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


@dataclass(frozen=True)
class Record:
    """A parsed ARC record; ``status``, ``checksum`` and ``location`` exist in version 2 alone."""

    url: str
    ip: str
    date: str
    mime: str
    body: bytes
    status: str = "-"
    checksum: str = "-"
    location: str = "-"


def arc_file(name: str, records: list[Record], version: int) -> bytes:
    """An uncompressed ARC file: the version block, then every record."""
    about = f"{version} {0 if version == 1 else 1} ledgerloom\n{FIELDS[version]}\n".encode()
    when, parts, offset = "20000101000000", [], 0
    first = Record(f"filedesc://{name}", "0.0.0.0", when, "text/plain", about, "200")
    for record in [first, *records]:
        fields = [record.url, record.ip, record.date, record.mime]
        if version == 2:
            fields += [record.status, record.checksum, record.location, str(offset), name]
        part = " ".join([*fields, str(len(record.body))]).encode() + b"\n" + record.body + b"\n"
        parts.append(part)
        offset += len(part)
    return b"".join(parts)


def parse_arc(data: bytes, name: str) -> Iterator[Record]:
    """Records behind the version block, by their declared lengths. Gzip members are inflated first."""
    data = inflate(data)
    version, at = None, 0
    while at < len(data):
        if data[at:at + 1] in b"\r\n":  # blank lines between records
            at += 1
            continue
        stop = data.find(b"\n", at)
        fields = data[at:stop if stop >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r").split(" ")
        count = 5 if version is None and len(fields) == 5 else 10 if version is None else len(FIELDS[version].split())
        if stop < 0 or len(fields) != count or not fields[-1].isdigit():
            raise ValueError(f"{name}: no ARC header at byte {at}")
        body = data[stop + 1:stop + 1 + int(fields[-1])]
        if len(body) != int(fields[-1]):
            raise ValueError(f"{name}: the record at byte {at} ends before its declared length")
        at = stop + 1 + len(body)
        if version is None:
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"{name}: unknown ARC version {version}")
            continue
        extra = fields[4:7] if version == 2 else ["-", "-", "-"]
        yield Record(*fields[:4], body, *extra)


def inflate(data: bytes) -> bytes:
    """All gzip members of ``data``, or ``data`` itself where it isn't compressed."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        one = zlib.decompressobj(31)
        parts.append(one.decompress(data) + one.flush())
        data = one.unused_data
    return b"".join(parts) if parts else data


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(body: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers in lower case and the entity of an HTTP answer; None for anything else."""
    if not body.startswith(b"HTTP/"):
        return None
    head, blank, entity = body.partition(END)
    if not blank:
        return None
    lines = head.decode("iso-8859-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, entity


def record_id(sha1: str, key: str | None, url: str, date: str) -> str:
    """The same archived answer gets the same identifier whenever it is converted; a key stands for its address and date."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{sha1} {key}' if key else f'{sha1} {url} {date}')}"


def warc_record(record: Record, revisits: str | None = None) -> bytes:
    """A WARC record without its closing blank line; ``revisits`` is the key of the record it refers to."""
    http = split_http(record.body)
    headers, payload = http if http else ({}, record.body)
    sha1 = digest(payload)
    stamp = datetime.strptime(record.date, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    block = record.body if revisits is None else record.body[:len(record.body) - len(payload)]
    kind = "revisit" if revisits is not None else "response" if http else "resource"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(sha1, headers.get('x-archive-key'), record.url, record.date)}>",
        f"WARC-Date: {stamp}", f"WARC-Target-URI: {record.url}", f"WARC-IP-Address: {record.ip}",
        f"WARC-Payload-Digest: sha1:{sha1}", f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisits is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"WARC-Refers-To: <{record_id(sha1, revisits, '', '')}>", f"X-Refers-To-Key: {revisits}"]
    mime = "application/http; msgtype=response" if http else record.mime
    lines += [f"Content-Type: {mime}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def parse_warc(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields in lower case and block of every record, by its declared length."""
    data, at = inflate(data), 0
    while at < len(data):
        stop = data.find(END, at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{name}: no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = stop + len(END)
        end = start + int(fields["content-length"])
        if data[end:end + len(END)] != END:
            raise ValueError(f"{name}: the record at byte {at} does not end where it declares")
        yield fields, data[start:end]
        at = end + len(END)


def legacy_archives(pages: DataFrame, version: int = 2) -> DataFrame:
    """path and content of ARC archives that hold every row of ``pages`` (key, url, html, revisits).

    Bodies are HTTP answers whose headers carry the row's key and, for the converter, what it revisits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, count = [], 0, 0
        writer = uuid.uuid4().hex

        def close():
            name = f"{writer}-{count:06d}.arc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_file(name, held, version)], pa.binary())], ["path", "content"])

        for batch in batches:
            for key, url, html, revisits in zip(*[batch.column(n).to_pylist() for n in ("key", "url", "html", "revisits")], strict=True):
                lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(html)}"]
                lines += [f"X-Archive-Key: {key}"] if key is not None else []
                lines += [f"X-Archive-Revisits: {revisits}"] if revisits is not None else []
                body = "\r\n".join(lines).encode() + END + html
                address = "".join((url or "").split()) or "urn:none"
                held.append(Record(address, "0.0.0.0", "20200101000000", "text/html", body, "200", hashlib.sha1(html).hexdigest()))
                size += len(body)
                if size > ARC_BYTES:
                    yield close()
                    held, size, count = [], 0, count + 1
        if held:
            yield close()

    return pages.mapInArrow(run, "path string, content binary")


def convert(archives: DataFrame) -> DataFrame:
    """One WARC record (``record``, without its closing blank line) for every record of ARC archives (path, content)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                out = []
                for record in parse_arc(content, path):
                    http = split_http(record.body)
                    out.append(warc_record(record, http[0].get("x-archive-revisits") if http else None))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return archives.mapInArrow(run, "record binary")


def write_warc(records: DataFrame, path: str) -> None:
    """Gzip files of WARC records; each is followed by the blank line that ends it."""
    text = records.select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record's type, key, revisited key, address, id, payload length and payload digest.

    Lengths and digests of responses are taken from the payload itself; revisits have only what they declare.
    """
    schema = ("key bigint, record_type string, refers_to bigint, url string, record_id string, payload_bytes bigint, payload_digest string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = []
                for fields, block in parse_warc(content, name):
                    http = split_http(block)
                    headers, payload = http if http else ({}, block)
                    declared = (int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:"))
                    length, sha1 = declared
                    if fields["warc-type"] != "revisit":
                        length, sha1 = len(payload), digest(payload)
                        if (length, sha1) != declared:
                            raise ValueError(f"{name}: the payload of {fields['warc-record-id']} is not the declared one")
                    key, refers = headers.get("x-archive-key"), fields.get("x-refers-to-key")
                    rows.append((None if key is None else int(key), fields["warc-type"], None if refers is None else int(refers),
                                 fields["warc-target-uri"], fields["warc-record-id"].strip("<>"), length, sha1))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 7
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in schema.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0, version: int = 2) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) below ``path``, or in the shared folder, and read the archives back.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest id is the
    response, and the others revisit it.
    """
    spark = pages.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "warc")
    path = path or f"{scratch.root}/archives"
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("key"), F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("sha1", F.sha1("html"))
    digests = rows.select("key", "sha1", F.octet_length("html").alias("bytes"))
    of_size = digests.where((F.col("bytes") >= least_bytes) & F.col("key").isNotNull())
    newest = of_size.groupBy("sha1").agg(F.max("key").alias("revisits"), F.count("*").alias("n")).where("n > 1").drop("n")
    newest = scratch.save(newest, "newest")
    revisits = of_size.join(newest, "sha1").where("key < revisits").select("key", "sha1", "revisits").distinct()
    size = digests.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    # The deal into files is also the join's: payloads are shuffled once.
    dealt = rows.repartition(max(1, -(-size // FILE_BYTES)), "key", "sha1")
    marked = dealt.join(revisits, ["key", "sha1"], "left").select("key", "url", "html", "revisits")
    write_warc(convert(legacy_archives(marked, version)), path)
    return read_warc(spark, path)
