"""Legacy web archives: write ARC files, convert them to WARC, read WARC files.

ARC 1 and ARC 2 differ in the header line of a record (five fields, or ten with status, checksum and
place); the version block that opens a file says which one follows. Both give the length of a
record, which is what it is cut by: payloads may hold anything, header lines included.

Spark's text writer stores the archives: with the record separator as line separator its output is
an archive byte for byte. Files are gzipped as a whole and of bounded size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.tables import Stage
from tributary.llm.tokens import chunks

#: Bytes of payload in an archive file, about.
FILE_BYTES = 8 << 20
#: Crawl time, address and separators of the archives; the fields of a header line are fixed values.
CRAWLED, ADDRESS = "20240101000000", "0.0.0.0"
ARC_END, WARC_END = "\n", "\r\n\r\n"
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _arc_line(version: int, url: str, kind: str, content: bytes, status: str, name: str, at: int) -> bytes:
    head = [url, ADDRESS, CRAWLED, kind]
    if version == 2:
        head += [status, "-", "-", str(at), name]
    return " ".join([*head, str(len(content))]).encode() + b"\n" + content


def _version_block(version: int, name: str) -> bytes:
    content = f"{version} 0 tributary\n{' '.join(FIELDS[version])}\n".encode()
    return _arc_line(version, f"filedesc://{name}", "text/plain", content, "200", name, 0)


def _escaped(url: str | None) -> str:
    """A URL as one field of a header line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or "-"


def _arc_rows(file_bytes: int):
    schema = pa.schema([("archive", pa.string()), ("seq", pa.int64()), ("record", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, files, size, seq, name = TaskContext.get().partitionId(), 0, file_bytes, 0, ""
        for batch in batches:
            ids, urls, pages = (batch.column(k) for k in range(3))
            pages = pages.fill_null("")
            for first, end, _, _ in chunks(pages):
                rows = []
                for page_id, url, html in zip(
                    ids.slice(first, end - first).to_pylist(), urls.slice(first, end - first).to_pylist(), pages.slice(first, end - first).cast(pa.binary()).to_pylist()
                ):
                    if size >= file_bytes:
                        name, version = f"{task:06d}-{files:06d}", 1 + (task + files) % 2
                        files, size = files + 1, 0
                        rows.append((name, seq, _version_block(version, name)))
                        seq += 1
                    shown = "-" if page_id is None else str(page_id)
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: {shown}\r\nContent-Length: {len(html)}\r\n\r\n"
                    record = _arc_line(version, _escaped(url), "text/html", head.encode() + html, "200", name, size)
                    rows.append((name, seq, record))
                    seq, size = seq + 1, size + len(record)
                names, places, records = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(places, pa.int64()), pa.array(records, pa.binary()).cast(pa.string(), safe=False)], schema=schema
                )

    return run


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = FILE_BYTES) -> None:
    """Pages as ARC files of about ``file_bytes``, version 1 and 2 in turn. Null html is an empty payload."""
    source = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    rows = source.mapInArrow(_arc_rows(file_bytes), "archive string, seq long, record string")
    _write_text(rows.sortWithinPartitions("archive", "seq").select("archive", "record"), path, ARC_END, partition="archive")


def _write_text(df: DataFrame, path: str, end: str, partition: str | None = None, records: int = 0) -> None:
    writer = df.write.mode("overwrite").option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", records)
    (writer.partitionBy(partition) if partition else writer).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files; an archive without records has no file."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")
    )


def arc_records(data: bytes) -> Iterator[dict]:
    """Records of one ARC file, version blocks included, by their header lines and declared lengths."""
    at, fields = 0, FIELDS[1]
    while at < len(data):
        if data[at : at + 1] == b"\n":  # separates records
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode().split(" ")
        if line[0].startswith("filedesc://"):
            content = data[end + 1 : end + 1 + int(line[-1])]
            fields = FIELDS[int(content.split(b" ", 1)[0])]
        if len(line) != len(fields):
            raise ValueError(f"ARC header with {len(line)} fields, {len(fields)} expected, at byte {at}")
        record = dict(zip(fields, line))
        length = int(record["Archive-length"])
        record["content"] = data[end + 1 : end + 1 + length]
        if len(record["content"]) != length:
            raise ValueError(f"ARC record cut short at byte {at}")
        yield record
        at = end + 1 + length


_CONVERTED = (
    "page_id long, record_id string, warc_type string, url string, date string, ip string, content_type string,"
    " digest string, head binary, payload binary, payload_bytes long"
)


def _number(head: bytes, name: bytes) -> int | None:
    """A numeric field of a block of header lines."""
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.lower() == name and value.strip().lstrip(b"-").isdigit():
            return int(value)
    return None


def _converted(record: dict) -> dict:
    """What a WARC record needs of an ARC record: type, id, time, digest."""
    url, day, content = record["URL"], record["Archive-date"], record["content"]
    head, cut, payload = content.partition(b"\r\n\r\n")
    if url.startswith("filedesc://"):
        kind, form, head, payload = "warcinfo", "application/warc-fields", b"", content
    elif content.startswith(b"HTTP/") and cut:
        kind, form, head = "response", "application/http;msgtype=response", head + cut
    else:
        kind, form, head, payload = "resource", record["Content-type"], b"", content
    page_id = _number(head, b"x-page-id")
    digest = sha1_base32(payload)
    return {
        "page_id": page_id, "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {day} {page_id} {digest}')}>",
        "warc_type": kind, "url": url, "date": f"{day[:4]}-{day[4:6]}-{day[6:8]}T{day[8:10]}:{day[10:12]}:{day[12:14]}Z",
        "ip": record["IP-address"], "content_type": form, "digest": digest, "head": head, "payload": payload, "payload_bytes": len(payload),
    }


def _batched(parse, names: list[str], schema: pa.Schema):
    """Parse the files of a task one at a time; batches of a few megabytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse(gzip.decompress(content.as_py())))
                for k in range(0, len(rows), 512):
                    some = rows[k : k + 512]
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in some], schema.field(n).type) for n in names], schema=schema)

    return run


_ARC_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("record_id", pa.string()), ("warc_type", pa.string()), ("url", pa.string()), ("date", pa.string()), ("ip", pa.string()),
     ("content_type", pa.string()), ("digest", pa.string()), ("head", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]
)


def read_arc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records of all ARC files below ``path`` with what their WARC records need."""
    names = columns or _ARC_SCHEMA.names
    schema = pa.schema([_ARC_SCHEMA.field(n) for n in names])
    kinds = dict(pair.strip().split(" ") for pair in _CONVERTED.split(","))

    def parse(data: bytes) -> Iterator[dict]:
        return map(_converted, arc_records(data))

    return _files(spark, path).mapInArrow(_batched(parse, names, schema), ", ".join(f"{n} {kinds[n]}" for n in names))


def arc_to_warc(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0) -> None:
    """Convert ARC files to WARC 1.0 files.

    Of responses with equal payloads of at least ``least_bytes``, that with the largest page id keeps
    the payload; the others become revisits that name it. Copies with that same id keep theirs too,
    and so do all copies of a payload of which no page has an id; other pages without one count as
    smallest. Version blocks become warcinfo, other content without an HTTP head becomes resource.
    """
    stage = Stage(spark)
    seen = stage.table(read_arc(spark, arc, ["page_id", "record_id", "warc_type", "digest", "payload_bytes"]), "seen")
    owner = F.max(F.struct("page_id", "record_id"))
    owners = (
        seen.where((F.col("warc_type") == "response") & (F.col("payload_bytes") >= least_bytes))
        .groupBy("digest", "payload_bytes").agg(F.count("*").alias("copies"), owner.alias("owner"))
    )
    owners = stage.table(owners.where("copies > 1 and owner.page_id is not null"), "owners")
    named = owners.select("digest", F.col("owner.page_id").alias("owner_page"), F.col("owner.record_id").alias("owner_record"))
    records = read_arc(spark, arc).join(named, "digest", "left")
    again = (F.col("warc_type") == "response") & F.col("owner_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner_page")) & (F.col("payload_bytes") >= least_bytes)
    again = F.coalesce(again, F.lit(False))
    head, payload = (F.col(c).cast("string") for c in ("head", "payload"))
    block = F.concat(head, F.when(again, F.lit("")).otherwise(payload))
    fields = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.col("warc_type"))),
        F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-IP-Address: "), "ip"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), "owner_record")),
        F.when(again, F.concat(F.lit("X-Refers-To-Page: "), F.col("owner_page").cast("string"))),
        F.concat(F.lit("Content-Type: "), "content_type"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"), block)
    mean = seen.agg(F.avg("payload_bytes")).first()[0] or 1
    _write_text(records.select(record), warc, WARC_END, records=max(1, int(FILE_BYTES / max(1, mean))))


def warc_records(data: bytes) -> Iterator[dict]:
    """Records of one WARC file. Payload and digest are checked against each other."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:cut].decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        field = dict(line.split(": ", 1) for line in lines)
        block = data[cut + 4 : cut + 4 + int(field["Content-Length"])]
        at = cut + 4 + len(block) + 4
        head, sep, payload = block.partition(b"\r\n\r\n") if "application/http" in field["Content-Type"] else (b"", b"", block)
        kind, digest = field["WARC-Type"], field["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind != "revisit" and sha1_base32(payload) != digest:
            raise ValueError(f"payload of {field['WARC-Record-ID']} does not match its digest")
        length = _number(head, b"content-length") if kind == "revisit" else len(payload)
        refers = field.get("X-Refers-To-Page")
        yield {
            "page_id": _number(head, b"x-page-id"), "payload_bytes": length, "payload_digest": digest, "record_type": kind,
            "refers_to": int(refers) if refers else None, "record_id": field["WARC-Record-ID"], "url": field["WARC-Target-URI"],
            "date": field["WARC-Date"], "payload": payload,
        }


_WARC_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("payload", pa.binary())]
)
_WARC_SQL = {"page_id": "long", "payload_bytes": "long", "refers_to": "long", "payload": "binary"}


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records of all WARC files below ``path``."""
    names = columns or _WARC_SCHEMA.names
    schema = pa.schema([_WARC_SCHEMA.field(n) for n in names])
    return _files(spark, path).mapInArrow(_batched(warc_records, names, schema), ", ".join(f"{n} {_WARC_SQL.get(n, 'string')}" for n in names))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages through ARC and WARC and back: a row per page with its record's digest, type and owner.

    Null html is an empty payload, a null URL is ``-``. An empty table gives an empty result. Other
    columns are not carried along.
    """
    spark = pages.sparkSession
    stage = Stage(spark)
    write_arc(pages, stage.path("arc"), id_col, url_col, html_col)
    arc_to_warc(spark, stage.path("arc"), stage.path("warc"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    read = read_warc(spark, stage.path("warc"), columns).where(F.col("record_type").isin("response", "revisit"))
    return read.withColumnRenamed("page_id", id_col)
