"""Legacy ARC archives converted to WARC (operator 10).

An ARC file begins with a version block whose own header line and lines say which fields
every record's header line has: five in version 1, ten in version 2, the declared length
last. `convert` walks a file by declared lengths and synthesises what WARC needs and ARC
lacks: record identifiers from file and offset, ISO timestamps, record types, block and
payload digests. Records with equal payloads become revisits of the first one. `write`
stores WARC records gzipped through Spark's text writer, whose separator is WARC's end of
a record; `read` parses them by their declared lengths again.

Defined results: a null html is an empty payload; a null url becomes about:blank and
white space in one is percent-encoded; a null page_id goes without its header and sorts
after all others when the first of equal payloads is chosen; repeated rows give a record
each. Empty tables give an empty archive. Other columns are not read. A record cut short
or a header line that does not fit its version is an error that names the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.registry import pick, query, table
from glimmerdex.plans.sizing import keyed_join, scratch_path, written

ARC_BYTES = 4 << 20
ARCS_PER_WARC = 8
DATE = "20240101000000"
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "arc-to-warc")
END = "\r\n\r\n"
RECORD = "record_id string, page_id bigint, uri string, ip string, date string, type string, digest string, payload_bytes bigint, block_digest string, block binary"


class Legacy(NamedTuple):
    """One record of an ARC file."""

    offset: int
    fields: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def inflated(content: bytes) -> bytes:
    """The bytes of a file of any number of gzip members, or of one that is not compressed."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data.lstrip(b"\0")
    return b"".join(out)


# -- ARC ---------------------------------------------------------------------


def arc_file(name: str, records: list[tuple[str, str, str, str, bytes]], version: int = 1) -> bytes:
    """An ARC file of (url, ip, date, content type, block)."""
    about = f"{version} 0 archive\n{FIELDS[version]}\n".encode()

    def line(url: str, ip: str, date: str, kind: str, offset: int, block: bytes) -> bytes:
        middle = "" if version == 1 else f"200 {hashlib.md5(block).hexdigest()} - {offset} {name} "
        return f"{url} {ip} {date} {kind} {middle}{len(block)}\n".encode()

    out = [line(f"filedesc://{name}", "0.0.0.0", DATE, "text/plain", 0, about), about, b"\n"]
    at = sum(map(len, out))
    for url, ip, date, kind, block in records:
        out += [head := line(url, ip, date, kind, at, block), block, b"\n"]
        at += len(head) + len(block) + 1
    return b"".join(out)


def parse_arc(name: str, data: bytes) -> Iterator[Legacy]:
    """The records of an ARC file without its version block."""
    at, names = 0, None
    while at < len(data):
        stop = data.find(b"\n", at)
        if stop == at:  # blank lines between records
            at += 1
            continue
        if stop < 0:
            raise ValueError(f"{name}: header line at {at} does not end")
        values = data[at:stop].decode("utf-8", "replace").rstrip("\r").split(" ")
        expected = names or (FIELDS[1].split(" ") if len(values) == 5 else FIELDS[2].split(" "))
        if len(values) != len(expected) or not values[-1].isdigit():
            raise ValueError(f"{name}: header line at {at} does not fit its version")
        block = data[stop + 1 : stop + 1 + int(values[-1])]
        if len(block) != int(values[-1]):
            raise ValueError(f"{name}: record at {at} is cut short")
        if names is None:
            lines = block.decode("utf-8", "replace").splitlines()
            version = int(lines[0].split(" ")[0])
            names = lines[1].split(" ") if len(lines) > 1 else FIELDS[version].split(" ")
            if version not in FIELDS or len(names) != len(FIELDS[version].split(" ")):
                raise ValueError(f"{name}: unknown version {lines[0]!r}")
        else:
            yield Legacy(at, dict(zip(names, values, strict=True)), block)
        at = stop + 1 + len(block)


def pages_to_arc(pages: DataFrame, version: int = 1) -> DataFrame:
    """(name, content): pages as gzipped ARC files of bounded size, an HTTP response per page."""

    def record(page_id: int | None, url: str | None, html: bytes | None) -> tuple[str, str, str, str, bytes]:
        html = html or b""
        safe = re.sub(r"[\s\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "about:blank"
        head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n"
        head += "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
        return safe, "0.0.0.0", DATE, "text/html", head.encode() + b"\r\n" + html

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, made = TaskContext.get().partitionId(), [], 0, 0

        def packed() -> pa.RecordBatch:
            name = f"{part:06d}-{made:06d}.arc.gz"
            packer = zlib.compressobj(4, zlib.DEFLATED, 31)
            content = packer.compress(arc_file(name, held, version)) + packer.flush()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["name", "content"])

        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(record(page_id, url, html))
                size += len(held[-1][-1])
                if size >= ARC_BYTES:
                    yield packed()
                    held, size, made = [], 0, made + 1
        if held:
            yield packed()

    rows = pick(pages, page_id="page_id", url="url", html="html").withColumn("html", F.col("html").cast("binary"))
    return rows.mapInArrow(run, "name string, content binary")


# -- ARC to WARC -------------------------------------------------------------


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head (with its blank line), header fields in lower case, and payload of an HTTP response."""
    cut = re.search(rb"\r?\n\r?\n", block)
    if not block.startswith(b"HTTP/") or not cut:
        return b"", {}, block
    head = block[: cut.end()]
    fields = dict(line.split(":", 1) for line in head.decode("utf-8", "replace").splitlines()[1:] if ":" in line)
    return head, {k.strip().lower(): v.strip() for k, v in fields.items()}, block[cut.end() :]


def convert(arcs: DataFrame, blocks: bool = True) -> DataFrame:
    """WARC records (RECORD) of ARC files given as (name, content). Without blocks, those are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in RECORD.split(", ")]
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for legacy in parse_arc(name, inflated(content)):
                    head, fields, payload = http_parts(legacy.block)
                    page = fields.get("x-page-id", "")
                    d = legacy.fields["Archive-date"].ljust(14, "0")
                    rows.append(
                        (
                            f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{name}@{legacy.offset}')}",
                            int(page) if re.fullmatch(r"-?\d+", page) else None,
                            legacy.fields["URL"],
                            legacy.fields["IP-address"],
                            f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                            "response" if head else "resource",
                            digest(payload),
                            len(payload),
                            digest(legacy.block),
                            legacy.block if blocks else None,
                        )
                    )
                columns = list(zip(*rows, strict=True)) or [[] for _ in names]
                kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return arcs.select("name", "content").mapInArrow(run, RECORD)


def first_of_equals(index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(digest, payload_bytes, first_id, first_uri, first_date) for payloads of that size that more than one record has."""
    order = F.struct(F.col("page_id").isNull(), "page_id", "record_id", "uri", "date")
    return (
        index.filter((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes))
        .groupBy("digest", "payload_bytes")
        .agg(F.count("*").alias("n"), F.min(order).alias("first"))
        .filter("n > 1")
        .select(
            "digest", "payload_bytes", F.col("first.record_id").alias("first_id"), F.col("first.uri").alias("first_uri"),
            F.col("first.date").alias("first_date"),
        )
    )


def write(arcs: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Convert ARC files to gzipped WARC files in the folder; payloads seen before become revisits."""
    firsts = written(first_of_equals(convert(arcs, blocks=False), least_bytes), "first-records")
    tasks = max(1, arcs.count() // ARCS_PER_WARC)
    records = keyed_join(convert(arcs.repartition(tasks)), firsts, ["digest", "payload_bytes"], "record_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def shown(fields: dict[str, str | None], block: bytes) -> bytes:
            lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items() if v is not None], f"Content-Length: {len(block)}"]
            return "\r\n".join(lines).encode() + END.encode() + block

        about = b"software: arc conversion\r\nformat: WARC File Format 1.1\r\n"
        start = {
            "WARC-Type": "warcinfo",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'warcinfo {part}')}>",
            "WARC-Date": "2024-01-01T00:00:00Z",
            "Content-Type": "application/warc-fields",
        }
        begun = False
        for batch in batches:
            values = [] if begun or not batch.num_rows else [shown(start, about)]
            begun = begun or bool(batch.num_rows)
            for r in batch.to_pylist():
                revisit = r["first_id"] is not None and r["first_id"] != r["record_id"]
                block = http_parts(r["block"])[0] if revisit else r["block"]
                fields = {
                    "WARC-Type": "revisit" if revisit else r["type"],
                    "WARC-Record-ID": f"<{r['record_id']}>",
                    "WARC-Date": r["date"],
                    "WARC-Target-URI": r["uri"],
                    "WARC-IP-Address": r["ip"],
                    "WARC-Payload-Digest": f"sha1:{r['digest']}",
                    "WARC-Block-Digest": f"sha1:{digest(block)}",
                    "WARC-Profile": PROFILE if revisit else None,
                    "WARC-Refers-To": f"<{r['first_id']}>" if revisit else None,
                    "WARC-Refers-To-Target-URI": r["first_uri"] if revisit else None,
                    "WARC-Refers-To-Date": r["first_date"] if revisit else None,
                    "Content-Type": "application/http; msgtype=response" if r["type"] == "response" else "text/html",
                }
                values.append(shown(fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])

    lines = records.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(folder)


# -- WARC --------------------------------------------------------------------


def parse_warc(name: str, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields in lower case and block of every record."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if stop < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"{name}: no record at {at}")
        fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        size = int(fields["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        if len(block) != size or data[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"{name}: record at {at} is cut short")
        yield fields, block
        at = stop + 8 + size


def read(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, type, uri, date, page_id, payload_bytes, digest, refers_id and payload of the response and revisit records.

    The digest of a revisit is that of the full payload; its size and the payload itself are null, see `resolved`."""
    schema = "record_id string, record_type string, uri string, date string, page_id bigint, payload_bytes bigint, payload_digest string, refers_id string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.string()] * 4, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        names = [c.split(" ")[0] for c in schema.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for fields, block in parse_warc(path, inflated(content)):
                    if fields["warc-type"] == "warcinfo":
                        continue
                    revisit = fields["warc-type"] == "revisit"
                    _, http, payload = http_parts(block)
                    page = http.get("x-page-id", "")
                    rows.append(
                        (
                            fields["warc-record-id"].strip("<>"),
                            fields["warc-type"],
                            fields.get("warc-target-uri"),
                            fields.get("warc-date"),
                            int(page) if re.fullmatch(r"-?\d+", page) else None,
                            None if revisit else len(payload),
                            fields["warc-payload-digest"].removeprefix("sha1:") if revisit else digest(payload),
                            fields["warc-refers-to"].strip("<>") if revisit else None,
                            None if revisit else payload,
                        )
                    )
                columns = list(zip(*rows, strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("path", "content").mapInArrow(run, schema)


def resolved(records: DataFrame) -> DataFrame:
    """Adds refers_to, the page_id of the response that a revisit refers to, and gives the revisit that payload's size."""
    revisits = records.filter("refers_id is not null").drop("payload_bytes")
    asked = revisits.select(F.col("refers_id").alias("record_id")).distinct()
    answers = records.join(asked, "record_id", "left_semi").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), "payload_bytes"
    )
    plain = records.filter("refers_id is null").withColumn("refers_to", F.lit(None).cast("bigint"))
    return plain.unionByName(keyed_join(revisits, answers, ["refers_id"], "record_id"))


SQL = """WITH p AS (SELECT row_number() OVER () AS n, page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT n, page_id, html, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p),
d AS (SELECT n, page_id, payload_bytes, string_agg(b, '' ORDER BY i) AS payload_digest
  FROM (SELECT *, unnest(range(8)) AS i FROM h) JOIN LATERAL (SELECT ('0x' || substr(hex, CAST(i * 5 + 1 AS INT), 5))::INT AS v) ON true
  JOIN LATERAL (SELECT array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v >> s) & 31) + 1 AS INT), 1)), '') AS b) ON true
  GROUP BY ALL)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY payload_digest, payload_bytes)"""


@query("op10_warc", SQL)
def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    arcs = written(pages_to_arc(table(spark, sf, "pages")), "arc")
    folder = scratch_path(spark, "op10-warc")
    write(arcs, folder)
    records = read(spark, folder).select("record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_id")
    return resolved(written(records, "warc-index")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
