"""Web pages as WARC records in ZIP-packaged archives, written and read back.

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (each
record a gzip member of its own), ``indexes/index.cdxj`` (a line of JSON per
record with its offset and length) and ``datapackage.json``. The reader parses the
central directory, ZIP64 too, finds the stored members, and reads single records
by range (``zip_reader``); nothing is unpacked to disk.

Of pages with equal payloads of at least ``LEAST_BYTES`` the one with the smallest
id is a response, the others revisit it and keep only headers. Duplicates are
found on digests, before any payload moves. The ``HOT_DIGESTS`` most frequent of those that
repeat are broadcast, so revisits of them drop their payload where they lie, however
many they are; only where more digests repeat do the other pages meet the rest by shuffle.

Archives are written by tasks straight to the shared folder under a name of their
own and then moved, so a repeated task leaves one whole archive.

Defined cases: a null page is an empty payload. Rows without an id that equal one
with an id revisit it; if none has an id, all are responses. Rows that repeat the
smallest id are all responses. A null address leaves the header out; bytes that
cannot stand in a header are percent-encoded. No pages give no archive and no rows. A very
long page is one long record. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zipfile
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import shared_folder, written
from eventloom.llm.zip_reader import ZipReader

LEAST_BYTES = 100
#: Repeated digests that are broadcast, at most: 64 characters and a number each.
HOT_DIGESTS = 1 << 17
#: Payload bytes of an archive, about.
ARCHIVE_BYTES = 64 << 20
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"

_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def deduplicated(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, digest, size and refers_to (null for responses)."""
    text = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(text, "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    # digests without payload; the partial counts of a hot one are merged before the shuffle
    firsts = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    firsts = written(firsts.where("copies > 1 and refers_to is not null"), "firsts")
    hot = firsts.orderBy(F.desc("copies"), "digest").limit(HOT_DIGESTS).select("digest", "refers_to")
    out = rows.join(F.broadcast(hot), "digest", "left")
    if firsts.count() > HOT_DIGESTS:
        out = _with_rest(_pointed(out), firsts.select("digest", "refers_to"))
    return _pointed(out)


def _pointed(out: DataFrame) -> DataFrame:
    """Revisits lose their payload, the page that they revisit its pointer."""
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return out.withColumn("refers_to", F.when(revisit, F.col("refers_to"))).withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))


def _with_rest(out: DataFrame, firsts: DataFrame) -> DataFrame:
    """Pages that still point nowhere look among all repeated digests; those that point
    already have a key of their own, which no digest equals, so a hot one is spread."""
    key = F.when(F.col("refers_to").isNull(), F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("page_id", "url")))
    rest = firsts.select(F.col("digest").alias("met"), F.col("refers_to").alias("found"))
    out = out.withColumn("met", key).join(rest, "met", "left")
    return out.withColumn("refers_to", F.coalesce("refers_to", "found")).drop("met", "found")


def record_bytes(page_id, url, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """One WARC record; a revisit has the HTTP headers only."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """What a record says; the digest of a response is checked against its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload and digest do not agree")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
    refers = fields.get("WARC-Refers-To")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": None if refers is None else number(refers)}


class ArchiveWriter:
    """Streams records into the data member, then adds index and package description."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, raw: bytes, page_id, url, kind: str) -> None:
        packed = gzip.compress(raw, 1, mtime=0)
        self.data.write(packed)
        entry = {"page": page_id, "url": url, "type": kind, "filename": DATA, "offset": self.at, "length": len(packed)}
        self.lines.append(json.dumps(entry))
        self.at += len(packed)

    def close(self) -> None:
        self.data.close()
        for name, text in ((INDEX, "".join(x + "\n" for x in self.lines)), (PACKAGE, json.dumps({"profile": "data-package", "resources": [DATA, INDEX]}))):
            self.zip.writestr(zipfile.ZipInfo(name), text)
        self.zip.close()


def _system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def _write(folder: str, limit: int):
    def of(batches):
        task, k, made = TaskContext.get(), 0, []
        system, base = _system(folder)
        system.create_dir(base, recursive=True)
        out = writer = None

        def finish():
            nonlocal out, writer, k
            writer.close()
            out.close()
            name = f"pages-{task.partitionId():07d}-{k:05d}.wacz"
            system.move(part, f"{base}/{name}")
            made.append((f"{folder}/{name}", len(writer.lines)))
            out = writer = None
            k += 1

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "size", "refers_to")), strict=True):
                page_id, url, payload, digest, size, refers = (x.as_py() for x in row)
                if writer is None:
                    part, held = f"{base}/.{task.taskAttemptId()}-{k}", 0
                    out = system.open_output_stream(part)
                    writer = ArchiveWriter(out)
                writer.add(record_bytes(page_id, url, payload, digest, size, refers), page_id, url, "response" if refers is None else "revisit")
                held += len(payload or b"") + 512
                if held >= limit:
                    finish()
        if writer is not None:
            finish()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.int64())], names=["path", "records"])

    return of


def write_archives(pages: DataFrame, folder: str, *, archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Writes all pages into archives in a folder (URI) and returns path and records of each."""
    rows = deduplicated(pages, **columns).select("page_id", "url", "payload", "digest", "size", "refers_to")
    return written(rows.mapInArrow(_write(folder, archive_bytes), "path string, records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of these archives, read by the ranges that their indexes name."""

    def of(batches):
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        kinds = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()], strict=True)))
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _system(uri)
                with system.open_input_file(path) as source:
                    archive, rows = ZipReader(source, source.size()), []
                    for line in archive.read(INDEX).decode().splitlines():
                        entry = json.loads(line)
                        rows.append(parsed(gzip.decompress(archive.read(entry["filename"], entry["offset"], entry["length"]))))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    paths = archives.select("path")
    return paths.repartition(max(1, min(archives.count(), 100_000)), "path").mapInArrow(of, _RECORDS)


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Writes the pages to archives in the shared folder and returns what they hold."""
    return read_archives(write_archives(pages, shared_folder(pages.sparkSession, "warc"), **how))
