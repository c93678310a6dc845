"""WARC archives: writing whole-file gzip streams and normalising them to a member for each record (operator 3)."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import shared_folder, stored

LEAST_PAYLOAD = 100  # bytes from which equal payloads become revisits
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
END = "\r\n\r\n"
INDEX = "archive string, offset long, length long, record_bytes long, record_id string"


def _octets(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def _field(name: str, value: Column) -> Column:
    """A header line; control characters end no line. A null value leaves the line out."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F\x7F]", ""), F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame) -> DataFrame:
    """page_id and the WARC record (without its closing empty lines) for every row of pages (page_id, url, html).

    Of rows with equal payloads of at least 100 bytes those with the least page_id are responses, the rest revisits that
    name it; a revisit has no payload of its own but carries its digest and length. Shorter payloads are all responses,
    and so are payloads that occur under null ids only. A null html is an empty payload, a null url leaves its header out.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"),
        F.sha2(payload.cast("binary"), 256).alias("digest"), _octets(payload).alias("bytes"),
    )
    # narrow, and usually far smaller than the pages: written, so that the planner knows its size
    groups = rows.filter(F.col("bytes") >= LEAST_PAYLOAD).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    groups = stored(groups.filter("n > 1 and first_id is not null").select("digest", "first_id"))
    rows = rows.join(groups, "digest", "left")
    revisit = F.coalesce(F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")), F.lit(False)) & F.col("first_id").isNotNull()
    identity = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(HTTP), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", identity("page_id")), _field("WARC-Date", F.lit(DATE)), _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Payload-Length", F.col("bytes").cast("string")),
        _field("WARC-Refers-To", F.when(revisit, identity("first_id"))),
        _field("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _field("Content-Type", F.lit("application/http; msgtype=response")), _field("Content-Length", _octets(block).cast("string")), F.lit("\r\n"),
    )
    return rows.select("page_id", F.concat(header, block).alias("record"))


def write_archives(recs: DataFrame, folder: str) -> None:
    """One gzip stream for each partition: the text sink writes the records with the end of a record between them."""
    recs.select("record").write.option("lineSep", END).option("compression", "gzip").text(folder)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


class _Records:
    """Records out of a byte stream that arrives in pieces."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.need: int | None = None

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.held += data
        at = 0
        while True:
            if self.need is None:
                end = self.held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self.need = end + 4 - at + int(header_fields(bytes(self.held[at:end]))["content-length"]) + len(END)
            if len(self.held) - at < self.need:
                break
            yield bytes(self.held[at : at + self.need])
            at += self.need
            self.need = None
        del self.held[:at]


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:80]!r}")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _member(record: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


def _normalise(source: str, target: str) -> Iterator[tuple[str, int, int, int, str]]:
    """Inflate a stream once, write each record as a member of its own, and yield the index rows.

    The archive and its index appear under their names only when complete; a task that runs again replaces them whole.
    """
    from_fs, from_path = _open(source)
    to_fs, to_path = _open(target)
    part = f"{to_path}.{uuid.uuid4().hex}"
    inflate, found, offset = zlib.decompressobj(31), _Records(), 0
    with from_fs.open_input_stream(from_path, compression=None) as read, to_fs.open_output_stream(part, compression=None) as write, to_fs.open_output_stream(f"{part}.idx", compression=None) as index:
        while data := read.read(CHUNK):
            while data:
                out = inflate.decompress(data, CHUNK)
                for record in found.feed(out):
                    member = _member(record)
                    write.write(member)
                    fields = header_fields(record[: record.index(b"\r\n\r\n")])
                    row = (target, offset, len(member), len(record), fields["warc-record-id"])
                    index.write((json.dumps(row[1:]) + "\n").encode())
                    offset += len(member)
                    yield row
                if inflate.eof:  # streams may follow one another in a file
                    data, inflate = inflate.unused_data, zlib.decompressobj(31)
                else:
                    data = inflate.unconsumed_tail
    if found.held:
        raise ValueError(f"{source} ends inside a record")
    for suffix in (".idx", ""):
        to_fs.move(part + suffix, to_path + suffix)


def normalise_archives(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """archive, offset, length, record_bytes, record_id: rewrite every archive of a folder; one task for each file.

    The rows are the sidecar indexes' rows. Memory is a piece of the stream and one record. Evaluate once (write it):
    each evaluation rewrites the archives.
    """
    paths = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path").collect()]  # names only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "offset", "length", "record_bytes", "record_id"]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for row in _normalise(path, f"{target}/{path.rsplit('/', 1)[-1].split('.')[0]}.warc.gz"):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)

    fs, path = _open(target)
    fs.create_dir(path, recursive=True)
    if not paths:
        return spark.createDataFrame([], INDEX)
    return spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1).repartition(len(paths)).mapInArrow(run, INDEX)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """archive, offset, length, record_bytes, record_id: the sidecar indexes of a folder's archives."""
    if spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(folder).select("path").isEmpty():
        return spark.createDataFrame([], INDEX)
    lines = spark.read.option("pathGlobFilter", "*.idx").text(folder).select(
        F.regexp_replace("_metadata.file_path", r"\.idx$", "").alias("archive"), F.from_json("value", "array<string>").alias("x")
    )
    return lines.select("archive", *(F.col("x")[i].cast(kind).alias(c) for i, (c, kind) in enumerate(f.split() for f in INDEX.split(", ")[1:])))


def read_records(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: each record inflated alone at its offset.

    A response's payload is counted and hashed anew and must agree with its header; a revisit's figures are those of the
    payload it refers to, from its header.
    """

    def page(identity: str | None) -> int | None:
        number = (identity or "")[len("<urn:page:") : -1]
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != name:
                    fs, path = _open(archive)
                    name, file = archive, fs.open_input_file(path)
                file.seek(offset)
                record = zlib.decompress(file.read(length), 31)
                head, _, body = record.partition(b"\r\n\r\n")
                fields = header_fields(head)
                size, digest = int(fields["warc-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
                if fields["warc-type"] == "response":
                    payload = body[: -len(END)].partition(b"\r\n\r\n")[2]
                    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{archive}, offset {offset}: the payload does not agree with its header")
                rows.append((page(fields["warc-record-id"]), size, digest, fields["warc-type"], page(fields.get("warc-refers-to"))))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            )

    rows = index.select("archive", "offset", "length").sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write `pages` as whole-file gzip streams, normalise them, and read every record back through the sidecar indexes."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(records(pages), f"{folder}/streams")
    normalise_archives(spark, f"{folder}/streams", f"{folder}/archives").write.format("noop").mode("overwrite").save()
    return read_records(read_index(spark, f"{folder}/archives"))
