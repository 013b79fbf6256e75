"""WARC archives: one gzip member per record, written by tasks and read back by byte ranges.

Writing: every task writes one archive under a name of its own attempt, and the rows it returns
(path, size, records) are the manifest. Only attempts whose rows reach the manifest count, so a
lost executor or a second attempt leaves a file that nobody reads.

Reading: archives are split into byte ranges. A task scans its range for the gzip magic, takes a
candidate only if the member decodes to a WARC header, owns the records of the members that start
inside the range, and reads on beyond its end to finish the last one.

Files are opened through ``pyarrow.fs`` by the scheme of their path (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.frames import map_batches, utf8
from starloom.session import materialise, scratch_path

SPLIT = 4 << 20
#: Bytes of archives that a task reads.
TASK = 32 << 20
LEVEL = 4
MAGIC = b"\x1f\x8b\x08"
WINDOW = 1 << 20
PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, size long, records long"
RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and its own path; ``file:/x`` is taken like ``file:///x``."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    return re.sub(r"[\r\n]+", " ", text)


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit (headers only) of the record ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_header_value(uri)}"] if uri is not None else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(records: DataFrame, folder: str) -> DataFrame:
    """Archives of ``records`` (record_id, target_uri, payload as text, refers_to); returns the manifest, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        system, path = _open(name)
        size = count = 0
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(path, compression=None)
            columns = [batch.column(c).to_pylist() for c in ("record_id", "target_uri", "refers_to")]
            for own, uri, refers, payload in zip(*columns, utf8(batch.column("payload"))):
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record(own, uri, payload.as_py().encode(), refers)) + packer.flush()
                out.write(member)
                size += len(member)
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], ["path", "size", "records"]
            )

    wanted = records.select("record_id", "target_uri", "refers_to", "payload")
    return materialise(map_batches(wanted, run, MANIFEST), "warc-manifest")


class _Source:
    """Bytes of a file by offset, read in windows."""

    def __init__(self, path: str):
        system, own = _open(path)
        self.file = system.open_input_file(own)
        self.size = self.file.size()

    def read(self, at: int, n: int) -> bytes:
        return self.file.read_at(min(n, self.size - at), at) if at < self.size else b""


def _starts_record(head: bytes) -> bool:
    """Whether a gzip member beginning with these bytes decodes to a WARC header."""
    try:
        return zlib.decompressobj(31).decompress(head, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _members(source: _Source, start: int, end: int) -> Iterator[bytes]:
    """Contents of the members that begin in [start, end)."""
    at, data, base = start, b"", start
    while at < end:
        if at - base >= len(data):
            base, data = at, source.read(at, WINDOW)
        found = data.find(MAGIC, at - base)
        if found < 0:
            if base + len(data) >= min(source.size, end + len(MAGIC)):
                return
            at = max(base + len(data) - len(MAGIC) + 1, at + 1)
            base, data = at, source.read(at, WINDOW)
            continue
        at = base + found
        if at >= end:
            return
        if len(data) - found < 512 and base + len(data) < source.size:
            base, data, found = at, source.read(at, WINDOW), 0
        if not _starts_record(data[found : found + 512]):
            at += 1
            continue
        unpacker, pieces, position = zlib.decompressobj(31), [], at
        chunk = data[found:]
        while True:
            pieces.append(unpacker.decompress(chunk))
            position += len(chunk)
            if unpacker.eof:
                break
            chunk = source.read(position, WINDOW)
            if not chunk:
                raise EOFError(f"the member at {at} is cut off")
        at = position - len(unpacker.unused_data)
        yield b"".join(pieces)


def _header(block: bytes) -> tuple[dict[str, str], int]:
    """Header fields (names in lower case) and where the body begins."""
    end = block.index(b"\r\n\r\n")
    fields = {}
    for line in block[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def parse(content: bytes) -> Iterator[dict]:
    """The records of a member; a payload that does not have its digest is an error."""
    while content.startswith(b"WARC/1."):
        fields, body = _header(content)
        size = int(fields["content-length"])
        block, content = content[body : body + size], content[body + size + 4 :]
        http, at = _header(block)
        revisit = fields["warc-type"] == "revisit"
        payload = None if revisit else block[at:]
        named = fields["warc-payload-digest"].removeprefix("sha1:")
        if payload is not None and digest(payload) != named:
            raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest")
        yield {
            "record_id": fields["warc-record-id"].strip("<>"),
            "record_type": fields["warc-type"],
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload_digest": named,
            "payload_bytes": int(http["content-length"]) if revisit else len(payload),
            "payload": payload,
        }


def tasks(archives: DataFrame, split: int) -> int:
    """Read tasks: one for each ``TASK`` bytes, and as many as the cluster has cores if there are as many ranges.

    The rows of ranges are tiny, so without a number of its own their exchange would end in one task.
    """
    size, ranges = archives.agg(F.sum("size"), F.sum(F.ceil(F.col("size") / split))).first()
    return max(1, -(-(size or 0) // TASK), min(ranges or 0, archives.sparkSession.sparkContext.defaultParallelism))


def read(archives: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """Records of the ``archives`` (path, size), each archive in ranges of ``split`` bytes.

    ``payload`` is null for revisits, and for all records without ``payloads``; digests are checked
    in either case.
    """
    ranges = archives.where("size > 0").select(
        "path",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long"))).alias("start"),
        "size",
    )
    schema = T.StructType([f for f in RECORDS if payloads or f.name != "payload"])
    arrow = pa.schema(
        [
            (f.name, {"long": pa.int64(), "bigint": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString(), pa.string()))
            for f in schema
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, weight = [], 0
                for content in _members(_Source(row["path"]), row["start"], min(row["start"] + split, row["size"])):
                    for found in parse(content):
                        held.append({c: found[c] for c in arrow.names})
                        weight += 256 + found["payload_bytes"]
                        if weight > WINDOW * 4:
                            yield pa.RecordBatch.from_pylist(held, arrow)
                            held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    return map_batches(ranges.repartition(tasks(archives, split)), run, schema)


def with_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Records for ``pages``: the largest id of equal payloads is the response, smaller ids revisit it.

    Null payloads are empty ones. Rows that repeat the largest id are all responses. A null id is
    smaller than any other and is written as an empty name. Other columns are not used.
    """
    base = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("target_uri"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    leads = base.groupBy("key").agg(F.max("page_id").alias("lead"))
    names = [F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("page_id", "lead")]
    return base.join(leads, "key").select(
        names[0].alias("record_id"),
        "target_uri",
        "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("lead")), names[1]).alias("refers_to"),
    )


def round_trip(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """``pages`` written as archives in the shared folder and read back."""
    manifest = write(with_roles(pages), scratch_path(pages.sparkSession, "warc"))
    return read(manifest, payloads=payloads)


def page_number(name):
    """The id of a page in the name of its record."""
    return F.nullif(F.substring_index(name, ":", -1), F.lit("")).cast("bigint")
