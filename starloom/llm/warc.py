"""WARC archives as seekable Zstandard bundles.

Each bundle is one file of independent Zstandard frames, each with some whole
records, and a seek table in a skippable frame at the end: compressed and plain
size of every frame. Any reader of Zstandard can read the file from the front;
with the seek table and the index (record, bundle, frame, offset in the frame,
length) one record is read by decompressing one frame.

Of records with equal payloads of at least least_revisit bytes that with the
smallest id holds the payload; the others are revisit records that refer to it.

A task writes one bundle after the other, frame by frame, into the shared
folder: first under a name of its own, then renamed. A task that is repeated
writes the same bytes under the same name, so a lost executor costs its task.

Edge cases: a null payload is empty; a null id or a repeated id is kept, ids
order ties by the payload's digest; without rows no bundle is written.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.frames import prepare
from starloom.session import scratch_path, stage

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


@dataclass(frozen=True)
class Bundling:
    bundle_bytes: int = 32 << 20
    frame_bytes: int = 1 << 20
    least_revisit: int = 100
    level: int = 3
    # WARC-Date of all records; empty: the time at which the bundles are written.
    date: str = ""


# A task reads about so many bytes of records back.
READ_BYTES = 128 << 20


class SeekableWriter:
    """Frames to a binary file, then the seek table."""

    def __init__(self, out, level: int = 3):
        self.out, self.frames, self.packer = out, [], zstandard.ZstdCompressor(level=level)

    def frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data)))

    def finish(self) -> None:
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


class SeekableReader:
    """Frames of a seekable file by number."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        file.seek(size - 9 - count * width)
        table = file.read(count * width)
        self.sizes = [struct.unpack_from("<II", table, k * width) for k in range(count)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, number: int) -> bytes:
        self.file.seek(self.starts[number])
        packed, plain = self.sizes[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=max(plain, 1))


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, digest_order: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> bytes:
    """One WARC/1.1 record; a revisit, with refers_to, holds no payload but its digest and size."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Date: {date}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest_order}/{digest}')}>",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To-Page: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of the records in a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        length = int(head["Content-Length"])
        yield head, data[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def with_revisits(pages: DataFrame, key: str, payload: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Digest and size of every row, and (_id, _digest, _first) of every revisit. Payloads are not shuffled."""
    content = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    digests = pages.select(
        F.col(key).alias("_id"), F.sha2(content, 256).alias("_digest"), F.octet_length(content).cast("long").alias("_size")
    )
    digests = stage(digests, "payload-digests")
    large = digests.filter(F.col("_size") >= least)
    firsts = large.groupBy("_digest").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    return digests, large.join(firsts, "_digest").filter("_id > _first").select("_id", "_digest", "_first").distinct()


def write_bundles(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", how: Bundling = Bundling()) -> DataFrame:
    """Write all rows of pages as records; the index (page_id, bundle, frame, offset, length) as a staged table."""
    spark = pages.sparkSession
    prepare(spark)
    digests, revisits = with_revisits(pages, key, payload, how.least_revisit)
    total = digests.agg(F.sum("_size")).first()[0] or 0
    bundles = max(1, -(-total // how.bundle_bytes))
    source = pages.select(
        F.col(key).cast("long").alias("_id"), F.col(url).cast("string").alias("_url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("_payload"),
    )
    # Marks of revisits travel as rows of their own and stand before the page they mark: payloads are shuffled once,
    # and pages of a hot payload lie in as many bundles as others.
    marks = revisits.select("_id", F.lit(None).cast("string").alias("_url"), F.lit(None).cast("binary").alias("_payload"), "_digest", "_first")
    empty = {"_digest": F.lit(None).cast("string"), "_first": F.lit(None).cast("long")}
    rows = source.withColumns(empty).unionByName(marks)
    spread = F.pmod(F.xxhash64("_id", F.when(F.col("_id").isNull(), F.xxhash64("_payload"))), F.lit(bundles)).cast("int")
    dealt = rows.withColumn("_bundle", spread).repartition(int(bundles), "_bundle")
    ordered = dealt.sortWithinPartitions("_bundle", "_id", F.col("_first").isNull(), F.xxhash64("_payload"))
    schema = "page_id long, bundle string, frame int, offset long, length long"
    how = replace(how, date=how.date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    return stage(ordered.mapInArrow(lambda batches: _write(batches, folder, how), schema), "warc-index")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(n) for n in ("_bundle", "_id", "_url", "_payload", "_digest", "_first")]
        for k in range(batch.num_rows):
            yield tuple(column[k].as_py() for column in columns)


def _write(batches: Iterator[pa.RecordBatch], folder: str, how: Bundling) -> Iterator[pa.RecordBatch]:
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    bundle, marked, writer, held, held_bytes, index = None, None, None, [], 0, []

    def flush():
        nonlocal held_bytes
        if held:
            writer.frame(b"".join(held))
            held.clear()
            held_bytes = 0

    def close():
        flush()
        writer.finish()
        writer.out.close()
        target = f"{root}/bundle-{bundle:06d}.warc.zst"
        # A task that runs again replaces the file of its first attempt, also where a move may not.
        if files.get_file_info(target).type != fs.FileType.NotFound:
            files.delete_file(target)
        files.move(f"{root}/{temporary}", target)
        names = ["page_id", "bundle", "frame", "offset", "length"]
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*index, strict=True), kinds, strict=True)]
        index.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    marks: dict[tuple[int, str], int] = {}
    for number, page, url, payload, mark, first in _rows(batches):
        if first is not None:
            if marks and page != marked:
                marks.clear()
            marked, marks[page, mark] = page, first
            continue
        if number != bundle:
            if writer:
                yield close()
            bundle, temporary = number, f".{uuid.uuid4().hex}.part"
            writer = SeekableWriter(files.open_output_stream(f"{root}/{temporary}", compression=None), how.level)
            order = 0
        order += 1
        digest = hashlib.sha256(payload).hexdigest()
        made = record(page, url, payload, digest, len(payload), marks.get((page, digest)), order, how.date)
        if held and held_bytes + len(made) > how.frame_bytes:
            flush()
        index.append((page, f"bundle-{number:06d}.warc.zst", len(writer.frames), held_bytes, len(made)))
        held.append(made)
        held_bytes += len(made)
    if writer:
        yield close()


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the indexed bundles, read frame by frame through the seek tables.

    (page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload);
    a response's digest and size are taken from its payload and must agree with
    its header, a revisit's come from its header.
    """
    prepare(spark)
    frames = index.select("bundle", "frame").distinct()
    # The index is small, what it stands for is not: tasks are cut by the bytes of the bundles.
    size = index.agg(F.count_distinct("bundle"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(size[0], max(2 * spark.sparkContext.defaultParallelism, -(-size[1] // READ_BYTES))))
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        opened, reader = None, None
        for batch in batches:
            for name, number in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist(), strict=True):
                if name != opened:
                    path = f"{root}/{name}"
                    opened, reader = name, SeekableReader(files.open_input_file(path), files.get_file_info(path).size)
                found = [_result(head, body) for head, body in parse_records(reader.frame(number))]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    return frames.repartition(int(tasks), "bundle").sortWithinPartitions("bundle", "frame").mapInArrow(read, schema)


def _result(head: dict[str, str], body: bytes) -> tuple:
    digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["WARC-Payload-Length"])
    first = head.get("WARC-Refers-To-Page")
    if head["WARC-Type"] == "response" and (hashlib.sha256(body).hexdigest() != digest or len(body) != size):
        raise ValueError(f"record of page {head['WARC-Page-ID']} is damaged")
    page = int(head["WARC-Page-ID"]) if head["WARC-Page-ID"] else None
    return page, head["WARC-Target-URI"], head["WARC-Type"], int(first) if first else None, digest, size, body


def read_record(folder: str, bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: reads the seek table and one frame."""
    files, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{bundle}"
    with files.open_input_file(path) as file:
        data = SeekableReader(file, files.get_file_info(path).size).frame(frame)
    return next(parse_records(data[offset : offset + length]))


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as bundles below the shared folder and read all of them back."""
    target = folder or scratch_path(pages.sparkSession, "warc")
    target = target if "://" in target or target.startswith("file:") else f"file://{target}"
    target = target.replace("file:/", "file:///", 1) if target.startswith("file:/") and not target.startswith("file://") else target
    return read_bundles(pages.sparkSession, target, write_bundles(pages, target))
