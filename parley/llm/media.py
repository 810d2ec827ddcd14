"""Media columns: a Spark data source over directories of ZIP archives.

Writing packs members into archives of bounded size, one task after another without a shuffle; a
manifest in the archive directory names the archives of committed tasks only. Reading plans
byte-range partitions over those archives from the manifest alone, so the driver never sees a
member. A task reads the archive's central directory, takes the members whose local headers lie in
its range, streams their payloads as Arrow batches of bounded size and retries each member by its
offset, whatever became of its neighbours.

Paths go through ``pyarrow.fs``: any scheme it knows, or a path that all executors share.
"""

from __future__ import annotations

import hashlib
import json
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "archive_media"
#: An archive is closed when it has grown so large; a reading partition covers so many bytes.
ARCHIVE_BYTES, RANGE_BYTES = 64 << 20, 16 << 20
#: Rows and payload bytes of an Arrow batch.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
RETRIES, WAIT_S = 4, 0.2
SCHEMA = "doc_id bigint, n_bytes bigint, media binary, archive string, offset bigint, error string"
WIDTH, PNG_LEVEL = 192, 4

# Fixed values of the ZIP format: signatures and layouts of the local header, directory entry and end record.
LOCAL, ENTRY, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
LOCAL_LAYOUT, ENTRY_LAYOUT, END_LAYOUT = "<4s5H3I2H", "<4s6H3I5H2I", "<4s4H2IH"
# Fixed value of the PNG format: its signature.
PNG = b"\x89PNG\r\n\x1a\n"


# --- the stored form -------------------------------------------------------------------------


def pad(raw: bytes, unit: int = WIDTH) -> bytes:
    """``raw`` followed by bytes 32 up to the next positive multiple of ``unit``."""
    return raw + b" " * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, width: int = WIDTH) -> bytes:
    """An 8-bit greyscale image, one sample a byte, ``width`` samples a row; the rows are unfiltered."""
    if not payload or len(payload) % width:
        raise ValueError(f"payload must be a positive multiple of {width} bytes")
    height = len(payload) // width
    coder, parts = zlib.compressobj(PNG_LEVEL), []
    for at in range(0, height, 4096):
        rows = payload[at * width : (at + 4096) * width]
        parts.append(coder.compress(b"".join(b"\0" + rows[i : i + width] for i in range(0, len(rows), width))))
    parts.append(coder.flush())
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", b"".join(parts)) + _chunk(b"IEND", b"")


def decode_png(image: bytes) -> bytes:
    """The samples of an image that ``encode_png`` made; any damage raises ValueError."""
    if image[:8] != PNG:
        raise ValueError("not a PNG image")
    at, width, height, data = 8, 0, 0, []
    while at + 12 <= len(image):
        (size,), kind = struct.unpack_from(">I", image, at), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", image, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk's checksum differs")
        if kind == b"IHDR":
            width, height = struct.unpack_from(">II", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    rows = zlib.decompress(b"".join(data))
    if not width or len(rows) != height * (width + 1) or any(rows[:: width + 1]):
        raise ValueError("not the rows of an unfiltered 8-bit image")
    return b"".join(rows[i + 1 : i + 1 + width] for i in range(0, len(rows), width + 1))


# --- archives --------------------------------------------------------------------------------


def _fs(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


class ArchiveWriter:
    """One ZIP archive of stored (uncompressed) members, written front to back. Members are bounded by the format: 4 GB each, and 65535 an archive."""

    def __init__(self, filesystem, path: str) -> None:
        self.path, self.at, self.entries = path, 0, []
        self.out = filesystem.open_output_stream(path)

    def add(self, name: bytes, note: bytes, payload: bytes) -> None:
        crc, size = zlib.crc32(payload), len(payload)
        head = struct.pack(LOCAL_LAYOUT, LOCAL, 20, 0x800, 0, 0, 0x21, crc, size, size, len(name), 0)
        entry = struct.pack(ENTRY_LAYOUT, ENTRY, 20, 20, 0x800, 0, 0, 0x21, crc, size, size, len(name), 0, len(note), 0, 0, 0, self.at)
        self.out.write(head + name), self.out.write(payload)
        self.entries.append(entry + name + note)
        self.at += len(head) + len(name) + size

    def full(self) -> bool:
        return self.at >= ARCHIVE_BYTES or len(self.entries) >= 65_000

    def close(self) -> dict:
        directory, start = b"".join(self.entries), self.at
        end = struct.pack(END_LAYOUT, END, 0, 0, len(self.entries), len(self.entries), len(directory), start, 0)
        self.out.write(directory + end)
        self.out.close()
        return {"archive": self.path.rsplit("/", 1)[-1], "bytes": start, "directory": len(directory), "members": len(self.entries)}


@dataclass
class Member:
    name: bytes
    note: bytes
    offset: int
    size: int
    crc: int


def read_directory(source, start: int, length: int) -> list[Member]:
    """The members that an archive's central directory lists."""
    source.seek(start)
    raw, at, out = source.read(length), 0, []
    while at < len(raw):
        f = struct.unpack_from(ENTRY_LAYOUT, raw, at)
        if f[0] != ENTRY:
            raise ValueError("not a directory entry")
        at += struct.calcsize(ENTRY_LAYOUT)
        name, note = raw[at : at + f[10]], raw[at + f[10] + f[11] : at + f[10] + f[11] + f[12]]
        out.append(Member(name, note, f[16], f[8], f[7]))
        at += f[10] + f[11] + f[12]
    return out


def read_member(source, member: Member) -> bytes:
    """The payload at the member's offset, held against its checksum."""
    source.seek(member.offset)
    head = source.read(struct.calcsize(LOCAL_LAYOUT))
    f = struct.unpack(LOCAL_LAYOUT, head)
    if f[0] != LOCAL:
        raise ValueError("not a local header")
    source.seek(member.offset + len(head) + f[9] + f[10])
    payload = source.read(member.size)
    if len(payload) != member.size or zlib.crc32(payload) != member.crc:
        raise ValueError("the payload's checksum differs")
    return payload


# --- the data source -------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    archives: list


@dataclass
class ByteRange(InputPartition):
    archive: str
    start: int
    end: int
    directory_at: int
    directory_bytes: int

    def __post_init__(self) -> None:
        self.value = None


class ArchiveSink(DataSourceArrowWriter):
    """Columns doc_id, n_bytes and media become members. Each task attempt writes archives of its own; only a commit lists them."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        filesystem, root = _fs(self.path)
        filesystem.create_dir(root, recursive=True)
        writer, done = None, []
        for batch in iterator:
            names = [n.lower() for n in batch.schema.names]
            ids, sizes, media = (batch.column(names.index(c)) for c in ("doc_id", "n_bytes", "media"))
            for i in range(batch.num_rows):
                writer = writer or ArchiveWriter(filesystem, f"{root}/{uuid.uuid4().hex}.zip")
                key = ids[i].as_py()
                note = json.dumps({"id": key, "n": sizes[i].as_py()}).encode()
                writer.add(b"%s.png" % str(key).encode(), note, media[i].as_py())
                if writer.full():
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        return Written(done)

    def commit(self, messages: list) -> None:
        filesystem, root = _fs(self.path)
        filesystem.create_dir(root, recursive=True)
        listed = [a for m in messages if m is not None for a in m.archives]
        with filesystem.open_output_stream(f"{root}/manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list) -> None:
        filesystem, root = _fs(self.path)
        for a in (a for m in messages if m is not None for a in m.archives):
            filesystem.delete_file(f"{root}/{a['archive']}")


class ArchiveSource(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, on_error: str) -> None:
        self.path, self.range_bytes, self.on_error = path, range_bytes, on_error

    def partitions(self) -> list[ByteRange]:
        from pyarrow import fs

        filesystem, root = _fs(self.path)
        out = []
        for info in sorted(filesystem.get_file_info(fs.FileSelector(root)), key=lambda i: i.path):
            if info.base_name.startswith("manifest-"):
                with filesystem.open_input_stream(info.path) as source:
                    listed = json.loads(source.read())
                for a in listed:
                    for start in range(0, a["bytes"], self.range_bytes):
                        out.append(ByteRange(a["archive"], start, min(a["bytes"], start + self.range_bytes), a["bytes"], a["directory"]))
        return out

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if partition is None or not isinstance(partition, ByteRange):
            return
        filesystem, root = _fs(self.path)
        path = f"{root}/{partition.archive}"
        source = filesystem.open_input_file(path)
        try:
            listed = read_directory(source, partition.directory_at, partition.directory_bytes)
        finally:
            source.close()
        rows: list[tuple] = []
        held = 0
        source = filesystem.open_input_file(path)
        for member in sorted((m for m in listed if partition.start <= m.offset < partition.end), key=lambda m: m.offset):
            payload, error = None, None
            for attempt in range(RETRIES):
                try:
                    payload, error = read_member(source, member), None
                    break
                except (OSError, ValueError, struct.error) as e:
                    error = f"{type(e).__name__}: {e}"
                    if attempt + 1 < RETRIES:
                        time.sleep(WAIT_S * 2**attempt)
                        source.close()
                        source = filesystem.open_input_file(path)
            if error and self.on_error != "row":
                raise OSError(f"{path} at {member.offset}: {error}")
            note = json.loads(member.note)
            rows.append((note["id"], note["n"], payload, partition.archive, member.offset, error))
            held += member.size
            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        source.close()
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.string())
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


class ArchiveMedia(DataSource):
    """``spark.read.format("archive_media").load(dir)`` and ``df.write.format("archive_media").mode("append").save(dir)``.

    Options: ``rangebytes`` (bytes of a reading partition), ``onerror`` (``raise``, or ``row``: a
    member that stays unreadable becomes a row with a null payload and the error). A directory with
    no manifest reads as an empty table.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveSource:
        return ArchiveSource(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)), self.options.get("onerror", "raise"))

    def writer(self, schema, overwrite: bool) -> ArchiveSink:
        return ArchiveSink(self.options["path"])


# --- the operator ----------------------------------------------------------------------------


def feature(payload: bytes) -> str:
    """Of the samples: mean, standard deviation and shares of eight equal ranges, with fixed decimals."""
    import numpy as np

    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    n, levels = len(payload), np.arange(256)
    mean = float((counts * levels).sum()) / n
    deviation = (max(0.0, float((counts * levels * levels).sum()) / n - mean * mean)) ** 0.5
    shares = counts.reshape(8, 32).sum(1) / n
    return ";".join([f"{mean:.4f}", f"{deviation:.4f}", *(f"{x:.5f}" for x in shares)])


def store(docs: DataFrame, path: str) -> None:
    """Write every whole text (null: the empty text) as an image into archives under ``path``.

    Ids may be null or repeat, and each row has a member of its own. An empty table gives a manifest of no
    archives, which reads as no rows. Other columns play no part. A member of the format holds less than
    4 GB; a longer text fails the write.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 64):
                raw = [t.as_py() or b"" for t in texts.slice(at, 64)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 64), pa.array([len(r) for r in raw], pa.int64()), pa.array([encode_png(pad(r)) for r in raw], pa.binary())],
                    ["doc_id", "n_bytes", "media"],
                )

    docs.sparkSession.dataSource.register(ArchiveMedia)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows.mapInArrow(run, "doc_id long, n_bytes long, media binary").write.format(FORMAT).mode("append").save(path)


def load(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Rows of SCHEMA from the archives under ``path``."""
    spark.dataSource.register(ArchiveMedia)
    return spark.read.format(FORMAT).option("onerror", on_error).load(path)


def describe(media: DataFrame) -> DataFrame:
    """Decoded payload digests and features, one row per stored member that could be read; none of no members.

    Equal texts have equal values. Rows that repeat stay, null ids too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in batches:
            out: list[list] = [[] for _ in names[2:]]
            for value in batch.column(2):
                image = value.as_py()
                payload = decode_png(image)
                one = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(image), hashlib.sha256(image).hexdigest(), feature(payload))
                for column, x in zip(out, one, strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    rows = media.where("media is not null").select("doc_id", "n_bytes", "media")
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(run, schema)
