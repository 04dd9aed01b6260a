"""Operator 7: media columns through a Spark data source.

Payloads become images: a payload is rows of 576 8-bit grey samples, stored without loss as PNG. Images are
members of archives (plain ZIP files with stored members, which any tool opens). ``media_archive`` is a data source for folders of such archives:

* writing streams Arrow batches into archives of ``ARCHIVE_MEMBERS`` members or ``ARCHIVE_BYTES`` at most; the commit of the job writes one list with
  the names of all archives of the tasks that won, and readers see only those of its archives that are listed: all of a job or nothing, whatever is lost.
  A task without rows writes no archive, a task that fails deletes its own; archives of other makers, by their names, need no list;
* reading plans byte ranges over the archives from their sizes alone, larger ones in larger folders (``MOST_RANGES``). A task reads the archive's
  directory, which is bounded as its members are, takes the members whose records start in its range, and streams them in Arrow batches of bounded bytes;
* each member is read by its own offset and checked by its own checksum. A failed read opens the archive
  anew and tries that member again, ``ATTEMPTS`` times, without a second read of its neighbours;
* an archive whose directory cannot be read fails with an error that names the archive.

Archives lie in the shared folder, reached through pyarrow's file systems (file, hdfs, s3, gs).

Defined results: a null text counts as empty; empty texts have one row of padding; the payload ends at the
last byte that is not 255, a byte UTF-8 never has; a null doc_id stays null; repeated rows repeat; extra
columns are dropped; an empty table writes no archive and gives an empty result, as does a folder that is
missing or empty.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from fwloom.llm.common import shared_dir, table

UNIT, PAD, TAIL = 576, b"\xff", 32
#: Bytes of a reading task's range and of an Arrow batch, and tries for a member.
RANGE_BYTES, BATCH_BYTES, ATTEMPTS = 16 << 20, 8 << 20, 4
#: Members and bytes from which a task begins a new archive, and the number of ranges of a job from which they grow.
ARCHIVE_MEMBERS, ARCHIVE_BYTES, MOST_RANGES = 20_000, 1 << 30, 100_000
LIST, OWN = re.compile(r"_archives-\w+\.json$"), re.compile(r"media-[0-9a-f]{32}\.zip$")
FORMAT = "media_archive"
MEMBERS = "doc_id long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
PNG = b"\x89PNG\r\n\x1a\n"
EPOCH = (1980, 1, 1, 0, 0, 0)


def payload(text: str | None) -> bytes:
    """UTF-8 bytes, padded to a positive multiple of ``UNIT``."""
    data = (text or "").encode()
    return data + PAD * (UNIT - len(data) if len(data) < UNIT else -len(data) % UNIT)


def png(samples: bytes) -> bytes:
    """A grey image of ``UNIT`` columns; no row is filtered, so equal samples give equal files."""
    rows = len(samples) // UNIT
    raw = np.zeros((rows, UNIT + 1), np.uint8)
    raw[:, 1:] = np.frombuffer(samples, np.uint8).reshape(rows, UNIT)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", UNIT, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + chunk(b"IEND", b"")


def samples_of(image: bytes) -> bytes:
    """The samples of such an image; chunk checksums are verified."""
    if image[:8] != PNG:
        raise ValueError("not a PNG file")
    at, data, width = 8, [], 0
    while at < len(image):
        (n,), kind = struct.unpack_from(">I", image, at), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            width = struct.unpack_from(">I", body)[0]
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, width + 1)
    if raw[:, 0].any():
        raise ValueError("filtered rows are not written here")
    return raw[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Mean, standard deviation, edges, and shares of the four quarters of the grey scale, in whole thousandths."""
    x = np.frombuffer(samples, np.uint8)
    counts = np.bincount(x, minlength=256)
    mean, square = int(counts @ np.arange(256)), int(counts @ np.arange(256) ** 2)
    n = len(x)
    deviation = int((max(square * n - mean * mean, 0)) ** 0.5 * 1000 // n)
    edges = int((np.abs(np.diff(x.astype(np.int16))) > 32).sum())
    quarters = [int(c) * 1000 // n for c in counts.reshape(4, 64).sum(1)]
    return f"mean={mean * 1000 // n};deviation={deviation};edges={edges};quarters={'/'.join(map(str, quarters))}"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; Spark's s3a counts as s3."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path) if re.match(r"^\w+:", path) else f"file://{path}")


class ArchiveCommit(WriterCommitMessage):
    """Names of the archives that a task wrote."""

    def __init__(self, names: list[str]):
        self.names = names


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ArchiveCommit:
        members = ((doc, media) for batch in iterator for doc, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        files, root = open_fs(self.path)
        names: list[str] = []
        try:
            for first in members:
                if not names:
                    files.create_dir(root, recursive=True)
                names.append(f"media-{uuid.uuid4().hex}.zip")
                with files.open_output_stream(f"{root}/{names[-1]}") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
                    size = 0
                    for nth, (doc, media) in enumerate(itertools.chain([first], members)):
                        archive.writestr(zipfile.ZipInfo(f"{nth}/{'null' if doc is None else doc}.png", EPOCH), media)
                        size += len(media)
                        if nth + 1 >= ARCHIVE_MEMBERS or size >= ARCHIVE_BYTES:
                            break
        except BaseException:
            for name in names:
                remove(files, f"{root}/{name}")
            raise
        return ArchiveCommit(names)

    def commit(self, messages: list) -> None:
        files, root = open_fs(self.path)
        names = [n for m in messages if m for n in m.names]
        if names:
            temporary, final = f"{root}/.{uuid.uuid4().hex}.tmp", f"{root}/_archives-{uuid.uuid4().hex}.json"
            with files.open_output_stream(temporary) as out:
                out.write(json.dumps(sorted(names)).encode())
            files.move(temporary, final)

    def abort(self, messages: list) -> None:
        files, root = open_fs(self.path)
        for m in messages:
            for name in m.names if m else ():
                remove(files, f"{root}/{name}")


def remove(files: fs.FileSystem, path: str) -> None:
    """Deletes a file that may never have come to be."""
    if files.get_file_info(path).type != fs.FileType.NotFound:
        files.delete_file(path)


def members_of(files: fs.FileSystem, archive: str) -> list[zipfile.ZipInfo]:
    """An archive's directory."""
    for attempt in range(ATTEMPTS):
        try:
            with files.open_input_file(archive) as f, zipfile.ZipFile(f) as opened:
                return opened.infolist()
        except (zipfile.BadZipFile, OSError, ValueError) as e:
            if attempt == ATTEMPTS - 1:
                raise OSError(f"archive {archive}: its directory cannot be read: {e}") from e
            time.sleep(0.05 * 2**attempt)
    raise AssertionError("unreachable")


class Range(InputPartition):
    def __init__(self, archive: str, start: int, end: int):
        super().__init__(archive)
        self.archive, self.start, self.end = archive, start, end


def read_member(files: fs.FileSystem, archive: str, opened: list, info: zipfile.ZipInfo) -> bytes:
    """The stored bytes of a member, by its own offset; another try opens the archive anew."""
    for attempt in range(ATTEMPTS):
        try:
            if not opened:
                opened.append(files.open_input_file(archive))
            head = opened[0].read_at(30, info.header_offset)
            if head[:4] != b"PK\x03\x04":
                raise OSError(f"no member at {info.header_offset}")
            name, extra = struct.unpack_from("<HH", head, 26)
            data = opened[0].read_at(info.compress_size, info.header_offset + 30 + name + extra)
            if len(data) != info.compress_size or zlib.crc32(data) != info.CRC:
                raise OSError(f"damaged member {info.filename}")
            return data
        except OSError:
            if attempt == ATTEMPTS - 1:
                raise
            for f in opened:
                f.close()
            opened.clear()
            time.sleep(0.05 * 2**attempt)
    raise AssertionError("unreachable")


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def archives(self) -> list[fs.FileInfo]:
        """Archives that are listed, or of other makers."""
        files, root = open_fs(self.path)
        found = [f for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.is_file]
        listed: set[str] = set()
        for f in found:
            if LIST.match(f.base_name):
                with files.open_input_stream(f.path) as stream:
                    listed |= set(json.loads(stream.read()))
        return sorted((f for f in found if f.base_name.endswith(".zip") and (f.base_name in listed or not OWN.match(f.base_name))), key=lambda f: f.path)

    def partitions(self) -> list[Range]:
        found = self.archives()
        step = max(self.range_bytes, -(-sum(f.size for f in found) // MOST_RANGES))
        return [Range(f.path, start, start + step) for f in found for start in range(0, f.size, step)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        files, _ = open_fs(self.path)
        members = [m for m in members_of(files, partition.archive) if partition.start <= m.header_offset < partition.end]
        opened: list = []
        docs, media, size = [], [], 0
        for m in members:
            data = read_member(files, partition.archive, opened, m)
            doc = m.filename.split("/")[1].removesuffix(".png")
            docs.append(None if doc == "null" else int(doc))
            media.append(data)
            size += len(data)
            if size >= BATCH_BYTES:
                yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "media"])
                docs, media, size = [], [], 0
        if docs:
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "media"])
        for f in opened:
            f.close()


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(folder)`` and the writer for it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"])


def images(docs: DataFrame) -> DataFrame:
    """``MEMBERS`` of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([png(payload(t)) for t in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, MEMBERS)


def write_archives(docs: DataFrame, path: str) -> None:
    docs.sparkSession.dataSource.register(MediaArchive)
    images(docs).write.format(FORMAT).mode("append").save(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format(FORMAT).load(path)


def features(media: DataFrame) -> DataFrame:
    """``FEATURES`` of members read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for image in batch.column(1).to_pylist():
                data = samples_of(image)
                rows.append((len(data.rstrip(PAD)), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-TAIL:]), len(image), hashlib.sha256(image).hexdigest(), feature(data)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], [f.split()[0] for f in FEATURES.split(", ")])

    return media.mapInArrow(run, FEATURES)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_archives(table(spark, sf_dir, "documents"), path)
    return features(read_archives(spark, path))


QUERIES = {"op7_media": op7_media}
ORACLE_SQL: dict[str, str] = {}
