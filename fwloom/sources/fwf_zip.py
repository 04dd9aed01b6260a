"""Data source ``fwf_zip``: lines of fixed-width records in zip archives or plain files.

Files are read as streams and handed over in Arrow batches of bounded size; archives are never unpacked to disk. Of an
archive the largest member is read. Lines end at ``\\n``, ``\\r\\n`` or a lone ``\\r``. A file that cannot be read gives
one row with ``read_error`` instead of ending the job, after the lines that came before the fault.

A file is one task, or, with a plan of splits (``planned``, ``read_lines``), many: plain files and members that are stored without
compression are cut into byte ranges. A range owns the lines that start in it; a first pass over the splits counts
lines (and checks the archive's checksum), and sums of these counts are the numbers of the splits' first lines, so
lines have the same numbers however a file is cut. Deflated members and encodings whose line ends are not the bytes
of ASCII stay whole.

Filters on ``input_path`` and ``line_no`` are pushed into the source where ``read_lines`` made the frame: other files are not opened,
splits past the last line wanted are not read, and a file is left once its last wanted line is read.

As a stream the source offers every file of a folder once, and again when its size or age changes, whatever the
order of ages and names. What it has seen is a log in the folder ``log``: an entry for each offset with the new files, and
now and then one that sums up all before it.

Files lie where pyarrow's file systems reach: local paths, ``file://``, ``hdfs://``, ``s3://`` (or ``s3a://``), ``gs://``.

Options: ``path`` (a folder, a file, or several separated by newlines), ``encoding`` (utf-8), ``batchRows``,
``maxLines`` (0: all), ``splits`` (folder of a plan), ``pushdown`` (filters; needs the session's setting for it), ``log`` (streams).
"""

from __future__ import annotations

import codecs
import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from fwloom import storage
from fwloom.sources import deflate64
from fwloom.storage import open_fs

FORMAT = "fwf_zip"
SCHEMA = "input_path string, line_no long, raw_line string, read_error string"
BATCH_ROWS = 50_000
DEFLATE64 = 9
#: Bytes of a split, and the number of splits of a job from which they grow.
SPLIT_BYTES, MAX_SPLITS = 128 << 20, 100_000
CHUNK = 1 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class ReadError(ValueError):
    """A file whose lines cannot be read."""


def open_file(path: str) -> pa.NativeFile | io.BytesIO:
    """A file to seek in; very short ones are read at once, as zipfile looks for their end before their start."""
    files, at = open_fs(path)
    f = files.open_input_file(at)
    if f.size() > 4096:
        return f
    with f:
        return io.BytesIO(f.read())


def data_member(archive: zipfile.ZipFile, path: str) -> zipfile.ZipInfo:
    """The largest member; the first of equals."""
    members = [m for m in archive.infolist() if not m.is_dir()]
    if not members:
        raise ReadError(f"{path}: zip is empty")
    return max(members, key=lambda m: m.file_size)


def data_start(f, member: zipfile.ZipInfo) -> int:
    """Where a member's bytes begin: after its local header."""
    f.seek(member.header_offset + 26)
    name, extra = (int.from_bytes(f.read(2), "little") for _ in range(2))
    return member.header_offset + 30 + name + extra


class Part(io.RawIOBase):
    """Bytes ``start`` to ``end`` of a file."""

    def __init__(self, path: str, start: int, end: int):
        self._file, self._left = open_file(path), end - start
        self._file.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        got = self._file.read(min(len(target), self._left))
        if not got and self._left and len(target):
            raise EOFError("file ends inside its data")
        self._left -= len(got)
        target[: len(got)] = got
        return len(got)

    def close(self) -> None:
        self._file.close()
        super().close()


class Deflate64Stream(io.RawIOBase):
    """Bytes of a member packed with method 9: by the package inflate64 if it is there, else by ``deflate64``. Size and checksum are compared."""

    def __init__(self, path: str, member: zipfile.ZipInfo):
        self._file = open_file(path)
        self._file.seek(data_start(self._file, member))
        self._packed, self._size, self._expected, self._crc, self._done = member.compress_size, member.file_size, member.CRC, 0, 0
        self._pieces, self._ready = self._inflated(), b""

    def _read(self, n: int) -> bytes:
        packed = self._file.read(min(n, self._packed))
        if not packed and self._packed:
            raise EOFError("archive ends inside a member")
        self._packed -= len(packed)
        return packed

    def _inflated(self) -> Iterator[bytes]:
        try:
            import inflate64
        except ImportError:
            yield from deflate64.inflate64(self._read)
            return
        inflater = inflate64.Inflater()
        while packed := self._read(1 << 16):
            yield inflater.inflate(packed)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self._ready:
            piece = next(self._pieces, None)
            if piece is None:
                if self._done != self._size or self._crc != self._expected:
                    raise zipfile.BadZipFile("the member's size or checksum differs")
                return 0
            self._ready, self._crc, self._done = piece, zlib.crc32(piece, self._crc), self._done + len(piece)
        n = min(len(target), len(self._ready))
        target[:n], self._ready = self._ready[:n], self._ready[n:]
        return n

    def close(self) -> None:
        self._file.close()
        super().close()


def text_lines(stream, encoding: str) -> Iterator[str]:
    with stream, io.TextIOWrapper(stream, encoding=encoding, newline="") as text:
        for line in text:
            yield line.rstrip("\n").rstrip("\r")


def lines_of(path: str, encoding: str) -> Iterator[str]:
    """Lines of a whole file without their ends."""
    with open_file(path) as f:
        if zipfile.is_zipfile(f):
            f.seek(0)
            with zipfile.ZipFile(f) as archive:
                member = data_member(archive, path)
                stream = io.BufferedReader(Deflate64Stream(path, member)) if member.compress_type == DEFLATE64 else archive.open(member)
                yield from text_lines(stream, encoding)
            return
        f.seek(0)
        yield from text_lines(f, encoding)


# splits


def splittable(encoding: str) -> bool:
    """Whether line ends are single bytes of ASCII that are part of no other character."""
    return codecs.lookup(encoding).name.startswith(("utf-8", "ascii", "iso8859", "cp125")) and codecs.lookup(encoding).name != "utf-8-sig"


def data_range(path: str) -> tuple[int, int, int | None] | None:
    """Start and end of a file's data and its checksum, if known; None if it has no range of plain bytes."""
    with open_file(path) as f:
        if not zipfile.is_zipfile(f):
            return 0, storage.info(path).size, None
        f.seek(0)
        with zipfile.ZipFile(f) as archive:
            member = data_member(archive, path)
        if member.compress_type != zipfile.ZIP_STORED or member.flag_bits & 1:
            return None
        start = data_start(f, member)
        return start, start + member.file_size, member.CRC


def line_start(f, at: int, low: int, high: int) -> int:
    """The first start of a line at or after ``at``; ``high`` if there is none."""
    if at <= low:
        return low
    f.seek(at - 1)
    at, before = at - 1, b""
    while at < high:
        chunk = f.read(min(CHUNK, high - at))
        if not chunk:
            break
        if before == b"\r":  # ends the line unless a line feed follows
            return at + 1 if chunk[:1] == b"\n" else at
        found = min((k for k in (chunk.find(b"\n"), chunk.find(b"\r")) if k >= 0), default=-1)
        if found >= 0 and chunk[found] == 10:
            return at + found + 1
        if found >= 0 and found + 1 < len(chunk):
            return at + found + (2 if chunk[found + 1] == 10 else 1)
        before, at = chunk[-1:], at + len(chunk)
    return high


def count_lines(f, start: int, end: int, low: int) -> tuple[int, int]:
    """Number of lines that start in a split, and the checksum of its bytes."""
    lines, crc, at = int(start == low and end > start), 0, start
    f.seek(start - 1 if start > low else start)
    before = f.read(1) if start > low else b""
    while at < end:
        chunk = f.read(min(CHUNK, end - at))
        if not chunk:
            raise EOFError("file ends inside its data")
        # A line starts after a line feed, and after a carriage return that no line feed follows.
        lines += (before + chunk[:-1]).count(b"\n") + (before + chunk[:-1]).count(b"\r") - (before + chunk).count(b"\r\n")
        crc, before, at = zlib.crc32(chunk, crc), chunk[-1:], at + len(chunk)
    return lines, crc


#: The polynomial of the checksum in zip archives, lowest power first.
CRC_POLYNOMIAL = 0xEDB88320


def crc_times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of the checksum; the highest bit is the power 0."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
    return out


def crc_join(first: int, second: int, length: int) -> int:
    """Checksum of two strings put together, from theirs and the second's length: the first is shifted by x^8 a byte."""
    shift, power = 1 << 31, 1 << 23
    while length:
        if length & 1:
            shift = crc_times(shift, power)
        power, length = crc_times(power, power), length >> 1
    return crc_times(first, shift) ^ second


PLAN = "path string, low long, high long, start long, end long, first long, error string"


def planned(spark: SparkSession, path: str, encoding: str = "utf-8", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``PLAN``: the splits of all files; ``low`` is -1 for files that are read whole."""
    found = [(p, f.size) for p, f in infos_at(path) if f.is_file]
    size = max(split_bytes, -(-sum(s for _, s in found) // MAX_SPLITS))
    may = splittable(encoding)
    files = spark.createDataFrame(found, "path string, size long")
    long = files.where(F.lit(may) & (F.col("size") > size))
    whole = files.where(~(F.lit(may) & (F.col("size") > size))).select("path", *(F.lit(-1).cast("long").alias(c) for c in ("low", "high", "start", "end")), F.lit(1).cast("long").alias("first"), F.lit(None).cast("string").alias("error"))
    if not may or all(s <= size for _, s in found):
        return whole

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p in frame["path"]:
                try:
                    span = data_range(p)
                except Exception:  # read whole, and told as a fault then
                    span = None
                low, high, crc = span or (-1, -1, None)
                rows += [(p, low, high, at, min(at + size, high), crc) for at in (range(low, high, size) if span else [-1])]
            yield pd.DataFrame(rows, columns=["path", "low", "high", "start", "end", "expected"]).astype({"expected": "Int64"})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lines, crcs, errors = [], [], []
            for r in frame.itertuples():
                got, error = (0, 0), None
                if r.low >= 0:
                    try:
                        with open_file(r.path) as f:
                            got = count_lines(f, r.start, r.end, r.low)
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                lines.append(got[0])
                crcs.append(got[1])
                errors.append(error)
            yield frame.assign(lines=lines, crc=crcs, fault=errors)

    def number(frame: pd.DataFrame) -> pd.DataFrame:
        """A row for each split of one file: at most ``MAX_SPLITS``."""
        frame = frame.sort_values("start")
        error, total = next((e for e in frame["fault"] if e), None), 0
        for crc, a, b in zip(frame["crc"], frame["start"], frame["end"]):
            total = crc_join(total, int(crc), int(b - a))
        expected = frame["expected"].iloc[0]
        if error is None and not pd.isna(expected) and int(expected) != total:
            error = "BadZipFile: the archive's checksum differs"
        frame = frame.assign(first=1 + frame["lines"].cumsum() - frame["lines"], error=error)
        return (frame if error is None else frame.head(1))[["path", "low", "high", "start", "end", "first", "error"]]

    splits = long.repartition(min(200, max(1, len(found)))).mapInPandas(cut, "path string, low long, high long, start long, end long, expected long")
    n = sum(-(-s // size) for _, s in found if s > size)
    counted = splits.repartition(max(1, min(n, 10_000)), "path", "start").mapInPandas(count, f"{splits._jdf.schema().toDDL()}, lines long, crc long, fault string")
    return whole.unionByName(counted.groupBy("path").applyInPandas(number, PLAN))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FwfZip)
    spark.conf.set(PUSHDOWN, "true")


def read_lines(spark: SparkSession, path: str, encoding: str = "utf-8", split_bytes: int = SPLIT_BYTES, plan: str | None = None, **options) -> DataFrame:
    """``SCHEMA`` of all files at ``path``, long ones by many tasks.

    ``plan`` is a folder for the plan of splits; without it, and where no file is long, files are one task each.
    """
    register(spark)
    reader = spark.read.format(FORMAT).option("path", path).option("encoding", encoding).option("pushdown", "true")
    if splittable(encoding) and any(f.size > split_bytes for _, f in infos_at(path) if f.is_file):
        plan = plan or storage.kept_dir(spark)
        planned(spark, path, encoding, split_bytes).write.parquet(plan)
        reader = reader.option("splits", plan)
    return reader.options(**options).load()


class FilePart(InputPartition):
    """A whole file, or (``low`` at least 0) the lines that start in a range of it."""

    def __init__(self, path: str, low: int = -1, high: int = -1, start: int = -1, end: int = -1, first: int = 1, error: str | None = None):
        super().__init__(path)
        self.path, self.low, self.high, self.start, self.end, self.first, self.error = path, low, high, start, end, first, error

    def lines(self, encoding: str) -> Iterator[str]:
        if self.error:
            raise ReadError(self.error)
        if self.low < 0:
            return lines_of(self.path, encoding)
        with open_file(self.path) as f:
            start, end = (line_start(f, at, self.low, self.high) for at in (self.start, self.end))
        return text_lines(io.BufferedReader(Part(self.path, start, end), CHUNK), encoding) if end > start else iter(())


def read_part(part: FilePart, encoding: str, batch_rows: int, last: int) -> Iterator[pa.RecordBatch]:
    """Lines of a part, up to number ``last`` if that is not 0."""

    def batch(first: int, lines: list[str], error: str | None = None) -> pa.RecordBatch:
        n = len(lines) + (error is not None)
        numbers = [*range(first, first + len(lines))] + [first + len(lines)] * (error is not None)
        return pa.record_batch([pa.array([part.path] * n, pa.string()), pa.array(numbers, pa.int64()), pa.array([*lines, *[None] * (error is not None)], pa.string()), pa.array([*[None] * len(lines), *[error] * (error is not None)], pa.string())], ["input_path", "line_no", "raw_line", "read_error"])

    first, held = part.first, []
    try:
        for line in part.lines(encoding):
            held.append(line)
            if len(held) >= batch_rows:
                yield batch(first, held)
                first, held = first + len(held), []
            if last and first + len(held) > last:
                break
    except UnicodeDecodeError as e:
        yield batch(first, held, f"cannot decode as {encoding} at byte {e.start}: {e.reason}")
    except Exception as e:  # zip, codec and file system faults concern this file alone
        yield batch(first, held, f"{type(e).__name__}: {e}" if not part.error else part.error)
    else:
        if held:
            yield batch(first, held)


def infos_at(path: str) -> list[tuple[str, fs.FileInfo]]:
    """Files named by the option, or the files directly in a folder, sorted, with what their file system knows of them."""
    out = []
    for one in path.split("\n"):
        one = one.removeprefix("file://")
        files, at = open_fs(one)
        info = files.get_file_info(at)
        if info.type != fs.FileType.Directory:
            out.append((one, info))
            continue
        before = one.removesuffix(at) if one.endswith(at) else re.match(r"^(\w+://)?", one)[0]
        found = files.get_file_info(fs.FileSelector(at))
        out += sorted(((before + f.path, f) for f in found if f.is_file), key=lambda x: x[0])
    return out


def files_at(path: str) -> list[str]:
    return [p for p, _ in infos_at(path)]


class FwfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.encoding, self.splits = options.get("path", ""), options.get("encoding", "utf-8"), options.get("splits")
        self.batch_rows, self.last = int(options.get("batchRows", BATCH_ROWS)), int(options.get("maxLines", 0))
        self.first, self.only = 1, None
        if self.batch_rows <= 0:
            raise ValueError("batchRows must be positive")

    def parts(self) -> list[FilePart]:
        """Of every file its splits, or all of it."""
        if not self.splits:
            return [FilePart(p) for p in files_at(self.path)]
        files, at = open_fs(self.splits.removeprefix("file://"))
        rows = pq.read_table(at, filesystem=files).to_pylist()
        return [FilePart(**r) for r in sorted(rows, key=lambda r: (r["path"], r["start"]))]

    def wanted(self, parts: list[FilePart]) -> list[FilePart]:
        """Parts that may hold what the filters leave."""
        if self.only is not None:
            parts = [p for p in parts if p.path in self.only]
        out = []
        for p, following in zip(parts, [*parts[1:], None]):
            ends = following.first - 1 if following and following.path == p.path else None
            if not (self.last and p.first > self.last) and not (ends is not None and ends < self.first):
                out.append(p)
        return out

    def partitions(self) -> list[FilePart]:
        return self.wanted(self.parts()) or [FilePart("")]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from read_part(partition, self.encoding, self.batch_rows, self.last)


class PushingReader(FwfReader):
    """Takes filters on the file's name and the line's number."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            about = getattr(f, "attribute", None)
            if about == ("input_path",) and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = values if self.only is None else self.only & values
                continue
            if about == ("line_no",):
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual | In):
                    most = max(f.value, default=0) if isinstance(f, In) else f.value - isinstance(f, LessThan)
                    self.last = min(self.last or most, most) if most >= 1 else 1
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | In):
                    least = min(f.value, default=1) if isinstance(f, In) else f.value + isinstance(f, GreaterThan)
                    self.first = max(self.first, least)
            yield f


# streams


class SeenFiles:
    """The log of a stream: which files came at which offset, with their age and size.

    Entry n is ``n.json``; ``n.sum.json`` holds all files up to n that are still there. Entries are written before Spark
    records their offset, so after a failure the same offsets give the same files.
    """

    EVERY = 20

    def __init__(self, folder: str):
        self.folder = folder.removeprefix("file://").rstrip("/")
        self.known: dict[str, list[int]] = {}
        self.last, self.summed = 0, 0
        numbers = self.numbers()
        self.summed = max((n for n, total in numbers if total), default=0)
        for n in [self.summed] * (self.summed > 0) + sorted(n for n, total in numbers if not total and n > self.summed):
            self.known |= self.entry(n, n == self.summed)
            self.last = n

    def numbers(self) -> list[tuple[int, bool]]:
        found = [re.search(r"/(\d+)(\.sum)?\.json$", p) for p in (files_at(self.folder) if storage.is_folder(self.folder) else [])]
        return [(int(m[1]), bool(m[2])) for m in found if m]

    def name(self, n: int, total: bool) -> str:
        return f"{self.folder}/{n}{'.sum' * total}.json"

    def entry(self, n: int, total: bool = False) -> dict[str, list[int]]:
        return json.loads(storage.read_text(self.name(n, total)))

    def look(self, found: dict[str, list[int]]) -> int:
        """Logs files that are new or changed; the last offset."""
        if fresh := {p: x for p, x in found.items() if self.known.get(p) != x}:
            storage.write_text(self.name(self.last + 1, False), json.dumps(fresh))
            self.known |= fresh
            self.last += 1
        return self.last

    def between(self, start: int, end: int) -> list[str]:
        return sorted({p for n in range(start + 1, end + 1) for p in self.entry(n)})

    def done(self, end: int, there: set[str]) -> None:
        """Sums up entries that Spark will not ask for again; files that are gone are forgotten."""
        if end - self.summed < self.EVERY:
            return
        total: dict[str, list[int]] = self.entry(self.summed, True) if self.summed else {}
        for n in range(self.summed + 1, end + 1):
            total |= self.entry(n)
        storage.write_text(self.name(end, True), json.dumps({p: x for p, x in total.items() if p in there}))
        old, self.summed = self.summed, end
        # The entry of ``end`` itself stays: a batch that was recorded but not marked as done is asked for again.
        for n in range(max(old, 1), end):
            storage.remove_file(self.name(n, False))
        if old:
            storage.remove_file(self.name(old, True))


class FwfStreamReader(FwfReader, DataSourceStreamReader):
    """Offsets are numbers of the log's entries."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        if not options.get("log"):
            raise ValueError("a stream needs the option log: a folder for what it has seen, beside its checkpoint")
        self.seen = SeenFiles(options["log"])

    def there(self) -> dict[str, list[int]]:
        return {p: [f.mtime_ns, f.size] for p, f in infos_at(self.path) if f.is_file}

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        return {"entry": self.seen.look(self.there())}

    def partitions(self, start: dict, end: dict) -> list[FilePart]:
        there = self.there()
        return [FilePart(p) for p in self.seen.between(start["entry"], end["entry"]) if p in there]

    def commit(self, end: dict) -> None:
        self.seen.done(end["entry"], set(self.there()))


class FwfZip(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FwfReader:
        return PushingReader(self.options) if self.options.get("pushdown") == "true" else FwfReader(self.options)

    def streamReader(self, schema) -> FwfStreamReader:
        return FwfStreamReader(self.options)
