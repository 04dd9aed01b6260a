"""Files in any store: pyarrow's file systems where Python reads them, Hadoop's where the driver moves folders,
and intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; Spark's s3a counts as s3."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path)) if re.match(r"^\w+:/", path) else (fs.LocalFileSystem(), os.path.abspath(path))


def info(path: str) -> fs.FileInfo:
    files, at = open_fs(path)
    return files.get_file_info(at)


def is_folder(path: str) -> bool:
    return info(path).type == fs.FileType.Directory


def read_text(path: str) -> str:
    files, at = open_fs(path)
    with files.open_input_stream(at) as f:
        return f.read().decode()


def write_text(path: str, text: str) -> None:
    """A small file in place of any older one; readers never see half of it."""
    files, at = open_fs(path)
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    temporary = f"{at}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(temporary) as out:
        out.write(text.encode())
    files.move(temporary, at)


def remove_file(path: str) -> None:
    files, at = open_fs(path)
    with contextlib.suppress(FileNotFoundError):
        files.delete_file(at)


class Folders:
    """Folders as Spark sees them: through Hadoop's file systems, on the driver."""

    def __init__(self, spark: SparkSession):
        self.path_of, self.conf = spark._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.path_of(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        files, p = self._at(path)
        return files.exists(p)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        files, p = self._at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(p)) if files.exists(p) else []

    def move(self, source: str, target: str) -> None:
        """Renames a folder; the target's parent is made, the target must not be there."""
        files, p = self._at(source)
        to = self.path_of(target)
        files.mkdirs(to.getParent())
        if files.exists(to) or not files.rename(p, to):
            raise OSError(f"cannot move {source} to {target}")

    def touch(self, path: str) -> None:
        """An empty file: it is there whole or not at all."""
        files, p = self._at(path)
        files.create(p, True).close()

    def delete(self, path: str) -> None:
        files, p = self._at(path)
        files.delete(p, True)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; only where that is unset and the master is local a temporary one stands in."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix='fwloom-'))).rstrip('/')}/table-{uuid.uuid4().hex}"


_LOCAL: dict[str, str] = {}


def kept_dir(spark: SparkSession) -> str:
    """A shared folder that goes when the driver's Python ends."""
    path = shared_dir(spark)

    def clean() -> None:
        with contextlib.suppress(Exception):  # the session may be gone; then the folder's owner clears it
            Folders(spark).delete(path)

    atexit.register(clean)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A shared folder for the time of a block."""
    path = shared_dir(spark)
    try:
        yield path
    finally:
        Folders(spark).delete(path)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``df`` once as Parquet and reads it back, which cuts the lineage; without ``path`` it goes at the driver's end."""
    path = path or kept_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
