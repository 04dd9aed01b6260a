"""What must be processed again, as joins of file listings with manifests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fwloom.storage import open_fs


def with_hashes(files: DataFrame) -> DataFrame:
    """``files`` (path, ...) and ``sha256``; tasks read the files, which must lie on shared storage."""
    names = files.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path in frame["path"]:
                digest = hashlib.sha256()
                files, at = open_fs(path.removeprefix("file://"))
                with files.open_input_stream(at) as f:
                    while chunk := f.read(1 << 20):
                        digest.update(chunk)
                out.append(digest.hexdigest())
            yield frame.assign(sha256=out)[[*names, "sha256"]]

    return files.mapInPandas(run, files.withColumn("sha256", F.lit("")).schema)


def dirty_files(files: DataFrame, manifest: DataFrame, config_hash: str) -> DataFrame:
    """Files without a manifest, with another configuration, or newer than it and of other content.

    ``files``: name, mtime, sha256, output_present; ``manifest``: name, raw_hash, config_hash, processed_at.
    """
    m = manifest.select(F.col("name").alias("m_name"), "raw_hash", F.col("config_hash").alias("m_config"), "processed_at")
    both = files.join(m, F.col("name") == F.col("m_name"), "left")
    changed = (F.col("mtime") > F.col("processed_at")) & ~F.col("sha256").eqNullSafe(F.col("raw_hash"))
    reason = F.when(F.col("m_name").isNull(), "new").when(F.col("m_config") != config_hash, "configuration").when(~F.col("output_present"), "output missing").when(changed, "content")
    return both.withColumn("reason", reason).where("reason IS NOT NULL").select(*files.columns, "reason")


def files_of_dirty_years(files: DataFrame, dirty: DataFrame) -> DataFrame:
    """All files of each trade type and year that has a dirty one: snapshots are chosen among siblings."""
    return files.join(dirty.select("trade_type", "year").distinct(), ["trade_type", "year"], "left_semi")


def volume(files: DataFrame) -> DataFrame:
    """files and bytes of a year or a run (``size``)."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def restrict(dirty_years: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dirty years that were asked for, and those asked for that are clean."""
    keys = ["trade_type", "year"]
    return dirty_years.join(wanted, keys, "left_semi"), wanted.join(dirty_years, keys, "left_anti")


def dirty_workbooks(books: DataFrame, manifest: DataFrame, config_hash: str) -> DataFrame:
    """``books``: name, sha256, outputs_present; ``manifest``: name, workbook_hash, config_hash."""
    m = manifest.select(F.col("name").alias("m_name"), "workbook_hash", F.col("config_hash").alias("m_config"))
    both = books.join(m, F.col("name") == F.col("m_name"), "left")
    reason = F.when(F.col("m_name").isNull(), "new").when(F.col("m_config") != config_hash, "configuration").when(F.col("workbook_hash") != F.col("sha256"), "content").when(~F.col("outputs_present"), "output missing")
    return both.withColumn("reason", reason).where("reason IS NOT NULL").select(*books.columns, "reason")
