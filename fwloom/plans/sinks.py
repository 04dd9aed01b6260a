"""Outputs of an ingest: partitioned Parquet, run manifests, quality log, merged schema."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom import storage
from fwloom.layouts import Layout, LayoutError
from fwloom.operators.catalog import columns_of, union_columns


STAGING, JOURNAL, TRASH = "_staging", "_journal", "_trash"


def stage_partitions(rows: DataFrame, routing: str, path: str, run: str, compression: str = "zstd", order: str | None = None) -> DataFrame | None:
    """Writes ``rows`` by month beside the table, unseen by readers; what was written, None if nothing.

    ``REBALANCE`` deals rows by month but splits months that are large, so a month with a third of all rows
    is written by many tasks.
    """
    if {"year", "month"} & set(rows.columns):
        raise LayoutError("year and month name partitions; layouts must not have columns of that name")
    dated = rows.withColumns({"year": F.date_format(routing, "yyyy"), "month": F.date_format(routing, "MM")})
    dealt = dated.hint("rebalance", F.col("year"), F.col("month"))
    if order:
        dealt = dealt.sortWithinPartitions("year", "month", order).drop(order)
    spark, staged = rows.sparkSession, f"{path}/{STAGING}/{run}"
    dealt.write.mode("overwrite").option("compression", compression).partitionBy("year", "month").parquet(staged)
    return spark.read.schema(dealt.schema).parquet(staged) if months_of(storage.Folders(spark), staged) else None


def months_of(folders: storage.Folders, staged: str) -> list[str]:
    return [f"{y}/{m}" for y in folders.names(staged) if y.startswith("year=") for m in folders.names(f"{staged}/{y}")]


def switch(spark: SparkSession, path: str, run: str) -> None:
    """Puts the staged months of a run in the place of older ones.

    Until the run's mark is in the journal nothing of the table has changed; from then on whoever comes next finishes the switch
    (``recover``), since a month that is still staged has not been switched: so a lost driver leaves all months old or all new.
    """
    folders, staged = storage.Folders(spark), f"{path}/{STAGING}/{run}"
    mark = f"{path}/{JOURNAL}/{run}"
    if not folders.exists(mark):
        folders.touch(mark)
    for month in months_of(folders, staged):
        if folders.exists(f"{path}/{month}"):
            folders.move(f"{path}/{month}", f"{path}/{TRASH}/{run}/{month}")
        folders.move(f"{staged}/{month}", f"{path}/{month}")
    folders.delete(staged)
    folders.delete(mark)
    folders.delete(f"{path}/{TRASH}/{run}")


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finishes switches that a lost driver began, and drops what runs staged and never switched; a table has one writer at a time.

    The runs whose switch was finished.
    """
    folders = storage.Folders(spark)
    begun = folders.names(f"{path}/{JOURNAL}")
    for run in begun:
        switch(spark, path, run)
    for place in (STAGING, TRASH):
        folders.delete(f"{path}/{place}")
    return begun


def write_partitions(rows: DataFrame, routing: str, path: str, compression: str = "zstd", order: str | None = None) -> None:
    """Replaces the months that ``rows`` has, all or none, and leaves the others."""
    run = uuid.uuid4().hex
    if stage_partitions(rows, routing, path, run, compression, order) is not None:
        switch(rows.sparkSession, path, run)
    else:
        storage.Folders(rows.sparkSession).delete(f"{path}/{STAGING}/{run}")


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A written table; columns are merged over layout versions, filters on year and month prune folders."""
    return spark.read.option("mergeSchema", True).parquet(path)


def partition_counts(written: DataFrame) -> DataFrame:
    return written.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count("*").alias("rows"))


def append_json(rows: DataFrame, folder: str) -> None:
    """Lines of JSON in a folder of their own; nulls are kept."""
    rows.write.mode("append").option("ignoreNullFields", False).json(folder)


def write_schema(spark: SparkSession, layouts: list[Layout], path: str, trade_type: str) -> bool:
    """``_dataset_schema.json`` of all versions; nothing without layouts or with conflicting dtypes."""
    if not layouts:
        return False
    try:
        merged = union_columns(columns_of(spark, layouts))
    except LayoutError:
        return False
    body = {"trade_type": trade_type, "generated_at": datetime.now(UTC).isoformat(timespec="seconds"), "spec_versions": sorted(x.version for x in layouts), "columns": [r.asDict() for r in merged.collect()]}
    storage.write_text(f"{path}/_dataset_schema.json", json.dumps(body, indent=2, sort_keys=True))
    return True
