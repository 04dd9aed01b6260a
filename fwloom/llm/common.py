"""Shared helpers of the corpus operators: inputs, written intermediate tables, hashing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch handed to Python. Texts may be long, so batches stay short.
ARROW_ROWS = 1024
DEFAULT_ARROW_ROWS = "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table; only Spark's reader opens the path.

    Arrow batches of this session stay short, unless it has a number of its own for them.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == DEFAULT_ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is empty and the master is local (tests on one machine) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="fwloom-"))
    path = f"{base.rstrip('/')}/fwloom-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


#: Folders that stand in for the shared one, by application.
_LOCAL: dict[str, str] = {}
#: Folders of tables written by ``materialize``, by the identity of their DataFrame.
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate files, if it is still there."""
    try:
        jvm, hadoop = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)
    except Exception:  # the session is gone: the folder is left to the owner of the checkpoint folder
        pass


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back.

    This cuts the lineage: a lost executor costs tasks that read these files, never the work before.
    """
    path = shared_dir(df.sparkSession)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes the files of materialized frames that no later job reads."""
    for df in frames:
        path = _WRITTEN.pop(df, None)
        if path:
            delete(df.sparkSession, path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers (splitmix64's finaliser)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
