"""Operator 10: sharding along a Hilbert curve.

Several metadata dimensions are quantised, each to the same number of bits, and joined to one index on the
Hilbert curve. Rows are ranked by that index and the ranking is cut into runs, so a shard covers a compact
box of every dimension and readers that filter on any of them can skip whole files by their statistics.

Law ``rows``: shard counts differ by one at most. The ranking is a range shuffle of narrow rows without text,
then a number within each range plus the sizes of the ranges before it; no task sees more than its range.
Ties on the curve are broken by doc_id, the text's checksum and the row's place, so a heavy cell is split like any other, fully equal rows too.

Quantisation: numbers by the table's own approximate quantiles; strings by cut points in their sort order,
taken from a range partitioning of the distinct values. Both give at most ``2**BITS - 1`` cuts.

Defined results: a null text has size 8 and the checksum of nothing; nulls of a dimension come first; fully
equal rows share out neighbouring slots in any order; extra columns are dropped (``write_shards`` keeps them; one
named ``shard`` is an error, as the folders need that name); an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fwloom.llm.common import materialize, table

SHARDS = 24
BITS = 6
ROW_BYTES = 8
RESULT = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of rows of ``cells``, each below ``2**bits``: Skilling's transpose form, by columns."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations from the coarsest level on
        low = bit - 1
        for i in range(dims):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> level) & 1
    return out


def string_cuts(df: DataFrame, column: str, cells: int) -> list[str]:
    """At most ``cells - 1`` values that part the distinct values of ``column`` into runs of about the same size."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    parts = values.repartitionByRange(cells, column).groupBy(F.spark_partition_id()).agg(F.min(column).alias("least"))
    return sorted(row["least"] for row in parts.collect())[1:cells]


def number_cuts(df: DataFrame, columns: list[str], cells: int) -> dict[str, list[float]]:
    """Quantiles of each numeric column, over all rows."""
    steps = [i / cells for i in range(1, cells)]
    if not columns:
        return {}
    row = df.agg(*(F.percentile_approx(F.col(c).cast("double"), steps, 10_000).alias(c) for c in columns)).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def ranked(df: DataFrame, dimensions: list[str], ties: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``rank``, a gapless long from 0 in the order of the curve; ``df`` must hold narrow rows."""
    cells = 2**bits
    kinds = dict(df.dtypes)
    text = [c for c in dimensions if kinds[c] == "string"]
    cuts: dict[str, list] = {c: string_cuts(df, c, cells) for c in text} | number_cuts(df, [c for c in dimensions if c not in text], cells)
    names = df.columns

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for c in dimensions:
                values, edges = batch.column(names.index(c)), cuts[c]
                if kinds[c] == "string":
                    # UTF-8 bytes sort as Spark sorts strings.
                    keys = np.array([b"" if v is None else v.encode() for v in values.to_pylist()], dtype=object)
                    edges = np.array([e.encode() for e in edges], dtype=object)
                else:
                    keys = np.nan_to_num(values.cast(pa.float64()).to_numpy(zero_copy_only=False), nan=-np.inf)
                    edges = np.array(edges, dtype=np.float64)
                columns.append(np.searchsorted(edges, keys, "right") if len(edges) else np.zeros(len(keys), np.int64))
            index = hilbert_index(np.stack(columns, 1), bits) if len(batch) else np.zeros(0, np.int64)
            yield pa.record_batch([*batch.columns, pa.array(index, pa.int64())], [*names, "curve"])

    curved = materialize(df.mapInArrow(index, df.select("*", F.lit(0).cast("long").alias("curve")).schema))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = curved.withColumn("__tie", F.monotonically_increasing_id())
    ordered = told.repartitionByRange(n, "curve", *ties, "__tie").sortWithinPartitions("curve", *ties, "__tie").drop("__tie")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            nth = np.arange(at, at + len(batch))
            at += len(batch)
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(batch), part), pa.int64()), pa.array(nth, pa.int64())], [*names, "curve", "part", "nth"])

    numbered = materialize(ordered.mapInArrow(number, curved.select("*", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("nth")).schema))
    # A row for each range, so a single window over them stays small.
    sizes = numbered.groupBy("part").agg((F.max("nth") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return numbered.join(base, "part").withColumn("rank", F.col("base") + F.col("nth")).select(*names, "curve", "rank")


def shards(docs: DataFrame, count: int = SHARDS, dimensions: tuple[str, ...] = ("lang", "source", "size"), keep: tuple[str, ...] = ()) -> DataFrame:
    """``RESULT`` for ``docs`` (doc_id, text and the dimensions; ``size`` is made here), and the columns to ``keep``."""
    own = [c for c in dimensions if c != "size"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *own,
        *keep,
    )
    narrow = materialize(narrow)
    total = narrow.count()
    rows = ranked(narrow, list(dimensions), ["doc_id", "text_crc32"])
    shard = F.expr(f"((rank + 1) * {count} - 1) div {max(total, 1)}")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("rank") - F.expr(f"({shard_start('rank', count, total)})")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *keep,
    )


def shard_start(rank: str, count: int, total: int) -> str:
    """SQL for the first rank in the shard of ``rank``."""
    total = max(total, 1)
    return f"((({rank} + 1) * {count} - 1) div {total}) * {total} div {count}"


def write_shards(docs: DataFrame, path: str, dimensions: tuple[str, ...] = ("lang", "source", "size"), **options) -> None:
    """Writes whole rows as Parquet folders, one for each shard, in the order of the curve.

    Rows are numbered first and meet their shard by that number, so repeated rows keep the law too.
    """
    if "shard" in docs.columns:
        raise ValueError("a column named shard clashes with the folders of the shards")
    numbered = materialize(docs.withColumn("__row", F.monotonically_increasing_id()))
    placed = shards(numbered, dimensions=dimensions, keep=("__row",), **options).select("__row", F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    rows = numbered.join(placed, "__row").repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
    rows.select(*(F.col(f"`{c}`") for c in docs.columns), F.col("__shard").alias("shard")).write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


QUERIES = {"op10_sharding": op10_sharding}
ORACLE_SQL: dict[str, str] = {}
