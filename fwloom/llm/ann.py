"""Operator 5: approximate nearest neighbours by an inverted file with product-quantised residuals.

Coarse centroids part the vectors into lists; what is left after the centroid is coded by product
quantisation, a byte for each sub-vector. A query probes its best lists and adds up asymmetric distance tables
(exact query part against coded part). Lists are tried in the order of what their best entry can score at most: the inner product with the centroid
and, for the longest residual in the list, the product of lengths; so long vectors, which lie far from every centroid, are tried first. The stored length of what the codes leave out bounds the error of that sum,
so every candidate that may be among the nearest of its block is scored again on the original vectors in double
precision: nothing in a probed list is lost to the quantisation. A query whose best lists hold too few entries
probes further ones. Nearness is the inner product.

Centroids and codebooks are fitted on at most ``SAMPLE`` vectors, chosen by a hash of their id; every row is
indexed. Equal vectors share one index entry with all its ids in the posting table, so a vector that a
third of all rows hold costs no more than any other; of its ids the smallest ``K + 1`` can appear in results.
Lists are cut into pieces of about ``INDEX_BLOCK`` entries and small lists are put together to blocks of that size
(fewer entries if vectors are long), the queries into blocks of ``QUERY_BLOCK``; a task holds one block of each and
gives the ``K + 1`` best for each query. Only lists' sizes and the model reach the driver.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor those
of another dimension than the commonest (the smaller of two as common); a row with a null vec_id takes no
part; rows with one vec_id are that query's own; ties go to the smaller vec_id; fewer candidates give fewer
rows; a very long vector is one row, and blocks hold fewer of them; extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fwloom.llm.common import materialize, table

K, QUERY_EVERY = 20, 20
SAMPLE, ROUNDS, SUB, CODES = 20_000, 12, 4, 256
MAX_LISTS = 4096
#: Share of the lists that a query probes.
PROBE_SHARE = 0.8
INDEX_BLOCK, QUERY_BLOCK, LEAST_QUERIES = 1 << 15, 1 << 14, 1 << 8
#: Numbers in the vectors of an index block.
BLOCK_NUMBERS = INDEX_BLOCK * 64
#: Rounding of sums, as a share of the lengths of both vectors.
ROUNDING = 1e-9


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from random rows; an empty cluster restarts at a random row."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centers)
        count = np.bincount(near, minlength=len(centers))
        total = np.zeros_like(centers)
        for c in range(x.shape[1]):
            total[:, c] = np.bincount(near, weights=x[:, c], minlength=len(centers))
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.integers(len(x), size=len(centers))])
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    norm = (centers * centers).sum(1)
    return np.concatenate([np.argmin(norm - 2 * part @ centers.T, axis=1) for part in np.array_split(x, max(1, len(x) // 4096))])


class Model:
    """Coarse centroids and one codebook for each sub-vector of ``SUB`` numbers (zeros fill the last)."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centers = kmeans(sample, lists, ROUNDS, 1)
        rest = self.parts(sample - self.centers[nearest(sample, self.centers)])
        self.books = np.stack([self.full(kmeans(rest[:, m], CODES, ROUNDS, 2 + m)) for m in range(rest.shape[1])])

    @staticmethod
    def full(book: np.ndarray) -> np.ndarray:
        return np.concatenate([book, np.repeat(book[:1], CODES - len(book), 0)]) if len(book) < CODES else book

    @staticmethod
    def parts(x: np.ndarray) -> np.ndarray:
        m = -(-x.shape[1] // SUB)
        return np.pad(x, ((0, 0), (0, m * SUB - x.shape[1]))).reshape(len(x), m, SUB)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes, the lengths of what the codes leave out, and of the whole residuals."""
        lists = nearest(x, self.centers)
        rest = self.parts(x - self.centers[lists])
        codes = np.stack([nearest(rest[:, m], self.books[m]) for m in range(rest.shape[1])], 1).astype(np.uint8)
        lost = rest - self.books[np.arange(rest.shape[1]), codes]
        return lists, codes, np.sqrt((lost * lost).sum((1, 2))), np.sqrt((rest * rest).sum((1, 2)))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of query sub-vectors with all codes."""
        return np.einsum("qms,mcs->qmc", self.parts(q), self.books)


    def probed(self, q: np.ndarray, sizes: np.ndarray, probes: int, least: int, reach: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of queries with centroids, and which lists they probe: the ``probes`` that can score highest by
        the lengths of their residuals (``reach``), and further ones while those hold fewer than ``least`` entries."""
        base = q @ self.centers.T
        order = np.argsort(-(base + np.sqrt((q * q).sum(1))[:, None] * reach), axis=1, kind="stable")
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        chosen = np.zeros(base.shape, bool)
        np.put_along_axis(chosen, order, (np.arange(base.shape[1]) < probes) | (before < least), 1)
        return base, chosen


def best_of_block(model: Model, q: np.ndarray, base: np.ndarray, chosen: np.ndarray, entry: np.ndarray, own: np.ndarray, code: np.ndarray, lost: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, entry and exact score of the ``keep`` best entries of a block for every query, ties to the smaller entry.

    The best by codes are scored exactly; the last of their scores is a floor under the true one, and whatever
    may reach it by its codes and ``lost`` is scored too.
    """
    tables, length = model.tables(q), np.sqrt((q * q).sum(1))
    near = base[:, own]
    for m in range(code.shape[1]):
        near += tables[:, m, :][:, code[:, m]]
    near[~chosen[:, own]] = -np.inf
    slack = ROUNDING * length * np.sqrt((x * x).sum(1)).max()
    head = min(keep, len(entry))
    best = np.argpartition(-near, head - 1, axis=1)[:, :head]
    first = np.einsum("qd,qkd->qk", q, x[best])
    first[np.isneginf(np.take_along_axis(near, best, 1))] = -np.inf
    floor = first.min(1) - slack if head == keep else np.full(len(q), -np.inf)
    may = ~(near + length[:, None] * lost < floor[:, None]) & chosen[:, own]
    columns = np.flatnonzero(may.any(0))
    exact = np.where(may[:, columns], q @ x[columns].T, -np.inf)
    if len(columns) > keep:
        edge = np.partition(exact, len(columns) - keep, axis=1)[:, len(columns) - keep]
        may[:, columns] &= ~(exact < (edge - slack)[:, None])
    at, column = np.nonzero(may)
    # The order of the sum decides ties, so it is the same for every pair.
    score = np.zeros(len(at))
    for d in range(q.shape[1]):
        score += q[at, d] * x[column, d]
    order = np.lexsort((entry[column], -score, at))
    at, column, score = at[order], column[order], score[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    return at[place < keep], entry[column[place < keep]], score[place < keep]


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one dimension as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v of the rows that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def blocks_of(sizes: dict[int, int], most: int) -> tuple[list[tuple[int, list[int]]], int]:
    """The blocks over which the entries of each list are dealt, and the number of blocks."""
    out, block, filled = [], 0, 0
    for name in sorted(sizes):
        pieces = math.ceil(sizes[name] / most)
        places = []
        for _ in range(pieces):
            size = sizes[name] / pieces
            if filled and filled + size > most:
                block, filled = block + 1, 0
            places.append(block)
            filled += size
        out.append((name, places))
    return out, block + 1


def search(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest of every query: rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors).distinct())
    entries = materialize(rows.groupBy("v").agg(F.min("vec_id").alias("entry")))
    first = Window.partitionBy("v").orderBy("vec_id")
    posting = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).join(entries, "v").select("entry", "vec_id")
    asked = rows.where(F.col("vec_id") % every == 0).join(entries, "v").select("vec_id", F.col("entry").alias("q"))
    total = entries.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if total == 0:
        return spark.createDataFrame([], schema)
    share = F.pmod(F.xxhash64("entry"), F.lit(total)) < SAMPLE
    sample = np.array([r["v"] for r in entries.where(share).orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).collect()] or [entries.first()["v"]])
    lists = max(1, min(MAX_LISTS, int(math.sqrt(total)), len(sample)))
    state = spark.sparkContext.broadcast(Model(sample, lists))
    probes = max(1, math.ceil(lists * PROBE_SHARE))

    def code(batches):
        for batch in batches:
            if len(batch):
                own, codes, lost, far = state.value.encode(matrix(batch.column(1)))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lost), pa.array(far)], ["entry", "v", "list", "codes", "lost", "far"])

    index = materialize(entries.select("entry", "v").mapInArrow(code, "entry long, v array<double>, list int, codes binary, lost double, far double"))
    queries = materialize(asked.select("q").distinct().join(entries, F.col("q") == F.col("entry")).select("q", "v"))
    # A row for each list at most.
    found = {r["list"]: r for r in index.groupBy("list").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    counted = {n: r["n"] for n, r in found.items()}
    sizes = np.array([counted.get(n, 0) for n in range(len(state.value.centers))])
    reach = np.array([found[n]["far"] if n in found else 0.0 for n in range(len(sizes))])
    places, i_blocks = blocks_of(counted, max(1, min(INDEX_BLOCK, BLOCK_NUMBERS // sample.shape[1])))
    asked_rows = queries.count()
    # The index moves once for each block of queries, so these are large, but not so large that cores have nothing to do.
    q_blocks = max(1, math.ceil(asked_rows / QUERY_BLOCK), min(math.ceil(asked_rows / LEAST_QUERIES), math.ceil(2 * spark.sparkContext.defaultParallelism / i_blocks)))
    places = F.broadcast(spark.createDataFrame(places, "list int, places array<int>"))
    at = F.pmod(F.xxhash64("entry"), F.size("places")).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    i_side = index.join(places, "list").select(F.get("places", at).alias("i"), all_of(q_blocks).alias("j"), "entry", "list", "codes", "lost", "v")
    q_side = queries.select(all_of(i_blocks).alias("i"), F.pmod(F.xxhash64("q"), F.lit(q_blocks)).cast("int").alias("j"), "q", "v")

    def scan(queries: pa.Table, codes: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(queries) and len(codes):
            model = state.value
            q, v = queries.column("q").to_numpy(), matrix(queries.column("v"))
            entry, own, lost, x = codes.column("entry").to_numpy(), codes.column("list").to_numpy(), codes.column("lost").to_numpy(), matrix(codes.column("v"))
            code = np.frombuffer(b"".join(codes.column("codes").to_pylist()), np.uint8).reshape(len(entry), -1)
            for s in range(0, len(q), 32):
                part = slice(s, s + 32)
                n, e, score = best_of_block(model, v[part], *model.probed(v[part], sizes, probes, k + 1, reach), entry, own, code, lost, x, k + 1)
                out.append((q[part][n], e, score))
        return pa.table({name: np.concatenate(x) for name, x in zip(["q", "entry", "score"], zip(*out))})

    exact = q_side.groupBy("i", "j").cogroup(i_side.groupBy("i", "j")).applyInArrow(scan, "q long, entry long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "entry")
    top = exact.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("q", "entry", "score")
    own = asked.select(F.col("vec_id").alias("query_id"), "q").distinct()
    found = top.join(posting, "entry").join(own, "q").where("vec_id <> query_id").select("query_id", "vec_id", "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


QUERIES = {"op5_ann": op5_ann}
ORACLE_SQL: dict[str, str] = {}
