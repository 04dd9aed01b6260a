"""Operator 11: ranked lexical search by Fagin's threshold algorithm.

Documents are ranked for each item by a sum of term weights, all of it in whole numbers (``weights`` and ``impacts``).

The corpus is an index in pieces, one for each run of documents that a task reads: a forward index (terms and
frequencies of each document, only terms that some item has) and, made from it in the task, a list for each term
with the documents in falling order of impact. For an item the lists of its terms are read in turn, to the same
depth each. A document that turns up is scored in full through the forward index. No document below the depth can
score more than the sum of the impacts at the depth, the threshold; once that is strictly below the k-th best
score, the piece is done. The best scores pass from piece to piece within a task, so later pieces stop earlier, and a task gives at
most ``k`` documents for each item. Texts and lists never move; what is shuffled is a few rows for each task and item.

Tokens are cut in one pass over the bytes of the texts: every byte of a letter beyond ASCII is above 0x7F, so UTF-8
bytes and characters give the same terms.

Items go in blocks of about ``BLOCK_TERMS`` terms, each with an index of its own, so what a task is told (terms,
weights) is bounded however many items there are. Statistics cover all documents.

Defined results: null and empty texts, and those without a term, count nowhere; an item's rows are put together if
several share its id, equal rows once; a null item_id is an item; each row of documents is a document, so repeated rows
are ranked one after the other; a null doc_id comes before others in ties; very long texts are one row of the forward
index; an item without terms, or whose terms no document has, gives no rows; extra columns are dropped; empty tables
give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fwloom.llm.common import materialize, release, table

K = 10
#: Terms, repeats included, of the items that share an index.
BLOCK_TERMS = 200_000
#: Postings of a piece of the index, and the depth to which lists are read first; it doubles from there.
PIECE, DEPTH = 1 << 20, 16
RESULT = "item_id long, rank int, doc_id long, score long"
FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"

#: Bytes of terms stay, with A-Z lower-cased; all others part terms.
BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    # Above ASCII no byte is white space to bytes.split.
    return text.translate(BYTES).split()


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """What a term with frequency ``tf`` adds to the score of a document of ``n`` terms."""
    m = 100 - 75 + (75 * n * documents) // tokens
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``FORWARD``: of every document with a term its length, and the numbers and frequencies of the known terms."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = known.value.get, len(known.value)
        for batch in batches:
            ids, lengths = [], []
            for text in batch.column(1):
                words = terms_of(text.as_py() or b"")
                lengths.append(len(words))
                ids.append(np.fromiter(map(number, words, repeat(-1)), np.int64, len(words)))
            if not lengths:
                continue
            flat, own = np.concatenate(ids), np.repeat(np.arange(len(lengths)), lengths)
            keys, tfs = np.unique((own * size + flat)[flat >= 0], return_counts=True)
            starts = np.searchsorted(keys, np.arange(len(lengths) + 1) * size).astype(np.int32)
            of = lambda values: pa.ListArray.from_arrays(pa.array(starts), pa.array(values.astype(np.int32)))
            out = pa.record_batch([batch.column(0), pa.array(lengths, pa.int64()), of(keys % max(size, 1)), of(tfs)], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.compute.greater(out.column("n"), 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, FORWARD)


class Piece:
    """A piece of the index: documents with their forward rows, and lists in falling order of impact."""

    def __init__(self, doc: np.ndarray, starts: np.ndarray, terms: np.ndarray, impact: np.ndarray, vocabulary: int):
        self.doc, self.starts, self.terms, self.impact = doc, starts, terms, impact
        order = np.lexsort((-impact, terms))
        own = np.repeat(np.arange(len(doc)), np.diff(starts))
        self.listed, self.falling = own[order], impact[order]
        self.lists = np.searchsorted(terms[order], np.arange(vocabulary + 1))

    def lookup(self, rows: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Full scores of documents, through the forward index; ``times`` has how often the item holds each term."""
        length = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends + length, length)
        sums = np.concatenate([[0], np.cumsum(times[self.terms[at]] * self.impact[at])])
        return sums[ends] - sums[ends - length]


class Best:
    """The ``k`` best (score, doc) so far; of equal scores the smaller doc."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        may = score > 0 if len(self.score) < self.k else score >= self.score[-1]
        if may.any():
            score, doc = np.concatenate([self.score, score[may]]), np.concatenate([self.doc, doc[may]])
            order = np.lexsort((doc, -score))[: self.k]
            self.score, self.doc = score[order], doc[order]

    def floor(self) -> int:
        """The k-th score, or 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0


def threshold_search(piece: Piece, terms: np.ndarray, often: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Adds to ``best`` what a piece holds for an item with ``terms``, each ``often``; the number of documents scored.

    ``times`` is ``often`` by term number. Nothing is left out that could be among the best.
    """
    first, last = piece.lists[terms], piece.lists[terms + 1]
    seen, depth, reach, scored = np.zeros(len(piece.doc), bool), 0, DEPTH, 0
    while True:
        parts = [piece.listed[a + depth : min(a + reach, b)] for a, b in zip(first, last) if a + depth < b]
        if not parts:
            return scored
        fresh = np.zeros(len(piece.doc), bool)
        fresh[np.concatenate(parts)] = True
        rows = np.flatnonzero(fresh & ~seen)
        seen |= fresh
        if len(rows):
            best.add(piece.lookup(rows, times), piece.doc[rows])
            scored += len(rows)
        below = first + reach - 1 < last
        if int((often * np.where(below, piece.falling[np.minimum(first + reach - 1, last - 1)], 0)).sum()) < max(best.floor(), 1):
            return scored
        depth, reach = reach, 2 * reach


def search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int) -> DataFrame:
    """item_id, doc_id, score: for each item the ``k`` best of every task."""
    spark = docs.sparkSession
    vocabulary = {t: n for n, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    forward = materialize(forward_index(docs, vocabulary))
    total = forward.agg(F.count("*").alias("documents"), F.sum("n").alias("tokens")).first()
    documents, tokens = total["documents"], total["tokens"] or 1
    df = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each term of the block at most
        df[r["t"]] = r["count"]
    weight = weights(df, documents)
    asked = [(i, np.array([vocabulary[t] for t in terms], np.int64), np.array([*terms.values()], np.int64)) for i, terms in items]
    state = spark.sparkContext.broadcast((weight, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, asked = state.value
        best = [Best(k) for _ in asked]

        def search(held: list[pa.RecordBatch]) -> None:
            part = pa.Table.from_batches(held).combine_chunks()
            doc = part.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
            terms, tfs = (part.column(c).combine_chunks() for c in ("terms", "tfs"))
            sizes = terms.value_lengths().to_numpy()
            terms, tfs = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
            impact = impacts(weight[terms], tfs, np.repeat(part.column("n").to_numpy(), sizes), documents, tokens)
            piece = Piece(doc, np.concatenate([[0], np.cumsum(sizes)]), terms, impact, len(weight))
            times = np.zeros(len(weight), np.int64)
            for n, (_, own, often) in enumerate(asked):
                times[own] = often
                there = piece.lists[own] < piece.lists[own + 1]
                threshold_search(piece, own[there], often[there], times, best[n])
                times[own] = 0

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten())
            if size >= PIECE:
                search(held)
                held, size = [], 0
        if size:
            search(held)
        found = [(i, int(d), int(s)) for (i, _, _), b in zip(asked, best) for d, s in zip(b.doc, b.score)]
        docs_of = [None if d == np.iinfo(np.int64).min else d for _, d, _ in found]
        yield pa.record_batch([pa.array([i for i, _, _ in found], pa.int64()), pa.array(docs_of, pa.int64()), pa.array([s for _, _, s in found], pa.int64())], ["item_id", "doc_id", "score"])

    out = materialize(forward.mapInArrow(run, "item_id long, doc_id long, score long"))
    release(forward)
    return out


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``RESULT``: the ``k`` best documents (doc_id, text) for each item (item_id, text), by falling score, then doc_id."""
    spark = docs.sparkSession
    text = F.col("text").cast("string").cast("binary")
    rows = materialize(items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).where(F.octet_length("text") > 0).distinct())
    # A term takes two bytes at least, with the byte that parts it from the next.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / block_terms))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        own: dict[int | None, Counter] = {}
        for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():  # about block_terms terms
            own.setdefault(r["item_id"], Counter()).update(terms_of(bytes(r["text"])))
        if any(own.values()):
            found = found.unionByName(search_block(docs, [(i, c) for i, c in own.items() if c], k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The characters that part terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERMS_SQL = f"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}'))"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), t AS (SELECT r, doc_id, {TERMS_SQL} AS term FROM d),
f AS (SELECT r, doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY r) AS n FROM t GROUP BY r, doc_id, term),
a AS (SELECT cast(count(DISTINCT r) AS bigint) AS docs, cast(count(*) AS bigint) AS tokens FROM t),
w AS (SELECT term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1))) AS bigint) AS w FROM f, a GROUP BY term, docs),
q AS (SELECT item_id, {TERMS_SQL} AS term FROM benchmark), c AS (SELECT item_id, term, count(*) AS c FROM q GROUP BY 1, 2),
s AS (SELECT item_id, r, doc_id, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + cast((75 * n * docs) // tokens AS bigint))))) AS bigint) AS score
  FROM c JOIN w USING (term) JOIN f USING (term), a GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM k WHERE rank <= {K}
"""

QUERIES = {"op11_lexical": op11_lexical}
ORACLE_SQL = {"op11_lexical": SQL}
