"""Operator 12: line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

Documents come in batches of rising doc_id. The store of lines seen so far is a few *runs*: tables of 128-bit line hashes,
hashed to buckets and sorted in them, no hash in two runs. A batch's own hashes are grouped (to the smallest doc_id
that holds each), joined against the runs without moving these, and what is new becomes a run itself. Once ``FANOUT``
runs stand on a level they are merged to one of the next level, so a batch meets few runs and a hash is rewritten once a level.

A line goes if a run has its hash or a smaller document of its batch does. That decision is made on a line's hash,
position and document alone; texts move once, to meet the positions of their dropped lines. Hot lines are counted
before they move, and the join that marks a batch's lines is one that adaptive execution splits where a hash is hot; it
gets only hashes that drop something.

Hashes are two of 64 bits with seeds of their own: among 10^12 lines two differ and collide with a chance of 2e-15.

Defined results: a null or empty text is one empty line; lines of under ``LEAST`` code points always stay; rows
with one doc_id count as one document, null being the smallest id; repeated rows come out as often as they came in;
a long text is one array of its lines in one row; extra columns are dropped, also where they have names used here; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import delete, materialize, release, shared_dir, table

LEAST = 10
BATCHES, FANOUT = 6, 3
#: White space that keys lose at their ends.
BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
RESULT = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
FIRST = -(2**63)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def hashed(docs: DataFrame) -> DataFrame:
    """d, t (hash of the text), pos, h1, h2 of every line that may go."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("d"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keys = rows.select("d", "t", "pos", key_of(F.col("line")).alias("key")).where(F.char_length("key") >= LEAST)
    return keys.select("d", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("2"), "key").alias("h2"))


class Runs:
    """The lines seen so far: levels of runs, the youngest and smallest at level 0.

    A run is a bucketed table, sorted within its buckets, with the hashes of a batch: ``first`` and ``last`` document that
    holds each, and ``seen`` for those that an older run has. Merged runs have only the hashes.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, hashes: DataFrame) -> tuple[str, str]:
        """The name and folder of a new table."""
        name, path = f"fwloom_run_{uuid.uuid4().hex}", shared_dir(self.spark)
        hashes.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        return name, path

    def drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        delete(self.spark, run[1])

    def hashes(self, run: tuple[str, str]) -> DataFrame:
        return self.spark.table(run[0]).where("NOT seen").select(*HASH)

    def add(self, hashes: DataFrame) -> DataFrame:
        """Merge-joins a batch (h1, h2 once each, first, last) with the runs and adds it; the batch with ``seen``.

        Hashes are dealt out as the runs are, so a join moves and sorts no run.
        """
        flags = []
        for level in self.levels:
            for run in level:
                flags.append(f"in{len(flags)}")
                hashes = hashes.join(self.hashes(run).withColumn(flags[-1], F.lit(True)).hint("merge"), HASH, "left")
        run = self.write(hashes.select(*HASH, "first", "last", F.coalesce(*flags, F.lit(False)).alias("seen")))
        self.levels[0].append(run)
        # Read as plain files: joins that follow may deal it out as they need.
        return self.spark.read.schema(self.spark.table(run[0]).schema).parquet(run[1])

    def compact(self) -> None:
        """Merges the runs of full levels; what ``add`` returned must have been used."""
        for n, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            merged = self.hashes(level[0])
            for run in level[1:]:
                merged = merged.unionByName(self.hashes(run))
            one = self.write(merged.repartition(self.buckets, *HASH).withColumn("seen", F.lit(False)))
            for run in level:
                self.drop(run)
            self.levels[n] = []
            if n + 1 == len(self.levels):
                self.levels.append([])
            self.levels[n + 1].append(one)

    def close(self) -> None:
        for level in self.levels:
            for run in level:
                self.drop(run)
        self.levels = [[]]


def admit(runs: Runs, lines: DataFrame) -> DataFrame:
    """Adds a batch to the runs; d, t, pos of its lines that go, as a written table. ``lines``: d, t, pos, h1, h2.

    Documents of a batch are taken as later than those of all batches before.
    """
    batch = runs.add(lines.groupBy(*HASH).agg(F.min("d").alias("first"), F.max("d").alias("last")))
    # Of a hash in older runs no line stays, of another those of the smallest document.
    drops = batch.where("seen OR last > first").select(*HASH, F.when(~F.col("seen"), F.col("first")).alias("first"))
    dropped = lines.join(drops, HASH).where("first IS NULL OR d > first").select("d", "t", "pos")
    out = materialize(dropped)
    runs.compact()
    return out


def cuts_of(docs: DataFrame, batches: int) -> list[int]:
    """At most ``batches - 1`` ids that part the documents into runs of about the same number."""
    ids = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [n / batches for n in range(1, batches)], 10_000)).first()[0]
    return sorted(set(ids or []))


def dropped_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """d, t, pos of all lines that go."""
    cuts = cuts_of(docs, batches)
    number = sum((F.when(F.col("d") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    lines = materialize(hashed(docs).withColumn("batch", number))
    runs, out = Runs(docs.sparkSession, fanout), None
    try:
        for batch in range(len(cuts) + 1):
            gone = admit(runs, lines.where(F.col("batch") == batch).drop("batch"))
            out = gone if out is None else out.unionByName(gone)
    finally:
        runs.close()
    release(lines)
    return out


def kept_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, lines (array), gone (sorted positions of dropped lines) of every row of ``docs``."""
    gone = dropped_lines(docs, batches, fanout).groupBy("d", "t").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))
    both = rows.join(gone, ["d", "t"], "left")
    return both.select("doc_id", F.split("text", "\n").alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))


def kept_text(lines: str = "lines", gone: str = "gone") -> Column:
    """The lines between dropped ones, joined; linear in the lines."""
    edges = F.expr(f"transform(sequence(0, size({gone})), i -> struct(if(i = 0, 0, {gone}[i - 1] + 1) AS a, if(i = size({gone}), size({lines}), {gone}[i]) AS b))")
    runs = F.transform(edges, lambda e: F.slice(F.col(lines), e["a"] + 1, e["b"] - e["a"]))
    return F.when(F.size(gone) == 0, F.array_join(lines, "\n")).otherwise(F.array_join(F.flatten(runs), "\n"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id and text without the lines that an earlier document holds."""
    return kept_lines(docs, batches, fanout).select("doc_id", kept_text().alias("text"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), F.sha2(kept_text(), 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS d, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, d, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(d) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT r, pos, line, coalesce(length(k.key) >= 10 AND d > first, false) AS gone FROM k LEFT JOIN f USING (key)),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, cast(n_lines AS bigint) AS n_lines, cast(n_dropped AS bigint) AS n_dropped, sha256(kept) AS kept_sha256 FROM g JOIN d USING (r)
"""

QUERIES = {"op12_lines": op12_lines}
ORACLE_SQL = {"op12_lines": SQL}
