"""Operator 2: near-duplicate classes by BagMinHash.

A document is the multiset of its five-word shingles. Its signature has ``REGISTERS`` registers. For every
shingle, Poisson processes run over discretised weights: the weight axis is parted into dyadic shells
(0,1], (1,2], (2,4], ..., each with a process of its own whose points carry a time, a register and a level;
a point counts if its level is within the shingle's weight. A register keeps its first point, so two
signatures agree in a register with probability equal to the weighted Jaccard similarity, without bias. A
process ends once its time has passed all registers of the document, hence few points a shingle.

1. Exact copies fold onto the first document of each text, by an aggregation that combines before it moves.
2. Bands of the signature deal out documents. Four registers a band and 32 bands miss a pair at similarity
   0.8 with a chance of 5e-8.
3. Each document is verified against one leader, the smallest id it meets most often; verified links make
   classes. That settles most members of even the largest groups with one comparison each.
4. What still meets in a bucket in different classes is compared pair by pair inside the bucket: signatures
   first (a pair at 0.8 agrees in under ``LEAST_AGREE`` of 128 registers with a chance of 1e-7), then the
   multisets themselves. The largest class of a bucket is dealt out once, in blocks of at most ``BLOCK``
   documents and ``BLOCK_BYTES`` bytes of text; the other documents go to every block, and meet each other in
   blocks of their own. So a million copies and one stray cost a million rows, not their product. A pair of
   documents is handled in the first band they share. Only links that join classes leave a task, never all pairs.
5. Connected components give the class; its id is its smallest doc_id.

No link, component or signature is collected to the driver.

Defined results: null, empty and wordless texts are no near-duplicates of others (equal wordless texts other
than blank ones are exact copies); a text under five words is one shingle of all its words; rows that repeat id
and text are one document, of which ``keep_one`` keeps one row; a null doc_id, and one that stands over different
texts, gets a negative stand-in made from the text's hash, so no text passes for another; repeated rows repeat;
extra columns are dropped (``keep_one`` keeps all, whatever their names); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import materialize, mix64, release, table

WORDS, THRESHOLD = 5, 0.8
REGISTERS, BANDS = 128, 32
ROWS = REGISTERS // BANDS
#: Registers that two signatures must share for their documents to be compared in a bucket.
LEAST_AGREE = 79
#: Documents of a bucket that one task compares with each other or with those of another block.
BLOCK, BLOCK_BYTES = 400, 16 << 20
MEMO_WORDS = 300_000
WORD = re.compile(r"\w+")
SIGNED = "d long, size long, signature binary, bands array<long>"
FIRST_STAND_IN, STAND_INS = -(2**62), 2**61


class Shingler:
    """Hashed shingles of a text with their counts."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def word(self, word: str) -> int:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            found = self.memo[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def bag(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = WORD.findall(text.lower())
        if not words:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.fromiter(map(self.word, words), np.uint64, len(words))
        n = max(1, len(h) - WORDS + 1)
        out = np.zeros(n, np.uint64)
        for i in range(min(WORDS, len(h))):
            out = mix64(out ^ h[i : i + n])
        return np.unique(out, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Ids of the first points, one row of ``REGISTERS`` for each bag."""
    n = len(bags)
    sizes = [len(b[0]) for b in bags]
    element = np.concatenate([b[0] for b in bags]) if n else np.zeros(0, np.uint64)
    weight = np.concatenate([b[1] for b in bags]) if n else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), sizes)
    first, ids = np.full(n * REGISTERS, np.inf), np.zeros(n * REGISTERS, np.uint64)
    seeds, owners, weights, lows, widths = [], [], [], [], []
    shell, low, width = 0, 0, 1
    own = np.arange(len(element))
    while len(own):
        seeds.append(mix64(element[own] ^ mix64(np.full(len(own), shell + 1, np.uint64))))
        owners.append(owner[own])
        weights.append(weight[own])
        lows.append(np.full(len(own), low))
        widths.append(np.full(len(own), width))
        shell, low, width = shell + 1, low + width, max(1, low + width)
        own = own[weight[own] > low]
    if not seeds:
        return ids.reshape(n, REGISTERS)
    seed, owner, weight, low, width = map(np.concatenate, (seeds, owners, weights, lows, widths))
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        step += 1
        x = mix64(seed + np.full(1, step, np.uint64) * np.uint64(0xA24BAED4963EE407))
        y = mix64(x)
        time = time - np.log1p(-(x >> np.uint64(11)).astype(np.float64) / 2**53) / width
        register = (y & np.uint64(REGISTERS - 1)).astype(np.int64)
        level = low + 1 + ((y >> np.uint64(32)).astype(np.int64) * width >> 32)
        inside = level <= weight
        at, t = (owner * REGISTERS + register)[inside], time[inside]
        np.minimum.at(first, at, t)
        best = first[at] == t
        ids[at[best]] = x[inside][best]
        going = time < first.reshape(n, REGISTERS).max(axis=1)[owner]
        seed, owner, weight, low, width, time = (c[going] for c in (seed, owner, weight, low, width, time))
    return ids.reshape(n, REGISTERS)


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(x[1][i], y[1][j]).sum())
    return both / max(1, int(x[1].sum() + y[1].sum()) - both)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with __text, __sha of the text and __d, a number for the document (never null)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("__text", text).withColumn("__sha", F.sha2("__text", 256))
    rows = rows.withColumn("__d", F.coalesce(F.col("doc_id").cast("long"), stand_in(0)))
    # Blank texts are no copies of each other.
    return rows.withColumn("__sha", F.when(F.col("__text").rlike(r"^\s*$"), F.concat(F.lit("blank "), F.col("__d").cast("string"))).otherwise(F.col("__sha")))


def stand_in(salt: int) -> Column:
    return F.lit(FIRST_STAND_IN) - F.pmod(F.xxhash64(F.lit(salt), "__sha"), F.lit(STAND_INS))


class Documents(NamedTuple):
    """Rows (``keyed``) whose __d stands for one text each; the first document of every text; whether rows repeat."""

    rows: DataFrame
    firsts: DataFrame
    repeats: bool


def documents(docs: DataFrame) -> Documents:
    """Numbers over different texts give way to stand-ins, until every number stands for one text."""
    rows, salt = keyed(docs), 0
    while True:
        held = materialize(rows.groupBy(F.col("__d").alias("d"), F.col("__sha").alias("sha")).agg(F.count("*").alias("times")))
        clash = held.groupBy("d").count().where("count > 1").select(F.col("d").alias("__clash"))
        clash = materialize(clash)
        if clash.isEmpty():
            break
        salt += 1
        rows = rows.join(clash, F.col("__d") == F.col("__clash"), "left").withColumn("__d", F.when(F.col("__clash").isNotNull(), stand_in(salt)).otherwise(F.col("__d"))).drop("__clash")
        release(held)
    firsts = materialize(held.groupBy("sha").agg(F.min("d").alias("d")))
    repeats = not held.where("times > 1").isEmpty()
    release(held)
    return Documents(rows, firsts, repeats)


def signed(texts: DataFrame) -> DataFrame:
    """``SIGNED`` of (d, text); documents without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            ids, sizes, bags = [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bag = shingler.bag(text)
                if len(bag[0]):
                    ids.append(d)
                    sizes.append(len(text))
                    bags.append(bag)
            points = signatures(bags)
            keys = np.full((len(ids), BANDS), 0, np.uint64)
            for r in range(ROWS):
                keys = mix64(keys ^ points[:, r::ROWS])
            keys = mix64(keys + np.arange(BANDS, dtype=np.uint64))
            short = (points & np.uint64(0xFFFF)).astype("<u2")
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array([s.tobytes() for s in short], pa.binary()), pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))], ["d", "size", "signature", "bands"])

    return texts.select("d", "text").mapInArrow(run, SIGNED)


def components(links: DataFrame) -> DataFrame:
    """d and its class, the smallest id it is connected with, for ids in ``links`` (x, y).

    Alternating large-star and small-star rounds; each is written, so no plan grows.
    """
    links = materialize(links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    before = None
    while True:
        both = links.union(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("m", "x").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y").distinct()
        down = large.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
        down = materialize(down)
        release(links)
        least = down.groupBy("x").agg(F.min("y").alias("m"))
        joined = down.join(least, "x")
        small = joined.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")).union(least.select("x", F.col("m").alias("y")))
        links = materialize(small.where("x <> y").distinct())
        release(down)
        state = tuple(links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("x", "y").cast("decimal(20,0)")), F.lit(0)).cast("string")).first())
        if state == before:
            return links.groupBy(F.col("x").alias("d")).agg(F.min("y").alias("class"))
        before = state


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of (x, y), those whose texts are near-duplicates."""
    one, two = texts.select(F.col("d").alias("x"), F.col("text").alias("x_text")), texts.select(F.col("d").alias("y"), F.col("text").alias("y_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        last: tuple = (None, None)
        for batch in batches:
            x, y = [], []
            for a, b, s, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last[0] != t:
                    last = (t, shingler.bag(t))
                if similarity(shingler.bag(s), last[1]) >= THRESHOLD:
                    x.append(a)
                    y.append(b)
            yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    return pairs.join(one, "x").join(two, "y").select("x", "y", "x_text", "y_text").mapInArrow(run, "x long, y long")


def agreeing(signature: np.ndarray, keys: np.ndarray, label: np.ndarray, block: np.ndarray, band: int, i: int, j: int) -> np.ndarray:
    """Pairs (a < b) of different classes that agree in enough registers and share no earlier band."""
    n = len(label)
    mask = label[:, None] != label[None, :]
    mask &= (block[:, None] == i) & (block[None, :] == j) if i != j else np.triu(np.ones((n, n), bool), 1)
    for b in range(band):
        mask &= keys[:, None, b] != keys[None, :, b]
    a, b = np.nonzero(mask)
    out = []
    for s in range(0, len(a), 1 << 15):
        x, y = a[s : s + (1 << 15)], b[s : s + (1 << 15)]
        good = (signature[x] == signature[y]).sum(1) >= LEAST_AGREE
        out.append(np.stack([x[good], y[good]], 1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal values in the first ``keys`` columns."""
    held: list[pa.Table] = []
    key = None
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist(), len(batch)] if len(batch) else []
        for a, b in zip(cuts, cuts[1:]):
            own = tuple(int(c[a]) for c in columns)
            if held and own != key:
                yield key, pa.concat_tables(held)
                held = []
            key = own
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held:
        yield key, pa.concat_tables(held)


PLACE = "band int, key long, i int, j int"


def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a bucket that must be compared with a member of another class."""
    for (band, key, i, j), rows in grouped(batches, 4):
        if len(rows) < 2:
            continue
        signature = np.stack([np.frombuffer(x, "<u2") for x in rows.column("signature").to_pylist()])
        keys = np.stack(rows.column("bands").to_numpy())
        pairs = agreeing(signature, keys, rows.column("class").to_numpy(), rows.column("block").to_numpy(), band, i, j)
        own = np.unique(pairs)
        if len(own):
            yield pa.Table.combine_chunks(rows.take(pa.array(own))).to_batches()[0]


def joined_in_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between classes from exact overlap of the multisets; at most one fewer than there are classes."""
    shingler = Shingler()
    for (band, key, i, j), rows in grouped(batches, 4):
        d, label = rows.column("d").to_numpy(), rows.column("class").to_numpy()
        signature = np.stack([np.frombuffer(x, "<u2") for x in rows.column("signature").to_pylist()])
        keys = np.stack(rows.column("bands").to_numpy())
        pairs = agreeing(signature, keys, label, rows.column("block").to_numpy(), band, i, j)
        if not len(pairs):
            continue
        texts = rows.column("text").to_pylist()
        bags = [shingler.bag(t) for t in texts]
        good = pairs[overlaps(bags, pairs) >= THRESHOLD]
        parent = {int(c): int(c) for c in np.unique(label)}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        x, y = [], []
        for a, b in good.tolist():
            p, q = root(int(label[a])), root(int(label[b]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                x.append(int(d[a]))
                y.append(int(d[b]))
        yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])


def overlaps(bags: list, pairs: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of pairs of bags; for many pairs by matrix products over shared shingles."""
    if len(pairs) < 300:
        return np.array([similarity(bags[a], bags[b]) for a, b in pairs.tolist()])
    total = np.array([b[1].sum() for b in bags])
    # A shingle of weight w stands for w items (shingle, 1..w): the overlap counts common items.
    items, owner = [], []
    for n, (e, w) in enumerate(bags):
        at = np.repeat(np.arange(len(e)), w)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(w) - w, w)
        items.append(mix64(e[at] ^ mix64(nth.astype(np.uint64))))
        owner.append(np.full(len(at), n))
    values, code, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    owner = np.concatenate(owner)
    column = np.cumsum(count > 1) - 1
    shared = count[code] > 1
    code, owner = column[code[shared]], owner[shared]
    both, wide = np.zeros((len(bags), len(bags)), np.float32), 4096
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for s in range(0, int(code[-1]) + 1 if len(code) else 0, wide):
        a, b = np.searchsorted(code, [s, s + wide])
        part = np.zeros((len(bags), wide), np.float32)
        part[owner[a:b], code[a:b] - s] = 1
        both += part @ part.T
    hit = both[pairs[:, 0], pairs[:, 1]]
    return hit / np.maximum(1, total[pairs[:, 0]] + total[pairs[:, 1]] - hit)


def dealt(open_: DataFrame) -> DataFrame:
    """Members of open buckets (band, key, d, class, size) dealt to the cells (i, j) in which they are compared.

    Blocks of the other documents come first, those of the largest class after them; no cell holds two blocks of
    the largest class.
    """
    sums = open_.groupBy("band", "key", "class").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    order = F.struct("n", -F.col("class"))
    plan = sums.groupBy("band", "key").agg(F.max_by("class", order).alias("main"), F.max("n").alias("m"), F.max_by("bytes", order).alias("mb"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")
    plan = plan.select("band", "key", "main", blocks(F.col("m"), F.col("mb")).alias("mains"), blocks(F.col("n") - F.col("m"), F.col("bytes") - F.col("mb")).alias("rests"))
    rows = open_.join(plan, ["band", "key"]).withColumn("in_main", F.col("class") == F.col("main"))
    block = F.when(F.col("in_main"), F.col("rests") + F.pmod(F.xxhash64("d"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("d"), F.col("rests")))
    rows = rows.withColumn("block", block.cast("int"))
    others = F.sequence(F.lit(0), F.when(F.col("in_main"), F.col("rests") - 1).otherwise(F.col("rests") + F.col("mains") - 1))
    rows = rows.withColumn("other", F.explode(others))
    return rows.select("band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "d", "class", "block")


def classes(found: Documents) -> DataFrame:
    """d, sha and class_id (the smallest d of the class) for every text."""
    firsts, n = found.firsts, int(found.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = found.rows.select(F.col("__d").alias("d"), F.col("__text").alias("text"))
    if found.repeats:
        texts = texts.dropDuplicates(["d"])
    marks = materialize(signed(texts).join(firsts.select("d"), "d", "left_semi"))
    banded = marks.select("d", "size", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("d").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = materialize(banded.join(buckets, ["band", "key"]).select("band", "key", "d", "size", "leader"))
    met = members.where("d <> leader").groupBy("d", "leader").agg(F.count("*").alias("times"))
    pairs = met.groupBy("d").agg(F.max_by("leader", F.struct("times", -F.col("leader"))).alias("y")).select(F.col("d").alias("x"), "y")
    links = materialize(verified(pairs, texts))
    label = components(links)
    labelled = members.join(label, "d", "left").withColumn("class", F.coalesce("class", "d"))
    mixed = labelled.groupBy("band", "key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("band", "key")
    open_ = materialize(labelled.join(mixed, ["band", "key"]).select("band", "key", "d", "class", "size"))
    release(members)
    place = ["band", "key", "i", "j"]
    fields = PLACE + ", d long, class long, block int, signature binary, bands array<long>"
    seen = dealt(open_).join(marks, "d").select(*place, "d", "class", "block", "signature", "bands")
    seen = materialize(seen.repartition(n, *place).sortWithinPartitions(*place, "d").mapInArrow(flagged, fields))
    release(marks, open_)
    full = seen.join(texts, "d").select(*place, "d", "class", "block", "signature", "bands", "text")
    more = full.repartition(n, *place).sortWithinPartitions(*place, "d").mapInArrow(joined_in_bucket, "x long, y long")
    label = components(links.union(more))
    release(seen, links)
    return firsts.join(label, "d", "left").select("d", "sha", F.coalesce("class", "d").alias("class_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and whether the document stays, for every row."""
    found = documents(docs)
    rows = found.rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__d").alias("own"), F.col("__sha").alias("sha"))
    return rows.join(classes(found).select("sha", "class_id"), "sha").select("doc_id", "class_id", (F.col("own") == F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every class, with all columns of ``docs``."""
    found = documents(docs)
    stay = classes(found).where("d = class_id").select(F.col("d").alias("__d"))
    kept = found.rows.join(stay, "__d", "left_semi")
    return (kept.dropDuplicates(["__d"]) if found.repeats else kept).select(*(F.col(f"`{c}`") for c in docs.columns))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, and the components of their links; for tables in which doc_id is a key.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS words FROM documents),
s AS (SELECT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle, count(*) AS times FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0) GROUP BY 1, 2),
n AS (SELECT doc_id, sum(times) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.times, b.times)) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE shared / (a.n + b.n - shared) >= 0.8
 UNION SELECT a.doc_id, b.doc_id FROM w a JOIN w b USING (text) WHERE a.doc_id < b.doc_id AND text <> ''),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT doc_id, min(reached) AS class_id, min(reached) = doc_id AS kept FROM r GROUP BY doc_id
"""

QUERIES = {"op2_near_duplicates": op2_near_duplicates}
ORACLE_SQL = {"op2_near_duplicates": SQL}
