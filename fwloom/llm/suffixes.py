"""Operator 9: suffix-array deduplication of long byte strings.

Every byte that lies in a ``LENGTH``-byte string which also starts earlier in the corpus is removed. The
corpus-wide suffix array is dealt out by content: of the grams in a ``LENGTH``-byte window the one with the
smallest hash is the window's anchor, so equal windows have equal anchors and meet in the same bucket. Windows
with the same anchor form a run; a run is about 35 windows, so few rows move.

1. Exact copies of a text fold onto the first of them; their removal follows from it.
2. Runs equal in whole content fold by hash, first within a task (a passage in a third of all documents
   leaves one row for each task), then across tasks: all but the first are covered.
3. Runs that share an anchor but not all content are compared exactly, in the bucket of the anchor: an
   enhanced suffix array of what follows the anchor, its common-prefix intervals by a stack scan, and within
   each interval the test of left extensions, which splits it into maximal repeats with all occurrences.
   Each occurrence but the earliest is covered as far as both extensions reach.
4. Anchors common to many different contexts (found in a sample of documents, or by the size of a bucket)
   are dealt out window by window instead. That changes the route, not the result.

Most repeats are settled by steps 1 and 2, which compare 64-bit hashes of whole runs (with a second hash of the
anchor); suffix arrays and intervals settle what is left. The groups themselves stay inside the tasks: what leaves
a bucket is the covered spans.

Texts are written once, bucketed by a key of (doc_id, text), and joined from there without moving again; so rows
that share a doc_id, or have none, spread out like any others.

Order: (doc_id, start); null ids come first, each of their texts as a document of its own, in the order of a hash of
the text. Rows with equal doc_id are one document: a string that starts at the same place in two of its rows has no
earlier start there. Defined results: a null text counts as empty; texts under ``LENGTH`` bytes keep everything;
repeated rows repeat; extra columns are dropped (``strip_repeats`` keeps all, whatever their names); an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import materialize, mix64, release, shared_dir, table

LENGTH, GRAM = 100, 32
SIDE = LENGTH - GRAM
#: Longer texts are hashed in pieces of so many windows.
PIECE = 1 << 20
#: Different contexts of an anchor up to which they are compared in one bucket, and rows handled at once.
BUCKET, CHUNK = 2000, 100_000
#: Sample for anchors that are common everywhere: documents, and the share of them that makes an anchor common.
SAMPLE_DOCS, COMMON = 2000, 0.01
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
#: Where the order of null ids begins, and how many numbers it has; ids of documents lie above.
FIRST_ID, NULL_IDS = -(2**63), 2**61

#: d orders documents, s is the key of a text.
RUN = "kind int, g long, h long, d long, s long, p long, q long, a long"
FOUND = "kind int, g long, d long, s long, p long, q long, a long"
CONTEXT = "g long, h long, d long, s long, p long, a long, body binary"
COVER = "d long, s long, p long, q long"
NAMES = {x: [f.split()[0] for f in x.split(", ")] for x in (RUN, FOUND, CONTEXT, COVER)}
TYPES = {"kind": pa.int32(), "body": pa.binary()}

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the k-th base and of its inverse, modulo 2**64."""
    if k not in _POWERS or len(_POWERS[k][0]) < n:
        m = max(n, 1 << 16)
        inverse = pow(int(BASES[k]), -1, 2**64)
        up, down = np.full(m, BASES[k], np.uint64), np.full(m, np.uint64(inverse), np.uint64)
        up[0] = down[0] = 1
        _POWERS[k] = np.cumprod(up), np.cumprod(down)
    return _POWERS[k]


def prefix_hashes(data: np.ndarray, k: int) -> np.ndarray:
    up, _ = powers(k, len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(k, len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start])


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, last window, anchor, hash of the anchor's gram, hash of the run."""
    n = len(data)
    one, two = prefix_hashes(data, 0), prefix_hashes(data, 1)
    at = np.arange(n - GRAM + 1)
    grams = span_hashes(one, 0, at, at + GRAM)
    least = (grams & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)
    span = 1
    while span * 2 <= SIDE + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = SIDE + 1 - span
    least = np.minimum(least[: len(least) - rest], least[rest:])
    anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
    a = anchor[first]
    shape = mix64(((last - first) * 1024 + (a - first)).astype(np.uint64))
    return first, last, a, grams[a], mix64(span_hashes(two, 1, first, last + LENGTH) + shape)


def window_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window of ``data``."""
    at = np.arange(len(data) - LENGTH + 1)
    return tuple(span_hashes(prefix_hashes(data, k), k, at, at + LENGTH) for k in (0, 1))


def pieces(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Parts whose windows together are all windows of ``data``, each once."""
    whole = np.frombuffer(data, np.uint8)
    for start in range(0, len(whole) - LENGTH + 1, PIECE):
        yield start, whole[start : start + PIECE + LENGTH - 1]


def batch_of(kind: str, columns: list) -> pa.RecordBatch:
    names = NAMES[kind]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if getattr(c, "dtype", None) == np.uint64 else c, TYPES.get(n, pa.int64())) for n, c in zip(names, columns)]
    return pa.record_batch(arrays, names)


def common_filter(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(hashes), bool)
    k = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    return common[k] == hashes


def emit_runs(batches: Iterator[pa.RecordBatch], common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``RUN`` of (d, s, text): kind 0 is covered, kind 1 is the first of its content among the rows at hand."""
    held, size = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        g, h, d, s, p, q, a = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.lexsort((p, d, h))
        g, h, d, s, p, q, a = (c[order] for c in (g, h, d, s, p, q, a))
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        tie = ~new & (d == d[lead]) & (p == p[lead])  # another row of the same document
        kind = np.where(new | tie, 1, 0).astype(np.int32)
        g = np.where(kind == 0, mix64(d.view(np.uint64) + p.view(np.uint64)), g)  # what is covered goes anywhere
        for i in range(0, len(g), CHUNK):
            yield batch_of(RUN, [c[i : i + CHUNK] for c in (kind, g, h, d, s, p, q, a)])

    for batch in batches:
        for d, s, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode()
            for start, part in pieces(data):
                first, last, a, g, h = runs_of(part)
                wide = common_filter(g, common)
                if wide.any():
                    one, two = window_keys(part)
                    n = (last - first + 1)[wide]
                    at = np.repeat(first[wide] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    first, last, a, g, h = (np.concatenate([c[~wide], x]) for c, x in zip((first, last, a, g, h), (at, at, at, one[at], two[at])))
                held.append((g, h, np.full(len(g), d), np.full(len(g), s), first + start, last + start + LENGTH, a + start))
                size += len(part)
            if size >= 1 << 24:
                yield from flush()
                size = 0
    yield from flush()


def fold_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``FOUND`` from ``RUN`` sorted by (g, h, d, p): kind 0 is covered; kinds 1 and 2 are contexts to compare, 2 by windows."""
    state = {"tail": None, "lead": None, "wide": None}

    def settle(rows: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
        kind, g, h, d, s, p, q, a = (rows.column(i).to_numpy() for i in range(8))
        yield from emit(kind[kind == 0], *(c[kind == 0] for c in (g, d, s, p, q, a)))
        own = np.flatnonzero(kind == 1)
        g, h, d, s, p, q, a = (c[own] for c in (g, h, d, s, p, q, a))
        if not len(g):
            return
        if not final:
            cut = int(np.searchsorted(-(g[::-1] == g[-1]).astype(np.int8), 0, "left"))
            if cut <= BUCKET or (state["wide"] is None and cut < len(g)):
                keep = len(g) - cut
                state["tail"] = pa.table([pa.array(np.ones(cut, np.int32)), *(pa.array(c[keep:]) for c in (g, h, d, s, p, q, a))], names=NAMES[RUN])
                g, h, d, s, p, q, a = (c[:keep] for c in (g, h, d, s, p, q, a))
                if not len(g):
                    return
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        lead_d, lead_p = d[lead], p[lead]
        before = state["lead"]
        if before and before[0] == g[0] and before[1] == h[0]:
            same = np.cumsum(new) == 1
            new[0] = False
            lead_d, lead_p = np.where(same, before[2], lead_d), np.where(same, before[3], lead_p)
        covered = ~new & ((d != lead_d) | (p != lead_p))
        contexts = np.flatnonzero(~covered)
        groups = np.concatenate([[True], g[1:] != g[:-1]])
        number = np.cumsum(groups) - 1
        count = np.bincount(number, weights=new).astype(np.int64)
        wide = count > BUCKET
        if state["wide"] is not None and state["wide"] == g[0]:
            wide[0] = True
        if not final and state["tail"] is None:  # the last bucket goes on
            wide[-1] = True
            state["wide"] = g[-1]
        state["lead"] = (g[-1], h[-1], lead_d[-1], lead_p[-1])
        compare = contexts[(count[number[contexts]] > 1) | wide[number[contexts]]]
        out = np.concatenate([np.flatnonzero(covered), compare])
        kinds = np.concatenate([np.zeros(covered.sum(), np.int32), np.where(wide[number[compare]], 2, 1).astype(np.int32)])
        yield from emit(kinds, *(c[out] for c in (g, d, s, p, q, a)))

    def emit(kind, *columns) -> Iterator[pa.RecordBatch]:
        if len(kind):
            yield batch_of(FOUND, [kind, *columns])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= CHUNK:
            tail, state["tail"] = state["tail"], None
            rows = pa.Table.from_batches(held, schema=batch.schema)
            yield from settle(pa.concat_tables([tail.cast(rows.schema), rows]) if tail is not None else rows, False)
            held, n = [], 0
    tail = state["tail"]
    if held or tail is not None:
        rows = pa.Table.from_batches(held) if held else None
        if tail is not None:
            tail = tail.cast(rows.schema) if rows is not None else tail
            rows = pa.concat_tables([tail, rows]) if rows is not None else tail
        state["tail"] = None
        yield from settle(rows, True)


def emit_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``CONTEXT`` of (d, s, text, wanted): the bytes of a run, or for kind 2 two hashes of each of its windows."""
    for batch in batches:
        out: list[tuple] = []
        wide = []
        for d, s, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = None
            for x in wanted:
                data = data if data is not None else text.encode()
                body = data[x["p"] : x["q"]]
                if x["kind"] == 1:
                    out.append((x["g"], 0, d, s, x["p"], x["a"], body))
                else:
                    one, two = window_keys(np.frombuffer(body, np.uint8))
                    at = np.arange(len(one)) + x["p"]
                    wide.append((one, two, np.full(len(at), d), np.full(len(at), s), at, at))
        if out:
            yield batch_of(CONTEXT, list(zip(*out)))
        if wide:
            columns = [np.concatenate(c) for c in zip(*wide)]
            order = np.lexsort((columns[4], columns[2], columns[1]))
            columns = [c[order] for c in columns]
            yield batch_of(CONTEXT, [*columns, pa.nulls(len(order), pa.binary())])


def padded(rows: list[bytes]) -> np.ndarray:
    """Rows as a matrix of ``SIDE`` bytes."""
    return np.frombuffer(b"".join(r.ljust(SIDE, b"\0") for r in rows), np.uint8).reshape(len(rows), SIDE)


def common_prefix(x: np.ndarray, y: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows of two matrices, at most ``bound``."""
    differs = x != y
    return np.minimum(np.where(differs.any(1), differs.argmax(1), SIDE), bound)


def intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (depth, first, last) of a suffix array by a stack scan of its LCP array.

    ``lcp[i]`` is between entries i and i + 1.
    """
    out, stack = [], []
    for i, depth in enumerate([*lcp, -1]):
        left = i
        while stack and stack[-1][0] > depth:
            top, left = stack.pop()
            out.append((top, left, i))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))
    return out


def earlier_extension(order: list[int], shared: list[int], time: list[int]) -> list[int]:
    """For each entry the longest left extension it shares with an earlier one (-1: none is earlier).

    ``order`` sorts entries by what precedes them, ``shared[i]`` is common to order[i] and order[i + 1]. The
    nearest earlier entry on either side shares the most.
    """
    best = [-1] * len(order)
    for ahead in (True, False):
        way = range(len(order)) if ahead else range(len(order) - 1, -1, -1)
        stack: list[tuple[int, int]] = []  # (time, common with the entry at hand)
        for i in way:
            step = (shared[i - 1] if ahead else shared[i]) if (i > 0 if ahead else i < len(order) - 1) else 0
            least = step
            while stack and stack[-1][0] >= time[order[i]]:
                t, c = stack.pop()
                least = min(least, c)
            if stack:
                t, c = stack[-1]
                common = min(least, c)
                stack[-1] = (t, common)
                best[order[i]] = max(best[order[i]], common)
            stack.append((time[order[i]], SIDE))
    return best


def compare_bucket(right: np.ndarray, right_n: np.ndarray, left: np.ndarray, left_n: np.ndarray, time: np.ndarray) -> list[tuple[int, int, int]]:
    """(entry, left reach, right reach) of maximal repeats with an earlier occurrence, for contexts of one anchor."""
    sa = np.lexsort(right.T[::-1])
    lcp = common_prefix(right[sa[:-1]], right[sa[1:]], np.minimum(right_n[sa[:-1]], right_n[sa[1:]])).tolist()
    found = []
    for depth, low, high in intervals(lcp):
        members = sa[low : high + 1]
        own_left, own_n = left[members], left_n[members]
        order = np.lexsort(own_left.T[::-1])
        shared = common_prefix(own_left[order[:-1]], own_left[order[1:]], np.minimum(own_n[order[:-1]], own_n[order[1:]]))
        if shared.max() + GRAM + depth < LENGTH:
            continue
        reach = earlier_extension(order.tolist(), shared.tolist(), time[members].tolist())
        found += [(int(m), r, depth) for m, r in zip(members, reach) if r >= 0 and r + GRAM + depth >= LENGTH]
    return found


def compare_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``COVER`` from ``CONTEXT`` sorted by (g, h, d, p)."""
    tail: list[pa.Table] = []
    lead = {"key": None}

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        g, h, d, s, p, a = (rows.column(i).to_numpy() for i in range(6))
        whole = rows.column(6).is_null().to_numpy()
        if whole.any():  # single windows: all but the first of equal ones
            w = np.flatnonzero(whole)
            wg, wh, wd, wp = g[w], h[w], d[w], p[w]
            new = np.concatenate([[True], (wg[1:] != wg[:-1]) | (wh[1:] != wh[:-1])])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            fd, fp = wd[first], wp[first]
            if lead["key"] and lead["key"][:2] == (wg[0], wh[0]):
                same = np.cumsum(new) == 1
                fd, fp = np.where(same, lead["key"][2], fd), np.where(same, lead["key"][3], fp)
            lead["key"] = (wg[-1], wh[-1], fd[-1], fp[-1])
            out = w[(wd != fd) | (wp != fp)]
            if len(out):
                yield batch_of(COVER, [d[out], s[out], p[out], p[out] + LENGTH])
        own = np.flatnonzero(~whole)
        if len(own) < 2:
            return
        g, d, s, p, a = (c[own] for c in (g, d, s, p, a))
        bodies = rows.column(6).take(pa.array(own)).to_pylist()
        offset = a - p
        right, left = padded([b[o + GRAM :] for b, o in zip(bodies, offset)]), padded([b[:o][::-1] for b, o in zip(bodies, offset)])
        left_n = offset
        right_n = np.array([len(b) for b in bodies]) - offset - GRAM
        time = np.empty(len(g), np.int64)
        order = np.lexsort((a, d))
        step = np.concatenate([[0], np.cumsum((d[order][1:] != d[order][:-1]) | (a[order][1:] != a[order][:-1]))])
        time[order] = step
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        size = np.diff([*start, len(g)])
        reach_l, reach_r, who = [], [], []
        # Two contexts: their suffix array has one interval, handled for all such buckets at once.
        x = start[size == 2]
        y = x + 1
        if len(x):
            depth = common_prefix(right[x], right[y], np.minimum(right_n[x], right_n[y]))
            ext = common_prefix(left[x], left[y], np.minimum(left_n[x], left_n[y]))
            hit = (depth + ext + GRAM >= LENGTH) & (time[x] != time[y])
            who.append(np.where(time[x] < time[y], y, x)[hit])
            reach_l.append(ext[hit])
            reach_r.append(depth[hit])
        for at, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            own_rows = slice(at, at + n)
            found = compare_bucket(right[own_rows], right_n[own_rows], left[own_rows], left_n[own_rows], time[own_rows])
            if found:
                m, l, r = (np.array(c) for c in zip(*found))
                who.append(m + at)
                reach_l.append(l)
                reach_r.append(r)
        if who:
            w, l, r = np.concatenate(who), np.concatenate(reach_l), np.concatenate(reach_r)
            if len(w):
                yield batch_of(COVER, [d[w], s[w], a[w] - l, a[w] + GRAM + r])

    held, n = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        n += len(batch)
        if n >= CHUNK // 4:
            rows = pa.concat_tables([*tail, *held])
            g = rows.column(0).to_numpy()
            body = rows.column(6).is_valid().to_numpy()
            last = len(g) - int(np.argmax(g[::-1] != g[-1])) if (g != g[-1]).any() else 0
            if not body[last:].any():
                last = len(g)  # single windows need no bucket as a whole
            yield from settle(rows.slice(0, last))
            tail, held, n = [rows.slice(last)], [], 0
    rest = [*tail, *held]
    if rest:
        yield from settle(pa.concat_tables(rest))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans as maximal runs."""
    out: list[list[int]] = []
    for p, q in sorted(spans):
        if out and p <= out[-1][1]:
            out[-1][1] = max(out[-1][1], q)
        else:
            out.append([p, q])
    return [(p, q) for p, q in out]


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for p, q in spans:
        out.append(data[at:p])
        at = q
    return b"".join([*out, data[at:]])


def common_anchors(texts: DataFrame) -> np.ndarray:
    """Hashes of anchors in many documents of a sample, sorted.

    The sample is about ``SAMPLE_DOCS`` documents by a hash of their id, whatever the size of the table; an
    anchor counts from a fixed share of that on, so there are at most a few for each sampled document.
    """
    every = max(1, texts.count() // SAMPLE_DOCS)
    sample = texts.where(F.pmod(F.xxhash64("d", "s"), F.lit(every)) == 0).select("d", "s", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(2).to_pylist():
                found = [runs_of(part)[3] for _, part in pieces(text.encode())]
                if found:
                    yield pa.record_batch([pa.array(np.unique(np.concatenate(found)).view(np.int64))], ["g"])

    least = max(20, int(SAMPLE_DOCS * COMMON))
    rows = sample.mapInArrow(run, "g long").groupBy("g").count().where(F.col("count") >= least).select("g").collect()
    return np.sort(np.array([r["g"] for r in rows], np.int64).view(np.uint64))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with __text, __sha, __n (bytes), __d (order of the document) and __s (key of document and text)."""
    rows = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("__sha", F.sha2("__text", 256))
    first = F.lit(FIRST_ID) + F.pmod(F.xxhash64("__sha"), F.lit(NULL_IDS))
    rows = rows.withColumn("__n", F.octet_length("__text").cast("long")).withColumn("__d", F.coalesce(F.col("doc_id").cast("long"), first))
    return rows.withColumn("__s", F.xxhash64("__d", "__sha"))


def first_texts(rows: DataFrame) -> DataFrame:
    """(d, s, sha, text) of the first document of every text of ``LENGTH`` bytes or more, bucketed by s."""
    spark = rows.sparkSession
    long = rows.where(F.col("__n") >= LENGTH)
    held = long.groupBy(F.col("__sha").alias("sha"), F.col("__d").alias("d")).agg(F.count("*").alias("times"))
    firsts = materialize(held.groupBy("sha").agg(F.min(F.struct("d", "times")).alias("first")).select("sha", "first.*"))
    repeats = not firsts.where("times > 1").isEmpty()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = firsts.select(F.xxhash64("d", "sha").alias("__s"), F.col("sha").alias("own"))
    texts = long.select("__d", "__s", "__sha", "__text").repartition(n, "__s").join(wanted, "__s")
    texts = texts.where(F.contains("own", "__sha"))  # a hash of 64 bits is no proof; equal lengths make this equality
    if repeats:
        texts = texts.dropDuplicates(["__s", "__sha"])
    texts = texts.select(F.col("__d").alias("d"), F.col("__s").alias("s"), F.col("__sha").alias("sha"), F.col("__text").alias("text"))
    name, path = f"fwloom_{uuid.uuid4().hex}", shared_dir(spark)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")  # the shuffled texts are not needed once they are written
    texts.write.bucketBy(n, "s").option("path", path).format("parquet").saveAsTable(name)
    spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    release(firsts)
    out = spark.table(name)
    out.schema  # resolved: only the files are needed from here on
    spark.sql(f"DROP TABLE {name}")
    return out


def found_runs(texts: DataFrame) -> DataFrame:
    """``FOUND``, written."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    common = texts.sparkSession.sparkContext.broadcast(common_anchors(texts))
    runs = texts.select("d", "s", "text").mapInArrow(lambda it: emit_runs(it, common.value), RUN)
    return materialize(runs.repartition(n, "g").sortWithinPartitions("g", "h", "d", "p").mapInArrow(fold_runs, FOUND))


def covers(texts: DataFrame) -> DataFrame:
    """``COVER``: spans of (d, s) that also start earlier."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found_runs(texts)
    wanted = found.where("kind > 0").groupBy("s").agg(F.collect_list(F.struct("kind", "g", "p", "q", "a")).alias("wanted"))
    contexts = texts.join(wanted, "s").select("d", "s", "text", "wanted").mapInArrow(emit_contexts, CONTEXT)
    compared = contexts.repartition(n, "g").sortWithinPartitions("g", "h", "d", "p").mapInArrow(compare_contexts, COVER)
    out = materialize(found.where("kind = 0").select("d", "s", "p", "q").union(compared))
    release(found)
    return out


def reduced(texts: DataFrame, spans: DataFrame, keep_text: bool) -> DataFrame:
    """s, sha, n_removed, n_spans, kept_sha256 and, if asked, the text that stays."""
    grouped = spans.groupBy("s").agg(F.collect_list(F.struct("p", "q")).alias("spans"))
    schema = "s long, sha string, n_removed long, n_spans long, kept_sha256 string, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for s, sha, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = merged([(x["p"], x["q"]) for x in spans or []])
                if not own:
                    rows.append((s, sha, 0, 0, sha, text if keep_text else None))
                    continue
                kept = kept_bytes(text.encode(), own)
                # A cut may split a character; its remaining bytes go with it where text is wanted.
                rows.append((s, sha, sum(q - p for p, q in own), len(own), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if keep_text else None))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)], ["s", "sha", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.join(grouped, "s", "left").select("s", "sha", "text", "spans").mapInArrow(run, schema)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = keyed(docs.select(F.col("doc_id").cast("long"), "text"))
    texts = first_texts(rows)
    done = reduced(texts, covers(texts), False).drop("kept")
    rows = rows.select("doc_id", F.col("__s").alias("s"), F.col("__sha").alias("sha"), F.col("__n").alias("n")).join(done, ["s", "sha"], "left")
    copy = F.col("kept_sha256").isNull() & (F.col("n") >= LENGTH)
    return rows.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def strip_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings removed from ``text``; all columns stay, ``n_chars`` follows the text."""
    rows = keyed(docs)
    texts = first_texts(rows)
    done = reduced(texts, covers(texts), True).select(F.col("s").alias("__s"), F.col("sha").alias("__sha"), F.col("kept").alias("__kept"), F.lit(True).alias("__done"))
    rows = rows.join(done, ["__s", "__sha"], "left")
    new = F.when(F.col("__n") < LENGTH, F.col("text")).when(F.col("__done"), F.col("__kept")).otherwise(F.lit(""))
    out = {c: new if c == "text" else F.length(new).cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns}
    return rows.select(*(v.alias(c) for c, v in out.items()))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


#: All windows of ``LENGTH`` bytes but the first of each content, joined to spans; for tables in which doc_id is a key.
SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, p, b[p + 1:p + 100] AS s FROM (SELECT doc_id, b, unnest(range(greatest(octet_length(b) - 99, 0))) AS p FROM d)),
c AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
i AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM (SELECT doc_id, p, (p > lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) + 100)::int AS fresh FROM c)),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS e FROM i GROUP BY doc_id, island),
g AS (SELECT d.doc_id, b, coalesce(list(struct_pack(a := a, e := e) ORDER BY a) FILTER (a IS NOT NULL), []) AS spans FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id, b),
k AS (SELECT *, list_transform(range(len(spans) + 1), lambda j: hex(b[CASE WHEN j = 0 THEN 0 ELSE spans[j].e END + 1:CASE WHEN j = len(spans) THEN octet_length(b) ELSE spans[j + 1].a END])) AS pieces FROM g)
SELECT doc_id, octet_length(b)::bigint AS n_bytes, coalesce(list_sum(list_transform(spans, lambda x: x.e - x.a)), 0)::bigint AS n_removed, len(spans)::bigint AS n_spans, sha256(unhex(array_to_string(pieces, ''))) AS kept_sha256 FROM k
"""

QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLE_SQL = {"op9_suffix_dedup": SQL}
