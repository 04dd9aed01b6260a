"""Operator 1: best-fit packing of token sequences.

The lengths of all pieces form a histogram of at most ``capacity`` numbers, however large the corpus. Over it
stands the configuration linear program: a variable for each multiset of lengths that fits a sequence, and a
covering row for each length, over the whole demand. Multiplicative weights solve it: a length's weight, which
starts at its size, falls with the share of its demand that is covered and rises where a phase left it for the
end. Knapsack dynamic programming prices the lengths by these weights and gives the best fill of every capacity,
so one pricing yields a column for each length.

A first solution covers each length by its best column, is rounded down, and the rest packed by the same pricing in whole steps. That is enough
where short pieces fill the gaps. Where it stays over the proven bound the program is solved in earnest: each phase takes only columns that are worth, but for
``SLACK``, as much as the best, a small step of each, so nothing but nearly optimal configurations come in (``tight_cover``). The solution is rounded by
diving: whole parts and the largest fractions are kept until half of the sequences stand, then what is left is solved anew.

Every pricing proves a lower bound by duality: weights divided by the value of the best configuration are
feasible prices, so no packing uses fewer sequences than they give for the demand. ``solve`` reports the best of
these bounds and of the step prices that hold for lengths over half a sequence.

Only the histogram reaches the driver. Pieces find their place by rank among the pieces of their length: each
task numbers its own pieces while it makes them, and sums over tasks give the rank in the whole table. No
length, however common, meets in one task.

Defined results: a null text counts as empty and packs as its separator alone; repeated rows are packed once
each; doc_id may be null; extra columns of the input are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fwloom.llm import bpe, merges
from fwloom.llm.common import materialize, table

CAPACITY = 2048
SEPARATOR = 0
#: Phases of the first solution before the last; in each, a column takes this share of what it could cover.
PHASES, SHARE = 10, 0.5
#: How strongly covered demand lowers a weight.
ETA = 1.0
#: Phases of the first and of later solutions of a dive, the share of its demand that a length gets in one, how strongly that lowers its weight,
#: and what a column may be worth less than the best.
DIVE_PHASES, DIVE_SHARE, DIVE_ETA, SLACK = (120, 40), 0.05, 0.05, 0.01
#: Share of the sequences that a dive keeps, and the number at which it ends.
KEPT, FEW = 0.5, 12
#: Sequences over the proven bound, as a share of it, up to which the first solution is taken.
GAP = 0.0005
#: Demand below this counts as covered.
TINY = 1e-6

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for each capacity, and the length to put in first (0: leave a gap of one)."""
    best, first = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        n = np.searchsorted(lengths, c, "right")
        best[c], first[c] = best[c - 1], 0
        if n:
            options = best[c - lengths[:n]] + values[:n]
            k = n - 1 - int(np.argmax(options[::-1]))
            if options[k] > best[c]:
                best[c], first[c] = options[k], lengths[k]
    return best, first


def column(seed: int, left: np.ndarray, first: np.ndarray, capacity: int, least: float) -> Counter:
    """The priced configuration that holds ``seed``; where a length runs out, the longest that fits is taken.

    In whole steps (``least`` is 1) a length can be taken as often as it is left.
    """
    config, room = Counter([seed]), capacity - seed
    while room > 0:
        take = int(first[room])
        if take == 0:
            room -= 1
            continue
        if left[take] < least * (1 + config[take] * (least == 1)):
            fitting = np.flatnonzero(left[1 : room + 1] >= least) + 1
            take = next((int(x) for x in fitting[::-1] if least < 1 or left[x] - config[int(x)] >= 1), 0)
            if take == 0:
                break
        config[take] += 1
        room -= take
    return config


class Solution(NamedTuple):
    """Configurations as ((length, times), ...) with how often each is used; together they hold the histogram exactly."""

    configurations: list[tuple[tuple[tuple[int, int], ...], int]]
    #: Sequences in use, the value of the best fractional solution that covers all demand, and a proven lower bound.
    sequences: int
    fractional: float
    bound: int


def step_bound(demand: np.ndarray, capacity: int) -> float:
    """Dual bound of the step prices: for a threshold t, lengths over ``capacity - t`` weigh 1, those from t their share, the rest 0."""
    size = np.arange(capacity + 1)
    count, volume = np.cumsum(demand), np.cumsum(demand * size)
    best = 0.0
    for t in range(capacity // 2 + 1):
        over = count[capacity] - count[capacity - t]
        # Two lengths over half do not share a sequence; the rest of their sequences takes others.
        half = max(capacity // 2, t - 1)
        wide = count[capacity - t] - count[half] if capacity - t > half else 0.0
        free = wide * capacity - (volume[capacity - t] - volume[half]) if wide else 0.0
        small = volume[half] - (volume[t - 1] if t else 0.0) if half >= t else 0.0
        best = max(best, over + wide + max(0.0, small - free) / capacity)
    return best


def cover(demand: np.ndarray, price: np.ndarray, capacity: int) -> tuple[Counter, float]:
    """A fractional cover of the whole demand by columns priced with multiplicative weights, and the best dual bound.

    Weights start at ``price``; in every phase a weight falls with the share of its demand that the phase covered.
    """
    lengths = np.flatnonzero(demand)
    weight, left, out, bound = price.copy(), demand.copy(), Counter(), 0.0
    for phase in range(PHASES + 1):
        best, first = knapsack(lengths, weight[lengths], capacity)
        bound = max(bound, demand @ weight / best[capacity])
        open_ = np.flatnonzero(left > TINY)
        if len(open_) < len(lengths):  # columns are made of what is left
            _, first = knapsack(open_, weight[open_], capacity)
        last = phase == PHASES
        before = left.copy()
        for seed in open_[::-1].tolist():  # the longest first
            while left[seed] > TINY:
                config = column(seed, left, first, capacity, TINY)
                step = min(left[x] / n for x, n in config.items()) * (1.0 if last else SHARE)
                for x, n in config.items():
                    left[x] -= n * step
                out[tuple(sorted(config.items(), reverse=True))] += step
                if not last:
                    break
        if (left <= TINY).all():
            break
        covered = (before - left)[lengths] / demand[lengths]
        weight[lengths] *= np.exp(-ETA * (covered - covered @ demand[lengths] / demand.sum()))
    return out, bound


def tight_cover(demand: np.ndarray, capacity: int, phases: int) -> tuple[Counter, float]:
    """Columns close to the best at their pricing, scaled to cover the demand on average, and the best dual bound."""
    lengths = np.flatnonzero(demand)
    weight, out, bound, covered = np.arange(capacity + 1) / capacity, Counter(), 0.0, np.zeros(capacity + 1)
    for _ in range(phases):
        best, first = knapsack(lengths, weight[lengths], capacity)
        bound = max(bound, demand @ weight / best[capacity])
        worth = weight[lengths] + best[capacity - lengths]
        tight = np.flatnonzero(worth >= (1 - SLACK) * best[capacity])
        left = DIVE_SHARE * demand
        before = covered.copy()
        for seed in lengths[tight[np.argsort(-worth[tight], kind="stable")]].tolist():
            if left[seed] <= TINY * DIVE_SHARE:
                continue
            config, room = Counter([seed]), capacity - seed
            while room > 0:
                take = int(first[room])
                config[take] += take > 0
                room -= take or 1
            config = +config
            step = min(left[x] / n for x, n in config.items())
            if step > 0:
                out[tuple(sorted(config.items(), reverse=True))] += step
                for x, n in config.items():
                    left[x] -= n * step
                    covered[x] += n * step
        weight[lengths] *= np.exp(-DIVE_ETA * (covered - before)[lengths] / demand[lengths] / DIVE_SHARE)
        weight[lengths] = np.maximum(weight[lengths] / weight[lengths].max(), 1e-9)
    scale = 1 / (covered[lengths] / demand[lengths]).mean()
    return Counter({config: x * scale for config, x in out.items()}), bound


def dive(histogram: np.ndarray, capacity: int) -> tuple[Counter, float]:
    """Whole sequences by solving, keeping, and solving what is left; and the dual bound of the whole."""
    left, used, bound = histogram.astype(np.int64), Counter(), 0.0

    def keep(config: tuple[tuple[int, int], ...], most: int) -> int:
        n = min([most, *(int(left[x]) // times for x, times in config)])
        if n:
            used[config] += n
            for x, times in config:
                left[x] -= n * times
        return n

    while left.any():
        first = not used
        fractional, proven = tight_cover(left.astype(np.float64), capacity, DIVE_PHASES[not first])
        total = sum(fractional.values())
        bound = proven if first else bound
        if total < FEW:
            break
        kept = sum(keep(config, int(x)) for config, x in sorted(fractional.items(), key=lambda kv: -kv[1]))
        for config, x in sorted(fractional.items(), key=lambda kv: -(kv[1] % 1)):
            if kept >= KEPT * total:
                break
            kept += keep(config, 1)
        if not kept:
            break
    return used + rounded(Counter(), left, np.arange(capacity + 1) / capacity, capacity), bound


def rounded(fractional: Counter, histogram: np.ndarray, price: np.ndarray, capacity: int) -> Counter:
    """Whole sequences: the fractional solution rounded down, the rest by columns in whole steps.

    The rest is priced by ``price`` and by size, and the better is taken.
    """
    floor: Counter = Counter()
    left = histogram.astype(np.int64)
    for config, x in fractional.items():
        n = int(x + 1e-9)
        if n and all(left[length] >= n * times for length, times in config):
            floor[config] += n
            for length, times in config:
                left[length] -= n * times
    lengths = np.flatnonzero(left)
    found = []
    for value in (price[lengths], lengths / capacity) if len(lengths) else ():
        _, first = knapsack(lengths, value, capacity)
        used, rest = Counter(), left.copy()
        for seed in lengths[::-1].tolist():
            while rest[seed]:
                config = column(seed, rest, first, capacity, 1)
                step = int(min(rest[x] // n for x, n in config.items()))
                used[tuple(sorted(config.items(), reverse=True))] += step
                for x, n in config.items():
                    rest[x] -= n * step
        found.append(used)
    return floor + min(found, key=Counter.total, default=Counter())


def solve(histogram: np.ndarray, capacity: int) -> Solution:
    """The configuration program of ``histogram`` (times of every length up to ``capacity``), solved and rounded."""
    demand = histogram.astype(np.float64)
    if not demand.any():
        return Solution([], 0, 0.0, 0)
    price = np.arange(capacity + 1) / capacity
    fractional, proven = cover(demand, price, capacity)
    used, value = rounded(fractional, histogram, price, capacity), float(sum(fractional.values()))
    bound = max(demand @ price, step_bound(demand, capacity), proven)
    if used.total() > math.ceil(bound - 1e-6) + max(1, GAP * bound):
        found, proven = dive(histogram, capacity)
        bound = max(bound, proven)
        used = min(used, found, key=Counter.total)
        value = min(value, float(used.total()))
    return Solution([(c, int(n)) for c, n in used.items()], used.total(), value, math.ceil(bound - 1e-6))


def slots(solution: list, capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of places by rank: first rank, first sequence, times in a sequence, offset there."""
    runs, taken, sequence = defaultdict(list), Counter(), 0
    for config, n in solution:
        offset = 0
        for length, times in config:
            runs[length].append((taken[length], sequence, times, offset))
            taken[length] += n * times
            offset += length * times
        sequence += n
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for length, rows in runs.items()}


def cut(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``PIECES`` of every document: only what is longer than ``capacity`` is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = merges.batch_encoder(path), bpe.words_le([SEPARATOR])
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.many(texts)):
                data = ids + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def histogram_of(pieces: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """How many pieces have each length; a row for each length at most reaches the driver."""
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    return histogram


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``PLACED`` for written ``PIECES``."""
    by_task = pieces.groupBy("task", "length").agg((F.max("nth") + 1).alias("n"))
    solution = solve(histogram_of(pieces, capacity), capacity)
    plan = pieces.sparkSession.sparkContext.broadcast(slots(solution.configurations, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for value in np.unique(length):
                own = np.flatnonzero(length == value)
                start, first, times, at = runs[int(value)]
                k = np.searchsorted(start, rank[own], "right") - 1
                nth = rank[own] - start[k]
                sequence[own] = first[k] + nth // times[k]
                offset[own] = at[k] + nth % times[k] * value
            yield pa.record_batch([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PLACED)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Packs all documents (doc_id, text) into sequences of at most ``capacity`` tokens."""
    return place(materialize(cut(docs, capacity, path)), capacity)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op1_packing": op1_packing}
ORACLE_SQL: dict[str, str] = {}
