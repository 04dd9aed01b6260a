"""Operators 11, 12 and 13 against brute force."""

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fwloom.llm import lexical, lines, turns

# operator 11

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    bags = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, tokens = len(bags), sum(n for *_, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, bag, n in bags:
            m = 100 - 75 + 75 * n * total // tokens
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in TERM.findall((text or "").translate(LOWER)) if t in bag)
            if s > 0:
                scores.append((-s, d is not None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def text_of(rng, words, size):
    return rng.choice(["", " ", "\n"]).join(["x", ""]) + " ".join(rng.choice(words) for _ in range(size))


@pytest.mark.parametrize("block_terms", [10**6, 3])
def test_search_equals_brute_force(spark, block_terms, monkeypatch):
    rng = random.Random(block_terms)
    monkeypatch.setattr(lexical, "PIECE", 300)
    words = [f"w{int(60 * rng.random() ** 3)}" for _ in range(200)] + ["Ünder", "ünder", "Ab-c", "AB c", "naïve", "\x7f\x00a", "１２", "çà"]
    docs = [(n, text_of(rng, words, rng.choice([0, 1, 5, 30, 200]))) for n in range(150)]
    docs += [(n, docs[3][1]) for n in range(200, 230)] + [(7, docs[7][1]), (None, docs[3][1]), (None, None), (400, "..."), (401, "w1 " * 20_000)]
    rng.shuffle(docs)
    items = [(n, text_of(rng, words, size)) for n, size in enumerate([1, 2, 5, 20, 60, 3])] + [(90, ""), (91, None), (92, "unknown"), (93, "-- !"), (None, "w1 w1 W1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).repartition(3)
    i = spark.createDataFrame([*items, items[4]], "item_id long, text string").withColumn("n", F.lit(2))
    got = [tuple(r) for r in lexical.ranked_search(d, i, 10, block_terms).collect()]
    assert sorted(got, key=str) == brute_search(docs, items, 10)
    assert lexical.ranked_search(d.limit(0), i).count() == 0 and lexical.ranked_search(d, i.limit(0)).count() == 0


def test_threshold_stops_early_and_loses_nothing():
    """A rare strong term ends the search before the long list of a weak one is read."""
    rng = np.random.default_rng(2)
    n = 20_000
    terms = np.where(np.arange(n) % 1000 == 0, 1, 0)
    impact = np.where(terms == 1, 10_000, 100 + rng.integers(0, 50, n))
    piece = lexical.Piece(np.arange(n), np.arange(n + 1), terms, impact, 2)
    best = lexical.Best(10)
    times = np.array([1, 1])
    assert lexical.threshold_search(piece, np.array([0, 1]), times, times, best) < 200
    assert list(best.doc) == list(range(0, 10_000, 1000))
    # Ties at the edge: all equal, so every document at the k-th score must be seen.
    piece, best = lexical.Piece(np.arange(500)[::-1].copy(), np.arange(501), np.zeros(500, int), np.full(500, 7), 1), lexical.Best(10)
    assert lexical.threshold_search(piece, np.array([0]), np.array([1]), np.array([1]), best) == 500 and list(best.doc) == list(range(10))


# operator 12


def brute_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(LOWER)
    rank = lambda d: (d is not None, d or 0)
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, rank(d)), rank(d))
    out = []
    for d, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < 10 or first[key(x)] == rank(d)]
        out.append((d, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_digest(df, **how):
    kept = lines.kept_lines(df, **how)
    return sorted((tuple(r) for r in kept.select("doc_id", F.size("lines"), F.size("gone"), F.sha2(lines.kept_text(), 256)).collect()), key=str)


@pytest.mark.parametrize("batches,fanout", [(6, 3), (7, 2), (1, 2)])
def test_lines_equal_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    stock = [f"line number {n} of the stock" for n in range(60)] + ["short", "", "  ", "exactly10!", "nine nine", "ÄÄÄÄÄÄÄÄÄÄ", "ääääääääää", " em space kept "]
    dress = lambda x: rng.choice([x, x.upper(), f"  {x}\t", x + "\r", f"\x0b{x}\x0c"])
    rows = [(rng.randrange(120), "\n".join(dress(rng.choice(stock)) for _ in range(rng.choice([0, 1, 3, 12])))) for _ in range(120)]
    rows += [(n, "the hot line of all\n" * 3) for n in range(300, 400)] + [(None, "the hot line of all\nand another line"), (None, None), (None, "and another line"), (5, ""), rows[0], rows[0]]
    rows += [(500, "\n".join(f"a long text, line {n % 3000}" for n in range(20_000))), (501, "a long text, line 7")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("gone", F.lit(1)).repartition(3)
    assert line_digest(df, batches=batches, fanout=fanout) == brute_lines(rows)


def test_lines_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_digest(empty) == []
    nulls = [(None, None), (None, "one and the same line"), (None, "one and the same line")]
    assert line_digest(spark.createDataFrame(nulls, "doc_id long, text string")) == brute_lines(nulls)
    out = lines.dedup_lines(spark.createDataFrame([(2, "B line of text\nx"), (1, "b LINE of text")], "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(1, "b LINE of text"), (2, "x")]


def test_runs_are_compacted(spark):
    runs = lines.Runs(spark, 2)
    for n in range(7):
        batch = spark.range(n * 5, n * 5 + 10).select(F.col("id").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(n).cast("long").alias("first"), F.lit(n).cast("long").alias("last"))
        assert runs.add(batch).where("seen").count() == (5 if n else 0)
        runs.compact()
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert sum(runs.hashes(r).count() for level in runs.levels for r in level) == 40
    plan = runs.spark.table(runs.levels[2][0][0]).join(runs.hashes(runs.levels[1][0]).hint("merge"), lines.HASH, "left")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fwloom_run_")]


def test_lines_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "a line of some length"), (2, "a line of some length")], "doc_id long, text string")
    plan = lines.kept_lines(df).select(lines.kept_text())._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# operator 13

SPACE = " \t\n\x0b\f\r"


def brute_repair(rows):
    """The digest of one conversation; rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @functools.cache
    def cheapest(i, state, inserts):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, ""))
        step = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserts < 3:
            c, a = cheapest(i, step, inserts + 1)
            ways.append((c + 2, "I" + a))
        if i < len(rows):
            c, a = cheapest(i + 1, state, 0)
            ways.append((c + 3, "D" + a))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                x = rows[i][1][:1]
                if x == step or x == "s" and state == "":
                    c, a = cheapest(i + 1, x, 0)
                    ways.append((c + more, "K" + a))
                c, a = cheapest(i + 1, step, 0)
                ways.append((c + 2 + more, "R" + a))
        return min(ways, default=(10**9, ""))

    cost, audit = cheapest(0, "", 0)
    left, i, state = [], 0, ""
    for e in audit:
        step = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
        if e == "I":
            left.append((step, ""))
        elif e in "KR":
            left.append((rows[i][1] if e == "K" else step, rows[i][2]))
        i += e != "I"
        state = left[-1][0][:1] if left else ""
    assert i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in left))
    known = sorted({t for t, *_ in rows if t is not None})
    gaps = known[-1] - known[0] + 1 - len(known) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())


def in_order(rows):
    hashed = lambda t: int.from_bytes(xxhash.xxh64(t.encode(), seed=42).digest(), "big", signed=True)
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashed(r[2])))


def brute_digests(rows, ids):
    by_id = {i: [] for i in ids}
    for conv, turn, role, text in rows:
        by_id[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return sorted(((i, *brute_repair(in_order(r))) for i, r in by_id.items()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rng, n):
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, 3]), role, rng.choice(["Yes.", "no", "What?", " \t", "", "é!", "cut off ", None, "Yes. ", f"t{turn}."])))
    return rows


def test_repair_equals_brute_force(spark):
    rng = random.Random(5)
    rows = conversations(rng, 400)
    rows += [(900, n, "user" if n % 2 == 0 else "assistant", f"turn {n}.") for n in range(150)] + [(901, 1, "user", "x. " * 50_000)]
    ids = {r[0] for r in rows}
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fault", F.lit("x")).withColumn("kind", F.lit(7)).withColumn("h1", F.lit("y")).repartition(3)
    got = sorted(map(tuple, turns.digests(df).collect()), key=str)
    assert got == brute_digests(rows, ids)
    left = turns.repair(df).collect()
    joined = collections.defaultdict(list)
    for r in sorted(left, key=lambda r: r["nth"]):
        joined[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert {g[0]: g[-1] for g in got} == {i: hashlib.sha256("\n".join(joined[i]).encode()).hexdigest() for i in ids}


def test_damage_then_repair(spark):
    rng = random.Random(6)
    rows = conversations(rng, 300)
    after = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, turns.digests(turns.damaged(df), df).collect()), key=str)
    assert got == brute_digests(after, {r[0] for r in rows})
    assert any(g[1:8] == (0, 0, 0, 0, 0, 0, "") for g in got)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turns.digests(none).count() == 0 and turns.repair(none).count() == 0
    assert tuple(turns.digests(none, spark.createDataFrame([(None, None, None, None)], SCHEMA)).first()) == (None, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def all_edits(rows, faults):
    """Cost and audit of every way to edit ``rows`` with up to three inserts before each and at the end."""
    names = {"u": "user", "a": "assistant"}
    inserts = [list(x) for n in range(4) for x in itertools.product("ua", repeat=n)]
    own = []
    for (_, role, _), fault in zip(rows, faults):
        ways = [("D", 3, "")]
        if fault not in ("blank", "duplicate"):
            ways += [("K", fault == "truncated", role[:1])] + [("R", 2 + (fault == "truncated"), x) for x in names]
        own.append(ways)
    for ways in itertools.product(*own):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            roles, audit, cost = "", "", 0
            for k, more in enumerate(put):
                roles, audit, cost = roles + "".join(more), audit + "I" * len(more), cost + 2 * len(more)
                if k < len(rows):
                    audit, cost, roles = audit + ways[k][0], cost + ways[k][1], roles + ways[k][2]
            if re.fullmatch("(s?(ua)+)?", roles):
                yield cost, audit


def test_cheapest_edits_equal_full_enumeration():
    for n in range(3):
        for roles in itertools.product("suax", repeat=n):
            for texts in itertools.product(["t.", "t", ""], repeat=n):
                rows = [(k, {"s": "system", "u": "user", "a": "assistant", "x": "x"}[r], f"{k}{t}" if t else "") for k, (r, t) in enumerate(zip(roles, texts))]
                cost, walks = [c for c, _ in turns.END], []
                for _, role, text in reversed(rows):
                    cost, walk = turns.step_back(cost, role[:1], not text, not text.endswith("."))
                    walks.insert(0, walk)
                state, audit = turns.START, ""
                for (_, role, _), walk in zip(rows, walks):
                    audit += walk[state]
                    for e in walk[state]:
                        state = state if e == "D" else turns.STATE_OF[role[:1]] if e == "K" else turns.NEXT[state]
                audit += turns.END[state][1]
                faults = ["blank" if not t else "" if t.endswith(".") else "truncated" for *_, t in rows]
                assert (cost[turns.START], audit) == min(all_edits(rows, faults)), rows
