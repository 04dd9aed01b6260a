"""Operator 13: conversation structure repair.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Four edits make it so: Delete a turn,
Insert an empty turn of user or assistant, Keep a turn, Rerole it to user or assistant; blank and repeated turns must go.
The cheapest edits are found by a dynamic program backwards over turns and the four states of that grammar: the cost
to go from each turn in each state. A walk forwards then takes, among the edits that lie on a cheapest way, the one
whose initial comes first, so of equally cheap edits their initials in order are the ASCII-least.

Two sorted passes, each a stream of one conversation after the other:

* backwards over narrow rows without texts: for each turn and state the edits that the walk would take there;
* forwards over these and the texts, in one order, each turn behind its edits: the walk and its outcome.

Memory of a task does not grow with a conversation, but for one byte a turn of the string of edits. A digest over a whole
conversation and that string have one order, so a conversation is one task's, however long; a hot one costs time, not
memory. Repeated turns are found before, by a grouping of narrow hashes that is combined before it moves, and a join
that adaptive execution can split.

Order: by turn, nulls first, then role, then the 64-bit hash of the text; equal rows are interchangeable.

Defined results: a null role or text is one space; turns without a conv_id are one conversation; gaps between turns count
distinct turns that are not null; equal rows count as repeated; a conversation of no rows has zeros and an empty
audit; a very long text is one row; extra columns are dropped, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import table

BLANK = " \t\n\x0b\f\r"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: States by what was kept last: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a turn of user or assistant that the grammar allows next, by state.
NEXT = (USER, USER, ASSISTANT, USER)
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Cost and initials of the inserts that end a conversation, by state.
END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
LEGAL = {"su", "ua", "au"}
ORDER = ["turn", "role", "h1", "h2"]
DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, nth long, role string, text string, edit string"


def kept_state(state: int, initial: str) -> int | None:
    """The state after a turn is kept, or None where the grammar has no such turn."""
    to = STATE_OF.get(initial)
    return to if to == NEXT[state] or to == SYSTEM and state == START else None


def step_back(after: list[int], initial: str, must_go: bool, truncated: bool) -> tuple[list[int], list[str]]:
    """Costs to go before a turn, by state, from those after it; and the edits that the walk takes up to this turn's own."""
    once: list[dict[str, tuple[int, int]]] = []  # edits of the turn itself, by initial: cost to go, state after
    for state in range(4):
        ways = {"D": (DELETE + after[state], state)}
        if not must_go:
            if (to := kept_state(state, initial)) is not None:
                ways["K"] = (truncated * TRUNCATED + after[to], to)
            to = NEXT[state]
            ways["R"] = (REROLE + truncated * TRUNCATED + after[to], to)
        once.append(ways)
    cost = [min(c for c, _ in ways.values()) for ways in once]
    for _ in range(3):  # two inserts lead from any state to all that inserts reach
        cost = [min(c, INSERT + cost[NEXT[state]]) for state, c in enumerate(cost)]
    walks = []
    for state in range(4):
        walk = ""
        while not walk or walk[-1] == "I":
            tight = [e for e, (c, _) in once[state].items() if c == cost[state]]
            if INSERT + cost[NEXT[state]] == cost[state]:
                tight.append("I")
            walk += min(tight)
            if walk[-1] == "I":
                state = NEXT[state]
        walks.append(walk)
    return cost, walks


def flagged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, the hashes of the text, blank and truncated."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    bare = F.btrim("text", F.lit(BLANK))
    return rows.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("2"), "text").alias("h2"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"))


def with_repeats(narrow: DataFrame) -> DataFrame:
    """``late`` for turns whose role and text an earlier turn has; equal rows of one turn are left to the streams."""
    same = ["conv_id", "role", "h1", "h2"]
    first = narrow.groupBy(*same).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    g = first.select(*(F.col(c).alias(f"g_{c}") for c in same), "first")
    both = narrow.join(g, F.col("conv_id").eqNullSafe(F.col("g_conv_id")) & (F.col("role") == F.col("g_role")) & (F.col("h1") == F.col("g_h1")) & (F.col("h2") == F.col("g_h2")), "left")
    late = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return both.select(*narrow.columns, late.alias("late"))


def planned(narrow: DataFrame) -> DataFrame:
    """The backward pass: for each turn ``walks`` by state, ``fault`` and its place from the end (``back``)."""
    schema = "conv_id long, turn long, role string, h1 long, h2 long, back long, fault string, walks array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cost, back, out = None, None, 0, []

        def settle(same: bool) -> None:
            """Plans the held turn, which is the repetition of an equal row before it if ``same``."""
            nonlocal cost, back
            *key, blank, truncated, late = held
            fault = "blank" if blank else "duplicate" if late or same else "truncated" if truncated else ""
            cost, walks = step_back(cost, key[2][:1], fault in ("blank", "duplicate"), fault == "truncated")
            out.append((*key, back, fault, walks))
            back += 1

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None:
                    settle(held[:5] == row[:5])
                if held is None or held[0] != row[0]:
                    cost, back = [c for c, _ in END], 0
                held = row
            yield record(out, schema)
            out = []
        if held is not None:
            settle(False)
            yield record(out, schema)

    falling = [F.desc_nulls_last("turn"), *(F.desc(c) for c in ORDER[1:])]
    ready = narrow.select("conv_id", *ORDER, "blank", "truncated", "late").repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *falling)
    return ready.mapInArrow(run, schema)


def record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return pa.record_batch([pa.array([r[n] for r in rows], kinds[kind]) for n, (_, kind) in enumerate(fields)], [name for name, _ in fields])


class Digest:
    """The outcome of a walk as one row."""

    schema = DIGEST

    def __init__(self, conv: int | None):
        self.conv, self.count, self.illegal, self.cost = conv, {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0
        self.audit, self.sha, self.empty = bytearray(), hashlib.sha256(), True
        self.least = self.most = self.last = None
        self.distinct, self.before = 0, None

    def turn(self, turn: int | None, role: str, fault: str) -> None:
        """A turn as it is found."""
        if fault:
            self.count[fault] += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.most:
            self.least, self.most, self.distinct = turn if self.least is None else self.least, turn, self.distinct + 1

    def edit(self, initial: str, role: str | None = None, text: str = "", truncated: bool = False) -> list[tuple]:
        """An edit, and the turn that it leaves."""
        self.audit += initial.encode()
        self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[initial] + (truncated and initial != "D") * TRUNCATED
        if role is not None:
            self.sha.update(b"" if self.empty else b"\n")
            self.sha.update(f"{role}:{text}".encode())
            self.empty = False
        return []

    def end(self) -> list[tuple]:
        gaps = self.most - self.least + 1 - self.distinct if self.distinct else 0
        return [(self.conv, gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal, self.cost, self.audit.decode(), self.sha.hexdigest())]


class Rebuilt:
    """The outcome of a walk as the turns that it leaves."""

    schema = TURNS

    def __init__(self, conv: int | None):
        self.conv, self.nth = conv, 0

    def turn(self, turn: int | None, role: str, fault: str) -> None:
        pass

    def edit(self, initial: str, role: str | None = None, text: str = "", truncated: bool = False) -> list[tuple]:
        if role is None:
            return []
        self.nth += 1
        return [(self.conv, self.nth - 1, role, text, initial)]

    def end(self) -> list[tuple]:
        return []


def walked(turns: DataFrame, ids: DataFrame, outcome: type[Digest] | type[Rebuilt]) -> DataFrame:
    """The forward pass over ``turns``; every id of ``ids`` has an outcome."""
    rows = flagged(turns)
    plans = planned(with_repeats(rows.select("conv_id", *ORDER, "blank", "truncated")))
    null = lambda kind: F.lit(None).cast(kind)
    nothing = {"turn": null("long"), "role": null("string"), "h1": null("long"), "h2": null("long")}
    heads = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    #: 0: the conversation itself, 1: the plan of a turn, 2: the turn. Plans of equal rows come in the order of the rows.
    stream = heads.select("conv_id", F.lit(False).alias("in"), *(v.alias(c) for c, v in nothing.items()), F.lit(0).alias("kind"), null("long").alias("back"), null("string").alias("fault"), null("array<string>").alias("walks"), null("string").alias("text"))
    stream = stream.unionByName(plans.select("conv_id", F.lit(True).alias("in"), *ORDER, F.lit(1).alias("kind"), "back", "fault", "walks", null("string").alias("text")))
    stream = stream.unionByName(rows.select("conv_id", F.lit(True).alias("in"), *ORDER, F.lit(2).alias("kind"), null("long").alias("back"), null("string").alias("fault"), null("array<string>").alias("walks"), "text"))
    rising = [F.asc_nulls_first("conv_id"), "in", F.asc_nulls_first("turn"), *ORDER[1:], "kind", F.desc("back")]
    ready = stream.repartition("conv_id").sortWithinPartitions(*rising).select("conv_id", "turn", "role", "kind", "fault", "walks", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, waiting, out = None, START, deque(), []

        def close() -> list[tuple]:
            left = []
            at = state
            for _ in END[at][1]:
                at = NEXT[at]
                left += own.edit("I", NAMES[at])
            return left + own.end()

        for batch in batches:
            for conv, turn, role, kind, fault, walks, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if own is not None:
                        out += close()
                    own, state = outcome(conv), START
                elif kind == 1:
                    waiting.append((fault, walks))
                else:
                    fault, walks = waiting.popleft()
                    own.turn(turn, role, fault)
                    for initial in walks[state]:
                        if initial == "D":
                            own.edit("D")
                        elif initial == "K":
                            state = STATE_OF[role[:1]]
                            out += own.edit("K", role, text, fault == "truncated")
                        else:
                            state = NEXT[state]
                            out += own.edit("I", NAMES[state]) if initial == "I" else own.edit("R", NAMES[state], text, fault == "truncated")
            yield record(out, outcome.schema)
            out = []
        if own is not None:
            yield record(close(), outcome.schema)

    return ready.mapInArrow(run, outcome.schema)


def repair(turns: DataFrame) -> DataFrame:
    """``TURNS``: the turns of every conversation (conv_id, turn, role, text) after the cheapest edits, and what was done."""
    return walked(turns, turns, Rebuilt)


def digests(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``DIGEST``: faults, cost, edits and the repaired text's hash of every conversation, also of those only in ``ids``."""
    return walked(turns, turns if ids is None else ids, Digest)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by a checksum of conversation and turn."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), named("role").alias("role"), named("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.expr("sequence(0, int(kind = 3))")).alias("copy"))
    return rows.drop("copy")


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return digests(damaged(turns), turns)


def least_sql(*ways: str) -> str:
    """The least of structs of cost, edits and text that are not null."""
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


def way_sql(cost: str, edit: str, to: str, text: str = "''") -> str:
    return f"{{'c': {cost} + {to}.c, 'a': '{edit}' || {to}.a, 't': {text} || {to}.t}}"


def own_sql(state: int) -> str:
    """The cheapest way from a state by an edit of the turn itself."""
    to = NEXT[state]
    kept = [f"CASE WHEN free AND ini = '{NAMES[to][0]}' THEN {way_sql('late', 'K', f's{to}', 'line')} END"]
    if state == START:
        kept.append(f"CASE WHEN free AND ini = 's' THEN {way_sql('late', 'K', f's{SYSTEM}', 'line')} END")
    rerole = way_sql(f"{REROLE} + late", "R", f"s{to}", f"'{NAMES[to]}:' || text || chr(10)")
    return least_sql(way_sql(str(DELETE), "D", f"s{state}"), *kept, f"CASE WHEN free THEN {rerole} END")


def insert_sql(state: int, ways: str) -> str:
    to = NEXT[state]
    return least_sql(f"{ways}{state}", way_sql(str(INSERT), "I", f"{ways}{to}", f"'{NAMES[to]}:' || chr(10)"))


def end_sql(state: int) -> str:
    text, at = "''", state
    for _ in END[state][1]:
        at = NEXT[at]
        text += f" || '{NAMES[at]}:' || chr(10)"
    return f"{{'c': {END[state][0]}, 'a': '{END[state][1]}', 't': {text}}}"


def states_sql(expression, name: str) -> str:
    return ", ".join(f"{expression(q)} AS {name}{q}" for q in range(4))


#: The program backwards by recursion: for each turn and state the least cost, then the least edits, and the text they leave. ``k`` and ``c`` are the checksum.
SQL = f"""
WITH RECURSIVE k AS (SELECT list(list_reduce(list_concat([n], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY n) AS crcs FROM range(256) r(n)),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS key FROM conversations),
c AS (SELECT o.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda x: ascii(x)::bigint)), lambda h, b: xor(h >> 8, crcs[1 + (xor(h, b) & 255)])), 4294967295) % 20 AS kind FROM o, k),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE kind <> 0),
n AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, lag(role) OVER w AS previous FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, left(role, 1) AS ini FROM n),
g AS (SELECT conv_id, turn, i, ini, text, role || ':' || text || chr(10) AS line, fault NOT IN ('b', 'd') AS free, (fault = 't')::int AS late, fault, previous IS NOT NULL AND left(previous, 1) || ini NOT IN ('su', 'ua', 'au') AS illegal FROM f),
z AS (SELECT conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal FROM g GROUP BY conv_id),
v AS (SELECT conv_id, i, {states_sql(end_sql, 's')} FROM z
 UNION ALL SELECT conv_id, i, {states_sql(lambda q: insert_sql(q, 'y'), 's')} FROM (SELECT conv_id, i, {states_sql(lambda q: insert_sql(q, 'x'), 'y')} FROM (SELECT v.conv_id, v.i - 1 AS i, {states_sql(own_sql, 'x')} FROM v JOIN g ON g.conv_id IS NOT DISTINCT FROM v.conv_id AND g.i = v.i))),
b AS (SELECT conv_id, s0 FROM v WHERE i = 0)
SELECT q.conv_id, coalesce(z.gaps, 0)::bigint AS gaps, coalesce(z.blank, 0)::bigint AS blank, coalesce(z.duplicate, 0)::bigint AS duplicate, coalesce(z.truncated, 0)::bigint AS truncated, coalesce(z.illegal, 0)::bigint AS illegal, coalesce(s0.c, 0)::bigint AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(left(s0.t, length(s0.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM q.conv_id
"""

QUERIES = {"op13_turns": op13_turns}
ORACLE_SQL = {"op13_turns": SQL}
