"""Operator 3: secret scans by assignment-aware lexing.

Base findings are three fixed patterns (``assign``, ``access``, ``hex``). On top of them the scanner lexes
source and configuration syntax into name-literal pairs: at every assignment sign, compound ones too, it reads the whole name on its
left and the value on its right: a quoted, triple-quoted, backquoted or bare literal, with or without a prefix letter, a YAML block, a list in
brackets, a sum of literals, or another name. Quoted arguments of a call belong to the name of the function, the text of an XML element to
that of the element. A name that says nothing of its own (``value``, ``key``) is read with the name around it: of the braces, the YAML block or the
INI section. Constants are propagated over the document, wherever they are bound: a literal that
reaches a sensitive name through any chain of names is found where it stands. Sums are folded, names in them too (by their first
binding): if the whole looks like a key, every part of it is found, however short. A pair scores by how sensitive its
name is and how much its literal looks like a key rather than prose; pairs of at least ``MIN_SCORE`` add a
``lexed`` span, unless base spans hold it already. Base spans are never changed. Lines of a literal over several
lines are literals of their own.

Every step is linear in the text: a name, a sign and a literal are each read once.

One pass over the table without a shuffle. Positions are code points, ends exclusive.

Defined results: a null text counts as empty and has no spans (empty strings, hash of the empty string);
repeated rows give repeated results; extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import table

#: Fixed patterns of the base findings.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "lexed")
ASSIGN_CHARS = 6

#: Parts of a name that make it sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.8, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0, "bearer": 0.8, "auth": 0.6,
}
#: Parts that come in pairs: a name with both is sensitive.
PAIRED = [("api", "key"), ("private", "key"), ("access", "key"), ("secret", "key"), ("auth", "key"), ("signing", "key"), ("encryption", "key"), ("client", "secret"), ("connection", "string")]
#: Literals that stand for a value instead of being one.
PLACEHOLDER = re.compile(r"(?ai)(?:none|null|true|false|undefined|changeme|example|placeholder|redacted|your[_-].*|x+|\*+|\.+|<.*>|\$\{.*\}|%\(.*|\{\{.*)$")
MIN_SCORE = 1.2
MIN_CHARS = 8

#: A whole name, what may close it (quotes, an index), and the sign, or a bracket before a quoted argument; or a brace; a section; an element and its text.
LEXEME = re.compile(
    r"""(?<![A-Za-z0-9_.\-$])[0-9.\-]*+([A-Za-z_$][A-Za-z0-9_.\-$]*+)["'\]]{0,2}+[ \t]*+(:=|=>|\?\?=|\|\|=|[+|?]?=(?![=~])|:(?![:/])|\((?=[ \t]*+[rbfuRBFU]{0,2}["'`]))"""
    r"""|([{}])|^[ \t]*+\[([A-Za-z_][A-Za-z0-9_.\- ]*+)\][ \t\r]*+$|<([A-Za-z_][A-Za-z0-9_.:\-]*+)(?:[ \t][^<>\n]*+)?>([^<>\n]++)</""",
    re.M,
)
PREFIX = re.compile("(?:[rbfuRBFU]{1,2}|[@$])(?=[\"'`])")
BLOCK = re.compile(r"[ \t]*+[|>][+-]?[0-9]?[+-]?[ \t\r]*+\n")
INDENTED = re.compile(r"[ ]*+")
BETWEEN = re.compile(r"[ \t\r\n]*+,?[ \t\r\n]*+")
QUOTE = re.compile("[ \t]*+(?:[rbfuRBFU]{1,2})?[\"'`]")
QUOTED = re.compile(r""""((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'""")
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]++""")
BLANK = re.compile(r"[ \t]*+")
LONG_QUOTES = ('"""', "'''", "`")
PLUS = re.compile(r"[ \t]*+\+(?=[ \t]*+[\"'`A-Za-z_])")
IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*$")
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")
LINE = re.compile(r"[^\n]+")
#: Names that say nothing of their own.
GENERIC = frozenset(["value", "key", "data", "content", "default", "current", "val"])

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lexed long, top_score double"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def name_score(name: str) -> float:
    parts = [p.lower() for p in SPLIT.split(name) if p]
    parts = [p[:-1] if p.endswith(("keys", "tokens", "secrets", "passwords")) else p for p in parts]
    joined = set(parts) | {a + b for a, b in zip(parts, parts[1:])}
    score = max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)
    return 1.0 if any(a in parts and b in parts for a, b in PAIRED) else score


def key_score(counts: Counter, n: int, quoted: bool) -> float:
    """0 to 1 for a string with these characters: keys are long, mix character classes and spread over many characters."""
    if n < MIN_CHARS or any(c.isspace() for c in counts):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = {0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 for c in counts}
    if 2 not in kinds and not (quoted and len(kinds) >= 2):
        return 0.0
    return min(1.0, 0.25 * (len(kinds) - 1) + 0.15 * entropy + 0.1 * quoted)


def literal_score(value: str, quoted: bool) -> float:
    if len(value) < MIN_CHARS or PLACEHOLDER.match(value):
        return 0.0
    return key_score(Counter(value), len(value), quoted)


#: A literal's start, end and whether it is quoted, and the name that a bare word may be.
Part = tuple[int, int, bool, str]


class Lexer:
    """Reads the pairs of one text."""

    def __init__(self, text: str):
        self.text = text
        self.unclosed: set[str] = set()  # long quotes that close nowhere from here on

    def literal(self, at: int) -> tuple[list[Part], int] | None:
        """The literal at ``at``, its lines apart if it has several, and its end."""
        text = self.text
        at = BLANK.match(text, at).end()
        if m := PREFIX.match(text, at):
            at = m.end()
        for mark in LONG_QUOTES:
            if text.startswith(mark, at) and mark not in self.unclosed:
                start = at + len(mark)
                end = text.find(mark, start)
                if end < 0:
                    self.unclosed.add(mark)
                    continue
                return self.lines(start, end), end + len(mark)
        if m := QUOTED.match(text, at):
            start, end = m.span(m.lastindex)
            return [(start, end, True, "")] if end > start else [], m.end()
        if m := BARE.match(text, at):
            word = m[0].rstrip(".:!?")
            return [(at, at + len(word), False, word if IDENTIFIER.match(word) else "")] if word else [], m.end()
        return None

    def lines(self, start: int, end: int) -> list[Part]:
        out = []
        for m in LINE.finditer(self.text, start, end):
            bare = m[0].strip()
            if bare:
                a = m.start() + m[0].index(bare)
                out.append((a, a + len(bare), True, ""))
        return out

    def block(self, at: int, indent: int) -> int:
        """Where the lines from ``at`` on that are indented deeper than ``indent`` end."""
        text = self.text
        while at < len(text):
            deep = INDENTED.match(text, at).end() - at
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            if deep <= indent and text[at:end].strip():
                break
            at = end + 1
        return min(at, len(text))

    def listed(self, at: int) -> tuple[list[list[Part]], int]:
        """Quoted elements of a list or arguments of a call, each a value."""
        values = []
        while QUOTE.match(self.text, at) and (value := self.literal(at)):
            values += [[part] for part in value[0]]
            at = value[1]
            after = BETWEEN.match(self.text, at).end()
            if not QUOTE.match(self.text, after):
                break
            at = after
        return values, at

    def value(self, at: int) -> tuple[list[list[Part]], int]:
        """Values on the right of a sign (several lines are several, a sum is one of several parts), and their end."""
        after = BLANK.match(self.text, at).end()
        if self.text.startswith("[", after) and QUOTE.match(self.text, start := BETWEEN.match(self.text, after + 1).end()):
            return self.listed(start)
        parts: list[Part] = []
        while value := self.literal(at):
            found, at = value
            if len(found) > 1:
                return [[p] for p in [*parts, *found]], at
            parts += found
            quoted = self.text[at - 1] in "\"'`"
            if plus := PLUS.match(self.text, at):
                at = plus.end()
            elif not (quoted and QUOTE.match(self.text, at)):  # literals side by side are one
                break
        return [parts] if parts else [], at

    def pairs(self) -> Iterator[tuple[str, list[list[Part]]]]:
        """Name and values of every assignment."""
        text, around, at = self.text, [], 0
        deeper: list[tuple[int, str]] = []  # indents and names of lines that open a block
        opening = section = ""
        line, following, first = 0, text.find("\n") + 1, True  # starts of this line and the next; whether no lexeme was on it
        for m in LEXEME.finditer(text):
            while 0 < following <= m.start():
                line, following, first = following, text.find("\n", following) + 1, True
            alone, first = first, False
            if m.start() < at:  # inside a literal
                continue
            if m[3]:
                if m[3] == "{":
                    around.append(opening)
                elif around:
                    around.pop()
                opening = ""
                continue
            if m[4]:
                section, opening, deeper = m[4].strip(), "", []
                continue
            if m[5]:
                bare = m[6].strip()
                start = m.start(6) + m[6].index(bare)
                if bare:
                    yield m[5], [[(start, start + len(bare), False, bare if IDENTIFIER.match(bare) else "")]]
                continue
            name, own = m[1], m[1]
            indent = m.start(1) - line if m[2] == ":" and alone and not text[line : m.start(1)].strip("- \"'\t") else -1
            if indent >= 0:
                while deeper and deeper[-1][0] >= indent:
                    deeper.pop()
            if name.lower() in GENERIC:
                outer = around[-1] if around and around[-1] else deeper[-1][1] if deeper and indent >= 0 else section
                own = f"{outer}.{name}" if outer else name
            if m[2] == "(":
                values, at = self.listed(m.end())
                if values:
                    yield own, values
                continue
            if indent >= 0 and (head := BLOCK.match(text, m.end())):
                at = self.block(head.end(), indent)
                yield own, [[p] for p in self.lines(head.end(), at)]
                continue
            values, end = self.value(m.end())
            opening = ""
            if values:
                if values[0][0][2]:
                    at = end
                yield own, values
                continue
            after = BLANK.match(text, m.end()).end()
            if text.startswith("{", after):
                opening = own
            elif indent >= 0 and (after == len(text) or text[after] == "\n"):
                deeper.append((indent, own))


class Constants:
    """What names are bound to in a text."""

    def __init__(self, text: str):
        self.text = text
        self.values: dict[str, list[list[Part]]] = {}
        self.folds: dict[str, tuple[Counter, int, bool]] = {}
        for name, values in Lexer(text).pairs():
            self.values.setdefault(name, []).extend(values)

    def is_literal(self, part: Part) -> bool:
        """A bare word without a digit is a name or prose."""
        start, end, quoted, name = part
        return quoted or not name or bool(re.search("[0-9]", self.text[start:end]))

    def fold(self, value: list[Part]) -> tuple[Counter, int, bool]:
        """Characters of a sum, how many, and whether a part of it is quoted; names in it must be folded already."""
        counts, n, any_quoted = Counter(), 0, False
        for part in value:
            start, end, quoted, name = part
            if name in self.values and not quoted:
                more, length, was = self.folds.get(name, (Counter(), 0, False))  # nothing for a name in its own sum
            elif not name:
                more, length, was = Counter(self.text[start:end]), end - start, quoted
            else:
                continue
            counts, n, any_quoted = counts + more, n + length, any_quoted or was
        return counts, n, any_quoted

    def whole_score(self, value: list[Part]) -> float:
        """Score of a sum as one literal."""
        open_ = [n for *_, quoted, n in value if not quoted and n in self.values and n not in self.folds]
        busy = set()
        while open_:
            first = self.values[open_[-1]][0] if self.values[open_[-1]] else []
            if open_[-1] not in self.folds and open_[-1] not in busy:
                busy.add(open_[-1])
                open_ += [n for *_, quoted, n in first if not quoted and n in self.values and n not in self.folds and n not in busy]
                continue
            name = open_.pop()
            if name not in self.folds:
                self.folds[name] = self.fold(first)
        counts, n, quoted = self.fold(value)
        return key_score(counts, n, quoted) if len(counts) > 1 else 0.0


def lexed_spans(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that reach a sensitive name."""
    if "=" not in text and ":" not in text and "(" not in text and "</" not in text:
        return []
    bound = Constants(text)
    sensitive = sorted(((s, name) for name in bound.values if (s := name_score(name))), reverse=True)
    seen: set[tuple[str, bool]] = set()
    found: dict[tuple[int, int], float] = {}
    for score, name in sensitive:  # the most sensitive first, so each name is passed once, and once as a part of a key
        open_ = [(name, 0.0)]
        while open_:
            name, key = open_.pop()
            if name not in bound.values or (name, key > 0) in seen:
                continue
            seen.add((name, key > 0))
            for value in bound.values[name]:
                whole = key
                if len(value) > 1 and (own := bound.whole_score(value)) and score + own >= MIN_SCORE:
                    whole = max(key, score + own)
                for part in value:
                    start, end, quoted, ref = part
                    if ref and not quoted:
                        open_.append((ref, whole))
                    if ref in bound.values and not quoted or not bound.is_literal(part):
                        continue
                    own = literal_score(text[start:end], quoted)
                    best = max(0.0 if ref else whole, score + own if own else 0.0)  # a bare word in a sum may be a name bound elsewhere
                    if best >= MIN_SCORE:
                        found[start, end] = max(found.get((start, end), 0.0), best)
    return sorted((a, b, s) for (a, b), s in found.items())


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], float]:
    """Base spans, all spans, and the best score of a lexed literal."""
    base = base_spans(text)
    lexed = lexed_spans(text)
    # The furthest end of base spans up to a start tells whether one of them holds the literal.
    starts, ends = [x for x, _, _ in base], list(itertools.accumulate((y for _, _, y in base), max))
    new = [(a, 3, b) for a, b, _ in lexed if not ((k := bisect.bisect_right(starts, a)) and ends[k - 1] >= b)]
    return base, sorted(base + new), max((s for *_, s in lexed), default=0.0)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame) -> DataFrame:
    """``SCHEMA`` for ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans, score = scan(text or "")
                kinds = Counter(kind for _, kind, _ in spans)
                rows.append((kinds[0], kinds[1], kinds[2], hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans), kinds[3], score))
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns and marks in place of secrets in ``text``; ``n_chars`` follows the text."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = []
            for text in texts:
                spans = scan(text)[1] if text else []
                new.append(redact(text, spans) if spans else text)
            columns = [pa.array(new, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.record_batch(columns, names)

    out = docs.withColumn("text", F.col("text").cast("string"))
    out = out.mapInArrow(run, out.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


QUERIES = {"op3_secrets": op3_secrets}
ORACLE_SQL: dict[str, str] = {}
