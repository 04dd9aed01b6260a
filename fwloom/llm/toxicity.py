"""Operator 4: toxicity by noisy-channel deobfuscation.

The channel: a writer hides a word by look-alike symbols, by separators between its letters, or by repeating
letters. Every suspicious token becomes a lattice of letters (each symbol with what it may stand for, each
separator and repeat with a way to drop it); Viterbi decoding under a character trigram model, counted over
all documents, restores the likeliest word. Restored text is then scored. Words written as four or more single
letters in a row, with or without separators, are read as one lattice whose hidden states include the edges between
words; learnt words are also looked up at every letter of such a run. Both are linear in the run.

The scorer is learnt from ``labels.toxic``: words and word beginnings that are significantly commoner in
toxic texts carry log-odds, a document sums them over its distinct words, and a logistic curve turns that
into a probability. Training rows are a sample of at most ``TRAIN_ROWS`` labelled texts, in the order of
a hash of id and text, and only of those whose crc32(doc_id) mod 3 is not 1. Labels, lang, source and doc_id
are no inputs of a score.

Trigram counts and feature counts are summed by Spark; what reaches the driver is bounded by the alphabet's cube and
by ``TRAIN_ROWS``: the labelled sample, and the features that pass the test on it, all of them. Documents are
scored in one pass without a shuffle.

Defined results: null and empty texts score like a text without evidence; a null doc_id is not held out;
of several labels for a document the largest counts, null labels none; without labels of both kinds every
score is the share of toxic labels (0 if there are none); repeated rows repeat; extra columns are dropped.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import materialize, release, table

#: Bound of the labelled sample, and the score from which a text counts as toxic.
TRAIN_ROWS, THRESHOLD = 12_000, 0.7
PREFIXES = (4, 5, 6)
MEMO_WORDS = 300_000
#: Fewest letters of a spaced run and of a learnt word looked up in it, and most of a run that counts as one word.
RUN_LETTERS, RUN_WORD = 4, 24
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SIZE = len(LETTERS) + 1  # 0 is the edge of a word
#: What a symbol may stand for.
LOOKALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i"}
READABLE = frozenset(LETTERS).union(LOOKALIKE)
SEPARATORS = ".-_*~^'`·"
#: Channel log probabilities: a look-alike read as a letter, a dropped separator, a dropped or kept repeat.
LOG_LOOK, LOG_DROP, LOG_REPEAT, LOG_KEEP = math.log(0.4), math.log(0.9), math.log(0.5), math.log(0.5)

SUSPECT = re.compile(r"[0-9@$!|+€£(¡.\-_*~^'`·]|(.)\1")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
FIRST_SYMBOL = re.compile(r"[@$!|+€£(¡0-9]+[^\W\d_]")
LAST_SYMBOL = re.compile(r"[^\W\d_][@$0-9]+$")

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def fold(word: str) -> str:
    """Lower case, letters without their accents; what has no Latin reading stays as it is."""
    if word.isascii():
        return word.lower()
    return unicodedata.normalize("NFKD", word).encode("ascii", "ignore").decode().lower() or word.lower()


FOLD_BYTES = bytes(b - 96 if 97 <= b <= 122 else (b - 64 if 65 <= b <= 90 else 0) for b in range(256))


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams of all documents, accents folded, words set off by edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            texts = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore") for t in batch.column(0).to_pylist() if t]
            codes = np.frombuffer(b"\0\0" + b"\0\0".join(texts).translate(FOLD_BYTES) + b"\0\0", np.uint8).astype(np.int32)
            total += np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int32()), pa.array(total[found])], ["code", "n"])

    out = np.zeros(SIZE**3, dtype=np.int64)
    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # at most SIZE ** 3 rows
        out[row["code"]] = row["n"]
    return out


class Channel:
    """Viterbi decoder of character lattices."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(SIZE, SIZE, SIZE) + 0.05
        self.log = np.log(cube / cube.sum(axis=2, keepdims=True)).tolist()

    def lattice(self, token: str) -> list[list[tuple[int, float]]]:
        """For each character the letters it may stand for (0: dropped) with channel log probabilities."""
        out, last = [], ""
        for c in token:
            at = LETTERS.find(c) + 1
            if at:
                out.append([(at, LOG_KEEP), (0, LOG_REPEAT)] if c == last else [(at, 0.0)])
            elif c in LOOKALIKE:
                out.append([(LETTERS.find(x) + 1, LOG_LOOK) for x in LOOKALIKE[c]])
            else:
                out.append([(0, LOG_DROP)])
            last = c if c.isalpha() else last
        return out

    def decode(self, token: str) -> str:
        """The likeliest word behind a folded token."""
        return "".join(self.words(token, False))

    def words(self, run: str, spaced: bool = True) -> list[str]:
        """The likeliest words behind folded letters; ``spaced`` lets words end at any letter."""
        log = self.log
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in self.lattice(run):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in states.items():
                for letter, cost in options:
                    if letter:
                        key, value, way = (b, letter), score + cost + log[a][b][letter], (letter, path)
                    else:
                        key, value, way = (a, b), score + cost, path
                    if key not in after or value > after[key][0]:
                        after[key] = (value, way)
            if spaced:
                for (a, b), (score, path) in list(after.items()):
                    if b and ((b, 0) not in after or score + log[a][b][0] > after[b, 0][0]):
                        after[b, 0] = (score + log[a][b][0], (0, path))
            states = after
        _, path = max(((s + (log[a][b][0] if b else 0.0), p) for (a, b), (s, p) in states.items()), key=lambda x: x[0])
        word = []
        while path:
            word.append(LETTERS[path[0] - 1] if path[0] else " ")
            path = path[1]
        return "".join(reversed(word)).split()

    def readings(self, token: str) -> set[str]:
        """Words to score for a token: as written, and as restored if it looks hidden."""
        word = fold(EDGE.sub("", token))
        if not word:
            return set()
        found, shapes = {word}, set()
        if SUSPECT.search(word):
            shapes.add(word)
        # Symbols at the edge may be letters of the word.
        if FIRST_SYMBOL.match(token):
            shapes.add(fold(re.sub(r"[\W_]+$", "", token)))
        if LAST_SYMBOL.search(token):
            shapes.add(fold(re.sub(r"^[\W_]+", "", token)))
        if shapes:
            for shape in shapes:
                if sum(c in READABLE for c in shape) >= 2:  # else the lattice yields no word
                    found.add(self.decode(shape))
            found |= {re.sub(r"(.)\1+", r"\1", x) for x in list(found) if re.search(r"(.)\1", x)}
            found |= {x for x in re.split(r"[^a-z]+", word) if len(x) > 3}
        return found


def runs_of(tokens: list[str]) -> list[str]:
    """Folded letters of words written as single letters in a row. Up to two separators may stand beside a letter."""
    found: list[str] = []
    run: list[str] = []
    at = -2
    for i in [*(i for i, t in enumerate(tokens) if len(t) == 1 or len(t) < 4 and not t.isalpha()), -1]:
        t = tokens[i] if i >= 0 else ""
        c = t if len(t) == 1 and (t.isalnum() or t in LOOKALIKE) else EDGE.sub("", t)
        single = t and len(c) < 2
        if run and (not single or i != at + 1):
            letters = fold("".join(run))
            if len(letters) >= RUN_LETTERS:
                found.append(letters)
            run = []
        if single:
            run.append(c)
            at = i
    return found


def tokens_and_runs(text: str) -> tuple[set[str], list[str]]:
    """Distinct tokens in lower case with short runs of single letters as one word, and all such runs."""
    tokens = text.lower().split()
    runs = runs_of(tokens)
    return {*tokens, *(r for r in runs if len(r) <= RUN_WORD)}, runs


def tokens_of(text: str) -> set[str]:
    return tokens_and_runs(text)[0]


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def scaled(total: float, top: float, density: float) -> tuple[float, float, float]:
    """Evidence as the logistic curve takes it."""
    return math.log1p(total), top, math.log1p(20 * density)


class Scorer(dict):
    """Evidence of a text: sum of log-odds over distinct tokens, the largest, and the sum for each token.

    A mapping of known tokens to log-odds.
    """

    def __init__(self, counts: np.ndarray, weights: dict[str, float], curve: tuple[float, ...] = ()):
        self.counts, self.weights, self.curve = counts, weights, curve
        self.channel = Channel(counts)
        words = [w for w in weights if len(w) >= RUN_LETTERS and w.isalpha() and w.isascii()]
        self.beginnings = {w[:n] for w in words for n in range(len(w) + 1)}
        self.longest = 2 * max(map(len, words), default=0)

    def __missing__(self, token: str) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        get = self.weights.get
        value = self[token] = max((get(f, 0.0) for w in self.channel.readings(token) for f in features_of(w)), default=0.0)
        return value

    def learnt_in(self, run: str) -> set[str]:
        """Learnt words at any place of a run of letters; more than two equal letters count as two."""
        run = re.sub(r"(.)\1\1+", r"\1\1", run)
        options = [[LETTERS[o - 1] for o, _ in at if o] for at in self.channel.lattice(run)]
        found = set()
        for start in range(len(run)):
            states, last = {""}, ""
            for c, letters in zip(run[start : start + self.longest], options[start : start + self.longest]):
                after = {w + x for w in states for x in letters if w + x in self.beginnings}
                if not letters or c == last:  # a dropped separator or repeat
                    after |= states - {""}
                if not after:
                    break
                found.update(w for w in after if len(w) >= RUN_LETTERS and w in self.weights)
                states, last = after, c
        return found

    def evidence(self, text: str) -> tuple[float, float, float]:
        tokens, runs = tokens_and_runs(text)
        for run in runs:
            tokens.update(self.channel.words(run))
            learnt = self.learnt_in(run)
            if learnt:  # they stand for the run
                tokens.discard(run)
                tokens |= learnt
        hits = [w for w in map(self.__getitem__, tokens) if w]
        return sum(hits), max(hits, default=0.0), sum(hits) / max(1, len(tokens))

    def score(self, text: str) -> float:
        if len(self.curve) == 1:
            return self.curve[0]
        bias, *slopes = self.curve
        logit = bias + sum(a * x for a, x in zip(slopes, scaled(*self.evidence(text))))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, logit))))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the labelled sample: at most ``TRAIN_ROWS`` texts, however many rows an id or a text has.

    An id with a text counts once. Only their hashes are gathered to choose from; they number ``TRAIN_ROWS`` at most, so the join sends them to
    every task.
    """
    allowed = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("toxic").cast("int").alias("toxic"))
    allowed = allowed.where(F.crc32(F.col("labelled").cast("string").cast("binary")) % 3 != 1)
    own = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    known = materialize(own.select("id", "h").join(allowed, F.col("id") == F.col("labelled")).select("labelled", "h", "toxic").distinct())
    order = F.xxhash64("labelled", "h")
    share = F.pmod(order, F.lit(max(1, known.count()))) < TRAIN_ROWS
    sample = known.where(share).orderBy(order, "labelled", "h").limit(TRAIN_ROWS).collect()
    release(known)
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in sample], "labelled long, s long, toxic int")
    rows = own.join(F.broadcast(chosen), (F.col("id") == F.col("labelled")) & (F.col("h") == F.col("s")))
    return rows.groupBy("labelled", "s").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def feature_weights(rows: DataFrame, counts: np.ndarray) -> dict[str, float]:
    """Log-odds of features whose excess in toxic texts passes a likelihood-ratio test at the level of their number."""
    totals = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(True, 0), totals.get(False, 0)
    if not n1 or not n0:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel, memo = Channel(counts), {}
        for batch in batches:
            found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = set()
                tokens, runs = tokens_and_runs(text or "")
                for t in tokens.union(*map(channel.words, runs)):
                    if t not in memo:
                        if len(memo) >= MEMO_WORDS:
                            memo.clear()
                        memo[t] = [f for w in channel.readings(t) for f in features_of(w)]
                    own.update(memo[t])
                for f in own:
                    found[f][toxic == 1] += 1
            yield pa.record_batch([pa.array(list(found), pa.string()), pa.array([v[1] for v in found.values()], pa.int64()), pa.array([v[0] for v in found.values()], pa.int64())], ["feature", "toxic", "clean"])

    summed = materialize(rows.mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("k1"), F.sum("clean").alias("k0")))
    k1, k0, share = F.col("k1"), F.col("k0"), n1 / (n1 + n0)
    n = k1 + k0
    xlogy = lambda x, y: F.when(x > 0, x * F.log(y)).otherwise(0.0)
    test = 2 * (xlogy(k1, k1 / (n * share)) + xlogy(k0, k0 / (n * (1 - share))))
    odds = F.log((k1 + 0.5) / (n1 + 1.0)) - F.log((k0 + 0.5) / (n0 + 1.0))
    tested = summed.where((k1 > 1) & (k1 > n * share)).select("feature", odds.alias("odds"), test.alias("test"))
    number = max(summed.count(), 2)
    kept = tested.where((F.col("test") >= 2 * math.log(number)) & (F.col("odds") >= 1.5)).orderBy("feature").collect()
    release(summed)
    return {r["feature"]: r["odds"] for r in kept}


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    ridge, beta = np.array([1e-3, 0.05, 0.05, 0.05]), np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Channel model from all documents, scorer from the labelled sample."""
    counts = trigram_counts(docs)
    rows = materialize(training_rows(docs, labels))
    weights = feature_weights(rows, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(counts, weights)
        for batch in batches:
            found = [scorer.evidence(t or "") for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64()), batch.column(1)], ["total", "top", "density", "toxic"])

    seen = rows.mapInArrow(run, "total double, top double, density double, toxic int").collect()  # the labelled sample
    release(rows)
    y = np.array([float(r["toxic"] == 1) for r in seen])
    if not len(y) or y.min() == y.max():
        return Scorer(counts, weights, (float(y.mean()) if len(y) else 0.0,))
    return Scorer(counts, weights, fit_curve(np.array([scaled(r["total"], r["top"], r["density"]) for r in seen]), y))


def score_texts(docs: DataFrame, model: Scorer, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, in a new ``column``; another name is needed where ``docs`` has one of it."""
    if column in docs.columns:
        raise ValueError(f"a column named {column} is there already")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    names = docs.columns
    state = docs.sparkSession.sparkContext.broadcast((model.counts, model.weights, model.curve))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*state.value)
        at = names.index("text")
        for batch in batches:
            scores = [scorer.score(t or "") for t in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], [*names, column])

    return docs.mapInArrow(run, docs.withColumn(column, F.lit(0.0)).schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``SCHEMA`` for every document."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score_texts(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE_SQL: dict[str, str] = {}
