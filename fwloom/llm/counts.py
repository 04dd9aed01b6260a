"""Operator 6: edit-aware token counts.

A document's text is cut into leaves of some dozens of pre-tokens where no pre-token, normalisation or special token of the tokenizer can reach
over: at white space, beside digits, and between letters and punctuation of ASCII (``BORDER``), so counts of leaves add up, in
texts without white space too. A segment tree over the leaves holds characters and tokens. An edit finds
its leaves by character offset, re-encodes only these (and a leaf beside them, if the characters that now meet are no such
border) and updates sums on the way to the root. A leaf
that has grown past ``GROWN`` times its size is split. Only a run of one kind without any border, such as letters alone, is one leaf however long, as it is one pre-token.

``build_trees`` encodes documents once and keeps a tree as a narrow row without the text: characters and tokens of
each leaf; leaf texts follow from the document, sums above the leaves from these, neither by encoding.
``apply_edits`` brings documents, their trees and a table of edits together and gives the edited documents with
their new trees, so a later batch of edits starts from stored counts. The three meet by one shuffle on doc_id
and stream through a task in the order of the document and of ``seq``, so a task holds one document's texts and
trees and no list of edits, however many there are. If few documents have edits (``FEW_IDS``, counted), only these
move; else all do, and the others go at the end of the stream.

The query needs an edit log, which the tables do not have: ``routine_edits`` makes one for every document
from its length alone (a replaced word, an insertion, a deletion, an appended line). Offsets are code points in
the text as edited so far.

Defined results: a null text counts as empty, which has no tokens before and those of the insertions after;
offsets beyond the end mean the end, a null start the start, an end before the start (or null) the start, a null
new text nothing; edits apply in the order of ``seq`` (null first), then start, end and text; edits of an unknown
or null doc_id apply nowhere; every row of a doc_id gets its edits, repeated rows repeat (equal texts under one
id are held once); extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm import bpe, merges
from fwloom.llm.common import materialize, table

#: Characters from which a leaf ends at the next border, and times that from which it is split.
LEAF_CHARS, GROWN = 256, 4
#: Places where pre-tokens always end: before white space; before a digit, and after one before ASCII, since a digit is a pre-token of its own; between punctuation
#: and letters, but not after an apostrophe (``'s``) and not within ``<|...|>``, which may be a special token.
BORDER = re.compile(r"(?=[ \t\n\r0-9])|(?<=[0-9])(?=[!-~])|(?<=[!-&(-/:-@\[-`{}~])(?=[A-Za-z])|(?<=[A-Za-z])(?=[!-/:-@\[-`{}~])")


def meets_border(before: str, after: str) -> bool:
    """Whether a border lies between two texts, by the characters that meet; an empty one says nothing."""
    return bool(BORDER.match(before[-1:] + after[:1], len(before[-1:])))


#: Ids of edited documents up to which they are sent to every task (8 MB).
FEW_IDS = 1_000_000

TREES = "doc_id long, text_key long, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long"
EDITED = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long, n_edits long, n_tokens_before long, leaves_encoded long, chars_encoded long"


def leaves_of(text: str) -> list[str]:
    """Parts of a text, with a border between any two."""
    cuts, at = [0], LEAF_CHARS
    while m := BORDER.search(text, at):
        cuts.append(m.start())
        at = m.start() + LEAF_CHARS
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


class TokenTree:
    """Segment tree of characters and tokens over the leaves of one text, from counts already known."""

    def __init__(self, leaves: list[str], tokens: list[int], memo: bpe.ChunkMemo):
        self.memo, self.encoded, self.encoded_chars = memo, 0, 0
        self.build(leaves, tokens)

    @classmethod
    def of(cls, text: str, memo: bpe.ChunkMemo) -> TokenTree:
        leaves = leaves_of(text)
        return cls(leaves, [sum(memo.of(leaf)) for leaf in leaves], memo)

    @classmethod
    def stored(cls, text: str, chars: list[int], tokens: list[int], memo: bpe.ChunkMemo) -> TokenTree:
        leaves, at = [], 0
        for n in chars:
            leaves.append(text[at : at + n])
            at += n
        return cls(leaves, tokens, memo)

    def build(self, leaves: list[str], tokens: list[int]) -> None:
        """Sums of all nodes; nothing is encoded."""
        self.leaves = leaves or [""]
        self.size = 1 << max(0, len(self.leaves) - 1).bit_length()
        rest = self.size - len(self.leaves)
        self.chars = [0] * self.size + [*map(len, self.leaves), *[0] * rest]
        self.tokens = [0] * self.size + [*(tokens or [0]), *[0] * rest]
        for sums in (self.chars, self.tokens):
            for i in range(self.size - 1, 0, -1):
                sums[i] = sums[2 * i] + sums[2 * i + 1]

    @property
    def count(self) -> int:
        return self.tokens[1]

    def find(self, offset: int) -> tuple[int, int]:
        """Leaf that holds the character before or at ``offset``, and the offset within it."""
        node = 1
        while node < self.size:
            node *= 2
            if offset > self.chars[node]:
                offset -= self.chars[node]
                node += 1
        return node - self.size, offset

    def start_of(self, leaf: int) -> int:
        """Characters before a leaf."""
        node, before = self.size + leaf, 0
        while node > 1:
            if node & 1:
                before += self.chars[node - 1]
            node //= 2
        return before

    def put(self, leaf: int, text: str) -> None:
        """Re-encodes a leaf and updates the sums above it."""
        self.leaves[leaf] = text
        node = self.size + leaf
        self.chars[node], self.tokens[node] = len(text), self.encode(text)
        while node := node // 2:
            self.chars[node], self.tokens[node] = self.chars[2 * node] + self.chars[2 * node + 1], self.tokens[2 * node] + self.tokens[2 * node + 1]

    def encode(self, text: str) -> int:
        self.encoded += bool(text)
        self.encoded_chars += len(text)
        return sum(self.memo.of(text)) if text else 0

    def split(self, leaf: int, text: str) -> None:
        """Puts the parts of a grown leaf in its place; empty leaves go, counts of the others stay."""
        parts = leaves_of(text)
        own = [(x, self.tokens[self.size + i]) for i, x in enumerate(self.leaves[:leaf]) if x]
        own += [(x, self.encode(x)) for x in parts]
        own += [(x, self.tokens[self.size + leaf + 1 + i]) for i, x in enumerate(self.leaves[leaf + 1 :]) if x]
        self.build([x for x, _ in own], [n for _, n in own])

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces code points ``start`` to ``end`` by ``new``."""
        start = min(max(start, 0), self.chars[1])
        end = min(max(end, start), self.chars[1])
        first, at = self.find(start)
        last, upto = self.find(end)
        text = self.leaves[first][:at] + new + self.leaves[last][upto:]
        for i in range(first + 1, last + 1):
            if self.leaves[i]:
                self.put(i, "")
        # What comes after and before may now run on over the ends of the new text.
        following = last + 1
        while True:
            while following < len(self.leaves) and not self.leaves[following]:
                following += 1
            runs_on = following < len(self.leaves) and not meets_border(text, self.leaves[following])
            before = self.start_of(first)
            if runs_on and text:
                text += self.leaves[following]
                self.put(following, "")
                continue
            leaf = self.find(before)[0] if before else first
            if not before or not (runs_on or text and not meets_border(self.leaves[leaf], text)):
                break
            self.put(first, "")
            first, text = leaf, self.leaves[leaf] + text
        if len(text) > GROWN * LEAF_CHARS and BORDER.search(text, LEAF_CHARS):
            self.split(first, text)
        else:
            self.put(first, text)

    def text(self) -> str:
        return "".join(self.leaves)

    def row(self) -> tuple[str, list[int], list[int], int]:
        kept = [i for i, x in enumerate(self.leaves) if x]
        return self.text(), [len(self.leaves[i]) for i in kept], [self.tokens[self.size + i] for i in kept], self.count


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def build_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``TREES`` of (doc_id, text): every text is encoded whole, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = merges.batch_memo(path, merges.count_of)
        for batch in batches:
            cut = [leaves_of(t) if t else [] for t in batch.column(2).to_pylist()]
            counted = iter(map(sum, memo.many([leaf for leaves in cut for leaf in leaves])))
            tokens = [[next(counted) for _ in leaves] for leaves in cut]
            arrays = [pa.array([list(map(len, x)) for x in cut], pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())), pa.array(list(map(sum, tokens)), pa.int64())]
            yield pa.record_batch([batch.column(0), batch.column(1), *arrays], [f.split()[0] for f in TREES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text").cast("string")).mapInArrow(run, TREES)


def trees_of(edited: DataFrame) -> DataFrame:
    """``TREES`` of edited documents."""
    return edited.select("doc_id", text_key().alias("text_key"), "leaf_chars", "leaf_tokens", "n_tokens")


def edited_ids(edits: DataFrame) -> DataFrame:
    return edits.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """``EDITED``: documents of (doc_id, text) that have ``edits`` (doc_id, seq, start, end, text), after all of them.

    A document without a tree of its text is encoded whole first.
    """
    spark = docs.sparkSession
    none = F.lit(None)
    fill = {"seq": "long", "start": "long", "end": "long", "text": "string", "text_key": "long", "leaf_chars": "array<int>", "leaf_tokens": "array<int>"}
    row = lambda kind, **given: [F.col("doc_id").cast("long").alias("doc_id"), F.lit(kind).alias("kind"), *((given[c] if c in given else none).cast(t).alias(c) for c, t in fill.items())]
    one = trees.select(*row(0, text_key=F.col("text_key"), leaf_chars=F.col("leaf_chars"), leaf_tokens=F.col("leaf_tokens")))
    two = docs.select(*row(1, text=F.coalesce(F.col("text").cast("string"), F.lit("")), text_key=text_key()))
    three = edits.select(*row(2, seq=F.col("seq"), start=F.col("start"), end=F.col("end"), text=F.col("text")))
    ids = edited_ids(edits)
    met = one.unionByName(two).where("doc_id IS NOT NULL")
    if ids.limit(FEW_IDS + 1).count() <= FEW_IDS:
        met = met.join(F.broadcast(ids), "doc_id", "left_semi")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = met.unionByName(three.where("doc_id IS NOT NULL")).repartition(n, "doc_id").sortWithinPartitions("doc_id", "kind", "seq", "start", "end", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = merges.batch_memo(path, merges.count_of)
        stored: dict[int, tuple[list[int], list[int]]] = {}
        held: dict[str, list] = {}  # by text as it was: its tree, how many rows have it, tokens before
        doc, done, edited = None, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal edited
            if edited:
                columns = list(zip(*edited))
                kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 5]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in EDITED.split(", ")])
                edited = []

        def close() -> None:
            for tree, times, before in held.values() if done else ():
                edited.extend([(doc, *tree.row(), done, before, tree.encoded, tree.encoded_chars)] * times)
            held.clear()
            stored.clear()

        for batch in batches:
            for own, kind, _, start, end, text, key, chars, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if own != doc:
                    close()
                    doc, done = own, 0
                if kind == 0:
                    stored[key] = chars, tokens
                elif kind == 1:
                    if text in held:
                        held[text][1] += 1
                        continue
                    chars, tokens = stored.get(key, ([], []))
                    # A key is no proof: characters must add up, else the text is encoded anew.
                    tree = TokenTree.stored(text, chars, tokens, memo) if sum(chars) == len(text) else TokenTree.of(text, memo)
                    held[text] = [tree, 1, tree.count]
                else:
                    done += 1
                    start = start or 0
                    for tree, _, _ in held.values():
                        tree.edit(start, start if end is None else end, text or "")
            yield from flush()
        close()
        yield from flush()

    return met.mapInArrow(run, EDITED)


def routine_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, seq, start, end, text): four edits of every document, from its length alone."""
    n = F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    at = lambda share: F.floor(n * share).cast("long")
    edit = lambda seq, start, end, text: F.struct(F.lit(seq).cast("long").alias("seq"), start.alias("start"), end.alias("end"), F.lit(text).alias("text"))
    log = F.array(edit(1, at(0.25), at(0.25) + 7, "redacted"), edit(2, at(0.5), at(0.5), " and "), edit(3, at(0.75), at(0.75) + 24, ""), edit(4, n + 64, n + 64, "\nEnd of document."))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(log).alias("e")).dropDuplicates(["doc_id", "e"]).select("doc_id", "e.*")


def edited_counts(docs: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """Token counts of (doc_id, text) before and after ``edits``, for every document."""
    trees = materialize(build_trees(docs, path))
    edited = apply_edits(docs, trees, edits, path)
    zero = F.lit(0).cast("long")
    leaves = F.size("leaf_chars").cast("long").alias("n_leaves")
    same = trees.join(edited_ids(edits), "doc_id", "left_anti").select("doc_id", "n_tokens", zero.alias("n_edits"), F.col("n_tokens").alias("n_tokens_edited"), leaves, zero.alias("leaves_encoded"), zero.alias("chars_encoded"))
    changed = edited.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_edited"), leaves, "leaves_encoded", "chars_encoded")
    return changed.unionByName(same)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edited_counts(docs, materialize(routine_edits(docs)))


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLE_SQL: dict[str, str] = {}
