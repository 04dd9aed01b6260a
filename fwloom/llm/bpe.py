"""Operator 8: BPE encoding and decoding.

Merges run over a doubly linked list of symbols. A priority queue holds the merge rank and place of every
adjacent pair; an entry whose pair has changed since it was pushed is stale and skipped. Decoding
concatenates vocabulary strings (this tokenizer has no decoder, so the library puts a space between them).

Texts consist of far fewer distinct words than words, so a task keeps a bounded memo of words; every text is
still encoded whole. Nothing is shuffled: the operator is one pass over the table.

Defined results: a null text counts as empty; an empty text has no ids, and both hashes are those of the
empty string; repeated rows give repeated results; extra columns of the input are dropped, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm.common import table

#: Entries of a task's word memo; it is emptied when full, which bounds memory and changes no result.
MEMO_WORDS = 300_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return table


#: All characters up to here are assigned.
HIGH = re.compile("[^\x00-\u0377]")


def has_unassigned(text: str) -> bool:
    """Whether a character is unknown to Python's Unicode tables."""
    return bool(HIGH.search(text)) and any(unicodedata.category(c) == "Cn" for c in set(text))


class WordBpe:
    """Encoder for a tokenizer file with lower-casing, word-end marks and byte-level symbols."""

    ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    #: These four split Python's str.split() but are no white space to the tokenizer.
    ODD_SPACE = re.compile("[\x1c-\x1f]")
    SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.strings = {i: s for s, i in (vocab | self.special).items()}
        self.by_decimal = {str(i): s for i, s in self.strings.items()}
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merge.setdefault(vocab[left] << 20 | vocab[right], (rank, vocab[left + right]))
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in symbols.items()}
        self.path, self._library = path, None
        self.first = [vocab[symbols[b]] for b in range(256)]
        self.last = [vocab[symbols[b] + self.end] for b in range(256)]
        self.words: dict[str, tuple[int, ...]] = {}

    def library(self):
        """Splits and lower-cases the few texts with characters newer than Python's Unicode tables; merges stay here."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= MEMO_WORDS:
                self.words.clear()
            known = self.words[word] = tuple(self.merged(word.encode()))
        return known

    def merged(self, data: bytes) -> list[int]:
        """Applies merges, lowest rank first and leftmost among equals."""
        first, merge = self.first, self.merge
        ids = [first[b] for b in data]
        ids[-1] = self.last[data[-1]]
        n = len(ids)
        if n == 1:
            return ids
        queue = []
        for i in range(n - 1):
            found = merge.get(ids[i] << 20 | ids[i + 1])
            if found:
                queue.append(found[0] << 40 | i)
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            found = merge.get(ids[i] << 20 | ids[j])
            if not found or found[0] != entry >> 40:
                continue  # stale: one of the two symbols has changed
            ids[i], ids[j] = found[1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                nxt = merge.get(ids[i] << 20 | ids[k])
                if nxt:
                    push(queue, nxt[0] << 40 | i)
            h = before[i]
            if h >= 0:
                nxt = merge.get(ids[h] << 20 | ids[i])
                if nxt:
                    push(queue, nxt[0] << 40 | h)
        return [i for i in ids if i >= 0]

    def normalized(self, text: str) -> str:
        """Composed and lower-cased; white space is left to the split."""
        if text.isascii():
            return text.lower()
        if has_unassigned(text):
            return self.library().normalizer.normalize_str(text)
        # Lower-casing is by character: a final sigma gets no form of its own.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def chunks(self, text: str) -> list[str]:
        """Pieces between white space; no pre-token crosses white space."""
        text = self.normalized(text)
        if self.ODD_SPACE.search(text):
            return [c for c in self.SPACE.split(text) if c]
        return text.split()

    def pretokens(self, chunk: str) -> list[str]:
        if chunk.isascii():
            return self.ASCII.findall(chunk)
        if has_unassigned(chunk):
            pieces = self.library().pre_tokenizer.pre_tokenize_str(chunk)
            return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in pieces]
        return self.WORDS.findall(chunk)

    def chunk_ids(self, chunk: str) -> list[int]:
        return [i for word in self.pretokens(chunk) for i in self.word_ids(word)]

    def segments(self, text: str) -> list[str]:
        """Text between special tokens, and these tokens themselves."""
        if self.special_re is None or "<|" not in text:
            return [text]
        return [s for s in self.special_re.split(text) if s]

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.segments(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                for chunk in self.chunks(part):
                    ids += self.chunk_ids(chunk)
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


class ChunkMemo(dict):
    """Maps a chunk to what ``make`` gives for its ids.

    When full, its entries become the older half and a lookup there brings one back; so it holds
    ``2 * MEMO_WORDS`` entries at most and common chunks stay.
    """

    def __init__(self, bpe: WordBpe, make):
        self.bpe, self.make, self.older = bpe, make, {}

    def __missing__(self, chunk: str):
        if len(self) >= MEMO_WORDS:
            self.older = dict(self)
            self.clear()
        value = self.older.get(chunk)
        self[chunk] = value = self.make(self.bpe.chunk_ids(chunk)) if value is None else value
        return value

    def of(self, text: str) -> list:
        """The values of all chunks of a text, in order."""
        get, out = self.__getitem__, []
        for part in self.bpe.segments(text):
            if part in self.bpe.special:
                out.append(self.make([self.bpe.special[part]]))
            else:
                out += map(get, self.bpe.chunks(part))
        return out


class StringMemo(dict):
    """Maps decimal ids, joined by spaces, to their vocabulary strings; emptied when full."""

    def __init__(self, bpe: WordBpe):
        self.of_id = bpe.by_decimal

    def __missing__(self, ids: str) -> str:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[ids] = " ".join(map(self.of_id.__getitem__, ids.split()))
        return value


_LOADED: dict[str, WordBpe] = {}
_MEMOS: dict[tuple, ChunkMemo] = {}


def decimals(ids: list[int]) -> str:
    return " ".join(map(str, ids))


def words_le(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def memo_of(path: str | None, make) -> ChunkMemo:
    """The memo for a tokenizer and a module-level function; it outlives the tasks of a Python process."""
    key = (path or tokenizer_path(), make)
    if key not in _MEMOS:
        _MEMOS[key] = ChunkMemo(load(key[0]), make)
    return _MEMOS[key]


def load(path: str) -> WordBpe:
    """The tokenizer of ``path``, read once in a Python process."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``SCHEMA`` for ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path or tokenizer_path())
        memo, strings = memo_of(path, decimals), StringMemo(bpe)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                parts = memo.of(text or "")
                joined = " ".join(parts)
                n.append(joined.count(" ") + 1 if parts else 0)
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sha.append(hashlib.sha256(" ".join(map(strings.__getitem__, parts)).encode()).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def encode_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids array<int>, decoded string: the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path or tokenizer_path())
        for batch in batches:
            ids = [bpe.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


QUERIES = {"op8_bpe": op8_bpe}
ORACLE_SQL: dict[str, str] = {}
