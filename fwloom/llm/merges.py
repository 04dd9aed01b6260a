"""BPE merges of many words at once, for operators that need only ids or counts (1 and 6).

The symbols of all words stand one after the other in one array, linked to their neighbours. A round finds the
lowest merge rank of every word, leftmost among equals, and applies it; words without a merge left are done.
That is the order in which a rank queue takes the merges of a word, one round for a merge.

``BatchEncoder`` gives the ids of whole texts: pre-tokens are cut by classes of characters, equal ones are found by
Arrow's dictionary encoding, each new one is merged once, and the ids of a group of texts are one gather.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex

from fwloom.llm import bpe

#: Longer words go through the queue instead. A place in a word takes ``PLACE_BITS``.
LONGEST, PLACE_BITS = 40, 6
#: Characters of text whose chunks or, in the encoder, pre-tokens are looked up together.
GROUP_CHARS, ENCODER_CHARS = 1 << 20, 1 << 21
NONE = np.int32(2**31 - 1)
#: Classes of characters.
SPACE, LETTER, NUMBER, OTHER = range(4)


def grouped(texts: list[str], most: int) -> Iterator[list[str]]:
    """Texts in order, in groups of ``most`` characters at most or of one text."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end]) <= most):
            chars += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def parts(text: bytes) -> Iterator[bytes]:
    """A long text, cut before spaces into parts of ``ENCODER_CHARS`` bytes or little more."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + ENCODER_CHARS)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start``, ``start + 1``, ... of every run, one run after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


class MergeTable:
    """Open-addressed table from symbol pairs to merge ranks, in arrays."""

    BITS = 20

    def __init__(self, own: bpe.WordBpe):
        self.queue = own.merged
        pairs = np.fromiter(own.merge, np.uint64, len(own.merge))
        rank = np.fromiter((r for r, _ in own.merge.values()), np.int32, len(pairs))
        made = np.fromiter((m for _, m in own.merge.values()), np.int32, len(pairs))
        self.made = np.zeros(int(rank.max(initial=0)) + 1, np.int32)
        self.made[rank] = made
        self.keys = np.full(1 << self.BITS, 2**64 - 1, np.uint64)
        self.ranks = np.full(1 << self.BITS, NONE, np.int32)
        left, at = np.arange(len(pairs)), self.place(pairs)
        while len(left):  # one of those that want a free place gets it, the others go on to the next
            free = left[self.keys[at[left]] == np.uint64(2**64 - 1)]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.ranks[at[won]] = pairs[won], rank[won]
            left = left[self.keys[at[left]] != pairs[left]]
            at[left] = (at[left] + 1) & ((1 << self.BITS) - 1)
        self.first = np.array(own.first, np.int32)
        self.last = np.array(own.last, np.int32)

    def place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs; ``NONE`` where there is no merge."""
        pairs = (x.astype(np.uint64) << np.uint64(20) | y.astype(np.uint64)).ravel()
        at = self.place(pairs)
        out = np.where(self.keys[at] == pairs, self.ranks[at], NONE)
        open_ = np.flatnonzero((self.keys[at] != pairs) & (self.keys[at] != np.uint64(2**64 - 1)))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.BITS) - 1)
            found = self.keys[at[open_]]
            hit = found == pairs[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return out.reshape(x.shape)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all words in order."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        short = length <= LONGEST
        if short.all():
            return self.rounds(b"".join(words), length)
        size = np.empty(len(words), np.int64)
        size[short], ids = self.rounds(b"".join(w for w, x in zip(words, short) if x), length[short])
        queued = [self.queue(words[i]) for i in np.flatnonzero(~short)]
        size[~short] = list(map(len, queued))
        order = np.concatenate([np.flatnonzero(short), np.flatnonzero(~short)])
        start = np.empty(len(words), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return size, np.concatenate([ids, *(np.array(x, np.int32) for x in queued)])[ragged(start, size)]

    def rounds(self, data: bytes, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merged`` for words that are at most ``LONGEST`` bytes long."""
        if not len(length):
            return length, np.empty(0, np.int32)
        symbols = np.frombuffer(data, np.uint8)
        end = np.cumsum(length)
        start = end - length
        ids = self.first[symbols]
        ids[end - 1] = self.last[symbols[end - 1]]
        place = (np.arange(len(ids)) - np.repeat(start, length)).astype(np.int32)
        # Rank and place of the pair that starts at a symbol; one more at the end, where no word is.
        key = np.full(len(ids) + 1, NONE)
        key[:-2] = self.keyed(ids[:-1], ids[1:], place[:-1])
        key[end - 1] = NONE
        before, after = np.arange(-1, len(ids) - 1), np.arange(1, len(ids) + 1)
        while True:
            best = np.minimum.reduceat(key, np.stack([start, end], axis=1).ravel())[::2] if len(start) else start
            open_ = best != NONE
            start, end, best = start[open_], end[open_], best[open_]
            if not len(start):
                break
            i = start + (best & ((1 << PLACE_BITS) - 1))
            j = after[i]
            ids[i], ids[j] = self.made[best >> PLACE_BITS], -1
            key[i] = key[j] = NONE
            after[i] = k = after[j]
            right, h = k < end, before[i]
            left = h >= start
            before[k[right]] = i[right]
            x, y = np.concatenate([i[right], h[left]]), np.concatenate([k[right], i[left]])
            key[x] = self.keyed(ids[x], ids[y], place[x])
        stay = ids >= 0
        return np.add.reduceat(stay, np.cumsum(length) - length, dtype=np.int64), ids[stay]

    def keyed(self, x: np.ndarray, y: np.ndarray, place: np.ndarray) -> np.ndarray:
        rank = self.rank(x, y)
        return np.where(rank == NONE, NONE, rank << PLACE_BITS | place)


class BatchMemo(bpe.ChunkMemo):
    """A chunk memo whose values come from ids as little-endian bytes, filled for many texts at once."""

    def __init__(self, own: bpe.WordBpe, make):
        super().__init__(own, lambda ids: make(bpe.words_le(ids)))
        self.make_bytes, self.table, self.word_bytes = make, MergeTable(own), {}

    def words(self, wanted: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Words with their ids."""
        words = list(wanted)
        size, ids = self.table.merged([w.encode() for w in words])
        flat, end = ids.astype("<u4").tobytes(), (4 * np.cumsum(size)).tolist()
        yield from zip(words, map(flat.__getitem__, map(slice, [0, *end], end)))

    def fill(self, chunks: set[str]) -> None:
        """Makes the values of all chunks that are not known yet."""
        missing = chunks - self.keys()
        if len(self) + len(missing) > bpe.MEMO_WORDS:
            self.older = dict(self)
            self.clear()
            missing = chunks
        if self.older:
            known = missing & self.older.keys()
            self.update(zip(known, map(self.older.__getitem__, known)))
            missing = missing - known
        make = self.make_bytes
        letters = {c for c in missing if c.isalpha()}  # one pre-token
        self.update((w, make(ids)) for w, ids in self.words(letters))
        cut = {c: self.bpe.pretokens(c) for c in missing - letters}
        if len(self.word_bytes) > bpe.MEMO_WORDS:
            self.word_bytes.clear()
        known = self.word_bytes
        known.update(self.words({w for words in cut.values() for w in words if w not in known}))
        get = known.__getitem__
        self.update((c, make(b"".join(map(get, words)))) for c, words in cut.items())

    def many(self, texts: list[str]) -> Iterator[list]:
        """For each text the values of its chunks, in order."""
        for group in grouped(texts, GROUP_CHARS):
            cut = [self.bpe.chunks(t) if len(self.bpe.segments(t)) == 1 and t not in self.bpe.special else None for t in group]
            self.fill(set().union(*(c for c in cut if c)))
            for text, chunks in zip(group, cut):
                yield self.of(text) if chunks is None else list(map(self.__getitem__, chunks))


def slices(words: pa.BinaryArray) -> list[bytes]:
    """The values of an array that starts at its buffers' start; ``to_pylist`` takes ten times as long."""
    _, offset, data = words.buffers()
    end = np.frombuffer(offset, np.int32)[: len(words) + 1].tolist()
    return list(map(data.to_pybytes().__getitem__, map(slice, end, end[1:]))) if len(words) else []


class WordStore:
    """Words and their ids in arrays."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.start, self.size, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word; -1 where it is not known."""
        return np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))

    def add(self, words: list[bytes], size: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Numbers of new words, after they have been added."""
        number = np.arange(len(self.at), len(self.at) + len(words))
        self.at.update(zip(words, number.tolist()))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
        return number


class BatchEncoder:
    """Ids of whole texts. Like a memo it holds ``2 * MEMO_WORDS`` words at most (and those of one group of texts)."""

    def __init__(self, own: bpe.WordBpe):
        self.bpe, self.table, self.known, self.older = own, MergeTable(own), WordStore(), WordStore()
        every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
        self.kind = np.full(len(every), OTHER, np.uint8)
        for kind, pattern in ((LETTER, regex.compile(r"\p{L}+")), (NUMBER, regex.compile(r"\p{N}+")), (SPACE, own.SPACE)):
            for m in pattern.finditer(every):
                self.kind[m.start() : m.end()] = kind
        self.kind_of_byte = bytes(self.kind[:256])

    def normalized(self, text: str) -> bytes | None:
        """A text as the pre-tokens are cut from it; None if it has special tokens or characters that are left to the library."""
        if len(self.bpe.segments(text)) > 1 or text in self.bpe.special or not text.isascii() and bpe.has_unassigned(text):
            return None
        return self.bpe.normalized(text).encode()

    def pretokens(self, data: bytes) -> tuple[np.ndarray, pa.Array]:
        """Where the pre-tokens of a normalised text start, and the pre-tokens; white space between them is null.

        The text ends with three characters of white space.
        """
        kind, chars = np.frombuffer(bytearray(data.translate(self.kind_of_byte)), np.uint8), np.frombuffer(data, np.uint8)
        high = np.flatnonzero(chars >= 0x80)
        lead = high[chars[high] >= 0xC0]
        if len(high):  # all bytes of a character get its class
            code = np.frombuffer(chars[high].tobytes().decode().encode("utf-32-le"), "<u4")
            kind[high] = np.repeat(self.kind[code], np.diff(np.searchsorted(high, lead), append=len(high)))
        first = np.ones(len(chars), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        first[high[chars[high] < 0xC0]] = False
        at = np.flatnonzero(chars == ord("'"))
        at = at[first[at]]
        x, y = chars[at + 1], chars[at + 2]
        one = np.isin(x, list(b"stmd"))
        two = ((x == ord("r")) | (x == ord("v"))) & (y == ord("e")) | (x == ord("l")) & (y == ord("l"))
        first[at[one | two] + 1] = False
        first[at[one] + 2] = first[at[two] + 3] = True
        start = np.flatnonzero(first)
        words, offset = np.packbits(kind[start] != SPACE, bitorder="little"), np.append(start, len(data)).astype(np.int32)
        return start, pa.Array.from_buffers(pa.binary(), len(start), [pa.py_buffer(words), pa.py_buffer(offset), pa.py_buffer(data)])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers in ``known`` of different words; new ones are added to it."""
        found = self.known.find(words)
        if len(self.known.at) + (found < 0).sum() > bpe.MEMO_WORDS:
            self.older, self.known = self.known, WordStore()
            found[:] = -1
        open_ = np.flatnonzero(found < 0)
        if len(open_):
            old = self.older.find([words[i] for i in open_.tolist()])
            again, new = open_[old >= 0], open_[old < 0]
            old = old[old >= 0]
            size = self.older.size[old]
            found[again] = self.known.add([words[i] for i in again.tolist()], size, self.older.ids[ragged(self.older.start[old], size)])
            fresh = [words[i] for i in new.tolist()]
            found[new] = self.known.add(fresh, *self.table.merged(fresh))
        return found

    def ids(self, own: list[bytes]) -> list[bytes]:
        """For each normalised text its ids as little-endian unsigned 32-bit numbers."""
        start, words = self.pretokens(b"\n".join(own) + b"\n\n\n")
        coded = words.dictionary_encode()
        at = self.numbers(slices(coded.dictionary))
        which = coded.indices.fill_null(len(at)).to_numpy()
        size = np.append(self.known.size[at], 0)[which]
        ids = self.known.ids[ragged(np.append(self.known.start[at], 0)[which], size)].astype("<u4").tobytes()
        # No pre-token crosses the line feed between two texts.
        begin = np.cumsum([0, *(len(t) + 1 for t in own)])
        bound = (4 * np.append(0, np.cumsum(size))[np.searchsorted(start, begin)]).tolist()
        return list(map(ids.__getitem__, map(slice, bound, bound[1:])))

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        for group in grouped(texts, ENCODER_CHARS):
            plain = [self.normalized(t) for t in group]
            own = [t for t in plain if t is not None]
            coded = iter(self.ids(own) if len(own) > 1 else [b"".join(x for part in parts(t) for x in self.ids([part])) for t in own])
            for text, t in zip(group, plain):
                yield bpe.words_le(self.bpe.encode(text)) if t is None else next(coded)


_BATCH: dict[tuple, BatchMemo] = {}


def batch_memo(path: str | None, make) -> BatchMemo:
    """The memo for a tokenizer and a module-level function of id bytes; it outlives the tasks of a Python process."""
    key = (path or bpe.tokenizer_path(), make)
    if key not in _BATCH:
        _BATCH[key] = BatchMemo(bpe.load(key[0]), make)
    return _BATCH[key]


_ENCODERS: dict[str, BatchEncoder] = {}


def batch_encoder(path: str | None) -> BatchEncoder:
    """The encoder for a tokenizer; it outlives the tasks of a Python process."""
    path = path or bpe.tokenizer_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(bpe.load(path))
    return _ENCODERS[path]


def as_bytes(ids: bytes) -> bytes:
    return ids


def count_of(ids: bytes) -> int:
    return len(ids) // 4
