"""Ids of whole texts for operator 1, and how often words are merged and looked up."""

import random

import pytest

from fwloom.llm import bpe, merges

PIECES = ["abc", "Der", "12", "7", ".", "--", "'s", "'", "''", "'re", "'ll", "'l", "'v", "'dog", "'T", "<|endoftext|>", "<|", "é", "é", "́", "日本", "。", "１", "½", "Σ", "İ", "𝐀𝟙", "😀", "\U0001fae8"]
PIECES += ["_", "‍", "\x00", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "ﬁ", "⃣", "ſ", "'ſ", "ab" * 30, "日" * 20, "!" * 50]


def ids_by_library(texts: list[str]) -> list[bytes]:
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.tokenizer_path())
    return [bpe.words_le(lib.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("chars", [1 << 21, 40, 1])
def test_encoder_against_the_library(monkeypatch, chars):
    monkeypatch.setattr(merges, "ENCODER_CHARS", chars)
    rng = random.Random(chars)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(2500)] + ["", " ", "\n\n", "'", "'s", "x '", "<|endoftext|>", ""]
    encoder = merges.BatchEncoder(bpe.load(bpe.tokenizer_path()))
    want = ids_by_library(texts)
    for _ in range(2):
        assert list(encoder.many(texts)) == want
    assert list(encoder.many([])) == []


def test_encoder_on_all_characters():
    """Every assigned character between letters, after an apostrophe and by itself."""
    import unicodedata

    chars = [c for c in map(chr, range(0x30000)) if unicodedata.category(c) not in ("Cn", "Cs")]
    texts = [" ".join(f"a{c}b '{c} {c}" for c in chars[i : i + 500]) for i in range(0, len(chars), 500)]
    encoder = merges.BatchEncoder(bpe.load(bpe.tokenizer_path()))
    assert list(encoder.many(texts)) == ids_by_library(texts)


def test_encoder_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 20)
    monkeypatch.setattr(merges, "ENCODER_CHARS", 200)
    own = bpe.load(bpe.tokenizer_path())
    encoder = merges.BatchEncoder(own)
    for n in range(30):
        texts = [" ".join(f"word{'abcdefgh'[(n * 7 + i * k) % 8]}{chr(97 + n % 26)} x" for i in range(12)) for k in range(3)]
        assert list(encoder.many(texts)) == [bpe.words_le(own.encode(t)) for t in texts]
        assert len(encoder.known.at) <= 20 + 40 and len(encoder.older.at) <= 20 + 40


def test_new_words_of_all_lengths_share_their_rounds(monkeypatch):
    """Arrays are searched once for a round, not once for each round of each length."""
    rng, own, calls = random.Random(4), bpe.load(bpe.tokenizer_path()), []
    words = list({"".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in range(1, merges.LONGEST + 1) for _ in range(20)})
    memo, rank = merges.BatchMemo(own, merges.as_bytes), merges.MergeTable.rank
    monkeypatch.setattr(merges.MergeTable, "rank", lambda self, x, y: calls.append(len(x)) or rank(self, x, y))
    assert dict(memo.words(words)) == {w: bpe.words_le(own.merged(w.encode())) for w in words}
    assert len(calls) <= merges.LONGEST


def test_words_are_looked_up_once_a_group(monkeypatch):
    """However often a word stands in the texts, and whatever punctuation follows it, it is looked up and merged once."""
    own, asked = bpe.load(bpe.tokenizer_path()), []
    words = [f"word{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [" ".join(w + end for w in words) for end in ("", ".", ",", "!!", ")")] * 40
    encoder, find = merges.BatchEncoder(own), merges.WordStore.find
    monkeypatch.setattr(merges.WordStore, "find", lambda self, own: asked.extend(own) or find(self, own))
    assert list(encoder.many(texts)) == [bpe.words_le(own.encode(t)) for t in texts]
    assert len(asked) == 2 * (len(words) + 4) and len(encoder.known.at) == len(words) + 4
