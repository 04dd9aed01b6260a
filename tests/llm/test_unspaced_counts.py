"""Operator 6 on texts without white space: leaves, edits and their borders."""

import random

import pytest

from fwloom.llm import bpe, counts, merges

PIECES = ["abc", "Der", "12", "7", ".", "--", "'s", "'", "'re", "<|endoftext|>", "<|", "|>", "end", "é", "é", "́", "日本", "。", "１", "½", "_", "~", "‍", "Ω", "{}", " ", "\n", "\x1c", "ﬁ", "⃣"]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


@pytest.mark.parametrize("seed", range(6))
def test_borders_part_no_token(seed):
    """At every border of random text the tokens of both sides add up, by the tokenizers library."""
    rng, lib = random.Random(seed), library()
    size = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    for _ in range(150):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(2, 12)))
        whole = size(text)
        for at in range(1, len(text)):
            if counts.meets_border(text[:at], text[at:]):
                assert size(text[:at]) + size(text[at:]) == whole, (text, at)


@pytest.mark.parametrize("seed", range(4))
def test_edits_of_unspaced_text(seed, monkeypatch):
    monkeypatch.setattr(counts, "LEAF_CHARS", 12)
    rng = random.Random(seed)
    memo, own = merges.batch_memo(None, merges.count_of), bpe.load(bpe.tokenizer_path())
    text = "".join(rng.choice(PIECES[:-5] if seed % 2 else PIECES[:9]) for _ in range(400))
    tree = counts.TokenTree.of(text, memo)
    for _ in range(250):
        a = rng.randint(0, len(text))
        b = min(len(text), a + rng.choice([0, 0, 1, 2, 5, 60]))
        new = rng.choice(["", "", *PIECES, "".join(rng.choice(PIECES) for _ in range(40))])
        tree.edit(a, b, new)
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.count == len(own.encode(text)), (a, b, new)


@pytest.mark.parametrize("kind", ["base64", "commas", "digits", "spaced"])
def test_one_edit_of_a_long_text_encodes_little(kind):
    rng = random.Random(kind)
    memo = merges.batch_memo(None, merges.count_of)
    letters = {"base64": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "commas": "abcdefghijk,", "digits": "0123456789", "spaced": "abcdef "}[kind]
    text = "".join(rng.choice(letters) for _ in range(100_000))
    tree = counts.TokenTree.of(text, memo)
    assert len(tree.leaves) > 300
    tree.edit(50_000, 50_005, "hello")
    assert tree.encoded_chars < 2000
    assert tree.count == len(bpe.load(bpe.tokenizer_path()).encode(text[:50_000] + "hello" + text[50_005:]))


def test_everything_goes():
    memo = merges.batch_memo(None, merges.count_of)
    tree = counts.TokenTree.of("abc123def456" * 200, memo)
    tree.edit(0, 10**6, "")
    assert tree.text() == "" and tree.count == 0
    tree.edit(0, 0, "a1")
    tree.edit(1, 2, "")
    assert tree.text() == "a" and tree.count == 1
