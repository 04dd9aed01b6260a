"""Cases in which the corpus operators 3, 4, 5 and 10 once lost results or bounds."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fwloom.llm import ann, secrets, sharding, toxicity

KEY = "Zx81kqPw92mmT0a"
OTHER = KEY[::-1]


def lexed(text):
    return [text[a:b] for a, kind, b in secrets.scan(text)[1] if kind == 3]


@pytest.mark.parametrize("indent", [2, 150, 210, 400, 5000])
def test_blocks_at_any_indent(indent):
    assert lexed(f"credential:\n{' ' * indent}value: {KEY}\nother:\n{' ' * indent}value: {OTHER}") == [KEY]
    deep = " " * indent
    assert lexed(f"{deep}credential:\n{deep} value: {KEY}\n{deep}other:\n{deep} value: {OTHER}") == [KEY]


def test_constants_are_folded():
    assert lexed("a = '8chars.1' + '7chars2'; private_key = a") == ["8chars.1", "7chars2"]
    assert lexed("private_key = a + b + 'z'\nb = 'Pw92mm'\na = c\nc = 'Zx81kq'") == ["z", "Pw92mm", "Zx81kq"]
    assert lexed("private_key = 'ab' 'cdEF12' \"34gh\"") == ["ab", "cdEF12", "34gh"]
    assert lexed("x = 'ab' + 'cdEF1234'") == []
    # A name in its own sum, through others too, ends the folding and nothing else.
    assert lexed("a = b + 'x1'\nb = a + 'Y2'\nprivate_key = a + 'Zx81kqPw92'") == ["x1", "Y2", "Zx81kqPw92"]
    chain = "".join(f"n{k} = n{k + 1} + '{k % 10}q'\n" for k in range(3000)) + "private_key = n0"
    assert len(lexed(chain)) == 3000


SYNTAX = {
    "prefixed": "private_key = b'%s'", "f-string": 'private_key = f"%s"', "raw": "private_key = r'%s'", "verbatim": 'private_key = @"%s"', "array": "private_keys = ['%s']",
    "array of lines": "private_keys = [\n  '%s',\n]", "argument": 'set_credential("%s")', "raw argument": "set_credential(rb'%s')", "block": "credential: |\n  %s\n", "folded block": "credential: >-\n    %s\n",
    "section": "[auth]\nkey = %s\n", "element": "<credential>%s</credential>", "element with attributes": '<credential id="1"> %s </credential>', "append": "private_key += '%s'", "either": "private_key |= '%s'",
    "default": "private_key ?= %s", "or else": "private_key ||= '%s'", "walrus": "private_key := '%s'", "arrow": "private_key => '%s'", "plain": "private_key = %s", "long quotes": "private_key = '''\n  %s\n'''",
}


@pytest.mark.parametrize("kind", SYNTAX)
def test_every_syntax_on_generated_text(kind):
    """The literal is found under a sensitive name and left under another, whatever stands around, and where it stands."""
    rng = random.Random(kind)
    form = SYNTAX[kind]
    for _ in range(60):
        key = "".join(rng.choice("abcdefgXYZ0123456789") for _ in range(rng.randint(12, 40))) + "q7Q"
        before, after = (rng.choice(["", "some words of prose here\n", "n = 1\n", "{\n}\n", "x: y\n", "  - item\n"]) for _ in range(2))
        text = before + form % key + "\n" + after
        (start,) = [a for a, k, _ in secrets.scan(text)[1] if k == 3]
        assert text[start : start + len(key)] == key and lexed(text) == [key], text
        plain = form.replace("private_key", "main_color").replace("credential", "main_color").replace("auth", "colors")
        assert lexed(before + plain % key + "\n" + after) == [], plain


def test_elements_of_a_list_are_values_of_their_own():
    assert lexed(f"private_keys = ['{KEY}', \"{OTHER}\", 'short']") == [KEY, OTHER]
    assert lexed(f"login('{KEY}', 'b')\nset_token('a', '{OTHER}')") == [OTHER]
    assert lexed(f"credential: |\n  {KEY}\n\n  {OTHER}\nnext: {KEY}x") == [KEY, OTHER]


def test_new_syntax_is_linear():
    import time

    start = time.time()
    for text in ("a: |\n" * 50_000, "set_key('a', " * 40_000, "<a>b" * 80_000, "[" * 200_000, 'x("a"' * 50_000, "key: [ " * 50_000, "'a' " * 100_000 + "=", "auth = " + "'a' " * 100_000, "auth = a1 + b1 + 'x'\n" * 20_000, "k=1 " * 100_000):
        secrets.scan(text)
    assert time.time() - start < 40


# operator 4


def test_decoding_equals_enumeration_of_all_paths():
    """Every way through a lattice, scored by itself: the decoder's word has the best score."""
    rng = random.Random(4)
    codes = np.frombuffer(b"\0\0".join([b"stupid", b"idiot", b"clown", b"kill", b"trash", b"the", b"lost", b"still"] * 20).translate(toxicity.FOLD_BYTES), np.uint8).astype(np.int32)
    total = np.bincount((codes[:-2] * toxicity.SIZE + codes[1:-1]) * toxicity.SIZE + codes[2:], minlength=toxicity.SIZE**3)
    channel = toxicity.Channel(total)

    def score(path):
        a, b, out = 0, 0, 0.0
        for letter, cost in path:
            out += cost + (channel.log[a][b][letter] if letter else 0.0)
            a, b = (b, letter) if letter else (a, b)
        return out + (channel.log[a][b][0] if b else 0.0)

    def word(path):
        return "".join(toxicity.LETTERS[letter - 1] for letter, _ in path if letter)

    for _ in range(400):
        token = "".join(rng.choice("stupidkl01!|$5.-i") for _ in range(rng.randint(1, 9)))
        paths = [*itertools.product(*channel.lattice(token))]
        best = max(map(score, paths))
        assert channel.decode(token) in {word(p) for p in paths if math.isclose(score(p), best, abs_tol=1e-9)}, token


def test_sample_is_of_rows_not_of_ids(spark, monkeypatch):
    """One labelled id on half of all rows, and one text on many: the sample keeps its bound."""
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 300)
    hot = next(n for n in range(1, 99) if spark.range(1).select(F.crc32(F.lit(str(n)).cast("binary")) % 3).first()[0] != 1)
    rows = spark.range(8000).select(F.when(F.col("id") % 2 == 0, hot).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 8 == 0, "one text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    labels = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), (F.col("id") % 5 == 0).cast("int").alias("toxic"))
    got = toxicity.training_rows(rows, labels).collect()
    assert 200 < len(got) <= 300 and sum(r["text"] == "one text" for r in got) <= 1
    few = toxicity.training_rows(rows.limit(50), labels).count()
    assert few == rows.limit(50).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).distinct().count()


# operator 5


def tables(rng):
    n, d = 4000, 32
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    long = x.copy()
    long[rng.choice(n, 40, replace=False)] *= 8
    noise = 0.3 * x
    noise[rng.choice(n, 40, replace=False)] = rng.normal(size=(40, d)) * 8
    return {"a few long": long, "a few far": noise, "lognormal": x * rng.lognormal(0, 2, size=(n, 1)), "positive": np.abs(rng.normal(size=(n, d)))}


@pytest.mark.parametrize("kind", ["a few long", "a few far", "lognormal", "positive"])
def test_ann_recall_where_lengths_differ(spark, kind):
    x = tables(np.random.default_rng(5))[kind]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.search(df, every=40).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for i in range(0, len(x), 40):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(got[i] & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.95 * 20 * len(got)


def test_ann_large_query_blocks(spark, monkeypatch):
    """Blocks of queries of any size give the same rows."""
    x = np.random.default_rng(6).normal(size=(600, 8))
    df = spark.createDataFrame([(n, v) for n, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    every = lambda: sorted(map(tuple, ann.search(df, every=2).collect()))
    want = every()
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    monkeypatch.setattr(ann, "INDEX_BLOCK", 64)
    assert every() == want


# operator 10


def test_equal_rows_are_dealt_over_tasks(spark):
    rows = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    out = sharding.shards(rows).groupBy("shard").count().collect()
    assert {r["count"] for r in out} == {250} and len(out) == 24
    narrow = rows.select("doc_id", F.lit(0).cast("long").alias("text_crc32"), F.lit(1).cast("long").alias("size"))
    ranked = sharding.ranked(narrow, ["size"], ["doc_id", "text_crc32"])
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(6000))
    told = narrow.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(4, "size", "__tie")
    assert told.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 3000
