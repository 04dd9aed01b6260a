"""Operators 3, 6, 8 and the pieces of 1, 4 and 7, against the library, brute force and round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fwloom.llm import bpe, counts, media, merges, packing, secrets, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, rank int"
ODD = [None, "", "a", " ", "word " * 3000, "ü\x1cb", "x" * 5000, "same text", "same text"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(n if n != 3 else None, t, "en" if n % 2 else None, None, None, "s", None, 1) for n, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[-1]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_library(text):
    from tokenizers import Tokenizer

    library = test_bpe_equals_library.library = getattr(test_bpe_equals_library, "library", None) or Tokenizer.from_file(bpe.tokenizer_path())
    ids = library.encode(text, add_special_tokens=False).ids
    own = bpe.load(bpe.tokenizer_path())
    assert own.encode(text) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in bpe.op8_bpe(spark, sf_dir).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_special_tokens(library):
    own = bpe.load(bpe.tokenizer_path())
    for text in ("a<|endoftext|>b", "<|startoftext|>", "x <|endoftext|><|endoftext|> y", "<|nothing|>"):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_odd_rows(odd, empty):
    for run in (bpe.encode_digests, bpe.encode_ids, lambda d: counts.edited_counts(d, counts.routine_edits(d)), secrets.find_secrets, media.images, sharding.shards, lambda d: packing.pack(d).dropDuplicates(["doc_id", "piece", "sequence_id", "offset"])):
        assert run(odd).count() >= odd.count()
        assert run(empty).count() == 0


def test_packing(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.op1_packing(spark, sf_dir).collect()
    seen, sequences = {}, {}
    for r in rows:
        seen.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen.keys() == texts.keys()
    for doc, parts in seen.items():
        ids = np.array([*library.encode(texts[doc], add_special_tokens=False).ids, 0], dtype="<u4")
        for n, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, n * 2048)
            part = ids[r["start"] : r["start"] + r["length"]]
            assert len(part) == min(2048, len(ids) - r["start"]) and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 2048) + 2


def least_sequences(lengths, capacity):
    """The true optimum of a few pieces, by trying every open sequence."""
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:k]:
                put(i + 1, [*rooms[:k], room - lengths[i], *rooms[k + 1 :]])
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def check_solution(lengths, capacity):
    histogram = np.bincount(lengths, minlength=capacity + 1) if len(lengths) else np.zeros(capacity + 1, dtype=np.int64)
    solution = packing.solve(histogram, capacity)
    total = np.zeros(capacity + 1, dtype=np.int64)
    for config, n in solution.configurations:
        assert n > 0 and sum(length * times for length, times in config) <= capacity
        for length, times in config:
            total[length] += n * times
    assert (total == histogram).all()
    assert solution.sequences == sum(n for _, n in solution.configurations) >= solution.bound
    return solution


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_solution_holds_the_histogram(lengths):
    check_solution(lengths, 64)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=9))
def test_bound_and_solution_against_the_optimum(lengths):
    solution = check_solution(lengths, 40)
    best = least_sequences(sorted(lengths, reverse=True), 40)
    assert solution.bound <= best <= solution.sequences <= best + 1


@pytest.mark.parametrize(
    "low,high,share",
    [(1, 300, 1.001), (1, 2048, 1.002), (960, 1090, 1.012), (1025, 2048, 1.0), (640, 720, 1.005), (300, 800, 1.001), (682, 682, 1.0), (1024, 1024, 1.0), (500, 1100, 1.036)],
)
def test_sequences_near_the_proven_bound(low, high, share):
    solution = check_solution(np.random.default_rng(1).integers(low, high + 1, 9000), 2048)
    assert solution.sequences <= share * solution.bound + 2 and abs(solution.fractional - solution.sequences) <= 0.02 * solution.sequences + 2


def test_knapsack_against_brute_force():
    lengths, values = np.array([2, 3, 7]), np.array([1.0, 2.5, 6.0])
    best, _ = packing.knapsack(lengths, values, 20)
    for c in range(21):
        want = max(a * 1.0 + b * 2.5 + k * 6.0 for a in range(11) for b in range(8) for k in range(4) if 2 * a + 3 * b + 7 * k <= c)
        assert best[c] == pytest.approx(want)


def test_token_tree():
    memo, own = merges.batch_memo(None, merges.count_of), bpe.load(bpe.tokenizer_path())
    random.seed(5)
    text = " ".join(random.choice(["alpha", "Beta,", "it's", "naïve", "42", "\n"]) for _ in range(900))
    tree = counts.TokenTree.of(text, memo)
    for _ in range(160):
        a = random.randint(0, len(text))
        b = min(len(text), a + random.choice([0, 1, 6, 300]))
        new = random.choice(["", "x", " ", "two words", "\nz", "many more words " * 200])
        tree.edit(a, b, new)
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.count == len(own.encode(text))
        assert sum(tree.row()[1]) == len(text) and sum(tree.row()[2]) == tree.count
    assert max(map(len, tree.leaves)) <= counts.GROWN * counts.LEAF_CHARS + 40


@pytest.mark.parametrize("few", [1_000_000, 3])
def test_edit_tables_against_encoding_anew(spark, monkeypatch, few):
    """Two batches of random edits on stored trees; a very long text, a hot document, repeated and null ids."""
    from fwloom.llm.common import materialize

    random.seed(8)
    own = bpe.load(bpe.tokenizer_path())
    word = lambda: random.choice(["alpha", "Beta,", "it's", "naïve", "42", "\n", "x1"])
    texts = {n: " ".join(word() for _ in range(random.choice([0, 1, 50, 400]))) for n in range(12)}
    texts[12] = " ".join(word() for _ in range(60_000))
    rows = [*texts.items(), (3, texts[3]), (3, "another text under one id"), (None, "no id"), (13, None)]
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_tokens long")
    trees = materialize(counts.build_trees(docs))
    docs = docs.select("doc_id", "text")
    monkeypatch.setattr(counts, "FEW_IDS", few)
    now = [(d, t or "") for d, t in rows]
    for _ in range(2):
        log = []
        for d in [*random.sample(range(14), 9), 12, 99]:
            for seq in range(200 if d == 12 else random.randint(1, 8)):
                a = random.randint(-3, 2500)
                log.append((d, seq, a, a + random.choice([-1, 0, 1, 9, 300]), random.choice(["", "x", " ", "two words", None, "long " * 300])))
        random.shuffle(log)
        edits = spark.createDataFrame(log, "doc_id long, seq long, start long, `end` long, text string")
        ids = {x[0] for x in log}
        edited = materialize(counts.apply_edits(docs, trees, edits))
        want = []
        for d, t in now:
            for _, _, a, b, new in sorted((x for x in log if x[0] == d), key=lambda x: x[1]):
                a = min(max(a, 0), len(t))
                b = min(max(b, a), len(t))
                t = t[:a] + (new or "") + t[b:]
            want.append((d, t))
        now = want
        got = edited.collect()
        assert sorted(map(str, [(r["doc_id"], r["text"]) for r in got])) == sorted(map(str, [x for x in now if x[0] in ids]))
        for r in got:
            assert r["n_tokens"] == sum(r["leaf_tokens"]) == len(own.encode(r["text"])) and sum(r["leaf_chars"]) == len(r["text"])
            assert r["n_edits"] == sum(x[0] == r["doc_id"] for x in log)
        long = next(r for r in got if r["doc_id"] == 12)
        assert long["leaves_encoded"] < 2500 and len(long["leaf_chars"]) > 900
        docs = materialize(edited.select("doc_id", "text").union(docs.where(~F.coalesce(F.col("doc_id").isin(list(ids)), F.lit(False)))))
        trees = materialize(counts.trees_of(edited).union(trees.where(~F.coalesce(F.col("doc_id").isin(list(ids)), F.lit(False)))))
    out = counts.edited_counts(docs, edits.limit(3)).collect()
    assert len(out) == len(now) and sum(r["n_edits"] > 0 for r in out) <= 4


def test_merged_words_equal_the_queue():
    own = bpe.load(bpe.tokenizer_path())
    random.seed(3)
    letters = "etaoinshrdlucmf" * 4 + "üß漢1'!-"
    words = list({"".join(random.choice(letters) for _ in range(random.randint(1, 60))) for _ in range(4000)} | {"a" * n for n in range(1, 50)} | {"the", "ththth", "nananana"})
    memo = merges.BatchMemo(own, merges.as_bytes)
    assert dict(memo.words(words)) == {w: bpe.words_le(own.merged(w.encode())) for w in words}
    texts = [" ".join(random.choice(words) for _ in range(50)) for _ in range(40)] + ["", " ", "<|endoftext|>x <|endoftext|>", "a\x1cb ü", "\U0001fae8 x"]
    for _ in range(2):
        assert [b"".join(v) for v in memo.many(texts)] == [bpe.words_le(own.encode(t)) for t in texts]


def test_batch_memo_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 20)
    own, memo = bpe.load(bpe.tokenizer_path()), merges.BatchMemo(bpe.load(bpe.tokenizer_path()), merges.count_of)
    for n in range(30):
        texts = [" ".join(f"word{(n * 7 + i * k) % 60} x" for i in range(12)) for k in range(3)]
        assert [sum(v) for v in memo.many(texts)] == [len(own.encode(t)) for t in texts]


def test_base_secrets_against_plain_patterns():
    random.seed(2)
    words = ["password", "Token", "api_key", "=", ":", " ", '"', "abc", "abcdefgh", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0123456789abcdef01234567", "é", "\n", "ſecret", "secret"]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for _ in range(3000):
        text = "".join(random.choice(words) for _ in range(12))
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert secrets.base_spans(text) == sorted(want)
        assert set(secrets.base_spans(text)) <= set(secrets.scan(text)[1])


def test_lexed_secrets():
    text = "k = \"Zx81kqPw92mmT0a\"\nprivate_key = k\nclientSecret: 'aB3$kkQ9zz1'\nnote: this is prose: plain\nauth_key = example\nurl = http://a.b/c\n"
    spans = secrets.scan(text)[1]
    assert [text[a:b] for a, kind, b in spans if kind == 3] == ["Zx81kqPw92mmT0a", "aB3$kkQ9zz1"]
    assert secrets.redact("a b c", [(0, 0, 1), (0, 1, 3)]) == "[SECRET] c"


def lexed(text):
    return [text[a:b] for a, kind, b in secrets.scan(text)[1] if kind == 3]


def test_long_names_and_late_constants():
    key = "Zx81kqPw92mmT0a"
    assert lexed("password_" + "x" * 400 + f" = '{key}'") == [key]
    assert lexed(f"private_key = a\na = b\nb = c\nc = '{key}'") == [key]  # bound after its use
    assert lexed(f"x = '{key}'\ny = x") == []
    assert lexed(f'private_key = """\n  {key}\n  plain words here\n"""\nn = 1') == [key]
    assert lexed(f"auth_key = `{key}`") == [key]
    assert lexed('{"auth": {"key": "%s", "user": "somebody12345"}, "n": {"key": "%s"}}' % (key, key[::-1])) == [key]
    assert lexed(f"credential:\n  value: {key}\nother:\n  value: {key[::-1]}") == [key]
    assert lexed('auth_key = """never closed ' + key) == []


def plain_lexed(text):
    """Literals that reach a sensitive name, by a plain scanner: lines of ``name = value`` and a closure over all names."""
    bound = {}
    for line in text.split("\n"):
        name, sign, value = line.partition(" = ")
        if sign:
            bound.setdefault(name, []).append(value)
    found, open_, seen = set(), [n for n in bound if secrets.name_score(n)], set()
    while open_:
        name = open_.pop()
        if name in seen:
            continue
        seen.add(name)
        for value in bound.get(name, []):
            if value[0] in "'\"":
                found.add(value[1:-1])
            else:
                open_.append(value)
    return found


def test_lexed_secrets_against_a_plain_scanner():
    random.seed(12)
    names = ["alpha", "beta_2", "gamma", "delta", "client_key", "privateKey", "auth.key", "user", "signing-key", "x" * 300]
    for _ in range(400):
        keys = ["".join(random.choice("abcdefgXYZ0123456789") for _ in range(14)) + "q7Q" for _ in range(6)]
        lines = [f"{random.choice(names)} = " + (f"'{random.choice(keys)}'" if random.random() < 0.5 else random.choice(names)) for _ in range(9)]
        text = "\n".join(lines)
        assert set(lexed(text)) == {k for k in plain_lexed(text) if secrets.literal_score(k, True) >= 0.2}, text


def test_lexing_is_linear():
    import time

    start = time.time()
    for text in ("a" * 400_000, "a = " * 100_000, '= """ ' * 60_000, "k: {" * 80_000, "a.b-" * 100_000 + "=", " " * 400_000 + "=", "'x = " * 80_000, "key = 'a' + " * 40_000, "}" * 200_000 + "a:\n" * 50_000):
        secrets.scan(text)
    assert time.time() - start < 40


def test_toxic_readings():
    text = b"\0\0".join([b"stupid idiot clown worthless moron pathetic scum loser trash the and of"] * 30)
    codes = np.frombuffer(text.translate(toxicity.FOLD_BYTES), np.uint8).astype(np.int32)
    total = np.bincount((codes[:-2] * toxicity.SIZE + codes[1:-1]) * toxicity.SIZE + codes[2:], minlength=toxicity.SIZE**3)
    channel = toxicity.Channel(total)
    for hidden, word in {"m0r0n": "moron", "$tup1d": "stupid", "idiooooot": "idiot", "sc.u.m": "scum", "l0ser!": "loser", "tr@sh": "trash"}.items():
        assert word in channel.readings(hidden), hidden
    assert "idiot" in toxicity.tokens_of("you I d i O t there") or "iidiot" in toxicity.tokens_of("you I d i O t there")


def channel_of(words):
    codes = np.frombuffer(b"\0\0".join([words] * 30).translate(toxicity.FOLD_BYTES), np.uint8).astype(np.int32)
    return np.bincount((codes[:-2] * toxicity.SIZE + codes[1:-1]) * toxicity.SIZE + codes[2:], minlength=toxicity.SIZE**3)


def test_toxic_readings_of_heavy_disguises():
    channel = toxicity.Channel(channel_of(b"stupid idiot clown worthless moron pathetic scum loser trash kill fuck ass the and of"))
    hidden = {"1d10t": "idiot", "l053r": "loser", "k.1.l.l": "kill", "f--u--c--k": "fuck", "f-----u-----c-----k": "fuck", "stuupid": "stupid", "1d107": "idiot", "$$tupid": "stupid", "455": "ass"}
    for token, word in hidden.items():
        assert word in channel.readings(token), token
    assert channel.readings("4") == {"4"}


def test_toxic_words_at_any_place_of_a_spaced_run():
    counts = channel_of(b"stupid idiot clown moron shut up kill the and of a you are")
    scorer = toxicity.Scorer(counts, {"kill": 3.0, "idiot": 4.0, "stupid": 5.0})
    hidden = {"a k i l l": 3.0, "s h u t u p i d i o t": 4.0, "i. d. i. o. t": 4.0, "you i - d - 1 - o - t": 4.0, "x s t u p i d i d i o t x": 9.0, "k i i l l": 3.0}
    for text, total in hidden.items():
        assert scorer.evidence(text)[0] == total, text
    assert scorer.evidence("a k i d")[0] == 0
    assert toxicity.Channel(counts).words("killmoron") == ["kill", "moron"]
    long = "a " * 20_000
    assert sum(map(len, toxicity.tokens_of(long))) < 100 and scorer.evidence(long)[0] == 0


def test_toxicity_held_out(spark):
    """On rows never learnt from, toxic documents are found and clean ones left alone."""
    rows = toxicity.op4_toxicity(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    clean = [r["predicted"] for r in held if not labels[r["doc_id"]]]
    toxic = [r["predicted"] for r in held if labels[r["doc_id"]]]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.7 * len(toxic)


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(odd, labels).collect()
    assert len(out) == len(ODD) + 1 and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.toxicity(empty, labels.limit(0)).count() == 0


def test_media(spark, sf_dir, odd):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in media.op7_media(spark, sf_dir).collect():
        data = texts[r["doc_id"]]
        n = max(576, -(-len(data) // 576) * 576)
        want = data.ljust(n, b"\xff")
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), n, hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
    from fwloom.llm.common import shared_dir

    path = shared_dir(spark)
    media.write_archives(odd, path)
    found = spark.read.format(media.FORMAT).option("rangeBytes", 200).load(path)
    assert found.rdd.getNumPartitions() > 4 and media.features(found).count() == odd.count()


def test_media_retries(tmp_path, monkeypatch):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("0/1.png", b"one")
        z.writestr("1/2.png", b"two")
    files, _ = media.open_fs(str(tmp_path))
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        info = z.infolist()

    class Broken:
        def read_at(self, *a):
            raise OSError("lost")

        def close(self):
            pass

    opened = [Broken()]
    assert media.read_member(files, str(tmp_path / "a.zip"), opened, info[1]) == b"two"
    info[0].CRC ^= 1
    with pytest.raises(OSError, match="damaged"):
        media.read_member(files, str(tmp_path / "a.zip"), opened, info[0])


@pytest.mark.parametrize("rows,parts", [(0, 1), (0, 3), (1, 3), (5, 40)])
def test_media_with_empty_tasks(spark, rows, parts):
    """Tasks without rows leave no archive; an empty table reads back as an empty one."""
    from fwloom.llm.common import shared_dir

    path = shared_dir(spark)
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(rows)], "doc_id long, text string").repartition(parts)
    media.write_archives(docs, path)
    assert sorted(r["doc_id"] for r in media.features(media.read_archives(spark, path)).collect()) == list(range(rows))
    files, root = media.open_fs(path)
    found = files.get_file_info(media.fs.FileSelector(root, allow_not_found=True))
    archives = [f for f in found if f.path.endswith(".zip")]
    assert len(archives) <= rows and len(found) == len(archives) + (rows > 0)  # and the list of them


def test_media_damaged_directory(tmp_path):
    (tmp_path / "a.zip").write_bytes(b"PK\x05\x06")
    files, root = media.open_fs(str(tmp_path))
    with pytest.raises(OSError, match="a.zip: its directory"):
        media.members_of(files, f"{root}/a.zip")


def test_media_failed_task_leaves_nothing(tmp_path):
    import pyarrow as pa

    def batches():
        yield pa.record_batch([pa.array([1]), pa.array([b"x"])], ["doc_id", "media"])
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        media.ArchiveWriter(str(tmp_path)).write(batches())
    assert list(tmp_path.iterdir()) == []


def test_sharding(spark, sf_dir):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = sharding.op10_sharding(spark, sf_dir).collect()
    shards: dict = {}
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]), "rows", None)
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(texts) and set(shards) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_written_shards_keep_the_law(spark, tmp_path):
    """Repeated rows, null ids and columns named like the operator's own are written once each."""
    rows = [(n % 7 if n % 5 else None, "same" if n % 3 else f"text {n}", "en", "s", 1.0, "mine") for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, slot double, text_crc32 string")
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 1
    assert sorted(map(str, back.drop("shard").select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    with pytest.raises(ValueError, match="shard"):
        sharding.write_shards(docs.withColumnRenamed("slot", "shard"), str(tmp_path / "no"))


def test_ranks_follow_the_curve(spark):
    """Against a plain sort of all rows by curve index, doc_id and checksum."""
    random.seed(6)
    rows = [(n, random.choice(["en", "de", None]), random.choice("abcdefgh"), random.randint(1, 900)) for n in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, size long")
    got = sharding.ranked(df, ["lang", "source", "size"], ["doc_id"]).collect()
    order = sorted(got, key=lambda r: (r["curve"], r["doc_id"]))
    assert [r["rank"] for r in order] == list(range(500))
    cuts = sharding.number_cuts(df, ["size"], 64)["size"]
    names = {c: sharding.string_cuts(df, c, 64) for c in ("lang", "source")}
    for r in got:
        cell = [sum(e <= r[c] for e in names[c]) if r[c] is not None else 0 for c in ("lang", "source")] + [sum(e <= r["size"] for e in cuts)]
        assert r["curve"] == sharding.hilbert_index(np.array([cell]), sharding.BITS)[0]


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_steps_are_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(2 ** (bits * dims)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()
