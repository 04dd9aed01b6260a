"""Operators 2, 5 and 9 and the pipeline against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fwloom.llm import ann, neardup, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, sha string, spans int"


def brute_classes(rows):
    """Smallest id of each component of links at 0.8, over multisets of five-word shingles."""
    bags = []
    for _, text in rows:
        w = re.findall(r"\w+", (text or "").lower())
        bags.append(collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                both = sum((bags[i] & bags[j]).values())
                if both / (sum(bags[i].values()) + sum(bags[j].values()) - both) >= 0.8:
                    parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: least[root(i)] for i, (d, _) in enumerate(rows)}


def test_near_duplicates(spark):
    random.seed(7)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(120)]
    texts = [" ".join(base)]
    for edits in (1, 1, 2, 2, 3, 6, 20):  # a star of near copies, and looser ones
        for _ in range(4):
            w = list(base)
            for _ in range(edits):
                w[random.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += ["one two three", "one two three", "", "", "ha " * 300, "ha " * 290, "ha " * 100, texts[3]]
    texts += [" ".join(word() for _ in range(40)) for _ in range(20)]
    order = list(range(len(texts)))
    random.shuffle(order)
    rows = [(n, texts[i]) for n, i in enumerate(order)]
    df = spark.createDataFrame([(d, t, "x", None, 0, "c", "c", 1) for d, t in rows], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == brute_classes(rows)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == set(got.values())


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f", None), (None, None, None), (1, "a b c d e f", None), (1, "a b c d e f", None), (2, "!!", None), (3, "!!", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = neardup.near_duplicates(df).collect()
    assert len(out) == 6
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    assert sum(r["text"] == "a b c d e f" for r in neardup.keep_one(df).collect()) == 1


def test_texts_under_one_id_are_not_lost(spark):
    """Two texts under one id, repeated rows, null ids, and columns named like the operator's own."""
    other = "quite another text that stands under the very same id"
    rows = [(7, "a b c d e f", 1), (7, other, 2), (7, other, 2), (8, "a b c d e f", 3), (9, other, 4), (None, "g h i j k", 5), (None, "l m n o p", 6), (7, "", 7), (None, "", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, d int").withColumn("class_id", F.lit("x")).withColumn("a.b", F.lit(1))
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted(["a b c d e f", other, "g h i j k", "l m n o p", "", ""])
    out = neardup.near_duplicates(df).collect()
    assert len(out) == len(rows) and sum(r["kept"] for r in out) == 7  # the repeated row is kept or not as a whole


def test_largest_class_of_a_bucket_is_dealt_once(spark):
    """5,000 members of one class and three strays: rows dealt grow with the members, not with the blocks."""
    rows = [(0, 1, d, 1, 100) for d in range(5000)] + [(0, 1, 9000 + d, 9000 + d, 100) for d in range(3)]
    out = neardup.dealt(spark.createDataFrame(rows, "band int, key long, d long, class long, size long")).collect()
    blocks = -(-5000 // neardup.BLOCK)
    assert len(out) == 5000 + 3 * (blocks + 1)
    cells: dict = {}
    for r in out:
        cells.setdefault((r["i"], r["j"]), set()).add(r["d"])
    met = {(s, d) for members in cells.values() for s in range(9000, 9003) if s in members for d in members}
    assert all((s, d) in met for s in range(9000, 9003) for d in [*range(5000), *range(9000, 9003)])
    heavy = spark.createDataFrame([(0, 1, d, 1 + d % 2, neardup.BLOCK_BYTES // 2) for d in range(40)], "band int, key long, d long, class long, size long")
    assert neardup.dealt(heavy).groupBy("i", "j").count().agg(F.max("count")).first()[0] < 25


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    hits = []
    for _ in range(60):
        e = rng.integers(1, 2**63, 40).astype(np.uint64)
        w, v = rng.integers(1, 9, 40), rng.integers(1, 9, 40)
        one, two = neardup.signatures([(np.sort(e), w), (np.sort(e), v)])
        hits.append((one == two).mean() - np.minimum(w, v).sum() / np.maximum(w, v).sum())
    assert abs(np.mean(hits)) < 4 * 0.5 / np.sqrt(60 * neardup.REGISTERS)


def test_overlaps_by_matrix_equal_pairs():
    rng = np.random.default_rng(4)
    bags = [np.unique(rng.integers(0, 60, 50).astype(np.uint64), return_counts=True) for _ in range(30)]
    pairs = np.array([(a, b) for a in range(30) for b in range(a + 1, 30)])
    assert np.allclose(neardup.overlaps(bags, pairs), [neardup.similarity(bags[a], bags[b]) for a, b in pairs])


def brute_removed(rows):
    seen, out = {}, {}
    for d, text in rows:
        for i in range(len((text or "").encode()) - 99):
            w = text.encode()[i : i + 100]
            seen[w] = min(seen.get(w, (d, i)), (d, i))
    for d, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - 99):
            if seen[data[i : i + 100]] != (d, i):
                covered[i : i + 100] = b"\1" * 100
        kept = bytes(b for b, c in zip(data, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[d] = (len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark, monkeypatch):
    random.seed(11)
    word = lambda n=5: "".join(random.choice("abcdeé") for _ in range(n))
    line = "a line that many documents share word for word, sixty to eighty bytes long"
    passage = " ".join(word() for _ in range(60))
    texts = [passage, None, "", "short", "x" * 700, "ab" * 300, passage + "tail" + passage]
    for _ in range(60):
        a, b = sorted(random.sample(range(len(passage)), 2))
        texts.append(" ".join(word() for _ in range(20)) + line + " ".join(word(3) for _ in range(15)) + passage[a:b] + word() + line)
    texts += [texts[7], texts[8][:300], texts[9][5:]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(d, t, None, None, 0, "c", "c", 1) for d, t in rows], SCHEMA)
    want = brute_removed(rows)
    for bucket in (2000, 3):  # the second sends shared anchors down the route by windows
        monkeypatch.setattr(suffixes, "BUCKET", bucket)
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.dedup(df).collect()}
        assert got == want
    stripped = suffixes.strip_repeats(df)
    assert stripped.columns == df.columns and stripped.count() == len(rows)


def test_suffix_dedup_odd_rows(spark):
    long = "".join(chr(97 + i % 23) for i in range(50)) + "".join(chr(97 + i * i % 26) for i in range(200))
    df = spark.createDataFrame([(None, long), (5, long), (5, long), (5, long[3:]), (None, None)], "doc_id long, text string")
    assert suffixes.dedup(df).count() == 5
    assert suffixes.dedup(df.limit(0)).count() == 0


def test_interval_tree():
    assert sorted(suffixes.intervals([3, 1, 2])) == [(1, 0, 3), (2, 2, 3), (3, 0, 1)]
    # Entries 0..3 in left order, commonness between neighbours, times: nearest earlier one counts.
    assert suffixes.earlier_extension([0, 1, 2, 3], [5, 2, 7], [3, 0, 2, 1]) == [5, -1, 7, 2]


def test_runs_are_the_same_wherever_a_passage_stands():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 900).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 123, 333).astype(np.uint8), passage])
    b = np.concatenate([passage, rng.integers(97, 123, 77).astype(np.uint8)])
    one, two = set(suffixes.runs_of(a)[4].tolist()), set(suffixes.runs_of(b)[4].tolist())
    assert len(one & two) >= 0.8 * len(suffixes.runs_of(passage)[4])


def test_ann_recall_and_exact_scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    got: dict = {}
    for r in ann.op5_ann(spark, sf_dir).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        found = sorted(got[ids[i]])
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(score[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for _, v, s in found)
        hits, total = hits + len(set(best) & {f[1] for f in found}), total + 20
    assert hits / total >= 0.9


@pytest.mark.parametrize("kind", ["clusters", "hot"])
def test_ann_recall_where_vectors_crowd(spark, kind):
    """Near copies, more of them than any list of candidates would hold."""
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(4000, 64)))
    if kind == "clusters":
        x = unit(np.repeat(x[:2], 2000, 0) + rng.normal(scale=0.02, size=(4000, 64)))
    else:
        x[::3] = unit(x[0] + rng.normal(scale=0.005, size=(len(x[::3]), 64)))
    df = spark.createDataFrame([(n, v) for n, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.search(df, every=60).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for i in range(0, 4000, 60):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(got[i] & set(np.argsort(-score)[:20].tolist()))
    assert len(got) == 67 and hits >= 0.9 * 20 * 67


def test_ann_probes_until_lists_hold_enough():
    model = ann.Model(np.eye(4), 4)
    _, chosen = model.probed(np.array([[4.0, 3.0, 2.0, 1.0]]) @ model.centers, np.array([3, 3, 3, 30]), 1, 7)
    assert chosen.tolist() == [[True, True, True, False]]


def test_ann_odd_rows(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, float("nan")]), (4, [1.0, None]), (5, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    same = [(n, [1.0, 0.5]) for n in range(20, 100)]
    df = spark.createDataFrame([*bad, *same, (200, [0.5, 1.0])], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.search(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert set(got) == {20, 40, 60, 80, 200}
    assert [v for _, v in sorted(got[40])] == [n for n in range(20, 41) if n != 40]
    assert ann.search(df.limit(0)).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    from fwloom.llm.common import materialize

    sizes = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < 4:
            docs = materialize(docs)
            assert docs.columns == columns
            sizes.append(docs.count())
    assert 150 < sizes[1] < sizes[0] <= 200 and sizes[1] == sizes[2] == sizes[3]
    assert docs.select("doc_id").distinct().count() == sizes[3]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    first = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).collect()}
    assert all(d in first for d, t in labels.items() if not t)


def test_pipeline_odd_rows(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("odd", [(None, None, None, None, None), (1, "", None, None, 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5)]), ("none", [])):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / name / "labels.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / name)).count() == (3 if rows else 0)


def test_pipeline_keeps_clashing_columns_and_texts(spark, tmp_path):
    """Columns named like the operators' own, a very long text, two texts under one id, repeated rows: nothing clean is lost."""
    import corpus_pipeline

    own = ["score", "kept", "d", "sha", "s", "class", "class_id", "band", "shard", "slot", "length", "size", "task"]
    long = " ".join(f"w{n * 7919 % 100_003}" for n in range(60_000))
    rows = [(1, long), (2, "one text under this id"), (2, "another one under it"), (3, "the same row"), (3, "the same row"), (None, "no id at all"), (None, "nor here"), (4, None), (5, "")]
    docs = spark.createDataFrame([(d, t, None, "src", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for n, c in enumerate(own):
        docs = docs.withColumn(c, F.lit(7.0) if n % 2 else F.lit("mine"))
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    texts = [t for _, t in rows]
    texts.remove("the same row")
    for _, stage in corpus_pipeline.STAGES[:4]:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        got = docs.collect()
        assert all(r[c] == (7.0 if n % 2 else "mine") for r in got for n, c in enumerate(own))
        docs = spark.createDataFrame(got, docs.schema)
    assert sorted(map(str, (r["text"] for r in got))) == sorted(map(str, texts))
    assert corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).select("doc_id", "piece").count() > len(texts)


@pytest.mark.parametrize("module", ["packing", "neardup", "secrets", "toxicity", "ann", "counts", "media", "bpe", "suffixes", "sharding", "lexical", "lines", "turns"])
def test_registered(module):
    import __spark_entry__

    assert any(name.startswith("op") for name in __import__(f"fwloom.llm.{module}", fromlist=["QUERIES"]).QUERIES)
    assert len([q for q in __spark_entry__.queries() if re.match(r"op\d+_", q)]) == 13
