"""The file source: splits, numbers, pushdown and the log of streams."""

import os
import random
import shutil
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThan, LessThanOrEqual

from fwloom.operators import numbering
from fwloom.plans import cycle
from fwloom.sources import fwf_zip as Z
from fwloom.streaming import ingest as stream
from tests.test_ingest import counts, drop, env, line, options  # noqa: F401


def plain_rows(df):
    return sorted((os.path.basename(r["input_path"]), r["line_no"], r["raw_line"]) for r in df.collect())


def messy(rng, n):
    """Text with all line ends, empty lines and letters of several bytes."""
    return "".join(rng.choice(["a", "é", "x" * 9, "", " "]) + rng.choice(["\n", "\r\n", "\r", "\r\r\n", ""]) for _ in range(n))


def test_line_starts_and_counts(tmp_path):
    rng = random.Random(1)
    for n in range(60):
        data = messy(rng, rng.choice([0, 1, 3, 40])).encode()
        path = tmp_path / f"{n}.fwf"
        path.write_bytes(b"##" + data)
        low, high = 2, 2 + len(data)
        starts, at = [], 0
        for x in data.decode().splitlines(keepends=True):
            starts.append(low + at)
            at += len(x.encode())
        size = rng.choice([1, 2, 3, 7])
        crc = 0
        with Z.open_file(str(path)) as f:
            for a in range(low, high, size):
                b = min(a + size, high)
                assert Z.line_start(f, a, low, high) == min((s for s in starts if s >= a), default=high)
                lines, part = Z.count_lines(f, a, b, low)
                assert lines == sum(a <= s < b for s in starts)
                crc = Z.crc_join(crc, part, b - a)
        assert crc == zlib.crc32(data)


def test_chunks_of_one_byte_give_the_same(tmp_path, monkeypatch):
    monkeypatch.setattr(Z, "CHUNK", 1)
    test_line_starts_and_counts(tmp_path)


@pytest.mark.parametrize("split", [9, 100])
def test_splits_give_the_same_lines_as_whole_files(spark, tmp_path, split):
    rng = random.Random(split)
    for n in range(3):
        (tmp_path / f"{n}.fwf").write_bytes(messy(rng, 60).encode())
        for kind, how in (("s", zipfile.ZIP_STORED), ("d", zipfile.ZIP_DEFLATED)):
            with zipfile.ZipFile(tmp_path / f"{n}{kind}.zip", "w", how) as z:
                z.writestr("note", "x")
                z.writestr("data", messy(rng, 50))
    (tmp_path / "empty.fwf").write_bytes(b"")
    whole = plain_rows(Z.read_lines(spark, str(tmp_path)))
    cut = Z.read_lines(spark, str(tmp_path), split_bytes=split)
    assert plain_rows(cut) == whole and len(whole) > 200
    assert cut.rdd.getNumPartitions() > 10
    assert plain_rows(cut.where("line_no > 10 AND line_no <= 14")) == [r for r in whole if 10 < r[1] <= 14]
    assert plain_rows(Z.read_lines(spark, str(tmp_path), "utf-16", split)) != [] and not Z.splittable("utf-16") and Z.splittable("cp1252")


def test_damaged_stored_member_fails_its_file(spark, tmp_path):
    for name in ("good.zip", "bad.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("data", "".join(f"line {n}\n" for n in range(500)))
    raw = bytearray((tmp_path / "bad.zip").read_bytes())
    raw[1000] ^= 1
    (tmp_path / "bad.zip").write_bytes(raw)
    rows = Z.read_lines(spark, str(tmp_path), split_bytes=500).collect()
    assert sum(r["raw_line"] is not None and "good" in r["input_path"] for r in rows) == 500
    assert [r["read_error"] for r in rows if "bad" in r["input_path"]] == ["BadZipFile: the archive's checksum differs"]


def test_pushed_filters(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"{n}.fwf").write_text("".join(f"{n} {k}\n" for k in range(1000)))
    (tmp_path / "z.zip").write_bytes(b"PK no archive")
    reader = Z.PushingReader({"path": str(tmp_path)})
    filters = [IsNotNull(("input_path",)), In(("input_path",), (f"{tmp_path}/1.fwf", f"{tmp_path}/3.fwf")), EqualTo(("input_path",), f"{tmp_path}/3.fwf"), LessThan(("line_no",), 8), GreaterThan(("line_no",), 2), EqualTo(("raw_line",), "x")]
    assert list(reader.pushFilters(filters)) == [filters[0], *filters[3:]]
    assert [p.path for p in reader.partitions()] == [f"{tmp_path}/3.fwf"] and (reader.first, reader.last) == (3, 7)
    frame = Z.read_lines(spark, str(tmp_path), split_bytes=500)
    paths = [f"{tmp_path}/1.fwf", f"{tmp_path}/3.fwf"]
    some = frame.where(F.col("input_path").isin(paths) & (F.col("line_no") <= 5))
    # Two files of about 5,900 bytes: of their twelve splits each only the first holds such lines.
    assert some.rdd.getNumPartitions() == 2 and some.count() == 10
    assert frame.where(F.col("input_path").isin(paths)).rdd.getNumPartitions() == 24


def test_last_line_wanted_ends_the_reading(tmp_path):
    (tmp_path / "a.fwf").write_text("".join(f"{k}\n" for k in range(100_000)))
    reader = Z.PushingReader({"path": str(tmp_path), "batchRows": "10"})
    list(reader.pushFilters([LessThanOrEqual(("line_no",), 35)]))
    batches = list(reader.read(reader.partitions()[0]))
    assert sum(map(len, batches)) == 35


def test_seen_files(tmp_path):
    log = str(tmp_path / "log")
    seen = Z.SeenFiles(log)
    assert seen.look({}) == 0
    assert seen.look({"b": [1000, 5]}) == 1 and seen.between(0, 1) == ["b"]
    assert seen.look({"b": [1000, 5]}) == 1
    assert seen.look({"a": [900, 5], "b": [1000, 5]}) == 2 and seen.between(1, 2) == ["a"]  # older, and a smaller name
    seen = Z.SeenFiles(log)  # a restart
    assert seen.look({"a": [900, 5], "b": [1000, 5]}) == 2
    assert seen.look({"a": [900, 6], "b": [1000, 5]}) == 3 and seen.between(2, 3) == ["a"]  # new content
    for n in range(4, 60):
        there = {"a": [900, 6], f"f{n}": [n, 1]}
        assert seen.look(there) == n
        seen.done(n - 1, set(there))
    kept = sorted(os.listdir(log))
    assert sum("sum" in x for x in kept) == 1 and len(kept) < 45
    again = Z.SeenFiles(log)
    assert again.last == 59 and again.look({"a": [900, 6], "f59": [59, 1]}) == 59 and again.between(58, 59) == ["f59"]
    assert again.look({"a": [900, 6], "f5": [5, 1]}) == 60  # was gone, and came back


def test_stream_reads_older_and_changed_files_once(spark, env):  # noqa: F811
    def run():
        stream.start(spark, options(env, ytd=False), str(env / "check")).awaitTermination(120)
        return counts(spark, env)

    upstream = env / "upstream"
    assert run()[2024, 2] == 12
    drop(upstream, "Sheet_202403N.TXT.zip", [line("202403", n) for n in range(3)])
    os.utime(upstream / "Sheet_202403N.TXT.zip", (1_000_000_000, 1_000_000_000))  # an old file, mirrored with its age
    assert cycle.mirror(str(upstream), str(env / "in")) == 1
    assert run()[2024, 3] == 3
    manifests = lambda: len(list((env / "out/_manifests/imports").iterdir()))
    runs = manifests()
    assert run()[2024, 3] == 3 and manifests() == runs
    drop(upstream, "Sheet_202403N.TXT.zip", [line("202403", n) for n in range(4)])
    os.utime(upstream / "Sheet_202403N.TXT.zip", (1_000_000_000, 1_000_000_000))  # same name and age, other content
    shutil.copy2(upstream / "Sheet_202403N.TXT.zip", env / "in")
    assert run()[2024, 3] == 4 and manifests() == runs + 1


def test_streams_need_a_log(spark, tmp_path):
    with pytest.raises(ValueError, match="log"):
        Z.FwfStreamReader({"path": str(tmp_path)})


def test_numbers_of_a_hot_group(spark):
    """One group with almost all rows, null groups and equal rows: numbered by many tasks, without a gap."""
    rows = [("hot", n % 997, n) for n in range(5000)] + [(None, 1, 1), (None, None, 2), ("b", 3, 3), ("b", 3, 3)] + [("same", 1, 1)] * 3000
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(7)
    out = numbering.numbered(df, ["g"], ["k"])
    by = {}
    for r in out.collect():
        by.setdefault(r["g"], []).append((r["line_no"], -1 if r["k"] is None else r["k"]))
    for got in by.values():
        assert sorted(n for n, _ in got) == list(range(1, len(got) + 1))
        assert [k for _, k in sorted(got)] == sorted(k for _, k in got)
    assert len(by) == 4 and out.columns == ["g", "k", "v", "line_no"]
    assert numbering.numbered(df.limit(0), ["g"], ["k"]).count() == 0
    # The ranges are of rows, not of groups: the hot one is cut.
    assert df.repartitionByRange(4, "g", "k").groupBy(F.spark_partition_id()).count().where("count > 5000").count() == 0
