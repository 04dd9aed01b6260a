"""Operator 7: features recomputed, bounded archives, and commits of all or nothing."""

import hashlib
import struct
import zipfile
import zlib

import pytest

from fwloom.llm import media
from fwloom.llm.common import shared_dir


def plain_image(data):
    """The stored form, written by itself: one grey image of 576 columns."""
    rows = [data[n : n + 576] for n in range(0, len(data), 576)]
    parts = [(b"IHDR", struct.pack(">IIBBBBB", 576, len(rows), 8, 0, 0, 0, 0)), (b"IDAT", zlib.compress(b"".join(b"\0" + r for r in rows), 6)), (b"IEND", b"")]
    return b"\x89PNG\r\n\x1a\n" + b"".join(struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b)) for k, b in parts)


def plain_feature(data):
    n, mean = len(data), sum(data)
    square = sum(x * x for x in data)
    deviation = int(max(square * n - mean * mean, 0) ** 0.5 * 1000 // n)
    edges = sum(abs(a - b) > 32 for a, b in zip(data, data[1:]))
    quarters = "/".join(str(sum(x // 64 == q for x in data) * 1000 // n) for q in range(4))
    return f"mean={mean * 1000 // n};deviation={deviation};edges={edges};quarters={quarters}"


def test_every_column_recomputed(spark, sf_dir):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = media.op7_media(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        data = texts[r["doc_id"]]
        data = data.ljust(max(576, -(-len(data) // 576) * 576), b"\xff")
        image = plain_image(data)
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(image), hashlib.sha256(image).hexdigest(), plain_feature(data))


def members(spark, path):
    return sorted(r["doc_id"] for r in media.read_archives(spark, path).collect())


def test_archives_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(media, "ARCHIVE_MEMBERS", 7)
    writer = media.ArchiveWriter(shared_dir(spark))
    import pyarrow as pa

    batch = pa.record_batch([pa.array(range(40), pa.int64()), pa.array([b"x" * n for n in range(40)], pa.binary())], ["doc_id", "media"])
    message = writer.write(iter([batch, batch.slice(0, 0), batch]))
    files, root = media.open_fs(writer.path)
    assert len(message.names) == 12 and max(len(media.members_of(files, f"{root}/{n}")) for n in message.names) == 7
    assert media.ArchiveReader(writer.path, 100).archives() == []  # nothing is seen before the commit
    writer.commit([message, None, media.ArchiveCommit([])])
    assert members(spark, writer.path) == sorted([*range(40)] * 2)


def test_jobs_are_seen_whole_or_not_at_all(spark):
    path = shared_dir(spark)
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(30)], "doc_id long, text string")
    media.write_archives(docs.repartition(3), path)
    # A job whose driver is lost: its archives lie there, its list does not.
    import pyarrow as pa

    lost = media.ArchiveWriter(path).write(iter([pa.record_batch([pa.array([99], pa.int64()), pa.array([b"x"], pa.binary())], ["doc_id", "media"])]))
    assert len(lost.names) == 1 and members(spark, path) == [*range(30)]
    media.write_archives(docs.limit(2), path)
    assert members(spark, path) == sorted([*range(30), *(r["doc_id"] for r in docs.limit(2).collect())])
    files, root = media.open_fs(path)
    with zipfile.ZipFile(f"{root}/other.zip", "w") as z:  # of another maker
        z.writestr("0/77.png", media.png(media.payload("seen")))
    assert 77 in members(spark, path)
    media.ArchiveWriter(path).abort([lost])
    assert files.get_file_info(f"{root}/{lost.names[0]}").type == media.fs.FileType.NotFound


@pytest.mark.parametrize("most", [1, 3, 100_000])
def test_ranges_grow_with_the_folder(spark, monkeypatch, most):
    path = shared_dir(spark)
    media.write_archives(spark.createDataFrame([(n, f"text {n} " * 50) for n in range(60)], "doc_id long, text string").repartition(1), path)
    monkeypatch.setattr(media, "MOST_RANGES", most)
    reader = media.ArchiveReader(path, 500)
    parts = reader.partitions()
    assert len(parts) <= most + 1 and (most < 4 or len(parts) > 10)
    got = [d for p in parts for batch in reader.read(p) for d in batch.column(0).to_pylist()]
    assert sorted(got) == [*range(60)]
