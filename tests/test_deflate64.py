import random
import struct
import zlib

import pytest

from fwloom.sources import deflate64 as X
from fwloom.sources.fwf_zip import read_lines


class Packer:
    """Writes one block with the fixed codes: literals, and copies of any length and distance."""

    def __init__(self):
        self.bits = ""

    def number(self, value, n):
        self.bits += f"{value:0{n}b}"[::-1] if n else ""

    def symbol(self, s):
        code, n = (0x30 + s, 8) if s < 144 else (0x190 + s - 144, 9) if s < 256 else (s - 256, 7) if s < 280 else (0xC0 + s - 280, 8)
        self.bits += f"{code:0{n}b}"

    def copy(self, length, distance, long=False):
        code = 28 if long or length > 257 else max(n for n in range(28) if X.LENGTHS[n][0] <= length)
        self.symbol(257 + code)
        self.number(length - X.LENGTHS[code][0], X.LENGTHS[code][1])
        code = max(n for n in range(32) if X.DISTANCES[n][0] <= distance)
        self.bits += f"{code:05b}"
        self.number(distance - X.DISTANCES[code][0], X.DISTANCES[code][1])

    def done(self):
        self.symbol(256)
        bits = "110" + self.bits
        bits += "0" * (-len(bits) % 8)
        return bytes(int(bits[n : n + 8][::-1], 2) for n in range(0, len(bits), 8))


def pack(data):
    """Greedy copies of the last place of three bytes in a window of 64 KB."""
    p, at, seen = Packer(), 0, {}
    while at < len(data):
        key, length = data[at : at + 3], 0
        if (start := seen.get(key)) is not None and at - start <= 65_536:
            while at + length < len(data) and length < 65_538 and data[start + length] == data[at + length]:
                length += 1
        seen[key] = at
        if length >= 3:
            p.copy(length, at - start)
            at += length
        else:
            p.symbol(data[at])
            at += 1
    return p.done()


def unpack(packed, piece=1 << 16):
    at = 0

    def read(n):
        nonlocal at
        at += min(n, piece)
        return packed[at - min(n, piece) : at]

    return b"".join(X.inflate64(read))


def archive(path, data, packed, crc=None):
    """A zip archive with one member of method 9."""
    name, crc = b"data.fwf", zlib.crc32(data) if crc is None else crc
    head = struct.pack("<HHHHHIIIHH", 20, 0, 9, 0, 33, crc, len(packed), len(data), len(name), 0)
    local = b"PK\3\4" + head + name + packed
    central = b"PK\1\2" + struct.pack("<H", 20) + head + struct.pack("<HHHII", 0, 0, 0, 0, 0) + name
    path.write_bytes(local + central + b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 1, 1, len(central), len(local), 0))


def test_ladders():
    assert X.LENGTHS[:9] == [(n, 0) for n in range(3, 11)] + [(11, 1)] and X.LENGTHS[27:] == [(227, 5), (3, 16)]
    assert X.DISTANCES[:5] == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 1)] and X.DISTANCES[30:] == [(32_769, 14), (49_153, 14)]


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_blocks_of_all_kinds(piece):
    rng = random.Random(piece)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(3000)).encode()
    for level in (0, 1, 9):  # stored, fixed and dynamic blocks; matches stay below the length that differs from Deflate
        c = zlib.compressobj(level, wbits=-15)
        assert unpack(c.compress(text) + c.flush(), piece) == text
    c = zlib.compressobj(9, wbits=-15, strategy=zlib.Z_FIXED)
    assert unpack(c.compress(text) + c.flush(), piece) == text
    assert unpack(zlib.compress(b"", wbits=-15)) == b""


def test_long_copies_and_far_ones():
    rng = random.Random(2)
    far = rng.randbytes(60_000)
    for data in (b"a" * 70_000, far + far[:5000], b"xyz" * 40_000 + far + b"xyz" * 30_000, rng.randbytes(300) * 900):
        assert unpack(pack(data)) == data
    p = Packer()
    p.symbol(65)
    p.copy(65_538, 1)
    p.copy(3, 65_536, long=True)
    assert unpack(p.done()) == b"A" * 65_542


def test_damage():
    packed = pack(b"hello hello hello" * 50)
    with pytest.raises(EOFError):
        unpack(packed[:-6])
    for bad in (b"\7", b"\1\1\0\1\1", b"\xff" * 40):
        with pytest.raises((X.Damaged, EOFError)):
            unpack(bad)
    p = Packer()
    p.copy(3, 10)
    with pytest.raises(X.Damaged, match="before the start"):
        unpack(p.done())
    rng = random.Random(9)
    for _ in range(300):  # any bytes end in data or in an error, never in another way
        try:
            unpack(rng.randbytes(rng.randint(1, 60)))
        except (X.Damaged, EOFError):
            pass


def test_archives(spark, tmp_path):
    lines = "".join(f"{n:>6}{'same text ' * 40}\n" for n in range(4000)).encode()
    packed = pack(lines)
    archive(tmp_path / "a.zip", lines, packed)
    archive(tmp_path / "b.zip", lines, packed, crc=1)
    archive(tmp_path / "c.zip", lines, packed[: len(packed) // 2])
    rows = read_lines(spark, str(tmp_path), split_bytes=1000).collect()
    good = sorted((r["line_no"], r["raw_line"]) for r in rows if r["input_path"].endswith("a.zip"))
    assert good == list(enumerate(lines.decode().splitlines(), 1))
    errors = {r["input_path"][-5:]: r["read_error"] for r in rows if r["read_error"]}
    assert "checksum" in errors["b.zip"] and "EOFError" in errors["c.zip"] and len(errors) == 2
