import random
import struct

import pytest

from fwloom.layouts import LayoutError
from fwloom.sources import workbook as W
from fwloom.sources import xls as X
from tests.test_catalog_and_cycle import ROWS, book, project


def record(kind, data):
    return struct.pack("<HH", kind, len(data)) + data


def text(s, extras=False):
    """A text as the table of strings holds it."""
    wide = any(ord(c) > 255 for c in s)
    flags = wide | (8 if extras else 0) | (4 if extras else 0)
    return struct.pack("<HB", len(s), flags) + (struct.pack("<HI", 2, 5) if extras else b""), s.encode("utf-16-le" if wide else "latin-1"), wide, b"\0" * 13 if extras else b""


def shared_strings(strings, size):
    """The table of strings, cut into records of at most ``size`` bytes wherever that falls; heads of texts stay whole."""
    parts, now = [], struct.pack("<II", len(strings), len(strings))
    for n, s in enumerate(strings):
        head, body, wide, tail = text(s, n % 3 == 1)
        if len(now) + len(head) > size:
            parts, now = [*parts, now], b""
        now += head
        while body:
            room = size - len(now)
            room -= room % 2 if wide else 0
            if room <= 0:
                parts, now = [*parts, now], bytes([wide])
                continue
            now, body = now + body[:room], body[room:]
        if len(now) + len(tail) > size:
            now, tail = now + tail[: size - len(now)], tail[size - len(now) :]
            parts, now = [*parts, now], b""
        now += tail
    first, *rest = [*parts, now]
    return record(X.STRINGS, first) + b"".join(record(X.MORE, p) for p in rest)


def cell(row, column, value, strings, how):
    at = struct.pack("<HHH", row, column, 0)
    if isinstance(value, str):
        if how == 0:
            strings.append(value)
            return record(X.SHARED, at + struct.pack("<I", len(strings) - 1))
        if how == 1:
            return record(X.LABEL, at + b"".join(text(value)[:2]))
        return record(X.FORMULA, at + b"\0" + b"\0" * 5 + b"\xff\xff" + b"\0" * 8) + record(X.TEXT, b"".join(text(value)[:2]))
    if how == 0:
        return record(X.NUMBER, at + struct.pack("<d", value))
    if how == 1 and float(value).is_integer() and abs(value) < 1 << 29:
        return record(X.RK, at + struct.pack("<i", int(value) << 2 | 2))
    if how == 1 and abs(value) < 1000:
        return record(X.RK, at + struct.pack("<I", (int(round(value * 100)) << 2 | 3) & 0xFFFFFFFF))
    return record(X.FORMULA, at + struct.pack("<d", value) + b"\0" * 8)


def stream_of(sheets, string_size=8224, filler=0):
    bof = lambda kind: record(X.BOF, struct.pack("<HHHHII", X.BIFF8, kind, 0, 0, 0, 0))
    strings, bodies, rng = [], [], random.Random(1)
    for rows in sheets.values():
        body = bof(16)
        for r, row in enumerate(rows):
            body += b"".join(cell(r, c, v, strings, rng.randrange(3)) for c, v in enumerate(row) if v is not None)
        bodies.append(body + record(0x1234, b"\0" * min(filler, 8000)) + record(X.EOF, b""))
    table = shared_strings(strings, string_size)
    names = [struct.pack("<BB", len(n), 1) + n.encode("utf-16-le") for n in sheets]
    at = len(bof(5)) + sum(10 + len(n) for n in names) + len(table) + 4
    heads = b""
    for n, body in zip(names, bodies):
        heads += record(X.SHEET, struct.pack("<IBB", at, 0, 0) + n)
        at += len(body)
    return bof(5) + heads + table + record(X.EOF, b"") + b"".join(bodies)


def compound(stream, name="Workbook"):
    """A compound file with one stream: in sectors of its own, or in the small ones if it is short."""
    sector, small = 512, len(stream) < 4096
    pad = lambda b, n: b + b"\0" * (-len(b) % n)
    content = pad(stream, 64 if small else sector)
    entry = lambda n, kind, start, size: pad(n.encode("utf-16-le"), 64)[:64] + struct.pack("<HBB", 2 * len(n) + 2, kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<III", start, size, 0)
    blocks, fat = [], []

    def put(data):
        first = len(blocks)
        cut = [pad(data[n : n + sector], sector) for n in range(0, len(data), sector)]
        blocks.extend(cut)
        fat.extend([*range(first + 1, first + len(cut)), X.END_OF_CHAIN])
        return first

    start = put(content)
    mini = X.END_OF_CHAIN
    if small:
        mini = put(pad(struct.pack(f"<{len(content) // 64}I", *range(1, len(content) // 64), X.END_OF_CHAIN), sector))
    root = entry("Root Entry", 5, start if small else X.END_OF_CHAIN, len(content) if small else 0)
    folder = put(pad(root + entry(name, 2, 0 if small else start, len(stream)), sector))
    n = -(-(len(fat) + 4) // 127)
    tables = [len(blocks) + k for k in range(n)]
    fat += [0xFFFFFFFD] * n
    raw = struct.pack(f"<{len(fat)}I", *fat)
    raw += b"\xff" * (n * sector - len(raw))
    head = X.MAGIC + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<II4xIIIII", n, folder, 4096, mini, 1 if small else 0, X.END_OF_CHAIN, 0)
    return head + struct.pack("<109I", *tables, *[0xFFFFFFFF] * (109 - n)) + b"".join(blocks) + raw


def cells(rows):
    """Without what a sheet does not keep: empty ends of rows and of the sheet."""
    out = [[*r] for r in rows]
    for r in out:
        while r and r[-1] in (None, ""):
            r.pop()
    while out and not out[-1]:
        out.pop()
    return out


@pytest.mark.parametrize("size", [40, 61, 8224])
@pytest.mark.parametrize("filler", [0, 6000])
def test_cells_come_back(size, filler):
    rng = random.Random(size)
    words = ["position", "Ünïcode", "日本語のテキスト", "x" * 300, "é" * 90, "code of goods", "€" * 77]
    sheets = {"Sheet": [[rng.choice([*words, 3, 2.5, -17, 1e9, 0.07, None]) for _ in range(6)] for _ in range(25)], "Zwei €": [["a", None, 1]], "none": []}
    sheets["Sheet"][3] = []
    got = X.sheets_of(compound(stream_of(sheets, size, filler)))
    assert list(got) == list(sheets)
    assert {n: cells(r) for n, r in got.items()} == {n: cells(r) for n, r in sheets.items()}


def test_many_numbers_and_charts():
    many = record(X.MANY_RK, struct.pack("<HH", 0, 1) + b"".join(struct.pack("<HI", 0, n << 2 | 2) for n in (5, 6, 7)) + struct.pack("<H", 3))
    chart = record(X.BOF, struct.pack("<HHHHII", X.BIFF8, 32, 0, 0, 0, 0)) + cell(0, 0, 99.0, [], 0) + record(X.EOF, b"")
    stream = record(X.BOF, struct.pack("<HHHHII", X.BIFF8, 16, 0, 0, 0, 0)) + chart + many + record(X.BOOLEAN, struct.pack("<HHHBB", 1, 0, 0, 1, 0)) + record(X.EOF, b"") + cell(5, 5, 1.0, [], 0)
    assert X.sheet_cells(stream, 0, [], True, "cp1252") == [[None, 5, 6, 7], ["1"]]
    assert X.rk_number(struct.unpack("<I", struct.pack("<i", -7 << 2 | 2))[0]) == -7 and X.rk_number(0x3FF00000) == 1.0


def test_older_version():
    """Version 5: texts in a code page, sheet names without flags."""
    bof = lambda kind: record(X.BOF, struct.pack("<HHHH", 0x500, kind, 0, 0))
    body = bof(16) + record(X.LABEL, struct.pack("<HHHH", 0, 1, 0, 3) + "Zoé".encode("cp1252")) + record(X.EOF, b"")
    head = bof(5) + record(X.CODEPAGE, struct.pack("<H", 1252))
    at = len(head) + 4 + 7 + 4 + 4
    stream = head + record(X.SHEET, struct.pack("<IBBB", at, 0, 0, 4) + b"List") + record(X.EOF, b"") + body
    assert X.sheets_of(compound(stream, "Book")) == {"List": [[None, "Zoé"]]}


def test_same_layout_from_both_kinds(tmp_path):
    book(tmp_path / "b_2020.xlsx", {"Sheet": ROWS})
    config = project(tmp_path / "p.yaml", rename={"value": "amount"}, drop=["code"])
    new = W.compile_workbook(tmp_path / "b_2020.xlsx", config.workbooks["b_2020.xlsx"])["imports"]
    for filler in (0, 8000):
        (tmp_path / "b_2020.xls").write_bytes(compound(stream_of({"Sheet": ROWS}, 50, filler)))
        old = W.compile_workbook(tmp_path / "b_2020.xls", config.workbooks["b_2020.xlsx"])["imports"]
        assert (old.columns, old.record_length, old.derived) == (new.columns, new.record_length, new.derived)


def test_damaged_workbooks(tmp_path):
    good = compound(stream_of({"Sheet": ROWS}, 50))
    rng = random.Random(4)
    for n in range(200):
        bad = bytearray(good if n % 2 else good[: rng.randrange(8, len(good))])
        for _ in range(rng.choice([1, 5, 40])):
            bad[rng.randrange(8, len(bad))] = rng.randrange(256)
        (tmp_path / "b.xls").write_bytes(bad)
        try:
            W.sheets_of(tmp_path / "b.xls")
        except LayoutError:
            pass
    (tmp_path / "b.xls").write_bytes(X.MAGIC + b"\0" * 600)
    with pytest.raises(LayoutError, match="not a readable .xls"):
        W.sheets_of(tmp_path / "b.xls")
