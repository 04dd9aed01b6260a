"""Cells of .xls workbooks: the compound file that holds the workbook's stream, and the stream's records.

Layout workbooks are small configuration files, read by the driver. Fixed values of the formats stand with their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
END_OF_CHAIN, NO_STREAM = 0xFFFFFFFE, 0xFFFFFFFF
#: Kinds of records.
BOF, EOF, SHEET, STRINGS, MORE, CODEPAGE = 0x809, 0x0A, 0x85, 0xFC, 0x3C, 0x42
NUMBER, RK, MANY_RK, SHARED, LABEL, RICH, BOOLEAN, FORMULA, TEXT = 0x203, 0x27E, 0xBD, 0xFD, 0x204, 0xD6, 0x205, 0x06, 0x207
BIFF8 = 0x600

Rows = list[list[object]]


class XlsError(ValueError):
    """A file that is no readable .xls workbook."""


def workbook_stream(data: bytes) -> bytes:
    """The stream ``Workbook`` (or ``Book``, as older versions call it) of a compound file."""
    if data[:8] != MAGIC:
        raise XlsError("no compound file")
    if struct.unpack_from("<HH", data, 30) not in ((9, 6), (12, 6)):
        raise XlsError("sizes of sectors")
    sector, mini = 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
    folder, cutoff, mini_fat, _, more, _ = struct.unpack_from("<I4xIIIII", data, 48)
    at = lambda n: data[(n + 1) * sector : (n + 2) * sector]
    numbers = lambda raw: list(struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4]))
    tables, seen = [n for n in numbers(data[76:512]) if n < END_OF_CHAIN - 4], set()
    while more < END_OF_CHAIN - 4 and more not in seen:
        seen.add(more)
        *places, more = numbers(at(more))
        tables += [n for n in places if n < END_OF_CHAIN - 4]
    fat = [n for t in tables for n in numbers(at(t))]

    def chain(start: int, table: list[int]) -> Iterator[int]:
        steps = 0
        while start < END_OF_CHAIN - 4:
            if start >= len(table) or steps > len(table):
                raise XlsError("a chain of sectors leads nowhere")
            yield start
            start, steps = table[start], steps + 1

    whole = lambda start: b"".join(at(n) for n in chain(start, fat))
    entries = whole(folder)
    found, root = {}, b""
    for n in range(0, len(entries) - 127, 128):
        size, kind = struct.unpack_from("<HB", entries, n + 64)
        start, length = struct.unpack_from("<II", entries, n + 116)
        name = entries[n : n + max(0, size - 2)].decode("utf-16-le", "replace")
        if kind == 5:
            root = whole(start) if length else b""
        elif kind == 2:
            found[name] = (start, length)
    for name in ("Workbook", "Book"):
        if name in found:
            start, length = found[name]
            if length >= cutoff:
                return whole(start)[:length]
            table = numbers(whole(mini_fat))
            return b"".join(root[n * mini : (n + 1) * mini] for n in chain(start, table))[:length]
    raise XlsError("no workbook in the compound file")


def records(stream: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """Kind and data of each record, with the data of the records that continue it."""
    held: tuple[int, list[bytes]] | None = None
    while at + 4 <= len(stream):
        kind, size = struct.unpack_from("<HH", stream, at)
        data, at = stream[at + 4 : at + 4 + size], at + 4 + size
        if kind == MORE and held:
            held[1].append(data)
            continue
        if held:
            yield held
        held = (kind, [data])
    if held:
        yield held


class Pieces:
    """Bytes that run over records; a text that does so says anew at the start of the next how wide its characters are."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.part, self.at = parts, 0, 0

    def left(self) -> int:
        return len(self.parts[self.part]) - self.at

    def following(self) -> None:
        if self.part + 1 >= len(self.parts):
            raise XlsError("a text ends outside its record")
        self.part, self.at = self.part + 1, 0

    def take(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            if not self.left():
                self.following()
            piece = self.parts[self.part][self.at : self.at + n - len(out)]
            out, self.at = out + piece, self.at + len(piece)
        return out

    def text(self) -> str:
        """A text with its length in two bytes, and what may follow it."""
        length, flags = struct.unpack("<HB", self.take(3))
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out, wide = [], flags & 1
        while length:
            if not self.left():
                self.following()
                wide = self.take(1)[0] & 1
            n = min(length, self.left() // 2 if wide else self.left())
            if not n:
                raise XlsError("half a character at the end of a record")
            out.append(self.take(2 * n if wide else n).decode("utf-16-le" if wide else "latin-1", "replace"))
            length -= n
        self.take(4 * runs + extra)
        return "".join(out)


def rk_number(raw: int) -> float:
    """A number in 30 bits: whole or the upper part of a double, maybe in hundredths."""
    value = float((raw - (1 << 32) if raw & 1 << 31 else raw) >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<Q", (raw & ~3 & 0xFFFFFFFF) << 32))[0]
    return value / 100 if raw & 1 else value


def plain(value: float) -> int | float:
    return int(value) if value.is_integer() else value


def sheet_cells(stream: bytes, start: int, strings: list[str], new: bool, codec: str) -> Rows:
    cells: dict[tuple[int, int], object] = {}
    waiting: tuple[int, int] | None = None
    depth = 0

    def label(data: bytes, at: int) -> str:
        if new:
            return Pieces([data[at:]]).text()
        return data[at + 2 : at + 2 + struct.unpack_from("<H", data, at)[0]].decode(codec, "replace")

    for kind, parts in records(stream, start):
        data = parts[0]
        if kind == BOF:
            depth += 1
        elif kind == EOF:
            depth -= 1
            if not depth:
                break
        elif depth > 1:  # a chart within the sheet
            continue
        elif kind == TEXT and waiting:
            cells[waiting] = Pieces(parts).text() if new else label(data, 0)
            waiting = None
        elif kind in (NUMBER, RK, MANY_RK, SHARED, LABEL, RICH, BOOLEAN, FORMULA):
            row, column = struct.unpack_from("<HH", data)
            if kind == NUMBER:
                cells[row, column] = plain(struct.unpack_from("<d", data, 6)[0])
            elif kind == RK:
                cells[row, column] = plain(rk_number(struct.unpack_from("<I", data, 6)[0]))
            elif kind == MANY_RK:
                for n in range((len(data) - 6) // 6):
                    cells[row, column + n] = plain(rk_number(struct.unpack_from("<I", data, 6 + 6 * n)[0]))
            elif kind == SHARED:
                cells[row, column] = strings[struct.unpack_from("<I", data, 6)[0]]
            elif kind in (LABEL, RICH):
                cells[row, column] = label(data, 6)
            elif kind == BOOLEAN:
                cells[row, column] = str(data[6]) if not data[7] else None
            elif data[12:14] != b"\xff\xff":
                cells[row, column] = plain(struct.unpack_from("<d", data, 6)[0])
            elif data[6] == 0:
                waiting = (row, column)
            elif data[6] == 1:
                cells[row, column] = str(data[8])
    out: Rows = []
    for row, column in sorted(cells):
        while len(out) <= row:
            out.append([])
        out[row] += [None] * (column - len(out[row])) + [cells[row, column]]
    return out


def sheets_of(data: bytes) -> dict[str, Rows]:
    """Cells of every sheet; cells are text, numbers or None, and empty text is None."""
    try:
        stream = workbook_stream(data)
        found, strings, new, codec = [], [], True, "cp1252"
        for kind, parts in records(stream):
            data = parts[0]
            if kind == BOF:
                new = struct.unpack_from("<H", data)[0] >= BIFF8
            elif kind == CODEPAGE and not new:
                page = struct.unpack_from("<H", data)[0]
                codec = "mac-roman" if page == 0x8000 else "cp1252" if page == 0x8001 else f"cp{page}"
            elif kind == SHEET:
                start, _, what, size = struct.unpack_from("<IBBB", data)
                if what == 0:
                    name = data[8:].decode("utf-16-le" if data[7] & 1 else "latin-1") if new else data[7 : 7 + size].decode(codec)
                    found.append((name, start))
            elif kind == STRINGS:
                text = Pieces([parts[0][8:], *parts[1:]])
                strings = [text.text() for _ in range(struct.unpack_from("<I", parts[0], 4)[0])]
            elif kind == EOF:
                break
        sheets = {name: sheet_cells(stream, start, strings, new, codec) for name, start in found}
        return {name: [[None if c == "" else c for c in row] for row in rows] for name, rows in sheets.items()}
    except XlsError:
        raise
    except (struct.error, ValueError, LookupError) as e:
        raise XlsError(f"damaged workbook: {e}") from e
