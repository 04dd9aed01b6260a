"""Layout workbooks: cells of .xlsx and .xls sheets, and the compilation of a sheet into a layout."""

from __future__ import annotations

import difflib
import hashlib
import re
import xml.etree.ElementTree as ET
import zipfile
from dataclasses import replace
from datetime import UTC, datetime
from pathlib import Path

from fwloom.config import SheetConfig, WorkbookConfig
from fwloom.layouts import TRADE_TYPES, Field, Layout, LayoutError, Source, check
from fwloom.sources import xls

#: Fixed values of the workbook format: names of dtypes in lower case, and spellings of yes and no.
DTYPE_NAMES = {
    "Utf8": "string str text char varchar utf8",
    "Int64": "int integer bigint long int64 num number numeric",
    "Float64": "float double decimal float64",
    "Date": "date yyyymmdd",
}
YES, NO = set("y yes true t 1".split()), set("n no false f 0".split())
HEADERS = ("position", "description", "length", "type")
BLANK = "blank"

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

Rows = list[list[object]]


def sheets_of(path: Path) -> dict[str, Rows]:
    """Cells of every sheet of an .xlsx or .xls file, told apart by their first bytes; cells are text, numbers or None."""
    with path.open("rb") as f:
        old = f.read(8) == xls.MAGIC
    if old:
        try:
            return xls.sheets_of(path.read_bytes())
        except xls.XlsError as e:
            raise LayoutError(f"{path.name}: not a readable .xls workbook ({e})") from e
    try:
        with zipfile.ZipFile(path) as z:
            read = lambda name: ET.fromstring(z.read(name))
            text = lambda e: "".join(t.text or "" for t in e.iter(f"{{{NS['m']}}}t"))
            strings = [text(si) for si in read("xl/sharedStrings.xml").findall("m:si", NS)] if "xl/sharedStrings.xml" in z.namelist() else []
            targets = {r.get("Id"): r.get("Target") for r in read("xl/_rels/workbook.xml.rels")}
            out = {}
            for s in read("xl/workbook.xml").find("m:sheets", NS):
                target = targets[s.get(REL)]
                sheet = read(target.lstrip("/") if target.startswith("/") else f"xl/{target}")
                out[s.get("name")] = [_cells(row, strings, text) for row in sheet.iter(f"{{{NS['m']}}}row")]
            return out
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        raise LayoutError(f"{path.name}: not a readable .xlsx workbook ({e})") from e


def _cells(row: ET.Element, strings: list[str], text) -> list[object]:
    out: list[object] = []
    for c in row.findall("m:c", NS):
        ref = re.match("[A-Z]+", c.get("r", ""))
        if ref:
            at = 0
            for letter in ref[0]:
                at = at * 26 + ord(letter) - 64
            out += [None] * (at - 1 - len(out))
        value, kind = c.find("m:v", NS), c.get("t")
        if kind == "inlineStr":
            out.append(text(c))
        elif value is None or value.text is None:
            out.append(None)
        elif kind == "s":
            out.append(strings[int(value.text)])
        elif kind in ("str", "b"):
            out.append(value.text)
        else:
            number = float(value.text)
            out.append(int(number) if number.is_integer() else number)
    return out


def dtype_of(name: object) -> str:
    for dtype, names in DTYPE_NAMES.items():
        if str(name).strip().lower() in names.split():
            return dtype
    raise LayoutError(f"unknown column type {name!r}")


def flag_of(cell: object) -> bool:
    if cell is None or isinstance(cell, (int, float)):
        return cell is None or bool(cell)
    word = str(cell).strip().lower()
    if word in YES or word in NO or not word:
        return word not in NO
    raise LayoutError(f"expected yes or no, got {cell!r}")


def number_of(cell: object) -> int | None:
    try:
        return int(float(str(cell)))
    except ValueError:
        return None


def text_of(cell: object) -> str:
    return "" if cell is None else str(cell).strip()


def layout_of(rows: Rows, sheet: str) -> tuple[list[Field], int]:
    """Fields and record length. Filler and position-only rows extend the record; footers are passed over."""
    header = next((i for i, r in enumerate(rows) if set(HEADERS) <= {text_of(c).lower() for c in r}), None)
    if header is None:
        raise LayoutError(f"sheet {sheet!r} has no header row with {', '.join(HEADERS)}")
    where = {text_of(c).lower(): i for i, c in reversed(list(enumerate(rows[header])))}
    fields, end = [], 0
    for row in rows[header + 1 :]:
        cell = lambda name: row[where[name]] if name in where and where[name] < len(row) else None  # noqa: B023, E731
        start, length = number_of(cell("position")), number_of(cell("length"))
        if start is None or (text_of(cell("length")) and length is None):
            continue
        if length is None:
            end = max(end, start)
            continue
        end = max(end, start + length - 1)
        name = text_of(cell("description"))
        if name.lower() == BLANK or not name:
            continue
        dtype = dtype_of(cell("type"))
        parse = text_of(cell("parse")) or ("yyyymmdd_to_date" if dtype == "Date" else None)
        fields.append(Field(name, start, length, dtype, flag_of(cell("nullable")), parse))
    return fields, end


def configured(fields: list[Field], cfg: SheetConfig) -> list[Field]:
    """Renames, casts, parsers and coercion of a sheet's configuration, in this order."""
    names = [f.physical_name for f in fields]
    for what in ("rename", "cast", "parse", "coerce_invalid_to_null"):
        for name in getattr(cfg, what):
            if name not in names:
                near = difflib.get_close_matches(name, names, 1)
                raise LayoutError(f"{what}: unknown column {name!r}" + (f"; did you mean {near[0]!r}?" if near else ""))
    out = []
    for f in fields:
        name = f.physical_name
        if name in cfg.rename:
            f = replace(f, logical_name=cfg.rename[name])
        if name in cfg.cast:
            dtype = cfg.cast[name]
            f = replace(f, dtype=dtype, parse="yyyymmdd_to_date" if dtype == "Date" else None)
        if name in cfg.parse:
            if f.dtype != "Date":
                raise LayoutError(f"parse: column {name!r} is {f.dtype}, not Date")
            f = replace(f, parse=cfg.parse[name])
        if name in cfg.coerce_invalid_to_null:
            if not f.nullable:
                raise LayoutError(f"coerce_invalid_to_null: column {name!r} is not nullable")
            f = replace(f, coerce_invalid_to_null=True)
        out.append(f)
    return out


def workbook_id(name: str) -> str:
    return Path(name).stem.split("_", 1)[0]


def compile_sheet(rows: Rows, sheet: str, cfg: SheetConfig, book: WorkbookConfig, trade_type: str, source: Source) -> Layout:
    fields, length = layout_of(rows, sheet)
    columns = tuple(configured(fields, cfg))
    routing = next((f for f in columns if f.name == cfg.routing_column and f.dtype == "Date"), None)
    derived = (("year", f"year({routing.name})"), ("month", f"month({routing.name})")) if routing else ()
    return check(Layout(trade_type, book.effective_from, book.effective_from, length, columns, cfg.routing_column, source, derived, effective_to=book.effective_to, computed_columns=cfg.computed, dropped_columns=cfg.drop))


def compile_workbook(path: Path, book: WorkbookConfig) -> dict[str, Layout]:
    """Layouts by trade type; sheets without one take the trade types in order of configuration."""
    cells = sheets_of(path)
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    now = datetime.now(UTC).isoformat(timespec="seconds")
    out: dict[str, Layout] = {}
    for n, (sheet, cfg) in enumerate(book.sheets.items()):
        if sheet not in cells:
            raise LayoutError(f"{path.name} has no sheet {sheet!r}")
        if cfg.trade_type is None and n >= len(TRADE_TYPES):
            raise LayoutError(f"{path.name}: more sheets than trade types")
        kind = cfg.trade_type or TRADE_TYPES[n]
        if kind in out:
            raise LayoutError(f"{path.name}: two sheets for trade type {kind!r}")
        source = Source(path.name, digest, sheet, now, book.workbook_id or workbook_id(path.name), cfg.filename_pattern)
        out[kind] = compile_sheet(cells[sheet], sheet, cfg, book, kind, source)
    return out
