"""Versioned record layouts: model, YAML form, checks, and the version that applies to a period."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import types as T

#: Fixed values of the layout format.
TRADE_TYPES = ("imports", "exports_us", "exports_nonus")
DTYPES = {"Utf8": T.StringType(), "Int64": T.LongType(), "Float64": T.DoubleType(), "Date": T.DateType()}
DATE_PARSERS = ("yyyymmdd_to_date", "yyyymm_to_date")
COMPUTED_KINDS = {"concat_to_date": "Date", "concat_text": "Utf8"}
PERIOD = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


class LayoutError(ValueError):
    """A layout that cannot be used."""


@dataclass(frozen=True)
class Field:
    """A field of the record: 1-based start, length in characters."""

    physical_name: str
    start: int
    length: int
    dtype: str
    nullable: bool = True
    parse: str | None = None
    description: str | None = None
    logical_name: str | None = None
    coerce_invalid_to_null: bool = False

    @property
    def end(self) -> int:
        return self.start + self.length - 1

    @property
    def name(self) -> str:
        return self.logical_name or self.physical_name


@dataclass(frozen=True)
class Computed:
    """A column made from parsed fields."""

    name: str
    dtype: str
    kind: str
    sources: tuple[str, ...]
    nullable: bool = True
    separator: str = " "


@dataclass(frozen=True)
class Source:
    """Where a layout came from."""

    workbook: str
    sha256: str
    sheet: str
    imported_at: str
    workbook_id: str | None = None
    filename_pattern: str | None = None


@dataclass(frozen=True)
class Layout:
    """One version of the record layout of a trade type; the window of periods is inclusive."""

    trade_type: str
    version: str
    effective_from: str
    record_length: int
    columns: tuple[Field, ...]
    routing_column: str = "period"
    source: Source | None = None
    derived: tuple[tuple[str, str], ...] = ()
    partition_by: tuple[str, ...] = ("year", "month")
    effective_to: str | None = None
    computed_columns: tuple[Computed, ...] = ()
    dropped_columns: tuple[str, ...] = ()

    @property
    def fields(self) -> list[Field]:
        """In the order of the record."""
        return sorted(self.columns, key=lambda f: f.start)

    @property
    def min_record_length(self) -> int:
        return max(f.end for f in self.columns)

    @property
    def outputs(self) -> list[Field | Computed]:
        """What is written: kept fields in record order, then kept computed columns."""
        return [c for c in [*self.fields, *self.computed_columns] if c.name not in self.dropped_columns]

    def applies(self, period: str) -> bool:
        return self.effective_from <= period and (self.effective_to is None or period <= self.effective_to)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, DTYPES[c.dtype], c.nullable) for c in self.outputs])


def check_period(period: str) -> None:
    if not PERIOD.fullmatch(period):
        raise LayoutError(f"invalid period {period!r}, expected YYYY-MM")


def check_window(effective_from: str, effective_to: str | None) -> None:
    check_period(effective_from)
    if effective_to is not None:
        check_period(effective_to)
        if effective_to < effective_from:
            raise LayoutError(f"effective_to {effective_to} is before effective_from {effective_from}")


def next_period(period: str) -> str:
    year, month = map(int, period.split("-"))
    return f"{year + month // 12:04d}-{month % 12 + 1:02d}"


def check_pattern(pattern: str) -> None:
    try:
        groups = set(re.compile(pattern).groupindex)
    except re.error as e:
        raise LayoutError(f"filename_pattern {pattern!r} does not compile: {e}") from e
    if not {"year", "month"} <= groups:
        raise LayoutError(f"filename_pattern {pattern!r} needs the named groups year and month")
    if extra := groups - {"year", "month", "flag"}:
        raise LayoutError(f"filename_pattern {pattern!r} has unknown named groups {sorted(extra)}")


def repeated(names: list[str]) -> list[str]:
    return sorted({n for n in names if names.count(n) > 1})


def check(layout: Layout) -> Layout:
    """Returns ``layout`` if it can be compiled, else says why not."""
    if layout.trade_type not in TRADE_TYPES:
        raise LayoutError(f"unknown trade_type {layout.trade_type!r}")
    check_window(layout.effective_from, layout.effective_to)
    if layout.source and layout.source.filename_pattern is not None:
        check_pattern(layout.source.filename_pattern)
    if not layout.columns:
        raise LayoutError(f"{layout.trade_type}: layout has no columns")
    for what, names in (("physical", [f.physical_name for f in layout.columns]), ("logical", [f.name for f in layout.columns])):
        if twice := repeated(names):
            raise LayoutError(f"duplicate {what} column names: {twice}")
    end = 0
    for f in layout.fields:
        if f.dtype not in DTYPES:
            raise LayoutError(f"column {f.name!r}: unknown dtype {f.dtype!r}")
        if f.parse is not None and f.parse not in DATE_PARSERS:
            raise LayoutError(f"column {f.name!r}: unknown parse {f.parse!r}")
        if f.length <= 0 or f.start <= 0:
            raise LayoutError(f"column {f.name!r}: start and length must be positive")
        if f.start <= end:
            raise LayoutError(f"column {f.name!r} overlaps the column before it")
        if f.coerce_invalid_to_null and not f.nullable:
            raise LayoutError(f"column {f.name!r}: coerce_invalid_to_null needs a nullable column")
        end = f.end
    if layout.record_length < end:
        raise LayoutError(f"record_length {layout.record_length} is less than the last column's end {end}")
    fields = {f.name: f for f in layout.columns}
    computed = {c.name: c for c in layout.computed_columns}
    if clash := sorted(fields.keys() & computed.keys()) + repeated([c.name for c in layout.computed_columns]):
        raise LayoutError(f"computed column names clash: {clash}")
    for c in layout.computed_columns:
        _check_computed(c, fields)
    known = fields.keys() | computed.keys()
    if unknown := sorted(set(layout.dropped_columns) - known):
        raise LayoutError(f"drop names unknown columns: {unknown}")
    if not layout.outputs:
        raise LayoutError("drop leaves no column")
    routing = fields.get(layout.routing_column) or computed.get(layout.routing_column)
    if routing is None:
        raise LayoutError(f"routing_column {layout.routing_column!r} is no column of the layout")
    if routing.dtype != "Date":
        raise LayoutError(f"routing_column {layout.routing_column!r} must be a Date, is {routing.dtype}")
    if layout.routing_column in layout.dropped_columns:
        raise LayoutError(f"routing_column {layout.routing_column!r} must not be dropped")
    return layout


def _check_computed(c: Computed, fields: dict[str, Field]) -> None:
    if c.kind not in COMPUTED_KINDS:
        raise LayoutError(f"computed column {c.name!r}: unknown kind {c.kind!r}")
    if c.dtype != COMPUTED_KINDS[c.kind]:
        raise LayoutError(f"computed column {c.name!r}: {c.kind} gives {COMPUTED_KINDS[c.kind]}, not {c.dtype}")
    if missing := [s for s in c.sources if s not in fields]:
        raise LayoutError(f"computed column {c.name!r}: unknown sources {missing}")
    kinds = [fields[s].dtype for s in c.sources]
    if c.kind == "concat_to_date" and not (len(kinds) == 2 and kinds[0] == "Date" and kinds[1] in ("Int64", "Utf8")):
        raise LayoutError(f"computed column {c.name!r}: concat_to_date needs a Date and a day (Int64 or Utf8), got {kinds}")
    if c.kind == "concat_text" and (not kinds or set(kinds) != {"Utf8"}):
        raise LayoutError(f"computed column {c.name!r}: concat_text needs Utf8 sources, got {kinds}")


# YAML form: keys with default values are left out.


def _plain(value: Any, order: list[str], always: set[str], defaults: Any) -> dict[str, Any]:
    return {k: getattr(value, k) for k in order if k in always or getattr(value, k) != getattr(defaults, k)}


def to_dict(layout: Layout) -> dict[str, Any]:
    head: dict[str, Any] = {k: getattr(layout, k) for k in ("trade_type", "version", "effective_from", "effective_to", "record_length")}
    if layout.source:
        head["source"] = {k: v for k, v in vars(layout.source).items() if v is not None}
    head["routing_column"] = layout.routing_column
    order = ["physical_name", "logical_name", "start", "length", "dtype", "nullable", "parse", "description", "coerce_invalid_to_null"]
    blank = Field("", 0, 0, "")
    head["columns"] = [_plain(f, order, {"physical_name", "start", "length", "dtype", "nullable"}, blank) for f in layout.columns]
    made = Computed("", "", "", ())
    head["computed_columns"] = [_plain(replace(c, sources=list(c.sources)), ["name", "dtype", "kind", "sources", "nullable", "separator"], {"name", "dtype", "kind", "sources", "nullable"}, made) for c in layout.computed_columns]
    head["dropped_columns"] = list(layout.dropped_columns)
    head["derived"] = [{k: v} for k, v in layout.derived]
    head["partition_by"] = list(layout.partition_by)
    return {k: v for k, v in head.items() if v not in (None, [])}


def from_dict(data: Any) -> Layout:
    if not isinstance(data, dict):
        raise LayoutError("a layout file must hold a mapping")
    data = dict(data)
    try:
        data["columns"] = tuple(Field(**f) for f in data["columns"])
        data["computed_columns"] = tuple(Computed(**{**c, "sources": tuple(c["sources"])}) for c in data.get("computed_columns") or [])
        data["source"] = Source(**{k: str(v) for k, v in data["source"].items()}) if data.get("source") else None
        data["derived"] = tuple(pair for item in data.get("derived") or [] for pair in item.items())
        for key, default in (("partition_by", ["year", "month"]), ("dropped_columns", [])):
            data[key] = tuple(data.get(key) or default)
        for key in ("version", "effective_from", "effective_to"):
            data[key] = str(data[key]) if data.get(key) is not None else None
        layout = Layout(**data)
    except (KeyError, TypeError) as e:
        raise LayoutError(f"malformed layout: {e}") from e
    return check(layout)


def save(layout: Layout, path: Path) -> None:
    check(layout)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(yaml.safe_dump(to_dict(layout), sort_keys=False, allow_unicode=True), encoding="utf-8")


def load(path: Path) -> Layout:
    return from_dict(yaml.safe_load(path.read_text(encoding="utf-8")))


def load_all(folder: Path, trade_type: str) -> list[Layout]:
    """All versions of a trade type, oldest first; none if the folder is missing."""
    return sorted((load(p) for p in sorted((Path(folder) / trade_type).glob("v*.yaml"))), key=lambda x: x.effective_from)


def resolve(layouts: list[Layout], period: str) -> Layout:
    """The latest version whose window holds ``period``."""
    check_period(period)
    found = [x for x in layouts if x.applies(period)]
    if not found:
        raise LayoutError(f"no layout applies to period {period}")
    return max(found, key=lambda x: x.effective_from)
