"""Project configuration: which workbook describes which files, and what to change in its columns."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from fwloom.layouts import COMPUTED_KINDS, DATE_PARSERS, DTYPES, TRADE_TYPES, Computed, LayoutError, check_pattern, check_window, repeated


class ConfigError(ValueError):
    """A configuration that cannot be used."""


@dataclass(frozen=True)
class SheetConfig:
    filename_pattern: str
    routing_column: str = "period"
    trade_type: str | None = None
    rename: dict[str, str] = field(default_factory=dict)
    cast: dict[str, str] = field(default_factory=dict)
    parse: dict[str, str] = field(default_factory=dict)
    computed: tuple[Computed, ...] = ()
    drop: tuple[str, ...] = ()
    coerce_invalid_to_null: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        def need(ok: bool, message: str) -> None:
            if not ok:
                raise ConfigError(message)

        try:
            check_pattern(self.filename_pattern)
        except LayoutError as e:
            raise ConfigError(str(e)) from e
        need(self.trade_type is None or self.trade_type in TRADE_TYPES, f"unknown trade_type {self.trade_type!r}")
        for what, names in (("rename targets", [*self.rename.values()]), ("computed names", [c.name for c in self.computed]), ("drop", [*self.drop]), ("coerce_invalid_to_null", [*self.coerce_invalid_to_null])):
            need(not repeated(names), f"duplicate {what}: {repeated(names)}")
        for what, values, known in (("cast", self.cast.values(), DTYPES), ("parse", self.parse.values(), DATE_PARSERS), ("computed kind", [c.kind for c in self.computed], COMPUTED_KINDS), ("computed dtype", [c.dtype for c in self.computed], DTYPES)):
            for value in values:
                need(value in known, f"{what}: {value!r} is none of {list(known)}")


@dataclass(frozen=True)
class WorkbookConfig:
    effective_from: str
    sheets: dict[str, SheetConfig]
    effective_to: str | None = None
    workbook_id: str | None = None

    def __post_init__(self) -> None:
        try:
            check_window(self.effective_from, self.effective_to)
        except LayoutError as e:
            raise ConfigError(str(e)) from e
        if not self.sheets:
            raise ConfigError("missing or empty 'sheets'")


@dataclass(frozen=True)
class ProjectConfig:
    workbooks: dict[str, WorkbookConfig]

    def workbook(self, path: Path) -> WorkbookConfig:
        if path.name not in self.workbooks:
            raise ConfigError(f"workbook {path.name!r} is not configured; known: {sorted(self.workbooks)}")
        return self.workbooks[path.name]

    def patterns(self) -> list[dict]:
        """Patterns for ``operators.discovery.match`` in order of configuration; positional trade types are filled in."""
        out = []
        for name, book in self.workbooks.items():
            for n, (sheet, cfg) in enumerate(book.sheets.items()):
                kind = cfg.trade_type or (TRADE_TYPES[n] if n < len(TRADE_TYPES) else None)
                if kind:
                    out.append({"trade_type": kind, "label": f"{book.workbook_id or name}/{sheet}", "pattern": cfg.filename_pattern, "effective_from": book.effective_from, "effective_to": book.effective_to})
        return out


def _typed(data: dict, key: str, kind: type, where: str) -> Any:
    value = data.get(key) or kind()
    if not isinstance(value, kind):
        raise ConfigError(f"{where}: {key!r} must be a {'mapping' if kind is dict else 'list'}")
    return value


def _sheet(data: Any, where: str) -> SheetConfig:
    if not isinstance(data, dict):
        raise ConfigError(f"{where} must be a mapping")
    if "filename_pattern" not in data:
        raise ConfigError(f"{where}: missing 'filename_pattern'")
    computed = []
    for name, c in _typed(data, "computed", dict, where).items():
        if not isinstance(c, dict) or not {"kind", "sources"} <= c.keys() or not isinstance(c["sources"], list):
            raise ConfigError(f"{where}: computed column {name!r} needs a kind and a list of sources")
        computed.append(Computed(str(name), c.get("dtype") or COMPUTED_KINDS.get(c["kind"], ""), c["kind"], tuple(map(str, c["sources"])), bool(c.get("nullable", True)), str(c.get("separator", " "))))
    maps = {k: {str(a): str(b) for a, b in _typed(data, k, dict, where).items()} for k in ("rename", "cast", "parse")}
    lists = {k: tuple(map(str, _typed(data, k, list, where))) for k in ("drop", "coerce_invalid_to_null")}
    try:
        return SheetConfig(str(data["filename_pattern"]), str(data.get("routing_column") or "period"), data.get("trade_type"), computed=tuple(computed), **maps, **lists)
    except ConfigError as e:
        raise ConfigError(f"{where}: {e}") from e


def load_config(path: Path) -> ProjectConfig:
    try:
        data = yaml.safe_load(path.read_text(encoding="utf-8"))
    except (OSError, yaml.YAMLError) as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    books = data.get("workbooks") if isinstance(data, dict) else None
    if not isinstance(books, dict) or not books:
        raise ConfigError(f"{path}: needs a mapping 'workbooks'")
    out = {}
    for name, book in books.items():
        if not isinstance(book, dict) or "effective_from" not in book:
            raise ConfigError(f"workbook {name!r}: missing 'effective_from'")
        sheets = {str(s): _sheet(d, f"workbook {name!r} sheet {s!r}") for s, d in _typed(book, "sheets", dict, f"workbook {name!r}").items()}
        optional = {k: str(book[k]) if book.get(k) else None for k in ("effective_to", "workbook_id")}
        try:
            out[str(name)] = WorkbookConfig(str(book["effective_from"]), sheets, **optional)
        except ConfigError as e:
            raise ConfigError(f"workbook {name!r}: {e}") from e
    return ProjectConfig(out)
