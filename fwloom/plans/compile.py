"""Import of layout workbooks into the catalog, and checks of the catalog."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

from fwloom import layouts as L
from fwloom.config import ProjectConfig
from fwloom.operators import catalog
from fwloom.sources.workbook import compile_workbook

COMPARED = ["physical_name", "start", "length", "dtype", "nullable", "parse", "description", "coerce"]


def layout_path(folder: Path, layout: L.Layout) -> Path:
    return Path(folder) / layout.trade_type / f"v{layout.effective_from}.yaml"


def diff_lines(spark: SparkSession, old: L.Layout, new: L.Layout) -> list[str]:
    """Readable changes of parsed columns between two versions."""
    columns = lambda x: catalog.columns_of(spark, [x], dropped=True).where("NOT computed")
    rows = catalog.diff(columns(old), columns(new), "name", COMPARED).orderBy("change", "name").collect()
    marks = {"added": "+", "removed": "-", "changed": "~"}
    out = []
    for r in rows:
        what = f"{r['old_dtype']}/{r['old_length']} -> {r['new_dtype']}/{r['new_length']}" if r["change"] == "changed" else f"{r['new_dtype'] or r['old_dtype']}"
        out.append(f"{marks[r['change']]} {r['name']}: {what}")
    return out or ["no column changes"]


def import_workbook(spark: SparkSession, path: Path, config: ProjectConfig, folder: Path, force: bool = False) -> list[tuple[L.Layout, list[str]]]:
    """Writes the layouts of a workbook; each with its changes against the version before it."""
    made = compile_workbook(path, config.workbook(path))
    for layout in made.values():
        if layout_path(folder, layout).exists() and not force:
            raise L.LayoutError(f"{layout_path(folder, layout)} exists; use --force to replace it")
    out = []
    for layout in made.values():
        earlier = [x for x in L.load_all(folder, layout.trade_type) if x.effective_from < layout.effective_from]
        L.save(layout, layout_path(folder, layout))
        out.append((layout, diff_lines(spark, earlier[-1], layout) if earlier else []))
    return out


def problems_of(spark: SparkSession, folder: Path) -> tuple[int, int, list[str]]:
    """Trade types and layouts found, and all problems of the catalog."""
    kinds, number, problems = 0, 0, []
    for kind in L.TRADE_TYPES:
        good = []
        for path in sorted((Path(folder) / kind).glob("v*.yaml")):
            number += 1
            try:
                layout = L.load(path)
                good.append(layout)
                if path.stem != f"v{layout.effective_from}" or layout.trade_type != kind:
                    problems.append(f"{kind}: {path.name} holds {layout.trade_type} v{layout.effective_from}")
            except Exception as e:  # any unreadable file is a problem of the catalog
                problems.append(f"{kind}: {path.name}: {e}")
        if not good:
            continue
        kinds += 1
        versions = spark.createDataFrame([(x.trade_type, x.effective_from, x.effective_to) for x in good], "trade_type string, effective_from string, effective_to string")
        for r in catalog.window_problems(versions).orderBy("effective_from").collect():
            problems.append({"open": f"{kind}: the version before {r['effective_from']} has no effective_to", "overlap": f"{kind}: windows overlap at {r['effective_from']}", "gap": f"{kind}: gap between {r['previous']} and {r['effective_from']}"}[r["problem"]])
        try:
            catalog.union_columns(catalog.columns_of(spark, good))
        except L.LayoutError as e:
            problems.append(f"{kind}: {e}")
    if not number:
        problems.append(f"no layouts under {folder}")
    return kinds, number, problems
