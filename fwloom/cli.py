"""Command line: ``python -m fwloom.cli <command>``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from fwloom import __version__
from fwloom import layouts as L
from fwloom.config import ConfigError, load_config
from fwloom.operators import discovery
from fwloom.plans import compile as C
from fwloom.plans import cycle, ingest
from fwloom.sources.fwf_zip import read_lines


def session() -> SparkSession:
    return SparkSession.builder.appName("fwloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def do_ingest(a: argparse.Namespace) -> int:
    if unknown := set(a.type or []) - set(L.TRADE_TYPES):
        print(f"unknown trade type: {', '.join(sorted(unknown))}", file=sys.stderr)
        return 2
    options = ingest.IngestOptions(a.input, a.output, a.spec_dir, tuple(a.type or L.TRADE_TYPES), not a.all, a.current_year, a.year, a.month, a.chunk_rows, a.compression, a.encoding, a.max_quality_issues, a.max_skip_rate, a.fail_fast, a.skip_rule)
    try:
        summary = ingest.run(session(), options)
    except ingest.BadRow as e:
        print(e, file=sys.stderr)
        return 1
    print(f"run {summary.run_id}: {summary.ok_count} ok, {summary.failed_count} failed, {summary.total_rows} rows")
    for r in summary.results:
        print(f"  [{r['status'].upper()}] {r['trade_type']} {r['year']:04d}-{r['month']:02d} rows={r['rows_written']} -> {r['output_path']}" + (f"  error={r['error']}" if r["error"] else ""))
    return int(summary.failed_count > 0)


def do_import(a: argparse.Namespace) -> int:
    try:
        config = load_config(Path(a.config))
    except ConfigError as e:
        print(e, file=sys.stderr)
        return 2
    failed = 0
    for book in a.workbooks:
        try:
            for layout, changes in C.import_workbook(session(), Path(book), config, Path(a.out), a.force):
                print(f"{layout.trade_type} v{layout.version}: {len(layout.columns)} columns")
                for line in changes:
                    print(f"  {line}")
        except (L.LayoutError, ConfigError, OSError) as e:
            failed += 1
            print(f"{book}: {e}", file=sys.stderr)
    return int(failed > 0)


def counted(n: int, one: str) -> str:
    return f"{n} {one}" + "s" * (n != 1)


def do_validate(a: argparse.Namespace) -> int:
    kinds, number, problems = C.problems_of(session(), Path(a.spec_dir))
    for p in problems:
        print(p)
    print(f"FAIL: {counted(len(problems), 'problem')}" if problems else f"OK ({counted(kinds, 'trade type')}, {counted(number, 'spec')})")
    return int(bool(problems))


def do_inspect(a: argparse.Namespace) -> int:
    spark = session()
    catalog = {t: L.load_all(Path(a.spec_dir), t) for t in L.TRADE_TYPES}
    try:
        kind, period = a.type, a.period
        if kind is None or period is None:
            patterns = ingest.patterns_of(catalog)
            hit = discovery.first_match(discovery.match(spark.createDataFrame([(a.path,)], "path string"), patterns)).first() if patterns else None
            if hit is None:
                raise L.LayoutError(f"{a.path}: no layout matches the name; give --type and --period")
            kind, period = kind or hit["trade_type"], period or f"{hit['year']:04d}-{hit['month']:02d}"
        if kind not in L.TRADE_TYPES:
            raise L.LayoutError(f"unknown trade type {kind!r}")
        layout = L.resolve(catalog[kind], period)
    except L.LayoutError as e:
        print(e, file=sys.stderr)
        return 2
    print(f"{kind} {period}: v{layout.version} record_length={layout.record_length} columns={len(layout.columns)}")
    if a.rows <= 0:
        return 0
    rows = read_lines(spark, a.path, a.encoding, split_bytes=1 << 62, maxLines=a.rows).orderBy("line_no").limit(a.rows + 1).collect()
    for r in rows:
        if r["read_error"]:
            print(f"{a.path}: {r['read_error']}", file=sys.stderr)
            return 2
        print(f"--- line {r['line_no']} (length={len(r['raw_line'])}) ---")
        if a.raw:
            print(r["raw_line"])
            continue
        for f in layout.fields:
            name = f.physical_name if f.logical_name is None else f"{f.physical_name} -> {f.logical_name}"
            print(f"  {name:<32} {f.start:>4}-{f.end:<4} {f.dtype:<8} {r['raw_line'][f.start - 1 : f.end]!r}")
    return 0


def do_ops(a: argparse.Namespace) -> int:
    only = [(t, int(y)) for t, _, y in (x.partition("/") for x in a.only)] if a.only else None
    return cycle.run(session(), cycle.load_settings(Path(a.config)), only)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="fwloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("ingest", help="archives to partitioned Parquet")
    for flag, more in {"--input": {"required": True}, "--output": {"required": True}, "--spec-dir": {"default": "specs"}, "--type": {"action": "append"}, "--year": {"type": int}, "--month": {"type": int}, "--all": {"action": "store_true"}, "--ytd": {"action": "store_true"}, "--current-year": {"type": int}, "--chunk-rows": {"type": int, "default": 250_000}, "--compression": {"default": "zstd"}, "--encoding": {"default": "cp1252"}, "--max-quality-issues": {"type": int, "default": 10_000}, "--max-skip-rate": {"type": float, "default": 0.5}, "--fail-fast": {"action": "store_true"}, "--skip-rule": {"choices": ["batch", "every"], "default": "batch"}}.items():
        c.add_argument(flag, **more)
    c.set_defaults(do=do_ingest)
    c = sub.add_parser("import-spec", help="workbooks to layouts")
    c.add_argument("workbooks", nargs="+")
    c.add_argument("--config", default="project.yaml")
    c.add_argument("--out", default="specs")
    c.add_argument("--force", action="store_true")
    c.set_defaults(do=do_import)
    c = sub.add_parser("validate-specs", help="check the layouts")
    c.add_argument("--spec-dir", default="specs")
    c.set_defaults(do=do_validate)
    c = sub.add_parser("inspect", help="first lines of a file, field by field")
    c.add_argument("path")
    for flag, more in {"--spec-dir": {"default": "specs"}, "--type": {}, "--period": {}, "--rows": {"type": int, "default": 5}, "--raw": {"action": "store_true"}, "--encoding": {"default": "cp1252"}}.items():
        c.add_argument(flag, *(["-n"] if flag == "--rows" else []), **more)
    c.set_defaults(do=do_inspect)
    c = sub.add_parser("ops", help="periodic job")
    c.add_argument("run", choices=["run"])
    c.add_argument("--config", default="config.yaml")
    c.add_argument("--only", action="append")
    c.set_defaults(do=do_ops)
    sub.add_parser("version").set_defaults(do=lambda a: print(__version__) or 0)
    a = p.parse_args(argv)
    return a.do(a)


if __name__ == "__main__":
    sys.exit(main())
