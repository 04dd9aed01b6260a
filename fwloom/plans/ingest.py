"""The ingest job: a drop folder of archives becomes partitioned Parquet.

All files with the same trade type and layout version run as one Spark job. Files are judged first: their first lines
in passes of growing length (``PROBES``), which give up on hopeless files after a few thousand lines and are enough for short ones, then all
lines of the others. A pass is one projection; it keeps only problems, counts lines and coerced values by the way, and what
it finds is written to shared storage. Then the good rows of the files that passed are read again (the filter on files reaches the
source, which opens no other), dealt out by month, staged, counted, and switched in, all months or none.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fwloom import layouts as L
from fwloom import storage
from fwloom.operators import decode as D
from fwloom.operators import discovery, quality
from fwloom.plans import sinks
from fwloom.sources.fwf_zip import SPLIT_BYTES, files_at, read_lines, register

#: Lines that the probing passes read of each file.
PROBES = (4_096, 131_072)


@dataclass(frozen=True)
class IngestOptions:
    input_dir: str
    output_dir: str
    layouts_dir: str
    trade_types: tuple[str, ...] = L.TRADE_TYPES
    ytd: bool = True
    current_year: int | None = None
    year: int | None = None
    month: int | None = None
    batch_rows: int = 250_000
    compression: str = "zstd"
    encoding: str = "utf-8"
    max_quality_issues: int = 10_000
    max_skip_rate: float = 0.5
    fail_fast: bool = False
    #: ``batch``: the skip rate is judged at rows that do not parse, and on all problems after each ``batch_rows`` good rows; ``every``: at every problem.
    skip_rule: str = "batch"
    split_bytes: int = SPLIT_BYTES


RESULT = "run_id string, logged_at string, trade_type string, year int, month int, snapshot_month int, input_path string, spec_version string, rows_written long, rows_skipped long, rows_skipped_logged long, coerced_counts map<string,long>, duration_seconds double, output_path string, status string, error string"


class BadRow(ValueError):
    """The first bad row of a run that fails fast."""


@dataclass
class RunSummary:
    run_id: str
    results: list[dict] = field(default_factory=list)

    @property
    def total_rows(self) -> int:
        return sum(r["rows_written"] for r in self.results)

    @property
    def total_skipped(self) -> int:
        return sum(r["rows_skipped"] for r in self.results)

    @property
    def total_coerced(self) -> int:
        """Once for each file, however many partitions it has."""
        return sum(sum(c.values()) for c in {r["input_path"]: r["coerced_counts"] for r in self.results}.values())

    @property
    def ok_count(self) -> int:
        return sum(r["status"] == "ok" for r in self.results)

    @property
    def failed_count(self) -> int:
        return len(self.results) - self.ok_count


def patterns_of(catalog: dict[str, list[L.Layout]]) -> list[dict]:
    return [{"trade_type": x.trade_type, "label": f"{x.trade_type}/v{x.version}", "pattern": x.source.filename_pattern, "effective_from": x.effective_from, "effective_to": x.effective_to} for xs in catalog.values() for x in xs if x.source and x.source.filename_pattern]


def select_inputs(spark: SparkSession, options: IngestOptions, catalog: dict[str, list[L.Layout]]) -> DataFrame:
    """path, trade_type, label, year, month, flag of the files to read."""
    if unknown := set(options.trade_types) - set(L.TRADE_TYPES):
        raise discovery.DiscoveryError(f"unknown trade types {sorted(unknown)}")
    if not storage.is_folder(options.input_dir.removeprefix("file://")):
        raise discovery.DiscoveryError(f"{options.input_dir} is no folder")
    files = spark.createDataFrame([(p,) for p in files_at(options.input_dir)], "path string")
    # Versions that share a pattern are told apart by their windows; outside all of them the file is still known.
    every = patterns_of(catalog)
    open_ended = [{**p, "effective_from": "", "effective_to": None, "label": p["trade_type"]} for p in {(p["trade_type"], p["pattern"]): p for p in every}.values()]
    found = discovery.unambiguous(discovery.match(files, open_ended)).where(F.col("trade_type").isin(list(options.trade_types)))
    for name in ("year", "month"):
        if (value := getattr(options, name)) is not None:
            found = found.where(F.col(name) == value)
    found = discovery.prefer_flag(found)
    if options.ytd and options.year is None:
        found = discovery.year_to_date(found, options.current_year or datetime.now(UTC).year)
    return discovery.latest_snapshot(found)


def run(spark: SparkSession, options: IngestOptions, catalog: dict[str, list[L.Layout]] | None = None) -> RunSummary:
    """Ingests what ``options`` choose, by the layouts of ``catalog``, or of the folder of layouts."""
    register(spark)
    summary = RunSummary(datetime.now(UTC).strftime("%Y-%m-%dT%H-%M-%S-%fZ"))
    catalog = catalog or {t: L.load_all(Path(options.layouts_dir), t) for t in options.trade_types}
    chosen = sorted((r.asDict() for r in select_inputs(spark, options, catalog).collect()), key=lambda r: (r["trade_type"], r["year"]))
    groups: dict[tuple[str, str], list[dict]] = {}
    for f in chosen:
        try:
            layout = L.resolve(catalog[f["trade_type"]], f"{f['year']:04d}-{f['month']:02d}")
            groups.setdefault((f["trade_type"], layout.version), []).append(f)
        except L.LayoutError as e:
            summary.results.append(failure(summary.run_id, f, "", str(e)))
    for (kind, version), files in sorted(groups.items()):
        layout = next(x for x in catalog[kind] if x.version == version)
        summary.results += ingest_files(spark, options, layout, files, summary.run_id)
    for kind in sorted({r["trade_type"] for r in summary.results}):
        rows = [tuple(r[c.split()[0]] for c in RESULT.split(", ")) for r in summary.results if r["trade_type"] == kind]
        sinks.append_json(spark.createDataFrame(rows, RESULT).coalesce(1), f"{options.output_dir}/_manifests/{kind}/{summary.run_id}")
    for kind in options.trade_types:
        sinks.write_schema(spark, catalog[kind], f"{options.output_dir}/{kind}", kind)
    return summary


def result(run_id: str, f: dict, version: str, **more) -> dict:
    base = {"run_id": run_id, "logged_at": datetime.now(UTC).isoformat(timespec="seconds"), "trade_type": f["trade_type"], "year": f["year"], "month": f["month"], "snapshot_month": f["month"], "input_path": f["path"], "spec_version": version}
    return base | {"rows_written": 0, "rows_skipped": 0, "rows_skipped_logged": 0, "coerced_counts": {}, "duration_seconds": 0.0, "output_path": "", "status": "ok", "error": None} | more


def failure(run_id: str, f: dict, version: str, error: str, **more) -> dict:
    return result(run_id, f, version, status="failed", error=error, **more)


@dataclass
class Judgement:
    """What the passes over the files of a layout found."""

    issues: DataFrame  # of every file from the pass that settled it
    failed: DataFrame  # input_path, abort_line, reason
    lines: dict[str, int] = field(default_factory=dict)  # read in the pass that settled a file
    read: dict[str, int] = field(default_factory=dict)  # read in all passes
    coerced: dict[str, dict[str, int]] = field(default_factory=dict)


def decoded_files(spark: SparkSession, options: IngestOptions, layout: L.Layout, files: list[dict], plan: str | None, lines: int = 0, only: list[str] | None = None) -> DataFrame:
    """Decoded lines with ``file_year`` and ``file_month``; the first ``lines`` of each file, or all; ``only`` some files."""
    more = {"maxLines": lines, "split_bytes": 1 << 62} if lines else {"split_bytes": options.split_bytes, "plan": plan}
    found = read_lines(spark, "\n".join(f["path"] for f in files), options.encoding, batchRows=min(options.batch_rows, 50_000), **more)
    if only is not None:
        found = found.where(F.col("input_path").isin(only))
    info = spark.createDataFrame([(f["path"], f["year"], f["month"]) for f in files], "input_path string, file_year int, file_month int")
    # The file list has a row for each archive of this run: far below any broadcast limit, which Spark checks.
    return D.decode(found, layout).join(info, "input_path")


def judge(spark: SparkSession, options: IngestOptions, layout: L.Layout, files: list[dict], folder: str) -> Judgement:
    """Reads the files of a layout pass by pass, each pass those that are not settled yet."""
    coercing = [f.name for f in layout.columns if f.coerce_invalid_to_null]
    open_, out = files, None
    for n, limit in enumerate([*(() if options.fail_fast else PROBES), 0]):
        decoded = decoded_files(spark, options, layout, open_, f"{folder}/splits{n}", limit)
        # A count for each file and coerced column: files of a layout are a few, one for each year.
        counts = [F.max(F.when(F.col("input_path") == f["path"], F.col("line_no"))).alias(f"lines{i}") for i, f in enumerate(open_)]
        counts += [F.count_if((F.col("input_path") == f["path"]) & F.array_contains("coerced", c)).alias(f"coerced{i}_{j}") for i, f in enumerate(open_) for j, c in enumerate(coercing)]
        seen = Observation()
        found = quality.issues(decoded.observe(seen, *counts), layout.routing_column, F.col("file_year"), F.col("file_month"))
        found = storage.written(found, f"{folder}/issues{n}")
        if options.fail_fast and (bad := found.orderBy("input_path", "line_no").select("input_path", "line_no", "column", "message").head()):
            raise BadRow(f"{bad['input_path']} line {bad['line_no']}, column {bad['column']}: {bad['message']}")
        lines = {f["path"]: seen.get[f"lines{i}"] or 0 for i, f in enumerate(open_)}
        whole = {p: not limit or k < limit for p, k in lines.items()}
        totals = spark.createDataFrame([(p, k, whole[p]) for p, k in lines.items()], "input_path string, lines long, whole boolean")
        failed = storage.written(quality.verdicts(found, options.max_skip_rate, options.max_quality_issues, options.batch_rows if options.skip_rule == "batch" else 0, totals), f"{folder}/failed{n}")
        settled = {r["input_path"] for r in failed.select("input_path").collect()} | {p for p in lines if whole[p]}
        found, failed = (x.where(F.col("input_path").isin(sorted(settled))) for x in (found, failed))
        if out is None:
            out = Judgement(found, failed)
        else:
            out.issues, out.failed = out.issues.unionByName(found), out.failed.unionByName(failed)
        for i, f in enumerate(open_):
            path = f["path"]
            out.read[path] = out.read.get(path, 0) + lines[path]
            if path in settled:
                out.lines[path] = lines[path]
                out.coerced[path] = {c: k for j, c in enumerate(coercing) if (k := seen.get[f"coerced{i}_{j}"])}
        open_ = [f for f in open_ if f["path"] not in settled]
        if not open_:
            return out
    return out


def ingest_files(spark: SparkSession, options: IngestOptions, layout: L.Layout, files: list[dict], run_id: str) -> list[dict]:
    """Decodes, judges and writes the files of one layout; at most one for each year."""
    began, kind = time.time(), layout.trade_type
    target, staged = f"{options.output_dir}/{kind}", f"{run_id}-{layout.version}"
    counts: dict[tuple[int, int], int] = {}
    with storage.scratch(spark) as folder:
        judged = judge(spark, options, layout, files, folder)
        info = spark.createDataFrame([(f["path"], f["year"], f["month"]) for f in files], "input_path string, file_year int, file_month int")
        log = quality.logged(judged.issues, judged.failed, options.max_quality_issues).join(info, "input_path")
        log = log.select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("trade_type"), F.col("file_year").alias("year"), F.col("file_month").alias("month"), "input_path", "line_no", "column", F.col("message").alias("error"), "raw_line")
        log = storage.written(log, f"{folder}/log")
        # At most a row for each file.
        skipped = {r["input_path"]: r["n"] for r in quality.until_abort(judged.issues, judged.failed).groupBy("input_path").agg(F.count("*").alias("n")).collect()}
        logged = {r["input_path"]: r["n"] for r in log.groupBy("input_path").agg(F.count("*").alias("n")).collect()}
        reasons = {r["input_path"]: (r["abort_line"], r["reason"]) for r in judged.failed.collect()}
        if logged:
            sinks.append_json(log, f"{options.output_dir}/_quality_issues/{kind}/{run_id}")
        keep = [f["path"] for f in files if f["path"] not in reasons]
        if keep:
            sinks.recover(spark, target)
            decoded = decoded_files(spark, options, layout, files, f"{folder}/splits", only=keep)
            rejected = quality.routing_reject(F.col("row")[layout.routing_column], F.col("file_year"), F.col("file_month"), layout.routing_column)
            good = D.select_decoded(decoded, F.col("structural").isNull() & F.col("error").isNull() & rejected.isNull())
            rows = sinks.stage_partitions(good.select("row.*", F.col("line_no").alias("__line")), layout.routing_column, target, staged, options.compression, "__line")
            if rows is not None:
                counts = {(r["year"], r["month"]): r["rows"] for r in sinks.partition_counts(rows).collect()}
                sinks.switch(spark, target, staged)
            else:
                storage.Folders(spark).delete(f"{target}/{sinks.STAGING}")
    out, seconds = [], time.time() - began
    for f in files:
        path = f["path"]
        own = {"rows_skipped": skipped.get(path, 0), "rows_skipped_logged": logged.get(path, 0), "coerced_counts": judged.coerced.get(path, {}), "duration_seconds": seconds}
        if path in reasons:
            line, reason = reasons[path]
            out.append(failure(run_id, f, layout.version, f"{path.rsplit('/', 1)[-1]} line {line}: {reason}", **own))
            continue
        months = sorted((m, n) for (y, m), n in counts.items() if y == f["year"])
        out += [result(run_id, {**f, "month": m}, layout.version, rows_written=n, snapshot_month=f["month"], output_path=f"{target}/year={f['year']:04d}/month={m:02d}", **own) for m, n in months]
        if not months:
            out.append(result(run_id, f, layout.version, **own))
    return out
