"""The periodic job: import changed workbooks, then ingest the years whose files, layouts or outputs changed.

Dirty checks are joins of file listings with manifest tables (``operators.planning``); files are hashed by
tasks. All folders lie on shared storage, so nothing is copied to and from a worker's disk; ``mirror`` is the
one file copy, from an upstream drop, with a replaceable copy function.
"""

from __future__ import annotations

import fnmatch
import hashlib
import logging
import os
import shutil
import time
from collections.abc import Callable
from dataclasses import dataclass, fields
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom import storage
from fwloom.config import load_config
from fwloom.operators import discovery, planning
from fwloom.plans import compile as C
from fwloom.plans import ingest
from fwloom.sources.fwf_zip import files_at, infos_at

log = logging.getLogger(__name__)
ENV = "FWLOOM_"
RAW_MANIFEST = "name string, raw_hash string, config_hash string, processed_at long, trade_type string, year int, month int"
BOOK_MANIFEST = "name string, workbook_hash string, config_hash string, processed_at long"


class SettingsError(ValueError):
    """Settings without a required value."""


@dataclass(frozen=True)
class Settings:
    project_yaml: str
    workbooks_dir: str
    raw_dir: str
    layouts_dir: str
    processed_dir: str
    manifests_dir: str
    upstream_raw_dir: str | None = None
    encoding: str = "utf-8"
    log_file: str | None = None


def load_settings(path: Path) -> Settings:
    """From YAML; an environment variable of the field's name in capitals, with prefix ``FWLOOM_``, wins."""
    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    values = {f.name: os.environ.get(ENV + f.name.upper(), data.get(f.name)) for f in fields(Settings)}
    given = {k: str(v) for k, v in values.items() if v is not None}
    required = ("project_yaml", "workbooks_dir", "raw_dir", "layouts_dir", "processed_dir", "manifests_dir")
    if missing := [n for n in required if n not in given]:
        raise SettingsError(f"{path}: missing {', '.join(missing)}")
    return Settings(**given)


def mirror(source: str, target: str, patterns: tuple[str, ...] = ("*",), copy_file: Callable[[Path, Path], object] = shutil.copy2) -> int:
    """Copies files that are missing, of another size, or older (in whole seconds) in the target."""
    done = 0
    for path in sorted(p for p in Path(source).rglob("*") if p.is_file() and any(fnmatch.fnmatch(p.name, x) for x in patterns)):
        to = Path(target) / path.relative_to(source)
        have, want = (to.stat() if to.exists() else None), path.stat()
        if have and have.st_size == want.st_size and int(have.st_mtime) >= int(want.st_mtime):
            continue
        to.parent.mkdir(parents=True, exist_ok=True)
        copy_file(path, to)
        done += 1
    return done


def manifest(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """The last entry for each name of an append-only JSON table."""
    path = f"{folder}/{name}"
    if not storage.is_folder(path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).json(path)
    others = [c for c in rows.columns if c != "name"]
    return rows.groupBy("name").agg(F.max_by(F.struct(*others), "processed_at").alias("x")).select("name", "x.*")


def append(spark: SparkSession, folder: str, name: str, rows: list[tuple], schema: str) -> None:
    if rows:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{folder}/{name}")


def config_hash(settings: Settings) -> str:
    return hashlib.sha256(Path(settings.project_yaml).read_bytes()).hexdigest()


def raw_files(spark: SparkSession, settings: Settings) -> DataFrame:
    """path, name, trade_type, year, month, flag, mtime, size, sha256, output_present of every file the project knows."""
    config = load_config(Path(settings.project_yaml))
    listed = [(p, f.mtime_ns // 10**9, f.size) for p, f in infos_at(settings.raw_dir) if f.is_file]
    files = spark.createDataFrame([(p,) for p, *_ in listed], "path string")
    found = discovery.first_match(discovery.match(files, config.patterns())).select("path", "trade_type", "year", "month", "flag")
    folders, done = storage.Folders(spark), settings.processed_dir
    years = [(t, int(y.removeprefix("year="))) for t in folders.names(done) if not t.startswith("_") for y in folders.names(f"{done}/{t}") if y.startswith("year=") and folders.names(f"{done}/{t}/{y}")]
    present = spark.createDataFrame(years, "trade_type string, year int").withColumn("present", F.lit(True))
    ages = spark.createDataFrame(listed, "path string, mtime long, size long")
    out = found.join(ages, "path").join(present, ["trade_type", "year"], "left").withColumn("output_present", F.coalesce("present", F.lit(False))).drop("present")
    return planning.with_hashes(out.withColumn("name", F.element_at(F.split("path", "/"), -1)))


def stage_layouts(spark: SparkSession, settings: Settings) -> int:
    """Imports dirty workbooks, each on its own; the number that failed."""
    config, digest, failed = load_config(Path(settings.project_yaml)), config_hash(settings), 0
    paths = {p.rsplit("/", 1)[-1]: p for p in files_at(settings.workbooks_dir) if p.endswith((".xls", ".xlsx"))}
    for name in sorted(paths.keys() - config.workbooks.keys()):
        log.warning("workbook %s is not configured", name)
    known = sorted(paths.keys() & config.workbooks.keys())
    outputs = {n: all((Path(settings.layouts_dir) / p["trade_type"] / f"v{config.workbooks[n].effective_from}.yaml").exists() for p in type(config)({n: config.workbooks[n]}).patterns()) for n in known}
    books = spark.createDataFrame([(n, paths[n], outputs[n]) for n in known], "name string, path string, outputs_present boolean")
    dirty = planning.dirty_workbooks(planning.with_hashes(books), manifest(spark, settings.manifests_dir, "workbooks", BOOK_MANIFEST), digest)
    for r in dirty.orderBy("name").collect():
        try:
            C.import_workbook(spark, Path(r["path"]), config, Path(settings.layouts_dir), force=True)
            append(spark, settings.manifests_dir, "workbooks", [(r["name"], r["sha256"], digest, int(time.time()))], BOOK_MANIFEST)
        except Exception:  # one bad workbook does not stop the others
            log.exception("import of %s failed", r["name"])
            failed += 1
    return failed


def stage_years(spark: SparkSession, settings: Settings, only: list[tuple[str, int]] | None = None) -> int:
    """Ingests dirty years in order and stops at the first failure; 1 if there was one."""
    digest = config_hash(settings)
    with storage.scratch(spark) as folder:
        files = storage.written(raw_files(spark, settings), folder)
        dirty = planning.dirty_files(files, manifest(spark, settings.manifests_dir, "raw", RAW_MANIFEST), digest).select("trade_type", "year").distinct()
        if only is not None:
            dirty, clean = planning.restrict(dirty, spark.createDataFrame(only, "trade_type string, year int"))
            for r in clean.collect():
                log.warning("%s/%s was asked for and is clean", r["trade_type"], r["year"])
        for key in dirty.orderBy("trade_type", "year").collect():
            options = ingest.IngestOptions(settings.raw_dir, settings.processed_dir, settings.layouts_dir, (key["trade_type"],), year=key["year"], encoding=settings.encoding)
            began = int(time.time())
            of_year = files.where((F.col("trade_type") == key["trade_type"]) & (F.col("year") == key["year"]))
            log.info("%s/%s: %s", key["trade_type"], key["year"], planning.volume(of_year).first().asDict())
            summary = ingest.run(spark, options)
            if summary.failed_count or not summary.results:
                log.error("%s/%s failed: %s", key["trade_type"], key["year"], [r["error"] for r in summary.results if r["error"]])
                return 1
            append(spark, settings.manifests_dir, "raw", [(r["name"], r["sha256"], digest, began, r["trade_type"], r["year"], r["month"]) for r in of_year.collect()], RAW_MANIFEST)
    return 0


def run(spark: SparkSession, settings: Settings, only: list[tuple[str, int]] | None = None, copy_file: Callable[[Path, Path], object] = shutil.copy2) -> int:
    """0 if all went well, else 1."""
    handler = logging.FileHandler(settings.log_file) if settings.log_file else logging.NullHandler()
    logging.getLogger("fwloom").addHandler(handler)
    try:
        if settings.upstream_raw_dir:
            mirror(settings.upstream_raw_dir, settings.raw_dir, ("*.zip",), copy_file)
        failed = stage_layouts(spark, settings)
        return int(bool(failed + stage_years(spark, settings, only)))
    finally:
        logging.getLogger("fwloom").removeHandler(handler)
        handler.close()
