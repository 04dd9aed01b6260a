"""File discovery as relational steps: match names, prefer flags, pick snapshots, find the layout version."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Order of preference among files of one month: no flag, N, C, anything else.
FLAG_RANK = "CASE WHEN flag IS NULL THEN 0 WHEN flag = 'N' THEN 1 WHEN flag = 'C' THEN 2 ELSE 3 END"


class DiscoveryError(ValueError):
    """A file name that cannot be told apart."""


def match(files: DataFrame, patterns: list[dict]) -> DataFrame:
    """``files`` (path) matched against patterns, Python regular expressions with groups year, month and flag.

    A pattern is a dict with trade_type, label, pattern, effective_from, effective_to and order. The result
    has a row for each hit whose window holds the file's period. The list of patterns is the configuration,
    so it goes to the tasks with the function; file names are split over tasks.
    """
    schema = "path string, trade_type string, label string, year int, month int, flag string, hits int, nth int"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = [(re.compile(p["pattern"]), p) for p in patterns]
        for frame in frames:
            rows = []
            for path in frame["path"]:
                name, hits = path.rsplit("/", 1)[-1], []
                for pattern, p in ready:
                    m = pattern.match(name)
                    if not m:
                        continue
                    year, month = m["year"], m["month"]
                    period = f"{year}-{month}"
                    if p["effective_from"] <= period and (p["effective_to"] is None or period <= p["effective_to"]):
                        hits.append((path, p["trade_type"], p["label"], int(year), int(month), m.groupdict().get("flag")))
                rows += [(*h, len(hits), n) for n, h in enumerate(hits)]
            yield pd.DataFrame(rows, columns=["path", "trade_type", "label", "year", "month", "flag", "hits", "nth"]).astype({"year": "int32", "month": "int32", "hits": "int32", "nth": "int32"})

    return files.select("path").mapInPandas(run, schema)


def unambiguous(matched: DataFrame) -> DataFrame:
    """The only hit of each file; several hits or an impossible month are errors that name the file."""
    bad = matched.where("hits > 1 OR month NOT BETWEEN 1 AND 12").groupBy("path").agg(F.sort_array(F.collect_list("label")).alias("labels"), F.first("month").alias("month")).orderBy("path").first()
    if bad and not 1 <= bad["month"] <= 12:
        raise DiscoveryError(f"{bad['path']}: month {bad['month']} is out of range")
    if bad:
        raise DiscoveryError(f"{bad['path']} matches several layouts: {', '.join(bad['labels'])}")
    return matched.drop("hits", "nth")


def first_match(matched: DataFrame) -> DataFrame:
    """The first hit of each file in the order of the patterns."""
    return matched.where("nth = 0").drop("hits", "nth")


def prefer_flag(found: DataFrame) -> DataFrame:
    """One file for each trade type and month."""
    order = Window.partitionBy("trade_type", "year", "month").orderBy(F.expr(FLAG_RANK), "path")
    return found.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def year_to_date(found: DataFrame, current_year: int) -> DataFrame:
    return found.where(F.col("year") == current_year)


def latest_snapshot(found: DataFrame) -> DataFrame:
    """The file of the last month for each trade type and year; snapshots are cumulative."""
    order = Window.partitionBy("trade_type", "year").orderBy(F.desc("month"))
    return found.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def resolve(found: DataFrame, versions: DataFrame) -> DataFrame:
    """Interval join: each row of ``found`` (trade_type, period, ...) with the latest version whose window holds it.

    ``versions``: trade_type, version, effective_from, effective_to. ``version`` is null where none applies.
    """
    v = versions.select(F.col("trade_type").alias("v_type"), "version", "effective_from", "effective_to")
    # Periods are few; rows of ``found`` meet their version by period, so equal rows stay apart.
    periods = found.select(F.col("trade_type").alias("p_type"), F.col("period").alias("p_period")).distinct()
    inside = (F.col("p_type") == F.col("v_type")) & (F.col("p_period") >= F.col("effective_from")) & (F.col("effective_to").isNull() | (F.col("p_period") <= F.col("effective_to")))
    chosen = periods.join(v, inside, "left").groupBy("p_type", "p_period").agg(F.max_by("version", "effective_from").alias("version"))
    same = F.col("trade_type").eqNullSafe(F.col("p_type")) & F.col("period").eqNullSafe(F.col("p_period"))
    return found.join(chosen, same, "left").select(*found.columns, "version")
