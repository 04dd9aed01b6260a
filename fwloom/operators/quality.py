"""Quality issues, verdicts of files, and routing of rows to months.

A file fails at the first of: a record of wrong length, a read error, a running share of bad rows above
``max_skip_rate``, or issue number ``max_issues + 1``. All three need only the bad rows of a file, never the
good ones: the running share at a bad row is its number among bad rows over its line number. With a cap no
more than ``max_issues + 1`` rows of a file matter, which Spark's group limit drops before the shuffle.

The share can be judged at every problem, or, with ``batch_rows``, by two rules: at every row that does not parse on such rows
alone, and on all problems, rows of other months too, at the end of each batch of ``batch_rows`` rows that parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fwloom.operators.decode import select_decoded


def routing_reject(routing: Column, year: Column, month: Column, name: str) -> Column:
    """Message for rows that belong to no month of a year-to-date snapshot; null for rows that do."""
    inside = (F.year(routing) == year) & (F.month(routing) <= month)
    window = F.concat(F.lit("row period "), F.date_format(routing, "yyyy-MM"), F.lit(" is outside the snapshot window ("), F.format_string("%04d-01..%04d-%02d", year, year, month), F.lit(")"))
    return F.when(routing.isNull(), F.lit(f"{name} is null; row cannot be routed to a partition")).when(~inside, window)


def issues(decoded: DataFrame, routing: str, year: Column, month: Column) -> DataFrame:
    """One row for each problem: input_path, line_no, column, message, raw_line, structural."""
    reject = F.when(F.col("structural").isNull() & F.col("error").isNull(), routing_reject(F.col("row")[routing], year, month, routing))
    message = F.coalesce("structural", F.col("error")["message"], reject)
    column = F.when(F.col("structural").isNotNull(), F.lit(None).cast("string")).otherwise(F.coalesce(F.col("error")["column"], F.lit(routing)))
    found = decoded.select("input_path", "line_no", column.alias("column"), message.alias("message"), "raw_line", F.col("structural").isNotNull().alias("structural"), F.col("error").isNotNull().alias("row_error"), "task")
    return select_decoded(found, F.col("message").isNotNull()).drop("task")


def verdicts(found: DataFrame, max_skip_rate: float = 1.0, max_issues: int = 0, batch_rows: int = 0, totals: DataFrame | None = None) -> DataFrame:
    """input_path, abort_line, reason of the files that fail; the smallest line decides.

    ``batch_rows`` needs ``totals``: input_path, lines and ``whole``, false if only the first lines were read; every file has a row.
    """
    by_line = Window.partitionBy("input_path").orderBy("line_no")
    structural = found.where("structural").groupBy("input_path").agg(F.min("line_no").alias("line"), F.min_by("message", "line_no").alias("reason"))
    aborts = structural
    rows = found.where("NOT structural").withColumn("n", F.row_number().over(by_line))
    if max_issues > 0:
        rows = rows.where(F.col("n") <= max_issues + 1)
        over = rows.where(F.col("n") == max_issues + 1)
        aborts = aborts.unionByName(over.select("input_path", F.col("line_no").alias("line"), F.lit(f"more than {max_issues} quality issues").alias("reason")))
    if max_skip_rate < 1:
        reason = F.lit(f"skip rate above {max_skip_rate}").alias("reason")
        judged = rows
        if batch_rows:
            judged = rows.where("row_error").withColumn("n", F.row_number().over(by_line))
            aborts = aborts.unionByName(batches(rows, batch_rows, totals).where(F.col("problems") / F.col("line") > max_skip_rate).select("input_path", "line", reason))
        over = judged.where(F.col("n") / F.col("line_no") > max_skip_rate).groupBy("input_path").agg(F.min("line_no").alias("line"))
        aborts = aborts.unionByName(over.select("input_path", "line", reason))
    return aborts.groupBy("input_path").agg(F.min("line").alias("abort_line"), F.min_by("reason", "line").alias("reason"))


def batches(rows: DataFrame, batch_rows: int, totals: DataFrame) -> DataFrame:
    """input_path, batch, line, problems: problems up to the last line of every batch that has any.

    A batch holds ``batch_rows`` rows that parse; the last holds what is left, none if nothing is. Of the rows that parse only those of other
    months are looked at: before line l stand l - e of them, e being the rows up to it that do not parse. Batches without problems only lower the
    share, so they need no judgement.
    """
    upto = Window.partitionBy("input_path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    errors = F.sum(F.col("row_error").cast("long")).over(upto)
    parsed = F.col("line_no") - errors - F.when(F.col("row_error"), 0).otherwise(1)  # rows that parse, before this one
    counted = rows.withColumn("batch", F.floor(parsed / batch_rows)).groupBy("input_path", "batch").agg(F.count("*").alias("n"), F.count_if("row_error").alias("errors"))
    upto = Window.partitionBy("input_path").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.select("input_path", "batch", F.sum("n").over(upto).alias("problems"), F.sum("errors").over(upto).alias("errors"))
    every = rows.groupBy("input_path").agg(F.count_if("row_error").alias("all_errors"))
    known = summed.join(every, "input_path").join(totals, "input_path")
    end = (F.col("batch") + 1) * batch_rows + F.col("errors")
    # What parses after the batch's start: without it there is no such batch.
    there = F.col("lines") - F.col("all_errors") > F.col("batch") * batch_rows
    return known.where(there & (F.col("whole") | (end <= F.col("lines")))).select("input_path", "batch", F.least(end, "lines").alias("line"), "problems")


def until_abort(found: DataFrame, failed: DataFrame) -> DataFrame:
    """Problems of rows, up to the line at which a file failed."""
    rows = found.where("NOT structural").join(failed.select("input_path", "abort_line"), "input_path", "left")
    return rows.where(F.col("abort_line").isNull() | (F.col("line_no") <= F.col("abort_line")))


def logged(found: DataFrame, failed: DataFrame, max_issues: int = 0) -> DataFrame:
    """Issues that the quality log keeps: up to the line at which a file failed, at most ``max_issues`` a file."""
    rows = until_abort(found, failed)
    if max_issues > 0:
        by_line = Window.partitionBy("input_path").orderBy("line_no")
        rows = rows.withColumn("n", F.row_number().over(by_line)).where(F.col("n") <= max_issues).drop("n")
    return rows.select("input_path", "line_no", "column", "message", "raw_line")


def coerced_counts(decoded: DataFrame) -> DataFrame:
    """input_path, column, n: bad values that became null."""
    found = select_decoded(decoded.select("input_path", "coerced", "task"), F.size("coerced") > 0)
    return found.select("input_path", F.explode("coerced").alias("column")).groupBy("input_path", "column").agg(F.count("*").alias("n"))


def total_coerced(results: DataFrame) -> DataFrame:
    """Sum over files of a number that every partition of a file repeats."""
    return results.groupBy("input_path").agg(F.max("coerced").alias("coerced")).agg(F.sum("coerced").alias("total_coerced"))


def run_totals(results: DataFrame) -> DataFrame:
    """Totals of a run from its results: a row for each partition, with what concerns the whole file repeated in each.

    ``results``: input_path, status, rows_written, rows_skipped, coerced_counts. One row: partitions by outcome, rows
    written, rows skipped as the rows of a manifest add up, and bad values that became null, once for each file.
    """
    coerced = F.coalesce(F.aggregate(F.map_values("coerced_counts"), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    files = results.groupBy("input_path").agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("failed"), F.sum("rows_written").alias("rows"), F.sum("rows_skipped").alias("skipped"), F.max(coerced).alias("coerced"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return files.agg(total("ok").alias("ok_count"), total("failed").alias("failed_count"), total("rows").alias("total_rows"), total("skipped").alias("total_skipped"), total("coerced").alias("total_coerced"))
