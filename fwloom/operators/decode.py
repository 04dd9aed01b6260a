"""Decoding of lines by a layout: slices, typed values, first error of a row, structural errors of a file.

Input: any DataFrame with ``input_path``, ``line_no`` and ``raw_line`` (archives, text files, rendered
tables). Output: these three plus

* ``row`` - struct of the layout's output columns,
* ``error`` - struct(column, message) of the first bad column in record order, null for good rows,
* ``structural`` - message if the record has a wrong length or was not read, which fails the file,
* ``coerced`` - names of columns whose bad value became null, up to the first bad column,
* ``task`` - number of the task that decoded the line.

A filter on these columns should go through ``select_decoded``: it names ``task``, which is not deterministic,
so the optimizer does not copy the whole parse into the filter and compute it twice.

Everything is one projection of built-in expressions; there is no Python and no shuffle. The code generated for a
layout soon passes 8000 bytes of a method, beyond which the JVM only interprets it, so sessions at Spark's own limit
for such methods get that of the JVM (``JIT_LIMIT``): Spark then cuts the projection into smaller methods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.functions import fields as X
from fwloom.layouts import Layout, check

ERROR = "struct<column:string,message:string>"
HUGE_METHODS, SPARK_LIMIT, JIT_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def length_message(line: Column, layout: Layout) -> Column:
    n = F.length(line)
    return F.when(n < layout.min_record_length, F.concat(F.lit("record truncated: length "), n, F.lit(f", needs {layout.min_record_length}"))).when(n > layout.record_length, F.concat(F.lit("record longer than declared: length "), n, F.lit(f", declared {layout.record_length}")))


def compiled(spark: SparkSession) -> None:
    """Keeps generated methods small enough for the JVM's compiler, unless the session has a limit of its own."""
    if spark.conf.get(HUGE_METHODS, SPARK_LIMIT) == SPARK_LIMIT:
        spark.conf.set(HUGE_METHODS, JIT_LIMIT)


def decode(lines: DataFrame, layout: Layout) -> DataFrame:
    check(layout)
    compiled(lines.sparkSession)
    line = F.col("raw_line")
    names = ["input_path", "line_no", "raw_line"]
    fields = layout.fields
    text, value = {f.name: f"__text{i}" for i, f in enumerate(fields)}, {f.name: f"__value{i}" for i, f in enumerate(fields)}
    read_error = [F.col("read_error")] if "read_error" in lines.columns else []
    # Plain columns step by step: the optimizer keeps apart what is used more than once, so nothing is computed twice.
    step = lines.select(*names, F.coalesce(*read_error, length_message(line, layout)).alias("structural"), X.is_plain(line).alias("__plain"))
    step = step.select("*", *(X.text_of(line, f, F.col("__plain")).alias(text[f.name]) for f in fields))
    step = step.select("*", *(X.value_of(F.col(text[f.name]), f).alias(value[f.name]) for f in fields))
    messages: dict[str, Column] = {}
    for f in fields:
        message = X.message_of(F.col(text[f.name]), F.col(value[f.name]), f)
        if message is not None:
            messages[f.name] = message.alias(f"__bad{len(messages)}")
    step = step.select("*", *messages.values())
    messages = {n: F.col(f"__bad{i}") for i, n in enumerate(messages)}
    for i, c in enumerate(layout.computed_columns):
        made, message = X.compute([F.col(value[s]) for s in c.sources], c)
        value[c.name] = f"__computed{i}"
        step = step.select("*", made.alias(value[c.name]), message.alias(f"__message{i}"))
        messages[c.name] = F.col(f"__message{i}")
    first = F.coalesce(*(F.when(m.isNotNull(), F.struct(F.lit(n).alias("column"), m.alias("message"))) for n, m in messages.items()), F.lit(None).cast(ERROR))
    error = F.when(F.col("structural").isNull(), first)
    coerced, clean = [], F.col("structural").isNull()
    for f in fields:
        if f.coerce_invalid_to_null:
            coerced.append(F.when(clean & X.is_bad(F.col(text[f.name]), F.col(value[f.name]), f), F.lit(f.name)))
        elif f.name in messages:
            clean = clean & messages[f.name].isNull()
    names_of = F.array_compact(F.array(*coerced)) if coerced else F.lit(None).cast("array<string>")
    row = F.struct(*(F.col(value[c.name]).alias(c.name) for c in layout.outputs))
    return step.select(*names, row.alias("row"), error.alias("error"), "structural", names_of.alias("coerced"), F.spark_partition_id().alias("task"))


def select_decoded(decoded: DataFrame, condition: Column) -> DataFrame:
    """Rows of decoded lines that meet ``condition``."""
    return decoded.where(condition & (F.col("task") >= 0))


def good_rows(decoded: DataFrame, layout: Layout) -> DataFrame:
    """Output columns of rows without errors; without validation where no column can fail."""
    return select_decoded(decoded, F.col("structural").isNull() & F.col("error").isNull()).select("row.*")


def project(lines: DataFrame, layout: Layout, columns: list[str], where: Column | None = None) -> DataFrame:
    """Some output columns without validation: only their slices are parsed, bad values are null.

    A filter on these columns should be given as ``where``: it is kept above the parse, as in ``select_decoded``.
    """
    compiled(lines.sparkSession)
    made = {c.name: c for c in layout.computed_columns}
    needed = [f for f in layout.fields if f.name in columns or any(f.name in made[c].sources for c in columns if c in made)]
    step = lines.select("raw_line", X.is_plain(F.col("raw_line")).alias("__plain"))
    step = step.select(*(X.text_of(F.col("raw_line"), f, F.col("__plain")).alias(f"__text{i}") for i, f in enumerate(needed)))
    step = step.select(*(X.value_of(F.col(f"__text{i}"), f).alias(f.name) for i, f in enumerate(needed)))
    out = step.select(*(X.compute([F.col(s) for s in made[c].sources], made[c])[0].alias(c) if c in made else F.col(c) for c in columns))
    if where is None:
        return out
    return out.select("*", F.spark_partition_id().alias("__task")).where(where & (F.col("__task") >= 0)).drop("__task")


def render(df: DataFrame, layout: Layout) -> Column:
    """The inverse of decoding for tables: a ``raw_line`` expression, numbers to the right, text to the left."""
    parts, at = [], 1
    for f in layout.fields:
        if f.start > at:
            parts.append(F.lit(" " * (f.start - at)))
        c = F.col(f.physical_name)
        if f.dtype == "Int64":
            text = F.lpad(F.coalesce(c.cast("string"), F.lit("")), f.length, " ")
        elif f.dtype == "Float64":
            text = F.lpad(F.coalesce(F.format_string("%.2f", c), F.lit("")), f.length, " ")
        elif f.dtype == "Date":
            text = F.rpad(F.coalesce(F.date_format(c, "yyyyMM" if f.parse == "yyyymm_to_date" else "yyyyMMdd"), F.lit("")), f.length, " ")
        else:
            text = F.rpad(F.coalesce(c, F.lit("")), f.length, " ")
        parts.append(text)
        at = f.end + 1
    if layout.record_length >= at:
        parts.append(F.lit(" " * (layout.record_length - at + 1)))
    return reduce(lambda a, b: F.concat(a, b), parts)
