"""A table function for SQL: ``SELECT * FROM fwf_decode(TABLE(lines), 'imports')``.

The function is polymorphic: its columns are those of the layout that the call names. It gives the good rows of ``decode``: lines
of a right length without a bad field. Lines come and rows go as Arrow batches; fields are sliced, trimmed and read as columns, values of
unusual form and computed columns one by one. For DataFrames ``operators.decode`` is the way: it stays in the JVM and tells what is wrong with a row.

A function that takes rows costs an Arrow batch for each of them, also where it gives none. ``arrow_udtf`` takes batches, but in
Spark 4.1 not with ``analyze``, which gives the columns; Spark analyses and evaluates apart, so the function is made by ``udtf`` and evaluated as
those of ``arrow_udtf`` are. Spark keeps a task's lines until the task ends, to pair them with results, and spills them to disk where memory is short.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, UserDefinedTableFunction
from pyspark.util import PythonEvalType

from fwloom.functions.fields import DATES, FLOAT
from fwloom.layouts import Computed, Field, Layout, LayoutError, check

NAME = "fwf_decode"
#: Lines that are decoded together.
BATCH = 4096
#: What str.isspace calls white space.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
TYPES = {"Utf8": (StringType(), pa.string()), "Int64": (LongType(), pa.int64()), "Float64": (DoubleType(), pa.float64()), "Date": (DateType(), pa.date32())}
#: Texts that Arrow and numpy read as Python does.
COMMON = {"Int64": "^-?[0-9]{1,18}$", "Float64": "^-?[0-9]{1,15}([.][0-9]{1,15})?$", "yyyymmdd_to_date": "^[0-9]{8}$", "yyyymm_to_date": "^[0-9]{6}$"}


class Bad(ValueError):
    """A field that cannot be read."""


def read_long(text: str) -> int:
    if not re.fullmatch("[+-]?[0-9]+", text) or not -(2**63) <= (value := int(text)) < 2**63:
        raise Bad
    return value


def read_double(text: str) -> float:
    if not re.match(FLOAT, text, re.A):
        raise Bad
    return float(text)


def read_date(kind: str) -> Callable[[str], dt.date]:
    form = re.compile(DATES[kind])

    def read(text: str) -> dt.date:
        m = form.match(text)
        try:
            return dt.date(int(m[1]), int(m[2]), int(m[3]) if m.re.groups > 2 else 1)
        except (TypeError, ValueError) as e:
            raise Bad from e

    return read


def dates_of(digits: pa.Array, kind: str) -> pa.Array:
    """Dates of texts that are digits alone; null where there is no such day."""
    n = pc.fill_null(digits.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    n = n if kind == "yyyymmdd_to_date" else n * 100 + 1
    year, month = n // 10000, n // 100 % 100
    first = ((year - 1970) * 12 + month - 1).astype("M8[M]")
    day = first.astype("M8[D]") + (n % 100 - 1)
    there = (year >= 1) & (month >= 1) & (month <= 12) & (day.astype("M8[M]") == first)
    return pa.array(day, pa.date32(), mask=~there)


def texts_of(lines: pa.Array, field: Field, ascii_only: bool) -> pa.Array:
    """The field's characters, trimmed as its type wants it; null for blanks."""
    start, end = field.start - 1, field.end
    raw = pc.binary_slice(lines.cast(pa.binary()), start, end).cast(pa.string()) if ascii_only else pc.utf8_slice_codeunits(lines, start, end)
    texts = (pc.utf8_rtrim if field.dtype == "Utf8" else pc.utf8_trim)(raw, SPACES)
    return pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.string()), texts)


def column_of(texts: pa.Array, field: Field) -> tuple[pa.Array, pa.Array]:
    """Values of a field, and which rows it spoils."""
    values, spoilt = texts, pa.array(np.zeros(len(texts), bool))
    if field.dtype != "Utf8":
        kind = field.parse or "yyyymmdd_to_date" if field.dtype == "Date" else field.dtype
        common = pc.if_else(pc.match_substring_regex(texts, COMMON[kind]), texts, pa.scalar(None, pa.string()))
        values = dates_of(common, kind) if field.dtype == "Date" else common.cast(TYPES[field.dtype][1])
        left = pc.and_(texts.is_valid(), values.is_null())
        if rest := texts.filter(left).to_pylist():
            read = {"Int64": read_long, "Float64": read_double}.get(kind) or read_date(kind)
            found, bad = [], []
            for t in rest:
                try:
                    found.append(read(t))
                    bad.append(False)
                except Bad:
                    found.append(None)
                    bad.append(not field.coerce_invalid_to_null)
            values = pc.replace_with_mask(values, left, pa.array(found, values.type))
            spoilt = pc.replace_with_mask(spoilt, left, pa.array(bad))
    return values, spoilt if field.nullable else pc.or_(spoilt, values.is_null())


def joined_date(base: dt.date | None, day: object) -> dt.date | None:
    text = "" if day is None else str(day).strip()
    if base is None or not text:
        return None
    if not re.fullmatch("[+]?[0-9]{1,9}", text):
        raise Bad
    try:
        return base.replace(day=int(text))
    except ValueError as e:
        raise Bad from e


def joined_text(parts: tuple, separator: str) -> str | None:
    return re.sub(f"[{SPACES}]+", " ", separator.join(x for p in parts if p is not None and (x := p.strip()))).strip() or None


def computed_of(sources: list[pa.Array], made: Computed) -> tuple[pa.Array, pa.Array]:
    values, spoilt = [], []
    for parts in zip(*(c.to_pylist() for c in sources)):
        try:
            value = joined_date(*parts) if made.kind == "concat_to_date" else joined_text(parts, made.separator)
            spoilt.append(value is None and not made.nullable)
        except Bad:
            value = None
            spoilt.append(True)
        values.append(value)
    return pa.array(values, TYPES[made.dtype][1]), pa.array(spoilt, pa.bool_())


def decode_batch(lines: pa.Array, layout: Layout) -> pa.Table:
    """The output columns of good rows; nulls and lines of another length give none."""
    lines = lines.cast(pa.string())
    size = pc.utf8_length(lines)
    ascii_only = size.equals(pc.binary_length(lines))
    lines = lines.filter(pc.fill_null(pc.and_(pc.greater_equal(size, layout.min_record_length), pc.less_equal(size, layout.record_length)), False))
    values, bad = {}, pa.array(np.zeros(len(lines), bool))
    for f in layout.fields:
        values[f.name], spoilt = column_of(texts_of(lines, f, ascii_only), f)
        bad = pc.or_(bad, spoilt)
    for c in layout.computed_columns:
        values[c.name], spoilt = computed_of([values[s] for s in c.sources], c)
        bad = pc.or_(bad, spoilt)
    good = pc.invert(bad)
    return pa.table({c.name: values[c.name].filter(good) for c in layout.outputs})


def table_function(layouts: dict[str, Layout]) -> UserDefinedTableFunction:
    """The function over named layouts; they go to the tasks with it."""
    for layout in layouts.values():
        check(layout)
        if kinds := {c.kind for c in layout.computed_columns} - {"concat_to_date", "concat_text"}:
            raise LayoutError(f"{NAME} does not know computed columns of kind {', '.join(sorted(kinds))}")

    @udtf(useArrow=True)
    class FwfDecode:
        @staticmethod
        def analyze(lines: AnalyzeArgument, layout: AnalyzeArgument) -> AnalyzeResult:
            if not lines.isTable or "raw_line" not in [f.name for f in lines.dataType.fields]:
                raise LayoutError(f"{NAME} takes a table with a column raw_line")
            if layout.value not in layouts:
                raise LayoutError(f"no layout {layout.value!r}; there are {', '.join(sorted(layouts))}")
            return AnalyzeResult(StructType([StructField(c.name, TYPES[c.dtype][0]) for c in layouts[layout.value].outputs]))

        def eval(self, lines: pa.RecordBatch, layout: pa.Array) -> Iterator[pa.Table]:
            texts = lines.column(lines.schema.names.index("raw_line"))
            for at in range(0, len(texts), BATCH):
                yield decode_batch(texts.slice(at, BATCH), layouts[layout[at].as_py()])

    FwfDecode.evalType = PythonEvalType.SQL_ARROW_UDTF
    return FwfDecode


def register(spark: SparkSession, layouts: dict[str, Layout]) -> None:
    """Makes ``fwf_decode`` known to SQL, for layouts by name."""
    spark.udtf.register(NAME, table_function(layouts))
