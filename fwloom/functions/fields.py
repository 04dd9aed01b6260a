"""Parsers of fixed-width fields and computed columns, as pure Catalyst expressions.

A field passes three expressions: trimmed text, value, and a message that is null unless the value is bad. Text
rules follow Python's: white space is what ``str.isspace`` says, dates are read as leniently as ``strptime``
does. Accepted differences: digit separators (``1_000``) and digits beyond ASCII do not parse, integers of
64 bits and more are bad values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fwloom.layouts import Computed, Field, LayoutError

#: White space of Python's str.isspace, as a Java character class.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
FLOAT = r"^[+-]?((([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?)|(?i:inf|infinity|nan))$"
MONTHS = "1[0-2]|0[1-9]|[1-9]"
DATES = {
    "yyyymmdd_to_date": rf"^([0-9]{{4}})({MONTHS})(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$",
    "yyyymm_to_date": rf"^([0-9]{{4}})({MONTHS})$",
}

Parsed = tuple[Column, Column]


def is_plain(line: Column) -> Column:
    """Whether a line is printable ASCII and spaces alone, so that spaces are all there is to trim."""
    return ~line.rlike("[^\\x20-\\x7e]")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, SPACE + "+$", "")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def text_of(line: Column, field: Field, plain: Column | None = None) -> Column:
    """The field's characters, trimmed as its type wants it; empty for blanks. ``plain`` is ``is_plain`` of the line."""
    plain = is_plain(line) if plain is None else plain
    raw = F.substring(line, field.start, field.length)
    right = field.dtype == "Utf8"
    return F.when(plain, F.rtrim(raw) if right else F.trim(raw)).otherwise(rstrip(raw) if right else strip(raw))


def parse_text(text: Column, field: Field) -> Column:
    return F.nullif(text, F.lit(""))


def parse_long(text: Column, field: Field) -> Column:
    return text.try_cast("bigint")


def parse_double(text: Column, field: Field) -> Column:
    """Digits at the end and no hexadecimal mark leave the cast nothing to accept that Python would not."""
    common = F.ascii(F.right(text, F.lit(1))).between(ord("."), ord("9")) & ~text.contains("x") & ~text.contains("X")
    return F.when(common | text.rlike(FLOAT), text.try_cast("double"))


def parse_date(text: Column, field: Field) -> Column:
    """Dates in full digits by a cast; other forms, which strptime also takes, by regular expressions."""
    kind = field.parse or "yyyymmdd_to_date"
    whole = kind == "yyyymmdd_to_date"
    digits = F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.concat(F.lit("-"), F.substring(text, 7, 2)) if whole else F.lit("-01"))
    part = lambda n: F.regexp_extract(text, DATES[kind], n)
    day = F.lpad(F.trim(part(3)), 2, "0") if whole else F.lit("01")
    other = F.try_to_date(F.concat(part(1), F.lpad(part(2), 2, "0"), day), "yyyyMMdd")
    full = (F.length(text) == (8 if whole else 6)) & text.try_cast("int").isNotNull()
    return F.when((text == "") | text.startswith("0000"), F.lit(None)).when(full, digits.try_cast("date")).when(text.rlike(DATES[kind]), other)


PARSERS: dict[str, Callable[[Column, Field], Column]] = {"Utf8": parse_text, "Int64": parse_long, "Float64": parse_double, "Date": parse_date}


def value_of(text: Column, field: Field) -> Column:
    return PARSERS[field.dtype](text, field)


def is_bad(text: Column, value: Column, field: Field) -> Column:
    """Whether characters are there but no value; text is never bad."""
    return (text != "") & value.isNull() if field.dtype != "Utf8" else F.lit(False)


def message_of(text: Column, value: Column, field: Field) -> Column | None:
    """Message of a bad value; None where a field cannot be bad."""
    if field.coerce_invalid_to_null or (field.dtype == "Utf8" and field.nullable):
        return None
    bad = F.when(is_bad(text, value, field), F.concat(F.lit("cannot parse '"), text, F.lit(f"' as {field.dtype}")))
    return bad if field.nullable else F.coalesce(bad, F.when(value.isNull(), F.lit("blank value in non-nullable column")))


def concat_to_date(sources: list[Column], made: Computed) -> Parsed:
    base, day = sources
    digits = strip(day.cast("string"))
    value = F.when(digits.rlike("^[+]?[0-9]{1,9}$") & digits.try_cast("int").between(1, 31), F.try_to_date(F.concat(F.date_format(base, "yyyyMM"), F.lpad(digits.try_cast("int").cast("string"), 2, "0")), "yyyyMMdd"))
    given = base.isNotNull() & (digits != "")
    return F.when(given, value), F.when(given & value.isNull(), F.concat(F.lit("no such date: day '"), digits, F.lit("' of "), F.date_format(base, "yyyy-MM")))


def concat_text(sources: list[Column], made: Computed) -> Parsed:
    parts = F.filter(F.transform(F.array(*sources), strip), lambda x: x.isNotNull() & (x != ""))
    joined = strip(F.regexp_replace(F.array_join(parts, made.separator), SPACE + "+", " "))
    return F.nullif(joined, F.lit("")), F.lit(None).cast("string")


COMPUTERS: dict[str, Callable[[list[Column], Computed], Parsed]] = {"concat_to_date": concat_to_date, "concat_text": concat_text}


def register_computed(kind: str, dtype: str, build: Callable[[list[Column], Computed], Parsed]) -> None:
    """Adds a kind of computed column; ``build`` returns value and message expressions."""
    from fwloom.layouts import COMPUTED_KINDS

    if kind in COMPUTERS:
        raise LayoutError(f"computed kind {kind!r} exists")
    COMPUTERS[kind], COMPUTED_KINDS[kind] = build, dtype


def compute(sources: list[Column], made: Computed) -> Parsed:
    value, bad = COMPUTERS[made.kind](sources, made)
    if not made.nullable:
        bad = F.coalesce(bad, F.when(value.isNull(), F.lit("null in non-nullable computed column")))
    return value, bad
