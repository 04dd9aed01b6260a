import random
from dataclasses import replace

import pytest

from fwloom.functions import table as T
from fwloom.layouts import Computed, Field, Layout, LayoutError
from fwloom.operators import decode as D

LAYOUT = Layout("imports", "2020-01", "2020-01", 60, (
    Field("day", 1, 8, "Date"), Field("month", 9, 6, "Date", parse="yyyymm_to_date"), Field("n", 15, 6, "Int64", False), Field("x", 21, 7, "Float64", coerce_invalid_to_null=True),
    Field("a", 28, 6, "Utf8"), Field("b", 34, 6, "Utf8", False), Field("dd", 40, 2, "Int64"),
), "day", computed_columns=(Computed("on", "Date", "concat_to_date", ("month", "dd")), Computed("name", "Utf8", "concat_text", ("a", "b"), separator="/")), dropped_columns=("dd",))


def random_line(rng):
    pick = lambda n, *good: rng.choice([*good, *good, " " * n, "".join(rng.choice("0123456789 .-+eEnaif\tx") for _ in range(n))]).ljust(n)[:n]
    line = pick(8, "20240115", "20240229", "20230229", "00000000", "2024 1 5") + pick(6, "202402", "202413", "20242 ") + pick(6, "    12", "+5", "-0", "999999") + pick(7, "1.5", "-.5e3", "  inf", "nan")
    line += pick(6, "Ada", "  B", "é　", "日本") + pick(6, "Love", "x\ty", " ") + pick(2, "15", "31", "00", " 7")
    return line + rng.choice(["", "", " " * 19, " " * 20, "x" * 30]) if rng.random() < 0.95 else line[: rng.randrange(41)]


def test_function_gives_what_decode_gives(spark):
    rng = random.Random(8)
    rows = [("f", n, random_line(rng)) for n in range(9000)] + [("f", 0, None)]
    lines = spark.createDataFrame(rows, "input_path string, line_no long, raw_line string").repartition(3)
    lines.createOrReplaceTempView("some_lines")
    T.register(spark, {"imports": LAYOUT, "plain": replace(LAYOUT, computed_columns=(), dropped_columns=())})
    for name, layout in (("imports", LAYOUT), ("plain", replace(LAYOUT, computed_columns=(), dropped_columns=()))):
        want = D.good_rows(D.decode(lines.where("raw_line IS NOT NULL"), layout), layout)
        got = spark.sql(f"SELECT * FROM fwf_decode(TABLE(some_lines), '{name}')")
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 300
    assert spark.sql("SELECT count(*) AS n FROM fwf_decode(TABLE(SELECT raw_line FROM some_lines WHERE raw_line IS NULL), 'imports')").first()["n"] == 0


def test_function_refuses(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    spark.sql("SELECT '' AS raw_line").createOrReplaceTempView("one_line")
    T.register(spark, {"imports": LAYOUT})
    for sql, what in (("TABLE(numbers), 'imports'", "raw_line"), ("TABLE(one_line), 'other'", "no layout")):
        with pytest.raises(Exception, match=what):
            spark.sql(f"SELECT * FROM fwf_decode({sql})").collect()
    with pytest.raises(LayoutError):
        T.table_function({"bad": replace(LAYOUT, columns=())})
